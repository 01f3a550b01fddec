"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of the hashes of all runs of `gram` words, the least in each window of `window`
neighbouring ones is kept. A span of gram + window - 1 words holds a whole window, so a
document and an item that share such a span share a kept hash: with 5 and 6 every shared
span of ten words is found. Documents are joined with the items on kept hashes; in those
that match, every ten-word span around a matching run is compared word for word.

Items of fewer words than a span hold no window. All runs of exactly their length are
kept instead (a window of one), in documents too, for the lengths that occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import id_text, let, prepare, stored, text_or_empty, with_key

GRAM, WINDOW = 5, 6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything in ASCII that is no digit and no small letter.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; of a null text there are none."""
    text = F.coalesce(text, F.lit(""))
    # lower() also changes letters beyond ASCII, so it serves plain texts only.
    plain = F.octet_length(text) == F.char_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, _GAPS), "")


def _runs(hashes: Column, n: int) -> Column:
    """A hash of each run of n words."""
    at = F.sequence(F.lit(0), F.size(hashes) - n)
    run = F.transform(at, lambda i: F.xxhash64(F.lit(n), *[F.get(hashes, i + j) for j in range(n)]))
    return F.when(F.size(hashes) >= n, run).otherwise(F.array().cast("array<long>"))


def _winnowed(hashes: Column, gram: int, window: int) -> Column:
    """The least of each window of neighbouring runs."""

    def least(runs: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(runs) - window)
        kept = F.transform(at, lambda i: F.least(*[F.get(runs, i + j) for j in range(window)]))
        return F.array_distinct(F.when(F.size(runs) >= window, kept).otherwise(F.array().cast("array<long>")))

    return let(_runs(hashes, gram), least)


def _hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def _kept(found: Column, short: list[int], gram: int, window: int) -> Column:
    """All kept hashes of a text: winnowed ones, and every run of the short lengths."""
    return let(
        _hashes(found),
        lambda h: F.concat(_winnowed(h, gram, window), *[F.array_distinct(_runs(h, n)) for n in short]),
    )


def _spans(found: Column, matched: Column, short: list[int], gram: int, window: int) -> Column:
    """The spans around matching runs, as (start, end, words)."""
    span = gram + window - 1

    def places(h: Column, n: int) -> Column:
        return F.filter(
            F.transform(_runs(h, n), lambda x, i: F.when(F.array_contains(matched, x), i)), lambda i: i.isNotNull()
        )

    def cut(starts: Column, n: int) -> Column:
        return F.transform(
            F.array_distinct(starts),
            lambda s: F.struct(
                s.alias("start"), (s + n).alias("end"), F.array_join(F.slice(found, s + 1, n), " ").alias("span")
            ),
        )

    def around(i: Column) -> Column:
        first, last = F.greatest(i - (window - 1), F.lit(0)), F.least(i, F.size(found) - span)
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    def all_spans(h: Column) -> Column:
        long = F.flatten(F.transform(places(h, gram), around))
        return F.concat(cut(long, span), *[cut(places(h, n), n) for n in short])

    return let(_hashes(found), all_spans)


RESULT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def contamination(docs: DataFrame, items: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """One row per document: the columns of RESULT.

    docs: doc_id, text. items: item_id, text. A word is hit if it lies inside any
    occurrence of an item's window. Null and empty texts have no words and are never hit;
    an item without words has no window; an item without id hits words but is not listed.
    Rows equal in id and text get equal results, one row each. Without items or without
    documents nothing is hit, and the result is as long as docs.
    """
    return _marked(docs, items, gram, window)[0].select(*RESULT)


def _marked(docs: DataFrame, items: DataFrame, gram: int, window: int) -> tuple[DataFrame, list[str]]:
    """The result with the two key columns, and their names."""
    prepare(docs.sparkSession)
    span = gram + window - 1
    item = items.select(id_text("item_id").alias("item"), words(F.col("text")).alias("words"))
    item = stored(item.filter(F.size("words") > 0), "items")
    sizes = item.filter(F.size("words") < span).select(F.size("words").alias("n")).distinct()
    short = sorted(r.n for r in sizes.collect())  # at most span - 1 numbers

    item_hashes = item.select(F.explode(_kept(F.col("words"), short, gram, window)).alias("hash")).distinct()
    n = F.least(F.size("words"), F.lit(span))
    item_spans = item.select(
        "item",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - n + 1),
                lambda i: F.array_join(F.slice("words", i, n), " "),
            )
        ).alias("span"),
    ).distinct()

    keyed, key = with_key(docs.select("doc_id", "text"))
    tokens = keyed.select(*key, words(F.col("text")).alias("words"))
    matched = (
        tokens.select(*key, F.explode(_kept(F.col("words"), short, gram, window)).alias("hash"))
        .join(item_hashes, "hash", "left_semi")
        .groupBy(*key)
        .agg(F.collect_set("hash").alias("matched"))
    )
    hit_spans = (
        keyed.join(matched, key)
        .select(*key, words(F.col("text")).alias("words"), "matched")
        .select(*key, F.explode(_spans(F.col("words"), F.col("matched"), short, gram, window)).alias("at"))
        .select(*key, "at.start", "at.end", "at.span")
    )
    place = F.struct("start", "end").alias("place")
    hits = (
        hit_spans.join(item_spans, "span")
        .groupBy(*key)
        .agg(F.collect_set(place).alias("places"), F.collect_set(F.nullif("item", F.lit(""))).alias("items"))
    )
    covered = F.aggregate(
        F.array_sort("places"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("edge")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], acc["edge"]))).alias("n"),
            F.greatest(acc["edge"], x["end"]).alias("edge"),
        ),
    )["n"]
    listed = F.array_join(F.array_sort("items"), ",")
    found = hits.select(
        *key, covered.alias("n_hit"), F.size("items").alias("n_items"), F.sha2(listed, 256).alias("items_sha256")
    )
    counted = keyed.select("doc_id", *key, F.size(words(text_or_empty())).alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    result = counted.join(found, key, "left").select(
        "doc_id",
        *key,
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
    return result, key


def clean(docs: DataFrame, items: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """The rows of docs, all columns, that hold no window of any item."""
    found, key = _marked(docs, items, gram, window)
    keyed, own = with_key(docs)
    dirty = found.filter("contaminated").select(*key).distinct().toDF(*own)
    return keyed.join(dirty, own, "left_anti").select(*docs.columns)
