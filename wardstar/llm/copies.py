"""Near copies by the Jaccard similarity of their five-word shingles, checked exactly.

Candidates come from SimHash: texts whose 64-bit fingerprints are equal or linked at the
anchors of `simhash.py`. A radius for similarity 0.8 is too wide for anchors (some 15% of the
bits differ there), so every text's set of shingle hashes also gets 80 minimum hashes in 16
bands of five. Two sets of similarity s share a band with probability 1 - (1 - s^5)^16: 0.998
at 0.8, more above. Only pairs whose exact similarity is 0.8 or more are linked, whichever way
they met.

First each member of a band is compared with the band's least member, which joins up nearly
all of a large group of near copies in one comparison each. Bands whose members are not yet in
one component are then compared within, all members; of these only a spanning forest is given.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import grouped, id_text, prepare, split_hot, stored, with_key
from wardstar.llm.components import components
from wardstar.llm.simhash import fingerprint, links

WORDS, SEED = 5, 42
#: Least similarity, as a ratio of whole numbers.
SIMILAR = (4, 5)
BANDS, BAND_ROWS = 16, 5
#: Bands beyond this are compared in pairs of blocks.
GROUP_ROWS = 1_024

_MIX = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 63, (2, BANDS * BAND_ROWS, 1), np.uint64)
_XOR, _ODD = _MIX[0], _MIX[1] * np.uint64(2) + np.uint64(1)


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """The different hashes of a UTF-8 text's word runs, sorted; a shorter text is one run."""
    found = raw.lower().split()  # on bytes, both mean ASCII
    if not found:
        return np.empty(0, np.uint64)
    line, n = b" ".join(found), max(1, len(found) - words + 1)
    if n == 1:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    runs = (digest(line[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist()))
    return np.unique(np.fromiter(runs, np.uint64, n))


def bands(found: np.ndarray) -> list[int]:
    """The band hashes of a set; an empty set has none."""
    if not len(found):
        return []
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2_048):
        mixed = (found[None, at : at + 2_048] ^ _XOR) * _ODD
        least = np.minimum(least, (mixed ^ mixed >> np.uint64(29)).min(axis=1))
    rows = least.reshape(BANDS, BAND_ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), i) - (1 << 63) for i, row in enumerate(rows)]


def similar(common, a, b):
    """Whether sets of a and b members with so many in common are near copies."""
    return common * SIMILAR[1] >= (a + b - common) * SIMILAR[0]


def forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between near copies that connect all that such links connect. No set is empty."""
    links: list[tuple[int, int]] = []
    left = np.arange(1, len(sets))
    queue, held = [0], np.empty(0, np.int64)
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
            continue
        p = queue.pop()
        if len(held) == 0 or len(left) * 2 <= len(held):
            held, flat = left, np.concatenate([sets[i] for i in left])
            sizes = np.array([len(sets[i]) for i in held])
            starts = np.cumsum(sizes) - sizes
        own = sets[p]
        hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
        near = held[similar(np.add.reduceat(hit, starts, dtype=np.int64), sizes, len(own))]
        found = np.intersect1d(near, left, assume_unique=True)
        left = np.setdiff1d(left, found, assume_unique=True)
        links += [(p, int(q)) for q in found]
        queue.extend(found.tolist())
    return links


def _sets(docs: DataFrame, key: list[str]) -> DataFrame:
    """(doc_id, key, set_id, bands, fp) of every row; a null text has no words.

    fp is the text's SimHash of the same runs; a text without words has none.
    """

    def run(batches):
        for batch in batches:
            texts = batch.column(3).to_pylist()
            found = [shingles(t or b"") for t in texts]
            ids = [xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in found]
            fps = [fingerprint(t, WORDS) if len(s) else None for t, s in zip(texts, found)]
            columns = [pa.array(ids, pa.int64()), pa.array([bands(s) for s in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), *columns, pa.array(fps, pa.int64())],
                ["doc_id", *key, "set_id", "bands", "fp"],
            )

    rows = docs.select("doc_id", *key, F.col("text").cast("binary"))
    schema = f"doc_id long, {key[0]} string, {key[1]} long, set_id long, bands array<long>, fp long"
    return rows.mapInArrow(run, schema)


def simhash_pairs(marked: DataFrame) -> DataFrame:
    """Candidates (a, b): sets that have a fingerprint in common, or whose fingerprints are linked.

    marked: set_id, fp. A fingerprint stands for its least set; the others with it are paired
    with that one.
    """
    of_set = stored(marked.filter("fp IS NOT NULL").select("fp", "set_id").distinct(), "set_fingerprints")
    least = stored(of_set.groupBy("fp").agg(F.min("set_id").alias("least")), "fp")
    equal = of_set.join(least, "fp").select(F.col("set_id").alias("a"), F.col("least").alias("b"))
    near = links(least.select("fp")).toDF("x", "y")
    near = near.join(least.toDF("x", "a"), "x").join(least.toDF("y", "b"), "y").select("a", "b")
    return equal.union(near).filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _with_shingles(texts: DataFrame) -> DataFrame:
    """(set_id, shingles) of (set_id, text)."""

    def run(batches):
        for batch in batches:
            found = pa.array([shingles(t or b"").tobytes() for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["set_id", "shingles"])

    return texts.mapInArrow(run, "set_id long, shingles binary")


def _checked(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are near copies."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(similar(common, len(x), len(y))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = members.select(F.col("set_id").alias("a"), F.col("shingles").alias("x"))
    second = members.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
    rows = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(run, "a long, b long")


def _within(rows: DataFrame, members: DataFrame, group_rows: int) -> DataFrame:
    """Links (a, b) within groups of (band, set_id), from comparing all their members."""
    rows = split_hot(rows, ["band"], "set_id", group_rows).select("band", "pair", "set_id")

    def run(batches):
        for group in grouped(batches, 2):
            ids = group.column(2).to_pylist()
            found = forest([np.frombuffer(s, np.uint64) for s in group.column(3).to_pylist()])
            if found:
                a, b = ([ids[link[end]] for link in found] for end in range(2))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    full = rows.join(members, "set_id").select("band", "pair", "set_id", "shingles")
    return full.repartition("band", "pair").sortWithinPartitions("band", "pair").mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, list[str]]:
    """(doc_id, key, label) of every row of docs, label a number of its component; the key's names too.

    Equal sets of shingles are linked, so are all texts without words. Repeated rows stay.
    """
    prepare(docs.sparkSession)
    keyed, key = with_key(docs.select(F.col("doc_id").cast("long"), "text"))
    marked = stored(_sets(keyed, key), "sets")
    sets = marked.groupBy("set_id").agg(F.min(F.struct(*key)).alias("row"), F.first("bands").alias("bands"))
    sets = stored(sets, "different_sets")
    at = sets.select("set_id", F.explode("bands").alias("band"))

    pivots = at.groupBy("band").agg(F.min("set_id").alias("b"), F.count("*").alias("n")).filter("n > 1")
    at = stored(at.join(pivots, "band").select("band", "set_id", "b", "n"), "candidates")
    met = stored(simhash_pairs(marked), "simhash_pairs")
    pairs = stored(at.filter("set_id != b").select(F.col("set_id").alias("a"), "b").union(met).distinct(), "pairs")
    ids = at.select("set_id").union(met.select("a")).union(met.select("b"))
    named = ids.distinct().join(sets, "set_id").select("set_id", "row.*")
    texts = named.join(keyed, key).select("set_id", F.col("text").cast("binary").alias("text"))
    members = stored(_with_shingles(texts.dropDuplicates(["set_id"])), "members")
    linked = stored(_checked(pairs, members), "checked")

    known = stored(components(linked), "components")
    label = F.coalesce("component", "set_id")
    labelled = at.filter("n > 2").join(known, F.col("set_id") == F.col("node"), "left")
    mixed = (
        labelled.groupBy("band")
        .agg(F.min(label).alias("low"), F.max(label).alias("high"), F.bit_xor(F.xxhash64("set_id")).alias("mark"), F.count("*").alias("n"))
        .filter("low != high")
        .groupBy("mark", "n")  # bands with the same members are compared once
        .agg(F.min("band").alias("band"))
    )
    more = stored(_within(at.join(mixed.select("band"), "band").select("band", "set_id"), members, group_rows), "more")
    labels = components(known.toDF("a", "b").union(more))
    of_set = F.coalesce("component", "set_id").alias("label")
    return marked.join(labels, F.col("set_id") == F.col("node"), "left").select("doc_id", *key, of_set), key


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each component: that of its smallest doc_id, with all columns of docs.

    Ties (one id in several rows of a component) go to the smallest hash of the text;
    rows equal in both are one row. If a component has null ids only, one of them stays.
    """
    found, found_key = near_copies(docs, **options)
    marked, key = with_key(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.col(found_key[1]).alias("hash"))
    chosen = found.groupBy("label").agg(F.min(order).alias("best")).select("best.*")
    chosen = chosen.select(id_text("doc_id").alias(key[0]), F.col("hash").alias(key[1]))
    return marked.join(chosen, key).dropDuplicates(key).select(*docs.columns)
