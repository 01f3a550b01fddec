"""Ranked lexical search over a length-stratified index.

Documents with equal length normaliser m are a stratum. Within a stratum the score of a
term depends on its occurrences tf alone, so a stratum's postings are kept by tf and an
impact is computed once per tf. The most a stratum can give to an item is the sum of its
terms' weights times the impact of the largest tf the stratum has of them. Strata are
visited by falling bounds, and a stratum is scored only for the items whose bound reaches
the k-th best score a task has seen.

Large strata are split, so a segment of the index holds some SEGMENT_DOCS documents of one
m. Scores are whole numbers: their sums stay far below 2^53 (checked), so the product of a
segment's impacts with the items' weights is exact in doubles.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.llm.common import prepare, stored

TOP = 10
#: Documents of one stratum that are indexed and scored together.
SEGMENT_DOCS = 1_024
#: Items are searched for in blocks of at most so many items, and pairs of an item and a
#: term (an item with more is a block of its own).
BLOCK_ITEMS, BLOCK_TERMS = 1_024, 1 << 14
#: Columns of a segment's impact matrix that are multiplied at once.
_SLICE = 4_096

# The scale of weights, the scale of impacts and the form of the normaliser.
WEIGHT_SCALE, IMPACT_SCALE = 1_000, 1_000_000_000
LENGTH_BASE, LENGTH_SHARE = 100, 90
TF_FACTOR, M_FACTOR = 1_000, 8

# A-Z become a-z, ASCII signs that are no digit or letter become spaces.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(raw: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text, in order and with repeats; of a null text none."""
    return (raw or b"").translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    """What a term in df of n_docs documents weighs."""
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf, m):
    """Whole-number impact of tf occurrences in a document with normaliser m."""
    return IMPACT_SCALE * tf // (TF_FACTOR * tf + M_FACTOR * m)


@dataclass
class Block:
    """Some items with their terms; all that is broadcast of the query set."""

    ids: list = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    terms: list[int] = field(default_factory=list)  # pairs of a term and an item
    items: list[int] = field(default_factory=list)

    def add(self, item_id, terms: set[bytes]) -> None:
        for term in sorted(terms):
            self.terms.append(self.vocabulary.setdefault(term, len(self.vocabulary)))
            self.items.append(len(self.ids))
        self.ids.append(item_id)

    def weights(self, n_docs: int, df: dict[int, int]) -> np.ndarray:
        """Weight per term and item; a term in no document has none."""
        w = np.zeros((len(self.vocabulary), len(self.ids)))
        of = np.array([weight(n_docs, df[t]) if t in df else 0 for t in range(len(self.vocabulary))], np.float64)
        w[self.terms, self.items] = of[self.terms] if self.terms else 0
        # Every sum is a whole number below 2^53, so doubles add without rounding.
        assert w.sum(axis=0).max(initial=0) * (IMPACT_SCALE / TF_FACTOR) < 2.0**53
        return w


def blocks_of(items: DataFrame) -> Iterator[Block]:
    """The items, a bounded block at a time, as they come from the executors."""
    block = Block()
    for item_id, text in items.select("item_id", F.col("text").cast("binary")).toLocalIterator():
        terms = set(terms_of(text))
        if block.ids and (len(block.ids) >= BLOCK_ITEMS or len(block.terms) + len(terms) > BLOCK_TERMS):
            yield block
            block = Block()
        block.add(item_id, terms)
    if block.ids:
        yield block


def matches(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) per document: its length, its query terms and their occurrences."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most BLOCK_TERMS terms, or one item's

    def run(batches):
        number = known.value
        for batch in batches:
            lengths, ends, terms, tfs = [], [0], [], []
            for raw in batch.column(1).to_pylist():
                found = terms_of(raw)
                lengths.append(len(found))
                for term, tf in Counter(found).items():
                    if (t := number.get(term)) is not None:
                        terms.append(t)
                        tfs.append(tf)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (terms, tfs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and the row each is in."""
    sizes = np.asarray(column.value_lengths())
    return np.asarray(column.flatten()), np.repeat(np.arange(len(column)), sizes)


def index(found: DataFrame, n_docs: int, n_terms: int, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """The index: one row per segment of at most segment_docs documents of one m.

    Columns: m; doc_ids; tfs, the different tf in rising order, with ends, where each one's
    postings end; terms and places, a posting's term and its document's place in doc_ids.
    Documents without a query term score zero and are not indexed. A document's segment
    follows from the hash of its row; rows that all are alike are cut as they come.
    """
    share = f"({LENGTH_SHARE}L * n * {n_docs}L) div {max(n_terms, 1)}L"
    rows = found.filter(F.size("terms") > 0).withColumn("m", F.expr(f"{LENGTH_BASE - LENGTH_SHARE}L + {share}"))
    sizes = stored(rows.groupBy("m").agg(F.ceil(F.count("*") / segment_docs).alias("parts")), "strata")
    part = F.pmod(F.xxhash64("doc_id", "terms", "tfs"), F.col("parts"))
    placed = rows.join(sizes, "m").withColumn("part", part).select("m", "part", "doc_id", "terms", "tfs")

    def segment(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        terms, place = _flat(rows.column("terms").chunk(0))
        tfs, _ = _flat(rows.column("tfs").chunk(0))
        order = np.lexsort((place, terms, tfs))
        different, starts = np.unique(tfs[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        lists = [different, ends, terms[order], place[order]]
        ids = rows.column("doc_id").chunk(0)
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        columns = [pa.array([rows.column("m")[0].as_py()], pa.int64()), one(ids)]
        columns += [one(pa.array(v, pa.int32())) for v in lists]
        return pa.RecordBatch.from_arrays(columns, ["m", "doc_ids", "tfs", "ends", "terms", "places"])

    def run(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            key = [np.asarray(rest.column(c)) for c in ("m", "part")]
            cut = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])) + 1
            edges = [0, *cut.tolist(), rest.num_rows]
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                last = i == len(edges) - 2
                while b - a >= 2 * segment_docs or (b > a and not last):
                    size = segment_docs if b - a >= 2 * segment_docs else b - a
                    yield segment(rest.slice(a, size))
                    a += size
                if last:
                    rest = rest.slice(a)
        if rest is not None and rest.num_rows:
            yield segment(rest)

    dealt = placed.repartition("m", "part").sortWithinPartitions("m", "part")
    lists = "doc_ids array<long>, tfs array<int>, ends array<int>, terms array<int>, places array<int>"
    return dealt.mapInArrow(run, f"m long, {lists}")


def _largest(terms: np.ndarray, impacts: np.ndarray, n_terms: int) -> np.ndarray:
    """The largest impact of each term in a segment; postings come by rising tf."""
    most = np.zeros(n_terms)
    most[terms] = impacts  # the last one, of the largest tf, stays
    return most


def best_of(segments: DataFrame, weights: np.ndarray, top: int = TOP) -> DataFrame:
    """(item, doc_id, score): for each item at least its `top` best documents.

    A task visits its segments by falling bounds and keeps the best of each item.
    """
    w = segments.sparkSession.sparkContext.broadcast(weights)  # one block's terms and items

    def impacts_of(row) -> np.ndarray:
        """Impact of each posting, computed once per tf."""
        tfs, ends = np.asarray(row["tfs"], np.int64), np.asarray(row["ends"], np.int64)
        return np.repeat(impact(tfs, row["m"]).astype(np.float64), np.diff(ends, prepend=0))

    def bounds(batches):
        for batch in batches:
            most = []
            for row in batch.to_pylist():
                largest = _largest(np.asarray(row["terms"]), impacts_of(row), len(w.value))
                most.append(float((largest @ w.value).max(initial=0.0)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(most, pa.float64())], [*batch.schema.names, "bound"])

    def visit(batches):
        n_items = w.value.shape[1]
        worst = np.zeros(n_items)  # score of the top-th best document so far
        held = [([], []) for _ in range(n_items)]  # scores and ids
        for batch in batches:
            for row in batch.to_pylist():
                terms, places = np.asarray(row["terms"]), np.asarray(row["places"])
                value = impacts_of(row)
                bound = _largest(terms, value, len(w.value)) @ w.value
                active = np.flatnonzero((bound >= worst) & (bound > 0))
                if not len(active):
                    continue
                ids = row["doc_ids"]
                present, column = np.unique(terms, return_inverse=True)
                scores = np.zeros((len(ids), len(active)))
                for at in range(0, len(present), _SLICE):
                    inside = (column >= at) & (column < at + _SLICE)
                    part = np.zeros((len(ids), min(_SLICE, len(present) - at)))
                    part[places[inside], column[inside] - at] = value[inside]
                    scores += part @ w.value[np.ix_(present[at : at + _SLICE], active)]
                for k, item in enumerate(active.tolist()):
                    good = np.flatnonzero((scores[:, k] >= worst[item]) & (scores[:, k] > 0))
                    if not len(good):
                        continue
                    old_scores, old_ids = held[item]
                    every = old_scores + scores[good, k].astype(np.int64).tolist()
                    names = old_ids + [ids[g] for g in good.tolist()]
                    order = sorted(range(len(every)), key=lambda i: (-every[i], names[i] is None, names[i] or 0))[:top]
                    held[item] = [every[i] for i in order], [names[i] for i in order]
                    if len(order) == top:
                        worst[item] = every[order[-1]]
        rows = [(item, name, score) for item, (scores, names) in enumerate(held) for score, name in zip(scores, names)]
        kinds = pa.int32(), pa.int64(), pa.int64()
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    bounded = T.StructType([*segments.schema.fields, T.StructField("bound", T.DoubleType())])
    ordered = segments.mapInArrow(bounds, bounded).sortWithinPartitions(F.desc("bound")).drop("bound")
    return ordered.mapInArrow(visit, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of each item, score above 0.

    docs: doc_id, text; items: item_id, text. Equal scores rank by doc_id, a null id last.
    Null and empty texts have no terms: such a document is never found and such an item
    finds nothing. Every row of items is a search of its own, every row of docs a document,
    so repeated rows give repeated results. Without documents or items there are no rows.
    """
    spark = prepare(docs.sparkSession)
    name = items.schema["item_id"].dataType
    parts = []
    for block in blocks_of(items):
        found = stored(matches(docs, block.vocabulary), "matches")
        size = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        rows = found.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # one per query term
        weights = block.weights(size[0], {r.t: r["count"] for r in rows})
        best = best_of(stored(index(found, *size), "index"), weights, top)
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        ranked = best.withColumn("rank", place).filter(F.col("rank") <= top)
        schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", name)])
        names = spark.createDataFrame(list(enumerate(block.ids)), schema)
        parts.append(stored(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "hits"))
    if not parts:
        schema = T.StructType([T.StructField("item_id", name)])
        return spark.createDataFrame([], schema).selectExpr(
            "item_id", "CAST(NULL AS INT) AS rank", "CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS BIGINT) AS score"
        )
    return reduce(DataFrame.union, parts)
