"""Mixing sources to target weights by a Pfair schedule.

Each source's documents form blocks. With weight w, block i of a source may start at
i / w (rounded down) and is due at (i + 1) / w (rounded up), counted in blocks of the whole
mix. Giving every place to the released block that is due first keeps each source within
less than one block of its share at any point.

Weights are whole numbers n of places in 2^40, so a weight is exact for any mix that fits a
table. The schedule is walked block by block, once, by a task that holds one block of each
source and writes the places as a table; the documents, numbered within their sources by
Spark, are joined to it by source and block.

When a source has no block left, the others go on in a new phase, with their weights in the
same proportion. The places from a phase's start to its end hold the guarantee.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstar.llm.common import fresh, id_text, prepare, stored

BLOCK_ROWS = 32
#: A weight is kept to within sources / PLACES.
PLACES = 1 << 40
#: Blocks the walk hands over at a time.
PLAN_ROWS = 65_536
#: Without given weights a source's is its number of rows to this power.
POWER = 0.5
#: Documents of a source are numbered in so many independent groups.
GROUPS = 1_024


def apportioned(weights: dict[str, float], places: int = PLACES) -> dict[str, int]:
    """Whole places, one at least, in proportion to the weights (largest remainders)."""
    total = math.fsum(weights.values())
    exact = {s: w / total * places for s, w in weights.items()}
    given = {s: max(1, int(x)) for s, x in exact.items()}
    spare = places - sum(given.values())
    if spare >= 0:
        for s in sorted(weights, key=lambda s: (given[s] - exact[s], s))[:spare]:
            given[s] += 1
    while (spare := places - sum(given.values())) != 0:  # what the least places took, or rounding left
        s = max(weights, key=lambda s: (given[s], s))
        given[s] += spare if spare > 0 else -min(-spare, max(1, given[s] // 2))
    return given


def frame(given: dict[str, int]) -> dict[str, list[int]]:
    """The places of each source's blocks in one frame: earliest deadline first."""
    places = sum(given.values())
    released: dict[int, list[tuple[int, str]]] = {}
    for s, n in given.items():
        for i in range(n):
            released.setdefault(i * places // n, []).append((-(-(i + 1) * places // n), s))
    ready: list[tuple[int, str]] = []
    result: dict[str, list[int]] = {s: [] for s in given}
    for at in range(places):
        for block in released.get(at, []):
            heapq.heappush(ready, block)
        result[heapq.heappop(ready)[1]].append(at)
    return result


def walk(blocks: dict[str, int], weights: dict[str, float], places: int = PLACES) -> Iterator[tuple]:
    """(source, block, phase, place, release, deadline, phase's start) by place: the released block due first runs."""
    left, done = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0)
    start = at = phase = 0
    while left:
        given = apportioned({s: weights[s] for s in left}, places)
        run = dict.fromkeys(left, 0)
        ready = [(-(-places // n), s) for s, n in given.items()]
        heapq.heapify(ready)
        later: list[tuple[int, int, str]] = []
        while len(left) == len(run):
            while later and later[0][0] <= at - start:
                heapq.heappush(ready, heapq.heappop(later)[1:])
            due, s = heapq.heappop(ready)
            yield s, done[s], phase, at, start + run[s] * places // given[s], start + due, start
            at, done[s], run[s], left[s] = at + 1, done[s] + 1, run[s] + 1, left[s] - 1
            if not left[s]:
                del left[s]
            heapq.heappush(later, (run[s] * places // given[s], -(-(run[s] + 1) * places // given[s]), s))
        start, phase = at, phase + 1


def phases(blocks: dict[str, int], weights: dict[str, float], places: int = PLACES) -> list[tuple]:
    """(source, phase, first block, end block, start, places, places of its blocks) for all phases."""
    plan: dict[tuple[str, int], list] = {}
    for s, block, phase, at, _, _, start in walk(blocks, weights, places):
        plan.setdefault((s, phase), [block, start, []])[2].append(at - start)
    return [(s, k, first, first + len(at), start, places, at) for (s, k), (first, start, at) in plan.items()]


def _plan(spark: SparkSession, blocks: dict[str, int], share: dict[str, float], places: int) -> DataFrame:
    """(s, b, phase, release, deadline, at, share) of every block, written by one task as it walks."""
    schema = pa.schema(
        [("s", pa.string()), *[(n, pa.int64()) for n in ("b", "phase", "at", "release", "deadline")], ("share", pa.float64())]
    )

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows: list[tuple] = []
            for row in walk(blocks, share, places):
                rows.append((*row[:6], share[row[0]]))
                if len(rows) == PLAN_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    one = spark.range(1, numPartitions=1)
    types = "s string, b long, phase long, at long, release long, deadline long, share double"
    return stored(one.mapInArrow(run, types).withColumn("phase", F.col("phase").cast("int")), "mixing_plan")


def positions(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    places: int = PLACES,
    sources: int | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """Add the columns of a place in the mix; returns their names too.

    weights: of sources by name; sources without one get the least. A null source is a
    source of its own. sources: if given, only so many, the largest, are scheduled on their
    own; the others share one schedule with the sum of their weights. Within a source, order follows the hash of the id; rows with one
    id are in the order of their texts' hashes if docs has a text.
    """
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    new = ("mix_source", "group", "hash", "number", "weight", "phase", "block", "release", "deadline", "place", "position")
    names = {n: fresh(n, docs) for n in new}
    name = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))  # no name is empty
    own = {r["name"]: r["count"] for r in docs.select(name.alias("name")).groupBy("name").count().collect()}
    target, pooled, pool = _weights(own, weights), set(), "~"  # no name either
    if sources is not None and len(own) > sources:
        pooled = set(sorted(own, key=lambda s: (-own[s], s))[sources - 1 :])
    if pooled:
        known = F.array(*[F.lit(s) for s in sorted(set(own) - pooled)]).cast("array<string>")
        name = F.when(F.array_contains(known, name), name).otherwise(F.lit(pool))
    rows, share = {}, {}
    for s, n in own.items():
        s, w = (pool if s in pooled else s), target[s]
        rows[s], share[s] = rows.get(s, 0) + n, share.get(s, 0.0) + w
    marked = docs.withColumns({names["mix_source"]: name, names["hash"]: F.xxhash64(id_text("doc_id"))}).withColumn(
        names["group"], F.pmod(F.col(names["hash"]), F.lit(GROUPS)).cast("int")
    )
    source, group = names["mix_source"], names["group"]

    counts = marked.groupBy(F.col(source).alias("s"), F.col(group).alias("g")).count()
    before = F.sum("count").over(Window.partitionBy("s").orderBy("g")) - F.col("count")
    offsets = counts.select("s", "g", before.alias("before"))
    plan = _plan(spark, {s: -(-n // block_rows) for s, n in rows.items()}, share, places)

    order = [names["hash"], "doc_id", *[F.xxhash64(c) for c in docs.columns if c.lower() == "text"]]
    numbered = marked.withColumn(names["number"], F.row_number().over(Window.partitionBy(source, group).orderBy(*order)))
    numbered = numbered.join(offsets, (F.col(source) == F.col("s")) & (F.col(group) == F.col("g"))).drop("s", "g")
    numbered = numbered.withColumn(names["number"], F.col(names["number"]) + F.col("before") - 1)
    block = F.floor(F.col(names["number"]) / block_rows)
    placed = numbered.join(plan, (F.col(source) == F.col("s")) & (block == F.col("b")))
    columns = {
        "mix_source": F.col(source),
        "weight": F.col("share"),
        "phase": plan["phase"],
        "block": plan["b"],
        "release": plan["release"],
        "deadline": plan["deadline"],
        "place": plan["at"],
        "position": plan["at"] * block_rows + F.col(names["number"]) % block_rows,
    }
    return placed.select(
        *[numbered[c] for c in docs.columns], *[c.alias(names[k]) for k, c in columns.items()]
    ), names


def _weights(rows: dict[str, int], weights: dict[str, float] | None) -> dict[str, float]:
    if weights is None:
        share = {s: n**POWER for s, n in rows.items()}
    else:
        least = min((w for w in weights.values() if w > 0), default=1.0)
        share = {s: max(weights.get(s[1:], least), 0) or least for s in rows}
    total = math.fsum(share.values()) or 1.0
    return {s: w / total for s, w in share.items()}


def mix(docs: DataFrame, weights: dict[str, float] | None = None, **options) -> DataFrame:
    """doc_id, source, weight, phase, block, release, deadline, place and position of every row.

    place counts blocks of the mix and position orders documents: a larger one comes
    later. No row is left out or repeated. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"))
    placed, _ = positions(rows, weights, **options)
    return placed.drop("mix_source")


def in_order(docs: DataFrame, weights: dict[str, float] | None = None, **options) -> DataFrame:
    """The rows of docs, all columns, laid out in the order of the mix."""
    placed, names = positions(docs, weights, **options)
    position = names["position"]
    return placed.repartitionByRange(position).sortWithinPartitions(position).select(*docs.columns)
