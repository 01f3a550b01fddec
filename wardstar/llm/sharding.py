"""Sharding by fixed virtual slots.

Every record is hashed into one of a fixed number of slots, for good. A versioned map says
which shard owns a slot; rebalancing edits the map and never hashes a record anew. The map
is made from the bytes and rows of each slot, a table of SLOTS rows whatever the input, so
it is small enough for the driver and for a broadcast. Given a folder, a run starts from the
newest map stored there and adds a version only if it has to move slots.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstar.llm.common import fresh, prepare, stored, text_or_empty

SHARDS, SLOTS = 40, 8_192
#: Places of an order that are numbered together.
ORDER_ROWS = 1 << 18
#: A stored map stays in use while no shard holds more than this share above the mean.
DRIFT = 0.02
#: Bytes a record takes besides its text.
RECORD_BYTES = 16


@dataclass(frozen=True)
class SlotMap:
    """The owner of every slot."""

    version: int
    shards: int
    owner: tuple[int, ...]

    @staticmethod
    def first(shards: int = SHARDS, slots: int = SLOTS) -> SlotMap:
        """Version 0: equal runs of slots."""
        return SlotMap(0, shards, tuple(s * shards // slots for s in range(slots)))

    def loads(self, size: list[int]) -> list[int]:
        total = [0] * self.shards
        for slot, shard in enumerate(self.owner):
            total[shard] += size[slot]
        return total

    def rebalanced(self, size: list[int]) -> SlotMap:
        """The next version, with sizes near equal; slots move off shards above the mean.

        What a shard has above the mean is dealt out, largest slots first, to the least
        loaded shard. Then single moves and swaps between the most and the least loaded
        shard follow as long as they narrow the gap between the two.
        """
        owner, mean = list(self.owner), sum(size) / self.shards
        held: list[list[int]] = [[] for _ in range(self.shards)]
        for slot in sorted(range(len(owner)), key=lambda s: (-size[s], s)):
            held[owner[slot]].append(slot)
        load, loose = [0] * self.shards, []
        for shard, slots in enumerate(held):
            for slot in slots:
                if size[slot] and load[shard] + size[slot] > mean:
                    loose.append(slot)
                else:
                    load[shard] += size[slot]
        least = [(total, shard) for shard, total in enumerate(load)]
        heapq.heapify(least)
        for slot in sorted(loose, key=lambda s: (-size[s], s)):
            total, shard = heapq.heappop(least)
            owner[slot] = shard
            heapq.heappush(least, (total + size[slot], shard))
        _narrow(owner, size, self.shards)
        return SlotMap(self.version + 1, self.shards, tuple(owner))

    def grown(self, size: list[int]) -> SlotMap:
        """The next version, with one more shard: slots move into it and nowhere else."""
        owner, new, shards = list(self.owner), self.shards, self.shards + 1
        load, target = [*self.loads(size), 0], sum(size) / shards
        held: dict[int, list[int]] = {}
        for slot in sorted(range(len(owner)), key=lambda s: (size[s], s)):
            if size[slot]:
                held.setdefault(owner[slot], []).append(slot)
        heaps = [(-load[shard], shard) for shard in held]
        heapq.heapify(heaps)
        while heaps:
            total, shard = heapq.heappop(heaps)
            # The largest slot that still fits; smaller ones of this shard are tried first next time.
            fitting = [s for s in held[shard] if load[new] + size[s] <= target]
            if not fitting or -total <= target:
                continue
            slot = fitting[-1]
            held[shard].remove(slot)
            owner[slot] = new
            load[new] += size[slot]
            heapq.heappush(heaps, (total + size[slot], shard))
        return SlotMap(self.version + 1, shards, tuple(owner))


def _narrow(owner: list[int], size: list[int], shards: int) -> None:
    """Move or swap slots between the most and the least loaded shard while that narrows their gap."""
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    load = [0] * shards
    for slot, shard in enumerate(owner):
        if size[slot]:
            held[shard].append((size[slot], slot))
            load[shard] += size[slot]
    for slots in held:
        slots.sort()
    while True:
        high, low = max(range(shards), key=load.__getitem__), min(range(shards), key=load.__getitem__)
        gap = load[high] - load[low]
        best: tuple[int, tuple, tuple | None] | None = None
        for give in held[high]:
            # Receiving nothing, or the slot that brings the difference nearest to half the gap.
            at = bisect_left(held[low], (give[0] - gap // 2, -1))
            for take in (None, *held[low][max(0, at - 1) : at + 1]):
                moved = give[0] - (take[0] if take else 0)
                if 0 < moved < gap and (best is None or abs(gap - 2 * moved) < best[0]):
                    best = (abs(gap - 2 * moved), give, take)
        if best is None or best[0] >= gap:
            return
        _, give, take = best
        for slot, source, target in ((give, high, low), (take, low, high)):
            if slot:
                held[source].remove(slot)
                held[target].insert(bisect_left(held[target], slot), slot)
                owner[slot[1]] = target
                load[source] -= slot[0]
                load[target] += slot[0]


def save_map(spark: SparkSession, folder: str, slots: SlotMap) -> None:
    """Add a version to a stored map. An existing version is an error: versions never change."""
    rows = [(slot, shard, slots.shards) for slot, shard in enumerate(slots.owner)]
    df = spark.createDataFrame(rows, "slot int, shard int, shards int")
    df.coalesce(1).write.parquet(f"{folder}/version={slots.version}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
    """A stored version, the newest unless one is named."""
    table = spark.read.parquet(folder)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    rows = table.filter(F.col("version") == version).orderBy("slot").collect()  # one row a slot
    return SlotMap(version, rows[0].shards, tuple(r.shard for r in rows))


def _stored_map(spark: SparkSession, folder: str) -> SlotMap | None:
    """The newest stored version, or None before the first."""
    try:
        return load_map(spark, folder)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def next_map(spark: SparkSession, size: list[int], shards: int = SHARDS, folder: str | None = None) -> SlotMap:
    """The map for slots of these sizes: the stored one, edited and stored anew where it must be.

    Without a folder, or before the first run in it, this is version 1, rebalanced from equal
    runs of slots. Later a slot moves only if shards are added or if a shard has drifted too
    far above the mean. Fewer shards or another number of slots than stored is an error.
    """
    old = _stored_map(spark, folder) if folder else None
    if old is None:
        new = SlotMap.first(shards, len(size)).rebalanced(size)
    else:
        if old.shards > shards or len(old.owner) != len(size):
            raise ValueError(f"{folder} holds {old.shards} shards of {len(old.owner)} slots")
        new = old
        while new.shards < shards:
            new = new.grown(size)
        if max(new.loads(size)) > (1 + DRIFT) * sum(size) / shards:
            edited = new.rebalanced(size)
            new = edited if edited.owner != new.owner else new
        # Several edits of one run are one version.
        new = old if new is old else SlotMap(old.version + 1, shards, new.owner)
    if folder and new is not old:
        save_map(spark, folder, new)
    return new


def sized(docs: DataFrame, slots: int = SLOTS) -> tuple[DataFrame, dict[str, str]]:
    """Add size, text_crc32, a hash of the text and the virtual slot; returns their names too.

    The slot comes from the id and the text, so neither null ids nor copies of a text
    gather in one slot. A null text is as long as an empty one.
    """
    names = {n: fresh(n, docs) for n in ("size", "text_crc32", "text_hash", "vslot")}
    text = text_or_empty()
    return docs.withColumns(
        {
            names["size"]: F.octet_length(text).cast("long") + RECORD_BYTES,
            names["text_crc32"]: F.crc32(text),
            names["text_hash"]: F.xxhash64("text"),
            names["vslot"]: F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int"),
        }
    ), names


def place(
    rows: DataFrame,
    names: dict[str, str],
    shards: int = SHARDS,
    slots: int = SLOTS,
    order: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Add shard, slot (0, 1, 2, ... within a shard) and map_version to sized rows.

    A row's place in its shard is the number of rows in the shard's earlier virtual slots
    plus its place in its own, so nothing larger than a virtual slot is ever sorted. With
    `order`, a column of different whole numbers, the rows of a shard are numbered by it:
    a place is the number of rows in the shard's earlier runs of ORDER_ROWS numbers plus
    the place in its own.
    """
    spark, vslot = rows.sparkSession, names["vslot"]
    size, count = [0] * slots, [0] * slots
    for at, n_bytes, n in rows.groupBy(vslot).agg(F.sum(names["size"]), F.count("*")).collect():  # one row a slot
        size[at], count[at] = n_bytes, n
    table = next_map(spark, size, shards, folder)
    before, filled = [], [0] * shards
    for at, shard in enumerate(table.owner):
        before.append((at, shard, filled[shard], table.version))
        filled[shard] += count[at]
    owners = spark.createDataFrame(before, "v int, owner int, before long, version int")
    shard, slot, version = (fresh(n, rows) for n in ("shard", "slot", "map_version"))
    if order is not None:
        return _in_order(rows.join(F.broadcast(owners.drop("before")), F.col(vslot) == F.col("v")), order).select(
            *[rows[c] for c in rows.columns],
            F.col("owner").alias(shard),
            F.col("at").alias(slot),
            F.col("version").alias(version),
        )
    within = Window.partitionBy(vslot).orderBy("doc_id", names["text_hash"])
    numbered = rows.withColumn(slot, F.row_number().over(within).cast("long") - 1)
    placed = numbered.join(F.broadcast(owners), F.col(vslot) == F.col("v"))  # `slots` rows
    return placed.select(
        *[numbered[c] for c in rows.columns],
        F.col("owner").alias(shard),
        (numbered[slot] + F.col("before")).alias(slot),
        F.col("version").alias(version),
    )


def _in_order(rows: DataFrame, order: str) -> DataFrame:
    """Add `at`, the place by `order` among the rows of an `owner`."""
    rows = rows.withColumn("run", F.floor(F.col(order) / ORDER_ROWS))
    runs = rows.groupBy(F.col("owner").alias("o"), F.col("run").alias("r")).count()
    before = F.sum("count").over(Window.partitionBy("o").orderBy("r")) - F.col("count")
    runs = stored(runs.select("o", "r", before.alias("before")), "runs")
    within = F.row_number().over(Window.partitionBy("owner", "run").orderBy(order)).cast("long") - 1
    numbered = rows.withColumn("within", within)
    placed = numbered.join(runs, (F.col("owner") == F.col("o")) & (F.col("run") == F.col("r")))
    return placed.withColumn("at", F.col("within") + F.col("before"))


def shards_of(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version of every row.

    The law is `bytes`: the shards' sizes are as near equal as whole slots allow. An empty
    table gives no rows; repeated rows each get a place; a null id is an id like others.
    With a folder for the map, sizes stay within DRIFT above the mean, as far as whole slots
    allow, and rows change shards only when slots are moved in the map.
    """
    prepare(docs.sparkSession)
    rows, names = sized(docs.select(F.col("doc_id").cast("long"), "text"), slots)
    rows = stored(rows.drop("text"), "sized")
    return place(rows, names, shards, slots, folder=folder).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
        "map_version",
    )


def with_shards(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, order: str | None = None) -> DataFrame:
    """docs with size, text_crc32, vslot, shard, slot and map_version added to its columns.

    A new column whose name docs already has gets an underscore. Slots of a shard are in
    the order of the column `order`, which is dropped, if one is given.
    """
    prepare(docs.sparkSession)
    rows, names = sized(docs, slots)
    placed = place(rows, names, shards, slots, order).drop(names["text_hash"])
    return placed if order is None else placed.drop(order)
