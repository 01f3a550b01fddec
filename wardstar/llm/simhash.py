"""SimHash near-duplicates, found by anchor points of a covering code.

A fingerprint of 64 bits is cut into parts, so that two fingerprints at most `bits` apart
differ by at most t bits in some part. The points of a part are covered by a code: a
Hamming code on its first 2^r - 1 positions, anything on the others, so that an anchor lies
within radius 1 of every point. A fingerprint goes to every anchor within 1 + t of it, and
two that differ by t meet at the anchor nearest to one of them. Fingerprints are compared
per anchor on all 64 bits, so the links are exact and whole.

Cost: with (blocks, take) = (3, 1) there are three parts of 21 or 22 bits, t = 1 and some
15 anchors each, and an anchor's group is about 1/9,000 of all different fingerprints. For
more than some 10^8 of them, (5, 2) gives ten parts of 25 or 26 bits, t = 1, some 20 anchors
each, and groups of 1/200,000.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import grouped, id_text, prepare, split_hot, stored, with_key
from wardstar.llm.components import components

WORDS, BITS, SEED = 4, 4, 42
#: Groups at an anchor beyond this are compared in pairs of blocks.
GROUP_ROWS = 16_384


def fingerprint(raw: bytes, words: int = WORDS) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text; without words it is zero."""
    found = raw.lower().split()  # on bytes, both mean ASCII
    if not found:
        return 0
    line = b" ".join(found)
    n = max(1, len(found) - words + 1)
    if n == 1:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(line[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())), np.uint64, n
        )
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        octets = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) for every row; a null text has no words."""

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            fps = pa.array([fingerprint(t or b"", words) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def parts(blocks: int, take: int, bits: int = BITS) -> list[tuple[list[int], int]]:
    """Bit positions of each part, and by how many bits its best case may differ.

    Each block is in the same share of the parts, so the least number of differing bits
    over the parts is at most the mean, bits * take / blocks.
    """
    cut = [list(range(64 * i // blocks, 64 * (i + 1) // blocks)) for i in range(blocks)]
    return [(sum(chosen, []), bits * take // blocks) for chosen in combinations(cut, take)]


def anchor_masks(positions: list[int], t: int) -> tuple[list[int], list[list[int]]]:
    """Parity masks of the part's code, and for each syndrome the flips that lead to anchors.

    The flips of syndrome s are all sets of at most 1 + t positions whose code positions
    have syndrome s: applied to a point with that syndrome, they give a code word.
    """
    r = (len(positions) + 1).bit_length() - 1
    coded, free = positions[: 2**r - 1], positions[2**r - 1 :]
    checks = [sum(1 << p for i, p in enumerate(coded, 1) if i >> b & 1) for b in range(r)]
    flips: list[list[int]] = [[] for _ in range(2**r)]
    for n in range(2 + t):
        for chosen in combinations(range(1, len(coded) + 1), n):
            syndrome, mask = 0, 0
            for i in chosen:
                syndrome, mask = syndrome ^ i, mask | 1 << coded[i - 1]
            for more in range(2 + t - n):
                for extra in combinations(free, more):
                    flips[syndrome].append(mask | sum(1 << p for p in extra))
    return checks, flips


def _anchors(fp: Column, part: int, positions: list[int], t: int) -> Column:
    checks, flips = anchor_masks(positions, t)
    syndrome = F.lit(0)
    for b, check in enumerate(checks):
        syndrome = syndrome + F.bit_count(fp.bitwiseAND(F.lit(_signed(check)))) % 2 * (1 << b)
    table = F.array(*[F.array(*[F.lit(_signed(m)).cast("long") for m in masks]) for masks in flips])
    own = fp.bitwiseAND(F.lit(_signed(sum(1 << p for p in positions))))
    return F.transform(
        F.element_at(table, (syndrome + 1).cast("int")),
        lambda flip: F.struct(F.lit(part).alias("part"), own.bitwiseXOR(flip).alias("anchor")),
    )


def _forest(x: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect what is connected within a group: at most one fewer than its members."""
    links: list[tuple[int, int]] = []
    if len(x) <= 256 and (np.bitwise_count(x[:, None] ^ x) <= bits).sum() == len(x):
        return links
    left = x
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue[-1]) <= bits
            p = queue.pop()
            if near.any():
                found = left[near]
                left = left[~near]
                links += [(p, q) for q in found]
                queue.extend(found)
    return links


def links(fps: DataFrame, bits: int = BITS, blocks: int = 3, take: int = 1, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links of at most `bits` bits that connect all that such links connect.

    fps: one column `fp` of different fingerprints. Of a group at an anchor only a
    spanning forest is given, so a large group of near copies never becomes all its pairs.
    """
    spread = F.concat(*[_anchors(F.col("fp"), i, p, t) for i, (p, t) in enumerate(parts(blocks, take, bits))])
    rows = fps.select("fp", F.explode(spread).alias("at")).select("at.part", "at.anchor", "fp")
    rows = split_hot(rows, ["part", "anchor"], "fp", group_rows).select("part", "anchor", "pair", "fp")

    def run(batches):
        for group in grouped(batches, 3):
            if group.num_rows < 2:
                continue
            found = _forest(group.column(3).to_numpy().astype(np.int64).view(np.uint64), bits)
            if found:
                ends = np.array(found, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    keys = ["part", "anchor", "pair"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS, blocks: int = 3, take: int = 1) -> DataFrame:
    """(doc_id, text_hash, fp, label, component_id) for every row of docs.

    component_id is the smallest doc_id reachable over links, label a number of the
    component. Equal fingerprints are linked; so are all texts without words (null and
    empty ones too). A null doc_id is linked but never the smallest; a component of null
    ids only has a null component_id. Repeated rows stay. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    marked = stored(fingerprints(docs, words), "fingerprints")
    per_fp = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp")
    labels = components(links(per_fp.select("fp"), bits, blocks, take))
    named = per_fp.join(labels, per_fp["fp"] == labels["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("label")
    )
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    ids = named.join(least, "label").select("fp", "label", "component_id")
    return marked.join(ids, "fp").select("doc_id", "text_hash", "fp", "label", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each component: that of its smallest doc_id, with all columns of docs.

    Ties (one id in several rows of a component) go to the smallest hash of the text;
    rows equal in both are one row. If a component has null ids only, one of them stays.
    """
    found = near_duplicates(docs, **options)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    chosen = found.groupBy("label").agg(F.min(order).alias("best")).select("best.*")
    marked, key = with_key(docs)
    chosen = chosen.select(id_text("doc_id").alias(key[0]), F.col("text_hash").alias(key[1]))
    return marked.join(chosen, key).dropDuplicates(key).select(*docs.columns)
