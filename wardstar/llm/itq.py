"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation of the principal components is learned on a bounded sample so that the signs of
the rotated coordinates lose little and are balanced (iterative quantisation); they are a
vector's 64-bit code. Every vector is indexed: the code is cut into `TABLES` substrings,
and in each table a vector is at home under its own substring and visits the substrings
that differ in one bit. Of a home and a visitor, or two homes, that meet under a substring
the whole codes are compared; only what is near by its code gets its vector attached and
is reranked by the cosine of the original vectors, so vectors aren't sent to every table.

A pair whose codes differ by at most 2 * TABLES - 1 = 7 bits is always met; one that
differs by more may be. Where vectors share no direction, a bit differs at cosine 0.95 with
probability 0.1, which gives recall 0.94 there, and more above. Where they share one, codes
of centred vectors lie further apart. So each sampled vector gets partners at exactly the
threshold, and codes from further rotations, with tables of their own, are added until
`RECALL` of those pairs meet. If `CODES` codes don't suffice, all vectors of that length are
compared in pairs of blocks, which misses nothing and is quadratic. So is a length that the
sample lacks.

A pair may meet under several substrings. It counts where it meets first: in the first
table in which it can meet, and of the two substrings there under the smaller one. So
links are counted once without ever listing a group's pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import grouped, prepare, split_hot, stored
from wardstar.llm.components import components

COSINE = 0.95
BITS, TABLES = 64, 4
#: Codes that differ by more bits are not reranked. At cosine 0.95 some 6.5 differ, more than
#: 16 once in 10,000 pairs; of unrelated vectors 32 do, 16 or fewer once in 25,000 pairs.
#: That is the least radius a code, widened to hold 999 of 1,000 sampled pairs at the threshold.
RADIUS = 16
#: Share of sampled pairs at the threshold that must meet, and the most codes tried for it.
RECALL, CODES = 0.93, 16
#: Sampled vectors that get partners at the threshold.
PAIRED = 4_000
#: The rotation is fitted on at most so many vectors; every vector is indexed.
SAMPLE_VECTORS, ITERATIONS = 10_000, 50
#: Groups under a substring beyond this are compared in pairs of blocks.
GROUP_ROWS = 2_048
_WIDTH = BITS // TABLES
_GROUP = ["length", "table", "key", "pair"]
_MEETING = [*_GROUP, "own", "home", "node", "code"]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles, scaled to length 1."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(x: np.ndarray, bits: int = BITS, iterations: int = ITERATIONS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projection of the code, from unit vectors in rows.

    Vectors with fewer coordinates than bits get further bits from fixed random directions.
    Another seed learns from another first rotation and gives another code.
    """
    rng = np.random.default_rng(seed)
    centre = x.mean(axis=0)
    own = min(bits, x.shape[1])
    _, _, axes = np.linalg.svd(np.cov((x - centre).T, ddof=0).reshape(x.shape[1], -1))
    v = (x - centre) @ axes[:own].T
    rotation = np.linalg.qr(rng.standard_normal((own, own)))[0]
    for _ in range(iterations):
        signs = np.where(v @ rotation >= 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(v.T @ signs)
        rotation = u @ w
    extra = rng.standard_normal((x.shape[1], bits - own))
    return centre, np.hstack([axes[:own].T @ rotation, extra])


def encode(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The codes of each row, one column per 64 columns of the model's projection."""
    signs = (x - model[0]) @ model[1] >= 0
    return np.packbits(signs, axis=1, bitorder="little").view("<i8")


def at_threshold(x: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors at the cosine: rows of x, turned towards other rows and at random."""
    x = x[:PAIRED]
    rng = np.random.default_rng(11)
    pairs = []
    for towards in (np.roll(x, 1, axis=0), rng.standard_normal(x.shape)):
        side = towards - (towards * x).sum(axis=1, keepdims=True) * x
        length = np.linalg.norm(side, axis=1, keepdims=True)
        usable = length[:, 0] > 1e-6
        turned = cosine * x[usable] + np.sqrt(1 - cosine**2) * side[usable] / length[usable]
        pairs.append((x[usable], turned))
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def plan(x: np.ndarray, cosine: float) -> tuple[tuple[np.ndarray, np.ndarray] | None, int]:
    """Centre and projections of as many codes as make sampled pairs meet, and the radius.

    The model is None where CODES codes are too few: then all pairs must be compared.
    """
    a, b = at_threshold(x, cosine)
    projections: list[np.ndarray] = []
    met, apart = np.zeros(len(a), dtype=bool), np.zeros(len(a), dtype=int)
    for k in range(CODES):
        centre, projection = fit(x, seed=7 + k)
        projections.append(projection)
        differ = (encode(a, (centre, projection)) ^ encode(b, (centre, projection))).view(np.uint64)
        apart += np.bitwise_count(differ[:, 0])
        met |= (np.bitwise_count(_substrings(differ)) <= 1).any(axis=0)
        # Nothing to pair: vectors of one coordinate.
        if not len(a) or met.mean() >= RECALL:
            widest = int(np.ceil(np.quantile(apart, 0.999))) if len(a) else 0
            return (centre, np.hstack(projections)), max(RADIUS * (k + 1), widest)
    return None, 0


def _vectors(rows: DataFrame) -> DataFrame:
    """vec_id, embedding, a 128-bit hash of it and whether it can link with anything."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = x.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(x, lambda v: v != 0)
    return rows.select(
        F.col("vec_id").cast("long"),
        "embedding",
        F.xxhash64("embedding").alias("h1"),
        F.xxhash64(F.lit(1), "embedding").alias("h2"),
        F.coalesce(usable, F.lit(False)).alias("usable"),
    )


def _indexed(nodes: DataFrame, cosine: float) -> tuple[DataFrame, dict[int, int]]:
    """Add each different vector's codes, from rotations fitted per vector length; and the radii.

    A vector has no code where all pairs of its length are compared.
    """
    sample = nodes.orderBy("h1", "h2").limit(SAMPLE_VECTORS).select("embedding").toArrow()
    by_length: dict[int, list] = {}
    for x in sample.column(0).to_pylist():
        by_length.setdefault(len(x), []).append(x)
    plans = {d: plan(_matrix(pa.array(xs, pa.list_(pa.float64()))), cosine) for d, xs in by_length.items()}
    models = {d: model for d, (model, _) in plans.items() if model is not None}

    def run(batches):
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("embedding"))
            sizes = vectors.value_lengths().to_numpy()
            codes: list = [[]] * batch.num_rows
            for d in np.unique(sizes):
                if int(d) in models:
                    at = np.flatnonzero(sizes == d)
                    for i, code in zip(at, encode(_matrix(vectors.take(pa.array(at))), models[int(d)])):
                        codes[i] = code
            yield batch.append_column("code", pa.array(codes, pa.list_(pa.int64())))

    kind = dict(nodes.dtypes)["embedding"]
    indexed = nodes.select("node", "copies", "embedding").mapInArrow(
        run, f"node long, copies long, embedding {kind}, code array<long>"
    )
    return indexed, {d: radius for d, (_, radius) in plans.items()}


def _meetings(indexed: DataFrame, group_rows: int) -> DataFrame:
    """A row for each substring that a vector is at home under or visits, with its codes only.

    Vectors without a code are all at home under one key.
    """
    n, tables = _WIDTH + 1, F.size("code") * TABLES
    at = F.explode(F.sequence(F.lit(0), F.greatest(tables * n, F.lit(1)) - 1)).alias("at")
    rows = indexed.select("node", "code", F.size("embedding").alias("length"), at)
    rows = rows.withColumns({"table": F.expr(f"cast(at div {n} as int)"), "flip": F.expr(f"cast(at % {n} as int)")})
    flipped = F.when(F.col("flip") == 0, F.lit(0)).otherwise(F.expr("shiftleft(1, flip - 1)"))
    whole = f"get(code, cast(table div {TABLES} as int))"
    sub = F.expr(f"cast(shiftrightunsigned({whole}, (table % {TABLES}) * {_WIDTH}) & {(1 << _WIDTH) - 1} as int)")
    key = F.coalesce(sub.bitwiseXOR(flipped), F.lit(0)).alias("key")
    rows = rows.select("length", "table", key, (F.col("flip") == 0).alias("home"), "node", "code")
    return split_hot(rows, _GROUP[:3], "node", group_rows).select(*_MEETING)


def _substrings(codes: np.ndarray) -> np.ndarray:
    """One row per table, from one column per code."""
    shifts = [np.uint64(t * _WIDTH) for t in range(TABLES)]
    return np.stack([codes[:, k] >> t & np.uint64((1 << _WIDTH) - 1) for k in range(codes.shape[1]) for t in shifts])


def _met(group: pa.Table, radii: dict[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some homes at a time: the rows of the group whose meeting with them counts here."""
    home = group.column("home").to_numpy()
    homes = np.flatnonzero(home)
    if group.num_rows < 2 or not len(homes):
        return
    table, own = group.column("table")[0].as_py(), group.column("own").to_numpy()
    flat = group.column("code").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    codes = flat.astype(np.int64).view(np.uint64).reshape(len(home), -1)
    order, split, n_codes = np.arange(len(home)), own.min() != own.max(), codes.shape[1]
    subs = _substrings(codes) if n_codes else None
    radius = radii.get(group.column("length")[0].as_py(), 0)
    for begin in range(0, len(homes), 256):
        h = homes[begin : begin + 256]
        # Two homes once; a home and a visitor under the smaller of their substrings.
        ok = order > h[:, None]
        if n_codes:
            ok = np.where(home, ok, subs[table][h][:, None] < subs[table])
            apart = np.zeros(ok.shape, dtype=np.uint16)
            for k in range(n_codes):
                apart += np.bitwise_count(codes[h, k][:, None] ^ codes[:, k])
            ok &= apart <= radius
        if split:
            ok &= own[h][:, None] != own
        for before in range(table):
            if not ok.any():
                break
            ok &= np.bitwise_count(subs[before][h][:, None] ^ subs[before]) > 1
        if ok.any():
            yield h, ok


def _candidates(meetings: DataFrame, radii: dict[int, int]) -> DataFrame:
    """The meetings in which a vector's code is near another's."""

    def run(batches):
        for group in grouped(batches, len(_GROUP)):
            near = np.zeros(group.num_rows, dtype=bool)
            for h, ok in _met(group, radii):
                near[h] |= ok.any(axis=1)
                near |= ok.any(axis=0)
            if near.any():
                yield from group.filter(pa.array(near)).to_batches()

    rows = meetings.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return rows.mapInArrow(run, meetings.schema)


def _compared(group: pa.Table, cosine: float, radii: dict[int, int]) -> pa.RecordBatch | None:
    """Links counted in one group: weighted counts per node, and links that connect its nodes."""
    node, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
    x = _matrix(group.column("embedding").combine_chunks())
    n_links, label = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
    for h, ok in _met(group, radii):
        ok &= x[h] @ x.T >= cosine
        n_links[h] += ok @ copies
        n_links += copies[h] @ ok
        for i in np.flatnonzero(ok.any(axis=1)):
            joined = np.unique(label[np.append(np.flatnonzero(ok[i]), h[i])])
            if len(joined) > 1:
                label[np.isin(label, joined)] = joined[0]
    found = np.flatnonzero(n_links)
    if not len(found):
        return None
    columns = [pa.array(node[found]), pa.array(node[label[found]]), pa.array(n_links[found])]
    return pa.RecordBatch.from_arrays(columns, ["node", "other", "n"])


def near_duplicates(rows: DataFrame, cosine: float = COSINE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vec_id and embedding.

    Equal vectors are one node while links are sought and count as often as they occur.
    Vectors that are null, empty, zero or hold null or non-finite components, and vectors
    of different lengths, link with nothing. component_id is the smallest vec_id
    reachable, the row's own if it has no link; null ids are linked but never the
    smallest. kept is true where it equals vec_id, and for a null id without a link. An empty
    table gives no rows.
    """
    prepare(rows.sparkSession)
    vectors = _vectors(rows)
    nodes = (
        vectors.filter("usable")
        .groupBy("h1", "h2")
        .agg(F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    )
    # Numbers given here are final once the table is written.
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    indexed, radii = _indexed(nodes, cosine)
    indexed = stored(indexed, "codes")

    def run(batches):
        for group in grouped(batches, len(_GROUP)):
            found = _compared(group, cosine, radii)
            if found is not None:
                yield found

    near = stored(_candidates(_meetings(indexed, group_rows), radii), "near_codes")
    vectors_of = indexed.select("node", "copies", "embedding")
    near = near.join(vectors_of, "node").select(*_MEETING, "copies", "embedding")
    near = near.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    links = stored(near.mapInArrow(run, "node long, other long, n long"), "vector_links")
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    labels = components(links.select("node", "other")).withColumnRenamed("component", "label")
    named = (
        nodes.select("node", "h1", "h2", "copies", "first")
        .join(counts, "node", "left")
        .join(labels, "node", "left")
        .select("h1", "h2", "copies", "first", "n", F.coalesce("label", "node").alias("label"))
    )
    least = named.groupBy("label").agg(F.min("first").alias("least"))
    named = named.join(least, "label").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "least", F.lit(True).alias("usable")
    )
    ids = vectors.select("vec_id", "h1", "h2", "usable").join(named, ["h1", "h2", "usable"], "left")
    component = F.when(F.col("usable"), F.col("least")).otherwise(F.col("vec_id"))
    return ids.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.when(component.isNull(), F.coalesce("n_links", F.lit(0)) == 0)
        .otherwise(F.coalesce(component == F.col("vec_id"), F.lit(False)))
        .alias("kept"),
    )
