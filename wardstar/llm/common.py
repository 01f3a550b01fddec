"""What several operators share: session settings, written intermediate tables, row keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstar.session import COMPRESSION, shared_dir, tune

#: A batch handed to a Python worker ends at so many rows or bytes, whichever comes first.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Run-time settings: adaptive plans with skew splitting, bounded batches for Python.

    Texts and vectors are little smaller in files than in memory, so sizes are taken as they are.
    """
    tune(spark)
    spark.conf.set(COMPRESSION, "1.0")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to a new folder that all executors share, and read it back.

    This cuts the lineage: a lost executor costs at most the tasks since the last
    written table. A folder is never written twice, so a reader is never disturbed.
    """
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever the case of its letters."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: str, parts: int) -> Column:
    """crc32 of an id as text, modulo parts; a null id counts as empty text."""
    return F.crc32(id_text(column)) % parts


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute a value once and use it several times inside one expression."""
    return F.transform(F.array(value), body)[0]


def id_text(column: str) -> Column:
    """An integer id as text; a null id is the empty text, which no integer has."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def with_key(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add two columns that name a row, without nulls: its id as text and its text's hash.

    Rows equal in both are treated alike by the operators that look rows up again.
    """
    key = [fresh("row_id", docs), fresh("row_hash", docs)]
    return docs.withColumns({key[0]: id_text("doc_id"), key[1]: F.xxhash64("text")}), key


def smallest_hashes(ids: DataFrame, group: str, id_column: str, limit: int) -> DataFrame:
    """A sample of at most `limit` ids of each group, by the smallest hashes.

    ids: different pairs of group and id. Groups are counted first, and only ids whose
    hash is in the lowest 2 * limit / count share of all hashes go on, so that about
    2 * limit of a group, and not the whole of it, are ranked. The sample is the same
    however the table is stored.
    """
    sizes = ids.groupBy(group).agg(F.count("*").alias("size"))
    low = F.lit(-(2.0**63)) + F.lit(2.0**64) * F.least(F.lit(1.0), F.lit(2.0 * limit) / F.col("size"))
    hashed = ids.join(sizes, group).withColumn("hash", F.xxhash64(id_column)).filter(F.col("hash") <= low)
    place = F.row_number().over(Window.partitionBy(group).orderBy("hash", id_column))
    return hashed.withColumn("place", place).filter(F.col("place") <= limit).select(group, id_column)


def split_hot(rows: DataFrame, keys: list[str], by: str, limit: int) -> DataFrame:
    """Cut groups of more than `limit` rows into blocks and pair the blocks.

    Adds `pair` and `own`. Rows of a group of b blocks go to the b pairs (i, j) that
    their block is in, so that any two rows of a group meet in a pair, and no pair holds
    much more than 2 * limit rows. Smaller groups are one pair. A row's block comes
    from the hash of its column `by`, so a repeated task deals the same way. The list of
    large groups is written first: Spark then knows its size and broadcasts it only if it
    is small.
    """
    blocks = F.ceil(F.col("count") / limit).cast("int").alias("blocks")
    large = rows.groupBy(*keys).count().filter(F.col("count") > limit).select(*keys, blocks)
    dealt = rows.join(stored(large, "large_groups"), keys, "left").withColumn(
        "own", F.coalesce(F.pmod(F.xxhash64(by, F.lit("block")), F.col("blocks")).cast("int"), F.lit(0))
    )
    mates = F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1)
    pair = F.transform(
        mates,
        lambda j: F.least(F.col("own"), j).cast("long") * (1 << 31) + F.greatest(F.col("own"), j),
    )
    return dealt.withColumn("pair", F.explode(pair)).drop("blocks")


def grouped(batches: Iterable[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Tables of rows with equal values in the first n_keys columns, from sorted batches.

    Holds one group and one batch at a time.
    """
    import numpy as np

    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        change = np.zeros(table.num_rows, dtype=bool)
        for k in range(n_keys):
            key = table.column(k).to_numpy()
            change[1:] |= key[1:] != key[:-1]
        starts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(starts[:-1], starts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(starts[-1])
    if rest is not None:
        yield rest
