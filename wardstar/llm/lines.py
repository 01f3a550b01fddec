"""Line deduplication by overlapping windows of three lines.

Every run of three neighbouring lines is hashed. A window that occurs more than once in the
corpus is kept where it occurs first, by (doc_id, hash of the text, position); the lines
that its later occurrences cover are removed, overlapping windows being merged. A removed
line equals a line of an earlier window, which is kept or equals a still earlier one, so
nothing vanishes from the corpus altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import let, prepare, stored, with_key

WINDOW = 3


def _windows(lines: Column) -> Column:
    """(pos, h1, h2) of every window with a line that isn't blank; 128 bits of hash."""

    def hashed(trimmed: Column) -> Column:
        def window(i: Column) -> Column:
            three = [F.get(trimmed, i + k) for k in range(WINDOW)]
            blank = F.concat(*three) == ""
            pair = F.struct(i.alias("pos"), F.xxhash64(*three).alias("h1"), F.xxhash64(F.lit(1), *three).alias("h2"))
            return F.when(~blank, pair)

        at = F.sequence(F.lit(0), F.size(trimmed) - WINDOW)
        return F.filter(F.transform(at, window), lambda w: w.isNotNull())

    none = F.array().cast("array<struct<pos:int,h1:bigint,h2:bigint>>")
    return F.when(F.size(lines) >= WINDOW, let(F.transform(lines, lambda x: F.trim(x)), hashed)).otherwise(none)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, text) of every row, text without the removed lines.

    Lines end at newlines and are compared without spaces at their ends; windows of blank
    lines don't count, nor do texts of fewer than three lines. Rows equal in id and text
    are one document and get one result, as often as they occur. A null text has no lines
    and stays null; a null id comes after all others. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    keyed, key = with_key(docs.select(F.col("doc_id").cast("long"), "text"))
    lines = F.split("text", "\n")
    place = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", F.col(key[1]).alias("hash"), "w.pos")
    windows = (
        keyed.filter(F.col("text").isNotNull())
        .select("doc_id", *key, F.explode(_windows(lines)).alias("w"))
        .select("w.h1", "w.h2", *key, "w.pos", place.alias("place"))
    )
    windows = stored(windows, "windows")
    first = windows.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = windows.join(first.drop("n"), ["h1", "h2"]).filter("place > first")
    covered = later.groupBy(*key).agg(F.collect_set("pos").alias("starts"))

    removed = F.flatten(F.transform("starts", lambda p: F.array(*[p + k for k in range(WINDOW)])))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    shortened = let(lines, lambda all_lines: F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n"))
    hit = F.col("starts").isNotNull()
    return keyed.join(covered, key, "left").select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(hit, F.size(F.array_distinct(removed))).otherwise(0).cast("long").alias("n_removed"),
        F.when(hit, shortened).otherwise(F.col("text")).alias("text"),
    )
