"""Language identification by rank-order profiles of character n-grams.

A profile lists the `profile` most frequent n-grams (1 to 3 letters, words padded with a
space) of a language, most frequent first; ties go to the smaller n-gram. A document is
ranked the same way, and its out-of-place distance to a language is the sum, over its
n-grams, of how far their places differ, or `profile` where the language lacks one.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstar.llm.common import fold, id_text, prepare, smallest_hashes, stored

FOLDS = 5
#: The classifier is fitted on at most so many labelled documents of a language ...
SAMPLE_DOCS = 2_000
#: ... and at most so many languages, the most frequent ones; places in a profile.
LANGUAGES, PROFILE = 1_000, 300
#: A document that shares less than this with every profile is in no learned language.
REJECT_BELOW = 0.05
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = 1 << 21  # above every code point


def _codes(text: str | None) -> np.ndarray | None:
    """Code points of the words in small letters, one space around each; None without a letter."""
    found = _LETTERS.findall(text.lower()) if text else []
    line = f" {' '.join(found)} "
    if not any(map(str.isalpha, line)):
        return None
    return np.frombuffer(line.encode("utf-32-le"), dtype="<u4").astype(np.int64)


def _grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of 1 to 3 characters as numbers, and how often each occurs."""
    two = codes[:-1] * _BASE + codes[1:]
    three = two[:-1] * _BASE + codes[2:]
    inside = codes[1:-1] != 32  # no n-gram across two words
    one = codes[codes != 32]
    found = np.concatenate([one, two, three[inside]])
    found.sort()
    first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
    return found[first], np.diff(np.append(first, len(found)))


def _ranked(grams: np.ndarray, counts: np.ndarray, places: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first."""
    return grams[np.lexsort((grams, -counts))[:places]]


def training_rows(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, text) of the documents to learn from: a bounded sample of each language.

    Held-out rows, null languages and null texts are left out. The sample takes the
    smallest hashes of the ids, so it is the same however the table is stored.
    """
    allowed = docs.filter((fold("doc_id", FOLDS) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = allowed.select(F.col("lang").alias("language"), id_text("doc_id").alias("id")).distinct()
    frequent = ids.groupBy("language").count().orderBy(F.desc("count"), "language").limit(LANGUAGES)
    chosen = smallest_hashes(ids.join(frequent.select("language"), "language", "left_semi"), "language", "id", sample_docs)
    texts = allowed.select(F.col("lang").alias("language"), id_text("doc_id").alias("id"), "text")
    # Written first, its size is known: broadcast if small, so that no text is shuffled.
    return texts.join(stored(chosen, "sample"), ["language", "id"], "left_semi").select("language", "text")


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, places: int = PROFILE) -> dict[str, np.ndarray]:
    """The profile of each language: at most LANGUAGES * places numbers reach the driver."""

    def count(batches):
        for batch in batches:
            sums: dict[str, list[np.ndarray]] = {}
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = _codes(text)
                if codes is not None:
                    sums.setdefault(language, []).append(codes)
            for language, found in sums.items():
                grams, counts = _grams(np.concatenate(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(grams)), pa.array(grams), pa.array(counts.astype(np.int64))],
                    ["language", "gram", "n"],
                )

    rows = training_rows(docs, sample_docs).mapInArrow(count, "language string, gram long, n long")
    totals = rows.groupBy("language", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "gram"))
    top = totals.withColumn("place", place).filter(F.col("place") <= places)
    profiles: dict[str, list[int]] = {}
    for row in top.select("language", "gram", "place").orderBy("language", "place").collect():
        profiles.setdefault(row.language, []).append(row.gram)
    return {language: np.array(grams, dtype=np.int64) for language, grams in profiles.items()}


def judge(profiles: dict[str, np.ndarray], places: int = PROFILE) -> Callable[[str | None], tuple[str, float]]:
    """A function that gives the language and the score of a text.

    The score is 1 - distance / largest possible distance of the nearest language; of
    equally near ones the first in the alphabet wins. A null text, one without a letter,
    and every text if there is no profile: `und` with score 0.
    """
    languages = sorted(profiles)
    known = np.unique(np.concatenate([np.array([-1], dtype=np.int64), *profiles.values()]))
    ranks = np.full((len(known), len(languages)), -1, dtype=np.int32)
    for k, language in enumerate(languages):
        ranks[np.searchsorted(known, profiles[language]), k] = np.arange(len(profiles[language]))

    def run(text: str | None) -> tuple[str, float]:
        codes = _codes(text) if languages else None
        if codes is None:
            return UNKNOWN, 0.0
        grams = _ranked(*_grams(codes), places)
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        theirs = np.where((known[at] == grams)[:, None], ranks[at], -1)
        own = np.arange(len(grams), dtype=np.int32)[:, None]
        distance = np.where(theirs < 0, places, np.abs(theirs - own)).sum(axis=0)
        best = int(distance.argmin())
        return languages[best], 1.0 - float(distance[best]) / (places * len(grams))

    return run


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, places: int = PROFILE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of docs (doc_id, text, lang).

    An empty table gives no rows; repeated rows are each classified; a null id counts as
    held out; other columns are ignored. See judge() for null texts and ties.
    """
    prepare(docs.sparkSession)
    verdict = judge(learn(docs, sample_docs, places), places)

    def run(batches):
        for batch in batches:
            found = [verdict(t) for t in batch.column(2).to_pylist()]
            language, score = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            columns = [batch.column(0), batch.column(1), language, score]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), (fold("doc_id", FOLDS) == 0).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, least: float = REJECT_BELOW, **options) -> DataFrame:
    """The rows of docs, all columns, that are in a learned language.

    Rejected are null texts, texts without a letter and those that score below `least`.
    If no row has a language, nothing is learned and every row is rejected as unknown.
    """
    prepare(docs.sparkSession)
    verdict = judge(learn(docs, **options), options.get("places", PROFILE))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            found = [verdict(t) for t in texts]
            yield batch.filter(pa.array([f[0] != UNKNOWN and f[1] >= least for f in found], pa.bool_()))

    text = next(c for c in docs.columns if c.lower() == "text")
    return docs.mapInArrow(run, docs.schema)
