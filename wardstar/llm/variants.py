"""Spelling variants of frequent words, found by PartEnum signatures of their letters.

A word's letters with repeats are a binary vector: one dimension per letter and its how
manieth occurrence. Replacing a letter changes two dimensions, inserting or deleting one
changes a single one, so words one edit apart are at Hamming distance two at most.

Signatures: the dimensions are dealt to PARTS parts by hash. Words of one length differ in
at most two parts, so they agree on the parts left after taking out some two; words whose
lengths differ by one agree on what is left after taking out some one. Each enumerated
choice of parts that stay is a signature: exact, no near pair is lost. A word has many
anagrams here, so a signature is narrowed, still exactly, by a half of the word: an edit
lies in the first half or behind it, and the other half stays as it is. Words with equal
signatures are joined and verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import id_text, prepare, stored

MIN_LENGTH, MIN_COUNT = 6, 5
#: A form is at least so many times as frequent as its variant.
FORM_RATIO = 5
#: One run in so many is damaged by a deleted letter before words are counted.
DAMAGE = 199
#: Parts of the dimensions for words of one length, and for lengths that differ by one.
PARTS, INSERT_PARTS = 4, 3
#: A worker hands its counts on when it holds so many words.
HELD_WORDS = 1 << 18

_RUN = re.compile("[a-zÀ-ÿ]+")
# How a row takes part: one of equal length, the shorter or the longer word.
_EQUAL, _SHORT, _LONG = 0, 1, 2


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of enough letters and occurrences in all texts.

    docs: doc_id, text. Runs of letters have A-Z in lower case; of a run with h = crc32 of
    `<doc_id>:<run>` and h mod DAMAGE = 0 the letter at h mod length is deleted. Counts are
    summed per worker before the shuffle, so a frequent word costs one row a task.
    """

    def run(batches):
        held: Counter = Counter()

        def hand_on():
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = (raw or b"").lower().decode()  # on bytes, lower() changes A-Z only
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in Counter(_RUN.findall(text)).items():
                    if len(word) < min_length:
                        continue
                    h = zlib.crc32(word.encode(), start)
                    if h % DAMAGE == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield hand_on()
                    held.clear()
        yield hand_on()

    rows = docs.select(id_text("doc_id").alias("doc_id"), F.col("text").cast("binary"))
    counts = rows.mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing of whole numbers (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _part_sums(code: np.ndarray, owner: np.ndarray, n_words: int, parts: int) -> np.ndarray:
    """Per word and part, the sum of the hashes of its dimensions there."""
    order = np.lexsort((code, owner))
    c, w = code[order], owner[order]
    new = np.ones(len(c), bool)
    new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
    first = np.flatnonzero(new)
    nth = np.arange(len(c)) - np.repeat(first, np.diff(np.append(first, len(c))))
    dim = _mixed(c.astype(np.uint64) * np.uint64(1 << 32) + nth.astype(np.uint64))
    sums = np.zeros((n_words, parts), np.uint64)
    np.add.at(sums, (w, (dim % np.uint64(parts)).astype(np.int64)), dim)
    return sums


def signature_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word index, role, key) of all signatures of some words.

    Words that are one edit apart share a key: with role _EQUAL if they are of one length,
    else the shorter with _SHORT and the longer with _LONG.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(code)) - np.repeat(starts, lengths)

    def half(size: np.ndarray, tail: bool) -> np.ndarray:
        """A hash of the first `size` letters of each word, or of the last ones."""
        from_end = np.repeat(lengths, lengths) - 1 - place
        at = from_end if tail else place
        inside = at < np.repeat(size, lengths)
        value = _mixed(code.astype(np.uint64) * np.uint64(1 << 20) + at.astype(np.uint64))
        out = np.zeros(len(words), np.uint64)
        np.add.at(out, owner[inside], value[inside])
        return out

    found = []

    def add(role: int, parts: int, take_out: int, short: np.ndarray) -> None:
        """Signatures of this role; short is the length of the shorter word of a pair."""
        sums = _part_sums(code, owner, len(words), parts)
        whole = sums.sum(axis=1, dtype=np.uint64)
        head = short // 2
        for tail, size in ((False, head), (True, short - head)):
            base = _mixed(half(size, tail) + _mixed(short.astype(np.uint64) * np.uint64(4) + np.uint64(2 * parts + tail)))
            for i, out in enumerate(combinations(range(parts), take_out)):
                rest = whole - sums[:, list(out)].sum(axis=1, dtype=np.uint64)
                key = _mixed(_mixed(rest + np.uint64(i)) ^ base)
                found.append((np.arange(len(words)), np.full(len(words), role), key.view(np.int64)))

    with np.errstate(over="ignore"):
        add(_EQUAL, PARTS, 2, lengths)
        add(_SHORT, INSERT_PARTS, 1, lengths)
        add(_LONG, INSERT_PARTS, 1, lengths - 1)
    return tuple(np.concatenate(column) for column in zip(*found))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all pairs one edit apart, in both directions, each once.

    words: (word, n), different words. A hot key is split by the adaptive skew join; the
    candidates of a key stream through the verification and are never held.
    """
    once = stored(_met(_signatures(words)).distinct(), "near_words")
    return once.union(once.select("near", "near_n", "word", "n"))


def _signatures(words: DataFrame) -> DataFrame:
    """(word, n, role, key): all signatures of the words."""

    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            if not texts:
                continue
            at, role, key = signature_rows(texts)
            at = pa.array(at)
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(role, pa.int32()), pa.array(key)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "role", "key"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, role int, key long")


def _met(rows: DataFrame) -> DataFrame:
    """(word, n, near, near_n): words one edit apart that share a key, once per such key.

    Spark takes the signatures for as large as the words, of which each has 18, so the join is
    told to sort them; else half a GB of documents has them all broadcast.
    """
    a, b = rows.alias("a"), rows.hint("merge").alias("b")
    meet = ((F.col("a.role") == _EQUAL) & (F.col("b.role") == _EQUAL) & (F.col("a.word") < F.col("b.word"))) | (
        (F.col("a.role") == _SHORT) & (F.col("b.role") == _LONG)
    )
    close = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    return a.join(b, (F.col("a.key") == F.col("b.key")) & meet & close).select(
        F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form: the last of the chain of forms.

    A form is FORM_RATIO times as frequent, so chains are short and have no circle; each
    round doubles the steps taken.
    """
    ahead = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = ahead.join(further, "root", "left")
        ahead = stored(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if ahead.filter("moved").isEmpty():
            return ahead.select("word", "root")
        ahead = ahead.select("word", "root")


def group_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """One row per word: word, form, root (string), n, n_near, form_n (long).

    The form of a word is its near word of largest n (ties: the least in code-point order)
    if that n is at least FORM_RATIO times the word's; else null. root follows the forms;
    a word without a form is its own root. Null and empty texts have no words; a null
    doc_id counts as empty text; repeated rows count as often as they occur. An empty table
    gives no rows.
    """
    prepare(docs.sparkSession)
    words = stored(word_counts(docs, min_length, min_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    most = -F.col("best.less")
    enough = most >= FORM_RATIO * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, most).alias("form_n"),
    )
    formed = stored(formed, "forms")
    last = roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
