"""Toxicity by two class-conditional Kneser-Ney models.

Both models give the probability of a word letter by letter, each letter after the four
before it (words are padded). A class's counts come from labelled documents of that class,
discounted; what the discount frees is given out by shared backoff counts. Those are
Kneser-Ney continuation counts from the whole corpus: in how many different words a run of
letters occurs, interpolated over runs of five letters down to one. An expression that a
class has hardly seen is thus smoothed by the same counts in both classes, and only what
the classes themselves have seen makes a difference.

A document's evidence is length-normalised: the mean over its words of the log-likelihood
ratio toxic : ordinary, the excess of its telling words for its length, and its most
telling word. A logistic curve, fitted on labelled documents that the models have not seen,
turns the three into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import fold, id_text, prepare, smallest_hashes, stored

FOLDS, HELD_OUT = 3, 1
ORDER = 5
#: The classifier is fitted on at most so many labelled documents of each class ...
SAMPLE_DOCS = 6_000
#: ... of which this share, in tenths, is kept for the logistic curve.
CALIBRATION_TENTHS = 3
TOXIC_FROM = 0.7
#: Log-likelihood ratio from which a word is telling.
TELLING = 2.0
_LETTERS = re.compile(r"[^\W\d_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CACHE_WORDS = 500_000


def _words(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def _runs(word: str, order: int) -> Iterator[str]:
    """The runs of `order` letters that end at each letter, and at the word's end."""
    line = "^" * (order - 1) + word + "$"
    return (line[i : i + order] for i in range(len(line) - order + 1))


def _batch(rows: Counter, kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = [*zip(*rows.keys()), list(rows.values())] if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def word_types(docs: DataFrame) -> DataFrame:
    """The different words of all documents."""

    def run(batches):
        for batch in batches:
            found: set[str] = set()
            for text in batch.column(0).to_pylist():
                found.update(_words(text))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string())], ["word"])

    return docs.select("text").mapInArrow(run, "word string").distinct()


def shared_counts(docs: DataFrame) -> DataFrame:
    """(run, n): in how many different words of the corpus each run of 1 to ORDER letters occurs."""

    def run(batches):
        for batch in batches:
            found: Counter = Counter()
            for word in batch.column(0).to_pylist():
                for order in range(1, ORDER + 1):
                    found.update(_runs(word, order))
            rows = Counter({(r,): n for r, n in found.items()})
            yield _batch(rows, [pa.string(), pa.int64()], ["run", "n"])

    counted = word_types(docs).mapInArrow(run, "run string, n long")
    return counted.groupBy("run").agg(F.sum("n").alias("n"))


def training_rows(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(toxic, calibrate, text) of the labelled documents to learn from.

    A bounded sample of each class, by the smallest hashes of the ids. Held-out ids, null
    ids and labels other than 0 and 1 are left out; an id with both labels counts as toxic.
    """
    known = labels.filter((fold("doc_id", FOLDS) != HELD_OUT) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.groupBy(id_text("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = smallest_hashes(known, "toxic", "id", sample_docs)
    late = F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(10)) < CALIBRATION_TENTHS
    texts = docs.select(id_text("doc_id").alias("id"), "text").filter(F.col("text").isNotNull())
    # At most 2 * sample_docs ids are broadcast, so the texts are not shuffled.
    return texts.join(F.broadcast(chosen), "id").select("toxic", late.alias("calibrate"), "text")


def class_counts(rows: DataFrame) -> DataFrame:
    """(run, toxic, ordinary): occurrences of each run of ORDER letters in either class."""

    def run(batches):
        for batch in batches:
            words: Counter = Counter()
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.update((toxic, w) for w in _words(text))
            found: Counter = Counter()
            for (toxic, word), n in words.items():
                for r in _runs(word, ORDER):
                    found[r, toxic] += n
            yield _batch(found, [pa.string(), pa.int32(), pa.int64()], ["run", "toxic", "n"])

    counted = rows.select("toxic", "text").mapInArrow(run, "run string, toxic int, n long")
    of = {name: F.coalesce(F.sum(F.when(F.col("toxic") == k, F.col("n"))), F.lit(0)) for name, k in (("toxic", 1), ("ordinary", 0))}
    return counted.groupBy("run").agg(*[c.alias(name) for name, c in of.items()])


def _discount(once: float, twice: float) -> float:
    """The usual estimate from how many counts are 1 and 2."""
    return once / (once + 2 * twice) if once and twice else 0.5


class Ratio:
    """log P(word | toxic) - log P(word | ordinary), for many words at once.

    A letter's ratio is listed if either class has seen its run. If not, both back off to
    the same shared probability, and only the shares they back off with remain; those are
    listed by context. In a context that neither has seen the ratio is zero.
    """

    def __init__(self, runs: dict[str, float], contexts: dict[str, float]):
        self.tables = []
        for listed, length in ((runs, ORDER), (contexts, ORDER - 1)):
            keys = self.keys(np.array([list(map(ord, r)) for r in listed], dtype=np.uint64).reshape(-1, length))
            order = np.argsort(keys)
            values = np.fromiter(listed.values(), np.float64, len(listed))
            # A last key that is never asked for keeps the tables from being empty.
            self.tables.append((np.append(keys[order], np.uint64(2**64 - 1)), np.append(values[order], 0.0)))
        self.cache: dict[str, float] = {}

    @staticmethod
    def keys(codes: np.ndarray) -> np.ndarray:
        key = np.zeros(len(codes), dtype=np.uint64)
        for k in range(codes.shape[1]):
            key = key * _STEP + codes[:, k]
        return key

    def fresh(self, words: list[str]) -> np.ndarray:
        pad = ORDER - 1
        line = "".join(f"{'^' * pad}{w}$" for w in words)
        codes = np.frombuffer(line.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + pad + 1
        owner = np.repeat(np.arange(len(words)), sizes)
        at = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ends = np.flatnonzero(at >= pad)
        context = self.keys(np.stack([codes[ends - pad + k] for k in range(pad)], axis=1))
        (runs, ratio), (contexts, share) = self.tables
        run = context * _STEP + codes[ends]
        i = np.minimum(np.searchsorted(runs, run), len(runs) - 1)
        j = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
        value = np.where(runs[i] == run, ratio[i], np.where(contexts[j] == context, share[j], 0.0))
        return np.bincount(owner[ends], weights=value, minlength=len(words))

    def __call__(self, words: np.ndarray) -> np.ndarray:
        """Ratios of different words; those met before are remembered."""
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > _CACHE_WORDS:
            self.cache.clear()
            new = list(words)
        if new:
            self.cache.update(zip(new, self.fresh(new).tolist()))
        return np.fromiter(map(self.cache.__getitem__, words), np.float64, len(words))


def fit_ratio(docs: DataFrame, rows: DataFrame) -> Ratio | None:
    """The two models. What reaches the driver is bounded by the sample of labelled rows.

    The shared counts of the whole corpus stay in Spark; of them only the runs and contexts
    that occur in the sample are fetched.
    """
    classes = stored(class_counts(rows), "class_runs")
    shared = stored(shared_counts(docs), "shared_runs")
    seen = classes.toPandas()
    if seen.empty or not seen.toxic.sum() or not seen.ordinary.sum():
        return None
    suffixes = F.explode(F.transform(F.sequence(F.lit(1), F.lit(ORDER)), lambda k: F.expr("run").substr(k, F.lit(ORDER))))
    wanted = classes.select(suffixes.alias("run")).distinct()
    length = F.char_length("run")
    context = F.expr("left(run, char_length(run) - 1)")
    contexts = shared.groupBy(context.alias("context"), length.alias("order")).agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds")
    )
    needed = wanted.select(context.alias("context"), length.alias("order")).distinct()
    n = dict(shared.join(wanted, "run", "left_semi").toPandas().itertuples(index=False, name=None))
    around = {
        (c, o): (total, kinds)
        for c, o, total, kinds in contexts.join(needed, ["context", "order"], "left_semi").toPandas().itertuples(index=False, name=None)
    }
    ones = shared.groupBy(length.alias("order")).agg(F.count_if(F.col("n") == 1).alias("a"), F.count_if(F.col("n") == 2).alias("b"))
    cut = {r.order: _discount(r.a, r.b) for r in ones.collect()}  # ORDER rows

    memo: dict[str, float] = {}

    def backoff(run: str) -> float:
        """Shared probability of the last letter after the others."""
        if run not in memo:
            lower = backoff(run[1:]) if len(run) > 1 else 1 / 1_000
            total, kinds = around.get((run[:-1], len(run)), (0, 0))
            d = cut.get(len(run), 0.5)
            memo[run] = (max(n.get(run, 0) - d, 0) + d * kinds * lower) / total if total else lower
        return memo[run]

    seen["context"] = seen.run.str[:-1]
    freed, sides = {}, {}
    for side in ("toxic", "ordinary"):
        own = seen[seen[side] > 0]
        d = _discount((own[side] == 1).sum(), (own[side] == 2).sum())
        groups = own.groupby("context")[side].agg(["sum", "count"])
        freed[side] = (d * groups["count"] / groups["sum"]).to_dict()
        sides[side] = (d, groups["sum"].to_dict())

    def logp(side: str, run: str, context: str, count: int) -> float:
        d, totals = sides[side]
        if context not in totals:
            return math.log(backoff(run))
        return math.log(max(count - d, 0) / totals[context] + freed[side][context] * backoff(run))

    runs = {
        r.run: logp("toxic", r.run, r.context, r.toxic) - logp("ordinary", r.run, r.context, r.ordinary)
        for r in seen.itertuples(index=False)
    }
    shares = {
        c: math.log(freed["toxic"].get(c, 1.0)) - math.log(freed["ordinary"].get(c, 1.0)) for c in seen.context.unique()
    }
    return Ratio(runs, shares)


def evidence(ratio: Ratio, texts: list[str | None]) -> np.ndarray:
    """Mean, excess and peak of each text's ratios; all zero without a word."""
    lists = [_words(t) for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    result = np.zeros((len(texts), 3))
    if not sizes.sum():
        return result
    codes, words = pd.factorize(np.array([w for found in lists for w in found], dtype=object))
    value = ratio(words)[codes]
    owner = np.repeat(np.arange(len(texts)), sizes)
    length = np.maximum(sizes, 1)
    result[:, 0] = np.bincount(owner, weights=value, minlength=len(texts)) / length
    result[:, 1] = np.bincount(owner, weights=np.maximum(value - TELLING, 0), minlength=len(texts)) / length**0.75
    full = np.flatnonzero(sizes)
    result[full, 2] = np.maximum.reduceat(value, (np.cumsum(sizes) - sizes)[full])
    return result


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps, each class with the same weight."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * len(y)
    penalty = np.diag([1e-6, *[ridge] * x.shape[1]]) * len(y) / 100
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (weight * (y - p)) - penalty @ beta
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + penalty
        beta = beta + np.linalg.solve(curve, slope)
    return centre, scale, beta


def score(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs (doc_id, text).

    labels: doc_id, toxic. Null and empty texts have no evidence and get the score of
    none. If either class has no document to learn from, or nothing to fit the curve
    on, every score is 0. Repeated rows are each scored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = stored(training_rows(docs, labels, sample_docs), "labelled")
    ratio = fit_ratio(docs, rows.filter("not calibrate"))
    curve = None
    if ratio is not None:

        def measure(batches):
            for batch in batches:
                found = evidence(ratio, batch.column(1).to_pylist())
                columns = [batch.column(0), *[pa.array(found[:, k]) for k in range(3)]]
                yield pa.RecordBatch.from_arrays(columns, ["toxic", "mean", "excess", "peak"])

        late = rows.filter("calibrate").select("toxic", "text")
        # At most 2 * sample_docs rows of four numbers.
        fitted = late.mapInArrow(measure, "toxic int, mean double, excess double, peak double").toPandas()
        if fitted.toxic.nunique() == 2:
            curve = fit_curve(fitted[["mean", "excess", "peak"]].to_numpy(), fitted.toxic.to_numpy())

    def run(batches):
        for batch in batches:
            result = np.zeros(batch.num_rows)
            if curve is not None:
                centre, scale, beta = curve
                z = (evidence(ratio, batch.column(2).to_pylist()) - centre) / scale
                result = 1 / (1 + np.exp(-np.clip(beta[0] + z @ beta[1:], -30, 30)))
            columns = [batch.column(0), batch.column(1), pa.array(result), pa.array((result >= TOXIC_FROM).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    held_out = (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    return docs.select("doc_id", held_out, "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
