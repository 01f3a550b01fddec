import random

import numpy as np
from llm_cases import documents, empty, odd_rows
from pyspark.sql import functions as F

from wardstar.llm import toxicity
from wardstar.llm.common import read_table

SF_DIR = "/root/testdata/sf0.1"
STEMS = ("zork", "blam")


def corpus(n=400, seed=1):
    """Every third document has one or two words with a bad stem and a new ending."""
    rng = random.Random(seed)
    parts = "an be co di el fa go hu in ja".split()
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(5, 120))]
        toxic = int(i % 3 == 0)
        for _ in range(toxic * rng.randint(1, 2)):
            words.insert(rng.randrange(len(words)), rng.choice(STEMS) + "".join(rng.choices(parts, k=2)))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def auc(score, y):
    order = np.argsort(np.argsort(score)) + 1
    pos = (y == 1).sum()
    return (order[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, toxic int")


def test_finds_held_out_documents_with_unseen_words(spark):
    rows, labels = corpus()
    found = toxicity.score(documents(spark, rows), label_table(spark, labels)).filter("held_out").collect()
    y = dict(labels)
    assert auc(np.array([r.score for r in found]), np.array([y[r.doc_id] for r in found])) > 0.97
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in found)


def test_held_out_labels_and_other_columns_change_nothing(spark):
    rows, labels = corpus(200)
    held = {r.doc_id for r in spark.range(200).select(F.col("id").alias("doc_id")).filter(
        F.crc32(F.col("doc_id").cast("string")) % 3 == 1).collect()}
    before = toxicity.score(documents(spark, rows), label_table(spark, labels)).collect()
    spoiled = [(i, 1 - t if i in held else t) for i, t in labels]
    other = documents(spark, [(i, t, "xx", "yy") for i, t in rows])
    after = toxicity.score(other, label_table(spark, spoiled)).collect()
    assert {(r.doc_id, round(r.score, 9)) for r in before} == {(r.doc_id, round(r.score, 9)) for r in after}
    assert {r.doc_id for r in before if r.held_out} == held


def test_odd_rows_and_labels(spark):
    rows, labels = corpus(150)
    odd = [(None if r[0] is None else 1_000 + r[0], *r[1:]) for r in odd_rows()]
    docs = documents(spark, rows + odd, "score")
    strange = [(None, 1), (0, None), (1, 7), (2, 0), (2, 1), (9_999, 1), (3, 1), (3, 1)]
    found = toxicity.score(docs, label_table(spark, labels + strange)).collect()
    assert len(found) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 for r in found)
    blank = {round(r.score, 12) for r in found if r.doc_id in (1_003, 1_004, 1_005)}
    assert len(blank) == 1


def test_nothing_to_learn_from(spark):
    rows, labels = corpus(30)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for table in (none, label_table(spark, [(i, 0) for i, _ in labels])):
        assert {r.score for r in toxicity.score(documents(spark, rows), table).collect()} == {0.0}
    assert toxicity.score(empty(spark), label_table(spark, labels)).count() == 0


def test_ratio_equals_the_two_models_written_out(spark):
    """Against Kneser-Ney computed run by run over plain dictionaries."""
    from collections import Counter
    from math import log

    rows, labels = corpus(60)
    y = dict(labels)
    toxic = [t for i, t in rows if y[i]]
    ordinary = [t for i, t in rows if not y[i]]
    docs = documents(spark, rows)
    training = spark.createDataFrame([(y[i], t) for i, t in rows], "toxic int, text string")
    ratio = toxicity.fit_ratio(docs, training)

    types = {w for _, t in rows for w in t.split()}
    n = {k: Counter(r for w in types for r in toxicity._runs(w, k)) for k in range(1, 6)}

    def absolute(counts):
        a, b = (sum(v == k for v in counts.values()) for k in (1, 2))
        return a / (a + 2 * b) if a and b else 0.5

    def back(run):
        k = len(run)
        lower = back(run[1:]) if k > 1 else 1 / 1_000
        around = [v for r, v in n[k].items() if r[:-1] == run[:-1]]
        if not around:
            return lower
        d = absolute(n[k])
        return (max(n[k][run] - d, 0) + d * len(around) * lower) / sum(around)

    def logp(texts, word):
        counts = Counter(r for t in texts for w in t.split() for r in toxicity._runs(w, 5))
        d, total = absolute(counts), 0.0
        for run in toxicity._runs(word, 5):
            around = [v for r, v in counts.items() if r[:-1] == run[:-1]]
            if around:
                total += log((max(counts[run] - d, 0) + d * len(around) * back(run)) / sum(around))
            else:
                total += log(back(run))
        return total

    for word in ("zorkanbe", "blaminja", "ancodi", "unseen", "an", "zo"):
        expected = logp(toxic, word) - logp(ordinary, word)
        assert abs(ratio(np.array([word], dtype=object))[0] - expected) < 1e-6


def test_held_out_quality_on_the_given_documents(spark):
    docs, labels = read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "labels")
    found = toxicity.score(docs, labels).filter("held_out").join(labels, "doc_id").toPandas()
    assert auc(found.score.to_numpy(), found.toxic.to_numpy()) > 0.85
