import random

import numpy as np
import pytest
from llm_cases import documents, empty, odd_rows, union_find
from pyspark.sql import functions as F

import corpus_pipeline
from wardstar.llm import copies


def runs(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def kept(rows):
    """Ids left by brute force over all pairs; ids differ."""
    rows = sorted(rows)
    sets = [runs(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    return {rows[i][0] for i in set(union_find(len(rows), links))}


def edited(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.random()}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    texts = [" ".join(f"w{rng.randrange(3_000)}" for _ in range(200)) for _ in range(30)]
    rows = texts + [edited(rng, t, n) for t in texts for n in (1, 2, 3, 4, 5, 8)]
    chain = texts[0]
    for _ in range(15):
        chain = edited(rng, chain, 3)
        rows.append(chain)
    return list(enumerate(rows))


@pytest.mark.parametrize("group_rows", [4, copies.GROUP_ROWS])
def test_the_stage_links_what_is_similar_by_08(spark, group_rows):
    rows = corpus(1)
    docs = documents(spark, rows)
    assert {r.doc_id for r in copies.keep_one(docs, group_rows=group_rows).collect()} == kept(rows)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == kept(rows)


def test_forest_connects_what_all_pairs_connect():
    texts = [t for _, t in corpus(2)]
    sets = [copies.shingles(t.encode()) for t in texts]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if jaccard(runs(texts[i]), runs(texts[j])) >= 0.8]
    found = copies.forest(sets)
    assert union_find(len(sets), found) == union_find(len(sets), near) and set(found) <= {p for i, j in near for p in ((i, j), (j, i))}


def test_most_pairs_at_08_share_a_band():
    rng = np.random.default_rng(5)
    hit = 0
    for _ in range(300):
        x = rng.integers(0, 1 << 63, 220, dtype=np.uint64)  # 180 common, 20 and 20 own: 180 / 220 = 0.82
        a, b = np.sort(x[:200]), np.sort(np.concatenate((x[:180], x[200:])))
        hit += bool(set(copies.bands(a)) & set(copies.bands(b)))
    assert hit >= 297


def test_odd_rows(spark):
    got = copies.keep_one(documents(spark, odd_rows(), "set_id")).collect()
    # Equal texts are one; so are texts without words, whatever their ids.
    assert sorted((r.doc_id, r.text[:9] if r.text else r.text) for r in got) == sorted(
        (i, t[:9] if t else t) for i, t in {(r[0], r[1]) for r in odd_rows()} if i in (0, 3, 6, 7, 8, 9)
    )
    assert copies.keep_one(empty(spark)).count() == 0


def test_simhash_pairs_have_equal_or_linked_fingerprints(spark):
    rows = [(0, 1), (0, 2), (0b1111, 3), (-1, 4), (None, 5), (-1, 4), (0b11111 << 20, 6)]
    got = copies.simhash_pairs(spark.createDataFrame(rows, "fp long, set_id long")).collect()
    assert sorted(tuple(r) for r in got) == [(2, 1), (3, 1)]


def test_the_stage_finds_near_copies_by_simhash_alone(spark, monkeypatch):
    """Without common bands, what SimHash links and is similar by 0.8 is still one document."""
    real = copies._sets

    def without_bands(docs, key):
        return real(docs, key).withColumn("bands", F.array().cast("array<long>"))

    monkeypatch.setattr(copies, "_sets", without_bands)
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(0, text), (1, text.upper()), (2, text + " end"), (3, "nothing like the others at all here")]
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, documents(spark, rows), "").collect()} == {0, 3}
