import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, odd_rows, prose

from wardstar.llm import lexical


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(docs, items, top=10):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    rows = []
    for item_id, text in items:
        scores = []
        for (doc_id, c), n in zip(counted, lengths):
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * (10 + (90 * n * n_docs) // total)))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, i, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(rows, key=repr)


def run(spark, docs, items, **options):
    table = spark.createDataFrame(items, "item_id long, text string")
    df = lexical.search(documents(spark, docs, "score"), table, **options)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    names = ["t%d" % i for i in range(30)] + ["é", "東京", "Ab"]

    def text(n):
        return rng.choice([" ", ", ", "_"]).join(names[min(int(rng.expovariate(0.2)), 32)] for _ in range(n))

    docs = [(i, text(rng.choice([0, 1, 2, 5, 5, 5, 40, 300]))) for i in range(200)]
    items = [(i, text(rng.choice([1, 3, 12]))) for i in range(20)] + [(3, text(4))]
    assert run(spark, docs, items) == expected(docs, items)


def test_small_segments_and_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(lexical, "_SLICE", 5)
    docs = [(i, prose(i % 70, 6 + i % 5)) for i in range(300)]
    items = [(i, prose(1_000 + i, 9)) for i in range(8)]
    assert run(spark, docs, items) == expected(docs, items)


def test_equals_brute_force_on_odd_rows(spark):
    docs = [r[:2] for r in odd_rows()]
    items = [(1, prose(1, 9)), (2, None), (3, ""), (4, "nowhere!"), (5, "東京 12 ÉTÉ"), (None, "one TWO"), (1, prose(1, 9))]
    got = run(spark, docs, items)
    assert got == expected(docs, items)
    assert run(spark, docs, items, top=2) == expected(docs, items, 2)


def test_many_equal_rows_share_segments(spark):
    docs = [(7, "same words here")] * 2_500 + [(None, "same words here")] * 40 + [(i, "other") for i in range(30)]
    items = [(1, "words"), (2, "other words")]
    assert run(spark, docs, items) == expected(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a b")], []) == []


def test_index_keeps_every_posting_in_bounded_segments(spark):
    docs = documents(spark, [(i, prose(i % 9, 10 + i % 3)) for i in range(400)])
    vocabulary = {b"river": 0, b"stones": 1, b"rain": 2}
    found = lexical.matches(docs, vocabulary)
    rows = lexical.index(found, 400, 4_400, segment_docs=50).collect()
    assert max(len(r.doc_ids) for r in rows) < 100
    got = Counter()
    for r in rows:
        assert list(r.tfs) == sorted(set(r.tfs)) and r.ends[-1] == len(r.terms)
        tf = np.repeat(r.tfs, np.diff(r.ends, prepend=0))
        got.update((r.doc_ids[p], t, int(x)) for p, t, x in zip(r.places, r.terms, tf))
    plain = Counter((r.doc_id, t, x) for r in found.collect() for t, x in zip(r.terms, r.tfs))
    assert got == plain
