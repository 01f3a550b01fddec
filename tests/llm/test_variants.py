import random
import re
import zlib
from collections import Counter

import pytest
from llm_cases import documents, empty, odd_rows, prose

from wardstar.llm import variants
from wardstar.llm.common import prepare

NAMES = ["word", "form", "root", "n", "n_near", "form_n"]


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(docs, min_length=6, min_count=5):
    counts = Counter()
    for doc_id, text in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    found = {}
    for w, n in words.items():
        mates = [x for x in words if near(w, x)]
        best = min(mates, key=lambda x: (-words[x], x), default=None)
        found[w] = (best if best and words[best] >= 5 * n else None, len(mates))

    def root(w):
        return root(found[w][0]) if found[w][0] else w

    return sorted((w, f, root(w), words[w], k, words[f] if f else None) for w, (f, k) in found.items())


def run(spark, docs):
    df = variants.group_variants(documents(spark, docs, "form"))
    assert df.columns == NAMES
    return sorted(map(tuple, df.collect()))


def edited(rng, word):
    at, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:at] + (rng.choice("abcé") if kind else "") + word[at + (kind < 2) :]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.choice([5, 6, 7, 9, 12]))) for _ in range(12)]
    words = list(base)
    for _ in range(3):  # chains of edits, each step rarer
        words += [edited(rng, rng.choice(words)) for _ in range(40)]
    docs = []
    for i in range(60):
        drawn = [words[min(int(rng.expovariate(1 / 15)), len(words) - 1)] for _ in range(80)]
        docs.append((i, rng.choice([" ", ", ", "-1"]).join(w.upper() if rng.random() < 0.3 else w for w in drawn)))
    got = run(spark, docs)
    assert got == expected(docs)
    assert any(r[1] and r[2] != r[1] for r in got) or any(r[1] for r in got)


def test_equals_brute_force_on_odd_rows(spark):
    docs = [r[:2] for r in odd_rows()] + [(None, "letters " * 500), (40, "letterz lettersé Ölfarbe×x " * 9), (41, "a" * 5_000)]
    assert run(spark, docs) == expected(docs)


def test_damaged_letters_change_words(spark):
    docs = [(i, "wonderful weather " * 6) for i in range(2_000)]
    got = run(spark, docs)
    assert got == expected(docs)
    assert {"wonderful", "weather"} < {r[0] for r in got}
    assert all(r[2] in ("wonderful", "weather") for r in got)


def test_roots_follow_long_chains(spark):
    # a, ab, abc, ...: each word is five times as frequent as the one a letter longer.
    words = ["abcdef" + "ghijk"[:i] for i in range(5)]
    docs = [(i, " ".join([w] * 5 ** (6 - i))) for i, w in enumerate(words)]
    got = {r[0]: r for r in run(spark, docs)}
    assert {w: got[w][2] for w in words} == dict.fromkeys(words, words[0])
    assert got[words[3]][1] == words[2]


def test_no_near_pair_is_lost_and_none_is_made_up(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([6, 7, 8]))) for _ in range(400)})
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = sorted((r.word, r.near) for r in variants.near_pairs(table).collect())
    assert got == sorted((a, b) for a in words for b in words if near(a, b))


def test_empty_table(spark):
    assert run(spark, []) == []
    assert variants.group_variants(empty(spark)).count() == 0
    assert run(spark, [(1, prose(1, 3))]) == []

def test_signatures_are_joined_by_sorting_and_never_broadcast(spark):
    prepare(spark)
    words = spark.createDataFrame([("letters", 9), ("lettrs", 1), ("lettera", 1)], "word string, n long")
    met = variants._met(variants._signatures(words))
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [key#" in plan and "Broadcast" not in plan
    assert {(r.word, r.near) for r in met.collect()} == {("lettera", "letters"), ("lettrs", "letters")}
