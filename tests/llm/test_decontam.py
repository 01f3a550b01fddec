import hashlib
import random

import pytest
from llm_cases import documents, empty, odd_rows, prose

from wardstar.llm import decontam


def plain_words(text):
    found, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if ord(c) > 0x7F or c.isdigit() or "a" <= c <= "z":
            word += c
        else:
            found += [word] if word else []
            word = ""
    return found


def expected(docs, items, span=10):
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = plain_words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    result = []
    for doc_id, text in docs:
        w = plain_words(text)
        hit, names = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    names |= found
        names = sorted(str(x) for x in names if x is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        result.append((doc_id, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(result, key=repr)


def run(spark, docs, items):
    table = spark.createDataFrame(items, "item_id long, text string, hash string")
    df = decontam.contamination(documents(spark, docs, "hash"), table)
    assert df.columns == list(decontam.RESULT)
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_on_few_words(spark, seed):
    rng = random.Random(seed)

    def text(n, letters="ab"):
        return rng.choice([" ", ", ", "-"]).join(rng.choice(letters) for _ in range(n))

    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 14]), "abcde")) for i in range(14)]
    items += [(3, text(12)), (None, text(12, "abc")), (50, None), (51, text(6, "abc"))]
    docs = [(i, text(rng.choice([0, 2, 9, 10, 30, 200]), "abcde")) for i in range(60)]
    docs += [(200 + k, f"{text(5)} {items[k][1]} {text(5)}") for k in range(14)] + [(200, "x")] + [docs[5]]
    got = run(spark, docs, [(i, t, "x") for i, t in items])
    assert got == expected(docs, items)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_equals_brute_force_on_odd_rows(spark):
    docs = [r[:2] for r in odd_rows()]
    items = [(1, prose(2, 20_000)[5_000:5_400].upper()), (2, prose(1, 40)), (3, ""), (4, None), (5, "東京 12"), (6, "ONE!")]
    assert run(spark, docs, [(i, t, "x") for i, t in items]) == expected(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b", "x")]) == []
    table = spark.createDataFrame([], "item_id long, text string")
    rows = decontam.contamination(documents(spark, odd_rows()), table).collect()
    assert len(rows) == len(odd_rows()) and not any(r.contaminated for r in rows)
    assert decontam.clean(empty(spark), table).count() == 0


def test_clean_keeps_all_columns_of_clean_rows(spark):
    docs = documents(spark, odd_rows(), "row_hash")
    items = spark.createDataFrame([(2, prose(1, 40))], "item_id long, text string")
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([3, 4, 5, None, 6, 7, 8, 8, 9], key=repr)


def test_the_plan_has_no_python(spark):
    items = spark.createDataFrame([(2, prose(1, 40))], "item_id long, text string")
    plan = decontam.contamination(documents(spark, odd_rows()), items)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
