import random

import pytest
from llm_cases import documents, empty, odd_rows, prose
from pyspark.sql import functions as F

from wardstar.llm import langid
from wardstar.llm.common import read_table

SF_DIR = "/root/testdata/sf0.01"
ALPHABETS = {"aa": "abcde ", "bb": "fghij ", "cc": "abfgk "}


def text(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return "".join(rng.choice(ALPHABETS[lang]) for _ in range(n))


def rows(n=60):
    langs = list(ALPHABETS)
    return [(i, text(langs[i % 3], 20 + i * 3, i), langs[i % 3], "s") for i in range(n)]


def plain_profile(texts, places):
    """n-grams of a language's texts, most frequent first, ties by code points."""
    counts: dict[str, int] = {}
    for t in texts:
        words, word = [], ""
        for c in t.lower() + " ":
            if c.isalpha():
                word += c
            else:
                words += [word] if word else []
                word = ""
        for w in words:
            for n in (1, 2, 3):
                padded = w if n == 1 else f" {w} "
                for i in range(len(padded) - n + 1):
                    counts[padded[i : i + n]] = counts.get(padded[i : i + n], 0) + 1

    def number(g):
        code = 0
        for c in g:
            code = code * (1 << 21) + ord(c)
        return code

    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:places]


def test_equals_plain_out_of_place_distances(spark):
    import zlib

    data = rows()
    places = 40
    learned = {}
    for lang in ALPHABETS:
        own = [t for i, t, l, _ in data if l == lang and zlib.crc32(str(i).encode()) % 5]
        learned[lang] = plain_profile(own, places)
    found = {r.doc_id: r for r in langid.identify(documents(spark, data), places=places).collect()}
    for i, t, _, _ in data:
        grams = plain_profile([t], places)
        distance = {
            lang: sum(abs(k - p.index(g)) if g in p else places for k, g in enumerate(grams)) for lang, p in learned.items()
        }
        best = min(sorted(distance), key=distance.get)
        assert found[i].lang_pred == best
        assert found[i].score == pytest.approx(1 - distance[best] / (places * len(grams)))
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_held_out_accuracy_and_no_use_of_labels(spark):
    docs = read_table(spark, SF_DIR, "documents")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    spoiled = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit(""))
    again = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(spoiled).collect()}
    assert all(again[r.doc_id] == (r.lang_pred, r.score) for r in found)


def test_odd_rows(spark):
    docs = documents(spark, odd_rows() + rows(), "held_out")
    found = langid.identify(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r.score <= 1
    unknown = {r.doc_id for r in found if r.lang_pred == "und"}
    assert {3, 4, 5, None} <= unknown | {None} and all(r.score == 0 for r in found if r.lang_pred == "und")
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns
    assert kept.filter("text is null or text = ''").count() == 0
    assert kept.count() >= docs.count() - 5


def test_without_labels_and_without_rows(spark):
    plain = documents(spark, [(1, "abc"), (2, None)])
    assert {(r.lang_pred, r.score) for r in langid.identify(plain).collect()} == {("und", 0.0)}
    assert langid.identify(empty(spark)).count() == 0
    assert langid.keep_known(empty(spark)).count() == 0


def test_sample_is_bounded_per_language(spark):
    sample = langid.training_rows(documents(spark, rows()), sample_docs=5).groupBy("language").count().collect()
    assert {r["count"] for r in sample} == {5} and len(sample) == 3


def test_digits_of_other_kinds_are_no_letters(spark):
    docs = documents(spark, [(100, "² ½ 12 _ !"), *rows()])
    assert langid.identify(docs).filter("doc_id = 100").first().lang_pred == "und"
    assert prose(1, 3)
