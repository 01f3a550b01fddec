import random

import pytest
from llm_cases import documents, empty, odd_rows

from wardstar.llm import licenses, lines


def plain_dedup(rows):
    """(doc_id, n_lines, n_removed, text), documents in the order of their ids; ids differ."""
    seen, result = set(), []
    for doc_id, text in sorted(rows):
        if text is None:
            result.append((doc_id, 0, 0, None))
            continue
        split = text.split("\n")
        bare = [x.strip(" ") for x in split]
        gone = set()
        for i in range(len(split) - 2):
            window = tuple(bare[i : i + 3])
            if not any(window):
                continue
            if window in seen:
                gone.update((i, i + 1, i + 2))
            seen.add(window)
        kept = [x for i, x in enumerate(split) if i not in gone]
        result.append((doc_id, len(split), len(gone), "\n".join(kept)))
    return result


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "\n".join(rng.choice(["a", "b", " b ", "", "c"]) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n\n\n")]
    got = sorted(map(tuple, lines.dedup_lines(documents(spark, rows, "pos")).collect()), key=lambda r: r[0])
    assert got == plain_dedup(rows)
    assert sum(r[2] for r in got) > 0


def test_every_removed_line_is_kept_somewhere(spark):
    rng = random.Random(9)
    rows = [(i, "\n".join(rng.choice("abcdefgh") for _ in range(30))) for i in range(50)]
    got = lines.dedup_lines(documents(spark, rows)).collect()
    kept = {x for r in got for x in r.text.split("\n")}
    assert {x for _, t in rows for x in t.split("\n")} <= kept


def test_line_dedup_of_odd_rows(spark):
    got = lines.dedup_lines(documents(spark, odd_rows(), "h1")).collect()
    assert len(got) == len(odd_rows())
    by_id = {r.doc_id: r for r in got}
    assert by_id[3].text is None and by_id[4].text == "" and by_id[4].n_lines == 1
    assert by_id[9].text == "a\nb\nc\n\n\n\n\n"[: len(by_id[9].text)] and by_id[9].n_removed > 0
    assert lines.dedup_lines(empty(spark)).count() == 0


def license_of(spark, text):
    return licenses.scan(documents(spark, [(1, text)], "license")).first()


def test_notices_in_any_spelling(spark):
    for text in (
        "Some prose.\nReleased under the MIT License.",
        "x\n  released   under THE mit licence!!  \ny",
        "RELEASED!! UNDER!! THE!! MIT!! LICENSE.!!",
    ):
        assert license_of(spark, text).licenses == "MIT"
    assert license_of(spark, "Not released under the MIT License.").licenses == ""
    both = license_of(spark, "Licensed under CC BY-NC 4.0.\nLicenced under CC BY-NC 4.0\nReleased under the MIT License.")
    assert both.licenses == "CC-BY-NC-4.0,MIT" and both.n_matches == 2


def test_whole_texts_with_copyright_lines_and_other_layout(spark):
    mit = next(t for name, t in licenses.KNOWN if name == "MIT" and len(t) > 500)
    changed = "Copyright (c) 2020 Somebody\n© 2021 Another\n" + mit.replace("\n", "  \n ").replace("sublicense", "sub-license").upper()
    row = license_of(spark, changed)
    assert row.whole_license == "MIT" and row.licenses == "MIT"
    assert license_of(spark, mit + " More.").whole_license is None
    # A copyright line is one; a sentence about copyright is none.
    assert license_of(spark, "copyright is a right\nReleased under the MIT License.").whole_license is None
    assert license_of(spark, "Copyright 2020 X\nReleased under the MIT License.").whole_license == "MIT"


def test_known_digests_are_unique(spark):
    rows = licenses.known_digests(spark).collect()
    assert len({bytes(r.digest) for r in rows}) == len(rows)
    assert {r.license for r in rows} == {name for name, _ in licenses.KNOWN}


def test_license_scan_of_odd_rows(spark):
    docs = documents(spark, odd_rows(), "digest")
    got = licenses.scan(docs).collect()
    assert len(got) == len(odd_rows()) and all(r.licenses == "" and r.whole_license is None for r in got)
    assert licenses.scan(empty(spark)).count() == 0
    own = licenses.known_digests(spark, [("A", "one"), ("B", "ONE")])
    assert own.count() == 1
    hit = {r.doc_id: r.whole_license for r in licenses.scan(docs, own).collect() if r.whole_license}
    assert hit == {8: "A"}
