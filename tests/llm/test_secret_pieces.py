import random
import string

import tiktoken

from wardstar.llm import secrets

ENCODING = tiktoken.Encoding(
    "test", pat_str=secrets._PIECES, mergeable_ranks=secrets.read_ranks(), special_tokens={}
)


def spans(text):
    return secrets.random_spans(text, [], lambda run: len(ENCODING.encode_ordinary(run)))


def test_random_letters_are_found():
    rng = random.Random(7)
    runs = ["".join(rng.choices(string.ascii_letters, k=rng.randint(20, 40))) for _ in range(500)]
    assert sum(spans(f"see {run} end") == [(4, 4 + len(run), "random")] for run in runs) > 450


def test_readable_text_in_front_hides_nothing():
    rng = random.Random(8)
    for front in ("https//example/download/resources/", "path/to/some/configuration/directory/settings/", "the_name_of_it_"):
        hit = 0
        for _ in range(300):
            run = "".join(rng.choices(string.ascii_letters + string.digits, k=32))
            hit += any(a <= len(front) and b >= len(front) + 32 for a, b, _ in spans(front + run))
        assert hit > 290, front


def test_words_are_left_alone():
    for text in (
        "internationalization getUserAccountSettingsByIdentifier CONFIGURATION_DIRECTORY_SETTINGS",
        "docs/guides/getting-started/thisisaverylongwordwithoutanyspaces", "Donaudampfschifffahrtsgesellschaft",
        "12345678901234567890/12345678901234567890",
    ):
        assert spans(text) == [], text


def test_a_number_at_the_end_hides_nothing():
    rng = random.Random(9)
    for digits in (1, 4, 12):
        runs = ["".join(rng.choices(string.ascii_letters, k=24) + rng.choices(string.digits, k=digits)) for _ in range(500)]
        assert sum(spans(f"see {run} end") == [(4, 4 + len(run), "random")] for run in runs) > 450, digits


def test_names_with_numbers_are_left_alone():
    for text in (
        "configuration_directory_settings_2024", "docs/guides/getting-started/chapter10", "getUserAccountSettings12345678",
        "INVOICE-20240105123456789", "ORD12345678901234567890", "thisisaverylongwordwithoutanyspaces7",
    ):
        assert spans(text) == [], text
