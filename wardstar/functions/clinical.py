"""Classification rules of the dimensions. Text compares without regard to case."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which specialty codes belong to which category.
SURGICAL_CODES = ("SURG", "ORTH", "NEUR")
SUPPORT_CODES = ("RAD", "PATH", "ANES")

# Fixed values: (type, category, expected length of stay in days).
ENCOUNTER_TYPES = (
    ("Outpatient", "Ambulatory", 0),
    ("Inpatient", "Acute", 5),
    ("ER", "Emergency", 1),
)

# Department type by words in its name, the first match wins.
DEPARTMENT_WORDS = (
    ("Inpatient", ("ICU", "Inpatient")),
    ("Outpatient", ("Clinic", "Outpatient")),
    ("ER", ("Emergency",)),
    ("Surgical", ("Surgical",)),
)

# Procedure category by code prefix, the first match wins.
PROCEDURE_PREFIXES = (
    ("99", "Evaluation & Management"),
    ("9", "Medicine"),
    ("7", "Radiology"),
    ("8", "Laboratory"),
)

# Upper age bound (inclusive) and label; everything else is 75+.
AGE_GROUPS = ((17, "0-17"), (34, "18-34"), (54, "35-54"), (74, "55-74"))
OLDEST_GROUP = "75+"


def text_key(c: Column) -> Column:
    """Form in which two text codes are equal when they differ only in case."""
    return F.upper(c)


def specialty_category(code: Column) -> Column:
    code = text_key(code)
    return (
        F.when(code.isin(*SURGICAL_CODES), "Surgical")
        .when(code.isin(*SUPPORT_CODES), "Diagnostic/Support")
        .otherwise("Medical")
    )


def department_type(name: Column) -> Column:
    result = None
    for label, words in DEPARTMENT_WORDS:
        hit = None
        for word in words:
            test = name.ilike(f"%{word}%")
            hit = test if hit is None else hit | test
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise("Other")


def procedure_category(code: Column) -> Column:
    result = None
    for prefix, label in PROCEDURE_PREFIXES:
        hit = code.startswith(prefix)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise("Procedure")


def diagnosis_category(code: Column) -> Column:
    return F.substring(code, 1, 1)


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)  # null when either part is null


def age_years(born: Column, as_of: date) -> Column:
    """Completed years; someone born on 29 February turns a year older on 1 March."""
    return F.timestamp_diff("YEAR", born, F.lit(as_of)).cast("int")


def age_group(age: Column) -> Column:
    """Label of an age in years. An unknown age falls into the last group."""
    result = None
    for upper, label in AGE_GROUPS:
        result = F.when(age <= upper, label) if result is None else result.when(age <= upper, label)
    return result.otherwise(OLDEST_GROUP)
