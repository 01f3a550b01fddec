import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardstar.context import BatchContext, ticking_clock  # noqa: E402
from wardstar.session import local_session, shared_dir  # noqa: E402
from wardstar.sources.tables import source_from_rows  # noqa: E402
from wardstar.sources.warehouse import Warehouse  # noqa: E402

OLD = datetime(2024, 1, 1)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


# The small sample with four encounters.
SAMPLE = {
    "specialties": [(1, "Cardiology", "CARD"), (2, "Internal Medicine", "IM"), (3, "Emergency", "ER")],
    "departments": [(1, "Cardiology Unit", 3, 20), (2, "Internal Medicine", 2, 30), (3, "Emergency", 1, 45)],
    "providers": [
        (101, "Ada", "Quill", "MD", 1, 1, OLD),
        (102, "Bo", "Marsh", "MD", 2, 2, OLD),
        (103, "Cy", "Holt", "MD", 3, 3, OLD),
    ],
    "patients": [
        (1001, "Una", "Reed", day("1955-03-15"), "M", "R-1", OLD),
        (1002, "Viv", "Stone", day("1962-07-22"), "F", "R-2", OLD),
        (1003, "Wil", "Ford", day("1948-11-08"), "M", "R-3", OLD),
    ],
    "diagnoses": [(3001, "I10", "Hypertension"), (3002, "E11.9", "Type 2 Diabetes"), (3003, "I50.9", "Heart Failure")],
    "procedures": [(4001, "99213", "Office Visit"), (4002, "93000", "EKG"), (4003, "71020", "Chest X-ray")],
    "billing": [
        (14001, 7001, Decimal("350.00"), Decimal("280.00"), day("2024-05-11"), "Paid"),
        (14002, 7002, Decimal("12500.00"), Decimal("10000.00"), day("2024-06-08"), "Paid"),
    ],
    "encounters": [
        (7001, 1001, 101, "Outpatient", ts("2024-05-10 10:00:00"), ts("2024-05-10 11:30:00"), 1),
        (7002, 1001, 101, "Inpatient", ts("2024-06-02 14:00:00"), ts("2024-06-06 09:00:00"), 1),
        (7003, 1002, 102, "Outpatient", ts("2024-05-15 09:00:00"), ts("2024-05-15 10:15:00"), 2),
        (7004, 1003, 103, "ER", ts("2024-06-12 23:45:00"), ts("2024-06-13 06:30:00"), 3),
    ],
    "encounter_diagnoses": [
        (8001, 7001, 3001, 1), (8002, 7001, 3002, 2), (8003, 7002, 3001, 1),
        (8004, 7002, 3003, 2), (8005, 7003, 3002, 1), (8006, 7004, 3001, 1),
    ],
    "encounter_procedures": [
        (9001, 7001, 4001, day("2024-05-10")), (9002, 7001, 4002, day("2024-05-10")),
        (9003, 7002, 4001, day("2024-06-02")), (9004, 7003, 4001, day("2024-05-15")),
    ],
}


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8)
    session.conf.set("spark.sql.shuffle.partitions", "3")
    yield session
    session.stop()


@pytest.fixture
def sample(spark):
    """Make source tables from the sample, with some tables replaced or extended."""

    def make(extra: dict | None = None, **replaced):
        rows = {k: list(v) for k, v in SAMPLE.items()}
        rows.update(replaced)
        for table, more in (extra or {}).items():
            rows[table] = rows[table] + more
        return source_from_rows(spark, rows)

    return make


@pytest.fixture
def warehouse(spark, request):
    import uuid

    return Warehouse(spark, f"{shared_dir(spark)}/tests/{uuid.uuid4().hex}")


@pytest.fixture
def batch():
    """Context of the n-th batch; a day apart unless as_of says otherwise."""

    def make(n: int, as_of: date | None = None, strict: bool = True) -> BatchContext:
        as_of = as_of or date(2024, 7, n)
        start = datetime(as_of.year, as_of.month, as_of.day, 2, n)
        return BatchContext(n, as_of, start, strict, ticking_clock(start))

    return make


def tuples(df, *columns):
    """Rows as sorted tuples."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)
