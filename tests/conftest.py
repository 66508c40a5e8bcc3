import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """Builds a small DataFrame from a DDL schema and rows; ISO texts become dates, and so on."""
    def build(ddl, *rows):
        names = [part.split()[0] for part in ddl.split(", ")]
        text = ", ".join(f"{n} string" for n in names)
        as_text = [tuple(None if v is None else str(v) for v in row) for row in rows]
        df = spark.createDataFrame(as_text, text)
        return df.selectExpr(*[f"cast({p.split()[0]} as {p.split()[1]}) as {p.split()[0]}"
                               for p in ddl.split(", ")])
    return build


def d(text):
    return date.fromisoformat(text)


def usd(text):
    return Decimal(text)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()),
                  key=lambda t: tuple(("" if v is None else str(v)) for v in t))
