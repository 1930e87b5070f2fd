import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wagerlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Thousands of tiny plans: the light compiler warms up faster than it loses; their code needs room.
    session = local_session("8", 2, "wagerlens-tests", java_options="-XX:TieredStopAtLevel=1 -XX:ReservedCodeCacheSize=512m")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame('id string, n bigint', (..), (..)) -> DataFrame; timestamps may be given as text."""

    def make(schema: str, *rows):
        from pyspark.sql import functions as F

        wanted = [part.strip().split(" ", 1) for part in schema.replace("(18,2)", "(18;2)").split(",")]
        wanted = [(n, t.replace(";", ",")) for n, t in wanted]
        loose = ", ".join(f"{n} {'string' if t in ('timestamp', 'date') or t.startswith('decimal') else t}" for n, t in wanted)
        text = [
            tuple(str(v) if v is not None and (t in ("timestamp", "date") or t.startswith("decimal")) else v
                  for v, (_, t) in zip(row, wanted))
            for row in rows
        ]
        df = spark.createDataFrame(text, loose)
        return df.select(*[F.col(n).cast(t).alias(n) for n, t in wanted])

    return make


def rows(df, *cols):
    """Rows as sorted tuples, decimals as plain numbers."""
    picked = df.select(*cols) if cols else df
    return sorted(
        (tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in picked.collect()),
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )
