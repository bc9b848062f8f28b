"""Every SQL-expressible catalog query equals its DuckDB oracle (sf0.001)."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

from oracle_check import compare  # noqa: E402

from riskspark.plans import catalog, extra  # noqa: E402,F401
from tests.conftest import SMALL  # noqa: E402

NAMES = sorted(catalog.ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, name):
    _, status, _, _, detail = compare(spark, duck_small, name, SMALL)
    assert status == "ok", detail


def test_entry_contract(spark):
    import __spark_entry__ as entry

    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["sample_size"] > 0
