"""Every registered query agrees with its SQL."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import TABLES, compare

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, con, sf_dir, name):
    said, _ = compare(spark, con, name, contract.queries()[name], ORACLES.get(name), sf_dir)
    assert said.startswith(("ok", "rows-only")), said


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_log_queries_tell_what_happened(spark, sf_dir):
    rows = contract.queries()["processing_log"](spark, sf_dir).orderBy("seq").collect()
    messages = [r.message for r in rows]
    assert all(m.startswith("[File 1] ") for m in messages)
    assert any("Converted 'price' to numeric" in m for m in messages)
    assert any(m.endswith("No duplicate rows found") for m in messages)
    assert any("rows with nil values in 'priority'" in m for m in messages)
    assert messages[-1] == "[File 1] Dropped columns: ['is_urgent']"
    head = contract.queries()["log_head"](spark, sf_dir).collect()
    assert [r.seq for r in head] == list(range(8)) and {r.more for r in head} == {len(rows) - 8}
