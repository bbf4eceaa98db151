import __spark_entry__ as entry
from adlens.plans.registry import QUERIES


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.count() == 328                      # FIXTURES.md section 7, sf0.001
    assert "roas" in df.columns


def test_every_query_of_the_reports_has_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(o)


def test_no_query_name_is_reserved():
    for name in QUERIES:
        assert "pipeline" not in name and not name.startswith("op")
