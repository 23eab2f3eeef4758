import __spark_entry__ as E  # noqa: E402
from cellscope.plans.catalog import load_all


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"region_id", "produce_hour", "user_count"}
    assert df.count() > 0


def test_every_query_has_oracle_or_is_known_rows_only():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    # Every query of this library's own plans has SQL.
    assert set(load_all()) - set(sql) == set()
