import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import canon

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_oracle_sql_runs(con):
    for name, sql in E.oracle_sql().items():
        con.execute(f"SELECT count(*) FROM ({sql}) q").fetchall()


@pytest.mark.parametrize("name", ["user_bitmap_index", "stay_user_count", "portrait_bitmaps",
                                  "segment_matrix", "region_flow", "persona_running",
                                  "parse_rejects", "parse_rejects_signals", "parse_rejects_users",
                                  "parse_rejects_cells", "dim_latest_per_key", "dim_ttl",
                                  "stay_id_sets", "users_json_empty", "job_hourly_stay",
                                  "stream_persona_window_late", "stream_dim_refresh"])
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got, got_cols = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    want, want_cols = canon([d[0] for d in cur.description], cur.fetchall())
    assert got_cols == want_cols
    assert got == want
