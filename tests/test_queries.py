"""Every base query against its SQL on the smallest driver tables."""

import os

import duckdb
import pytest

from chatlake import queries as Q

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def normal(rows):
    show = lambda v: "null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(show, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, duck, name):
    df = Q.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = [tuple(r) for r in df.select(*names).collect()]
    assert got
    if name in Q.SQL:
        rel = duck.sql(Q.SQL[name])
        assert sorted(rel.columns) == names
        assert normal(got) == normal(duck.sql(f"SELECT {', '.join(names)} FROM ({Q.SQL[name]})").fetchall())


def test_metrics_of_averages_that_end_in_five(spark, tmp_path):
    con = duckdb.connect()  # the sixteenth and last shortest digit is 5: 40/9 lies below, 41/9 above
    con.execute("CREATE TABLE documents AS SELECT i AS doc_id, 's' || i % 3 AS source, CASE WHEN i < 3 THEN 40 + i ELSE 0 END AS n_chars FROM range(27) r(i)")
    con.execute("CREATE TABLE labels AS SELECT doc_id, 1 AS quality, 0 AS toxic FROM documents WHERE doc_id % 2 = 0")
    for name in ("documents", "labels"):
        con.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet'")
    got = Q.metrics_text(spark, str(tmp_path)).select("line", "metric", "place", "type").collect()
    assert normal(got) == normal(con.sql(f"SELECT line, metric, place, type FROM ({Q.SQL['metrics_text']})").fetchall())
    assert 'chatlake_run_duration_seconds{workspace="s0"} 4.44444444444444' in {r["line"] for r in got}
