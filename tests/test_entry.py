"""Driver contract: entry(), queries() and oracle_sql() on the smallest tables."""

import collections
import decimal

import pytest

import __spark_entry__ as ent
from adlens.plans import adhoc as Z
from support import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_flagship(spark):
    df = ent.entry(spark)
    rows = df.collect()
    assert df.columns == ["room_count", "ad_count", "min_price", "max_price", "price_range", "avg_price", "is_total"]
    total = [r for r in rows if r["is_total"]][0]
    assert total["ad_count"] == sum(r["ad_count"] for r in rows if not r["is_total"]) > 0


def test_every_oracle_has_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())


def _norm(v):
    return ("dec", str(v)) if isinstance(v, decimal.Decimal) else v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ent.oracle_sql()))
def test_query_matches_oracle_small(spark, duck, name):
    con = duck
    df = ent.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = collections.Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(ent.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    want = collections.Counter(tuple(_norm(r[ocols.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_adhoc_sql_is_read_only(spark):
    df = spark.range(5).withColumnRenamed("id", "days_listed")
    assert Z.run_sql(spark, "-- count\nSELECT count(*) AS n FROM removed_ads", {"removed_ads": df}).first()["n"] == 5
    for text, want in (("SELECT '/* c */' AS x", "/* c */"), ("SELECT 'a -- b' AS x", "a -- b"), ("SELECT ';' AS x", ";"),
                       ("WITH t AS (SELECT 3 AS x) SELECT x FROM t /* tail */", 3), ("FROM VALUES (7) AS t(x) SELECT x", 7)):
        assert Z.run_sql(spark, text).first()["x"] == want
    spark.range(3).createOrReplaceTempView("three_rows")
    for bad in ("DROP VIEW removed_ads", "INSERT INTO x VALUES (1)", "SELECT 1; DROP VIEW removed_ads", "not sql",
                "FROM three_rows INSERT INTO tgt SELECT id", "WITH x AS (SELECT 1 AS id) INSERT INTO tgt SELECT id FROM x",
                "FROM three_rows INSERT OVERWRITE tgt SELECT id", "CREATE TABLE tgt AS SELECT 1", "SET spark.sql.ansi.enabled=false",
                "CACHE TABLE three_rows", "EXPLAIN SELECT 1", "DELETE FROM tgt", "UPDATE tgt SET id = 1", "SHOW TABLES"):
        with pytest.raises(Z.NotAQuery):
            Z.run_sql(spark, bad)
    info = Z.table_info(spark, "removed_ads").collect()
    assert [(r["column_name"], r["data_type"]) for r in info] == [("days_listed", "bigint")]
