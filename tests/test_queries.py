"""Every query of the catalogue against its DuckDB equivalent on the smallest tables."""

import glob
import hashlib
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from hustings import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v != v:
            return None
        return f"{v:.6f}" if isinstance(v, float) else str(v)

    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).values.tolist()), key=str)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, duck, name):
    got, want = queries.queries()[name](spark, SF).toPandas(), duck.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    whole = lambda df: df.apply(lambda c: c.astype("float64") if c.dtype.kind in "iu" else c)
    assert rows(whole(got)) == rows(whole(want))


def test_tokens_join_to_the_text(spark):
    got = queries.queries()["phrase_tokens"](spark, SF).toPandas().sort_values(["doc_id", "seq"]).groupby("doc_id").token.agg("".join)
    want = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id").text
    assert got.to_dict() == {k: v for k, v in want.items() if v}


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_time_filter_reaches_the_scan(spark):
    plan = queries.queries()["date_range"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_interval_join_has_no_nested_loop(spark):
    plan = queries.queries()["interval_join"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_cascade_holds_every_candidate(spark, tmp_path):
    parts = [(i, "hot", "Brand#1", "T") for i in range(1, 8)] + [(8, "own", "Brand#2", "T")]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    run = lambda name: queries.queries()[name](spark, str(tmp_path)).collect()
    members = {}
    for r in run("alias_members"):
        members.setdefault((r.priority, r.class_id), set()).add(r.found)
    found = {r.id - 1000000: (r.priority, members[r.priority, r.class_id]) for r in run("cascade_join")}
    every = set(range(1, 9))
    assert found == {i: (3, every) if i == 5 else (2, {8}) if i == 8 else (1 if i % 3 == 0 else 2, set(range(1, 8))) for i in every}
    counts = {r.id - 1000000: (r.n_candidates, r.status, r.match) for r in run("match_status")}
    assert counts == {i: (8, "multiple", None) if i == 5 else (1, "match", 8) if i == 8 else (7, "multiple", None) for i in every}


def test_range_join_counts_windows_of_all_customers(spark, tmp_path):
    import datetime

    day = datetime.datetime(1995, 1, 8)
    spark.createDataFrame([(1, 39, day), (2, 40, day), (3, 5000, day), (4, 5000, day + datetime.timedelta(days=1))], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1,), (2,), (9,)], "event_id long").write.parquet(str(tmp_path / "events.parquet"))
    got = queries.queries()["range_join"](spark, str(tmp_path)).collect()
    assert sorted((r.event_id, r.n) for r in got) == [(1, 3), (2, 4)]


def test_slugs_of_whole_texts_in_any_letters(spark, tmp_path):
    long = "word " * 40
    spark.createDataFrame([(1, long + "End!"), (2, "Élan vital"), (3, "a  b")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.digest for r in queries.queries()["slugify_ascii"](spark, str(tmp_path)).collect()}
    assert got == {i: hashlib.md5(slug.encode()).hexdigest() for i, slug in ((1, "word-" * 40 + "end"), (2, "elan-vital"), (3, "a-b"))}
