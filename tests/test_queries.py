"""Every registered query against its SQL, and the plans of the main ones."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, sf_dir, duck, name):
    df = contract.queries()[name](spark, sf_dir)
    rows = df.collect()
    assert rows
    if name not in contract.oracle_sql():
        return
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in names) for r in rows), key=repr)
    theirs = sorted((tuple(map(plain, r)) for r in cursor.fetchall()), key=repr)
    assert mine == theirs


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    return df._jdf.queryExecution().executedPlan().toString()


def run(spark, sf_dir, name):
    return plan(contract.queries()[name](spark, sf_dir))


def test_statistics_read_two_level_fields_and_shuffle_one_row(spark, lake):
    from profilelake.operators import stats

    text = plan(stats.aggregate_statistics(
        lake.profiles, lake.bgc_profiles, 0, 100, "temp", "1996-01-01", "1997-01-01"))
    assert "measurements:array<struct<pres:double,temp:double>>" in text
    assert "GreaterThanOrEqual(timestamp" in text
    assert "hashpartitioning" not in text and text.count("Exchange SinglePartition") == 1


def test_depth_range_reaches_the_flat_scan(spark, sf_dir):
    text = run(spark, sf_dir, "aggregate_statistics_levels")
    assert "GreaterThanOrEqual(l_quantity,5.0)" in text and "LessThanOrEqual(l_quantity,40.0)" in text


@pytest.mark.parametrize("name", [
    "nearest_join", "lookup_profile", "semantic_search", "search_all", "trajectory",
    "float_profiles", "build_floats", "upsert_documents",
])
def test_no_cross_joins(spark, sf_dir, name):
    text = run(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["nearest_join", "float_profiles", "semantic_search", "lookup_profile"])
def test_rows_are_limited_before_the_shuffle(spark, sf_dir, name):
    assert "WindowGroupLimit" in run(spark, sf_dir, name)


def test_summary_scan_reads_no_levels(spark, sf_dir):
    assert "measurements" not in run(spark, sf_dir, "profile_summary")


def test_entry(spark):
    assert contract.entry(spark).count() == 2
