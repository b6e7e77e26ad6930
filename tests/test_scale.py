"""What a run leaves on the disk, and how many rows its steps move."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from profilelake.functions import cleaning as cl
from profilelake.functions import geo, levels
from profilelake.operators import nearest, vectors
from profilelake.session import fresh_path, writing
from profilelake.sources import fixtures, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(filter(lambda f: "shuffle_" in f, disk.getAllFiles().mkString("\n").split("\n")))


def test_a_write_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = spark.range(2000).selectExpr("id", "id % 7 as part").repartition(5, "part")
    settings = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled",
                "spark.sql.maxConcurrentOutputFileWriters")
    were = [spark.conf.get(s, None) for s in settings]
    got = tables.write_table(df, fresh_path(spark, "scale"), "part", writers=7)
    assert got.count() == 2000 and [spark.conf.get(s, None) for s in settings] == were
    own = tables.write_table(df.groupBy("part").count(), fresh_path(spark, "scale"))
    assert own.count() == 7
    for _ in range(50):
        left = {f for f in shuffle_files(spark) - before if f.endswith(".data")}
        if len(left) <= 16:  # those of the two counts
            break
        time.sleep(0.2)
    with writing(spark):
        df.repartition(31).write.format("noop").mode("overwrite").save()
    time.sleep(2)
    assert len({f for f in shuffle_files(spark) if f.endswith(".data")} - before) <= len(left)


def test_writers_replace_the_sort(spark):
    df = spark.range(100).selectExpr("id", "id % 3 as part")
    path = fresh_path(spark, "writers")
    tables.write_table(df, path, "part", writers=3)
    assert tables.read_table(spark, path).groupBy("part").count().count() == 3


@pytest.mark.parametrize("limit", [0, 1, 500_000])
def test_replaced_rows_equal_a_merge(spark, monkeypatch, limit):
    monkeypatch.setattr(tables, "SHARED_KEYS", limit)
    old = spark.createDataFrame(
        [(f"p{i}", i, f"o{i}" if i % 2 else None) for i in range(40)], "id string, v int, opt string")
    new = spark.createDataFrame(
        [(f"p{i}", None if i % 5 == 0 else -i, f"n{i}" if i % 3 == 0 else None, i * 0.5)
         for i in range(20, 60)], "id string, v int, opt string, more double")
    got = tables.replace_rows(old, new, "id", ["opt"])
    want = tables.merge_rows(old, new, ["id"], ["opt"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_rows_that_share_ids_meet_the_stored_fields_in_their_shuffle(spark):
    """The wide rows of a batch lie by id after they are ranked: no second exchange of them."""
    rows = spark.range(50).selectExpr("concat('p', id % 20) as id", "id as v", "string(null) as opt")
    old = spark.range(30).selectExpr("concat('p', id) as id", "id as v", "concat('o', id) as opt")
    monkey = tables.SHARED_KEYS
    tables.SHARED_KEYS = 0
    try:
        once = tables.latest_rows(rows, ["id"], ["v"])
        text = plan(tables.fill_optional(once, old, "id", ["opt"]))
    finally:
        tables.SHARED_KEYS = monkey
    assert text.count("Exchange hashpartitioning") <= 2


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(120, 6))
    base[30:60] = base[0]
    base[70] = 0
    rows = [(f"d{i:03}", v.tolist(), "xy"[i % 2]) for i, v in enumerate(base)]
    return spark.createDataFrame(
        rows, "id string, embedding array<float>, collection string").repartition(5)


@pytest.mark.parametrize("by", [None, "collection"])
def test_few_queries_find_what_many_find(spark, corpus, by, monkeypatch):
    monkeypatch.setattr(vectors, "ROWS_PER_BLOCK", 8)
    asked = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(np.eye(6)[:3])], "query_id int, vector array<float>")
    few = vectors.semantic_search(corpus, asked, 40, by=by, few=True)
    many = vectors.semantic_search(corpus, asked, 40, by=by)
    assert few.columns == many.columns and few.dtypes == many.dtypes
    assert sorted(map(tuple, few.collect()), key=repr) == sorted(map(tuple, many.collect()), key=repr)


def test_few_queries_move_no_rows(spark, corpus):
    asked = spark.createDataFrame([(0, [1.0] * 6)], "query_id int, vector array<double>")
    text = plan(vectors.semantic_search(corpus, asked, 3, few=True))
    before_window = text.split("Window")[-1]
    assert "_grp" not in text and "ROUND" in text.upper() or "MapInArrow" in text
    assert before_window.count("Join") == 0
    hits = vectors.with_documents(vectors.semantic_search(corpus, asked, 3, few=True), corpus, ["id"])
    assert "BroadcastHashJoin" in plan(hits) and hits.count() == 3
    assert vectors.semantic_search(corpus, asked.limit(0), 3, few=True).count() == 0
    assert vectors.semantic_search(corpus.limit(0), asked, 3, few=True).count() == 0


def test_vectors_of_different_lengths_fail(spark):
    rows = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0] * 4)], "id string, embedding array<float>")
    asked = spark.createDataFrame([(0, [1.0, 1.0, 1.0])], "query_id int, vector array<double>")
    with pytest.raises(Exception, match="lengths"):
        vectors.semantic_search(rows.coalesce(1), asked, 1, few=True).collect()


def test_a_point_meets_few_cells_at_each_level(spark):
    assert geo.SPLIT ** nearest.LEVELS == 256
    # the nine cells around a point, in the parts of one level
    assert 9 * geo.SPLIT ** 2 <= 150


def test_landing_files_do_not_grow_in_number_with_the_tasks_of_raw_profiles(spark, sf_dir, monkeypatch):
    import query_registry

    monkeypatch.setattr(fixtures, "TASK_ROWS", 20)
    monkeypatch.setattr(query_registry, "_landings", {})
    root = query_registry.landing_zone(spark, sf_dir)
    files = [f for _, _, names in os.walk(root) for f in names if f.endswith(".parquet")]
    assert len(files) <= spark.sparkContext.defaultParallelism * 8


def test_ragged_calibration_and_history(spark):
    none = "cast(null as array<string>)"
    given = {f"history_{c}": none for c in levels.HISTORY_TEXT}
    given |= {f"history_{c}": "cast(null as array<double>)" for c in levels.HISTORY_NUMBERS}
    given |= {"history_date": "array('20000102030405')", "history_step": "array(' a ', 'b', 'beyond')",
              "history_institution": "array('IF', ' ')", "history_start_pres": "array(99999e0, 1e0)",
              "calib_parameter": "array(array('P ', '', 'T'), array('S'))",
              "calib_equation": "array(array(' e ', 'x'))", "calib_coefficient": "array(array('', 'c', 'd', 'beyond'))",
              "calib_comment": "cast(null as array<array<string>>)", "calib_date": "array(array('bad'), array('19991231235959'))"}
    row = spark.range(1).selectExpr(*(f"{v} as {k}" for k, v in given.items()))
    got = row.selectExpr(f"{levels.flatten_history()} as h", f"{levels.flatten_calibration()} as c").first()
    assert [(r.institution, r.step, str(r.date), r.start_pres, r.action) for r in got.h] == [
        ("IF", "a", "2000-01-02 03:04:05", None, None)]
    assert [(r.parameter, r.equation, r.coefficient, r.comment, r.date and str(r.date)) for r in got.c] == [
        ("P", "e", None, None, None), ("T", None, "d", None, None), ("S", None, None, None, "1999-12-31 23:59:59")]


def test_lambdas_hold_no_list_tests(spark):
    assert " in (" not in cl.clean_numeric("x")
    assert "arrays_zip" not in levels.filter_levels("levels", "file_type")
