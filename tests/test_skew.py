"""One float holds a third of all profiles: the same results, spread over tasks."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from profilelake.operators import lookup, rollup, series


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(2)
    rows = []
    for i in range(9000):
        name = "hot" if i % 3 == 0 else f"f{i % 700}"
        rows.append((f"{name}_{i}", name, i if i % 50 else None, float(i % 80), float(i % 110),
                     rng.choice("DRA")))
    rng.shuffle(rows)
    df = spark.createDataFrame(
        rows, "profile_id string, platform_number string, cycle_number int, latitude double, "
              "longitude double, data_mode string",
    ).selectExpr(
        "*", "timestamp_ntz'2000-01-01' + make_dt_interval(coalesce(cycle_number, 0)) as timestamp",
        "'p' as project_name", "'n' as pi_name", "'t' as platform_type", "'w' as wmo_inst_type",
        "'d' as data_centre", "1 as n_levels", "array('PRES') as station_parameters",
        "array('DOXY') as bgc_parameters",
    ).repartition(12)
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r[2] if r[2] is not None else -1, r[0]))
    return df, {k: sorted(v) for k, v in by.items()}


def test_float_profiles(skewed):
    df, by = skewed
    got = lookup.float_profiles(df, df.limit(0), limit=4).collect()
    listed = defaultdict(list)
    for r in sorted(got, key=lambda r: r.position):
        listed[r.platform_number].append(r.profile_id)
        assert (r.total_core, r.total_bgc) == (len(by[r.platform_number]), 0)
    assert listed == {k: [p for _, p in v[:4]] for k, v in by.items()}


def test_trajectory(skewed):
    df, by = skewed
    rows = series.trajectory(df).collect()
    assert len(rows) == 9000
    assert {r.platform_number: r.profile_id for r in rows if r.is_start} == {
        k: v[0][1] for k, v in by.items()}
    assert {r.platform_number: r.profile_id for r in rows if r.is_end} == {
        k: v[-1][1] for k, v in by.items()}


def test_rollup(skewed):
    df, by = skewed
    got = {r.platform_number: r for r in rollup.build_floats(df, df).collect()}
    assert {k: r.total_cycles for k, r in got.items()} == {k: len(v) for k, v in by.items()}
    assert got["hot"].bgc_cycles == 3000 and got["hot"].data_modes_used == ["A", "D", "R"]


def test_repeated_requests_for_one_profile(spark, skewed):
    df, by = skewed
    wanted = spark.createDataFrame([("hot_3",)] * 5000 + [("f1_1",), ("f2_2",)], "profile_id string")
    got = lookup.lookup_profiles(df, df.limit(0), wanted, ["platform_number"])
    assert got.where("requested_id = 'hot_3'").count() == 5000
    assert got.where("requested_id <> 'hot_3'").count() == 2


def test_orders_are_dealt_evenly_whatever_the_row_groups(spark, tmp_path):
    """One row group in many splits: all rows used to be cleaned in the one task that holds it."""
    import pyarrow.parquet as pq

    from profilelake.sources import fixtures

    orders = pq.read_table("/root/testdata/sf0.001/orders.parquet")
    pq.write_table(orders, tmp_path / "orders.parquet", row_group_size=len(orders))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for n in names:
            spark.conf.set(n, "1024")
        rows = fixtures.bronze(spark, str(tmp_path))
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == fixtures.bronze(spark, "/root/testdata/sf0.001").count()
        assert max(sizes) < 2 * len(orders) / spark.sparkContext.defaultParallelism
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)
