"""The tools by name."""

import json

import pytest

from profilelake.plans.engine import Engine
from profilelake.operators import lookup, rollup, series, stats


@pytest.fixture(scope="module")
def engine(spark, sf_dir, store):
    from query_registry import embedded

    embedded(spark, sf_dir)
    return Engine(store)


@pytest.fixture(scope="module")
def some_ids(lake):
    core = [r[0] for r in lake.profiles.where("n_levels > 3 and cycle_number is not null")
            .orderBy("profile_id").select("profile_id").limit(3).collect()]
    bgc = lake.bgc_profiles.where("n_levels > 3").orderBy("profile_id").first().profile_id
    return core, bgc


def test_lookup_falls_back_in_order(lake, some_ids):
    core, bgc = some_ids
    wanted = [core[0], bgc, bgc.removesuffix("_BGC"), "nobody_001", core[0]]
    got = lookup.lookup_profiles(lake.profiles, lake.bgc_profiles, wanted, []).collect()
    assert sorted((r.position, r.profile_id) for r in got) == [
        (0, core[0]), (1, bgc), (2, bgc), (4, core[0])]


def test_ids_of_any_number_keep_their_order(spark, lake, some_ids):
    core, bgc = some_ids
    many = ["x"] * 10_001 + [core[1], bgc]
    got = lookup.lookup_profiles(lake.profiles, lake.bgc_profiles, many, []).collect()
    assert sorted((r.position, r.profile_id) for r in got) == [(10_001, core[1]), (10_002, bgc)]
    frame = spark.createDataFrame(list(zip(many, range(len(many)))), "profile_id string, position int")
    got = series.ts_spec(lake.profiles, lake.bgc_profiles, frame).collect()
    assert sorted((r.position, r.profile_id) for r in got) == [(10_001, core[1]), (10_002, bgc)]
    assert lookup.lookup_profiles(lake.profiles, lake.bgc_profiles, [], []).count() == 0


def test_ids_and_years_reach_the_scan(lake, some_ids):
    def scans(df):
        df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10_000)
        return df._jdf.queryExecution().executedPlan().toString()

    found = scans(lookup.profile_data(lake.profiles, lake.bgc_profiles, some_ids[0][:1]))
    assert f"EqualTo(profile_id,{some_ids[0][0]})" in found
    rows = scans(stats.aggregate_statistics(
        lake.profiles, lake.bgc_profiles, 0, 100, "temp", "1996-01-01", "1997-01-01"))
    assert "(year#" in rows.split("PartitionFilters: [")[1].split("]")[0]


def test_any_level_field_can_be_drawn(engine, some_ids):
    core, bgc = some_ids
    assert engine.profile_depth_series(bgc, "chla_fluorescence").count() >= 0
    rows = engine.profile_depth_series(core[0], "temp,temp_adjusted,temp_qc").collect()
    assert {r.parameter for r in rows} <= {"temp", "temp_adjusted", "temp_qc"}
    with pytest.raises(ValueError):
        engine.profile_depth_series(core[0], "salt")


def test_bgc_search_without_documents(spark, sf_dir):
    from profilelake.plans import ingest
    from profilelake.session import fresh_path
    from profilelake.sources import fixtures

    store = ingest.Store(spark, fresh_path(spark, "no-documents"))
    ingest.ingest(store, fixtures.bronze(spark, sf_dir))
    got = Engine(store).search_bgc_profiles("doxy", 3).collect()
    assert [r.rank for r in got] == [1, 2, 3] and got == sorted(got, key=lambda r: r.profile_id)


def test_profile_data_adjusted_falls_back_only_without_variable(spark):
    level = "struct<pres:double,temp:double,temp_qc:int,temp_adjusted:double,temp_adjusted_qc:int>"
    rows = [("a", ["temp", "temp_adjusted"], [(None, 5.0, 1, None, 2)]), ("b", ["temp"], [(1.0, 6.0, 1, None, None)])]
    df = spark.createDataFrame(rows, f"profile_id string, available_vars array<string>, measurements array<{level}>")
    df = df.selectExpr("*", "'p' as platform_number", "1 as cycle_number", "1 as n_levels",
                       "cast(null as timestamp_ntz) as timestamp", "1D as latitude", "1D as longitude",
                       "array('TEMP') as station_parameters", "'D' as data_mode", "1D as max_pres")
    got = {r.profile_id: (r.depth_m, r.temp, r.temp_qc) for r in
           lookup.profile_data(df, df.limit(0), ["a", "b"], "temp, pres", True).collect()}
    assert got == {"a": (None, None, 2), "b": (1.0, 6.0, None)}


def test_unknown_parameter_is_rejected(engine, some_ids):
    with pytest.raises(ValueError):
        engine.get_profile_data(some_ids[0][0], "temp,chla_fluorescence")
    with pytest.raises(ValueError):
        engine.aggregate_statistics(0, 10, "salt")
    with pytest.raises(ValueError):
        engine.scatter_series(some_ids[0], "temp", "x")


def test_statistics_without_data_and_bad_dates(engine):
    assert engine.aggregate_statistics(-5, -1).count() == 0
    whole = engine.aggregate_statistics(0, 5000, "pres").first()
    assert whole == engine.aggregate_statistics(0, 5000, "pres", "soon", "later").first()
    assert whole["count"] > 0


def test_nested_and_flat_statistics_agree(lake):
    flat = lookup.explode_levels(
        lake.profiles, ["profile_id", "timestamp"], ["pres", "temp"]
    ).select("profile_id", "timestamp", "m.*")
    args = (100, 250, "temp", "1996-02", "2000-01-01")
    assert stats.level_statistics(flat, *args).collect() == stats.aggregate_statistics(
        lake.profiles, lake.bgc_profiles, *args).collect()


def test_float_tools(engine, lake):
    name = lake.floats.where("has_bgc and total_cycles > 3").orderBy("platform_number").first().platform_number
    info = engine.get_float_info(name).collect()
    assert len(info) == 1 and info[0].platform_number == name
    listed = engine.get_float_profiles(name, 2).collect()
    assert {r.source for r in listed} == {"core", "bgc"}
    assert max(r.position for r in listed) <= 2
    assert len({(r.total_core, r.total_bgc) for r in listed}) == 1
    path = engine.float_trajectory(name).collect()
    assert path[0].is_start and path[-1].is_end and sum(r.is_start for r in path) == 1
    spec = json.loads(engine.visualize_float_trajectory(name).first().chart_spec)
    assert spec["type"] == "map_trajectory" and spec["params"]["platform_number"] == name
    assert engine.get_float_info("nobody").count() == 0


def test_search_tools(engine):
    hits = engine.search_profiles("profiles in the Arabian Sea", 4).collect()
    assert len(hits) == 4 and all(len(h.summary) <= 200 for h in hits)
    bgc = engine.search_bgc_profiles("doxy", 3).collect()
    assert len(bgc) == 3 and all(h.profile_id.endswith("_BGC") for h in bgc)
    assert engine.search_bgc_profiles("nitrate", 3).count() == 0
    where = {"region": "Arabian Sea"}
    assert {h.metadata.region for h in engine.query_all("floats", 3, where).collect()} == {"Arabian Sea"}
    assert {r.collection for r in engine.get_stats().collect()} == {"profiles", "bgc_profiles", "floats"}


def test_chart_specs_keep_input_order(engine, some_ids):
    core, bgc = some_ids
    wanted = [core[2], bgc, core[0], "nobody"]
    spec = json.loads(engine.visualize_ts_diagram(wanted).first().chart_spec)
    assert spec["params"]["profile_ids"] == [core[2], bgc, core[0]]
    assert len(spec["params"]["labels"]) == 3
    assert engine.visualize_ts_diagram(wanted).first().summary == (
        f"T-S Diagram for 3 profile(s): {core[2]}, {bgc}, {core[0]}.")
    assert engine.map_marker_display(wanted).first().summary == "Map with 3 profile markers."
    spec = json.loads(engine.compare_profiles_depth(wanted, "TEMP").first().chart_spec)
    assert spec["params"]["parameter"] == "temp"
    spec = json.loads(engine.visualize_parameter_scatter(wanted, "temp", "doxy").first().chart_spec)
    assert spec["params"]["param_y"] == "doxy"
    spec = json.loads(engine.map_marker_display(wanted).first().chart_spec)
    assert [x["profile_id"] for x in spec["params"]["locations"]] == [core[2], bgc, core[0]]
    assert engine.visualize_ts_diagram(["nobody"]).count() == 0


def test_series_of_some_profiles(engine, some_ids):
    core, bgc = some_ids
    rows = engine.profile_depth_series(core[0], "temp,psal").collect()
    assert {r.parameter for r in rows} == {"temp", "psal"}
    assert {r.profile_id for r in engine.comparison_series([*core, bgc]).collect()} <= {*core, bgc}
    assert engine.map_markers([bgc]).first().profile_id == bgc
    assert engine.ts_series(core).count() > 0


def test_union_of_bgc_parameters(spark):
    df = spark.createDataFrame(
        [("f", "a", ["DOXY"]), ("f", "b", ["CHLA", "DOXY"]), ("f", "c", None)],
        "platform_number string, profile_id string, bgc_parameters array<string>",
    ).selectExpr("*", "cast(null as timestamp_ntz) as timestamp", "1D as latitude", "1D as longitude")
    assert rollup.float_bgc_rollup(df).first().bgc_parameters == ["DOXY"]
    assert rollup.float_bgc_rollup(df, union=True).first().bgc_parameters == ["CHLA", "DOXY"]


def test_only_new_texts_are_embedded(engine, store):
    def vectors_of(df):
        return {(r.collection, r.id): r.embedding for r in df.select("collection", "id", "embedding").collect()}

    before = vectors_of(store.read("documents"))
    other = Engine(store, lambda: lambda texts: [[1.0, 2.0]] * len(texts))
    assert vectors_of(other.build_embeddings("floats")) == before
