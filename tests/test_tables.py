"""Merges, snapshots, quarantine and the streaming run."""

from pyspark.sql import functions as F

from profilelake.operators.normalize import bgc_profiles, core_profiles, normalize, quarantine
from profilelake.plans import ingest
from profilelake.schema import BRONZE
from profilelake.session import fresh_path
from profilelake.sources import documents as docstore
from profilelake.functions.geo import square
from profilelake.sources import fixtures, landing, tables
from profilelake.streaming.ingest import merge_changes, stream_ingest

VOLATILE = ["ingested_at", "year"]


def rows(df):
    return sorted(map(repr, df.drop(*VOLATILE).collect()))


def test_merge_is_field_wise(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, o string")
    new = spark.createDataFrame([("b", None, None), ("c", 3, "z")], "k string, v int, o string")
    got = {r.k: (r.v, r.o) for r in tables.merge_rows(old, new, ["k"], ["o"]).collect()}
    assert got == {"a": (1, "x"), "b": (None, "y"), "c": (3, "z")}


def test_latest_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, "w")],
                               "k string, v int, o string")
    assert {(r.k, r.o) for r in tables.latest_rows(df, ["k"], ["v"]).collect()} == {
        ("a", "y"), ("b", "w")}


def test_few_shared_keys_are_folded_apart(spark, monkeypatch):
    df = spark.createDataFrame(
        [(f"k{i}", i, "lone") for i in range(200)] + [(None, 1, "x"), (None, 2, "y")]
        + [("hot", i, f"h{i}") for i in range(90)] + [("k3", 9, "later"), ("k3", 9, "later")],
        "k string, v int, o string").repartition(6)

    def newest(rows):
        return tables.latest_rows(rows, ["k"], ["v", "o"])

    want = sorted(map(repr, newest(df).collect()))
    for part in (0.1, 0.0):  # folded apart, and all rows at once
        monkeypatch.setattr(tables, "SHARED_PART", part)
        got = tables.fold_shared(df, ["k"], newest)
        assert got.columns == df.columns
        assert sorted(map(repr, got.collect())) == want
        assert ("Union" in got._jdf.queryExecution().toString()) == (part > 0)
    assert tables.fold_shared(df.limit(0), ["k"], newest).collect() == []


def test_rows_without_a_partner_are_not_ranked(spark):
    bronze = raw(spark).unionByName(raw(spark, cycle_number=2.0))
    lone = ingest.one_per_id(normalize(bronze))
    assert lone.count() == 2
    plan = lone._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


def test_first_delivery_is_written_once(spark):
    store = ingest.Store(spark, fresh_path(spark, "first"))
    bronze = raw(spark).unionByName(raw(spark, source_file="SD1.nc")).unionByName(
        raw(spark, source_file="R0.nc", project_name="earlier name"))
    run = ingest.ingest(store, bronze)
    report = {r.measure: r["rows"] for r in ingest.run_report(store, run).collect()}
    assert (report["written_profiles"], report["written_bgc_profiles"]) == (1, 1)
    assert (report["stored_profiles"], report["stored_bgc_profiles"]) == (1, 1)
    staged = ingest.read_staged(store, *[f"{store.path('staged')}/{run}"] * 2)
    # the profiles lie in their tables; the folder of the run names them
    assert [r.n for r in staged.selectExpr("count(profile_id) - count(source_file) as n").collect()] == [2]
    assert store.read("profiles").first().source_file == "R0.nc"


def test_upsert_twice_is_once(spark, sf_dir):
    store = ingest.Store(spark, fresh_path(spark, "twice"))
    profiles = core_profiles(normalize(fixtures.bronze(spark, sf_dir)))
    once = rows(ingest.upsert_profiles(store, "profiles", profiles))
    assert rows(ingest.upsert_profiles(store, "profiles", profiles)) == once


def test_rows_of_a_file_lie_by_place(spark):
    df = spark.range(4000).selectExpr(
        "concat('p', id) as profile_id", "concat('f', id % 50) as platform_number",
        "cast(id as int) as cycle_number", "timestamp_ntz'2001-02-03' as timestamp",
        "if(id % 99 = 0, null, id * 7 % 180 - 90e0) as latitude", "id * 11 % 360 - 180e0 as longitude")
    parts = tables.profile_layout(df).selectExpr(
        "spark_partition_id() as part", f"{square('latitude', 'longitude')} as square",
        "platform_number").collect()
    assert len(parts) == 4000
    for part in {r.part for r in parts}:
        mine = [(-1 if r.square is None else r.square, r.platform_number) for r in parts if r.part == part]
        assert mine == sorted(mine)


def test_incomplete_snapshot_is_not_read(spark):
    root = fresh_path(spark, "snapshots")
    first = tables.write_table(spark.range(3).toDF("k"), root)
    spark.range(9).toDF("k").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{root}/snapshot=2")
    assert tables.read_table(spark, root).count() == first.count() == 3
    assert tables.write_table(spark.range(5).toDF("k"), root).count() == 5


def raw(spark, **fields):
    known = {"profile_index": 0, "source_file": "D1.nc", "platform_number": "77", "cycle_number": 1.0}
    known |= fields
    return spark.createDataFrame([tuple(known.get(c) for c in BRONZE.names)], BRONZE)


def test_core_file_wins_and_collisions_are_counted(spark):
    batch = raw(spark, source_file="BD1.nc", project_name="bgc").unionByName(
        raw(spark, source_file="D1.nc", project_name="core")
    ).unionByName(raw(spark, source_file="D0.nc", project_name="older name"))
    profiles = normalize(batch)
    assert [r.project_name for r in ingest.one_per_id(profiles).collect()] == ["core"]
    assert tuple(ingest.collisions(profiles).first()) == (1, 2)


def test_levels_follow_pressure_and_station_list(spark):
    param = {"value": [1.0, 99999.0, 3.0], "qc": ["1", " ", None]}
    df = raw(spark, pres=param, temp={"value": [5.0]}, psal={"value": [None, None, 7.0, 8.0]},
             doxy={"value": [9.0, 9.0, 9.0]})
    row = normalize(df).first()
    assert [(m.pres, m.pres_qc, m.temp, m.psal, m.doxy) for m in row.measurements] == [
        (1.0, 1, 5.0, None, None), (3.0, -1, None, 7.0, None)]
    assert row.n_levels == 2 and row.max_pres == 3.0
    assert row.available_vars == ["pres", "pres_qc", "temp", "psal"]


def test_parameters_outside_the_catalogue_are_kept(spark):
    df = raw(spark, pres={"value": [1.0, 2.0, 3.0]},
             station_parameters=["PRES", "Turbidity "],
             other_params=[
                 {"name": "TURBIDITY", "value": [0.5, 99999.0], "qc": ["1"]},
                 {"name": "TILT", "value": [7.0]}, {"name": "temp", "value": [7.0]}])
    row = normalize(df).first()
    assert [[(o.name, o.value, o.qc, o.adjusted) for o in m.others] for m in row.measurements] == [
        [("turbidity", 0.5, 1, None)], [("turbidity", None, None, None)],
        [("turbidity", None, None, None)]]
    assert row.available_vars == ["pres", "turbidity", "turbidity_qc"]


def test_bgc_value_keeps_a_level(spark):
    fields = dict(pres={"value": [None, None]}, doxy={"value": [4.0, None]},
                  station_parameters=["PRES", "DOXY"])
    assert normalize(raw(spark, source_file="SD1.nc", **fields)).first().n_levels == 1
    assert normalize(raw(spark, source_file="D1.nc", **fields)).first().n_levels == 0


def test_no_pressure_no_levels(spark):
    row = normalize(raw(spark, temp={"value": [1.0]})).first()
    assert row.measurements == [] and row.n_levels == 0 and row.max_pres is None


def test_quarantine_reasons(spark):
    df = raw(spark, parse_error="broken").unionByName(raw(spark, profile_index=None)).unionByName(
        raw(spark, platform_number=" \x00"))
    got = {(r.error, r.file_failed) for r in quarantine(df).collect()}
    assert got == {("broken", True), ("no profiles in file", False), ("no platform number", False)}
    assert [r.error for r in ingest.first_errors(df).collect()] == ["broken"]


def test_scan_skips_other_folders_and_needs_the_root(spark, tmp_path):
    import pytest

    raw(spark).write.parquet(f"{tmp_path}/77/profiles")
    raw(spark, source_file=None).write.parquet(f"{tmp_path}/78/profiles")
    raw(spark).write.parquet(f"{tmp_path}/77/meta")
    names = [r.source_file for r in landing.scan_raw(spark, str(tmp_path)).collect()]
    assert len(names) == 2 and any(n.startswith("part-") for n in names)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landing.scan_raw(spark, f"{tmp_path}/none").count()


def test_stream_equals_batch_and_repeats_safely(spark, sf_dir):
    from query_registry import LANDING, landing_zone

    root = landing_zone(spark, sf_dir)
    batch = ingest.Store(spark, fresh_path(spark, "batch"))
    ingest.ingest(batch, fixtures.bronze(spark, sf_dir))
    stream = ingest.Store(spark, fresh_path(spark, "stream"))
    stream_ingest(stream, root, LANDING, files_per_batch=40)
    for table in ("profiles", "bgc_profiles", "floats"):
        assert rows(stream.read(table)) == rows(batch.read(table))
    assert rows(ingest.rejected_rows(stream).drop("run")) == rows(ingest.rejected_rows(batch).drop("run"))
    stream_ingest(stream, root, LANDING, files_per_batch=40)
    merge_changes(stream)
    assert rows(stream.read("floats")) == rows(batch.read("floats"))
    assert stream.read("profiles").count() == batch.read("profiles").count()


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, sf_dir):
    store = ingest.Store(spark, fresh_path(spark, "years"))
    ingest.ingest(store, fixtures.bronze(spark, sf_dir))
    before = store.read("profiles")
    stored = before.count()
    row = before.where("year = 1996").orderBy("profile_id").limit(1)
    bucket = row.first().bucket
    moved = row.drop("year", "bucket").withColumns({
        "timestamp": F.expr("timestamp_ntz'1997-07-01 00:00:00'"), "pi_name": F.lit("moved")})
    after = ingest.upsert_profiles(store, "profiles", moved)
    assert after.count() == stored
    assert [(r.year, r.bucket, r.pi_name) for r in after.join(row.select("profile_id"), "profile_id").collect()] == [
        (1997, bucket, "moved")]

    def files(df, touched):
        inside = (f"year=1996/bucket={bucket}/", f"year=1997/bucket={bucket}/")
        return {f for f in df.inputFiles() if any(p in f for p in inside) == touched}

    assert before.select("bucket").distinct().count() > 3
    assert files(after, False) == files(before, False) and files(before, False)
    assert not files(after, True) & files(before, True)
    # the snapshot the upsert wrote holds the touched buckets only
    newest = max(tables.complete_folders(spark, store.path("profiles"), "snapshot"))
    written = {f.split(f"snapshot={newest}/")[1].rsplit("/", 1)[0]
               for f in after.inputFiles() if f"snapshot={newest}/" in f}
    assert written <= {f"year=1996/bucket={bucket}", f"year=1997/bucket={bucket}"} and written
    undated = moved.withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    for _ in range(2):
        again = ingest.upsert_profiles(store, "profiles", undated)
        assert again.count() == stored and again.where("year is null and pi_name = 'moved'").count() == 1
    assert ingest.upsert_profiles(store, "profiles", undated.limit(0)).count() == stored


def test_one_float_rewrites_one_bucket_per_year(spark, sf_dir):
    store = ingest.Store(spark, fresh_path(spark, "float"))
    ingest.ingest(store, fixtures.bronze(spark, sf_dir))
    before = store.read("profiles")
    platform = before.groupBy("platform_number").count().orderBy(F.desc("count"), "platform_number").first()[0]
    mine = before.where(F.col("platform_number") == platform)
    years = {r.year for r in mine.select("year").distinct().collect()}
    changed = mine.drop("year", "bucket").withColumn("pi_name", F.lit("late correction"))
    after = ingest.upsert_profiles(store, "profiles", changed)
    newest = max(tables.complete_folders(spark, store.path("profiles"), "snapshot"))
    written = {f.split(f"snapshot={newest}/")[1].rsplit("/", 1)[0]
               for f in after.inputFiles() if f"snapshot={newest}/" in f}
    bucket = tables.platform_bucket(platform)
    assert written == {f"year={y}/bucket={bucket}" for y in years}
    assert after.where(F.col("pi_name") == "late correction").count() == mine.count()
    assert rows(after.where(F.col("platform_number") != platform)) == rows(
        before.where(F.col("platform_number") != platform))


def test_small_delivery_equals_one_large(spark, sf_dir):
    bronze = fixtures.bronze(spark, sf_dir)
    whole = ingest.Store(spark, fresh_path(spark, "whole"))
    ingest.ingest(whole, bronze)
    parts = ingest.Store(spark, fresh_path(spark, "parts"))
    half = "pmod(hash(source_file), 2) = {}"
    runs = [ingest.ingest(parts, bronze.where(half.format(i))) for i in (0, 1)]
    for table in ("bgc_profiles", "floats"):
        assert rows(parts.read(table)) == rows(whole.read(table))
    assert rows(parts.read("profiles").select("profile_id")) == rows(
        whole.read("profiles").select("profile_id"))
    report = {r.measure: r["rows"] for r in ingest.run_report(parts, runs[1]).collect()}
    assert report["stored_profiles"] == whole.read("profiles").count() > report["written_profiles"]
    assert ingest.rejected_rows(parts).count() == quarantine(bronze).count()
    assert {r.run for r in ingest.rejected_rows(parts).collect()} == set(runs)


def test_missing_id_is_made_up(spark):
    store = ingest.Store(spark, fresh_path(spark, "unnamed"))
    df = normalize(raw(spark)).withColumns({
        "profile_id": F.lit(None).cast("string"), "platform_number": F.lit(None).cast("string")})
    assert ingest.upsert_profiles(store, "profiles", df).first().profile_id == "UNK_001"


def test_stream_without_files_does_nothing(spark, tmp_path):
    store = ingest.Store(spark, fresh_path(spark, "nothing"))
    (tmp_path / "7" / "profiles").mkdir(parents=True)
    stream_ingest(store, str(tmp_path))
    assert not store.exists("profiles")


def test_fold_keeps_optional_fields(spark):
    from profilelake.schema import OPTIONAL_COLUMNS
    from profilelake.streaming.ingest import fold_changes

    df = spark.createDataFrame(
        [("a", 0, "old", ["DOXY"]), ("a", 1, "mid", ["CHLA"]), ("a", 2, None, None),
         ("b", 1, "only", None)],
        "profile_id string, batch int, pi_name string, bgc_parameters array<string>",
    ).withColumns({c: F.lit(None).cast("string") for c in OPTIONAL_COLUMNS if c != "bgc_parameters"})
    got = {r.profile_id: (r.pi_name, r.bgc_parameters) for r in fold_changes(df).collect()}
    assert got == {"a": (None, ["CHLA"]), "b": ("only", None)}


def test_documents_last_wins(spark):
    store = ingest.Store(spark, fresh_path(spark, "docs"))
    df = spark.createDataFrame(
        [("profiles", "a", "old", 1), ("profiles", "a", "new", 2), ("floats", "a", "f", 1)],
        "collection string, id string, document string, updated int",
    )
    docstore.upsert_documents(store, df)
    got = {(r.collection, r.id, r.document) for r in store.read("documents").collect()}
    assert got == {("profiles", "a", "new"), ("floats", "a", "f")}
    docstore.reset_collections(store)
    assert store.read("documents").count() == 0
    docstore.upsert_documents(store, df.limit(1))
    assert store.read("documents").count() == 1


def test_document_merge_rewrites_only_touched_buckets(spark):
    store = ingest.Store(spark, fresh_path(spark, "docbuckets"))
    df = spark.range(400).selectExpr(
        "if(id % 2 = 0, 'profiles', 'floats') as collection", "concat('d', id) as id",
        "concat('text ', id) as document", "array(cast(id as float)) as embedding")
    first = docstore.upsert_documents(store, df)
    assert first.select("bucket").distinct().count() == docstore.BUCKETS

    def stamps(frame):
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        out = {}
        for f in frame.inputFiles():
            path = jvm.org.apache.hadoop.fs.Path(f)
            out[f] = path.getFileSystem(conf).getFileStatus(path).getModificationTime()
        return out

    before = stamps(first)
    change = spark.createDataFrame([("profiles", "d10", "new text", None)],
                                   "collection string, id string, document string, embedding array<float>")
    after = docstore.upsert_documents(store, change)
    bucket = after.where("id = 'd10'").first().bucket
    now = stamps(after)
    touched = f"collection=profiles/bucket={bucket}/"
    assert {f: t for f, t in now.items() if touched not in f} == {
        f: t for f, t in before.items() if touched not in f}
    assert not {f for f in now if touched in f} & set(before)
    got = {r.id: (r.document, r.embedding) for r in after.collect()}
    assert len(got) == 400 and got["d10"] == ("new text", None)
    assert got["d12"] == ("text 12", [12.0]) and got["d11"] == ("text 11", [11.0])


def test_routing(spark, sf_dir):
    profiles = normalize(fixtures.bronze(spark, sf_dir)).select("file_type", "profile_id")
    assert {r[0] for r in core_profiles(profiles).select("file_type").distinct().collect()} == {
        "core", "bgc"}
    assert bgc_profiles(profiles).where(~F.col("profile_id").endswith("_BGC")).count() == 0
