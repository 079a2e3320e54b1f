from __future__ import annotations

import os
import time
from datetime import datetime

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tableloom.operators.merge import DeleteFlag
from tableloom.operators.quality import QualityFailure
from tableloom.operators.schema import SchemaDrift
from tableloom.plans import control
from tableloom.plans.run import SourceSpec, TableSpec, micro_batches, run_table
from tableloom.sources import files, tables
from tableloom.sources.files import FileSpec
from tableloom.sources.store import TableStore, stamp_path, write_output
from tableloom.spec import NoDataFound, SpecError
from tableloom.streaming import ingest


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("mode,want", [("quarantine", {(1, "a"), (None, None)}), ("drop", {(1, "a")})])
def test_bad_csv_records(spark, tmp_path, mode, want):
    path = put(tmp_path / "x.csv", "id,name\n1,a\noops,b\n")
    df = files.read_files(spark, [path], FileSpec("csv", schema="id int, name string", on_bad_records=mode))
    got = {(r["id"], r["name"] if r["id"] else None) for r in df.collect()}
    assert got == want and "delta__raw_folderpath" in df.columns


def test_bad_csv_record_fails(spark, tmp_path):
    path = put(tmp_path / "x.csv", "id\noops\n")
    with pytest.raises(Exception):
        files.read_files(spark, [path], FileSpec("csv", schema="id int", on_bad_records="fail")).collect()


def test_tsv_json_xml_and_parquet_contract(spark, tmp_path):
    tsv = files.read_files(spark, [put(tmp_path / "x.tsv", "a\tb\n1\t2\n")], FileSpec("tsv"))
    assert as_set(tsv, "a", "b") == {("1", "2")}
    js = files.read_files(spark, [put(tmp_path / "x.json", '[{"a":\n1}]')], FileSpec("json", multiline=True))
    assert as_set(js, "a") == {(1,)}
    xml = put(tmp_path / "x.xml", "<c><book><t>x</t><e/></book><book><t>y</t><e/></book></c>")
    df = files.read_files(spark, [xml], FileSpec("xml", xml_xpath="//c/book"))
    assert as_set(df, "t") == {("x",), ("y",)}
    spark.range(3).write.parquet(str(tmp_path / "p"))
    with pytest.raises(SpecError):
        files.read_files(spark, [str(tmp_path / "p")], FileSpec("parquet", schema="id string"))
    with pytest.raises(SpecError):
        files.row_tag("//book[@id='1']")


def test_mixed_layouts_in_subfolders(spark, tmp_path):
    """Files below the given folder count, and folder names give their columns."""
    for name, text in (("a.csv", "a,b\n1,2\n"), ("p=1/b.csv", "a,b\n3,4\n"), ("p=2/c.csv", "a,c\n5,6\n")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        put(tmp_path / name, text)
    df = files.read_mixed_files(spark, [str(tmp_path)], FileSpec("csv"))
    assert as_set(df, "a") == {("1",), ("3",), ("5",)}


def test_mixed_layouts_share_scans(spark, tmp_path):
    paths = [put(tmp_path / f"{i}.csv", text) for i, text in enumerate(["a,b\n1,2\n", "a,c\n3,4\n", "a,b\n5,6\n"])]
    df = files.read_mixed_files(spark, paths, FileSpec("csv"))
    assert as_set(df, "a", "b", "c") == {("1", "2", None), ("3", None, "4"), ("5", "6", None)}
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_changed_files_are_read_once(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", "k\n1\n")
    df, mark = files.read_changed_files(spark, str(tmp_path / "in"), FileSpec("csv"), pattern="*.csv")
    assert as_set(df, "k") == {("1",)}
    assert files.read_changed_files(spark, str(tmp_path / "in"), FileSpec("csv"), mark, "*.csv") == (None, mark)
    later = put(tmp_path / "in" / "deep" / "b.csv", "k\n2\n")
    os.utime(later, (time.time() + 5, time.time() + 5))
    df, newer = files.read_changed_files(spark, str(tmp_path / "in"), FileSpec("csv"), mark, "*.csv")
    assert as_set(df, "k") == {("2",)} and newer > mark


def test_a_missing_folder_has_no_files(spark, tmp_path):
    gone = str(tmp_path / "gone")
    assert files.list_files(spark, gone).isEmpty()
    assert files.read_changed_files(spark, gone, FileSpec("csv")) == (None, files.FIRST_MARK)
    assert files.read_new_folders(spark, gone, FileSpec("csv")) == (None, "-1")


def test_new_folders_by_name(spark, tmp_path):
    for name in ("20240101000000", "20240102000000", "Archived_1/20240103000000"):
        put(tmp_path / name / "x.csv", f"k\n{name[-14:-6]}\n")
    df, mark = files.read_new_folders(spark, str(tmp_path), FileSpec("csv"), "20240101000000")
    assert as_set(df, "k") == {("20240102",)} and mark == "20240102000000"
    assert files.read_new_folders(spark, str(tmp_path), FileSpec("csv"), mark) == (None, mark)


def test_marks_skip_the_first_run_and_are_pushed_down(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert tables.after_mark(df, "id", "numeric", "-1").count() == 100
    later = tables.after_mark(df, "id", "numeric", "90")
    assert later.count() == 9
    assert "GreaterThan(id,90)" in later._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(SpecError):
        tables.after_mark(df, "nope")


def test_jdbc_reads_in_parallel(spark, frame):
    url, driver = "jdbc:derby:memory:loom;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rows = spark.range(50).selectExpr("cast(id AS int) AS ID", "date_add(DATE '2024-01-01', cast(id AS int)) AS D")
    rows.write.jdbc(url, "T", mode="overwrite", properties={"driver": driver})
    by_range = tables.read_jdbc(spark, url, "T", driver, "ID", (0, 50), 4)
    assert by_range.rdd.getNumPartitions() == 4 and by_range.count() == 50
    parts = tables.date_predicates("D", ["2024-01-10", "2024-02-01"], "DATE('{}')")
    by_date = tables.read_jdbc(spark, url, "T", driver, predicates=parts)
    assert by_date.rdd.getNumPartitions() == 3 and by_date.count() == 50
    assert tables.with_mark("SELECT * FROM T WHERE D > {WATERMARKVALUE}", "5").endswith("> 5")


def test_outputs(spark, tmp_path):
    df = spark.range(2)
    path = write_output(df, f"{tmp_path}/%Y/out.txt", now=datetime(2024, 5, 6), single=True)
    assert path.endswith("/2024/out.txt") and as_set(spark.read.csv(path, sep="\t", header=True)) == {("0",), ("1",)}
    assert (tmp_path / "2024/out.txt").is_file() and len(list((tmp_path / "2024").glob("[!.]*"))) == 1
    write_output(spark.range(5), f"{tmp_path}/%Y/out.txt", now=datetime(2024, 5, 6), single=True)
    assert spark.read.csv(path, sep="\t", header=True).count() == 5
    assert stamp_path("%Y%m%d_%j", datetime(2024, 5, 6)) == "20240506_127"
    with pytest.raises(SpecError):
        write_output(df, f"{tmp_path}/x.xlsx")


def test_store_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert not store.exists("silver.t")
    store.write("silver.t", spark.range(2))
    store.write("silver.t", store.read("silver.t").union(spark.range(5, 6)))
    assert store.version("silver.t") == 2 and store.read("silver.t").count() == 3 and store.read("silver.t", 1).count() == 2
    with pytest.raises(SpecError):
        store.read("nope")


def test_stream_reads_new_files_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.range(5).write.json(source)
    spec = FileSpec("json", schema="id bigint")
    for _ in range(2):
        ingest.ingest_available(ingest.stream_files(spark, source, spec), state, ingest.write_batch(out)).awaitTermination()
        assert spark.read.parquet(out).count() == 5
    spark.range(5, 7).write.mode("append").json(source)
    ingest.ingest_available(ingest.stream_files(spark, source, spec), state, ingest.write_batch(out)).awaitTermination()
    assert spark.read.parquet(out).count() == 7


@pytest.fixture
def store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    rows = [(1, " a ", datetime(2024, 1, 1)), (2, "b", datetime(2024, 1, 2)), (3, "", datetime(2024, 1, 3))]
    store.register("bronze.src", spark.createDataFrame(rows, "ID int, `Full Name` string, ts timestamp"))
    return store


def table_spec(**changes):
    spec = dict(
        target="silver.people", source=SourceSpec(table="bronze.src", mark_columns=["ts"]), primary_keys=["ID"], table_id=7,
        name_rules={"apply_case": "lower", "replace_non_alphanumeric_with_underscore": "true"}, trim_strings="*", blank_to_null="*",
        steps=[{"Category": "derived_column", "column_name": "n", "expression": "length(full_name)"}],
        checks=[{"Category": "validate_not_null", "column_name": "full_name", "if_not_compliant": "quarantine", "message": "no name"}],
    )
    return TableSpec(**{**spec, **changes})


def test_runs_are_incremental_and_logged(spark, store):
    first = run_table(spark, store, table_spec())
    assert (first.status, first.rows, first.quarantined) == ("Processed", 2, 1)
    assert as_set(store.read("silver.people"), "id", "full_name", "n") == {(1, "a", 1), (2, "b", 1)}
    assert as_set(store.read("silver.people_quarantined"), "id", "delta__quarantine_reason") == {(3, "no name")}
    idle = run_table(spark, store, table_spec(), first.mark)
    assert (idle.rows, idle.mark) == (0, first.mark)
    more = spark.createDataFrame([(2, "bb", datetime(2024, 2, 1)), (4, "d", datetime(2024, 2, 2))], "ID int, `Full Name` string, ts timestamp")
    store.register("bronze.src", store.read("bronze.src").union(more))
    second = run_table(spark, store, table_spec(), first.mark)
    assert second.rows == 2
    assert as_set(store.read("silver.people"), "id", "full_name") == {(1, "a"), (2, "bb"), (4, "d")}
    log = store.read("log.runs")
    assert log.count() == 3 and store.read("log.quality").filter("Data_Quality_Result = 'Warning'").count() == 1
    mark = control.high_water_marks(log, spark.createDataFrame([], control.PRIMARY_CONFIG)).first()
    assert mark["watermark_value"].startswith("2024-02-02")


def test_a_path_as_target_is_written_as_one_file(spark, store, tmp_path):
    spec = table_spec(target=f"{tmp_path}/out/people_%Y.csv", checks=[{"Category": "validate_not_null", "column_name": "full_name", "if_not_compliant": "quarantine", "message": "no name"}])
    for _ in range(2):
        made = run_table(spark, store, spec, now=datetime(2024, 5, 6))
        assert (made.version, made.rows, made.quarantined) == (None, 2, 1)
    assert as_set(spark.read.csv(f"{tmp_path}/out/people_2024.csv", header=True), "id", "full_name") == {("1", "a"), ("2", "b")}
    assert store.read("people_%Y_quarantined").count() == 2 and store.read("log.runs").count() == 2


def test_a_run_counts_while_it_writes_its_flags(spark, store, monkeypatch):
    from tableloom.operators.quality import run_quality

    df = spark.range(10)
    step = {"Category": "validate_range", "column_name": "id", "max_value": "6", "if_not_compliant": "quarantine", "message": "big"}
    assert run_quality(df, [step], materialize=True).sizes() == run_quality(df, [step]).sizes() == (7, 3)
    assert run_quality(df, []).results() == []


def test_first_run_without_rows_is_an_error(spark, store):
    with pytest.raises(NoDataFound):
        run_table(spark, store, table_spec(steps=[{"Category": "filter_data", "filter_logic": "id > 100"}]))


def test_failed_check_leaves_the_target_alone(spark, store):
    run_table(spark, store, table_spec())
    strict = table_spec(checks=[{"Category": "validate_range", "column_name": "id", "max_value": "1", "if_not_compliant": "fail", "message": "big"}])
    with pytest.raises(QualityFailure):
        run_table(spark, store, strict)
    assert store.version("silver.people") == 1
    assert store.read("log.runs").filter("Ingestion_Status = 'Failed'").count() == 1


def test_drift_and_full_reload(spark, store):
    run_table(spark, store, table_spec())
    wider = table_spec(steps=[{"Category": "derived_column", "column_name": "n", "expression": "'text'"}], fail_on_type_change=True)
    with pytest.raises(SchemaDrift):
        run_table(spark, store, wider)
    again = run_table(spark, store, table_spec(full_reload=True), "2030-01-01 00:00:00")
    assert again.rows == 2


def test_scd2_run(spark, store):
    spec = table_spec(merge_type="scd2", source_timestamp="ts", checks=[], source=SourceSpec(table="bronze.src"))
    run_table(spark, store, spec)
    changed = spark.createDataFrame([(1, "new", datetime(2024, 3, 1))], "ID int, `Full Name` string, ts timestamp")
    store.register("bronze.src", changed)
    run_table(spark, store, spec)
    rows = store.read("silver.people").select("id", "full_name", "scd_active", F.year("scd_start_date")).collect()
    assert {tuple(r) for r in rows} == {(1, "a", 0, 1900), (1, "new", 1, 2024), (2, "b", 1, 1900), (3, None, 1, 1900)}


def test_change_feed_run(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write("bronze.t", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    spec = TableSpec("silver.t", SourceSpec(table="bronze.t", change_feed_keys=["k"]), primary_keys=["k"])
    first = run_table(spark, store, spec)
    store.write("bronze.t", spark.createDataFrame([(1, "z"), (3, "c")], "k int, v string"))
    run_table(spark, store, spec, first.mark)
    assert as_set(store.read("silver.t"), "k", "v") == {(1, "z"), (3, "c")}


def test_dimension_run(spark, store):
    spec = table_spec(
        target="gold.dim", layer="gold", dimension_key="sk", checks=[], source=SourceSpec(table="bronze.src"),
        steps=[{"Category": "create_surrogate_key", "type": "auto_increment", "column_name": "sk"}], delete=DeleteFlag("gone", "1"), merge_type="merge",
    )
    run_table(spark, store, spec)
    assert as_set(store.read("gold.dim"), "sk", "id") == {(-1, None), (1, 1), (2, 2), (3, 3)}


def test_micro_batches_run_once(spark, tmp_path):
    store, source = TableStore(spark, str(tmp_path / "t")), str(tmp_path / "in")
    spec = TableSpec("silver.s", SourceSpec(), primary_keys=["id"], checks=[
        {"Category": "validate_range", "column_name": "id", "max_value": "5", "if_not_compliant": "quarantine", "message": "big"}])
    handle = micro_batches(spark, store, spec)
    for low, high in ((0, 4), (3, 8)):
        spark.range(low, high).write.mode("append").json(source)
        stream = ingest.stream_files(spark, source, FileSpec("json", schema="id bigint", on_bad_records="drop"))
        ingest.ingest_available(stream, str(tmp_path / "state"), handle).awaitTermination()
    handle(spark.range(100), 0)  # a replay of the first batch changes nothing
    assert as_set(store.read("silver.s"), "id") == {(i,) for i in range(6)}
    assert as_set(store.read("silver.s_quarantined"), "id") == {(6,), (7,)}


def test_custom_staging(spark, tmp_path):
    def land(metadata, spark):
        put(tmp_path / "stage" / metadata["staging_folder"].rsplit("/", 1)[-1] / "a.csv", "k\n7\n")
        return {"rows_copied": 1, "next_watermark_value": "9"}

    made = files.stage(spark, land, str(tmp_path / "stage"), datetime(2024, 1, 2, 3, 4, 5))
    assert made["staging_folder"].endswith("/20240102030405") and made["next_watermark_value"] == "9"
    df, mark = files.read_new_folders(spark, str(tmp_path / "stage"), FileSpec("csv"))
    assert as_set(df, "k") == {("7",)} and mark == "20240102030405"
    with pytest.raises(SpecError):
        files.stage(spark, lambda m, s: {}, str(tmp_path / "stage"), datetime(2024, 1, 2))


def test_a_run_leaves_no_intermediate_tables(spark, store):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    run_table(spark, store, table_spec())
    assert set(os.listdir(shared)) == before


def test_only_plain_scans_are_read_again(spark, tmp_path):
    from tableloom.session import once

    path = str(tmp_path / "t")
    spark.range(9).withColumn("JoinDate", F.lit("Sort Window")).write.parquet(path)
    spark.range(9).write.csv(f"{path}.csv")
    scan = spark.read.parquet(path)
    for df in (scan, scan.filter("id > 3").select("JoinDate"), spark.range(5)):
        assert once(df) is df
    for df in (scan.distinct(), scan.withColumn("r", F.rand(1)), spark.read.csv(f"{path}.csv"), scan.join(scan.select("id"), "id"), spark.createDataFrame([(1,)], "a int")):
        assert once(df) is not df and once(df).count() == df.count()


def test_control_helpers(spark):
    at = datetime(2024, 1, 1)
    row = control.reset_mark(spark, 7, "silver", at, "x").first()
    assert (row["Watermark_Value"], row["Date_Key"]) == ("FULL_RELOAD", 20240101)
    stores = spark.createDataFrame([("Lake",)], "Datastore_Name string")
    assert control.find_datastore(stores, "lake").count() == 1
    with pytest.raises(SpecError, match="Lake"):
        control.find_datastore(stores, "pond")
    log = control.log_rows(spark, [{"Log_ID": "1", "Table_ID": 7, "Ingestion_Status": "Started", "Processing_Phase": "Staging", "Ingestion_Start_Time": at}], control.RUN_LOG)
    with pytest.raises(SpecError):
        control.assert_not_in_flight(log, 7, F.lit(at))


def test_appends_add_folders_and_old_versions_can_go(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write("silver.t", spark.range(2))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "silver" / "t").glob("part-*/*.parquet")}
    assert store.append("silver.t", spark.range(5, 7), batch=3) == 2 and store.batch("silver.t") == 3
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert store.read("silver.t").count() == 4 and store.read("silver.t", 1).count() == 2
    assert not store._point("silver.t", 2, [], None)
    store.write("silver.t", spark.range(1))
    store.forget("silver.t")
    assert store.batch("silver.t") == 3 and store.read("silver.t").count() == 1
    assert len(list((tmp_path / "silver" / "t").glob("part-*"))) == 1
