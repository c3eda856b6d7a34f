import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyforge.__main__ import main
from tallyforge.operators.quality import QualityError
from tallyforge.plans import mortality as M
from tallyforge.plans.run import Config, build_gold, load_silver, register_views, run
from tallyforge.sources import bronze, landing
from tallyforge.sources.versions import TableSet, path_exists
from tallyforge.streaming.landing_stream import ingest_new_files

UTC = dt.timezone.utc
DAYS = [dt.datetime(2024, 5, d, 1, 2, 3, tzinfo=UTC) for d in (1, 2, 3, 4)]


def record(year, month, total=200000, name="US", **more):
    texts = {"jurisdiction_of_occurrence": name, "year": str(year), "month": str(month), "all_cause": str(total)}
    texts |= {"start_date": f"{year}-{month:02d}-01T00:00:00.000", "data_as_of": "2024-05-01T00:00:00.000"}
    texts |= {"diseases_of_heart": "50000", "covid_19_underlying_cause": "1000"}
    return texts | more


def years(*wanted, total=200000, **more):
    return [record(y, m, total + m, **more) for y in wanted for m in range(1, 13)]


def landed(spark, records):
    texts = [(json.dumps(r),) for r in records]
    return lambda: spark.createDataFrame(texts, "raw_data string")


@pytest.fixture
def config(folder):
    return Config(folder, "deaths", "https://example.org/deaths.json", "full_")


def table(spark, config, name):
    layout = {"silver": M.SILVER, **M.gold_layouts(config.entity)}[name]
    return TableSet(spark, config.root).read(layout)


def rows(frame, *without):
    return sorted(map(str, frame.drop("loaded_at", *without).collect()))


def audit(spark, config):
    return [tuple(r) for r in bronze_audit(spark, config).orderBy("started_at").collect()]


def bronze_audit(spark, config):
    return spark.read.schema(bronze.AUDIT_SCHEMA).parquet(f"{config.root}/audit").select("batch_id", "status", "rows_ingested", "error_message")


def test_first_load(spark, config):
    records = [*years(2019, 2020), {"year": "x", "month": "1"}]
    result = run(spark, config, landed(spark, records), DAYS[0])
    assert (result.received, result.inserted, result.transformed, result.dropped, result.upserted) == (25, 25, 24, 1, 24)
    assert result.batch_id == "full_20240501_010203" and len(result.report) == 15
    assert table(spark, config, "silver").count() == 24
    assert table(spark, config, "trends").count() == 24
    assert table(spark, config, "summary").count() == 12
    impact = {(r.year, r.month): r.excess_vs_prev_year for r in table(spark, config, "impact").collect()}
    assert impact[(2019, 3)] is None and impact[(2020, 3)] == 0
    assert audit(spark, config) == [("full_20240501_010203", "success", 25, None)]
    rejects = spark.read.parquet(f"{config.root}/staged/*/usable=false")
    assert rejects.first().reject_reason == "no_year"


def test_twice_gives_the_same_tables(spark, config):
    records = landed(spark, years(2019, 2020))
    run(spark, config, records, DAYS[0])
    before = {n: rows(table(spark, config, n)) for n in ("silver", "trends", "summary", "impact")}
    run(spark, config, records, DAYS[1])
    assert before == {n: rows(table(spark, config, n)) for n in before}
    assert table(spark, config, "trends").select("loaded_at").distinct().count() == 1


def test_revision_touches_its_years_only(spark, config):
    run(spark, config, landed(spark, years(2019, 2020, 2021, 2022)), DAYS[0])
    before = TableSet(spark, config.root).published()[1]
    revised = [record(2020, 1, 300000, start_date="1999-01-01")]
    result = run(spark, config, landed(spark, revised), DAYS[1])
    after = TableSet(spark, config.root).published()[1]
    changed = {n: sorted({f.split("/")[0] for f in set(after[n]) - set(before[n])}) for n in ("silver", "trends", "summary", "impact")}
    assert changed == {"silver": ["year=2020"], "trends": ["year=2020"], "summary": ["year=2020"], "impact": ["year=2020", "year=2021"]}
    assert result.silver_years == [2020] and result.gold_years == [2020]
    silver = {(r.year, r.month): r for r in table(spark, config, "silver").collect()}
    assert len(silver) == 48 and silver[(2020, 1)].all_cause == 300000
    assert silver[(2020, 1)].start_date == dt.date(2020, 1, 1), "the first load fixes the period bounds"
    assert silver[(2020, 1)].loaded_at.day == 2 and silver[(2020, 2)].loaded_at.day == 1
    impact = {(r.year, r.month): r.excess_vs_prev_year for r in table(spark, config, "impact").collect()}
    assert impact[(2020, 1)] == 99999 and impact[(2021, 1)] == -99999 and impact[(2022, 1)] == 0


def test_expired_folders_are_deleted(spark, config):
    for at in DAYS[:3]:
        run(spark, config, landed(spark, years(2019, 2020)), at)
    names = ("silver", "trends", "summary", "impact")
    before = {n: rows(table(spark, config, n)) for n in names}
    tables = TableSet(spark, config.root)
    gone = tables.expire(keep=3)
    assert len(gone) == 24 + 24 + 2 + 24 + 3 * 2 and all(not path_exists(spark, f"{config.root}/{folder}") for folder in gone)
    assert {folder.split("/")[0] for folder in gone} == {*names, "trends_checks", "summary_checks", "impact_checks"}
    assert tables.expire(keep=3) == [] and before == {n: rows(table(spark, config, n)) for n in names}
    assert not path_exists(spark, f"{config.root}/never") and tables.published()[0] == 6


def test_incremental_equals_rebuilt(spark, config):
    run(spark, config, landed(spark, years(2019, 2020, 2021)), DAYS[0])
    run(spark, config, landed(spark, years(2020, total=250000)), DAYS[1])
    names = ("trends", "summary", "impact")
    incremental = {n: rows(table(spark, config, n)) for n in names}
    result = build_gold(spark, config, load_silver(spark, config, None, DAYS[2]), DAYS[2], rebuild=True)
    assert result.gold_years == [2019, 2020, 2021]
    assert incremental == {n: rows(table(spark, config, n)) for n in names}


def test_failed_checks_leave_the_published_tables(spark, config):
    run(spark, config, landed(spark, years(2019, 2020)), DAYS[0])
    before = rows(table(spark, config, "trends"))
    with pytest.raises(QualityError, match="trends_total_range: 12 rows outside 100000 to 500000"):
        run(spark, config, landed(spark, years(2020, total=60000)), DAYS[1])
    assert rows(table(spark, config, "trends")) == before
    run(spark, config, landed(spark, years(2020, total=260000)), DAYS[2])
    assert table(spark, config, "trends").filter("year = 2020 AND total_deaths > 260000").count() == 12


def test_failed_fetch_is_audited_and_raised(spark, config):
    def fail():
        raise TimeoutError("no answer in 30 s")

    with pytest.raises(TimeoutError):
        run(spark, config, fail, DAYS[0])
    assert audit(spark, config) == [("full_20240501_010203", "failed", 0, "no answer in 30 s")]
    assert not path_exists(spark, f"{config.root}/bronze")


def test_empty_fetch_reuses_the_older_batch(spark, config):
    run(spark, config, landed(spark, years(2019)), DAYS[0])
    before = rows(table(spark, config, "silver"))
    result = run(spark, config, landed(spark, []), DAYS[1])
    assert result.received == 0 and result.transformed == 12
    assert rows(table(spark, config, "silver")) == before
    assert [a[1:3] for a in audit(spark, config)] == [("success", 12), ("success", 0)]


def test_two_jurisdictions(spark, config):
    two = [*years(2019, 2020), *years(2019, 2020, name="NYC", total=150000)]
    with pytest.raises(Exception, match="repeated key"):
        run(spark, config, landed(spark, two), DAYS[0])
    assert table(spark, config, "silver").count() == 48 and table(spark, config, "trends").count() == 0
    config.entity, config.checks = ("jurisdiction",), M.checks(("jurisdiction",))
    run(spark, config, landed(spark, two), DAYS[1])
    assert table(spark, config, "trends").count() == 48 and table(spark, config, "summary").count() == 24


def test_null_jurisdiction(spark, config):
    records = [*years(2019), record(2019, 5, name=None)]
    with pytest.raises(Exception, match="jurisdiction is NULL"):
        run(spark, config, landed(spark, records), DAYS[0])
    config.null_jurisdiction = "reject"
    result = run(spark, config, landed(spark, records), DAYS[1])
    assert (result.transformed, result.dropped) == (12, 1)


def test_repeated_record(spark, config):
    records = [*years(2019), record(2019, 5, 333333, data_as_of="2024-06-01")]
    with pytest.raises(Exception, match="repeated key: jurisdiction=US, year=2019, month=5"):
        run(spark, config, landed(spark, records), DAYS[0])
    config.on_duplicate = "last"
    run(spark, config, landed(spark, records), DAYS[1])
    assert table(spark, config, "silver").filter("month = 5").first().all_cause == 333333


def test_all_records_unusable(spark, config):
    result = run(spark, config, landed(spark, [{"month": "1"}]), DAYS[0])
    assert (result.transformed, result.dropped, result.silver_years, result.gold_years) == (0, 1, [], [])
    assert table(spark, config, "silver").count() == 0


def test_stages_from_the_command_line(spark, folder, capsys):
    lines = [(json.dumps(r),) for r in [*years(2018), *years(2019, 2020)]]
    spark.createDataFrame(lines, "value string").write.text(f"{folder}/landing")
    place = ["--root", f"{folder}/tables"]
    for stage in (["ingest", "--landing", f"{folder}/landing"], ["silver"], ["gold"], ["check"]):
        assert main([*stage, *place]) == 0
    printed = capsys.readouterr().out
    assert printed.count("PASS") == 30 and "transformed=24" in printed, "2018 is before the first year"
    register_views(spark, Config(f"{folder}/tables", "", ""))
    assert spark.sql("SELECT count(*) n FROM trends JOIN impact USING (year, month)").first().n == 24
    assert main(["check", *place, "--high", "200001"]) == 1
    assert main(["rebuild", *place]) == 0 and main(["expire", *place, "--keep", "1"]) == 0
    printed = capsys.readouterr().out
    assert "gold_years=[2019, 2020]" in printed and "trends/year=2019/month=1/run=" in printed


# --- raw table and landing ------------------------------------------------------------------------------------


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "raw_data string")


def test_latest_batch(spark, folder):
    path = f"{folder}/bronze"
    assert bronze.append(texts(spark, "a", "b"), path, "s", "b2", DAYS[0]) == 2
    bronze.append(texts(spark, "c"), path, "s", "b1", DAYS[1])
    assert [r.raw_data for r in bronze.latest_batch(bronze.read(spark, path)).collect()] == ["c"]
    bronze.append(texts(spark, "d"), path, "s", "b0", DAYS[1])
    latest = bronze.latest_batch(bronze.read(spark, path))
    assert [(r.raw_data, r.batch_id) for r in latest.collect()] == [("c", "b1")], "equal times go to the greater id"
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
    assert [r.raw_data for r in bronze.latest_batch(bronze.read(spark, path), "b2").orderBy("raw_data").collect()] == ["a", "b"]


def test_latest_of_an_empty_table_raises(spark):
    empty = spark.createDataFrame([], bronze.BRONZE_SCHEMA)
    with pytest.raises(Exception, match="raw table is empty"):
        bronze.latest_batch(empty).collect()


def test_appending_nothing_adds_no_batch(spark, folder):
    path = f"{folder}/bronze"
    bronze.append(texts(spark, "a"), path, "s", "b1", DAYS[0])
    assert bronze.append(texts(spark, "a").limit(0), path, "s", "b2", DAYS[1]) == 0
    assert bronze.latest_batch_id(bronze.read(spark, path)).first().batch_id == "b1"


def test_landed_lines_filter_and_page(spark, folder):
    lines = [json.dumps({"year": str(y), "n": f"{i:02d}"}) for i, y in enumerate([2018, 2019, 2020, 2021, 2022])] + ["", "  "]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{folder}/lines")
    assert landing.read_landed(spark, f"{folder}/lines").count() == 5
    kept = landing.read_landed(spark, f"{folder}/lines", where=M.since_first_year())
    assert kept.count() == 4
    paged = landing.read_landed(spark, f"{folder}/lines", where=M.since_first_year(), order_by=["n"], offset=1, limit=2)
    assert [json.loads(r.raw_data)["n"] for r in paged.collect()] == ["02", "03"]
    with pytest.raises(ValueError, match="order"):
        landing.page(kept, [], 0, 5)


def test_landed_array_equals_lines(spark, tmp_path):
    records = [{"year": "2020", "n": i, "nested": {"a": [1, None]}, "gone": None} for i in range(5)]
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "p1.json").write_text(json.dumps(records[:3], indent=1))
    (tmp_path / "array" / "p2.json").write_text(json.dumps(records[3:]))
    (tmp_path / "array" / "p3.json").write_text("[]")
    got = landing.read_landed(spark, str(tmp_path / "array"), layout="array").collect()
    assert sorted((json.loads(r.raw_data) for r in got), key=lambda r: r["n"]) == records


def test_new_files_are_ingested_once(spark, folder):
    place, path, progress = f"{folder}/landing", f"{folder}/bronze", f"{folder}/progress"
    lines = spark.createDataFrame([('{"year":"2020"}',), ('{"year":"2021"}',)], "value string").coalesce(1)
    lines.write.text(place)
    assert ingest_new_files(spark, place, path, progress, "s", run_ts=DAYS[0]) == 2
    assert ingest_new_files(spark, place, path, progress, "s", run_ts=DAYS[1]) == 0
    lines.write.mode("append").text(place)
    assert ingest_new_files(spark, place, path, progress, "s", run_ts=DAYS[2]) == 2
    stored = bronze.read(spark, path)
    assert stored.count() == 4 and stored.select("batch_id").distinct().count() == 2
    assert bronze.latest_batch(stored).count() == 2


def test_audit_counts(spark):
    stored = bronze.stamp(texts(spark, "a", "b"), "s", "b1", DAYS[0])
    runs = [("b1", "s", "success", None), ("b2", "s", "failed", "timeout"), ("b3", "s", "success", None)]
    frame = spark.createDataFrame(runs, "batch_id string, source string, status string, error_message string")
    frame = frame.withColumn("started_at", F.lit(DAYS[0])).withColumn("finished_at", F.lit(DAYS[1]))
    got = {r.batch_id: r.rows_ingested for r in bronze.audit(stored, frame).collect()}
    assert got == {"b1": 2, "b2": 0, "b3": 0}
