"""Attempts, backlog, failed batches, layout changes, and constraints counted while rows are written."""

import datetime as dt
import json

import pytest
from test_run import DAYS, config, landed, record, rows, table, texts, years  # noqa: F401

from tallyforge.operators.constraints import ConstraintError
from tallyforge.plans import mortality as M
from tallyforge.plans.run import Result, build_gold, ingest, load_silver, run
from tallyforge.sources import bronze, landing, ledger
from tallyforge.sources.ledger import Ledger
from tallyforge.sources.versions import Layout, TableSet
from tallyforge.streaming.landing_stream import ingest_new_files


def raws(spark, path):
    return sorted(r.raw_data for r in bronze.read(spark, path).collect())


def states(spark, config):  # noqa: F811
    return [(b.batch_id[-15:], b.state, b.n) for b in Ledger(spark, f"{config.root}/bronze").batches()]


# --- appending ------------------------------------------------------------------------------------------------


def test_attempt_is_invisible_until_committed(spark, folder):
    path = f"{folder}/bronze"
    assert raws(spark, path) == [] and Ledger(spark, path).batches() == []
    died = bronze.write_attempt(texts(spark, "a", "b"), path, "s", "b1", DAYS[0])
    assert raws(spark, path) == [] and died.n == 2
    bronze.append(texts(spark, "c"), path, "s", "b0", DAYS[0])
    assert raws(spark, path) == ["c"]
    bronze.commit(spark, path, died)
    assert raws(spark, path) == ["a", "b", "c"]


def test_repeated_append_replaces_its_batch(spark, folder):
    path = f"{folder}/bronze"
    for values in (("a",), ("a", "b")):
        bronze.append(texts(spark, *values), path, "s", "b1", DAYS[0])
    assert raws(spark, path) == ["a", "b"]
    (only,) = Ledger(spark, path).batches()
    assert (only.batch_id, only.state, only.n) == ("b1", ledger.LANDED, 2)
    Ledger(spark, path).mark([only], ledger.LOADED)
    assert [b.state for b in Ledger(spark, path).batches()] == [ledger.LOADED]
    bronze.append(texts(spark, "c"), path, "s", "b1", DAYS[0])
    assert [(b.state, b.n) for b in Ledger(spark, path).batches()] == [(ledger.LANDED, 1)], "the new attempt waits"
    assert bronze.append(texts(spark, "x").limit(0), path, "s", "b1", DAYS[0]) == 0
    assert raws(spark, path) == ["c"], "an empty attempt replaces nothing"


def test_newest_batch_reads_one_folder(spark, folder):
    path = f"{folder}/bronze"
    with pytest.raises(ValueError, match="raw table is empty"):
        bronze.newest_batch(spark, path)
    for at, name in ((DAYS[1], "b1"), (DAYS[0], "b2"), (DAYS[1], "b0")):
        bronze.append(texts(spark, name), path, "s", name, at)
    newest = bronze.newest_batch(spark, path)
    assert [r.raw_data for r in newest.collect()] == ["b1"], "equal times go to the greater id"
    assert {name.split('/batch_id=')[1].split('/')[0] for name in newest.inputFiles()} == {'b1'}
    assert newest.columns == bronze.BRONZE_SCHEMA.names
    with pytest.raises(ValueError, match="letters, digits"):
        bronze.append(texts(spark, "x"), path, "s", "a/b", DAYS[0])


def test_high_water_stops_at_the_first_open_batch(spark, folder):
    path = f"{folder}/bronze"
    for at, name in zip(DAYS, ("b1", "b2", "b3")):
        bronze.append(texts(spark, name), path, "s", name, at)
    book = Ledger(spark, path)
    first, second, third = book.batches()
    assert ledger.high_water(book.batches()) is None and ledger.backlog(book.batches()) == [first, second, third]
    book.mark([first, third], ledger.LOADED)
    assert ledger.high_water(book.batches()) == first.ingested_at and ledger.backlog(book.batches()) == [second]
    book.mark([second], ledger.FAILED)
    assert ledger.high_water(book.batches()) == third.ingested_at and ledger.backlog(book.batches()) == []


# --- loading --------------------------------------------------------------------------------------------------


def test_two_waiting_batches_are_loaded_once(spark, config):  # noqa: F811
    first = [*years(2019), record(2020, 1, 1, start_date="2020-01-05")]
    ingest(spark, config, landed(spark, first), DAYS[0])
    ingest(spark, config, landed(spark, [record(2020, 1, 200001, start_date="1999-01-01"), record(2020, 2)]), DAYS[1])
    result = load_silver(spark, config, None, DAYS[2])
    assert len(result.batches) == 2 and result.transformed == 15 and result.high_water.day == 2
    silver = {(r.year, r.month): r for r in table(spark, config, "silver").collect()}
    assert len(silver) == 14 and silver[(2020, 1)].all_cause == 200001
    assert silver[(2020, 1)].start_date == dt.date(2020, 1, 5), "the first batch with the key fixes the period bounds"
    ingest(spark, config, landed(spark, [record(2020, 3)]), DAYS[3])
    again = load_silver(spark, config, None, DAYS[3])
    assert again.transformed == 1 and again.silver_years == [2020]
    assert [s[1] for s in states(spark, config)] == [ledger.LOADED] * 3


def test_streamed_batches_are_loaded(spark, config, folder):  # noqa: F811
    place = f"{folder}/landing"
    for part in (years(2019), years(2020)):
        spark.createDataFrame([(json.dumps(r),) for r in part], "value string").coalesce(1).write.mode("append").text(place)
        ingest_new_files(spark, place, f"{config.root}/bronze", f"{folder}/progress", "s", run_ts=DAYS[0])
    result = load_silver(spark, config, None, DAYS[1])
    assert len(result.batches) == 2 and table(spark, config, "silver").count() == 24


def test_batch_with_broken_rows_does_not_hold_up_the_others(spark, config):  # noqa: F811
    ingest(spark, config, landed(spark, years(2019)), DAYS[0])
    ingest(spark, config, landed(spark, [record(2020, 1), record(2020, 1)]), DAYS[1])
    ingest(spark, config, landed(spark, [record(2020, 2)]), DAYS[2])
    with pytest.raises(Exception, match="repeated key: jurisdiction=US, year=2020, month=1"):
        load_silver(spark, config, None, DAYS[2])
    assert table(spark, config, "silver").count() == 13
    assert [s[1] for s in states(spark, config)] == [ledger.LOADED, ledger.FAILED, ledger.LOADED]
    ingest(spark, config, landed(spark, [record(2020, 1)]), DAYS[1])
    assert load_silver(spark, config, None, DAYS[3]).transformed == 1
    assert table(spark, config, "silver").count() == 14 and [s[1] for s in states(spark, config)] == [ledger.LOADED] * 3


def test_failure_of_a_machine_leaves_the_batch_open(spark, config, monkeypatch):  # noqa: F811
    ingest(spark, config, landed(spark, years(2019)), DAYS[0])

    def lost(*_):
        raise OSError("disk lost")

    with monkeypatch.context() as broken:
        broken.setattr(TableSet, "write", lost)
        with pytest.raises(OSError):
            load_silver(spark, config, None, DAYS[0])
    assert [s[1] for s in states(spark, config)] == [ledger.LANDED]
    assert load_silver(spark, config, None, DAYS[1]).transformed == 12


def test_revised_month_rewrites_one_month(spark, config):  # noqa: F811
    run(spark, config, landed(spark, years(2019, 2020, 2021)), DAYS[0])
    before = TableSet(spark, config.root).published()[1]
    run(spark, config, landed(spark, [record(2020, 5, 222222)]), DAYS[1])
    after = TableSet(spark, config.root).published()[1]
    new = {n: sorted(f.rsplit("/run=", 1)[0] for f in set(after[n]) - set(before[n])) for n in ("silver", "trends", "summary", "impact")}
    month = "year=2020/month=5"
    assert new == {"silver": [month], "trends": [month], "summary": ["year=2020"], "impact": [month, "year=2021/month=5"]}


# --- layouts --------------------------------------------------------------------------------------------------


def test_change_of_entity_builds_all_tables_afresh(spark, config):  # noqa: F811
    run(spark, config, landed(spark, years(2019, 2020)), DAYS[0])
    config.entity, config.checks = ("jurisdiction",), M.checks(("jurisdiction",))
    result = build_gold(spark, config, Result(""), DAYS[1])
    assert result.gold_years == [2019, 2020]
    for name, n in (("trends", 24), ("summary", 12), ("impact", 24)):
        got = table(spark, config, name)
        assert got.count() == n and got.filter("jurisdiction IS NULL").count() == 0
    assert build_gold(spark, config, Result(""), DAYS[2]).gold_years == [], "nothing changed since"
    config.entity, config.checks = (), M.checks()
    build_gold(spark, config, Result(""), DAYS[3])
    assert table(spark, config, "trends").count() == 24


def test_change_of_silver_loads_every_batch_again(spark, config, monkeypatch):  # noqa: F811
    run(spark, config, landed(spark, years(2019)), DAYS[0])
    run(spark, config, landed(spark, years(2020)), DAYS[1])
    before = rows(table(spark, config, "silver"))
    yearly = Layout("silver", M.SILVER.schema, ("year",), M.SILVER_KEYS)
    assert TableSet(spark, config.root).changed([yearly]) == {"silver"} and TableSet(spark, config.root).changed([M.SILVER]) == set()
    tables = TableSet(spark, config.root)
    tables.publish({}, DAYS[2], layouts=[yearly])  # as an earlier version of the library left it
    result = run(spark, config, landed(spark, [record(2021, 1)]), DAYS[3])
    assert len(result.batches) == 3
    assert [r for r in rows(table(spark, config, "silver")) if "2021" not in r.split("start_date")[0]] == before


def test_checks_count_only_what_was_written(spark, config, monkeypatch):  # noqa: F811
    from tallyforge.operators import quality

    run(spark, config, landed(spark, years(2019, 2020)), DAYS[0])
    counted, plain = [], quality.check_state

    def watched(frame, checks, partitions):
        counted.append(frame.select(*partitions).distinct().count())
        return plain(frame, checks, partitions)

    monkeypatch.setattr(quality, "check_state", watched)
    result = run(spark, config, landed(spark, [record(2020, 5, 222222)]), DAYS[1])
    assert sorted(counted) == [1, 1, 1] and len(result.report) == 15
    with pytest.raises(quality.QualityError, match=r"trends_total_range: 1 rows outside 100000 to 500000 \(year=2020, month=6\)"):
        run(spark, config, landed(spark, [record(2020, 6, 99999)]), DAYS[2])
    config.checks = M.checks(low=1)
    counted.clear()
    assert len(run(spark, config, landed(spark, [record(2020, 6, 60000)]), DAYS[3]).report) == 15
    assert sorted(counted) == [1, 1, 24], "another bound counts all months of its table again"


# --- constraints ----------------------------------------------------------------------------------------------


def test_number_beyond_32_bits_stops_the_load(spark, config):  # noqa: F811
    bad = [*years(2019), record(2020, 1, 9_999_999_999), record(2020, 2, name="x" * 101), record(2020, 3, natural_cause="-2147483649")]
    with pytest.raises(ConstraintError, match="jurisdiction is longer than 100 in 1 row; all_cause does not fit 32 bits in 1 row; natural_cause"):
        run(spark, config, landed(spark, bad), DAYS[0])
    assert table(spark, config, "silver").count() == 0 and [s[1] for s in states(spark, config)] == [ledger.FAILED]


@pytest.mark.parametrize("typed", [False, True])
def test_broken_rows_are_kept_aside(spark, config, typed):  # noqa: F811
    bad = [record(2020, 1, 9_999_999_999), record(2020, 2, name="x" * 101), record(2020, 3, name=None), {"year": "x"}]
    if typed:
        bad = [{**r, "all_cause": int(r["all_cause"])} if "all_cause" in r else r for r in bad]
    config.on_violation, config.typed_json = "quarantine", typed
    result = run(spark, config, landed(spark, [*years(2019), *bad]), DAYS[0])
    assert (result.received, result.transformed, result.dropped) == (16, 12, 4)
    assert {n: v for n, v in result.violations.items() if v} == {"not_null:jurisdiction": 1, "max_length:jurisdiction": 1, "int_range:all_cause": 1}
    aside = spark.read.parquet(f"{config.root}/staged/*/usable=false")
    assert sorted((r.reject_reason, r.batch_id) for r in aside.collect()) == sorted(
        (reason, result.batch_id) for reason in ("int_range:all_cause", "max_length:jurisdiction", "no_year", "not_null:jurisdiction")
    )
    assert all(r.raw_data for r in aside.collect())


def test_constraints_cost_no_second_scan(spark):
    from tallyforge.operators.parse import constraint_counts, parse

    raw = spark.createDataFrame([(json.dumps(r),) for r in [*years(2019), record(2019, 1), record(2020, 1, 9_999_999_999)]], "raw_data string")
    counts = constraint_counts(parse(raw, M.SPEC, constraints=True), M.SPEC, M.SILVER_KEYS)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("hashpartitioning") == 1
    assert {(r.constraint, r.column_name): r.violations for r in counts.collect() if r.violations} == {
        ("int_range", "all_cause"): 1,
        ("unique_key", "jurisdiction,year,month"): 1,
    }


def test_truncated_page_fails_the_run_and_its_audit_says_all(spark, config, tmp_path):  # noqa: F811
    place = tmp_path / "landing"
    place.mkdir()
    whole = json.dumps(years(2019))
    (place / "page.json").write_text(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="not a whole JSON array"):
        run(spark, config, lambda: landing.read_landed(spark, str(place), "array"), DAYS[0])
    (row,) = spark.read.schema(bronze.AUDIT_SCHEMA).parquet(f"{config.root}/audit").collect()
    assert row.status == "failed" and row.rows_ingested == 0 and "page.json" in row.error_message
    assert states(spark, config) == []
    (place / "page.json").write_text(whole)
    assert run(spark, config, lambda: landing.read_landed(spark, str(place), "array"), DAYS[1]).received == 12


def test_audit_keeps_the_whole_message(spark, config):  # noqa: F811
    with pytest.raises(TimeoutError):
        run(spark, config, lambda: (_ for _ in ()).throw(TimeoutError("no answer " * 500)), DAYS[0])
    (row,) = spark.read.schema(bronze.AUDIT_SCHEMA).parquet(f"{config.root}/audit").collect()
    assert row.error_message == "no answer " * 500
