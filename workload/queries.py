"""One query per operator, each over whole tables. Keys match `workload.checks_sql`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge import functions as fn
from tallyforge.operators import quality, reporting
from tallyforge.operators import parse as parsing
from tallyforge.operators.upsert import last_by_key, merge
from tallyforge.plans import mortality
from tallyforge.plans.run import Config, Result, build_gold, ingest, load_silver, run
from tallyforge.session import work_folder
from tallyforge.sources import bronze, landing
from tallyforge.sources.versions import Layout, TableSet, new_run
from workload import planted, shapes

ENTITY = ("jurisdiction",)
SUPPLIER_LOW, SUPPLIER_HIGH = 100, 2500
PAGE_OFFSET, PAGE_SIZE = 100, 2000
ORDERS_PER_PAGE = 20_000  # keys of one landed array file
SOURCE_YEAR = "1997"
STATUS_BATCHES = {"F": "full_20020101_000000", "O": "full_20020102_000000", "P": "full_20020103_000000"}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- raw records ----------------------------------------------------------------------------------------------


@query
def bronze_ingest(spark, sf_dir):
    """Land every order's record as text, append it as one batch, read the batch back."""
    folder = work_folder(spark, "bronze_ingest")
    shapes.order_raw(spark, sf_dir).write.text(f"{folder}/landing")
    landed = landing.read_landed(spark, f"{folder}/landing")
    bronze.append(landed, f"{folder}/bronze", "orders", "full_20020201_000000", shapes.RUN_TS)
    return _fields(bronze.read(spark, f"{folder}/bronze"), "source_url", "batch_id")


@query
def bronze_source_filter(spark, sf_dir):
    raw = shapes.order_raw(spark, sf_dir)
    return _fields(raw.filter(mortality.since_first_year(first=SOURCE_YEAR)))


@query
def bronze_page(spark, sf_dir):
    """One page of the source, which is what the source's limit and offset mean."""
    raw = shapes.order_raw(spark, sf_dir)
    return _fields(landing.page(raw, ["data_as_of", "order_key"], PAGE_OFFSET, PAGE_SIZE))


@query
def landing_array(spark, sf_dir):
    """Every order's record landed as pages, each one JSON array in one file, and read back record by record."""
    folder = work_folder(spark, "landing_array")
    raw = shapes.order_raw(spark, sf_dir).withColumn("page", F.floor(landing.field("order_key").cast("bigint") / ORDERS_PER_PAGE))
    pages = raw.groupBy("page").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("raw_data"), ",\n"), F.lit("\n]")).alias("value"))
    pages.write.partitionBy("page").text(folder)
    return _fields(landing.read_landed(spark, folder, layout="array"))


def _fields(raw: DataFrame, *columns: str) -> DataFrame:
    key = landing.field("order_key").cast("bigint").alias("order_key")
    return raw.select(key, landing.field("year").alias("year_text"), landing.field("all_cause").alias("count_text"), *columns)


@query
def run_audit(spark, sf_dir):
    """Counts per batch joined to run outcomes: successful, failed, and successful without a record."""
    orders = shapes.table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyyMM")
    landed = orders.select(
        F.concat(F.lit("full_"), month).alias("batch_id"),
        F.lit("orders").alias("source_url"),
        F.col("o_orderdate").alias("ingested_at"),
    )
    months = landed.groupBy("batch_id").agg(
        F.min("ingested_at").cast("date").alias("started_at"), F.max("ingested_at").cast("date").alias("finished_at")
    )
    kinds = F.explode(F.array(F.lit("full"), F.lit("empty")))
    outcomes = months.select(kinds.alias("kind"), "batch_id", "started_at", "finished_at")
    failed = (F.col("kind") == "full") & F.col("batch_id").endswith("02")
    runs = outcomes.select(
        F.when(F.col("kind") == "full", F.col("batch_id")).otherwise(F.concat("kind", F.lit("_"), "batch_id")).alias("batch_id"),
        F.lit("orders").alias("source"),
        F.when(failed, bronze.FAILED).otherwise(bronze.SUCCESS).alias("status"),
        F.when(failed, "source timeout").alias("error_message"),
        "started_at",
        "finished_at",
    )
    return bronze.audit(landed, runs)


@query
def latest_batch(spark, sf_dir):
    """Orders appended as three batches, one per status; the newest is found in the ledger and read back."""
    folder = work_folder(spark, "latest_batch")
    for day, (status, batch_id) in enumerate(STATUS_BATCHES.items(), start=1):
        raw = shapes.order_raw(spark, sf_dir, f"o_orderstatus = '{status}'")
        bronze.append(raw, f"{folder}/bronze", "orders", batch_id, shapes.EARLIER_TS.replace(day=day))
    return _fields(bronze.newest_batch(spark, f"{folder}/bronze"), "batch_id")


@query
def bronze_reingest(spark, sf_dir):
    """An attempt that dies before it is committed, one that stops early, and the whole batch again under the same id."""
    path = f"{work_folder(spark, 'bronze_reingest')}/bronze"
    batch_id = "full_20020201_000000"
    raw = shapes.order_raw(spark, sf_dir)
    bronze.write_attempt(raw, path, "orders", batch_id, shapes.RUN_TS)
    bronze.append(shapes.order_raw(spark, sf_dir, "o_orderstatus = 'F'"), path, "orders", batch_id, shapes.RUN_TS)
    bronze.append(raw, path, "orders", batch_id, shapes.RUN_TS)
    return _fields(bronze.read(spark, path), "source_url", "batch_id")


# --- typed rows -----------------------------------------------------------------------------------------------


def _parsed_orders(spark, sf_dir) -> DataFrame:
    return parsing.parse(shapes.order_raw(spark, sf_dir), mortality.SPEC)


@query
def stage_counts(spark, sf_dir):
    return parsing.stage_counts(_parsed_orders(spark, sf_dir))


@query
def silver_transform(spark, sf_dir):
    return parsing.accepted(_parsed_orders(spark, sf_dir), mortality.SPEC)


@query
def silver_rejects(spark, sf_dir):
    rejects = parsing.rejected(_parsed_orders(spark, sf_dir))
    return rejects.select(landing.field("order_key").cast("bigint").alias("order_key"), parsing.REASON)


@query
def constraint_violations(spark, sf_dir):
    parsed = parsing.parse(shapes.order_raw(spark, sf_dir), mortality.SPEC, constraints=True)
    return parsing.constraint_counts(parsed, mortality.SPEC, mortality.SILVER_KEYS)


@query
def silver_overflow(spark, sf_dir):
    """All orders through ingest and the silver stage, with rows that break a constraint kept aside: those, and why."""
    config = Config(work_folder(spark, "silver_overflow"), "orders", "orders", on_duplicate="last", on_violation="quarantine")
    load_silver(spark, config, ingest(spark, config, lambda: shapes.order_raw(spark, sf_dir), shapes.RUN_TS), shapes.RUN_TS)
    aside = spark.read.parquet(f"{config.root}/staged/*/usable=false")
    return aside.select(landing.field("order_key").cast("bigint").alias("order_key"), parsing.REASON, "batch_id")


# --- upserts --------------------------------------------------------------------------------------------------


def _editions(spark, sf_dir, make: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """A table as an earlier load left it, and the rows of a later load that overlaps it."""
    months = shapes.supplier_months(spark, sf_dir)
    target = make(shapes.earlier(months)).withColumn("loaded_at", F.lit(shapes.EARLIER_TS))
    return target, make(shapes.later(months))


def _with_load_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd"))


@query
def upsert_silver(spark, sf_dir):
    target, source = _editions(spark, sf_dir, lambda months: months)
    return _with_load_text(merge(target, source, mortality.SILVER_KEYS, mortality.SILVER_UPDATE, shapes.RUN_TS))


@query
def upsert_idempotent(spark, sf_dir):
    target, source = _editions(spark, sf_dir, lambda months: months)
    once = merge(target, source, mortality.SILVER_KEYS, mortality.SILVER_UPDATE, shapes.EARLIER_TS)
    return _with_load_text(merge(once, source, mortality.SILVER_KEYS, mortality.SILVER_UPDATE, shapes.RUN_TS))


@query
def upsert_gold(spark, sf_dir):
    target, source = _editions(spark, sf_dir, lambda months: mortality.trends(months, ENTITY))
    return _with_load_text(merge(target, source, mortality.gold_keys(ENTITY)["trends"], run_ts=shapes.RUN_TS))


@query
def upsert_gold_summary(spark, sf_dir):
    target, source = _editions(spark, sf_dir, lambda months: mortality.summary(months, ENTITY))
    return _with_load_text(merge(target, source, mortality.gold_keys(ENTITY)["summary"], run_ts=shapes.RUN_TS))


@query
def upsert_gold_impact(spark, sf_dir):
    def make(months):
        return reporting.prior_year_window(months, ENTITY, "all_cause", "covid_19_underlying")

    target, source = _editions(spark, sf_dir, make)
    return _with_load_text(merge(target, source, mortality.gold_keys(ENTITY)["impact"], run_ts=shapes.RUN_TS))


@query
def dedup_last_by_key(spark, sf_dir):
    items = shapes.table(spark, sf_dir, "lineitem")
    return last_by_key(items, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# --- reporting tables -----------------------------------------------------------------------------------------


@query
def monthly_trends(spark, sf_dir):
    return mortality.trends(shapes.supplier_months(spark, sf_dir), ENTITY)


@query
def monthly_trends_single(spark, sf_dir):
    return mortality.trends(shapes.overall_months(spark, sf_dir))


@query
def cause_summary(spark, sf_dir):
    return mortality.summary(shapes.supplier_months(spark, sf_dir))


@query
def cause_summary_union(spark, sf_dir):
    return reporting.summary_union(shapes.supplier_months(spark, sf_dir), ["year"], "all_cause", mortality.CAUSES)


@query
def cause_summary_by_entity(spark, sf_dir):
    return mortality.summary(shapes.supplier_months(spark, sf_dir), ENTITY)


@query
def prior_year_impact(spark, sf_dir):
    return reporting.prior_year(shapes.supplier_months(spark, sf_dir), ENTITY, "all_cause", "covid_19_underlying")


@query
def prior_year_window(spark, sf_dir):
    return reporting.prior_year_window(shapes.supplier_months(spark, sf_dir), ENTITY, "all_cause", "covid_19_underlying")


@query
def prior_year_single(spark, sf_dir):
    return mortality.impact(shapes.overall_months(spark, sf_dir))


# --- value rules ----------------------------------------------------------------------------------------------


def _order_texts(spark, sf_dir) -> DataFrame:
    return shapes.order_records(spark, sf_dir).withColumn("order_key", F.col("order_key").cast("bigint"))


@query
def scalar_safe_int(spark, sf_dir):
    texts = _order_texts(spark, sf_dir)
    return texts.select("order_key", *[fn.safe_int(F.col(c)).alias(f"{c}_value") for c in ("year", "month", "all_cause")])


@query
def scalar_safe_date(spark, sf_dir):
    texts = _order_texts(spark, sf_dir)
    return texts.select("order_key", *[fn.safe_date(F.col(c)).alias(f"{c}_value") for c in mortality.DATES])


@query
def scalar_any_flag(spark, sf_dir):
    texts = _order_texts(spark, sf_dir)
    return texts.select("order_key", fn.any_flag(F.col(c) for c in mortality.FLAGS).alias("is_provisional"))


@query
def scalar_pct(spark, sf_dir):
    items = shapes.table(spark, sf_dir, "lineitem")
    part = F.expr("CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linenumber END")
    total = F.expr("CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS INT) END")
    price = F.expr("CAST(floor(l_extendedprice) AS INT)")
    quantity = F.expr("CAST(l_quantity AS INT)")
    return items.select(
        "l_orderkey",
        "l_linenumber",
        fn.share_pct(part, total).alias("line_pct"),
        fn.share_pct(quantity, price).alias("price_pct"),
    )


@query
def scalar_json_get(spark, sf_dir):
    events = shapes.table(spark, sf_dir, "events")
    return events.select(
        "event_id", landing.field("k", "props").alias("k_text"), landing.field("absent", "props").alias("absent_text")
    )


@query
def scalar_typed_json(spark, sf_dir):
    """Numbers, booleans and texts of a record, each by the rule of its JSON type."""
    events = shapes.table(spark, sf_dir, "events")
    is_click = F.col("event_type") == "click"
    raw = F.to_json(
        F.struct(
            F.col("user_id").alias("whole"),
            F.col("value").alias("fraction"),
            is_click.alias("truth"),
            F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("text"),
            F.col("event_type").alias("word"),
            F.when(is_click, "").otherwise("0").alias("mark"),
        )
    )
    keys = ("whole", "fraction", "truth", "text", "word", "absent", "mark")
    schema = T.StructType([T.StructField(k, T.VariantType()) for k in keys])
    record = events.select("event_id", F.from_json(raw, schema).alias("record"))
    ints = [fn.typed_int(F.col(f"record.{k}")).alias(f"{k}_value") for k in keys[:-1]]
    flags = [fn.typed_flag(F.col(f"record.{k}")).alias(f"{k}_flag") for k in ("truth", "mark", "fraction", "absent")]
    return record.select("event_id", *ints, *flags)


@query
def scalar_batch_id(spark, sf_dir):
    events = shapes.table(spark, sf_dir, "events")
    return events.select("event_id", fn.batch_id(F.col("ts")).alias("batch_id"))


# --- checks ---------------------------------------------------------------------------------------------------


def _planted(months: DataFrame, name: str) -> DataFrame:
    if name == "trends":
        return planted.plant(mortality.trends(months, ENTITY), planted.TRENDS)
    if name == "summary":
        return planted.plant(mortality.summary(months, ENTITY), planted.SUMMARY)
    return planted.plant(mortality.impact(months, ENTITY), planted.IMPACT)


def supplier_checks() -> list[quality.Check]:
    return mortality.checks(ENTITY, SUPPLIER_LOW, SUPPLIER_HIGH)


def _check_query(check: quality.Check) -> Query:
    def checked(spark, sf_dir):
        rows = _planted(shapes.supplier_months(spark, sf_dir), check.table)
        return quality.report({check.table: rows}, [check])

    return checked


QUERIES.update({f"dq_{check.name}": _check_query(check) for check in supplier_checks()})


@query
def dq_report(spark, sf_dir):
    """All fifteen checks over written tables, as they run before a publication."""
    return quality.report(_planted_tables(spark, sf_dir, "dq_report"), supplier_checks())


def _planted_tables(spark, sf_dir, label: str) -> dict[str, DataFrame]:
    folder = work_folder(spark, label)

    def stored(name: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    months = stored("silver", shapes.supplier_months(spark, sf_dir))
    return {name: stored(name, _planted(months, name)) for name in ("trends", "summary", "impact")}


@query
def dq_incremental(spark, sf_dir):
    """Part of the years is loaded again in full; only its partitions are counted anew, and the report is that of all rows."""
    tables, states = TableSet(spark, work_folder(spark, "dq_incremental")), {}
    for name, rows in _planted_tables(spark, sf_dir, "dq_incremental").items():
        partitions = mortality.gold_layouts(ENTITY)[name].partitions
        checks = [c for c in supplier_checks() if c.table == name]
        table = Layout(name, rows.schema, partitions)
        kept = Layout(f"{name}_checks", quality.state_schema(rows.schema, checks, partitions), partitions)
        for load in (rows.filter("year <= 1998 OR total_deaths % 2 = 0"), rows.filter("year > 1998")):
            values = [tuple(r) for r in load.select(*partitions).distinct().collect()]
            folders = tables.write(table, load, values, new_run())
            state = quality.check_state(tables.read(table, folders), checks, partitions)
            tables.publish({name: folders, kept.name: tables.write(kept, state, values, new_run())}, shapes.RUN_TS)
        states[name] = tables.read(kept)
    return quality.report_from_state(states, supplier_checks())


@query
def dq_offenders(spark, sf_dir):
    """The first three rows or groups that break each check."""
    return quality.all_offenders(_planted_tables(spark, sf_dir, "dq_offenders"), supplier_checks(), mortality.gold_keys(ENTITY))


@query
def dq_failing_groups(spark, sf_dir):
    """The groups behind the two size checks."""
    months = shapes.supplier_months(spark, sf_dir)
    parts = []
    for check in supplier_checks():
        if isinstance(check, (quality.FullGroups, quality.GroupSize)):
            groups = quality.failing_groups(_planted(months, check.table), check)
            parts.append(groups.select(F.lit(check.name).alias("check_name"), *check.group, "row_count"))
    return parts[0].unionByName(parts[1])


# --- the whole chain ------------------------------------------------------------------------------------------


def layered_run(spark: SparkSession, sf_dir: str, months: DataFrame, config: Config) -> TableSet:
    """Two loads, an earlier edition and a later one that revises part of it, through every stage."""
    at_and_rows = ((shapes.EARLIER_TS, shapes.earlier(months)), (shapes.RUN_TS, shapes.later(months)))
    for at, rows in at_and_rows:
        run(spark, config, lambda rows=rows: shapes.as_records(rows), at)
    return TableSet(spark, config.root)


def _single_config(spark: SparkSession, label: str) -> Config:
    folder = work_folder(spark, label)
    return Config(folder, "lineitem", "tables/lineitem", checks=mortality.checks(low=0, high=2_000_000_000))


@query
def layered_trends(spark, sf_dir):
    """Both loads over all suppliers; the published monthly trends."""
    config = _single_config(spark, "layered_trends")
    tables = layered_run(spark, sf_dir, shapes.overall_months(spark, sf_dir), config)
    return _with_load_text(tables.read(mortality.gold_layouts()["trends"]))


@query
def silver_backlog(spark, sf_dir):
    """Both editions land before silver is loaded once: the table that one load of two waiting batches leaves."""
    config = _single_config(spark, "silver_backlog")
    months = shapes.supplier_months(spark, sf_dir)
    for at, rows in ((shapes.EARLIER_TS, shapes.earlier(months)), (shapes.RUN_TS, shapes.later(months))):
        result = ingest(spark, config, lambda rows=rows: shapes.as_records(rows), at)
    load_silver(spark, config, result, shapes.RUN_TS)
    return _with_load_text(TableSet(spark, config.root).read(mortality.SILVER))


@query
def layered_entity_change(spark, sf_dir):
    """Tables published for one jurisdiction, then published again with the jurisdiction in the key."""
    config = _single_config(spark, "layered_entity")
    months = shapes.overall_months(spark, sf_dir)
    tables = layered_run(spark, sf_dir, months, config)
    config.entity, config.checks = ENTITY, mortality.checks(ENTITY, 0, 2_000_000_000)
    build_gold(spark, config, Result(""), shapes.RUN_TS, tables=tables)
    return _with_load_text(tables.read(mortality.gold_layouts(ENTITY)["trends"]))


@query
def layered_impact_by_entity(spark, sf_dir):
    """Both loads per supplier. Suppliers may skip months, so the two checks that forbid gaps are left out."""
    gap_checks = ("trends_full_years", "impact_nulls_earliest_only")
    kept = [c for c in mortality.checks(ENTITY, 0, 2_000_000_000) if c.name not in gap_checks]
    config = _single_config(spark, "layered_impact")
    config.entity, config.checks = ENTITY, kept
    tables = layered_run(spark, sf_dir, shapes.supplier_months(spark, sf_dir), config)
    return _with_load_text(tables.read(mortality.gold_layouts(ENTITY)["impact"]))
