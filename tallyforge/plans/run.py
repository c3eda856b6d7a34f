"""The stages in order: ingest, silver, gold, checks. An error stops the later stages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators import quality
from tallyforge.operators.constraints import ConstraintError, describe, enforce
from tallyforge.operators.parse import BROKEN, REASON, parse
from tallyforge.operators.upsert import fold_batches, merge
from tallyforge.plans import mortality
from tallyforge.sources import bronze, ledger
from tallyforge.sources.landing import spread
from tallyforge.sources.ledger import Batch, Ledger
from tallyforge.sources.versions import Layout, TableSet, by_partition, new_run, remove_path

GOLD_BUILT_FROM = "_gold_built_from"
BATCH = ("ingested_at", "batch_id")
# Conditions that rows raise, as against those of machines: a batch that meets one is not tried again by itself.
ROW_CONDITIONS = ("[USER_RAISED_EXCEPTION]", "[CAST_OVERFLOW", "[NUMERIC_VALUE_OUT_OF_RANGE", "[CAST_INVALID_INPUT]")


@dataclass
class Config:
    """What one run needs. `entity` is () for one jurisdiction, ("jurisdiction",) to report on each.

    on_violation="quarantine" keeps rows that break a constraint of the silver table aside with its name, "error" stops
    the load; null_jurisdiction="reject" keeps aside rows without a jurisdiction in either case.
    """

    root: str
    source: str
    source_url: str
    batch_prefix: str = "full_"
    entity: Sequence[str] = ()
    on_duplicate: str = "error"
    duplicate_order: Sequence[str] = ("data_as_of",)
    null_jurisdiction: str = "error"
    on_violation: str = "error"
    typed_json: bool = False
    checks: Sequence[quality.Check] = field(default_factory=mortality.checks)


@dataclass
class Result:
    batch_id: str
    received: int = 0
    inserted: int = 0
    transformed: int = 0
    dropped: int = 0
    upserted: int = 0
    violations: dict = field(default_factory=dict)
    batches: list = field(default_factory=list)
    high_water: datetime | None = None
    silver_years: list = field(default_factory=list)
    gold_years: list = field(default_factory=list)
    report: list = field(default_factory=list)


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def run(spark: SparkSession, config: Config, landed: Callable[[], DataFrame], run_ts: datetime | None = None) -> Result:
    """All stages. `landed` gives the records to ingest (column `raw_data`), so that its failure is audited too."""
    at = run_ts or utc_now()
    tables = TableSet(spark, config.root)
    result = ingest(spark, config, landed, at)
    load_silver(spark, config, result, at, tables)
    build_gold(spark, config, result, at, tables=tables)
    return result


def ingest(spark: SparkSession, config: Config, landed: Callable[[], DataFrame], at: datetime) -> Result:
    """Append one batch and its audit row. A failure is audited in a write of its own and raised again."""
    batch_id = f"{config.batch_prefix}{at.astimezone(timezone.utc):%Y%m%d_%H%M%S}"
    audit = f"{config.root}/audit"
    try:
        n = bronze.append(landed(), f"{config.root}/bronze", config.source_url, batch_id, at)
    except Exception as error:
        bronze.log_run(spark, audit, batch_id, config.source, bronze.FAILED, 0, str(error), at, utc_now())
        raise
    bronze.log_run(spark, audit, batch_id, config.source, bronze.SUCCESS, n, None, at, utc_now())
    return Result(batch_id=batch_id, received=n, inserted=n)


def load_silver(spark: SparkSession, config: Config, result: Result | None, at: datetime, tables: TableSet | None = None) -> Result:
    """Load every batch that waits in the ledger, together and each once; without any, the newest one again.

    If rows of one of them break the load, the batches are loaded one by one, and those that fail are marked so and left
    out from then on until they are ingested again. If silver was published with another key, other partitions or other
    columns, it is built afresh from all batches that did not fail.
    """
    tables, book = tables or TableSet(spark, config.root), Ledger(spark, f"{config.root}/bronze")
    known = book.batches()
    if not known:
        raise ValueError(bronze.EMPTY)
    result = result or Result(batch_id=known[-1].batch_id)
    if tables.changed([mortality.SILVER]):
        waiting = [b for b in known if b.state != ledger.FAILED]
    else:
        waiting = ledger.backlog(known) or known[-1:]
    failures = []
    try:
        _load(spark, config, waiting, result, at, tables)
    except Exception as error:
        if not _raised_by_rows(error):
            raise
        failures = [error] if len(waiting) == 1 else _load_one_by_one(spark, config, waiting, result, at, tables, book)
        if len(waiting) == 1:
            book.mark(waiting, ledger.FAILED)
    else:
        book.mark(waiting, ledger.LOADED)
    result.high_water = ledger.high_water(book.batches())
    if failures:
        raise failures[0]
    return result


def _raised_by_rows(error: Exception) -> bool:
    return isinstance(error, ConstraintError) or any(condition in str(error) for condition in ROW_CONDITIONS)


def _load_one_by_one(spark, config: Config, batches: list[Batch], result: Result, at: datetime, tables: TableSet, book: Ledger) -> list[Exception]:
    failures = []
    for batch in batches:
        try:
            _load(spark, config, [batch], result, at, tables)
        except Exception as error:
            if not _raised_by_rows(error):
                raise
            failures.append(error)
            book.mark([batch], ledger.FAILED)
        else:
            book.mark([batch], ledger.LOADED)
    return failures


def _load(spark: SparkSession, config: Config, batches: list[Batch], result: Result, at: datetime, tables: TableSet) -> None:
    """Parse the batches once into a staged table, then upsert the months they touch. Others are neither read nor written."""
    layout, path = mortality.SILVER, f"{config.root}/staged/run={new_run()}"
    staged = _stage(spark, config, bronze.read(spark, f"{config.root}/bronze", batches), result, path)
    touched = _partitions(staged, layout.partitions)
    afresh = tables.changed([layout])
    current = {} if afresh else tables.folders(layout.name)
    target = tables.read(layout, [current[f] for f in map(layout.folder, touched) if f in current])
    defaults = {"is_provisional": F.lit(False), "loaded_at": F.lit(at).cast("timestamp")}
    columns = T.StructType([*layout.schema, *[f for f in bronze.BRONZE_SCHEMA if f.name in BATCH]])
    source = enforce(staged, columns, lengths=mortality.SPEC.lengths, defaults=defaults)
    keys, update = mortality.SILVER_KEYS, mortality.SILVER_UPDATE
    if len(batches) > 1:
        source = fold_batches(source, keys, BATCH, update, config.on_duplicate, config.duplicate_order)
        merged = merge(target, source, keys, update, run_ts=at)
    else:
        merged = merge(target, source, keys, update, at, config.on_duplicate, config.duplicate_order)
    if touched:
        folders = tables.write(layout, merged, touched, new_run())
        tables.publish({layout.name: folders}, at, layouts=[layout], afresh=afresh)
    remove_path(spark, f"{path}/usable=true")  # now in silver; the rejects stay
    result.upserted, result.batches = result.transformed, [b.batch_id for b in batches]
    result.silver_years = sorted({year for year, _ in touched})


def _stage(spark: SparkSession, config: Config, batch: DataFrame, result: Result, path: str) -> DataFrame:
    """Typed rows of the batches, read back from the one write that also keeps the rejects and counts every constraint."""
    parsed = parse(spread(batch), mortality.SPEC, config.typed_json, filters_follow=False, carry=BATCH, constraints=True)
    names = [f"{kind}:{column}" for kind, column in mortality.SPEC.constraints()]
    aside = [n for n in names if config.on_violation == "quarantine" or (n == "not_null:jurisdiction" and config.null_jurisdiction == "reject")]
    identified, parts = F.col(REASON).isNull(), [F.lit(n) for n in aside]
    first = F.get(F.array_intersect(BROKEN, F.array(*parts)), 0) if parts else F.lit(None).cast("string")
    parsed = parsed.withColumn(BROKEN, F.when(identified, F.col(BROKEN)).otherwise(F.array())).withColumn(REASON, F.coalesce(REASON, first))
    usable = F.col(REASON).isNull()
    seen = Observation("parse")
    counts = [F.count_if(F.array_contains(BROKEN, n)).alias(f"v{i}") for i, n in enumerate(names)]
    counted = parsed.observe(seen, F.count(F.lit(1)).alias("received"), F.count_if(usable).alias("usable"), *counts)
    text_if_rejected = F.when(~usable, F.col("raw_data")).alias("raw_data")
    columns = [text_if_rejected, *BATCH, *mortality.SPEC.columns(), REASON, usable.alias("usable")]
    placed = counted.select(*columns)
    placed.write.partitionBy("usable").parquet(path)
    found = seen.get
    result.transformed, result.dropped = found["usable"], found["received"] - found["usable"]
    result.violations = {n: found[f"v{i}"] for i, n in enumerate(names)}
    broken = [n.split(":") for n, count in result.violations.items() if count and n not in aside]
    if broken:
        says = [describe(kind, c, mortality.SPEC.lengths.get(c), result.violations[f"{kind}:{c}"]) for kind, c in broken]
        raise ConstraintError("; ".join(says))
    return spark.read.schema(placed.schema).parquet(path).filter(F.col("usable")).select(*BATCH, *mortality.SPEC.columns())


def _partitions(rows: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """Distinct values of the partition columns: as many as the folders that are written next."""
    return sorted(tuple(r) for r in rows.select(*columns).distinct().collect())


def build_gold(
    spark: SparkSession, config: Config, result: Result, at: datetime, rebuild: bool = False, tables: TableSet | None = None
) -> Result:
    """Upsert the reporting tables for the months whose silver folder changed since the last publication,
    check the outcome as it would be, and only then publish all three together.

    A month's impact also depends on the silver rows of the same month a year before, so that of the year after a changed
    one follows it; a year's summary depends on all of its months. Tables that were published with another key, other
    partitions or other columns keep nothing of that, and everything is built again. What the checks count is kept per
    partition beside each table, so that they read only the partitions written here.
    """
    tables = tables or TableSet(spark, config.root)
    entity, layouts, run_id = config.entity, mortality.gold_layouts(config.entity), new_run()
    states = {name: _state_layout(layout, config.checks) for name, layout in layouts.items()}
    afresh = tables.changed([*layouts.values(), *states.values()])
    _, published = tables.published()
    silver = by_partition(published.get(mortality.SILVER.name, []))
    silver_now = {tuple(map(int, mortality.SILVER.values(folder))): folder for folder in silver.values()}
    built_from = set() if rebuild or afresh & set(layouts) else set(published.get(GOLD_BUILT_FROM, []))
    changed = sorted(month for month, folder in silver_now.items() if folder not in built_from)
    is_changed = set(changed)
    years = sorted({year for year, _ in changed})
    followed = sorted(m for m in silver_now if m in is_changed or (m[0] - 1, m[1]) in is_changed)
    needed = {*followed, *[(y - 1, m) for y, m in followed]}

    def read(months) -> DataFrame:
        return tables.read(mortality.SILVER, [folder for month, folder in silver_now.items() if month in months])

    def only(rows: DataFrame, months: list[tuple]) -> DataFrame:
        return rows.filter((F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in months]))

    sources = {
        "trends": (lambda: mortality.trends(read(is_changed), entity), changed),
        "summary": (lambda: mortality.summary(read({m for m in silver_now if m[0] in years}), entity), [(y,) for y in years]),
        "impact": (lambda: only(mortality.impact(read(needed), entity), followed), followed),
    }

    def build(name: str) -> tuple[dict[str, list[str]], list[str], DataFrame]:
        """Folders added to the table and to its check state, all folders of the table, and the state as it will be."""
        layout, current = layouts[name], {} if name in afresh else by_partition(published.get(name, []))
        rows, touched = sources[name]
        added = []
        if touched:
            stamped = enforce(rows(), layout.schema, defaults={"loaded_at": F.lit(at).cast("timestamp")})
            target = tables.read(layout, [current[f] for f in map(layout.folder, touched) if f in current])
            added = tables.write(layout, merge(target, stamped, layout.keys, run_ts=at), touched, run_id)
        ready = {**current, **by_partition(added)}
        state, kept = states[name], {} if {name, states[name].name} & afresh else by_partition(published.get(states[name].name, []))
        uncounted = {p: folder for p, folder in ready.items() if not kept or folder in added}
        if uncounted:
            mine = [c for c in config.checks if c.table == name]
            fresh = quality.check_state(tables.read(layout, list(uncounted.values())), mine, layout.partitions)
            anew = sorted({layout.values(folder)[: len(state.partitions)] for folder in uncounted.values()})
            older = tables.read(state, [kept[f] for f in map(state.folder, anew) if f in kept])
            counted = spark.createDataFrame([tuple(map(int, layout.values(f))) for f in uncounted.values()], _only(layout.schema, layout.partitions))
            whole = older.join(counted, list(layout.partitions), "left_anti").unionByName(fresh)
            kept |= by_partition(tables.write(state, whole, anew, run_id))
        folders = {name: added, state.name: list(kept.values())}
        return folders, list(ready.values()), tables.read(state, list(kept.values()))

    # Three independent jobs: started together, the short ones fill the tail of the long one.
    with ThreadPoolExecutor(len(sources)) as pool:
        built = dict(zip(sources, pool.map(build, sources)))

    report = quality.report_from_state({name: state for name, (_, _, state) in built.items()}, config.checks)
    ready = lambda: {name: tables.read(layouts[name], folders) for name, (_, folders, _) in built.items()}
    result.report = quality.gate(report, _explain(ready, config))
    folders = {name: added for made, _, _ in built.values() for name, added in made.items()}
    if changed or afresh:
        notes = {GOLD_BUILT_FROM: sorted(silver_now.values())}
        tables.publish(folders, at, notes, [*layouts.values(), *states.values()], afresh)
    result.gold_years = years
    return result


def _state_layout(layout: Layout, checks: Sequence[quality.Check]) -> Layout:
    """Where the counts of a table's checks are kept: a few rows per month, so a year of them is one folder.

    Its columns change with the checks, and so does its fingerprint.
    """
    mine = [c for c in checks if c.table == layout.name]
    return Layout(f"{layout.name}_checks", quality.state_schema(layout.schema, mine, layout.partitions), layout.partitions[:1])


def _only(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    return T.StructType([schema[n] for n in names])


def published_tables(spark: SparkSession, config: Config) -> dict[str, DataFrame]:
    """Silver and the reporting tables as last published."""
    tables = TableSet(spark, config.root)
    layouts = [mortality.SILVER, *mortality.gold_layouts(config.entity).values()]
    return {layout.name: tables.read(layout) for layout in layouts}


def register_views(spark: SparkSession, config: Config) -> None:
    """Temporary views `silver`, `trends`, `summary` and `impact` for SQL over the published tables."""
    for name, rows in published_tables(spark, config).items():
        rows.createOrReplaceTempView(name)


def check(spark: SparkSession, config: Config) -> list:
    """The checks over all rows of the published reporting tables; QualityError if one fails."""
    ready = published_tables(spark, config)
    return quality.gate(quality.report(ready, config.checks), _explain(lambda: ready, config))


def _explain(tables: Callable[[], dict[str, DataFrame]], config: Config) -> Callable[[list[str]], DataFrame | None]:
    """For the gate: the first rows or groups that break the named checks. The tables are opened only then."""

    def explain(names: list[str]) -> DataFrame | None:
        failed = [c for c in config.checks if c.name in names and not isinstance(c, quality.MinRows)]
        return quality.all_offenders(tables(), failed, mortality.gold_keys(config.entity)) if failed else None

    return explain
