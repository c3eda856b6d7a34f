"""Each operator against the obvious way of writing it, on the same input. Prints seconds, best of three."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators import parse as parsing
from tallyforge.operators import quality, reporting
from tallyforge.operators.upsert import last_by_key, merge
from tallyforge.plans import mortality
from tallyforge.session import build_session, work_folder
from tallyforge.sources.landing import spread
from workload import shapes
from workload.queries import ENTITY, supplier_checks

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def line_records(spark) -> DataFrame:
    """One JSON text per lineitem row."""
    items = shapes.table(spark, SF_DIR, "lineitem")
    quantity = F.col("l_quantity").cast("int").cast("string")
    texts = {
        "jurisdiction_of_occurrence": F.concat(F.lit("S"), F.col("l_suppkey").cast("string")),
        "year": F.year("l_shipdate").cast("string"),
        "month": F.month("l_shipdate").cast("string"),
        "start_date": F.date_format("l_shipdate", "yyyy-MM-dd'T'00:00:00.000"),
        "data_as_of": F.lit("2002-01-31T00:00:00.000"),
        "all_cause": quantity,
        "natural_cause": F.when(F.col("l_linenumber") == 3, "12.7").when(F.col("l_linenumber") == 5, "").otherwise(quantity),
        "flag_drugod": F.when(F.col("l_returnflag") == "N", "Incomplete"),
    }
    return items.select(F.to_json(F.struct(*[c.alias(k) for k, c in texts.items()])).alias("raw_data"))


def python_parse(raw: DataFrame) -> DataFrame:
    """The same casts, one Python call per record."""

    def number(text):
        try:
            return int(text)
        except (TypeError, ValueError):
            return None

    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in mortality.SPEC.ints])

    @F.udf(schema)
    def record(text):
        found = json.loads(text)
        return tuple(number(found.get(k)) for k in mortality.SPEC.ints.values())

    return raw.select(record("raw_data").alias("r")).select("r.*").filter("year IS NOT NULL AND month IS NOT NULL")


def aggregate_dedup(items: DataFrame) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in items.columns if c not in [*keys, "l_shipdate"]]
    kept = items.groupBy(*keys).agg(F.max(F.struct("l_shipdate", *rest)).alias("last"))
    return kept.select(*keys, "last.*")


def one_by_one(tables: dict[str, DataFrame]) -> list[DataFrame]:
    return [quality.report(tables, [check]) for check in supplier_checks()]


def main() -> None:
    spark = build_session("forms", shuffle_partitions=8, master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    folder = work_folder(spark, "forms")

    def stored(name: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    raw = stored("raw", spread(line_records(spark)))
    months = stored("months", shapes.supplier_months(spark, SF_DIR))
    items = shapes.table(spark, SF_DIR, "lineitem")
    tables = {
        "trends": stored("trends", mortality.trends(months, ENTITY)),
        "summary": stored("summary", mortality.summary(months, ENTITY)),
        "impact": stored("impact", mortality.impact(months, ENTITY)),
    }
    total, part = "all_cause", "covid_19_underlying"
    old, new = shapes.earlier(months), shapes.later(months)
    forms = {
        "parse: native": lambda: [parsing.accepted(parsing.parse(raw, mortality.SPEC), mortality.SPEC)],
        "parse: Python UDF": lambda: [python_parse(raw)],
        "summary: one aggregate": lambda: [mortality.summary(months)],
        "summary: union of six": lambda: [reporting.summary_union(months, ["year"], total, mortality.CAUSES)],
        "prior year: range window": lambda: [reporting.prior_year_window(months, ENTITY, total, part)],
        "prior year: self-join": lambda: [reporting.prior_year_join(months, ENTITY, total, part)],
        "checks: fused report": lambda: [quality.report(tables, supplier_checks())],
        "checks: one by one": lambda: one_by_one(tables),
        "last row per key: window": lambda: [last_by_key(items, ["l_orderkey", "l_linenumber"], ["l_shipdate"])],
        "last row per key: aggregate": lambda: [aggregate_dedup(items)],
        "upsert: source must be unique": lambda: [merge(old, new, mortality.SILVER_KEYS)],
        "upsert: last row counts": lambda: [merge(old, new, mortality.SILVER_KEYS, on_duplicate="last")],
    }
    for name, make in forms.items():
        best = float("inf")
        for _ in range(3):
            start = time.perf_counter()
            for rows in make():
                rows.write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        print(f"{name:32s} {best:6.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
