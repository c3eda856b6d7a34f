"""The test tables in the shapes the operators work on.

Two shapes: `orders` as one dirty text record per order, and `lineitem` as monthly counts per supplier (or over
all suppliers). The expressions are valid in Spark SQL and in DuckDB, so the check queries read the same input.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.plans import mortality
from tallyforge.sources.landing import spread

RUN_TS = datetime(2002, 2, 1, tzinfo=timezone.utc)
EARLIER_TS = datetime(2002, 1, 1, tzinfo=timezone.utc)

# --- one record per order -------------------------------------------------------------------------------------

_Y = "CAST(year(o_orderdate) AS STRING)"
_M = "CAST(month(o_orderdate) AS STRING)"
_D = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_P = "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"


def _priority(name: str) -> str:
    return f"CASE WHEN o_orderpriority = '{name}' THEN {_P} ELSE '0' END"


# Every texts a record may carry, clean or not: blanks, padding, signs, decimals, separators, absent keys.
ORDER_FIELDS = {
    "order_key": "CAST(o_orderkey AS STRING)",
    "jurisdiction_of_occurrence": (
        "CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 97 = 1 THEN repeat('x', 101)"
        " ELSE 'J' || CAST(o_custkey AS STRING) END"
    ),
    "year": (
        f"CASE o_orderkey % 13 WHEN 0 THEN '' WHEN 1 THEN ' ' || {_Y} || ' ' WHEN 2 THEN '+' || {_Y}"
        f" WHEN 3 THEN {_Y} || '.0' WHEN 4 THEN 'n/a' WHEN 5 THEN NULL"
        f" WHEN 6 THEN substr({_Y}, 1, 1) || '_' || substr({_Y}, 2, 3) ELSE {_Y} END"
    ),
    "month": f"CASE o_orderkey % 17 WHEN 0 THEN lpad({_M}, 2, '0') WHEN 1 THEN 'Jan' WHEN 2 THEN '13' ELSE {_M} END",
    "start_date": (
        f"CASE o_orderkey % 10 WHEN 0 THEN {_Y} || '-' || {_M} || '-1' WHEN 1 THEN {_Y} || '-' || {_M} || '-1T0'"
        f" WHEN 2 THEN {_Y} || '-02-30T00:00:00.000' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN {_Y} || '-13-01'"
        f" WHEN 6 THEN '0000-01-01' WHEN 7 THEN ' ' || {_D} ELSE {_D} || 'T00:00:00.000' END"
    ),
    "end_date": (
        f"CASE o_orderkey % 6 WHEN 0 THEN substr({_D}, 1, 7) WHEN 1 THEN {_Y} WHEN 2 THEN replace({_D}, '-', '')"
        f" WHEN 3 THEN substr({_D}, 1, 8) || ' 5' ELSE {_D} || 'T00:00:00.000' END"
    ),
    "data_as_of": f"{_D} || 'T00:00:00.000'",
    "all_cause": (
        f"CASE o_orderkey % 19 WHEN 0 THEN {_P} || '.7' WHEN 1 THEN '1e3' WHEN 2 THEN '1,234' WHEN 3 THEN ''"
        f" WHEN 4 THEN '  ' WHEN 5 THEN ' ' || {_P} || ' ' WHEN 6 THEN '+' || {_P} WHEN 7 THEN '-' || {_P}"
        f" WHEN 8 THEN '- ' || {_P} WHEN 9 THEN '000' || {_P} WHEN 10 THEN 'abc' WHEN 11 THEN {_P} || '0000000'"
        f" ELSE {_P} END"
    ),
    "natural_cause": "CAST(o_custkey AS STRING)",
    "diseases_of_heart": _priority("1-URGENT"),
    "malignant_neoplasms": _priority("2-HIGH"),
    "diabetes_mellitus": "CASE WHEN o_totalprice > 300000 THEN '1' ELSE '0' END",
    "alzheimer_disease": _priority("5-LOW"),
    "drug_overdose": f"CASE WHEN o_orderdate >= TIMESTAMP '2001-03-01 00:00:00' THEN NULL ELSE {_priority('4-NOT SPECIFIED')} END",
    "covid_19_underlying_cause": f"CASE WHEN o_orderdate < TIMESTAMP '1997-01-01 00:00:00' THEN NULL ELSE {_priority('3-MEDIUM')} END",
    "accidents_unintentional": "CASE WHEN o_orderstatus = 'O' THEN '1' ELSE '' END",
    "flag_accid": "CASE WHEN o_orderkey % 8 = 0 THEN '' END",
    "flag_mva": "CASE WHEN o_orderkey % 8 = 2 THEN '0' END",
    "flag_suic": "CASE WHEN o_orderkey % 8 = 3 THEN ' ' END",
    "flag_homic": "CASE WHEN o_orderkey % 8 IN (1, 4) THEN 'Data suppressed' END",
    "flag_drugod": "CASE WHEN o_orderkey % 8 IN (4, 5) THEN 'Incomplete' ELSE '' END",
}
ORDER_RECORDS_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in ORDER_FIELDS.items()) + " FROM orders"

# --- monthly counts from lineitem -----------------------------------------------------------------------------

_Q = "CAST(l_quantity AS INT)"


def _sum_if(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN {_Q} ELSE 0 END) AS INT)"


MONTH_KEYS = {"year": "CAST(year(l_shipdate) AS INT)", "month": "CAST(month(l_shipdate) AS INT)"}
SUPPLIER = "'S' || CAST(l_suppkey AS STRING)"
MONTH_SUMS = {
    "start_date": "MIN(CAST(l_shipdate AS DATE))",
    "end_date": "MAX(CAST(l_shipdate AS DATE))",
    "all_cause": f"CAST(SUM({_Q}) AS INT)",
    "natural_cause": _sum_if("l_linestatus = 'F'"),
    "diseases_of_heart": _sum_if("l_returnflag = 'R'"),
    "malignant_neoplasms": _sum_if("l_returnflag = 'A' AND l_linestatus = 'F'"),
    "diabetes_mellitus": _sum_if("l_discount >= 0.05"),
    "alzheimer_disease": _sum_if("l_returnflag = 'N' AND l_linestatus = 'O'"),
    "overdose": _sum_if("l_returnflag = 'N' AND l_linestatus = 'F'"),
    "covid": _sum_if("l_returnflag = 'A' AND l_linestatus = 'O'"),
    "accidents_unintentional": _sum_if("l_tax > 0.04"),
}
# A measure that starts in 1997, and one suppressed (and so flagged) from March 2001 on.
MONTH_COLUMNS = {
    "jurisdiction": "jurisdiction",
    "year": "year",
    "month": "month",
    "start_date": "start_date",
    "end_date": "end_date",
    "data_as_of": "CAST('2002-01-31' AS DATE)",
    "all_cause": "all_cause",
    "natural_cause": "natural_cause",
    "diseases_of_heart": "diseases_of_heart",
    "malignant_neoplasms": "malignant_neoplasms",
    "diabetes_mellitus": "diabetes_mellitus",
    "alzheimer_disease": "alzheimer_disease",
    "drug_overdose": "CASE WHEN year * 100 + month >= 200103 THEN NULL ELSE overdose END",
    "covid_19_underlying": "CASE WHEN year < 1997 THEN NULL ELSE covid END",
    "accidents_unintentional": "accidents_unintentional",
    "is_provisional": "year * 100 + month >= 200103",
}
# The edition of an earlier load: other counts, other bounds, provisional throughout.
EARLIER_COLUMNS = {
    "start_date": "start_date - 1",
    "data_as_of": "CAST('2001-12-31' AS DATE)",
    "all_cause": "all_cause + 7",
    "natural_cause": "natural_cause + 5",
    "diseases_of_heart": "CASE WHEN month = 12 THEN NULL ELSE diseases_of_heart END",
    "is_provisional": "year < 3000",
}
EARLIER_UNTIL, LATER_FROM = "year <= 1998", "year >= 1997"


def _aliased(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


def months_sql(jurisdiction: str = SUPPLIER) -> str:
    grouped = f"SELECT {jurisdiction} AS jurisdiction, {_aliased(MONTH_KEYS | MONTH_SUMS)} FROM lineitem GROUP BY ALL"
    return f"SELECT {_aliased(MONTH_COLUMNS)} FROM ({grouped}) AS grouped"


def earlier_sql(source: str) -> str:
    columns = {c: EARLIER_COLUMNS.get(c, c) for c in MONTH_COLUMNS}
    return f"SELECT {_aliased(columns)} FROM {source} WHERE {EARLIER_UNTIL}"


# --- the same in Spark ----------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_records(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """All texts of every order's record, one column each."""
    orders = spread(table(spark, sf_dir, "orders").filter(where))
    return orders.selectExpr(*[f"{e} AS {n}" for n, e in ORDER_FIELDS.items()])


def order_raw(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """One JSON text per order, column `raw_data`; keys without a value are absent."""
    records = order_records(spark, sf_dir, where)
    return records.select(F.to_json(F.struct(*records.columns)).alias("raw_data"))


def supplier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _months(spark, sf_dir, SUPPLIER)


def overall_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _months(spark, sf_dir, "'ALL'")


def _months(spark: SparkSession, sf_dir: str, jurisdiction: str) -> DataFrame:
    keys = {"jurisdiction": jurisdiction} | MONTH_KEYS
    grouped = table(spark, sf_dir, "lineitem").groupBy(*[F.expr(e).alias(n) for n, e in keys.items()])
    summed = grouped.agg(*[F.expr(e).alias(n) for n, e in MONTH_SUMS.items()])
    return summed.selectExpr(*[f"{e} AS {n}" for n, e in MONTH_COLUMNS.items()])


def earlier(months: DataFrame) -> DataFrame:
    columns = {c: EARLIER_COLUMNS.get(c, c) for c in MONTH_COLUMNS}
    return months.filter(EARLIER_UNTIL).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def later(months: DataFrame) -> DataFrame:
    return months.filter(LATER_FROM)


def as_records(months: DataFrame) -> DataFrame:
    """Monthly rows as the JSON texts a source would send."""
    spec = mortality.SPEC
    texts = {k: F.col(c) for c, k in spec.texts.items()}
    texts |= {k: F.col(c).cast("string") for c, k in spec.ints.items()}
    texts |= {k: F.concat(F.col(c).cast("string"), F.lit("T00:00:00.000")) for c, k in spec.dates.items()}
    texts["flag_drugod"] = F.when(F.col("is_provisional"), "Data not shown")
    return months.select(F.to_json(F.struct(*[e.alias(k) for k, e in texts.items()])).alias("raw_data"))
