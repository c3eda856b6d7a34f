"""DuckDB SQL for every query, written from the rules and not from the Spark code. Only the input shapes are shared."""

from __future__ import annotations

from workload import planted, shapes

ORDER_RECORDS = f"records AS ({shapes.ORDER_RECORDS_SQL})"
MONTHS = f"months AS MATERIALIZED ({shapes.months_sql()})"
OVERALL = f"months AS MATERIALIZED ({shapes.months_sql(chr(39) + 'ALL' + chr(39))})"
EARLIER = f"earlier AS ({shapes.earlier_sql('months')})"
LATER = f"later AS (SELECT * FROM months WHERE {shapes.LATER_FROM})"

SILVER_COUNTS = [
    "all_cause",
    "natural_cause",
    "diseases_of_heart",
    "malignant_neoplasms",
    "diabetes_mellitus",
    "alzheimer_disease",
    "drug_overdose",
    "covid_19_underlying",
    "accidents_unintentional",
]


def as_int(text: str) -> str:
    return (
        rf"CASE WHEN regexp_full_match({text}, '\s*[+-]?[0-9]+(_[0-9]+)*\s*')"
        f" THEN TRY_CAST(replace(trim({text}), '_', '') AS INTEGER) END"
    )


def as_date(text: str) -> str:
    head = f"substr({text}, 1, 10)"
    pattern = "[0-9]{4}-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
    good = f"regexp_full_match({head}, '{pattern}') AND {head} NOT LIKE '0000%'"
    return f"CASE WHEN {good} THEN TRY_CAST(replace({head}, ' ', '') AS DATE) END"


def pct(part: str, total: str) -> str:
    ratio = f"CAST({part} AS DOUBLE) / NULLIF({total}, 0) * 100"
    return f"CAST(ROUND(CAST({ratio} AS DECIMAL(18,12)), 2) AS DECIMAL(5,2))"


def mean(column: str) -> str:
    ratio = f"CAST(SUM({column}) AS DOUBLE) / NULLIF(COUNT({column}), 0)"
    return f"CAST(ROUND(CAST({ratio} AS DECIMAL(18,8)), 2) AS DECIMAL(10,2))"


ANY_FLAG = " OR ".join(
    f"(f.{c} IS NOT NULL AND f.{c} <> '')" for c in ("flag_accid", "flag_mva", "flag_suic", "flag_homic", "flag_drugod")
)

# Casts every order's texts; `f` are the texts.
TYPED_ORDERS = f"""typed AS (
  SELECT CAST(f.order_key AS BIGINT) AS order_key, f.jurisdiction_of_occurrence AS jurisdiction,
    {as_int("f.year")} AS year, {as_int("f.month")} AS month,
    {as_date("f.start_date")} AS start_date, {as_date("f.end_date")} AS end_date, {as_date("f.data_as_of")} AS data_as_of,
    {", ".join(f"{as_int('f.' + c)} AS {c}" for c in SILVER_COUNTS if c != "covid_19_underlying")},
    {as_int("f.covid_19_underlying_cause")} AS covid_19_underlying,
    ({ANY_FLAG}) AS is_provisional
  FROM records f)"""

# measure, and its name in the monthly report; the shares follow the counts
SHARES = [("diseases_of_heart", "heart_disease"), ("malignant_neoplasms", "cancer"), ("covid_19_underlying", "covid"), ("drug_overdose", "drug_overdose")]
TRENDS_SELECT = ", ".join(
    ["year", "month", "all_cause AS total_deaths"]
    + [f"{c} AS {name}_deaths" for c, name in SHARES]
    + [f"{pct(c, 'all_cause')} AS {name}_pct" for c, name in SHARES]
    + ["is_provisional"]
)
TRENDS_COLUMNS = [
    "jurisdiction",
    "year",
    "month",
    "total_deaths",
    "heart_disease_deaths",
    "cancer_deaths",
    "covid_deaths",
    "drug_overdose_deaths",
    "heart_disease_pct",
    "cancer_pct",
    "covid_pct",
    "drug_overdose_pct",
    "is_provisional",
]
SUMMARY_COLUMNS = ["jurisdiction", "year", "cause", "total_deaths", "avg_monthly_deaths", "pct_of_all_deaths"]
IMPACT_COLUMNS = [
    "jurisdiction",
    "year",
    "month",
    "total_deaths",
    "covid_deaths",
    "non_covid_deaths",
    "covid_pct",
    "excess_vs_prev_year",
]
CAUSE_OF = {
    "diseases_of_heart": "Heart Disease",
    "malignant_neoplasms": "Cancer",
    "covid_19_underlying": "COVID-19",
    "drug_overdose": "Drug Overdose",
    "alzheimer_disease": "Alzheimer Disease",
    "diabetes_mellitus": "Diabetes",
}


def trends_of(source: str) -> str:
    return f"SELECT jurisdiction, {TRENDS_SELECT} FROM {source}"


def summary_of(source: str, keys: str) -> str:
    """Grouped once; then one struct per cause, unnested."""
    sums = ", ".join(f"SUM({c}) AS s_{c}, {mean(c)} AS a_{c}, {pct(f'SUM({c})', 'SUM(all_cause)')} AS p_{c}" for c in CAUSE_OF)
    causes = ", ".join(f"{{'cause': '{name}', 's': CAST(s_{c} AS BIGINT), 'a': a_{c}, 'p': p_{c}}}" for c, name in CAUSE_OF.items())
    return f"""SELECT {keys}, x.cause, x.s AS total_deaths, x.a AS avg_monthly_deaths, x.p AS pct_of_all_deaths
      FROM (SELECT {keys}, unnest([{causes}]) AS x FROM (SELECT {keys}, {sums} FROM {source} GROUP BY {keys}) AS grouped) AS long"""


def impact_of(source: str, keys: str = "jurisdiction, year, month") -> str:
    """The prior year's total is looked up by a range over the years of one month."""
    return f"""SELECT {keys}, all_cause AS total_deaths, covid_19_underlying AS covid_deaths,
      all_cause - COALESCE(covid_19_underlying, 0) AS non_covid_deaths, {pct("covid_19_underlying", "all_cause")} AS covid_pct,
      all_cause - MAX(all_cause) OVER (PARTITION BY jurisdiction, month ORDER BY year RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS excess_vs_prev_year
    FROM {source}"""


def upsert_sql(columns: list[str], keys: list[str], first_write: tuple[str, ...] = ()) -> str:
    """Rows of `old` and `new` after the upsert, by three disjoint cases."""
    on = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    matched = ", ".join(f"o.{c}" if c in first_write else f"n.{c}" for c in columns)
    added, kept = ", ".join(f"n.{c}" for c in columns), ", ".join(f"o.{c}" for c in columns)
    return f"""SELECT {matched}, '2002-02-01' AS loaded_at FROM old o JOIN new n ON {on}
      UNION ALL SELECT {added}, '2002-02-01' FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE {on})
      UNION ALL SELECT {kept}, '2002-01-01' FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE {on})"""


SILVER_COLUMNS = list(shapes.MONTH_COLUMNS)
MONTHLY_KEYS, CAUSE_KEYS = ["jurisdiction", "year", "month"], ["jurisdiction", "year", "cause"]
UPSERT_SILVER = f"""WITH {MONTHS}, old AS ({shapes.earlier_sql("months")}), new AS (SELECT * FROM months WHERE {shapes.LATER_FROM})
  {upsert_sql(SILVER_COLUMNS, MONTHLY_KEYS, ("start_date", "end_date"))}"""


def upsert_gold(make, columns: list[str], keys: list[str]) -> str:
    return f"""WITH {MONTHS}, {EARLIER}, {LATER}, old AS MATERIALIZED ({make("earlier")}), new AS MATERIALIZED ({make("later")})
      {upsert_sql(columns, keys)}"""


RAW_COLUMNS = "CAST(order_key AS BIGINT) AS order_key, year AS year_text, all_cause AS count_text"

INT_KEYS = {"year": "year", "month": "month"} | {c: "covid_19_underlying_cause" if c == "covid_19_underlying" else c for c in SILVER_COUNTS}


def too_large(text: str) -> str:
    whole = rf"regexp_full_match({text}, '\s*[+-]?[0-9]+(_[0-9]+)*\s*')"
    return f"{whole} AND ABS(TRY_CAST(replace(trim({text}), '_', '') AS HUGEINT)) > 2147483647"


ORACLES: dict[str, str] = {
    "bronze_ingest": f"""WITH {ORDER_RECORDS}
      SELECT {RAW_COLUMNS}, 'orders' AS source_url, 'full_20020201_000000' AS batch_id FROM records""",
    "bronze_source_filter": f"WITH {ORDER_RECORDS} SELECT {RAW_COLUMNS} FROM records WHERE year >= '1997'",
    "bronze_page": f"""WITH {ORDER_RECORDS} SELECT {RAW_COLUMNS} FROM (
      SELECT * FROM records ORDER BY data_as_of, order_key LIMIT 2000 OFFSET 100) AS one_page""",
    "landing_array": f"WITH {ORDER_RECORDS} SELECT {RAW_COLUMNS} FROM records",
    "run_audit": """WITH counts AS (
        SELECT strftime(o_orderdate, '%Y%m') AS ym, COUNT(*) AS n, CAST(MIN(o_orderdate) AS DATE) AS started_at,
          CAST(MAX(o_orderdate) AS DATE) AS finished_at FROM orders GROUP BY 1)
      SELECT 'full_' || ym AS batch_id, 'orders' AS source,
        CASE WHEN ym LIKE '%02' THEN 'failed' ELSE 'success' END AS status,
        CAST(CASE WHEN ym LIKE '%02' THEN 0 ELSE n END AS BIGINT) AS rows_ingested,
        CASE WHEN ym LIKE '%02' THEN 'source timeout' END AS error_message, started_at, finished_at FROM counts
      UNION ALL SELECT 'empty_full_' || ym, 'orders', 'success', CAST(0 AS BIGINT), NULL, started_at, finished_at FROM counts""",
    "latest_batch": f"""WITH {ORDER_RECORDS} SELECT {RAW_COLUMNS}, 'full_20020103_000000' AS batch_id FROM records
      WHERE CAST(order_key AS BIGINT) IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
    "bronze_reingest": f"""WITH {ORDER_RECORDS}
      SELECT {RAW_COLUMNS}, 'orders' AS source_url, 'full_20020201_000000' AS batch_id FROM records""",
    "stage_counts": f"""WITH {ORDER_RECORDS}, {TYPED_ORDERS}, n AS (
        SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE year IS NOT NULL AND month IS NOT NULL) AS usable FROM typed)
      SELECT 'received' AS stage, total AS n FROM n UNION ALL SELECT 'inserted', total FROM n
      UNION ALL SELECT 'transformed', usable FROM n UNION ALL SELECT 'dropped', total - usable FROM n
      UNION ALL SELECT 'upserted', usable FROM n""",
    "silver_transform": f"""WITH {ORDER_RECORDS}, {TYPED_ORDERS}
      SELECT * EXCLUDE (order_key) FROM typed WHERE year IS NOT NULL AND month IS NOT NULL""",
    "silver_rejects": f"""WITH {ORDER_RECORDS}, {TYPED_ORDERS}
      SELECT order_key, CASE WHEN year IS NULL THEN 'no_year' ELSE 'no_month' END AS reject_reason
      FROM typed WHERE year IS NULL OR month IS NULL""",
    "constraint_violations": f"""WITH {ORDER_RECORDS}, {TYPED_ORDERS},
        usable AS (SELECT * FROM typed WHERE year IS NOT NULL AND month IS NOT NULL),
        wide AS (SELECT {", ".join(f"COUNT(*) FILTER (WHERE {too_large(key)}) AS {c}" for c, key in INT_KEYS.items())} FROM records)
      SELECT 'not_null' AS "constraint", 'jurisdiction' AS column_name, COUNT(*) AS violations FROM usable WHERE jurisdiction IS NULL
      UNION ALL SELECT 'max_length', 'jurisdiction', COUNT(*) FROM usable WHERE length(jurisdiction) > 100
      UNION ALL SELECT 'unique_key', 'jurisdiction,year,month', COUNT(*) FROM (
        SELECT 1 FROM usable GROUP BY jurisdiction, year, month HAVING COUNT(*) > 1) AS repeated
      {" ".join(f"UNION ALL SELECT 'int_range', '{c}', {c} FROM wide" for c in ["year", "month", *SILVER_COUNTS])}""",
    "silver_overflow": f"""WITH {ORDER_RECORDS}, {TYPED_ORDERS},
        reasons AS (SELECT CAST(order_key AS BIGINT) AS order_key, CASE WHEN jurisdiction_of_occurrence IS NULL THEN 'not_null:jurisdiction'
          WHEN length(jurisdiction_of_occurrence) > 100 THEN 'max_length:jurisdiction'
          {" ".join(f"WHEN {too_large(key)} THEN 'int_range:{c}'" for c, key in INT_KEYS.items())} END AS broken FROM records)
      SELECT t.order_key, CASE WHEN year IS NULL THEN 'no_year' WHEN month IS NULL THEN 'no_month' ELSE broken END AS reject_reason,
        'full_20020201_000000' AS batch_id FROM typed t JOIN reasons USING (order_key)
      WHERE year IS NULL OR month IS NULL OR broken IS NOT NULL""",
    "upsert_silver": UPSERT_SILVER,
    "upsert_idempotent": UPSERT_SILVER,
    "upsert_gold": upsert_gold(trends_of, TRENDS_COLUMNS, MONTHLY_KEYS),
    "upsert_gold_summary": upsert_gold(lambda s: summary_of(s, "jurisdiction, year"), SUMMARY_COLUMNS, CAUSE_KEYS),
    "upsert_gold_impact": upsert_gold(impact_of, IMPACT_COLUMNS, MONTHLY_KEYS),
    "dedup_last_by_key": """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
          l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) AS ranked WHERE rn = 1""",
    "monthly_trends": f"WITH {MONTHS} {trends_of('months')}",
    "monthly_trends_single": f"WITH {OVERALL} SELECT {TRENDS_SELECT} FROM months",
    "cause_summary": f"WITH {MONTHS} {summary_of('months', 'year')}",
    "cause_summary_union": f"WITH {MONTHS} {summary_of('months', 'year')}",
    "cause_summary_by_entity": f"WITH {MONTHS} {summary_of('months', 'jurisdiction, year')}",
    "prior_year_impact": f"WITH {MONTHS} {impact_of('months')}",
    "prior_year_window": f"WITH {MONTHS} {impact_of('months')}",
    "prior_year_single": f"WITH {OVERALL} {impact_of('months', 'year, month')}",
    "scalar_safe_int": f"""WITH {ORDER_RECORDS} SELECT CAST(order_key AS BIGINT) AS order_key, {as_int("year")} AS year_value,
      {as_int("month")} AS month_value, {as_int("all_cause")} AS all_cause_value FROM records""",
    "scalar_safe_date": f"""WITH {ORDER_RECORDS} SELECT CAST(order_key AS BIGINT) AS order_key,
      {as_date("start_date")} AS start_date_value, {as_date("end_date")} AS end_date_value,
      {as_date("data_as_of")} AS data_as_of_value FROM records""",
    "scalar_any_flag": f"""WITH {ORDER_RECORDS} SELECT CAST(f.order_key AS BIGINT) AS order_key, ({ANY_FLAG}) AS is_provisional
      FROM records f""",
    "scalar_pct": f"""WITH items AS (SELECT l_orderkey, l_linenumber,
        CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linenumber END AS part,
        CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS total,
        CAST(l_quantity AS INTEGER) AS quantity, CAST(floor(l_extendedprice) AS INTEGER) AS price FROM lineitem)
      SELECT l_orderkey, l_linenumber, {pct("part", "total")} AS line_pct, {pct("quantity", "price")} AS price_pct FROM items""",
    "scalar_json_get": """SELECT event_id, json_extract_string(props, '$.k') AS k_text,
      json_extract_string(props, '$.absent') AS absent_text FROM events""",
    "scalar_typed_json": """SELECT event_id, CAST(user_id AS INTEGER) AS whole_value, CAST(trunc(value) AS INTEGER) AS fraction_value,
        CAST(event_type = 'click' AS INTEGER) AS truth_value, CAST(user_id AS INTEGER) AS text_value,
        CAST(NULL AS INTEGER) AS word_value, CAST(NULL AS INTEGER) AS absent_value, event_type = 'click' AS truth_flag,
        event_type <> 'click' AS mark_flag, value <> 0 AS fraction_flag, FALSE AS absent_flag FROM events""",
    "scalar_batch_id": "SELECT event_id, 'full_' || strftime(ts, '%Y%m%d_%H%M%S') AS batch_id FROM events",
}

# --- checks ---------------------------------------------------------------------------------------------------

PLANTED = {
    "trends": f"""{MONTHS}, clean AS ({trends_of("months")}),
      t AS ({planted.planted_sql("clean", TRENDS_COLUMNS, planted.TRENDS)})""",
    "summary": f"""{MONTHS}, clean AS ({summary_of("months", "jurisdiction, year")}),
      t AS ({planted.planted_sql("clean", SUMMARY_COLUMNS, planted.SUMMARY)})""",
    "impact": f"""{MONTHS}, clean AS ({impact_of("months")}),
      t AS ({planted.planted_sql("clean", IMPACT_COLUMNS, planted.IMPACT)})""",
}
SHORT_YEARS = """SELECT jurisdiction, year, COUNT(*) AS row_count FROM t GROUP BY jurisdiction, year
  HAVING COUNT(*) < 12 AND year < (SELECT MAX(year) FROM t)"""
WRONG_SIZES = "SELECT jurisdiction, year, COUNT(*) AS row_count FROM t GROUP BY jurisdiction, year HAVING COUNT(*) <> 6"

# table, kind, message, and a query that counts the violations in `t`
CHECKS = {
    "trends_unique": (
        "trends",
        "uniqueness",
        "repeated keys",
        "SELECT COUNT(*) AS v FROM (SELECT 1 FROM t GROUP BY jurisdiction, year, month HAVING COUNT(*) > 1) AS g",
    ),
    "trends_full_years": ("trends", "completeness", "years with too few months", f"SELECT COUNT(*) AS v FROM ({SHORT_YEARS}) AS g"),
    "trends_total_range": (
        "trends",
        "validity",
        "rows outside 100 to 2500",
        "SELECT COUNT(*) AS v FROM t WHERE total_deaths < 100 OR total_deaths > 2500",
    ),
    "trends_non_negative": (
        "trends",
        "validity",
        "rows with negative values",
        """SELECT COUNT(*) AS v FROM t
          WHERE heart_disease_deaths < 0 OR cancer_deaths < 0 OR covid_deaths < 0 OR drug_overdose_deaths < 0""",
    ),
    "trends_causes_le_total": (
        "trends",
        "consistency",
        "rows whose parts exceed the total",
        """SELECT COUNT(*) AS v FROM t WHERE COALESCE(heart_disease_deaths, 0) + COALESCE(cancer_deaths, 0)
          + COALESCE(covid_deaths, 0) + COALESCE(drug_overdose_deaths, 0) > total_deaths""",
    ),
    "trends_pct_range": (
        "trends",
        "validity",
        "rows outside 0 to 100",
        """SELECT COUNT(*) AS v FROM t WHERE heart_disease_pct < 0 OR heart_disease_pct > 100 OR cancer_pct < 0
          OR cancer_pct > 100 OR covid_pct < 0 OR covid_pct > 100 OR drug_overdose_pct < 0 OR drug_overdose_pct > 100""",
    ),
    "summary_unique": (
        "summary",
        "uniqueness",
        "repeated keys",
        "SELECT COUNT(*) AS v FROM (SELECT 1 FROM t GROUP BY jurisdiction, year, cause HAVING COUNT(*) > 1) AS g",
    ),
    "summary_group_size": (
        "summary",
        "completeness",
        "years with a wrong number of causes",
        f"SELECT COUNT(*) AS v FROM ({WRONG_SIZES}) AS g",
    ),
    "summary_pct_range": (
        "summary",
        "validity",
        "rows outside 0 to 100",
        "SELECT COUNT(*) AS v FROM t WHERE pct_of_all_deaths < 0 OR pct_of_all_deaths > 100",
    ),
    "summary_non_negative": (
        "summary",
        "validity",
        "rows with negative values",
        "SELECT COUNT(*) AS v FROM t WHERE total_deaths < 0 OR avg_monthly_deaths < 0",
    ),
    "impact_unique": (
        "impact",
        "uniqueness",
        "repeated keys",
        "SELECT COUNT(*) AS v FROM (SELECT 1 FROM t GROUP BY jurisdiction, year, month HAVING COUNT(*) > 1) AS g",
    ),
    "impact_parts_sum": (
        "impact",
        "consistency",
        "rows whose parts differ from the total",
        "SELECT COUNT(*) AS v FROM t WHERE covid_deaths + non_covid_deaths <> total_deaths",
    ),
    "impact_pct_range": (
        "impact",
        "validity",
        "rows outside 0 to 100",
        "SELECT COUNT(*) AS v FROM t WHERE covid_pct < 0 OR covid_pct > 100",
    ),
    "impact_nulls_earliest_only": (
        "impact",
        "precision",
        "NULLs after the first year",
        "SELECT COUNT(*) AS v FROM t WHERE excess_vs_prev_year IS NULL AND year <> (SELECT MIN(year) FROM t)",
    ),
    "impact_non_negative": (
        "impact",
        "validity",
        "rows with negative values",
        "SELECT COUNT(*) AS v FROM t WHERE covid_deaths < 0 OR non_covid_deaths < 0 OR total_deaths < 0",
    ),
}


def check_sql(name: str) -> str:
    table, kind, message, counting = CHECKS[name]
    return f"""WITH {PLANTED[table]} SELECT '{table}' AS table_name, '{name}' AS check_name, '{kind}' AS kind,
      v AS violations, v = 0 AS passed, CASE WHEN v > 0 THEN CAST(v AS VARCHAR) || ' {message}' END AS message
      FROM ({counting}) AS counted"""


ORACLES.update({f"dq_{name}": check_sql(name) for name in CHECKS})
ORACLES["dq_report"] = " UNION ALL ".join(f"SELECT * FROM ({check_sql(name)}) AS {name}" for name in CHECKS)
ORACLES["dq_failing_groups"] = f"""
  SELECT 'trends_full_years' AS check_name, * FROM (WITH {PLANTED["trends"]} {SHORT_YEARS}) AS short_years
  UNION ALL SELECT 'summary_group_size', * FROM (WITH {PLANTED["summary"]} {WRONG_SIZES}) AS wrong_sizes"""

ORACLES["dq_incremental"] = ORACLES["dq_report"]

# The columns that name what breaks a check, and the query that finds it in `t`
MONTHLY, YEARLY, CAUSED = "jurisdiction, year, month", "jurisdiction, year", "jurisdiction, year, cause"
BREAKS = {
    name: (MONTHLY if table != "summary" else CAUSED, f"SELECT * FROM t {counting[counting.index('WHERE'):]}")
    for name, (table, kind, message, counting) in CHECKS.items()
    if kind not in ("uniqueness", "completeness")
}
BREAKS |= {
    f"{table}_unique": (keys, f"SELECT {keys} FROM t GROUP BY {keys} HAVING COUNT(*) > 1")
    for table, keys in (("trends", MONTHLY), ("summary", CAUSED), ("impact", MONTHLY))
}
BREAKS |= {"trends_full_years": (YEARLY, SHORT_YEARS), "summary_group_size": (YEARLY, WRONG_SIZES)}


def offenders_sql(name: str) -> str:
    table, (keys, breaking) = CHECKS[name][0], BREAKS[name]
    text = " || ', ' || ".join(f"'{k}=' || CAST({k} AS VARCHAR)" for k in keys.split(", "))
    return f"""WITH {PLANTED[table]}, found AS (SELECT DISTINCT {keys} FROM ({breaking}) AS b)
      SELECT '{table}' AS table_name, '{name}' AS check_name, CAST(row_number() OVER (ORDER BY {keys}) AS INTEGER) AS nth,
        {text} AS offender FROM found ORDER BY {keys} LIMIT 3"""


ORACLES["dq_offenders"] = " UNION ALL ".join(f"SELECT * FROM ({offenders_sql(name)}) AS {name}" for name in CHECKS)

# --- the whole chain ------------------------------------------------------------------------------------------

# After both loads a year up to 1996 is as the earlier load left it, and a later one as the later load made it.
FINAL_SILVER = "silver AS (SELECT * FROM earlier WHERE year <= 1996 UNION ALL SELECT * FROM later)"
LOADED_AT = "CASE WHEN year <= 1996 THEN '2002-01-01' ELSE '2002-02-01' END AS loaded_at"
ORACLES["layered_trends"] = f"""WITH {OVERALL}, {EARLIER}, {LATER}, {FINAL_SILVER}
  SELECT {TRENDS_SELECT}, {LOADED_AT} FROM silver"""
ORACLES["layered_impact_by_entity"] = f"""WITH {MONTHS}, {EARLIER}, {LATER}, {FINAL_SILVER}
  SELECT *, {LOADED_AT} FROM ({impact_of("silver")}) AS impact"""
ORACLES["layered_entity_change"] = f"""WITH {OVERALL}, {EARLIER}, {LATER}, {FINAL_SILVER}
  SELECT jurisdiction, {TRENDS_SELECT}, '2002-02-01' AS loaded_at FROM silver"""
# Rows of both editions are loaded at once: the later one's counts, and the bounds of the edition that had the key first.
ORACLES["silver_backlog"] = f"""WITH {MONTHS}, {EARLIER}, {LATER}
  SELECT COALESCE(e.jurisdiction, l.jurisdiction) AS jurisdiction, COALESCE(e.year, l.year) AS year, COALESCE(e.month, l.month) AS month,
    {", ".join(f"CASE WHEN e.year IS NULL THEN l.{c} ELSE e.{c} END AS {c}" for c in ("start_date", "end_date"))},
    {", ".join(f"CASE WHEN l.year IS NULL THEN e.{c} ELSE l.{c} END AS {c}" for c in ["data_as_of", *SILVER_COUNTS, "is_provisional"])},
    '2002-02-01' AS loaded_at
  FROM earlier e FULL OUTER JOIN later l ON e.jurisdiction = l.jurisdiction AND e.year = l.year AND e.month = l.month"""
