"""The monthly mortality tables: record keys, schemas, reporting tables and the fifteen checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.operators import quality as q
from tallyforge.operators import reporting
from tallyforge.operators.parse import RecordSpec
from tallyforge.sources.versions import Layout

# Record keys, column names, cause labels, length limits and check bounds.
COUNTS = (
    "all_cause",
    "natural_cause",
    "diseases_of_heart",
    "malignant_neoplasms",
    "diabetes_mellitus",
    "alzheimer_disease",
    "drug_overdose",
    "covid_19_underlying",
    "accidents_unintentional",
)
RENAMED = {"covid_19_underlying": "covid_19_underlying_cause"}
FLAGS = ("flag_accid", "flag_mva", "flag_suic", "flag_homic", "flag_drugod")
DATES = ("start_date", "end_date", "data_as_of")
TREND_PARTS = {
    "diseases_of_heart": "heart_disease",
    "malignant_neoplasms": "cancer",
    "covid_19_underlying": "covid",
    "drug_overdose": "drug_overdose",
}
CAUSES = {
    "diseases_of_heart": "Heart Disease",
    "malignant_neoplasms": "Cancer",
    "covid_19_underlying": "COVID-19",
    "drug_overdose": "Drug Overdose",
    "alzheimer_disease": "Alzheimer Disease",
    "diabetes_mellitus": "Diabetes",
}
NAME_LENGTH = 100
TOTAL_LOW, TOTAL_HIGH = 100000, 500000
MONTHS_PER_YEAR = 12
FIRST_YEAR = "2019"

SPEC = RecordSpec(
    texts={"jurisdiction": "jurisdiction_of_occurrence"},
    ints={"year": "year", "month": "month"} | {c: RENAMED.get(c, c) for c in COUNTS},
    dates={c: c for c in DATES},
    flags=FLAGS,
    flag_column="is_provisional",
    required=("year", "month"),
    order=("jurisdiction", "year", "month", *DATES, *COUNTS, "is_provisional"),
    not_null=("jurisdiction",),
    lengths={"jurisdiction": NAME_LENGTH},
)

INT, DATE, BOOL, TEXT, TIME = T.IntegerType(), T.DateType(), T.BooleanType(), T.StringType(), T.TimestampType()
PCT, MEAN = T.DecimalType(5, 2), T.DecimalType(10, 2)


def _schema(required: dict, optional: dict) -> T.StructType:
    fields = [T.StructField(n, t, False) for n, t in required.items()]
    return T.StructType(fields + [T.StructField(n, t) for n, t in optional.items()])


SILVER_KEYS = ("jurisdiction", "year", "month")
SILVER = Layout(
    "silver",
    T.StructType(
        [
            *_schema({"jurisdiction": TEXT, "year": INT, "month": INT}, {}),
            *[T.StructField(c, DATE) for c in DATES],
            *[T.StructField(c, INT) for c in COUNTS],
            *_schema({"is_provisional": BOOL, "loaded_at": TIME}, {}),
        ]
    ),
    ("year", "month"),
    SILVER_KEYS,
)
# The first load fixes the period bounds of a row; later loads revise everything else.
SILVER_UPDATE = (*COUNTS, "is_provisional", "data_as_of")


def gold_layouts(entity: Sequence[str] = ()) -> dict[str, Layout]:
    """The reporting tables; `entity` columns, if any, lead every key."""
    lead = {e: TEXT for e in entity}
    trend_counts = {"total_deaths": INT} | {f"{n}_deaths": INT for n in TREND_PARTS.values()}
    trend_shares = {f"{n}_pct": PCT for n in TREND_PARTS.values()}
    period = {"year": INT, "month": INT}
    keys = gold_keys(entity)
    trends_schema = _schema(lead | period, trend_counts | trend_shares | {"is_provisional": BOOL, "loaded_at": TIME})
    measures = {"total_deaths": INT, "avg_monthly_deaths": MEAN, "pct_of_all_deaths": PCT, "loaded_at": TIME}
    summary_schema = _schema(lead | {"year": INT, "cause": TEXT}, measures)
    against_prior = {"total_deaths": INT, "covid_deaths": INT, "non_covid_deaths": INT, "covid_pct": PCT, "excess_vs_prev_year": INT}
    impact_schema = _schema(lead | period, against_prior | {"loaded_at": TIME})
    return {
        "trends": Layout("trends", trends_schema, ("year", "month"), keys["trends"]),
        "summary": Layout("summary", summary_schema, ("year",), keys["summary"]),
        "impact": Layout("impact", impact_schema, ("year", "month"), keys["impact"]),
    }


def gold_keys(entity: Sequence[str] = ()) -> dict[str, tuple[str, ...]]:
    monthly = (*entity, "year", "month")
    return {"trends": monthly, "summary": (*entity, "year", "cause"), "impact": monthly}


def trends(silver: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    keys = [*entity, "year", "month"]
    return reporting.monthly_shares(silver, keys, "all_cause", "total_deaths", TREND_PARTS, ["is_provisional"])


def summary(silver: DataFrame, entity: Sequence[str] = (), count_type: str = "bigint") -> DataFrame:
    return reporting.summary_long(silver, [*entity, "year"], "all_cause", CAUSES, count_type=count_type)


def impact(silver: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """Several jurisdictions without one in the key repeat a month, which raises."""
    return reporting.prior_year(silver, entity, "all_cause", "covid_19_underlying")


def checks(entity: Sequence[str] = (), low: int = TOTAL_LOW, high: int = TOTAL_HIGH) -> list[q.Check]:
    """The fifteen checks of the three reporting tables."""
    lead = tuple(entity)
    monthly, by_cause, yearly = (*lead, "year", "month"), (*lead, "year", "cause"), (*lead, "year")
    parts = [f"{n}_deaths" for n in TREND_PARTS.values()]
    shares = [f"{n}_pct" for n in TREND_PARTS.values()]
    repeated, unfinished = "repeated keys", "years with too few months"
    return [
        q.Unique("trends", "trends_unique", "uniqueness", repeated, monthly),
        q.FullGroups("trends", "trends_full_years", "completeness", unfinished, monthly, yearly, "year", MONTHS_PER_YEAR),
        q.in_range("trends", "trends_total_range", ["total_deaths"], low, high),
        q.non_negative("trends", "trends_non_negative", parts),
        q.parts_within_total("trends", "trends_causes_le_total", parts, "total_deaths"),
        q.in_range("trends", "trends_pct_range", shares, 0, 100),
        q.Unique("summary", "summary_unique", "uniqueness", repeated, by_cause),
        q.GroupSize("summary", "summary_group_size", "completeness", "years with a wrong number of causes", by_cause, yearly, len(CAUSES)),
        q.in_range("summary", "summary_pct_range", ["pct_of_all_deaths"], 0, 100),
        q.non_negative("summary", "summary_non_negative", ["total_deaths", "avg_monthly_deaths"]),
        q.Unique("impact", "impact_unique", "uniqueness", repeated, monthly),
        q.parts_make_total("impact", "impact_parts_sum", ["covid_deaths", "non_covid_deaths"], "total_deaths"),
        q.in_range("impact", "impact_pct_range", ["covid_pct"], 0, 100),
        q.NullOnlyInFirst("impact", "impact_nulls_earliest_only", "precision", "NULLs after the first year", "excess_vs_prev_year", "year"),
        q.non_negative("impact", "impact_non_negative", ["covid_deaths", "non_covid_deaths", "total_deaths"]),
    ]


def since_first_year(raw: str = "raw_data", first: str = FIRST_YEAR):
    """The source's year condition. It compares texts, as the source does."""
    return F.get_json_object(raw, "$.year") >= first
