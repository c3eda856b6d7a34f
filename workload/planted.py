"""Reporting tables with planted violations, so that every check has something to count."""

from __future__ import annotations

from pyspark.sql import DataFrame

TRENDS = {
    "change": {
        "total_deaths": "CASE WHEN year = 1996 AND month = 6 THEN 1 ELSE total_deaths END",
        "heart_disease_deaths": "CASE WHEN year = 1999 AND month = 3 THEN -heart_disease_deaths ELSE heart_disease_deaths END",
        "heart_disease_pct": "CASE WHEN year = 2000 AND month = 4 THEN heart_disease_pct + 100 ELSE heart_disease_pct END",
    },
    "keep": "NOT (year = 1998 AND month = 2)",
    "repeat": "year = 1997 AND month = 5",
}
SUMMARY = {
    "change": {
        "total_deaths": "CASE WHEN year = 2000 AND cause = 'Diabetes' THEN -total_deaths ELSE total_deaths END",
        "pct_of_all_deaths": (
            "CASE WHEN year = 1997 AND cause = 'Heart Disease' THEN pct_of_all_deaths + 100 ELSE pct_of_all_deaths END"
        ),
    },
    "keep": "NOT (year = 1998 AND cause = 'Cancer')",
    "repeat": "year = 1999 AND cause = 'COVID-19'",
}
IMPACT = {
    "change": {
        "total_deaths": "CASE WHEN year = 1998 AND month = 8 THEN -total_deaths ELSE total_deaths END",
        "covid_deaths": "CASE WHEN year = 1999 AND month = 7 THEN covid_deaths + 1 ELSE covid_deaths END",
        "covid_pct": "CASE WHEN year = 2000 AND month = 1 THEN covid_pct + 100 ELSE covid_pct END",
        "excess_vs_prev_year": "CASE WHEN year = 2000 AND month = 2 THEN NULL ELSE excess_vs_prev_year END",
    },
    "keep": "year > 0",
    "repeat": "year = 1997 AND month = 5",
}


def plant(rows: DataFrame, plan: dict) -> DataFrame:
    changed = [f"{plan['change'].get(c, c)} AS {c}" for c in rows.columns]
    return rows.filter(plan["keep"]).selectExpr(*changed).unionByName(rows.filter(plan["repeat"]))


def planted_sql(source: str, columns: list[str], plan: dict) -> str:
    changed = ", ".join(f"{plan['change'].get(c, c)} AS {c}" for c in columns)
    same = ", ".join(columns)
    return f"SELECT {changed} FROM {source} WHERE {plan['keep']} UNION ALL SELECT {same} FROM {source} WHERE {plan['repeat']}"
