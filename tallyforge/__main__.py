"""Run one stage or all of them: `spark-submit --py-files ... -m tallyforge run --root ... --landing ...`.

The exit code is 0, or 1 if a stage or a check failed, so any scheduler can chain the stages.
"""

from __future__ import annotations

import argparse
import sys

from tallyforge.operators.quality import QualityError
from tallyforge.plans import mortality
from tallyforge.plans import run as stages
from tallyforge.session import build_session
from tallyforge.sources.landing import read_landed
from tallyforge.sources.versions import TableSet


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyforge", description="Layered monthly tables")
    parser.add_argument("stage", choices=["run", "ingest", "silver", "gold", "rebuild", "check", "expire"])
    parser.add_argument("--root", required=True, help="shared folder of the tables")
    parser.add_argument("--landing", help="folder or file of landed JSON records")
    parser.add_argument("--layout", choices=["lines", "array"], default="lines")
    parser.add_argument("--source", default="monthly_deaths")
    parser.add_argument("--source-url", default="")
    parser.add_argument("--first-year", default=mortality.FIRST_YEAR, help="text the record's year must not precede")
    parser.add_argument("--by-jurisdiction", action="store_true", help="report on each jurisdiction")
    parser.add_argument("--on-duplicate", choices=["error", "last"], default="error")
    parser.add_argument("--null-jurisdiction", choices=["error", "reject"], default="error")
    parser.add_argument("--on-violation", choices=["error", "quarantine"], default="error", help="rows that break a constraint of silver")
    parser.add_argument("--keep", type=int, default=3, help="publications whose folders `expire` leaves")
    parser.add_argument("--typed-json", action="store_true", help="honour JSON numbers and booleans")
    parser.add_argument("--low", type=int, default=mortality.TOTAL_LOW)
    parser.add_argument("--high", type=int, default=mortality.TOTAL_HIGH)
    chosen = parser.parse_args(given)
    if chosen.stage in ("run", "ingest") and not chosen.landing:
        parser.error(f"{chosen.stage} needs --landing")
    return chosen


def main(given: list[str] | None = None) -> int:
    chosen = arguments(given)
    spark = build_session("tallyforge")
    entity = ("jurisdiction",) if chosen.by_jurisdiction else ()
    config = stages.Config(
        root=chosen.root,
        source=chosen.source,
        source_url=chosen.source_url or chosen.landing or "",
        entity=entity,
        on_duplicate=chosen.on_duplicate,
        null_jurisdiction=chosen.null_jurisdiction,
        on_violation=chosen.on_violation,
        typed_json=chosen.typed_json,
        checks=mortality.checks(entity, chosen.low, chosen.high),
    )

    def landed():
        return read_landed(spark, chosen.landing, chosen.layout, mortality.since_first_year(first=chosen.first_year))

    at = stages.utc_now()
    try:
        if chosen.stage == "run":
            result = stages.run(spark, config, landed, at)
        elif chosen.stage == "ingest":
            result = stages.ingest(spark, config, landed, at)
        elif chosen.stage == "silver":
            result = stages.load_silver(spark, config, None, at)
        elif chosen.stage in ("gold", "rebuild"):
            result = stages.build_gold(spark, config, stages.Result(batch_id=""), at, rebuild=chosen.stage == "rebuild")
        elif chosen.stage == "expire":
            print("\n".join(TableSet(spark, config.root).expire(chosen.keep)))
            result = stages.Result(batch_id="")
        else:
            result = stages.Result(batch_id="", report=stages.check(spark, config))
    except QualityError as failed:
        print(failed, file=sys.stderr)
        return 1
    for row in result.report:
        print("PASS", row.table_name, row.check_name)
    print(
        f"received={result.received} transformed={result.transformed} dropped={result.dropped}"
        f" upserted={result.upserted} silver_years={result.silver_years} gold_years={result.gold_years}"
    )
    return 0


if __name__ == "__main__":
    sys.exit(main())
