"""Raw JSON text to typed rows. Unusable records are kept aside with a reason, never dropped unseen."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions import any_flag, int_overflows, safe_date, safe_int, typed_flag, typed_int, typed_int_overflows, variant_text
from tallyforge.operators.constraints import counts_to_rows

REASON = "reject_reason"
BROKEN = "broken_constraints"
_CORRUPT = "_corrupt"


@dataclass(frozen=True)
class RecordSpec:
    """How a flat JSON record becomes a row.

    texts, ints and dates map a column to its record key; `flag_column` is true if any of `flags` is set;
    rows whose `required` columns are NULL after casting are rejects. Other record keys are ignored. `not_null` columns,
    `lengths` of texts and the 32 bits of ints are constraints of the table: rows that break them are parsed all the same.
    """

    texts: dict[str, str] = field(default_factory=dict)
    ints: dict[str, str] = field(default_factory=dict)
    dates: dict[str, str] = field(default_factory=dict)
    flags: tuple[str, ...] = ()
    flag_column: str = "is_provisional"
    required: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)

    def constraints(self) -> list[tuple[str, str]]:
        """(kind, column) of every constraint that a single row may break."""
        kinds = {"not_null": self.not_null, "max_length": self.lengths, "int_range": self.ints}
        return [(kind, column) for kind, columns in kinds.items() for column in columns]

    def columns(self) -> list[str]:
        found = [*self.texts, *self.ints, *self.dates, self.flag_column]
        return list(self.order) or found

    def record_keys(self) -> list[str]:
        return list(dict.fromkeys([*self.texts.values(), *self.ints.values(), *self.dates.values(), *self.flags]))


def unpack(
    bronze: DataFrame, spec: RecordSpec, raw: str = "raw_data", typed_json: bool = False, filters_follow: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """Raw text, carried columns, and `record`, the record's values by key, as texts or as variants.

    `record._corrupt` marks text that is not JSON. With filters_follow=True the parse is a generator of one row,
    so that filters on its result stay above it; pushed below, each would parse the text again.
    """
    value_type = T.VariantType() if typed_json else T.StringType()
    fields = [T.StructField(key, value_type) for key in spec.record_keys()]
    schema = T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(raw, schema, {"columnNameOfCorruptRecord": _CORRUPT})
    return bronze.select(raw, *carry, F.explode(F.array(parsed)).alias("record") if filters_follow else parsed.alias("record"))


def parse(
    bronze: DataFrame,
    spec: RecordSpec,
    typed_json: bool = False,
    filters_follow: bool = True,
    raw: str = "raw_data",
    carry: Sequence[str] = (),
    constraints: bool = False,
) -> DataFrame:
    """All records as typed rows, with the raw text and `reject_reason` (NULL for usable rows).

    One pass and no Python: write it once, partitioned by the reason, or take `accepted` and `rejected` of it.
    typed_json=True honours JSON numbers and booleans instead of reading every value as text. `carry` columns stay.
    constraints=True adds `broken_constraints`, the names "kind:column" of those that the row breaks.
    """
    rows = unpack(bronze, spec, raw, typed_json, filters_follow, carry)
    made = _typed_columns(spec) if typed_json else _text_columns(spec)
    is_json = F.col("record").isNotNull() & F.col(f"record.{_CORRUPT}").isNull()
    kept = [raw, *carry, *[made[c].alias(c) for c in spec.columns()], is_json.alias("_is_json")]
    typed = rows.select(*kept, _broken(spec, made, typed_json).alias(BROKEN)) if constraints else rows.select(*kept)
    reason = F.when(~F.col("_is_json"), F.lit("bad_json"))
    for name in spec.required:
        reason = reason.when(F.col(name).isNull(), F.lit(f"no_{name}"))
    return typed.withColumn(REASON, reason).drop("_is_json")


def _broken(spec: RecordSpec, made: dict[str, Column], typed_json: bool) -> Column:
    """Names of the constraints that the row breaks, in the order of `spec.constraints()`."""
    too_large = typed_int_overflows if typed_json else int_overflows
    tests = {
        "not_null": lambda c: made[c].isNull(),
        "max_length": lambda c: F.coalesce(F.char_length(made[c]) > spec.lengths[c], F.lit(False)),
        "int_range": lambda c: too_large(F.col(f"record.{spec.ints[c]}")),
    }
    named = [F.when(tests[kind](column), F.lit(f"{kind}:{column}")) for kind, column in spec.constraints()]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def constraint_counts(parsed: DataFrame, spec: RecordSpec, keys: Sequence[str]) -> DataFrame:
    """(constraint, column_name, violations) of every constraint, zeros included, in one scan and one shuffle by key.

    `parsed` comes with constraints=True. Numbers are judged in all records, everything else in usable rows only. Keys
    are counted in every task before they are shuffled; a key that repeats counts once.
    """
    usable = F.col(REASON).isNull()

    def broken(kind: str, column: str) -> Column:
        hit = F.array_contains(BROKEN, f"{kind}:{column}")
        return hit if kind == "int_range" else hit & usable

    names = spec.constraints()
    counted = [F.count_if(broken(*name)).alias(f"t{i}") for i, name in enumerate(names)]
    per_key = parsed.groupBy(*keys).agg(F.count_if(usable).alias("n"), *counted)
    repeated = F.count_if(F.col("n") > 1).alias(f"t{len(names)}")
    totals = per_key.agg(*[F.coalesce(F.sum(f"t{i}"), F.lit(0)).alias(f"t{i}") for i in range(len(names))], repeated)
    return counts_to_rows(totals, [*names, ("unique_key", ",".join(keys))])


def _text_columns(spec: RecordSpec) -> dict[str, Column]:
    made = {c: F.col(f"record.{k}") for c, k in spec.texts.items()}
    made |= {c: safe_int(F.col(f"record.{k}")) for c, k in spec.ints.items()}
    made |= {c: safe_date(F.col(f"record.{k}")) for c, k in spec.dates.items()}
    made[spec.flag_column] = any_flag(F.col(f"record.{k}") for k in spec.flags)
    return made


def _typed_columns(spec: RecordSpec) -> dict[str, Column]:
    def value(key: str) -> Column:
        return F.col(f"record.{key}")

    made = {c: variant_text(value(k)) for c, k in spec.texts.items()}
    made |= {c: typed_int(value(k)) for c, k in spec.ints.items()}
    made |= {c: safe_date(variant_text(value(k))) for c, k in spec.dates.items()}
    flag = F.lit(False)
    for key in spec.flags:
        flag = flag | typed_flag(value(key))
    made[spec.flag_column] = flag
    return made


def accepted(parsed: DataFrame, spec: RecordSpec) -> DataFrame:
    """The usable rows, table columns only."""
    return parsed.filter(F.col(REASON).isNull()).select(*spec.columns())


def rejected(parsed: DataFrame, raw: str = "raw_data") -> DataFrame:
    """The raw text and reason of every record that could not be used."""
    return parsed.filter(F.col(REASON).isNotNull()).select(raw, REASON)


def overflowing(bronze: DataFrame, spec: RecordSpec, raw: str = "raw_data") -> DataFrame:
    """Records whose whole number does not fit 32 bits, as (constraint, column_name, violations), one row per column."""
    rows = unpack(bronze, spec, raw)
    tests = [F.count_if(int_overflows(F.col(f"record.{k}"))).alias(f"t{i}") for i, k in enumerate(spec.ints.values())]
    return counts_to_rows(rows.agg(*tests), [("int_range", c) for c in spec.ints])


def stage_counts(parsed: DataFrame) -> DataFrame:
    """Rows (stage, n) of one batch: received, inserted, transformed, dropped, upserted. One scan."""
    usable = F.count_if(F.col(REASON).isNull())
    counts = parsed.agg(F.count(F.lit(1)).alias("received"), usable.alias("usable"))
    stages = {
        "received": F.col("received"),
        "inserted": F.col("received"),
        "transformed": F.col("usable"),
        "dropped": F.col("received") - F.col("usable"),
        "upserted": F.col("usable"),
    }
    entries = [F.struct(F.lit(name).alias("stage"), n.alias("n")) for name, n in stages.items()]
    return counts.select(F.inline(F.array(*entries)))
