from tallyforge.functions.scalars import (
    any_flag,
    batch_id,
    exact_mean,
    int_overflows,
    safe_date,
    safe_int,
    share_pct,
    typed_flag,
    typed_int,
    typed_int_overflows,
    variant_text,
)

__all__ = [
    "any_flag",
    "batch_id",
    "exact_mean",
    "int_overflows",
    "safe_date",
    "safe_int",
    "share_pct",
    "typed_flag",
    "typed_int",
    "typed_int_overflows",
    "variant_text",
]
