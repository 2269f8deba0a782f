"""Column-to-column helpers; all of them stay inside the JVM expression tree."""

from silverlode.functions.columns import (
    blank_to_null,
    calendar_parts,
    capitalize_words,
    clean_lower,
    clean_upper,
    elapsed_seconds,
    joined_hash,
    lenient_cast,
    number_text,
    quoted,
    ratio,
    rounded_double,
    row_hash,
    run_together_hash,
    sum_or_zero,
)

__all__ = [
    "blank_to_null",
    "calendar_parts",
    "capitalize_words",
    "clean_lower",
    "clean_upper",
    "elapsed_seconds",
    "joined_hash",
    "lenient_cast",
    "number_text",
    "quoted",
    "ratio",
    "rounded_double",
    "row_hash",
    "run_together_hash",
    "sum_or_zero",
]
