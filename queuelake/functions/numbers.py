"""Lax scalar casts over landed text.

These take and give SQL text: documents are checked and typed in nested lambdas over dozens of fields,
and one parsed expression costs far less driver time than thousands of chained column calls.
"""

from __future__ import annotations

# Spark's own cast also takes a trailing d or f ("1d"), which is no number here.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def lax_double(text: str) -> str:
    """Numbers, numeric text and booleans as DOUBLE; anything else null."""
    return (
        f"CASE WHEN {text} RLIKE r'{NUMBER}' THEN try_cast(trim({text}) AS DOUBLE)"
        f" WHEN {text} = 'true' THEN 1D WHEN {text} = 'false' THEN 0D END"
    )


def lax_boolean(text: str) -> str:
    """The spellings of true and false a lenient reader takes; anything else null."""
    return (
        f"CASE WHEN lower({text}) IN ('true', 't', 'yes', 'y', 'on', '1', '1.0') THEN true"
        f" WHEN lower({text}) IN ('false', 'f', 'no', 'n', 'off', '0', '0.0') THEN false END"
    )
