"""Scalar column functions: code grouping, flags, ordinal bands.

All are native Catalyst expressions -- no Python UDF -- so they stay inside
whole-stage codegen. Null rules follow SURVEY N3, N4, N7, N10-N12.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for right results).
# Diagnosis code groups, checked in this order; first match wins.
# (label, low, high, high_inclusive, extra point codes)
DIAGNOSIS_GROUPS = [
    ("Circulatory", 390, 459, True, [785]),
    ("Respiratory", 460, 519, True, [786]),
    ("Digestive", 520, 579, True, [787]),
    ("Diabetes", 250, 251, False, []),
    ("Injury", 800, 999, True, []),
    ("Musculoskeletal", 710, 739, True, []),
    ("Genitourinary", 580, 629, True, [788]),
    ("Neoplasms", 140, 239, True, []),
]
# Codes starting with these letters are supplementary codes -> "Other".
SUPPLEMENTARY_PREFIXES = ["V", "E"]
# Ordered age bands -> 0..9; any other value maps to null.
AGE_BANDS = ["[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)",
             "[50-60)", "[60-70)", "[70-80)", "[80-90)", "[90-100)"]
# ---------------------------------------------------------------------------

# What Python's float() accepts as a number (digits with optional underscores
# between them, optional fraction/exponent, inf/nan words), surrounded by
# optional whitespace. Spark's own cast is looser ('12d' -> 12.0), so the cast
# is guarded by this pattern.
_DIGITS = r"[0-9](?:_?[0-9])*"
PY_FLOAT_PATTERN = (
    r"^\s*[+-]?(?:(?:" + _DIGITS + r"(?:\." + r"(?:" + _DIGITS + r")?)?|\." + _DIGITS + r")"
    r"(?:[eE][+-]?" + _DIGITS + r")?"
    r"|(?i:inf|infinity|nan))\s*$"
)


def py_float(c: Column) -> Column:
    """Numeric value of a string the way Python's float() reads it; null if not numeric."""
    cleaned = F.regexp_replace(F.trim(c), "_", "")
    return F.when(c.rlike(PY_FLOAT_PATTERN), cleaned.try_cast("double"))


def group_codes(code: Column | str, groups=DIAGNOSIS_GROUPS,
                prefixes: Sequence[str] = SUPPLEMENTARY_PREFIXES,
                missing: str = "Missing", other: str = "Other", numeric: Column | None = None) -> Column:
    """Map a code string to a group label.

    null -> ``missing``; leading supplementary prefix -> ``other``; not a number
    -> ``other``; NaN -> ``other`` (all comparisons false); else the first group
    whose closed (or half-open) range or point list contains the number.
    ``numeric`` may carry the already parsed number (see
    ``features.add_code_groups``), so the parse runs once per row instead of
    once per branch.
    """
    c = F.col(code) if isinstance(code, str) else code
    s = c.cast("string")
    x = numeric if numeric is not None else py_float(s)
    expr = F.when(c.isNull(), F.lit(missing))
    for p in prefixes:
        expr = expr.when(s.startswith(p), F.lit(other))
    expr = expr.when(x.isNull() | F.isnan(x), F.lit(other))
    for label, lo, hi, hi_incl, points in groups:
        upper = (x <= hi) if hi_incl else (x < hi)
        cond = (x >= lo) & upper
        for pt in points:
            cond = cond | (x == pt)
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(other))


def flag_not_equal(c: Column | str, value) -> Column:
    """(c != value) as 0/1 where null counts as 'not equal' (F02, N3)."""
    c = F.col(c) if isinstance(c, str) else c
    return (~c.eqNullSafe(F.lit(value))).cast("int")


def flag_equal(c: Column | str, value) -> Column:
    """(c == value) as 0/1 where null counts as 'not equal' (F03, N4)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.eqNullSafe(F.lit(value)).cast("int")


def ordinal_lookup(c: Column | str, ordered: Sequence[str] = AGE_BANDS) -> Column:
    """Position of the value in ``ordered``; unmapped or null -> null."""
    c = F.col(c) if isinstance(c, str) else c
    pairs = []
    for i, v in enumerate(ordered):
        pairs += [F.lit(v), F.lit(i)]
    return F.create_map(*pairs)[c]


def ordinal_encode(c: Column | str, mapping: dict, unseen: int = -1) -> Column:
    """Ordinal code from a fitted mapping; unseen and null -> ``unseen``.

    A null is looked up as the text 'nan' (never in a fitted map), so it falls
    to ``unseen`` like any other unseen value.
    """
    c = F.col(c) if isinstance(c, str) else c
    if not mapping:
        return F.lit(unseen).cast("long")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(str(k)), F.lit(int(v)).cast("long")]
    return F.coalesce(F.create_map(*pairs)[c.cast("string")], F.lit(unseen).cast("long"))


def one_hot(c: Column | str, name: str, categories: Sequence[str], sep: str = "_") -> list[Column]:
    """One 0/1 column per fixed category; unseen or null -> all zero."""
    c = F.col(c) if isinstance(c, str) else c
    s = c.cast("string")
    return [s.eqNullSafe(F.lit(cat)).cast("long").alias(f"{name}{sep}{cat}") for cat in categories]


def not_in_keep_null(c: Column | str, values: Sequence) -> Column:
    """~isin(values) where a null value passes."""
    c = F.col(c) if isinstance(c, str) else c
    return ~F.coalesce(c.isin(list(values)), F.lit(False))


def not_equal_keep_null(c: Column | str, value) -> Column:
    """c != value where a null value passes."""
    c = F.col(c) if isinstance(c, str) else c
    return ~c.eqNullSafe(F.lit(value))
