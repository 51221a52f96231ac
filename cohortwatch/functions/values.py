"""Scalar helpers: repeatable randomness, clipping, rounding, labels, JSON/map,
status mapping (F10-F24). All native expressions.

Randomness is a pure function of (row key, seed, stream name): the same row gets
the same draw under any partitioning, retry or executor loss, and the same value
can be computed by any SQL engine that has md5 (F12, F13).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Bits of a draw: 15 hex digits, the most that fit a long without its sign.
DRAW_DIGITS = 15
DRAW_RANGE = 16 ** DRAW_DIGITS


def hash_draw(key: Column | str, seed: int, stream: str = "") -> Column:
    """60-bit unsigned integer from md5 of 'key|seed|stream' (first 15 hex digits)."""
    h = F.md5(F.concat_ws("|", _c(key).cast("string"), F.lit(str(seed)), F.lit(stream)))
    return F.conv(F.substring(h, 1, DRAW_DIGITS), 16, 10).cast("long")


def hash_uniform(key: Column | str, seed: int, stream: str = "") -> Column:
    """Uniform double in [0, 1) from the row key."""
    return hash_draw(key, seed, stream) / F.lit(float(DRAW_RANGE))


def hash_int(key: Column | str, seed: int, low: int, high: int, stream: str = "") -> Column:
    """Integer in [low, high) from the row key."""
    return (F.lit(low) + hash_draw(key, seed, stream) % F.lit(high - low)).cast("long")


def hash_choice(key: Column | str, seed: int, choices: Sequence, stream: str = "") -> Column:
    """One of ``choices`` picked by the row key."""
    arr = F.array(*[F.lit(v) for v in choices])
    idx = hash_draw(key, seed, stream) % F.lit(len(choices))
    return F.element_at(arr, (idx + 1).cast("int"))


def hash_order(key: Column | str, seed: int) -> Column:
    """Sort key for seeded shuffles and samples: md5 hex of 'key|seed'."""
    return F.md5(F.concat_ws("|", _c(key).cast("string"), F.lit(str(seed))))


def clip(c: Column | str, low=None, high=None) -> Column:
    """Clip to [low, high]; null stays null."""
    x = _c(c)
    out = x
    if low is not None:
        out = F.when(x.isNull(), None).otherwise(F.greatest(out, F.lit(low)))
    if high is not None:
        out = F.when(x.isNull(), None).otherwise(F.least(out, F.lit(high)))
    return out


def py_round(c: Column | str, digits: int) -> Column:
    """Round half to even (Python's round on decimal ties)."""
    return F.bround(_c(c), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share as a percentage, rounded."""
    return F.round(part.cast("double") * 100.0 / whole, digits)


def join_labels(*labels: Column, sep: str = ", ", empty: str = "-") -> Column:
    """Join the non-null labels with ``sep``; ``empty`` when none."""
    arr = F.array_compact(F.array(*labels))
    return F.when(F.size(arr) == 0, F.lit(empty)).otherwise(F.array_join(arr, sep))


# Decimal numbers as the usual table readers take them: no digit groups, no type suffix.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_number(c: Column | str, to: str = "double") -> Column:
    """Text (or a number) -> number; anything that is not a plain number -> null."""
    text = _c(c).cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast(to))


def json_field(c: Column | str, path: str, cast: str | None = None) -> Column:
    """Read one field from a JSON text column."""
    v = F.get_json_object(_c(c), path)
    return v.cast(cast) if cast else v


def status_band(value: Column | str, bands: Sequence[tuple], default: str) -> Column:
    """Map a number to a label by ordered (upper_exclusive, label) bands."""
    x = _c(value)
    expr = None
    for upper, label in bands:
        cond = x < F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def clamp_max(c: Column, upper) -> Column:
    """least(c, upper)."""
    return F.least(c, F.lit(upper))


def split_prefixed_name(name: Column | str, prefixes: Sequence[str], sep: str = "_") -> tuple[Column, Column]:
    """(source column, category) of an encoded column name like 'col_cat' (F16).

    The first prefix (followed by ``sep``) that the name starts with wins;
    names with no known prefix are their own source and have no category.
    """
    n = _c(name)
    source, category = None, None
    for p in prefixes:
        hit = n.startswith(p + sep)
        source = F.when(hit, F.lit(p)) if source is None else source.when(hit, F.lit(p))
        rest = F.substr(n, F.lit(len(p) + len(sep) + 1))
        category = F.when(hit, rest) if category is None else category.when(hit, rest)
    if source is None:
        return n, F.lit(None).cast("string")
    return source.otherwise(n), category
