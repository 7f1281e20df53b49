"""Column expressions: log-mean, clamps, metric terms, product-name parsers.

All are built-in Spark expressions, so they run inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name patterns, unit map, caps and thresholds.
SHORT_NAME_PATTERN = r"^(\D*)"             # leading non-digits (keeps a trailing blank)
BRAND_PATTERN = r"^.+\s(\D+) \d+$"         # last non-digit word(s) before the final number
WEIGHT_PATTERN = r"(\d+)(Kg|g)"            # first weight, grams or kilograms
PIECES_PATTERN = r"(\d+)p "                # piece count, note the trailing blank
UNIT_GRAMS = {"Kg": 1000, "g": 1}
LABEL_CAP = 10
BINARY_THRESHOLD = 0.5


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_mean(c: str | Column) -> Column:
    """exp(mean(log(y+1)))-1. y <= -1 contributes NULL (ignored by avg)."""
    return F.expm1(F.avg(F.log1p(_c(c))))


def clamp_nonneg(p: str | Column) -> Column:
    """max(0, p) where NaN counts as 0 (as Python's max(0, nan) does)."""
    p = _c(p).cast("double")
    return F.greatest(F.nanvl(p, F.lit(0.0)), F.lit(0.0))


def squared_log_error(pred: str | Column, label: str | Column, clamp: bool) -> Column:
    p = clamp_nonneg(pred) if clamp else _c(pred).cast("double")
    return F.pow(F.log1p(p) - F.log1p(_c(label).cast("double")), 2)


def rmsle(pred: str | Column, label: str | Column, clamp: bool = True) -> Column:
    """Root mean squared log error as one aggregate expression."""
    return F.sqrt(F.avg(squared_log_error(pred, label, clamp)))


def cap_label(c: str | Column, cap: float = LABEL_CAP) -> Column:
    return F.least(_c(c), F.lit(cap))


def floor_zero(c: str | Column) -> Column:
    return F.greatest(_c(c), F.lit(0))


def binarise(c: str | Column, threshold: float = BINARY_THRESHOLD) -> Column:
    return F.when(_c(c) >= threshold, F.lit(1)).otherwise(F.lit(0))


def short_name(name: str | Column) -> Column:
    # always matches, may be '' (no NULL conversion here)
    return F.regexp_extract(_c(name), SHORT_NAME_PATTERN, 1)


def brand(name: str | Column) -> Column:
    return F.nullif(F.regexp_extract(_c(name), BRAND_PATTERN, 1), F.lit(""))


def weight_grams(name: str | Column) -> Column:
    n = _c(name)
    amount = F.nullif(F.regexp_extract(n, WEIGHT_PATTERN, 1), F.lit("")).cast("double")
    unit = F.regexp_extract(n, WEIGHT_PATTERN, 2)
    factor = F.when(unit == "Kg", F.lit(UNIT_GRAMS["Kg"])).when(unit == "g", F.lit(UNIT_GRAMS["g"]))
    return amount * factor


def pieces(name: str | Column) -> Column:
    return F.nullif(F.regexp_extract(_c(name), PIECES_PATTERN, 1), F.lit("")).cast("double")


def size_mb(nbytes: str | Column) -> Column:
    return F.round(_c(nbytes) / F.lit(1e6), 2)


def null_count(c: str) -> Column:
    return F.sum(F.col(c).isNull().cast("long")).alias(c)
