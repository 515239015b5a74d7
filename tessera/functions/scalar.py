"""Scalar column functions (F1-F10).  All are JVM-side built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "strip_parens", "strip_digits", "safe_div", "dot", "affine",
    "scale_array", "flatten_array", "take_component", "round_to", "format_num",
    "pair_product", "pair_sum", "nan_to_null",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_parens(c, trim: bool = True) -> Column:
    """drop parenthesised text, greedy from the first '(' to the last ')'.

    With ``trim=False`` the blank before the bracket stays, as a plain regex
    replacement would leave it.
    """
    out = F.regexp_replace(col_of(c), r"\(.*\)", "")
    return F.trim(out) if trim else out


def strip_digits(c) -> Column:
    """drop every run of digits."""
    return F.regexp_replace(col_of(c), r"\d+", "")


def safe_div(a, b) -> Column:
    """division that yields NULL for a zero or NULL divisor (ANSI-safe)."""
    return F.try_divide(col_of(a), col_of(b))


def dot(a, b) -> Column:
    """inner product of two equally long numeric arrays."""
    prod = F.zip_with(col_of(a), col_of(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x)


def affine(bias, weights, x) -> Column:
    """``b + x . w`` for an array column ``x`` and literal/array weights."""
    w = F.array(*[F.lit(float(v)) for v in weights]) if isinstance(weights, (list, tuple)) else col_of(weights)
    return F.lit(float(bias)) + dot(x, w)


def scale_array(c, k: float) -> Column:
    """divide every element by ``k`` (e.g. pixel values by 255)."""
    return F.transform(col_of(c), lambda x: x.cast("double") / F.lit(float(k)))


def flatten_array(c) -> Column:
    """flatten one nesting level (a 2-D image to a 1-D vector)."""
    return F.flatten(col_of(c))


def take_component(c, i: int, vector: bool = False) -> Column:
    """0-based element of an array (or, with ``vector=True``, ML vector) column."""
    cc = col_of(c)
    if vector:
        from pyspark.ml.functions import vector_to_array

        cc = vector_to_array(cc)
    return F.get(cc, i)


def round_to(c, places: int = 4) -> Column:
    """F9."""
    return F.round(col_of(c), places)


def format_num(c, places: int = 0) -> Column:
    """thousands-separated text, for display only."""
    return F.format_number(col_of(c), places)


def pair_product(a, b) -> Column:
    """F8."""
    return col_of(a) * col_of(b)


def pair_sum(a, b) -> Column:
    """F8."""
    return col_of(a) + col_of(b)


def nan_to_null(c) -> Column:
    """Entry rule: one missing marker, NULL (NaN becomes NULL)."""
    cc = col_of(c)
    return F.when(F.isnan(cc), F.lit(None)).otherwise(cc)
