"""Column expressions for text and numbers.

All functions return ``Column``s built from Spark built-ins, so they stay inside
whole-stage codegen.  NaN never travels inside the library: numeric inputs are turned
into NULL at the boundary (``nan_to_null``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veracity.schema import LABEL_ALIASES, LABEL_DISPLAY, WS_CLASS_JAVA

WS = f"[{WS_CLASS_JAVA}]"
NON_WS_RUN = f"[^{WS_CLASS_JAVA}]+"
# numbers Python's float() accepts: digits with single underscores, dot, exponent,
# nan / inf / infinity, surrounded by whitespace
_DIGITS = r"[0-9](?:_?[0-9])*"
NUMBER_RE = (
    rf"^{WS}*[+-]?(?:(?:{_DIGITS})?\.?{_DIGITS}(?:[eE][+-]?{_DIGITS})?|{_DIGITS}\."
    rf"(?:[eE][+-]?{_DIGITS})?|(?i:nan|inf|infinity)){WS}*$"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()`` with Python's whitespace set (Spark ``trim`` strips only U+0020)."""
    return F.regexp_replace(_col(c), rf"^{WS}+|{WS}+\z", "")


def is_blank(c) -> Column:
    """NULL or only whitespace."""
    c = _col(c)
    return c.isNull() | (py_strip(c) == F.lit(""))


def is_missing_number(c) -> Column:
    c = _col(c)
    return c.isNull() | F.isnan(c)


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def clip01(c) -> Column:
    """min(1, max(0, x)); NaN becomes 0.0 as Python's ``max(0.0, nan)`` does; NULL stays."""
    c = _col(c)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.nanvl(c.cast("double"), F.lit(0.0))))


def safe_float(c, default: float | None = None) -> Column:
    """Tolerant number parse: what Python ``float()`` accepts, else ``default``.

    Blank or NULL input gives ``default``.  ``try_cast`` alone would also accept
    Spark-only forms such as ``1d`` and reject ``1_0``, so a pattern guards it.
    """
    c = _col(c).cast("string")
    cleaned = F.regexp_replace(py_strip(c), "_", "")
    parsed = F.when(c.rlike(NUMBER_RE), cleaned.try_cast("double"))
    if default is None:
        return parsed
    return F.coalesce(parsed, F.lit(float(default)))


def normalize_label(c) -> Column:
    """Label alias lookup on ``lower(strip(value))``; unknown → NULL (caller validates)."""
    pairs = []
    for key, value in LABEL_ALIASES.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.try_element_at(F.create_map(*pairs), F.lower(py_strip(_col(c).cast("string"))))


def display_label(c) -> Column:
    pairs = []
    for key, value in LABEL_DISPLAY.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.try_element_at(F.create_map(*pairs), _col(c))


def sigmoid(c, temperature: float | Column = 1.0) -> Column:
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(c) / t))


def softplus(c) -> Column:
    """log(1 + exp(x)) without overflow."""
    c = _col(c)
    return F.greatest(c, F.lit(0.0)) + F.log1p(F.exp(-F.abs(c)))


def format_duration(c) -> Column:
    """``HH:MM:SS`` with half-even rounding of seconds; NULL, NaN, ±inf, negative → ``--:--:--``."""
    c = _col(c).cast("double")
    total = F.bround(c, 0).cast("long")
    ok = c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))) & (c >= 0)
    text = F.format_string(
        "%02d:%02d:%02d",
        F.floor(total / 3600).cast("long"),
        F.floor((total % 3600) / 60).cast("long"),
        (total % 60).cast("long"),
    )
    return F.when(ok, text).otherwise(F.lit("--:--:--"))


def regex_quote(c) -> Column:
    """Java ``Pattern.quote`` as an expression: the phrase matched literally."""
    c = _col(c)
    return F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
