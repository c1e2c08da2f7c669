"""Column-expression cleaning rules (SCA-*).

All helpers return Columns built from built-in functions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES: the number grammar accepted by the lenient float parse (what a
# Python float() accepts after ',' -> '.', minus underscores / NBSP /
# full-width digits), and the whitespace stripped by str.strip().
NUM = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"
STRIP = r"(?U)^\s+|\s+$"

# The full float grammar applied to text already stripped of Unicode
# whitespace: ASCII digit groups may be joined by single underscores.
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_TEXT = (rf"(?i)^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
              rf"(?:e[+-]?{_DIGITS})?$")
SPECIAL_TEXT = r"(?i)^[+-]?(?:nan|inf|infinity)$"
# Fast path: text made only of these characters is parsed by the cast
# directly (on this alphabet the cast and the float grammar agree).
_ASCII_WS = " \t\n\x0b\x0c\r"
_PLAIN_CHARS = "0123456789.eE+-" + _ASCII_WS

ColumnOrName = "Column | str"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """SCA-12: remove leading/trailing whitespace (tabs and newlines too)."""
    return F.regexp_replace(_c(c), STRIP, "")


def strip_lower(c) -> Column:
    """SCA-11: normalise text (strip then lower-case)."""
    return F.lower(strip(c))


def is_blank(c) -> Column:
    """SCA-18: null or the empty string. Whitespace is NOT blank."""
    c = _c(c)
    return c.isNull() | (c.cast("string") == F.lit(""))


def falsy_default(c, default: str) -> Column:
    """SCA-15: null or '' is replaced by ``default``."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(default))


def to_float(c, dtype: T.DataType | None = None, default: float = 0.0) -> Column:
    """SCA-1: lenient float.

    Strings: blank -> default; every ',' becomes '.'; the result is parsed only
    when it matches ``NUM``, otherwise -> default.  Numbers and booleans are
    cast to double; null -> default.  ``dtype`` is the input column's type when
    known (pass ``df.schema[name].dataType``); strings are assumed otherwise.
    """
    c = _c(c)
    if dtype is not None and not isinstance(dtype, T.StringType):
        return F.coalesce(c.cast("double"), F.lit(float(default)))
    return (F.when(is_blank(c), F.lit(float(default)))
            .otherwise(F.coalesce(text_number(c), F.lit(float(default)))))


def text_number(c) -> Column:
    """The number that SCA-1 reads in a text, null when it reads none (a blank text has none)."""
    # ',' becomes '.'.  Plain ASCII numbers (the common case) need no regex:
    # translate() removes the plain-number characters and, when nothing is
    # left, the cast validates the structure.  Everything else is stripped
    # of Unicode whitespace like str.strip() and checked against the grammar.
    plain = F.translate(_c(c), ",", ".")
    fast = F.when(F.translate(plain, _PLAIN_CHARS, "") == "",
                  F.trim(plain, F.lit(_ASCII_WS)).try_cast("double"))
    v = F.regexp_replace(plain, STRIP, "")
    slow = (F.when(v.rlike(FLOAT_TEXT), F.translate(v, "_", "").try_cast("double"))
            .when(v.rlike(SPECIAL_TEXT),
                  F.when(F.lower(v).endswith("nan"), F.lit(float("nan")))
                  .otherwise(v.try_cast("double"))))
    return F.coalesce(fast, slow)


def strict_float(c) -> Column:
    """SCA-4: strict numeric coercion; unparsable -> null (NaN in pandas)."""
    c = _c(c)
    return F.when(c.cast("string").rlike(NUM), F.trim(c.cast("string")).try_cast("double"))


def safe_ratio(num, den, default: float = 0.0) -> Column:
    """SCA-2: ``num / den`` if den is truthy (non-zero, non-null) else default."""
    num, den = _c(num), _c(den)
    return F.when(den.isNotNull() & (den != 0), num / den).otherwise(F.lit(float(default)))


def length_between(c, lo: int, hi: int) -> Column:
    """SCA-17: inclusive length bounds; null fails."""
    return F.coalesce(F.length(_c(c)).between(lo, hi), F.lit(False))


def digits_only(c) -> Column:
    """FLT-8: the text is a non-empty run of ASCII digits."""
    return F.coalesce(_c(c).cast("string").rlike(r"^[0-9]+$"), F.lit(False))


def like_escape(text: str) -> str:
    """Escape LIKE wildcards so user text matches literally (T13 opt-in)."""
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def percent_text(p, decimals: int = 2) -> Column:
    """SCA-7 / PRJ-7: ``p * 100`` formatted with fixed decimals and a % sign."""
    return F.format_string(f"%.{decimals}f%%", _c(p) * 100.0)


def complement_percent_text(p, decimals: int = 2) -> Column:
    """SCA-7: ``100 - p * 100`` with fixed decimals and a % sign."""
    return F.format_string(f"%.{decimals}f%%", F.lit(100.0) - _c(p) * 100.0)


def leading_number(c, default: float = 0.0) -> Column:
    """SCA-10: form parsing, leading-number parse (like JS parseFloat)."""
    lead = F.regexp_extract(_c(c).cast("string"),
                            r"^\s*([+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?)", 1)
    return F.coalesce(F.nullif(lead, F.lit("")).try_cast("double"), F.lit(float(default)))
