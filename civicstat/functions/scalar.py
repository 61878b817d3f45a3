"""Scalar column expressions shared by all operators.

All of them are built-in Spark expressions, so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results.
DATE_PATTERN = "d-M-yyyy"          # strict day-month-year, single digits allowed
ENDS_IN_YEAR = "[0-9]{4}$"
_DIGITS = "[0-9]+(?:_[0-9]+)*"
_SPACES = r"[\s\x1c-\x1f]*"
NUMBER_REGEX = rf"(?U)^{_SPACES}([+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?){_SPACES}$"
PINCODE_REGEX = r"(?s)^([0-9]{6})(?:\..*)?$"  # six digits before an optional '.'


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column) -> Column:
    """Day-month-year text to DATE; anything else becomes NULL.

    The parser throws and catches an exception for every text it rejects. The
    pattern's year has at least four digits and ends the text, so texts without
    them (ISO dates, empty ones) are NULL before it.
    """
    return F.when(col_(c).rlike(ENDS_IN_YEAR), F.try_to_date(col_(c), DATE_PATTERN))


def _tidy(c: Column) -> Column:
    """Whether the first and the last character are printable ASCII, so that
    there is nothing to strip."""
    return F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)


_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_NOT_PLAIN = r"(?U)^[\s\x1c-\x1f]|[\s\x1c-\x1f]$|[^\p{L} ]\p{L}"


def strip_ws(c: str | Column) -> Column:
    """Remove leading/trailing whitespace of any kind, Unicode spaces and the
    separators U+001C..U+001F included, as Python's ``strip`` does. The regular
    expression runs only on texts whose ends may need it."""
    c = col_(c)
    return F.when(_tidy(c), c).otherwise(F.regexp_replace(c, _ENDS, ""))


# private-use marker inserted after every non-letter; removed afterwards
_MARK = "\ue000"


def title_case(c: str | Column) -> Column:
    """Python-style ``str.strip().title()``; NULL stays NULL.

    Every run of letters gets an upper-case first letter and lower-case
    rest, so ``24-parganas`` → ``24-Parganas`` (``initcap`` alone keeps it
    lower, as it splits words on spaces only). A space is put after every
    non-letter, ``initcap`` capitalises the letter that follows it, and the
    inserted spaces are removed again: three built-in string functions,
    all inside whole-stage codegen.
    """
    c = col_(c)
    marked = F.regexp_replace(F.lower(F.regexp_replace(c, _ENDS, "")), r"(\P{L})", "$1" + _MARK + " ")
    slow = F.regexp_replace(F.initcap(marked), _MARK + " ", "")
    # initcap alone is already right unless there is something to strip or a
    # letter follows a character that is neither a letter nor a space
    return F.when(c.rlike(_NOT_PLAIN), slow).otherwise(F.initcap(c))


def pincode(c: str | Column) -> Column:
    """Text before the first '.', six digits, as INT; invalid → NULL.

    NULL input stays NULL and is not counted as invalid (see ``pincode_invalid``).
    """
    return F.regexp_extract(col_(c).cast("string"), PINCODE_REGEX, 1).try_cast("int")


def pincode_invalid(c: str | Column) -> Column:
    return col_(c).isNotNull() & pincode(c).isNull()


def number(c: str | Column) -> Column:
    """What Python's ``float`` reads from a text, else NULL: digits with single
    underscores between them, no type suffix and no hexadecimal form; infinite
    values and NaN written as words are NULL.

    A text without letters and without spaces around it needs no pattern: the
    engine's own cast reads the same numbers from it. The pattern decides on
    the rest.
    """
    raw = col_(c).cast("string")
    # no match is an empty text, for which the cast would throw and catch an exception
    found = F.nullif(F.regexp_extract(raw, NUMBER_REGEX, 1), F.lit(""))
    strict = F.replace(found, F.lit("_"), F.lit("")).try_cast("double")
    return F.coalesce(F.when(_tidy(raw) & (F.lower(raw) == F.upper(raw)), raw.try_cast("double")), strict)


def is_nonneg(v: str | Column) -> Column:
    """Whether a number is there, finite and at least 0. It names ``v`` once, so
    that a filter, which the optimizer copies below the parsing step, parses
    once: the root of any other number times 0 is not a number."""
    return F.coalesce(F.sqrt(col_(v)) * 0 <= 0, F.lit(False))


def nonneg(v: str | Column) -> Column:
    """The finite numbers of at least 0; others are NULL (NaN is above all)."""
    v = col_(v)
    return F.when((v >= 0) & (v < F.lit(float("inf"))), v)


def nonneg_number(c: str | Column) -> Column:
    """Finite, non-negative number or NULL (text, NaN, ±inf, negatives)."""
    return nonneg(number(c))


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    """numpy/pandas ``round``: ties to even on the scaled binary value."""
    if digits == 0:
        return F.rint(col_(c))
    scale = float(10 ** digits)
    return F.rint(col_(c) * scale) / scale


def pct_ratio(num: str | Column, den: str | Column, scale: float = 100.0) -> Column:
    """``where(den > 0, num / den * scale, 0)``; a NULL denominator gives 0."""
    return F.when(col_(den) > 0, col_(num) / col_(den) * scale).otherwise(F.lit(0.0))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL (no error under ANSI)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def total(*cols: str) -> Column:
    """Sum of columns; NULL when any is NULL (row-wise ``a + b + c``)."""
    out = col_(cols[0])
    for c in cols[1:]:
        out = out + col_(c)
    return out


def iso_date(c: str | Column) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd")


def optional_filter(df, **eq):
    """Equality filters only for truthy arguments."""
    for name, value in eq.items():
        if value:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def date_range_filter(df, start=None, end=None, col: str = "date"):
    """Inclusive date range."""
    if start:
        df = df.filter(F.col(col) >= F.to_date(F.lit(str(start))))
    if end:
        df = df.filter(F.col(col) <= F.to_date(F.lit(str(end))))
    return df
