"""Column expressions: decoding, parsing, bucketing and null-safe arithmetic.

Everything is a built-in Spark expression, so it stays inside whole-stage codegen.  Spark 4 runs in
ANSI mode (bad casts raise), hence the ``try_*`` forms throughout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(col: Column | str, mapping: Mapping, default=None) -> Column:
    """Look a code up in a literal map; unknown and NULL codes give ``default``."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[as_col(col)], F.lit(default))


def to_int(col: Column | str) -> Column:
    """Integer value of a text field, NULL when it is not a number."""
    return F.trim(as_col(col).cast("string")).try_cast("int")


def int_or_zero(col: Column | str) -> Column:
    return F.coalesce(to_int(col), F.lit(0))


def likely(col: Column | str, scale: int = 99) -> Column:
    """Inverse-percentile rule: low means likely.  Never NULL."""
    value = to_int(col)
    return F.coalesce(value <= 5 if scale == 10 else value < 50, F.lit(False))


def is_filled(col: Column | str) -> Column:
    c = as_col(col)
    return F.coalesce(c != "", F.lit(False))


def tag_if_present(col: Column | str, tag: str) -> Column:
    return F.when(is_filled(col), F.lit(tag))


def parse_age(col: Column | str) -> Column:
    """``E25`` / ``I25`` -> 25; blank or too short -> NULL."""
    c = as_col(col)
    return F.when(F.length(c) >= 2, to_int(F.substr(c, F.lit(2))))


def bucket(col: Column | str, bounds: Sequence[tuple], otherwise=None) -> Column:
    """Label of the inclusive range a number falls in; ``None`` bounds are open."""
    c = as_col(col)
    out = None
    for low, high, label in bounds:
        hit = c.between(low, high) if high is not None else c >= low
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def age_code(bucket_col: Column | str, age_col: Column | str, codes: Mapping[str, int],
             senior: Sequence[tuple]) -> Column:
    """Integer code of an age bucket; ``60+`` is refined by the age itself, unknown is 0."""
    first_senior = senior[0][2]
    refined = F.coalesce(bucket(age_col, senior), F.lit(first_senior))
    b = as_col(bucket_col)
    return F.when(b == "60+", refined).otherwise(decode(b, dict(codes), 0))


def income_amount(col: Column | str) -> Column:
    """Thousands as text -> dollars; blank and ``000`` are unknown."""
    text = F.trim(as_col(col))
    return F.when(~text.isin("", "000"), to_int(text) * 1000)


def income_code(bucket_col: Column | str, amount_col: Column | str, codes: Mapping[str, tuple],
                unknown: int, amount_unit: int = 1) -> Column:
    """Integer code of an income bucket, three buckets being split on the amount.

    ``amount_unit=1`` compares the stored amount as it is; ``1000`` compares thousands.
    """
    b, amount = as_col(bucket_col), as_col(amount_col)
    out = F.lit(unknown)
    for label, (limit, below, above) in reversed(list(codes.items())):
        code = F.lit(below)
        if limit is not None:
            code = F.when(amount < limit * amount_unit, F.lit(below)).otherwise(F.lit(above))
        out = F.when(b == label, code).otherwise(out)
    return out


def parse_yyyymmdd(col: Column | str, as_of) -> Column:
    """Eight-character date text (or a real DATE) -> date, else ``as_of``."""
    text = as_col(col).cast("string")
    parsed = F.when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd")) \
              .when(F.length(text) == 10, F.try_to_date(text, "yyyy-MM-dd"))
    return F.coalesce(parsed, F.lit(as_of).cast("date"))


def flag(col: Column | str, values: Sequence, otherwise=None) -> Column:
    return F.when(as_col(col).isin(*values), F.lit(1)).otherwise(F.lit(otherwise).cast("int"))


def argmin_label(candidates: Sequence[tuple], missing: int = 100, limit: int = 50,
                 default: str = "Unknown") -> Column:
    """Label of the smallest value below ``limit``; on a tie the first candidate wins."""
    scored = F.array(*[
        F.struct(F.coalesce(to_int(c), F.lit(missing)).alias("value"),
                 F.lit(order).alias("rank"), F.lit(label).alias("label"))
        for order, (c, label) in enumerate(candidates)])
    best = F.array_min(scored)
    return F.when(best["value"] < limit, best["label"]).otherwise(F.lit(default))


def greatest_or_null(*cols: Column) -> Column:
    """Largest value, NULL as soon as one input is NULL (``F.greatest`` would skip it)."""
    any_null = reduce(lambda a, b: a | b, [as_col(c).isNull() for c in cols])
    return F.when(~any_null, F.greatest(*[as_col(c) for c in cols]))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double division, NULL for a zero or NULL denominator."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def in_range(col: Column | str, start=None, end=None) -> Column:
    """Half-open date range ``start <= col < end``."""
    c = as_col(col)
    cond = F.lit(True)
    if start is not None:
        cond = c >= F.lit(start).cast("date")
    if end is not None:
        upper = c < F.lit(end).cast("date")
        cond = upper if start is None else cond & upper
    return cond


def month_filter(col: Column | str, include: Sequence[int] | None = None,
                 exclude: Sequence[int] | None = None,
                 exclude_range: tuple[str, str] | None = None) -> Column:
    """Keep or drop calendar months, and drop an inclusive ``MM-dd`` range of every year."""
    c = as_col(col)
    cond = F.lit(True)
    if include:
        cond = cond & F.month(c).isin(*include)
    if exclude:
        cond = cond & ~F.month(c).isin(*exclude)
    if exclude_range:
        cond = cond & ~F.date_format(c, "MM-dd").between(*exclude_range)
    return cond


# --- text --------------------------------------------------------------------------------------
def keyword_match(cols: Sequence[Column | str], keywords: Sequence[str],
                  upper: bool = True) -> Column:
    """True when any keyword occurs, ignoring case, in any of the columns.  Never NULL.

    Keywords are literal text: ``%``, ``_`` and quotes have no special meaning.  ``upper=False`` says
    the columns are in upper case already.
    """
    if not keywords:
        return F.lit(False)
    # the whole OR per column sits under one coalesce, so a NULL column simply does not match
    per_col = [
        F.coalesce(reduce(lambda a, b: a | b,
                          [(F.upper(as_col(c)) if upper else as_col(c)).contains(k.upper())
                           for k in keywords]),
                   F.lit(False))
        for c in cols]
    return reduce(lambda a, b: a | b, per_col)


def normalise(col: Column | str, lower: bool = False, upper: bool = False,
              hyphenate: bool = False) -> Column:
    c = as_col(col)
    if lower:
        c = F.lower(c)
    if upper:
        c = F.upper(c)
    return F.replace(c, F.lit(" "), F.lit("-")) if hyphenate else c


def split_list(col: Column | str, sep: str = ",") -> Column:
    """Delimited text -> array of trimmed, non-empty values; NULL stays NULL."""
    parts = F.split(as_col(col), "\\Q" + sep + "\\E")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")
