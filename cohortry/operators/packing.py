"""Texts of a wide row as one value while rows are shuffled.

A text column takes 16 bytes or more of a shuffled row whatever it holds.  Joined into one value, the texts of a row
take little more than their characters; nothing is lost on the way, neither NULLs nor the joining character itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Joins the texts, and marks what a text cannot hold as it is: 0 and 1 these two, 2 NULL, 3 bytes that are no UTF-8.
BETWEEN, MARK = "\x1f", "\x1e"


def text_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Those of ``cols`` that are plain text."""
    return [c for c in cols if df.schema[c].dataType == T.StringType()]


def pack(texts: Sequence[Column]) -> Column:
    """The texts as one, for :func:`unpack`; never NULL, and equal exactly where all texts are."""
    def closed(c):
        plain = F.replace(F.replace(c, F.lit(MARK), F.lit(MARK + "0")), F.lit(BETWEEN), F.lit(MARK + "1"))
        return F.when(c.isNull(), MARK + "2").when(F.is_valid_utf8(c), plain).otherwise(F.concat(F.lit(MARK + "3"), F.hex(c)))
    # nearly all rows need no mark but for NULL: one look at the whole row tells them
    whole = F.concat_ws("\n", *texts)
    clean = F.is_valid_utf8(whole) & ~whole.contains(MARK) & ~whole.contains(BETWEEN)
    return F.when(clean, F.concat_ws(BETWEEN, *[F.coalesce(c, F.lit(MARK + "2")) for c in texts])).otherwise(
        F.concat_ws(BETWEEN, *[closed(c) for c in texts]))


def unpack(packed: Column) -> Column:
    """Array of the texts in :func:`pack`, in order."""
    def opened(p):
        marked = F.when(p == MARK + "2", F.lit(None).cast("string")).when(
            p.startswith(MARK + "3"), F.unhex(F.substring(p, 3, 2**31 - 1)).cast("string")).otherwise(
            F.replace(F.replace(p, F.lit(MARK + "1"), F.lit(BETWEEN)), F.lit(MARK + "0"), F.lit(MARK)))
        return F.when(p.contains(MARK), marked).otherwise(p)
    return F.transform(F.split(packed, BETWEEN, -1), opened)


def free_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def shuffled(df: DataFrame, move: Callable[[DataFrame], DataFrame], keep: Sequence[str] = (),
             **extra: Column) -> DataFrame:
    """``move(df)`` with the text columns other than ``keep`` packed on the way.

    ``extra`` are columns that ``move`` needs besides; they are computed from the plain rows and go again.  Columns
    come back in their order, with their comments.
    """
    texts = text_columns(df, [c for c in df.columns if c not in keep])
    rest = [c for c in df.columns if c not in texts]
    one, several = free_name(df, "_texts"), free_name(df, "_each")
    rows = df.select(*[F.col(f"`{c}`") for c in rest], pack([F.col(f"`{c}`") for c in texts]).alias(one),
                     *[c.alias(n) for n, c in extra.items()])
    opened = move(rows).withColumn(several, unpack(F.col(one)))
    return opened.select(*[
        F.get(several, F.lit(texts.index(c))).alias(c, metadata=df.schema[c].metadata) if c in texts else F.col(f"`{c}`")
        for c in df.columns])
