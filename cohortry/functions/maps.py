"""Map- and array-valued expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import as_col, is_filled, likely


def tag_array(pairs: Sequence[tuple]) -> Column:
    """Array of the tags whose column is filled, in the given order."""
    return F.array_compact(F.array(*[F.when(is_filled(c), F.lit(tag)) for c, tag in pairs]))


def map_without_nulls(keys: Sequence[Column], values: Sequence[Column]) -> Column:
    """Map of the pairs whose key and value are both present; the others are left out."""
    entries = F.array(*[F.struct(k.alias("key"), v.alias("value"))
                        for k, v in zip(keys, values)])
    return F.map_from_entries(
        F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull()))


def present_map(pairs: Sequence[tuple]) -> Column:
    """``{tag: 1}`` for every (condition, tag) whose condition holds."""
    return map_without_nulls([F.when(cond, F.lit(tag)) for cond, tag in pairs],
                             [F.lit(1) for _ in pairs])


def interest_map(pairs: Sequence[tuple], scale: int = 99) -> Column:
    """``{tag: 1}`` for every (column, tag) that is likely."""
    return present_map([(likely(c, scale), tag) for c, tag in pairs])


def flag_map(triples: Sequence[tuple]) -> Column:
    """``{tag: 0 or 1}`` with every tag present, from (column, tag, scale)."""
    items = []
    for c, tag, scale in triples:
        items += [F.lit(tag), likely(c, scale).cast("int")]
    return F.create_map(*items)


def dynamic_map(key: Column | str, value: Column | str) -> Column:
    """One-entry map keyed by a column; NULL when key or value is missing."""
    k, v = as_col(key), as_col(value)
    return F.when(k.isNotNull() & v.isNotNull(),
                  F.map_from_entries(F.array(F.struct(k.alias("key"), v.alias("value")))))


def list_membership_map(col: Column | str, members: Sequence[str], sep: str = ",") -> Column:
    """``{member: 1}`` for the members found in a delimited list; NULL for an empty list."""
    c = as_col(col)
    parts = F.transform(F.split(c, sep), lambda x: F.trim(x))
    return F.when(is_filled(c), present_map([(F.array_contains(parts, m), m) for m in members]))


def map_text(col: Column | str) -> Column:
    """Canonical ``k=v,k=v`` text of a map, keys ascending; for comparing and exporting."""
    pairs = F.transform(F.map_entries(as_col(col)),
                        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return F.array_join(F.array_sort(pairs), ",")
