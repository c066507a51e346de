"""Counter keys and their text form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from adfeat.config import DimSet


def dim_text(col: Column | str) -> Column:
    """Text of a dimension value; a missing value reads ``None`` inside a key."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit("None"))


def dim_key(dims, prefix: str = "") -> Column:
    """``#``-joined dimension values. Values are made non-null first: concat_ws skips nulls."""
    return F.expr("concat_ws('#', " + ", ".join(f"coalesce(cast({prefix}{d} AS string), 'None')" for d in dims) + ")")


def counter_key(dim_set: Column | str = "dim_set", key: Column | str = "dim_key", nation: str | None = None) -> Column:
    """Published key: set name followed by the values, led by the nation if there is one."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (dim_set, key)]
    return F.concat_ws("#", *([dim_text(nation)] if nation else []), *parts)


def keyed_sets(sets: tuple[DimSet, ...], prefix: str = "") -> Column:
    """Array of ``(dim_set, dim_key)`` entries, one per dimension set, for key lookups."""
    return F.array(*[
        F.struct(F.lit(s.name).alias("dim_set"), dim_key(s.dims, prefix).alias("dim_key")) for s in sets
    ])


def is_ascii(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.rlike(r"^[\x00-\x7F]*$")


def ascii_or_empty(col: Column | str) -> Column:
    """Keeps ASCII text, anything else becomes the empty string."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(is_ascii(col), col).otherwise(F.lit(""))
