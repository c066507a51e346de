"""Counter cells: the window slots of one key with their counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from adfeat.config import MEASURES, SLOT_PREFIX, WINDOW_TAGS


def _col(w: str, m: str) -> str:
    return f"_{w}_{m}"


def window_sums() -> list[Column]:
    """Per window and measure one conditional sum; null where the key lacks the window.

    Plain longs keep the aggregation on the hash path (a struct buffer would force a sort). A window outside
    the known ones, or null, has no slot: it stops the job, in the first of the sums."""
    tags = ", ".join(f"'{w}'" for w in WINDOW_TAGS)
    refuse = f" WHEN window_tag IS NULL OR window_tag NOT IN ({tags}) THEN CAST(raise_error(concat('unknown window tag: ', coalesce(window_tag, 'null'))) AS BIGINT)"
    return [
        F.expr(f"sum(CASE WHEN window_tag = '{w}' THEN coalesce({m}, 0L){'' if i or j else refuse} END)").alias(_col(w, m))
        for i, w in enumerate(WINDOW_TAGS)
        for j, m in enumerate(MEASURES)
    ]


def cell(install_field: str) -> Column:
    """Nested cell over the columns of :func:`window_sums`; zero counts are absent."""
    names = dict(zip(MEASURES, ("imp", "click", install_field)))
    slots = []
    for w in WINDOW_TAGS:
        counts = ", ".join(f"'{names[m]}', nullif(greatest({_col(w, m)}, 0L), 0L)" for m in MEASURES)
        slots.append(f"'{SLOT_PREFIX}{w}', CASE WHEN {_col(w, 'imp')} IS NOT NULL THEN named_struct({counts}) END")
    return F.expr(f"named_struct({', '.join(slots)})")


def empty_cell(install_field: str) -> Column:
    """Cell without any window, ``{}`` as JSON."""
    return F.expr("named_struct(" + ", ".join(
        f"'{SLOT_PREFIX}{w}', CAST(NULL AS {counts_type(install_field)})" for w in WINDOW_TAGS
    ) + ")")


def counts_type(install_field: str) -> str:
    return f"struct<imp:bigint,click:bigint,{install_field}:bigint>"


def cell_type(install_field: str) -> str:
    return "struct<" + ",".join(f"{SLOT_PREFIX}{w}:{counts_type(install_field)}" for w in WINDOW_TAGS) + ">"
