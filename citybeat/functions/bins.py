"""Bin labels (B1, B2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def left_closed_bin(col: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the ``[edges[i], edges[i+1])`` interval; null outside all bins."""
    c = _c(col)
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (c >= F.lit(lo)) & (c < F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def right_closed_bin(col: Column | str, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = True) -> Column:
    """Label of the ``(edges[i], edges[i+1]]`` interval, first one closed on the left too."""
    c = _c(col)
    expr = None
    for i, (lo, hi, label) in enumerate(zip(edges[:-1], edges[1:], labels)):
        lower = (c >= F.lit(lo)) if (i == 0 and include_lowest) else (c > F.lit(lo))
        cond = lower & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bin_case_sql(expr: str, edges: Sequence[float], labels: Sequence[str], right: bool = False) -> str:
    """The same binning as an SQL ``CASE`` (used by the SQL oracles and docs)."""
    parts = []
    for i, (lo, hi, label) in enumerate(zip(edges[:-1], edges[1:], labels)):
        if right:
            lower = f"{expr} >= {lo}" if i == 0 else f"{expr} > {lo}"
            parts.append(f"WHEN {lower} AND {expr} <= {hi} THEN '{label}'")
        else:
            parts.append(f"WHEN {expr} >= {lo} AND {expr} < {hi} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"
