"""Text and label expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: Column, last: Column) -> Column:
    """NULL when either part is NULL (``concat_ws`` would skip it)."""
    return F.concat(first, F.lit(" "), last)


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number with leading zeros; longer numbers keep all their digits."""
    return F.format_string(f"{prefix}%0{width}d", number)


def bin_fixed(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin ``(edges[i], edges[i+1]]``; NULL outside all bins."""
    if len(edges) != len(labels) + 1:
        raise ValueError("bin_fixed needs one more edge than labels")
    if any(low >= high for low, high in zip(edges, edges[1:])):
        raise ValueError("bin_fixed needs increasing edges")
    branches = None
    for upper, label in zip(edges[1:], labels):
        inside = value <= F.lit(upper)
        branches = F.when(inside, label) if branches is None else branches.when(inside, label)
    return F.when(value > F.lit(edges[0]), branches)
