"""Approximate quantiles of any span of groups from stored, mergeable summaries (KLL), with their rank error.

A summary has a bounded number of values, some hundreds whatever the rows. A quantile read from merged summaries is a value whose
rank is off by at most :func:`rank_bound` of the rows, but for one in some thousands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: values kept on a summary's top level
SIZE = 400


def rank_bound(size: int = SIZE, times: float = 2.0) -> float:
    """Twice the rank error that 99 of 100 summaries of that size keep."""
    return times * 2.296 / size**0.9021


def summaries(df: DataFrame, value: str, groups: Sequence[str], size: int = SIZE) -> DataFrame:
    """One ``summary`` of the values per group; NULL values don't count."""
    number = F.col(value).cast("double")
    return df.filter(F.col(value).isNotNull()).groupBy(*groups).agg(F.kll_sketch_agg_double(number, F.lit(size)).alias("summary"))


def merged(stored: DataFrame, *by: Column, size: int = SIZE) -> DataFrame:
    """One summary by expressions over the groups of stored ones."""
    return stored.groupBy(*by).agg(F.kll_merge_agg_double("summary", F.lit(size)).alias("summary"))


def quantiles(stored: DataFrame, shares: Sequence[float], *by: Column) -> DataFrame:
    """share and value: the approximate quantiles by expressions over the groups, with n rows each."""
    united = merged(stored, *by)
    names = [c for c in united.columns if c != "summary"]
    # the function takes constant ranks only
    read = [
        F.struct(F.lit(float(share)).alias("share"), F.kll_sketch_get_quantile_double("summary", F.lit(float(share))).alias("value"))
        for share in shares
    ]
    return united.select(*names, F.kll_sketch_get_n_double("summary").alias("n"), F.inline(F.array(*read)))
