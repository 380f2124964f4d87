"""URL filters: a temporal list join.

A filter list is a table of dated entries: (key, category, effective date, action), where the action
lists or unlists the key. Keys are hosts or parent domains, alone or with the first part of the path. A capture
is held against its host and every parent domain, however many labels they have, both alone and with its path.
Addresses (four numbers, or anything in brackets) have no parents.
:func:`intervals` turns entries into validity intervals, and :func:`evaluate` runs an as-of join: every
capture is held against the entries that were active on the day it was fetched.

Scale: the join is an equality on (key, month) with the interval's dates as a filter, so one host with a
third of all captures is spread over the months of the crawl, and adaptive execution splits what is
still large. Captures are reduced to distinct (keys, day) pairs on the way in, so that repeated visits
to a place on one day meet the list once. Nothing is broadcast unless Spark finds it small.

Several entries of one key, category and day: unlisting wins. Entries with a null key, date or action are
ignored. Captures with a null url or without host match nothing; without a date they match nothing either.
Repeated captures each get their row. Empty lists block nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LISTED, UNLISTED = "list", "unlist"
#: characters of a domain name in DNS, at most
LONGEST = 253
ADDRESS = r"^(\d{1,3}(\.\d{1,3}){3}|\[.*\])$"
FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a last dot, an address in brackets with them; empty if there is none."""
    pattern = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#@]+\]|[^/?#:@\[\]]+)"
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), pattern, 1)
    return F.regexp_replace(found, r"\.$", "")


def first_path(url: Column) -> Column:
    """The first part of the path, empty if there is none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)


def domains(host: Column) -> Column:
    """The host and its parent domains of two labels or more; none without host, and no parents of addresses."""
    labels = F.split(host, r"\.")
    size = F.size(labels)
    # no name is longer than LONGEST, so a longer (broken) host has no more parents than fit
    most = F.size(F.split(F.substring(host, -LONGEST, LONGEST), r"\."))
    most = F.when(F.length(host) > LONGEST, most).otherwise(size)
    parents = F.transform(
        F.sequence(F.lit(2), F.greatest(most, F.lit(2))),
        lambda n: F.array_join(F.slice(labels, F.greatest(size - n + 1, F.lit(1)), n), "."),
    )
    alone = F.when(host == "", F.array().cast("array<string>")).when(host.rlike(ADDRESS), F.array(host))
    return alone.otherwise(F.array_union(F.array(host), parents))


def lookup_keys(host: Column, path: Column) -> Column:
    """The keys of a capture: the host and all its parent domains, each with and without the path's first part."""
    names = domains(host)
    return F.when(path != "", F.array_union(names, F.transform(names, lambda name: F.concat_ws("/", name, path)))).otherwise(names)


def intervals(entries: DataFrame) -> DataFrame:
    """key, category, valid_from, valid_until (exclusive) of each time a key was listed."""
    days = (
        entries.where(F.col("key").isNotNull() & F.col("effective").isNotNull() & F.col("action").isin(LISTED, UNLISTED))
        .groupBy("key", "category", "effective")
        .agg(F.max("action").alias("action"))  # "unlist" is the larger one
    )
    later = Window.partitionBy("key", "category").orderBy("effective")
    return (
        days.withColumn("before", F.lag("action").over(later))
        .where(F.col("before").isNull() | (F.col("before") != F.col("action")))
        .withColumn("valid_until", F.coalesce(F.lead("effective").over(later), F.lit(FOREVER).cast("date")))
        .where(F.col("action") == LISTED)
        .select("key", "category", F.col("effective").alias("valid_from"), "valid_until")
    )


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def evaluate(captures: DataFrame, listed: DataFrame) -> DataFrame:
    """capture_id, url, fetched, blocked, n_entries and the first category and key that block it.

    ``captures``: capture_id, url, fetched (date). ``listed``: result of :func:`intervals`.
    """
    seen = captures.select("capture_id", "url", "fetched", host_of(F.col("url")).alias("host"), first_path(F.col("url")).alias("path"))
    places = seen.where((F.col("host") != "") & F.col("fetched").isNotNull()).select("host", "path", "fetched").distinct()
    keyed = places.select("*", F.explode(lookup_keys(F.col("host"), F.col("path"))).alias("key")).withColumn("month", _month(F.col("fetched")))
    # the months that any capture can fall into bound the slices of an open interval
    span = captures.agg(F.min("fetched").alias("low"), F.max("fetched").alias("high"))
    low, high = span.select("low").scalar(), span.select("high").scalar()
    start = F.greatest(F.col("valid_from"), low)
    end = F.least(F.date_sub("valid_until", 1), high)
    sliced = listed.where(start <= end).withColumn("month", F.explode(F.sequence(_month(start), _month(end))))
    active = keyed.join(sliced, ["key", "month"]).where((F.col("valid_from") <= F.col("fetched")) & (F.col("fetched") < F.col("valid_until")))
    verdicts = active.groupBy("host", "path", "fetched").agg(
        F.count(F.lit(1)).alias("n_entries"), F.min(F.struct("category", "key")).alias("hit")
    )
    joined = seen.join(verdicts, ["host", "path", "fetched"], "left")
    return joined.select(
        "capture_id",
        "url",
        "fetched",
        F.col("n_entries").isNotNull().alias("blocked"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.col("hit.category").alias("category"),
        F.col("hit.key").alias("matched_key"),
    )
