"""Mixing sources to target weights: capped water-filling and seeded whole and fractional repetitions.

Every source has a size (words of its documents) and a weight. The mix is as large as ``share`` of
all sizes. Targets are in proportion to the weights, but at most ``max_epochs`` times the source's
size; what the capped sources leave goes to the others by weight until no target is above its cap.

Sorted by cap per weight, the capped sources come first. So with running sums over the sources one
comparison finds them all: a source is capped if its cap per weight is below the level at which the
sources from it on would share what the ones before it leave.

A document is taken ``floor(target / size of the source)`` times whole. For the rest of the target
the documents of a source queue by a seeded hash of their id: those in front are taken once more,
the one at the end of the queue in part, so that a source yields its target to the word. Reruns give
the same rows.

Scale: the text is read once for the word counts; those (id, source, size) are written to the shared
folder. Sources and hash buckets are summed before any shuffle. The plan, a row per source, is counted: up to
``SENT_SOURCES`` rows it is sent to all tasks, a longer one is joined by shuffle with the documents of heavy sources dealt into
slices. Either way a source with a third of all rows fills no task; only the documents in the one bucket where a
queue ends are ordered.

Nulls: a null text has size 0, null sources are one source (last in order), a document without id queues by a
hash of its text. Sources of size 0 have target 0. Rows that are alike in id, source and size get equal turns in
any order. An empty table gives an empty result. Other columns are ignored by :func:`mix`;
:func:`mixed_documents` keeps them all, but for those named like its results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, text_of
from ledgerloom.operators.hot_keys import split_join
from ledgerloom.session import durable

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: hash buckets of a queue, as hex digits of the hash
BUCKET_DIGITS = 4
#: a plan of at most so many sources (some 100 bytes each) is sent to all tasks
SENT_SOURCES = 100_000
RESULTS = ("size", "source_size", "target", "taken", "epochs")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """source, source_size, target from (source, size) rows. Works on one row per source."""
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    place = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before, whole = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    listed = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(cycle, ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_epochs)
    )
    left = listed.withColumns(
        {
            "left_size": F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "left_weight": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    ).withColumn("uncapped", F.col("left_size") * F.col("weight") / F.col("left_weight") <= F.col("cap"))
    # the first source that isn't capped sets the level for itself and all after it
    first = Window.orderBy("cap_rank").rowsBetween(Window.unboundedPreceding, 0)
    levelled = left.withColumn("cap_rank", F.row_number().over(by_cap)).withColumns(
        {
            "level_size": F.first(F.when(F.col("uncapped"), F.col("left_size")), ignorenulls=True).over(first),
            "level_weight": F.first(F.when(F.col("uncapped"), F.col("left_weight")), ignorenulls=True).over(first),
        }
    )
    shared = F.col("level_size") * F.col("weight") / F.col("level_weight")
    return levelled.select(
        "source", "source_size", F.coalesce(shared, F.col("cap")).cast("double").alias("target")
    )


def _named_source(source: str) -> dict[str, Column]:
    """The source as columns that are never null."""
    return {"nameless": F.col(source).isNull(), "named": F.coalesce(F.col(source), F.lit(""))}


def _queued(docs: DataFrame, seed: str, *kept: Column) -> DataFrame:
    """The kept columns, source (as ``_named_source``), size, and the turn and bucket of each document."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(text_of())))
    sized = docs.select(*kept, "doc_id", "source", word_count(text_of()).alias("size"), F.md5(F.concat(F.lit(f"{seed}:"), key)).alias("turn"))
    return sized.withColumns({**_named_source("source"), "bucket": F.substring("turn", 1, BUCKET_DIGITS)})


def _plan(sized: DataFrame, weights: Sequence[int], max_epochs: int, share: float) -> DataFrame:
    """Per source: its size, target, whole repetitions, and where its queue ends."""
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = (
        source_targets(sized, weights, max_epochs, share)
        .withColumn("epochs", rate.cast("long"))
        .withColumn("goal", F.floor(F.col("target") + 0.5) - F.col("epochs") * F.col("source_size"))
    )
    plan = durable(plan)  # a row per source; its readers must not compute the sums again
    goals = plan.select(F.col("source").alias("s"), "goal")
    goals = F.broadcast(goals) if plan.count() <= SENT_SOURCES else goals
    # the bucket in which the queue of each source ends, and the words before it
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        sized.groupBy("source", "bucket")
        .agg(F.sum("size").alias("words"))
        .withColumn("ahead", F.coalesce(F.sum("words").over(order), F.lit(0)))
        .join(goals, F.col("source").eqNullSafe(F.col("s")))
        .where((F.col("ahead") < F.col("goal")) & (F.col("goal") <= F.col("ahead") + F.col("words")))
        .select("s", F.col("bucket").alias("last_bucket"), "ahead")
    )
    ended = plan.join(ends, plan.source.eqNullSafe(ends.s), "left").drop("s").withColumns(_named_source("source"))
    return durable(ended.drop("source"))


def _taken(queued: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents with their source's plan and the words that the mix takes of each."""
    keys = ["nameless", "named"]
    if plan.count() <= SENT_SOURCES:
        planned = queued.join(F.broadcast(plan), keys)
    else:
        planned = split_join(queued, plan, keys, "left", spread=["turn"])
    front = F.col("last_bucket").isNotNull() & (F.col("bucket") < F.col("last_bucket"))
    at_end = F.coalesce(F.col("bucket") == F.col("last_bucket"), F.lit(False))
    queue = Window.partitionBy(*keys).orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    missing = F.col("goal") - F.col("ahead") - F.coalesce(F.sum("size").over(queue), F.lit(0))
    ordered = planned.where(at_end).withColumn("more", F.greatest(F.lit(0), F.least(F.col("size"), missing)))
    others = planned.where(~at_end).withColumn("more", F.when(front, F.col("size")).otherwise(F.lit(0)))
    taken = (F.col("epochs") * F.col("size") + F.col("more")).cast("long")
    return others.unionByName(ordered).withColumn("taken", taken)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    share: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, epochs (whole repetitions) of every document."""
    sized = durable(_queued(docs, seed))
    return _taken(sized, _plan(sized, weights, max_epochs, share)).select("doc_id", "source", *RESULTS)


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    share: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """Every document with all its columns and size, source_size, target, taken, epochs: the training mix itself.

    Texts don't move while the plan is sent to all tasks, but for those in the bucket where a queue ends.
    """
    plan = _plan(durable(_queued(docs, seed)), weights, max_epochs, share)
    taken = _taken(_queued(docs, seed, F.struct(*docs.columns).alias("row")), plan)
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in RESULTS]
    return taken.select(*own, *RESULTS)
