import edge
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing


def filled(sizes, weights, most, share=1.0):
    """Water-filling by rounds: clamp, hand the excess on by weight, until nothing is above its cap."""
    total, targets, open_ = share * sum(sizes), {}, set(range(len(sizes)))
    while open_:
        left = total - sum(targets.values())
        level = left / sum(weights[k] for k in open_)
        over = {k for k in open_ if level * weights[k] > most * sizes[k]}
        if not over:
            return [targets.get(k, level * weights[k]) for k in range(len(sizes))]
        for k in over:
            targets[k] = most * sizes[k]
        open_ -= over
    return [targets[k] for k in range(len(sizes))]


@pytest.mark.parametrize(
    "sizes", [[100, 100, 100], [1, 1000, 5], [0, 10, 10, 10], [1, 2, 3, 4, 5, 6, 700], [5], [0, 0], [3, 1, 10_000, 2, 90, 90, 90, 1]]
)
@pytest.mark.parametrize("share", [1.0, 0.25, 5.0])
def test_targets_follow_the_rounds(spark, sizes, share):
    rows = spark.createDataFrame([(f"s{k:02}", size) for k, size in enumerate(sizes)], "source string, size long")
    out = {r.source: r.target for r in mixing.source_targets(rows, share=share).collect()}
    weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
    expected = filled(sizes, weights, 3, share)
    assert [out[f"s{k:02}"] for k in range(len(sizes))] == pytest.approx(expected)


def test_a_source_yields_its_target_to_the_word(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "repeat('w ', cast(1 + id % 37 as int)) as text", "case when id % 3 = 0 then 'hot' else concat('s', id % 11) end as source"
    )
    out = mixing.mix(docs).toPandas()
    for _, rows in out.groupby("source"):
        assert rows.taken.sum() == int(rows.target.iloc[0] + 0.5)
        assert (rows.taken <= 3 * rows["size"]).all()
        cut = (rows.taken % rows["size"] > 0).sum()
        assert cut <= 1
    assert abs(out.taken.sum() - out["size"].sum()) <= out.source.nunique()


def test_edges(spark):
    out = mixing.mix(edge.documents(spark)).toPandas()
    assert len(out) == len(edge.ROWS)
    assert out.taken.min() >= 0 and (out.taken <= 3 * out["size"]).all()
    assert out[out.doc_id == 4]["size"].tolist() == [0]
    assert out.source.isna().sum() == 2
    assert mixing.mix(edge.empty(spark)).count() == 0


def test_main_path_is_native(spark, monkeypatch):
    from helpers import plan

    docs = edge.documents(spark)
    assert "Python" not in plan(mixing.mix(docs))
    assert "Python" not in plan(mixing.mixed_documents(docs))
    monkeypatch.setattr(mixing, "SENT_SOURCES", 0)
    assert "Python" not in plan(mixing.mix(docs))
    assert docs.select(mixing.word_count(F.lit(" a b  c\x0bd\n"))).first()[0] == 3


def hot_documents(spark):
    return spark.range(3000).selectExpr(
        "if(id % 7 = 6, null, id) as doc_id",
        "repeat('w ', cast(id % 37 as int)) as text",
        "case when id % 3 = 0 then 'hot' when id % 5 = 0 then null else concat('s', id % 11) end as source",
        "'kept' as turn",
        "id as n",
    )


def test_a_long_plan_is_joined_in_slices(spark, monkeypatch, setting):
    docs = hot_documents(spark)
    sent = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "SENT_SOURCES", 0)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = mixing.mix(docs)
    assert sorted(map(str, joined.collect())) == sent
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.shuffle.partitions", "12")
    queued, plan = mixing._queued(docs, "x"), mixing._plan(mixing._queued(docs, "x"), (5, 2, 1), 3, 1.0)
    keys = ["nameless", "named"]
    rows = [r["count"] for r in mixing.split_join(queued, plan, keys, "left").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(rows) == 3000 and max(rows) < 700  # the hot source has 1,000


def test_mixed_documents_keep_their_columns(spark):
    docs = hot_documents(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == [*docs.columns, *mixing.RESULTS]
    narrow = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("t")).collect()
    assert sorted(map(str, mixed.groupBy("source").agg(F.sum("taken").alias("t")).collect())) == sorted(map(str, narrow))
    by_row = {r.n: (r.text, r.source, r.turn, r.size) for r in mixed.collect()}
    assert by_row == {r.n: (r.text, r.source, r.turn, r.n % 37) for r in docs.collect()}
    edge_docs = edge.documents(spark)
    assert mixing.mixed_documents(edge_docs).count() == len(edge.ROWS)
    assert set(mixing.mixed_documents(edge_docs).columns) == set(edge_docs.columns) | set(mixing.RESULTS)


def test_documents_without_id_queue_by_their_texts(spark):
    docs = spark.range(400).selectExpr("cast(null as long) as doc_id", "concat(repeat('w ', 9), id) as text", "'s' as source")
    turns = mixing._queued(docs, "x").select("bucket").distinct().count()
    assert turns > 300
