"""Bounded samples: never more than asked for, the same each time, and no table in one task."""

from pyspark.sql import functions as F

import edge
from helpers import plan
from ledgerloom.llm import common, html_extract


def test_drawn_rows_are_about_as_many_as_wanted(spark):
    ids = spark.range(20_000)
    assert ids.where(common.drawn(F.col("id"), 20_000, 20_000)).count() == 20_000
    some = ids.where(common.drawn(F.col("id"), 1000, 20_000))
    assert 800 < some.count() < 1200
    assert ids.where(common.drawn(F.col("id"), 10, 0)).count() == 20_000


def test_labelled_sample_is_bounded_and_repeatable(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('text ', id) as text", "'x' as y")
    rows = [(k, int(k % 5 > 0), 0) for k in range(2000)] + [(7, 0, 0), (None, 1, 1), (8, None, None)]
    labels = edge.labels(spark, rows)
    take = lambda part: common.labelled_sample(docs.repartition(part), labels, "quality", F.col("doc_id") % 2 == 0, {0: 30, 1: 70})
    sample = take(3)
    assert sample == take(7)
    assert [sum(y == label for _, y in sample) for label in (0, 1)] == [30, 70]
    assert all(int(text.split()[1]) % 2 == 0 for text, _ in sample)
    everything = common.labelled_sample(docs, labels, "quality", F.lit(True), {0: 10**6, 1: 10**6})
    assert len(everything) == 2000
    assert ("text 7", 1) in everything  # the larger of two labels


def test_pages_are_looked_for_until_enough_are_found(spark):
    pages = spark.range(3000).selectExpr(
        "id as page_id", "concat('http://h/', id) as url", "if(id % 100 = 0, '<article>x y</article>', '<p>z</p>') as html"
    )
    assert len(html_extract.labelled_pages(pages, 5)) == 5
    assert len(html_extract.labelled_pages(pages, 100)) == 30
    assert html_extract.labelled_pages(pages.limit(0), 5) == []


def test_scoring_needs_no_shuffle(spark):
    pages = spark.createDataFrame([(1, "u", "<article>x</article>")], "page_id long, url string, html string")
    assert "Exchange" not in plan(html_extract.extract(pages))
