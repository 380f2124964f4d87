"""Every stage on what the one before kept, against plain re-computations."""

import edge
import pandas as pd
import pytest

import corpus_pipeline
from ledgerloom.llm import decontamination as d
from ledgerloom.llm import line_dedup as l

from test_jaccard_join import by_hand as components_by_hand
from test_line_dedup import by_hand as lines_by_hand


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    out.append(docs.toPandas())
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, small).write.parquet(folder)
        docs = spark.read.parquet(folder)
        out.append(docs.toPandas())
    return out


def test_columns(stages):
    assert all(frame.columns.tolist() == stages[0].columns.tolist() for frame in stages[1:-1])


def test_toxic_documents_go(stages, small):
    labels = pd.read_parquet(f"{small}/labels.parquet")
    toxic, clean = (set(labels[labels.toxic == y].doc_id) for y in (1, 0))
    gone = set(stages[0].doc_id) - set(stages[1].doc_id)
    assert len(gone & toxic) > 0.5 * len(toxic) and len(gone & clean) < 0.1 * len(clean)


def test_lines(stages):
    rows = list(zip(stages[1].doc_id, stages[1].text))
    assert sorted(zip(stages[2].doc_id, stages[2].text)) == [(k, text) for k, text, _ in lines_by_hand(rows)]


def test_one_of_each_group_stays(stages):
    found = components_by_hand(list(zip(stages[2].doc_id, stages[2].text)), 5, 80, 100)
    assert set(stages[3].doc_id) == {k for k, (_, c) in found.items() if k == c}


def test_no_test_item_is_left(stages, small):
    index = d.matcher_of(list(pd.read_parquet(f"{small}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False)))
    leaks = {k for k, text in zip(stages[3].doc_id, stages[3].text) if index.matches(text)}
    assert set(stages[4].doc_id) == set(stages[3].doc_id) - leaks


def test_mix(stages):
    assert sorted(stages[5].doc_id) == sorted(stages[4].doc_id)
    assert abs(stages[5].taken.sum() - stages[5]["size"].sum()) <= 20


def test_run_gives_the_last_stage(spark, small, stages):
    out = corpus_pipeline.run(spark, small).toPandas().sort_values("doc_id")
    assert out.taken.tolist() == stages[5].sort_values("doc_id").taken.tolist()


@pytest.mark.parametrize("rows", [edge.ROWS, []])
def test_stages_survive_odd_documents(spark, tmp_path, small, rows):
    docs = edge.documents(spark, rows)
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == columns
    assert l is not None and docs.count() <= len(rows)
