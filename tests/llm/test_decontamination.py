import edge
import numpy as np
import pytest

from ledgerloom.llm import decontamination as d

ITEMS = [
    (1, "What is the tallest tower of the old harbour town? It is the northern lighthouse built in stone."),
    (2, "Name the river that crosses the valley of apples and pears before it meets the sea. The answer is the Lune."),
    (3, "one two three"),
    (4, None),
    (5, ""),
    (6, "..."),
    (7, "What is the tallest tower of the old harbour town? It is the northern lighthouse built in stone."),
]


def test_retrieval_equals_scoring_every_passage():
    random = np.random.default_rng(3)
    words = [f"w{k}" for k in range(60)] + ["the", "of", "and"] * 5
    items = [(k, " ".join(random.choice(words, random.integers(3, 30)))) for k in range(70)]
    for threshold in (0.2, 0.5, 0.8):
        index = d.ItemIndex(items, threshold)
        for _ in range(25):
            text = " ".join(random.choice(words, random.integers(1, 200)))
            if random.random() < 0.5:
                text += " " + items[int(random.integers(len(items)))][1]
            ids = np.array([index.vocabulary.get(w, -1) for w in d.words_of(text)])
            found = {(p, i): s for p, i, s in index.retrieve(ids)}
            shares = np.zeros((len(index.vocabulary), len(index.items)))
            for word in range(len(index.vocabulary)):
                at = slice(index.starts[word * index.blocks], index.starts[(word + 1) * index.blocks])
                shares[word, index.owners[at]] = index.impacts[at]
            expected = {}
            for p in range(-(-len(ids) // index.span)):
                query = np.unique(ids[p * index.span : (p + 2) * index.span])
                scores = shares[query[query >= 0]].sum(0)
                expected |= {(p, int(i)): scores[i] for i in np.flatnonzero(scores >= threshold - 1e-9)}
            assert found == pytest.approx(expected)


def test_an_item_scores_one_against_itself():
    asked = d.matcher_of(ITEMS)
    assert [m["item_id"] for m in asked.matches(ITEMS[0][1])] == [1, 7]
    assert asked.matches(ITEMS[0][1])[0]["score"] == pytest.approx(1.0)
    assert [[k for k, _ in index.items] for index in asked.indexes] == [[3], [1, 2, 7]]
    assert [index.span for index in asked.indexes] == [4, 32]


def test_copies_inside_long_texts_and_small_edits():
    index = d.matcher_of(ITEMS)
    filler = " ".join(f"tree{k % 50} the of" for k in range(400))
    assert [m["item_id"] for m in index.matches(f"{filler} {ITEMS[1][1].upper()} {filler}")] == [2]
    edited = ITEMS[1][1].replace("apples", "plums")
    assert 0.7 < d.held(d.words_of(ITEMS[1][1]), d.words_of(edited)) < 0.8
    for sep in (" ", "\n", " -- "):
        assert [m["item_id"] for m in index.matches(sep.join(ITEMS[1][1].split(" ")))] == [2]
    assert index.matches("the tallest tower of the old town is not in the harbour") == []


def test_question_and_answer():
    assert d.question_and_answer("A b c? D e.") == ("A b c?", "D e.")
    assert d.question_and_answer("only one") == ("only one", "")


def test_edges_and_shards(spark):
    docs = edge.documents(spark, [*edge.ROWS, (50, f"x {ITEMS[0][1]} y", "en", "a", 1), (51, "one two three", "en", "a", 1)])
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as score")
    expected = {(50, 1), (50, 7), (51, 3)}
    assert {(r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()} == expected
    assert d.item_indexes(items, shard_chars=30).count() > 2
    kept = d.without_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(edge.ROWS)
    assert d.contaminated(docs, items.limit(0)).count() == 0
    assert d.contaminated(docs, items.limit(0)).columns == d.contaminated(docs, items).columns
    assert d.without_leaks(docs, items.limit(0)).count() == docs.count()
    assert d.contaminated(edge.empty(spark), items).count() == 0


def scattered(seed, number):
    """Items of 2 to 60 words, and texts with copies of them, whole, edited or in two pieces far apart."""
    random = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(300)] + ["the", "of", "and"] * 30
    draw = lambda n: [str(w) for w in random.choice(words, n)]
    items = [(k, " ".join(draw(int(random.integers(2, 60))))) for k in range(number)]
    texts = []
    for k, item in items:
        own = item.split()
        if k % 3 == 1:
            own[len(own) // 2] = "other"
        if k % 3 == 2:
            own = own[: len(own) // 2] + draw(300) + own[len(own) // 2 :]
        texts.append((k, " ".join(draw(50) + own + draw(40))))
    return items, texts


@pytest.mark.parametrize("long_item", [False, True])
def test_shards_and_passes_change_nothing(spark, long_item):
    items, texts = scattered(6, 60)
    if long_item:
        items.append((900, " ".join(f"long{k}" for k in range(3000))))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    found = {}
    for shard_chars, pass_bytes in ((30, 10**9), (30, 1), (1000, 20_000), (1 << 40, 10**9)):
        rows = d.contaminated(docs, benchmark, shard_chars=shard_chars, pass_bytes=pass_bytes).collect()
        found[shard_chars, pass_bytes] = sorted((r.doc_id, r.item_id, round(r.score, 9), r.overlap) for r in rows)
    assert len({str(rows) for rows in found.values()}) == 1
    rows = next(iter(found.values()))
    whole = d.matcher_of(items)
    assert rows == sorted((k, m["item_id"], round(m["score"], 9), m["overlap"]) for k, text in texts for m in whole.matches(text))
    assert {(k, k) for k in range(0, 60, 3)} <= {r[:2] for r in rows}
    # in two pieces 300 words apart an item isn't there, whatever else is asked for
    long_enough = {k for k, item in items if len(item.split()) >= 12}
    assert not {(k, k) for k in range(2, 60, 3) if k in long_enough} & {r[:2] for r in rows}


def test_equal_rows_are_one_item(spark):
    items = spark.createDataFrame([ITEMS[0], ITEMS[0], ITEMS[6]], "item_id long, text string")
    docs = spark.createDataFrame([(1, ITEMS[0][1])], "doc_id long, text string")
    assert sorted(r.item_id for r in d.contaminated(docs, items).collect()) == [1, 7]


def test_a_very_long_item(spark):
    item = " ".join(f"long{k % 7919}" for k in range(60_000))
    items = spark.createDataFrame([(1, item), ITEMS[0]], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"before {item} after"), (2, item[: len(item) // 2]), (3, ITEMS[0][1])], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()} >= {(1, 1), (3, 1)}
