import random
from collections import Counter, defaultdict

import edge
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard_join as j
from ledgerloom.llm.components import connected_components


def by_hand(rows, size, num, den):
    """Components by comparing all pairs."""
    sets = {}
    for key, text in rows:
        words = (text or "").encode().lower().split()
        length = min(size, len(words))
        sets[key] = {tuple(words[k : k + length]) for k in range(len(words) - length + 1)} if words else set()
    up = {k: k for k in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def variants(seed, bases=14, copies=9, most_edits=6, lengths=(1, 150)):
    """Families of texts with some words changed, dropped or added, some texts shared by all."""
    r = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(300)] + ["the", "of"] * 40
    shared = [r.choice(vocabulary) for _ in range(25)]
    rows = []
    for _ in range(bases):
        base = [r.choice(vocabulary) for _ in range(r.randint(*lengths))]
        if r.random() < 0.4:
            base = shared + base
        for _ in range(copies):
            text = list(base)
            for _ in range(r.randrange(most_edits)):
                at = r.randrange(len(text) + 1)
                if r.random() < 0.5 and at < len(text):
                    text[at] = r.choice(vocabulary)
                elif r.random() < 0.5 and at < len(text):
                    del text[at]
                else:
                    text.insert(at, r.choice(vocabulary))
            rows.append((len(rows), " ".join(text)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "num", "den", "seed"), [(3, 90, 100, 1), (5, 80, 100, 2), (2, 60, 100, 3)])
def test_components_equal_brute_force(spark, size, num, den, seed):
    rows = variants(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in j.linked_components(docs, size, num, den).collect()}
    expected = by_hand(rows, size, num, den)
    assert out == expected
    assert len({c for _, c in expected.values()}) < len(rows) - 10


@pytest.mark.parametrize("final", [0, 10**9])
def test_large_families_by_blocks(spark, monkeypatch, final):
    for name, value in (("SMALL", 4), ("BLOCK", 8), ("PIVOTS", 2), ("FINAL_PAIRS", final)):
        monkeypatch.setattr(j, name, value)
    rows = variants(5, bases=3, copies=45, most_edits=9, lengths=(60, 90))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in j.linked_components(docs, 3, 90, 100).collect()}
    assert out == by_hand(rows, 3, 90, 100)


@pytest.mark.parametrize(("num", "den"), [(9, 10), (4, 5), (1, 2)])
@pytest.mark.parametrize("sets", [10, 10**6, 10**10])
def test_linked_sets_share_a_signature(num, den, sets):
    """The pigeonhole bound, at the largest difference that still links, for every way of allocation."""
    random_ = np.random.default_rng(7)
    signer = j.Signer(sets, num, den)
    for size in (1, 2, 5, 9, 10, 11, 14, 19, 20, 27, 40, 63, 100, 150, 333, 800):
        for _ in range(6):
            other = int(random_.integers(size, size * den // num + 1))
            common = -(-num * (size + other) // (num + den))
            if common > size:
                continue
            values = random_.integers(0, 1 << 63, size + other - common, dtype=np.uint64)
            a, b = np.sort(values[:size]), np.sort(values[size - common :])
            assert np.intersect1d(signer.signatures(a), signer.signatures(b)).size, (size, other)


@pytest.mark.parametrize(("num", "den"), [(9, 10), (4, 5)])
def test_linked_sets_share_one_of_their_rarest_signatures(num, den):
    """Among sets that share passages with many others, at the largest difference that still links."""
    random_ = np.random.default_rng(11)
    signer = j.Signer(30_000, num, den)
    passages = random_.integers(0, 1 << 63, (4, 60), dtype=np.uint64)
    pairs, sets = [], []
    for size in (20, 40, 63, 100, 117, 140, 200, 333) * 4:
        other = int(random_.integers(size, size * den // num + 1))
        common = -(-num * (size + other) // (num + den))
        if common > size:
            continue
        values = random_.integers(0, 1 << 63, size + other - common, dtype=np.uint64)
        shared = passages[int(random_.integers(4))][: size // 2]
        at = int(random_.integers(0, size - len(shared) + 1))
        values[at : at + len(shared)] = shared
        pairs.append((len(sets), len(sets) + 1))
        sets += [np.unique(values[:size]), np.unique(values[size - common :])]
    # sets that hold nothing but passages, so that those signatures are the most frequent
    sets += [np.unique(passages.ravel()[k : k + 90]) for k in range(0, 150, 3)]
    by_set = [signer.indexed(s) for s in sets]
    found = Counter(sig for bands in by_set for own, _ in bands for sig in own.tolist())

    def looked_up(k):
        return {sig for own, wanted in by_set[k] for sig in sorted(own.tolist(), key=lambda x: (found[x], x))[:wanted]}

    assert any(wanted < len(own) for bands in by_set for own, wanted in bands)
    for a, b in pairs:
        assert looked_up(a) & looked_up(b), (len(sets[a]), len(sets[b]))


def test_passages_that_many_share_make_no_candidates(spark):
    """Documents that share half of their words, but are not linked."""
    r = random.Random(3)
    passage = [f"p{k}" for k in range(70)]
    rows = []
    for k in range(300):
        own = [f"x{r.randrange(10**6)}" for _ in range(70)]
        rows.append((k, " ".join(own[:30] + passage + own[30:])))
    rows += [(1000 + k, text.replace(" p5 ", " q5 ")) for k, text in rows[:40]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = j.Join(5, 80, 100, 100_000)
    sets = j.document_sets(docs, join)
    pairs = {(r.a, r.b) for r in j._candidates(sets).collect()}
    assert {(k, 1000 + k) for k in range(40)} <= pairs
    # without the choice of the rarest, the passage would connect all of them
    assert len({k for pair in pairs for k in pair if 40 <= k < 1000}) < 130
    assert {x.doc_id: x.component_id for x in j.linked_components(docs).collect()} == {k: k % 1000 for k, _ in rows}


def test_allocations_use_every_means():
    chosen = [j.allocation(low, int(low * 1.5), 10**8, 9, 10) for low in (2, 10, 20, 40, 80, 200, 1000)]
    assert any(d for _, d, _ in chosen) and any(s for _, _, s in chosen)
    for low in range(1, 400):
        segments, deletions, spare = j.allocation(low, int(low * 1.5), 10**5, 9, 10)
        assert deletions <= segments
        assert 2 * deletions + segments - deletions > j.most_difference(2 * int(low * 1.5), 9, 10) + spare - (spare == 0)


def test_copies_and_hot_groups(spark):
    rows = [(k, "the very same text of a hot group") for k in range(0, 1200, 2)]
    rows += [(k, f"the other text number {k} is its own") for k in range(1, 1200, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    out = {r.doc_id: (r.class_id, r.component_id) for r in j.linked_components(docs).collect()}
    assert all(out[k] == ((0, 0) if k % 2 == 0 else (k, k)) for k, _ in rows)


def test_edges(spark):
    docs = edge.documents(spark)
    out = j.linked_components(docs, 3, 90, 100).toPandas()
    assert len(out) == len(edge.ROWS)
    found = out.dropna(subset=["doc_id"]).drop_duplicates().set_index("doc_id").component_id.to_dict()
    assert found == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 1, 9: 9, 10: 10}
    assert out[out.doc_id.isna()].component_id.isna().all()
    assert out.set_index("doc_id").n_shingles[[2, 3, 4]].tolist() == [0, 0, 0]
    kept = j.one_of_each(docs)
    assert kept.columns == docs.columns
    # 6 is a copy of 1, and there twice; rows without id are documents of their own
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "9", "10", "None", "None"])
    assert j.linked_components(edge.empty(spark)).count() == 0
    assert j.one_of_each(edge.empty(spark)).count() == 0


def test_repeated_rows_and_ids(spark):
    text, other = "a b c d e f g h i j k l", "m n o p q r s t u v w x"
    rows = [(1, text), (2, text), (2, other), (3, other), (3, other), (4, "alone here in the corpus it stands")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {(r.doc_id, r.component_id) for r in j.linked_components(docs).collect()}
    assert out == {(1, 1), (2, 1), (3, 1), (4, 4)}
    # texts are told apart within an id: the copies of 1 and 2 go, no text is lost
    assert sorted((r.doc_id, r.text) for r in j.one_of_each(docs).collect()) == [(1, text), (2, other), (4, rows[-1][1])]


def test_only_the_row_whose_text_is_a_copy_goes(spark):
    a, b, x, y = (" ".join(f"{c}{k}" for k in range(30)) for c in "abxy")
    near = a.replace("a29", "other")
    rows = [(3, a, 1), (7, a, 1), (7, b, 1), (8, x, 1), (8, y, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    assert sorted(map(tuple, j.one_of_each(docs).collect())) == [rows[0], rows[2], rows[3], rows[4]]
    # equal rows are one, of rows equal in id and text one stays; a document without id goes if one with an id is near
    more = [*rows, (8, x, 1), (8, x, 2), (None, near, 1), (None, " ".join(f"z{k}" for k in range(30)), 1), (None, None, 1), (None, None, 1)]
    docs = spark.createDataFrame(more, "doc_id long, text string, n int").repartition(5)
    kept = [tuple(r) for r in j.one_of_each(docs).collect()]
    assert sorted(((r[0] or 0), r[1] or "") for r in kept) == sorted([(3, a), (7, b), (8, x), (8, y), (0, more[8][1]), (0, "")])
    again = [tuple(r) for r in j.one_of_each(docs.repartition(3)).collect()]
    assert sorted(kept, key=str) == sorted(again, key=str)


def test_near_copies_without_id(spark):
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base), " ".join([*base, "tail"]), " ".join(["head", *base])]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert j.one_of_each(docs).count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(130)] + [(1000 + k, 1001 + k) for k in range(60)]
    out = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo.extend(new)
        assert out[node] == min(seen)
    assert set(out) == set(near)


def test_levels_of_signatures(spark):
    r = random.Random(9)
    sets = {r.randrange(-(1 << 63), 1 << 63): r.choice([2, 3, 4, 9, 300, 1 << 15, 1 << 20]) for _ in range(3000)}
    alone = [r.randrange(-(1 << 63), 1 << 63) for _ in range(20_000)]
    signed = spark.createDataFrame([(k, sig) for k, sig in enumerate([*sets, *alone])], "rep long, sig long")
    repeated = spark.createDataFrame(list(sets.items()), "sig long, sets long")
    out = {x.sig: x.often for x in j._shared(signed, repeated).collect()}
    assert all(out[sig] >= min(15, n.bit_length() - 1) for sig, n in sets.items())
    assert sum(out[sig] == min(15, n.bit_length() - 1) for sig, n in sets.items()) > 2700
    assert len(out) < len(sets) + 2000  # most of those that one set alone has are left out


@pytest.mark.parametrize("blocks", [1, 2, 1 << 16])
def test_components_do_not_depend_on_the_levels(spark, monkeypatch, blocks):
    """With a block or two most signatures share a bucket, or there are too many for the levels, which are joined then."""
    monkeypatch.setattr(j, "BLOCKS", blocks)
    rows = variants(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (0, j.LEAST_BUCKETS):
        monkeypatch.setattr(j, "LEAST_BUCKETS", least)
        out = {r.doc_id: (r.n_shingles, r.component_id) for r in j.linked_components(docs, 5, 80, 100).collect()}
        assert out == by_hand(rows, 5, 80, 100)


def test_signatures_are_not_sent_one_by_one(spark, monkeypatch):
    """A list of the repeated ones with their counts took some 80 bytes each on the driver, 134 MB over 0.5 GB of texts."""
    sent, send = [], F.broadcast
    monkeypatch.setattr(j.F, "broadcast", lambda df: sent.append(df.count()) or send(df))
    docs = spark.createDataFrame(variants(4, bases=60, lengths=(100, 150)), "doc_id long, text string")
    sets = j.document_sets(docs, j.Join(5, 80, 100, 100_000))
    assert j._candidates(sets).count()
    signatures = sets.select(F.explode(F.flatten("bands.sigs")).alias("sig"))
    repeated = signatures.groupBy("sig").count().where("count > 1").count()
    assert repeated > 2000 and 0 < sum(sent) * 30 < repeated


def test_signatures_of_one_set_stay_where_there_are_too_many_for_levels(spark, monkeypatch):
    """All of them moved then, with the fingerprint of their set: 4.6 times the input."""
    r = random.Random(9)
    sets = {r.randrange(-(1 << 63), 1 << 63): r.choice([2, 3, 4, 9, 300, 1 << 20]) for _ in range(3000)}
    alone = [r.randrange(-(1 << 63), 1 << 63) for _ in range(20_000)]
    signed = spark.createDataFrame([(k, sig) for k, sig in enumerate([*sets, *alone])], "row long, sig long")
    repeated = spark.createDataFrame(list(sets.items()), "sig long, sets long")
    sent, send = [], F.broadcast
    monkeypatch.setattr(j, "BLOCKS", 32)
    monkeypatch.setattr(j.F, "broadcast", lambda df: sent.append(df) or send(df))
    assert {x.sig: x.often for x in j._shared(signed, repeated).collect()} == sets
    (bits,) = sent
    held = {x.block: x.words for x in bits.collect()}
    passing = [x for x in signed.select("sig", *j._place(j._blocks(len(sets), j.BITS), j.BITS)).collect() if x.block in held and held[x.block][x.word] >> x.place & 1]
    assert sets.keys() <= {x.sig for x in passing} and len(passing) < len(sets) + 2000


def test_signatures_move_with_the_number_of_their_row(spark, monkeypatch):
    moved, shared = [], j._shared
    monkeypatch.setattr(j, "_shared", lambda signed, repeated: moved.append(signed.columns) or shared(signed, repeated))
    rows = variants(6)
    # the same id with several texts, and rows that come twice, are rows of their own
    docs = spark.createDataFrame([*rows, *[(0, text) for _, text in rows[:20]], *rows[:5]], "doc_id long, text string").repartition(5)
    sets = j.document_sets(docs, j.Join(5, 80, 100, len(rows)))
    numbers = [x.row for x in sets.collect()]
    assert len(set(numbers)) == len(numbers) == len(rows) + 25
    assert j._candidates(sets).count()
    assert moved == [["row", "k", "sig"]]


@pytest.mark.parametrize("shingles", [0, j.BLOCK_SHINGLES])
def test_large_families_of_short_sets_that_are_not_linked(spark, monkeypatch, shingles):
    """Chance meetings connect them; each moved once for every block of 256 others."""
    for name, value in (("SMALL", 4), ("BLOCK", 16), ("PIVOTS", 2), ("BLOCK_SHINGLES", shingles)):
        monkeypatch.setattr(j, name, value)
    verified, moved = j._verified, []
    monkeypatch.setattr(j, "_verified", lambda blocks, join: moved.append(blocks.count()) or verified(blocks, join))
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(24 + k % 3))) for k in range(600)]
    rows += [(600 + k, f"{text} tail") for k, text in rows[:50]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = spark.createDataFrame([(k, len(text.split()) - 4) for k, text in rows], "rep long, n long")
    candidates = spark.createDataFrame([(k, k + 1) for k in range(len(rows) - 1)], "a long, b long")
    links = {(x.a, x.b) for x in j._family_links(docs, sizes, candidates, j.Join(5, 80, 100, len(rows))).collect()}
    assert links == {(k, 600 + k) for k in range(50)}
    assert (sum(moved) < 12 * len(rows)) == bool(shingles)
