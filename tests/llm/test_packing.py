import random
import zlib
from collections import defaultdict

import edge
import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import packing as p

PATH = public_tokenizers.path("byte_bpe_50k.json")


def power_of_two(n):
    return n & (n - 1) == 0


def check_windows(windows, sizes, window, slack):
    """Every token once, no window too full, no room left but where it is allowed."""
    covered = defaultdict(list)
    for pieces in windows:
        total = sum(size for _, _, size in pieces)
        assert 0 < total <= window
        assert window - total <= slack or power_of_two(total)
        for document, first, size in pieces:
            assert size > 0
            covered[document].append((first, size))
    for document, size in enumerate(sizes):
        at = 0
        for first, length in sorted(covered[document]):
            assert first == at
            at += length
        assert at == size


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=60), st.sampled_from([8, 16, 64]), st.integers(0, 3))
def test_every_token_is_in_one_window(sizes, window, slack):
    check_windows(p.packed(sizes, window, slack), sizes, window, slack)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_best_fit_is_the_tightest_window(sizes):
    expected = []  # rooms, by trying every window
    for size in sorted(sizes, reverse=True):
        fits = [k for k, room in enumerate(expected) if room >= size]
        if fits:
            expected[min(fits, key=lambda k: expected[k])] -= size
        else:
            expected.append(16 - size)
    windows, room = p.best_fit([(k, 0, size) for k, size in enumerate(sizes)], 16)
    assert sorted(room) == sorted(expected)
    assert [16 - sum(s for _, _, s in w) for w in windows] == room


@given(st.lists(st.integers(0, 16)), st.integers(1, 16))
def test_room_tree(capacities, needed):
    tree = p.RoomTree(16)
    for capacity in capacities:
        tree.add(capacity, 1)
    assert tree.tightest(needed) == min((c for c in capacities if c >= needed), default=-1)


def test_pieces_that_fit_stay_whole():
    generator = random.Random(3)
    sizes = [generator.randrange(1, 9000) for _ in range(3000)]
    windows = p.packed(sizes)
    check_windows(windows, sizes, p.WINDOW, p.SLACK)
    cuts = sum(map(len, windows)) - sum(-(-size // p.WINDOW) for size in sizes)
    assert cuts <= 0.05 * len(sizes)
    assert len(windows) <= 1.001 * sum(sizes) / p.WINDOW + 11
    # documents that can't share a window have to be cut
    sizes = [1300] * 1000
    check_windows(p.packed(sizes), sizes, p.WINDOW, p.SLACK)


@pytest.mark.parametrize("group", [1, 3000, 1 << 22])
def test_pack(spark, monkeypatch, group):
    monkeypatch.setattr(p, "GROUP", group)
    library = tokenizers.Tokenizer.from_file(PATH)
    out = p.pack(edge.documents(spark).repartition(3), PATH, 1).collect()
    expected = sorted(
        ((row[0] if row[0] is not None else -1, library.encode(row[1] or "", add_special_tokens=False).ids + [1]) for row in edge.ROWS),
        key=lambda r: (r[0], len(r[1])),
    )
    windows, documents = defaultdict(list), defaultdict(list)
    for r in out:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        windows[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id if r.doc_id is not None else -1, r.doc_tokens].append((r.start, ids))
    for parts in windows.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= p.WINDOW and (p.WINDOW - end <= p.SLACK or power_of_two(end))
    got = []
    for (key, tokens), parts in documents.items():
        copies = sum(1 for start, _ in parts if start == 0)
        parts = sorted(parts)
        assert sum(len(ids) for _, ids in parts) == copies * tokens
        if copies == 1:
            got.append((key, [i for _, ids in parts for i in ids]))
        else:  # repeated rows are cut alike or not; each token is there twice
            got += [(key, next(ids for k, ids in expected if k == key and len(ids) == tokens))] * copies
    assert sorted(got, key=lambda r: (r[0], len(r[1]))) == expected


def test_whole_windows(spark):
    pieces = p.pack(edge.documents(spark), PATH, 1, window=1000, slack=40)
    rows = p.sequences(pieces, window=1000).collect()
    sizes = defaultdict(int)
    for r in pieces.collect():
        sizes[r.sequence_id] += r.length
    assert {r.sequence_id for r in rows} == sizes.keys()
    for r in rows:
        n = sizes[r.sequence_id]
        assert r.n_padding == (0 if power_of_two(n) else 1000 - n) <= 40
        assert len(r.ids) == 4 * (n + r.n_padding)
    crc = {r.sequence_id: zlib.crc32(r.ids[: 4 * sizes[r.sequence_id]]) for r in rows}
    for key in sizes:
        parts = sorted((r.offset, bytes(r.ids)) for r in pieces.where(f"sequence_id = {key}").collect())
        assert crc[key] == zlib.crc32(b"".join(part for _, part in parts))
        break


def test_empty_table(spark):
    assert p.pack(edge.empty(spark), PATH, 1).count() == 0
    assert p.sequences(p.pack(edge.empty(spark), PATH, 1)).count() == 0
