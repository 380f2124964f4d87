import random

import edge
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import periodic_runs as p


def by_definition(words, least):
    """Every maximal stretch of each period, kept if no smaller period holds it."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        start = 0
        while start + period < len(words):
            end = start + period
            while end < len(words) and words[end] == words[end - period]:
                end += 1
            if end - start >= max(least, 2 * period):
                found.setdefault((start, end), period)
            start = max(start + 1, end - period + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def words(text):
    return [w.encode() for w in text]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=60), min_size=1, max_size=4), st.integers(2, 13))
def test_few_different_words(texts, least):
    texts = [words(t) for t in texts]
    assert p.find_runs(texts, least) == [by_definition(t, least) for t in texts]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.text("abcd", min_size=1, max_size=9), st.integers(1, 6), st.text("abcdefgh", max_size=5)), max_size=5),
    st.sampled_from([2, 7, 12]),
)
def test_planted_repeats(parts, least):
    text = words("".join(root * times + rest for root, times, rest in parts))
    assert p.find_runs([text], least) == [by_definition(text, least)]


def test_long_periods_and_nested_runs():
    generator = random.Random(5)
    root = [b"w%d" % generator.randrange(40) for _ in range(300)] + [b"x"] * 20 + [b"y", b"z"] * 9
    text = [b"start"] + root * 3 + root[:100] + [b"end"]
    runs = p.find_runs([text])[0]
    assert runs == by_definition(text, 12)
    assert (1, 3 * len(root) + 100, len(root)) in runs


def test_fibonacci_words_have_many_runs():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    assert p.find_runs([words(b)], 2)[0] == by_definition(words(b), 2)


def test_a_run_that_windows_split():
    # twice the same 14 words: the windows across the middle occur once
    root = [b"v%d" % k for k in range(14)]
    text = [b"a", *root, *root, b"b"]
    assert p.find_runs([text]) == [[(1, 28, 14)]]
    assert p.find_runs([root + [b"between"] + root]) == [[]]


def test_texts_share_no_runs():
    half = [b"q%d" % k for k in range(8)]
    assert p.find_runs([half + half[:3], half[3:] + half]) == [[], []]
    assert p.find_runs([[b"one"] * 11, [b"one"] * 12]) == [[], [(0, 12, 1)]]


@given(st.lists(st.integers(0, 4), min_size=1, max_size=40))
def test_extensions(symbols):
    symbols = [*symbols, 9]
    extend = p.Extensions(symbols)
    pairs = [(i, j) for i in range(len(symbols)) for j in range(len(symbols)) if i != j]
    found = extend(*map(np.array, zip(*pairs)))
    for (i, j), length in zip(pairs, found):
        expected = 0
        while max(i, j) + expected < len(symbols) and symbols[i + expected] == symbols[j + expected]:
            expected += 1
        assert length == expected


@pytest.mark.parametrize("part_bytes", [1, 1 << 20])
def test_edge_rows(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(p, "PART_BYTES", part_bytes)
    rows = edge.ROWS + [(20, "go " * 30 + "stop", "en", "a", 1), (21, "　   " * 12, "en", "a", 1)]
    out = p.periodic_runs(edge.documents(spark, rows)).collect()
    assert len(out) == len(rows)
    expected = sorted(
        (
            (key if key is not None else -1, len(split), by_definition(split, 12) if len(split) < 1000 else [], len(p.collapsed(split, []))) if key not in (20, 21)
            else (key, len(split), by_definition(split, 12), len(b" ".join({20: [b"go", b"stop"], 21: split[:2]}[key])))
            for key, text, *_ in rows
            for split in [(text or "").encode().split()]
        ),
        key=str,
    )
    got = sorted(
        ((r.doc_id if r.doc_id is not None else -1, r.n_words, [tuple(x) for x in r.runs], len(r.collapsed.encode())) for r in out), key=str
    )
    assert got == expected
    assert p.periodic_runs(edge.empty(spark)).count() == 0


def test_a_very_long_text():
    root = [b"t%d" % (k * k % 1009) for k in range(1009)]
    text = root * 200 + [b"tail"]
    runs = p.find_runs([text])[0]
    # squares mod a prime are the same read backwards, so 1009 is the period
    assert max(runs, key=lambda r: r[1]) == (0, 201_800, 1009)
    assert p.collapsed(text, runs).startswith(b" ".join(root[:10]))
    assert p.find_runs([[b"same"] * 100_000])[0] == [(0, 100_000, 1)]
