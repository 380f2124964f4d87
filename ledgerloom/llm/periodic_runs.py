"""Runs of words that repeat with a period, found with suffix trees.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least twice q and at
least ``least`` words long, that no neighbouring word extends with the same period.

Every run holds a Lyndon root: for one of the two orders of the words (an order and its reverse), the run's
period is the length of the longest Lyndon word that starts at some place of it. That word ends where the next smaller
suffix starts (for the reverse order, the next larger one). So each place gives two candidates (place, period), and
each is extended in both directions by one query for the longest common extension: to the right in the suffix tree
of the words, to the left in that of the words reversed. Both trees are built by Ukkonen's method. The tour
through a tree's leaves keeps the least depth it passes between neighbouring leaves; a table of minima over ranges of
2^k of them gives the depth of two leaves' lowest common ancestor, which is the length of the extension, by two
looks.

A run with period q repeats at least ``max(least - q, q)`` words at distance q, so all its windows of
``(least + 1) // 2`` words occur twice in the text, but for fewer than so many windows in the middle. Stretches of
such windows are found first; words outside of them are in no run and stay out of the trees. The stretches
of a text, and of neighbouring texts up to ``PART_BYTES``, make one sequence with a different separator
after each. No run holds a separator, because each occurs once.

Scale: one pass in Arrow batches, no shuffle. Memory is bounded by the trees of one part: some 700 bytes for each word
in its stretches. A longer text is a part of its own.

Null, empty and blank texts have no words and no runs. Repeated rows get equal results; equally long runs are
ordered by start, then period; an empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import texts_in_parts

LEAST = 12
PART_BYTES = 1 << 20

Run = tuple[int, int, int]  # start, length, period

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of integers whose last one occurs once.

    Inner nodes have a depth, the start of one of their occurrences and children by first symbol; a
    child below zero is the leaf ``~child`` of the suffix that starts there.
    """

    def __init__(self, symbols: list[int]):
        depth, first, link, children = [0], [0], [0], [{}]
        node = edge = length = open_suffixes = 0
        for at, symbol in enumerate(symbols):
            unlinked = 0
            open_suffixes += 1
            while open_suffixes:
                if not length:
                    edge = at
                below = children[node]
                child = below.get(symbols[edge])
                if child is None:
                    below[symbols[edge]] = ~(at - open_suffixes + 1)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    if child >= 0:
                        label = depth[child] - depth[node]
                        if length >= label:
                            node = child
                            length -= label
                            edge += label
                            continue
                        begin = first[child] + depth[node]
                    else:
                        begin = ~child + depth[node]
                    if symbols[begin + length] == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    start = at - open_suffixes + 1
                    split = len(depth)
                    depth.append(depth[node] + length)
                    first.append(start)
                    link.append(0)
                    children.append({symbols[begin + length]: child, symbol: ~start})
                    below[symbols[edge]] = split
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                open_suffixes -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = at - open_suffixes + 1
        self.depth, self.children = depth, children

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of the leaves, and the least depth passed on the way to each from the one before."""
        leaves: list[int] = []
        lows: list[int] = []
        depth, children = self.depth, self.children
        stack = [(0, 0)]
        while stack:
            node, low = stack.pop()
            if node < 0:
                leaves.append(~node)
                lows.append(low)
                continue
            own, below = depth[node], children[node]
            order = sorted(below, reverse=True)
            stack.extend([(below[symbol], own) for symbol in order[:-1]])
            stack.append((below[order[-1]], low))
        return np.array(leaves, np.int64), np.array(lows, np.int32)


class Extensions:
    """Lengths of longest common extensions of pairs of places, each by two looks at a table of range minima."""

    def __init__(self, symbols: list[int]):
        leaves, lows = SuffixTree(symbols).tour()
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self.minima = [lows]
        width = 1
        while 2 * width <= len(lows):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The places of a pair differ."""
        low, high = self.rank[one], self.rank[other]
        low, high = np.minimum(low, high) + 1, np.maximum(low, high) + 1
        level = np.frexp((high - low).astype(float))[1] - 1  # exact below 2^53
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.minima[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        return out


def next_smaller(values: Sequence[int]) -> np.ndarray:
    """For each place the next place with a smaller value; the number of places if there is none."""
    out = [len(values)] * len(values)
    stack: list[int] = []
    for at, value in enumerate(values):
        while stack and values[stack[-1]] > value:
            out[stack.pop()] = at
        stack.append(at)
    return np.array(out, np.int64)


def runs_of(symbols: list[int], least: int = LEAST) -> np.ndarray:
    """(start, end, period) of each run, in order; the last symbol must occur once."""
    number = len(symbols)
    right = Extensions(symbols)
    ranks = right.rank.tolist()
    ends = np.concatenate([next_smaller(ranks), next_smaller([-r for r in ranks])])
    starts = np.concatenate([np.arange(number)] * 2)
    kept = ends < number
    starts, ends = starts[kept], ends[kept]
    after = right(starts, ends)
    # the reversed sequence ends with a symbol of its own, too
    left = Extensions([*symbols[::-1], max(symbols) + 1])
    before = np.zeros(len(starts), np.int64)
    inner = np.flatnonzero(starts > 0)
    before[inner] = left(number - starts[inner], number - ends[inner])
    period = ends - starts
    first, last = starts - before, ends + after
    long = last - first >= np.maximum(least, 2 * period)
    return np.unique(np.stack([first, last, period], axis=1)[long], axis=0)


def stretches(words: list[bytes], least: int = LEAST) -> list[tuple[int, int]]:
    """Where windows of ``(least + 1) // 2`` words that occur twice lie close enough to hold a run."""
    size = (least + 1) // 2
    if len(words) < least:
        return []
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):  # equal windows have equal sums; others may, which makes a stretch longer
        windows = (windows ^ (windows >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(windows)]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    at = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
    marked = np.flatnonzero(twice[at] == windows)
    cuts = np.flatnonzero(np.diff(marked) > size)
    first = marked[np.concatenate([[0], cuts + 1])]
    last = marked[np.concatenate([cuts, [len(marked) - 1]])] + size
    return [(int(a), int(b)) for a, b in zip(first, last) if b - a >= least]


def find_runs(texts: Sequence[list[bytes]], least: int = LEAST) -> list[list[Run]]:
    """The runs of each sequence of words, by start, then period."""
    numbers: dict[bytes, int] = {}
    symbols: list[int] = []
    pieces: list[tuple[int, int, int]] = []  # place among the symbols, text, first word
    for text, words in enumerate(texts):
        for first, last in stretches(words, least):
            pieces.append((len(symbols), text, first))
            symbols.extend([numbers.setdefault(word, len(numbers)) for word in words[first:last]])
            symbols.append(-len(pieces))
    found: list[list[Run]] = [[] for _ in texts]
    if symbols:
        runs = runs_of(symbols, least)
        begins = np.array([p[0] for p in pieces])
        for (first, last, period), k in zip(runs.tolist(), np.searchsorted(begins, runs[:, 0], side="right") - 1):
            begin, text, word = pieces[k]
            found[text].append((first - begin + word, last - first, period))
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in found]


def collapsed(words: list[bytes], runs: Sequence[Run]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(kept)])


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed text of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in texts_in_parts(batch.column("text"), PART_BYTES):
                words = [text.encode("utf-8", "replace").split() for text in part]
                runs = find_runs(words, least)
                listed = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs]
                left = [collapsed(*pair).decode() for pair in zip(words, runs)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(done, len(part)),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array(listed, _RUNS),
                        pa.array(left, pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
                done += len(part)

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(
        rows, f"doc_id long, n_words long, runs {RUNS}, collapsed string"
    )
