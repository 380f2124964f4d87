"""Groups of spelling variants: words that differ by one code point, found in bidirectional FM-indexes.

Words are near if they differ by exactly one inserted, deleted or replaced code point. A word's form is its near word
with most occurrences (ties: the smallest in code-point order), if that has at least ``ratio`` times the word's
own; its root is the last word that forms lead to.

Search scheme: a single error lies in one half of the searched word, so the other half is exact. The first half is
matched from the middle to the word's start, then extended to the right over the second with one error, up to the
word's end; or the second half to the end, then extended to the left over the first. The index is a text of delimited
words, ``|word|word``, read in a circle; a match is an interval of ranks among the suffixes of the text and at the same time one
among those of the reversed text, so that it can grow in both directions. Both intervals follow from counts of
code points before a rank in the two Burrows-Wheeler transforms. All searches of a block advance together, one
code point a step.

Scale: words are counted in the tasks first, then summed over tasks. A word of 2m or 2m+1 code points meets only words of
2m-1 to 2m+2 that share its exact half, so the vocabulary is dealt by (side, m, half): each word to four index keys and
two search keys. Blocks of many keys share an index of about ``BLOCK`` words. A half with more than ``BLOCK`` words is
cut into parts by a hash of the indexed word, and its searching words go to every part, so neither an index nor a task
grows with the vocabulary. The alphabet bounds a word's near words, so pairs grow with the vocabulary. Roots
take a logarithmic number of joins of the vocabulary with itself. Intermediate results are written to the shared folder.

Null, empty and blank texts and texts without letters have no words. Repeated rows count each. An empty table or
one without words that are frequent enough gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import compact
from ledgerloom.session import durable

SHORTEST = 6
RAREST = 5
RATIO = 5
BLOCK = 4096
BLOCKS_PER_TASK = 8
#: so many different words are counted in a task before they are handed on
COUNTED = 300_000
#: searches that advance together
BATCH = 2048

_LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
_END = 0  # the delimiter's code


def letter_runs(text: str) -> list[str]:
    """Longest runs of letters, only A-Z lower-cased."""
    return _LETTERS.findall(text.encode("utf-8", "replace").lower().decode())


def count_words(
    docs: DataFrame, rewrite: Callable[[int | None, str], str] | None = None, shortest: int = SHORTEST, rarest: int = RAREST
) -> DataFrame:
    """word, n of the words of at least ``shortest`` code points with at least ``rarest`` occurrences.

    ``rewrite(doc_id, word)`` may replace a document's word; all its occurrences there alike.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                own = Counter(letter_runs(text.as_py() or ""))
                for word, n in own.items():
                    if rewrite is not None:
                        word = rewrite(key, word)
                    if len(word) >= shortest:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield counted()
                    total = Counter()
        yield counted()

    found = docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(rows, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rarest)


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of the text read in a circle, in their order, by doubling the compared length."""
    number = len(text)
    rank = text.astype(np.int64)
    width = 1
    while True:
        pair = rank * (int(rank.max()) + 1) + np.roll(rank, -width)
        order = np.argsort(pair, kind="stable")
        steps = np.concatenate([[0], np.cumsum(np.diff(pair[order]) != 0)])
        rank = np.empty(number, np.int64)
        rank[order] = steps
        if steps[-1] == number - 1 or width >= number:
            return order
        width *= 2


class Side:
    """One direction of the index: counts of each code before each rank of the transform."""

    def __init__(self, text: np.ndarray, codes: int):
        self.places = suffix_ranks(text)
        transform = text[self.places - 1]
        self.before = np.zeros((len(text) + 1, codes), np.int32)
        self.before[np.arange(1, len(text) + 1), transform] = 1
        np.cumsum(self.before, axis=0, out=self.before)
        self.first = np.concatenate([[0], np.cumsum(self.before[-1])[:-1]]).astype(np.int64)


class VocabularyIndex:
    """Bidirectional FM-index of different words, for searches with one error in a stated half.

    A match is (start among the suffixes, start among those of the reversed text, number of both); it grows to the left
    (side 0) or to the right (side 1).
    """

    def __init__(self, words: list[str]):
        self.words = words
        text = "\0" + "\0".join(words)  # read in a circle: the first delimiter ends the last word
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        self.alphabet, coded = np.unique(points, return_inverse=True)  # the delimiter is the smallest
        codes = len(self.alphabet)
        self.sides = (Side(coded, codes), Side(coded[::-1].copy(), codes))
        self.owner = np.cumsum(coded == _END) - 1

    def coded(self, word: str) -> np.ndarray:
        """Codes of a word's letters; -1 for those of no indexed word."""
        points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at, -1)

    def grow(self, side: int, match: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The matches grown by one code each; of size 0 where there is none."""
        index = self.sides[side]
        here, size = match[:, side], match[:, 2]
        below, upto = index.before[here], index.before[here + size]
        known = np.maximum(code, 0)
        row = np.arange(len(match))
        inside = upto - below
        own = inside[row, known]
        less = np.cumsum(inside, axis=1)[row, known] - own
        grown = np.empty_like(match)
        grown[:, side] = index.first[known] + below[row, known]
        grown[:, 1 - side] = match[:, 1 - side] + less
        grown[:, 2] = np.where(code >= 0, own, 0)
        return grown

    def choices(self, side: int, match: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(match, code) of every letter by which a match can grow."""
        index = self.sides[side]
        here = match[:, side]
        more = index.before[here + match[:, 2]] > index.before[here]
        more[:, _END] = False
        return np.nonzero(more)

    def search(
        self, side: int, exact: np.ndarray, other: np.ndarray, exact_size: np.ndarray, other_size: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(search, indexed word) of all words with exactly one error in the half on ``side``.

        ``exact`` and ``other`` hold a search's halves a row, both read from the middle of the word outward.
        """
        number = len(exact)
        match = np.tile(np.array([0, 0, len(self.owner)], np.int64), (number, 1))
        row = np.arange(number)
        for k in range(exact.shape[1]):
            inner = k < exact_size[row]
            match = np.where(inner[:, None], self.grow(1 - side, match, exact[row, k]), match)
            row, match = _there(row, match)
        clean = _there(row, self.grow(1 - side, match, np.zeros(len(row), np.int64)))  # the word ends there
        wrong = (row[:0], match[:0])
        found = []
        for used in range(other.shape[1] + 1):
            # all states have used so many letters of the other half, without error (clean) or with one (wrong)
            row, match = clean
            at_end = other_size[row] == used
            next_code = other[row, used] if used < other.shape[1] else np.full(len(row), -1)
            at, code = self.choices(side, match)
            grown = self.grow(side, match[at], code)
            replaces = ~at_end[at] & (code != next_code[at])
            replaced = (row[at][replaces], grown[replaces])
            deleted = (row[~at_end], match[~at_end])
            clean = _there(row[~at_end], self.grow(side, match[~at_end], next_code[~at_end]))
            # an inserted letter uses none of the half
            row, match = np.concatenate([wrong[0], row[at]]), np.concatenate([wrong[1], grown])
            at_end = other_size[row] == used
            found.append(_there(row[at_end], self.grow(side, match[at_end], np.zeros(int(at_end.sum()), np.int64))))
            if used < other.shape[1]:
                row, match = row[~at_end], match[~at_end]
                moved = _there(row, self.grow(side, match, other[row, used]))
                wrong = tuple(np.concatenate(parts) for parts in zip(moved, replaced, deleted))
        row, match = (np.concatenate(parts) for parts in zip(*found))
        # a match is one word between delimiters; the place of the first names it
        return row, self.owner[self.sides[0].places[match[:, 0]]]

    def near(self, words: list[str], side: int) -> tuple[np.ndarray, np.ndarray]:
        """(searched word, indexed word) by number: exactly one error, in the first half (side 0) or the second (side 1)."""
        pairs = [np.zeros(0, np.int64)]
        for start in range(0, len(words), BATCH):
            halves = []
            for word in words[start : start + BATCH]:
                codes, middle = self.coded(word), len(word) // 2
                outward = (codes[:middle][::-1], codes[middle:])
                halves.append((outward[1 - side], outward[side]))
            row, owner = self.search(side, *_padded(halves))
            pairs.append((row + start) * len(self.words) + owner)
        # one error may be seen at several places ("aab" without one "a")
        pair = np.unique(np.concatenate(pairs))
        return pair // len(self.words), pair % len(self.words)


def _there(row: np.ndarray, match: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The states that match something."""
    some = match[:, 2] > 0
    return row[some], match[some]


def _padded(halves: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The exact and the other halves as arrays, and the sizes of both."""
    arrays, sizes = [], []
    for k in (0, 1):
        size = np.array([len(half[k]) for half in halves], np.int64)
        array = np.full((len(halves), int(size.max(initial=0))), -1, np.int64)
        for row, half in enumerate(halves):
            array[row, : len(half[k])] = half[k]
        arrays.append(array)
        sizes.append(size)
    return arrays[0], arrays[1], sizes[0], sizes[1]


def _dealt(vocabulary: DataFrame, block: int) -> DataFrame:
    """place, key, part, side, asks, word, n: each word by its halves, as a searching and as an indexed one."""
    size = F.char_length("word")

    def role(side: int, half, asks: bool):
        end = F.left(F.col("word"), half) if side else F.right(F.col("word"), half)
        return F.struct(F.xxhash64(F.lit(side), half, end).alias("key"), F.lit(side).alias("side"), F.lit(asks).alias("asks"))

    roles = []
    for side in (0, 1):
        half = F.floor(size / 2).cast("int")
        exact = half if side else (size - half).cast("int")  # the exact half: the second of a word for side 0
        roles.append(role(side, exact, True))
        # searching words are a code point shorter or longer, or as long
        for change in (-1, 0, 1):
            other = size + change
            first = F.floor(other / 2).cast("int")
            roles.append(role(side, first if side else (other - first).cast("int"), False))
    rows = vocabulary.select("word", "n", F.explode(F.array_distinct(F.array(*roles))).alias("r")).select("word", "n", "r.*")
    rows = durable(rows)
    indexed = rows.where(~F.col("asks"))
    blocks = max(1, -(-indexed.count() // block))
    hot = compact(
        indexed.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > block).select("key", F.ceil(F.col("k") / block).cast("int").alias("parts"))
    )
    whole = rows.withColumn("parts", F.lit(1)) if hot.isEmpty() else rows.join(hot, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")))
    dealt = whole.withColumn("part", F.explode(part))
    # a cut half has places of its own
    place = F.when(F.col("parts") > 1, F.xxhash64("key", "part")).otherwise(F.pmod(F.col("key"), F.lit(blocks)))
    # few bytes but much work: a number of tasks by blocks, not by size
    tasks = max(1, blocks // BLOCKS_PER_TASK)
    rows = dealt.select(place.alias("place"), "side", "asks", "word", "n")
    return rows.repartition(tasks, "place", "side").sortWithinPartitions("place", "side", "asks")


def near_pairs(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n, near, near_n of every ordered pair of near words; a pair may come twice."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, index, indexed, asking = None, None, {}, []

        def found() -> pa.RecordBatch:
            row, owner = index.near([word for word, _ in asking], current[1])
            words = list(indexed)
            pairs = [(*asking[r], words[o], indexed[words[o]]) for r, o in zip(row.tolist(), owner.tolist())]
            columns = list(zip(*pairs)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n", "near", "near_n"])

        for batch in batches:
            for place, side, asks, word, n in zip(*(batch.column(c).to_pylist() for c in ("place", "side", "asks", "word", "n"))):
                if (place, side) != current:
                    if index and asking:
                        yield found()
                    current, index, indexed, asking = (place, side), None, {}, []
                if not asks:  # indexed words come first
                    indexed[word] = n
                    continue
                if indexed:
                    index = index or VocabularyIndex(list(indexed))
                    asking.append((word, n))
                    if len(asking) == BATCH:
                        yield found()
                        asking = []
        if index and asking:
            yield found()

    return _dealt(vocabulary, block).mapInArrow(rows, "word string, n long, near string, near_n long")


def variant_groups(vocabulary: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of a vocabulary (word, n)."""
    words = durable(vocabulary.select("word", "n"))
    pairs = near_pairs(words, block).dropDuplicates(["word", "near"])
    # as a struct, the smallest of (-n, word) is the word with most occurrences
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("word")))
    per = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(per, "word", "left")
    strong = -F.col("best.minus") >= ratio * F.col("n")
    known = durable(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best.word")).alias("form"),
            F.when(strong, -F.col("best.minus")).alias("form_n"),
        )
    )
    # each round follows the forms twice as far; n grows by the ratio with each form, so paths are short
    up = compact(known.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = compact(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        up = ahead.select("word", "root")
        if ahead.where("moved").isEmpty():
            break
    return known.join(up, "word", "left").withColumn("root", F.coalesce("root", "word"))
