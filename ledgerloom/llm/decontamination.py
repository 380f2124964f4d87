"""Benchmark decontamination: BM25 over test items with block-max pruning, then overlap checks.

The test items are the indexed collection; document frequencies, number and mean length are those of all items.
Items are taken in bands by length: those of more than half of ``span`` and up to ``span`` words, ``span`` a power of two. Every
training text is cut for each band into passages of ``2 * span`` words, half overlapping, so that each copy of an item lies
whole in some passage. Every passage is a query (its distinct words); all items whose BM25 score reaches ``THRESHOLD`` of the
item's score against itself are retrieved. So what is found for an item depends on the item, the text and the statistics
of the whole benchmark, not on what else an index holds.

Postings are sorted by item and divided into blocks of neighbouring items, at the same places for all
words; a word has its largest share of a score in each block. WAND's pivot test, made for all blocks
at once: the sum of a passage's block maxima bounds the score of every item in the block, and only
blocks whose bound reaches the threshold are opened. (Cursors that walk to a pivot document leave out the same blocks, one
posting list at a time; a passage has some hundred words of few postings each, so sums over arrays visit them sooner than a
loop in Python would.) The most frequent words of an item, as far as they
make up ``STATIC`` of the threshold, are not looked up for that test; the bound takes them as present.
Opened blocks are scored with all their postings, so nothing above the threshold is lost.

A retrieved item is verified against the passage on five-word shingles: it counts if the passage
holds at least 0.8 of the item's shingles, or of those of its question and those of its answer each (the
answer is the last sentence; shorter parts are one shingle).

Scale: items are dealt into shards of one band and about ``SHARD_CHARS`` characters each, by a hash of the item. Tasks count
words and build each shard's index. The driver hands indexes on to the tasks, some ``PASS_BYTES`` at a time (at least one); texts are read
once for so many, which is once in all for a benchmark of some ten thousand items. Documents are never shuffled.

Null or empty texts match nothing; null or empty items can't be matched. Equal rows of the benchmark are one item; items
with other ids and equal texts are all reported. Repeated documents get equal results. Without items nothing matches.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ledgerloom.session import durable

THRESHOLD = 0.5
OVERLAP = 0.8
SHINGLE = 5
K1, B = 1.2, 0.75
SHARD_CHARS = 4_000_000
PASS_BYTES = 64_000_000
MOST_BLOCKS = 128
LEAST_BLOCK = 2
#: share of the threshold that frequent words may make up without being looked up
STATIC = 0.6

_SPACED = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")
MATCHES = "array<struct<item_id: bigint, score: double, overlap: double, question_overlap: double, answer_overlap: double>>"
_MATCH_TYPE = pa.list_(
    pa.struct([("item_id", pa.int64())] + [(n, pa.float64()) for n in ("score", "overlap", "question_overlap", "answer_overlap")])
)


def words_of(text: str) -> list[bytes]:
    """Lower-case runs of letters and digits."""
    return text.lower().encode("utf-8", "replace").translate(_SPACED).split()


def question_and_answer(text: str) -> tuple[str, str]:
    """All but the last sentence, and the last; a single sentence is a question without answer."""
    parts = [p for p in _SENTENCE.split(text) if words_of(p)]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def shingles(words: Sequence) -> set[tuple]:
    if not words:
        return set()
    if len(words) <= SHINGLE:
        return {tuple(words)}
    return {tuple(words[k : k + SHINGLE]) for k in range(len(words) - SHINGLE + 1)}


def held(part: list, passage: list) -> float:
    """The share of a part's shingles that occur in the passage."""
    wanted = shingles(part)
    if not wanted:
        return 1.0
    length = min(SHINGLE, len(part))
    there = {tuple(passage[k : k + length]) for k in range(len(passage) - length + 1)}
    return len(wanted & there) / len(wanted)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


@dataclass(frozen=True)
class Statistics:
    """Of a whole benchmark: items, their mean length, and how many of them hold each word (of some at least)."""

    number: int
    mean: float
    found: Mapping[bytes, int]


def statistics_of(items: Sequence[tuple[int, str]]) -> Statistics:
    bags = [words_of(text) for _, text in items if text]
    lengths = [len(bag) for bag in bags if bag]
    found = Counter(word for bag in bags for word in set(bag))
    return Statistics(len(lengths), sum(lengths) / max(len(lengths), 1), found)


def band_of(length: int) -> int:
    """The smallest power of two that isn't under the length, as its exponent."""
    return max(length - 1, 0).bit_length()


class ItemIndex:
    """Inverted index of test items: postings by word and block, with block maxima.

    ``statistics`` are those of the whole benchmark, ``band`` is that of the items (default: of these items).
    """

    def __init__(
        self,
        items: Sequence[tuple[int, str]],
        threshold: float = THRESHOLD,
        statistics: Statistics | None = None,
        band: int | None = None,
    ):
        self.threshold = threshold
        statistics = statistics or statistics_of(items)
        self.items = [(key, text) for key, text in items if text and words_of(text)]
        bags = [Counter(words_of(text)) for _, text in self.items]
        number = len(bags)
        self.vocabulary: dict[bytes, int] = {}
        for bag in bags:
            for word in bag:
                self.vocabulary.setdefault(word, len(self.vocabulary))
        lengths = np.array([sum(bag.values()) for bag in bags], float)
        # passages are twice as long
        self.span = 1 << (band_of(int(lengths.max(initial=1))) if band is None else band)
        terms, owners, counts = [], [], []
        for k, bag in enumerate(bags):
            terms.extend(self.vocabulary[w] for w in bag)
            owners.extend([k] * len(bag))
            counts.extend(bag.values())
        terms, owners, counts = np.array(terms, np.int64), np.array(owners, np.int64), np.array(counts, float)
        found = np.array([statistics.found[w] for w in self.vocabulary], np.int64)
        weight = np.log1p((statistics.number - found + 0.5) / (found + 0.5))
        norm = K1 * (1 - B + B * lengths / max(statistics.mean, 1e-9)) if number else lengths
        impact = weight[terms] * counts * (K1 + 1) / (counts + norm[owners]) if number else counts
        own = np.bincount(owners, impact, number)  # an item's score against itself
        self.block = max(LEAST_BLOCK, -(-number // MOST_BLOCKS))
        self.blocks = max(1, -(-number // self.block))
        order = np.lexsort((owners, terms))
        self.owners = owners[order].astype(np.int32)
        self.impacts = (impact / own[owners])[order] if number else impact
        cell = terms[order] * self.blocks + self.owners // self.block
        self.starts = np.searchsorted(cell, np.arange(len(self.vocabulary) * self.blocks + 1))
        # an item's words from the most frequent on; those that the bound takes as present come first
        frequent = np.lexsort((terms, -found[terms], owners))
        share = (impact / own[owners])[frequent] if number else impact
        begins = np.searchsorted(owners[frequent], np.arange(number))
        running = np.cumsum(share)
        running -= (running[begins] - share[begins])[owners[frequent]] if number else 0
        looked_up = running > STATIC * threshold
        static = np.bincount(owners[frequent][~looked_up], share[~looked_up], number)
        self.static = np.zeros(self.blocks)
        np.maximum.at(self.static, np.arange(number) // self.block, static)
        cells, place = np.unique((terms * self.blocks + owners // self.block)[frequent][looked_up], return_inverse=True)
        self.maxima = np.zeros(len(cells))
        np.maximum.at(self.maxima, place, share[looked_up])
        self.cell_blocks = cells % self.blocks
        self.cell_starts = np.searchsorted(cells // self.blocks, np.arange(len(self.vocabulary) + 1))
        self.words = [[self.vocabulary[w] for w in words_of(text)] for _, text in self.items]
        parts = [question_and_answer(text) for _, text in self.items]
        self.parts = [[[self.vocabulary[w] for w in words_of(p)] for p in pair] for pair in parts]

    def dumps(self) -> bytes:
        return pickle.dumps(vars(self), protocol=5)

    @classmethod
    def loads(cls, content: bytes) -> ItemIndex:
        index = cls.__new__(cls)
        vars(index).update(pickle.loads(content))
        return index

    def retrieve(self, ids: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(passage, item, score) of all items that reach the threshold; passage p is the segments p and p + 1."""
        known = np.flatnonzero(ids >= 0)
        if not len(known) or not self.items:
            return
        size = len(self.vocabulary)
        pairs = np.unique(known // self.span * size + ids[known])  # distinct words of each segment
        segment, word = pairs // size, pairs % size
        number = int(-(-len(ids) // self.span))
        length = self.cell_starts[word + 1] - self.cell_starts[word]
        at = _ranges(self.cell_starts[word], length)
        cells = np.repeat(segment, length) * self.blocks + self.cell_blocks[at]
        bound = np.bincount(cells, self.maxima[at], (number + 1) * self.blocks).reshape(-1, self.blocks)
        bound = bound[:-1] + bound[1:] + self.static
        for passage, block in np.argwhere(bound >= self.threshold - 1e-9):
            low, high = np.searchsorted(segment, (passage, passage + 2))
            query = np.unique(word[low:high])
            begin = self.starts[query * self.blocks + block]
            at = _ranges(begin, self.starts[query * self.blocks + block + 1] - begin)
            scores = np.bincount(self.owners[at] - block * self.block, self.impacts[at], self.block)
            for k in np.flatnonzero(scores >= self.threshold - 1e-9):
                yield int(passage), int(block * self.block + k), float(scores[k])

    def verified(self, ids: np.ndarray, overlap: float = OVERLAP) -> list[dict]:
        """The verified items of a text, given by the numbers of its words, each with its best passage."""
        best: dict[int, dict] = {}
        for passage, item, score in self.retrieve(ids):
            words = ids[passage * self.span : (passage + 2) * self.span].tolist()
            whole = held(self.words[item], words)
            question, answer = (held(part, words) for part in self.parts[item])
            if whole >= overlap or (question >= overlap and answer >= overlap):
                match = {"item_id": self.items[item][0], "score": score, "overlap": whole, "question_overlap": question, "answer_overlap": answer}
                if item not in best or (match["overlap"], score) > (best[item]["overlap"], best[item]["score"]):
                    best[item] = match
        return [best[k] for k in sorted(best)]


class Matcher:
    """Several indexes that are asked together: a text's words are looked up once."""

    def __init__(self, indexes: Sequence[ItemIndex]):
        self.indexes = indexes
        self.vocabulary: dict[bytes, int] = {}
        for index in indexes:
            for word in index.vocabulary:
                self.vocabulary.setdefault(word, len(self.vocabulary))
        self.own = np.full((len(indexes), len(self.vocabulary) + 1), -1, np.int64)  # the last one is of unknown words
        for k, index in enumerate(indexes):
            for word, number in index.vocabulary.items():
                self.own[k, self.vocabulary[word]] = number

    def matches(self, text: str, overlap: float = OVERLAP) -> list[dict]:
        """The verified items of a text."""
        found = words_of(text)
        words = np.fromiter(map(self.vocabulary.get, found, repeat(-1)), np.int64, len(found))
        return [match for own, index in zip(self.own, self.indexes) for match in index.verified(own[words], overlap)]


def matcher_of(items: Sequence[tuple[int, str]], threshold: float = THRESHOLD) -> Matcher:
    """All items by band, without Spark."""
    statistics, bands = statistics_of(items), {}
    for key, text in items:
        if text and words_of(text):
            bands.setdefault(band_of(len(words_of(text))), []).append((key, text))
    return Matcher([ItemIndex(part, threshold, statistics, band) for band, part in sorted(bands.items())])


_ITEMS = "item_id long, text string, band int, n_words long, words array<binary>"
_INDEXES = "shard long, n_bytes long, content binary"


def _counted_items(benchmark: DataFrame) -> DataFrame:
    """The distinct items with words: their band, length and distinct words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, bands, lengths, words = [], [], [], []
            for k, text in enumerate(batch.column("text")):
                found = words_of(text.as_py())
                if found:
                    kept.append(k)
                    bands.append(band_of(len(found)))
                    lengths.append(len(found))
                    words.append(sorted(set(found)))
            some = batch.take(pa.array(kept, pa.int64()))
            columns = [pa.array(bands, pa.int32()), pa.array(lengths, pa.int64()), pa.array(words, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays([*some.columns, *columns], names=["item_id", "text", "band", "n_words", "words"])

    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text").distinct()
    return items.mapInArrow(rows, _ITEMS)


def item_indexes(benchmark: DataFrame, threshold: float = THRESHOLD, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """shard, n_bytes, content: the pickled index of each shard of the items, built in the tasks."""
    items = durable(_counted_items(benchmark))
    whole = items.agg(F.count(F.lit(1)).alias("n"), F.avg("n_words").alias("mean")).first()
    chars = {r.band: r.chars for r in items.groupBy("band").agg(F.sum(F.char_length("text")).alias("chars")).collect()}  # a row a band
    parts = F.lit(1)
    for band, size in chars.items():
        parts = F.when(F.col("band") == band, -(-size // shard_chars)).otherwise(parts)
    part = F.pmod(F.xxhash64("item_id", "text"), parts.cast("long"))
    dealt = items.withColumn("shard", F.shiftleft(F.col("band").cast("long"), 32) + part)
    found = items.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("found"))
    of_shard = dealt.select("shard", F.explode("words").alias("word")).distinct().join(found, "word")
    no_word, no_text = F.lit(None).cast("binary"), F.lit(None).cast("string")
    rows = of_shard.select("shard", "word", "found", F.lit(None).cast("long").alias("item_id"), no_text.alias("text")).unionByName(
        dealt.select("shard", no_word.alias("word"), F.lit(None).cast("long").alias("found"), "item_id", "text")
    )
    number, mean = whole.n, whole["mean"] or 0.0

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, words, own = None, {}, []

        def built() -> pa.RecordBatch:
            index = ItemIndex(own, threshold, Statistics(number, mean, words), shard >> 32)
            content = index.dumps()
            columns = [pa.array([shard], pa.int64()), pa.array([len(content)], pa.int64()), pa.array([content], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "n_bytes", "content"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    if shard is not None:
                        yield built()
                    shard, words, own = row["shard"], {}, []
                if row["word"] is not None:
                    words[row["word"]] = row["found"]
                else:
                    own.append((row["item_id"], row["text"]))
        if shard is not None:
            yield built()

    together = rows.repartition("shard").sortWithinPartitions("shard", "item_id", "text", "word")
    return durable(together.mapInArrow(build, _INDEXES))


def matchers(benchmark: DataFrame, threshold: float = THRESHOLD, shard_chars: int = SHARD_CHARS, pass_bytes: int = PASS_BYTES) -> Iterator[Broadcast]:
    """For every pass over the texts the pickled indexes it asks."""
    spark = benchmark.sparkSession
    indexes = item_indexes(benchmark, threshold, shard_chars)
    listed = sorted((r.shard, r.n_bytes) for r in indexes.select("shard", "n_bytes").collect())  # a row a shard
    while listed:
        some, size = [], 0
        while listed and (not some or size + listed[0][1] <= pass_bytes):
            shard, own = listed.pop(0)
            some.append(shard)
            size += own
        contents = [r.content for r in indexes.where(F.col("shard").isin(some)).orderBy("shard").select("content").collect()]
        yield spark.sparkContext.broadcast(contents)


def matches_column(contents: Broadcast, text: Column, overlap: float = OVERLAP) -> Column:
    """The verified items of a text, by the indexes of one pass."""

    @arrow_udf(MATCHES)
    def item_matches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = None
        for batch in batches:
            matcher = matcher or Matcher([ItemIndex.loads(content) for content in contents.value])
            yield pa.array([matcher.matches(t.as_py() or "", overlap) for t in batch], _MATCH_TYPE)

    return item_matches(text)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    shard_chars: int = SHARD_CHARS,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap, answer_overlap of every verified pair."""
    found = None
    for contents in matchers(benchmark, threshold, shard_chars, pass_bytes):
        part = docs.select("doc_id", F.explode(matches_column(contents, F.col("text"), overlap)).alias("m"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        empty = F.explode(F.lit(None).cast(MATCHES)).alias("m")
        found = docs.select("doc_id", empty)
    return found.select("doc_id", "m.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no test item."""
    for contents in matchers(benchmark):
        docs = docs.where(F.size(matches_column(contents, F.col("text"))) == 0)
    return docs
