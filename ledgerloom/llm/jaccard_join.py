"""N-gram Jaccard join by universe partition and pigeonhole, verified exactly.

A document's set is its distinct word shingles (64-bit hashes). Sets of similar size form bands; the sets of a
band cut the universe of shingles into the same segments by hash. Two sets of the band with
Jaccard similarity ``num/den`` or more differ in at most H shingles, so with more than H segments
one segment at least is equal in both. Each set is indexed by a hash of each segment's subset. A segment
may be indexed with its one-deletion neighbourhood instead (the subset and the subset without each one
of its shingles): then sets that differ in one shingle there still meet, and the segment counts twice.
A set indexes only as many segments, from the first on, as its own size and that of its largest
possible partner in the band require; partners of either size then have enough in common.

:func:`allocation` picks, for each band, how many segments get neighbourhoods and how many spare segments
there are, by the cost of signatures and of the chance meetings that it expects among as many sets as
the corpus has. With s spare segments a set with at most s empty segments leaves those out: of the
segments in which two linked sets agree, more than s, one is not empty. (A set with more empty segments
indexes all, so two such sets meet as well.)

Copies are joined first: equal sets form a class, and its smallest document stands for it. With s spare segments two
linked sets have more than s equal ones, so each looks up all but s of its signatures, and leaves out those that
most sets have: the ones of common passages and of empty segments. Classes that
share a signature they look up are candidates; connected candidates form a family, and each size class of a family with the
next larger one a unit. Units are worked off in blocks of bounded size: small ones whole, in large ones every
member against pivots of the unit and then, block by block, what is not linked yet against
everything. In a block, sets that share a signature are compared. Two documents link when
``den * intersection >= num * union`` of the exact sets. A chain of links is enough to know a
component, so no group ever emits all its pairs.

Scale: one pass of Python over the text; then signatures (about a tenth of the shingles), counted before
the shuffle; only members of families are read again. A component's rows never meet in one task: blocks hold
at most ``BLOCK`` members, more of short sets, and as many others. Chance meetings make families of short sets that aren't linked, so
what moves there, each block's members once for each other block, is the less the larger the blocks. Intermediate results are in the shared folder.

Null, empty and blank texts have no set and link with nothing. Fewer words than a shingle count as
one shingle. Rows with the same id are one node of the graph (their links unite). Rows without id get
no component. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_of
from ledgerloom.llm.components import compact, connected_components
from ledgerloom.session import durable

BLOCK = 256
#: a block of short sets has more members, up to so many shingles and ``SHORT`` times as many members
BLOCK_SHINGLES = 1 << 17
SHORT = 16
PIVOTS = 16
SMALL = 256
BAND_RATIO = 1.5
#: cost of comparing two sets, in units of one signature
COMPARE = 4.0
#: so many pairs may be compared at once instead of another round of pivots
FINAL_PAIRS = 20_000_000
#: a list of at most so many ids is sent to all executors; then no texts move. Longer lists are joined by shuffle.
SENT_IDS = 2_000_000
#: how frequent signatures are is sent as levels of so many buckets a signature, in blocks of ``WORDS * PLACES`` buckets (half a
#: KB), ``BLOCKS`` at most (some 36 MB); then signatures don't move. With fewer than ``LEAST_BUCKETS`` a signature too many of one
#: set share a bucket with them; then a bit says whether a bucket has any, which needs a quarter of the room, and those that
#: pass are joined with the counts.
BUCKETS = 16
LEAST_BUCKETS = 16
WORDS = 64
PLACES = 16
BITS = 64
BLOCKS = 1 << 16
_SEED = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input changes half of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    length = min(size, len(words))
    total = np.full(len(words) - length + 1, np.uint64(length))
    for k in range(length):
        total = mix(total + hashes[k : len(hashes) - length + 1 + k] * _SEED)
    return np.unique(total)


def most_difference(total: int, num: int, den: int) -> int:
    """The largest symmetric difference of two linked sets with together ``total`` elements."""
    return (den - num) * total // (den + num)


def bands(upto: int) -> list[int]:
    """The smallest size of each band, up to the band of size ``upto``."""
    starts = [1]
    while starts[-1] <= upto:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND_RATIO)))
    return starts


def allocation(low: int, high: int, sets: int, num: int, den: int) -> tuple[int, int, int]:
    """(segments, segments with neighbourhoods, spare segments) of a band of sizes low..high."""
    need = most_difference(2 * high, num, den) + 1
    best = None
    spares = {0, 1, 2, 4, 8} | {need * k // 24 for k in range(1, 13)}
    for deletions, spare in [(0, s) for s in sorted(spares)] + [(need // 2, 0), ((need + 1) // 2, 0)]:
        segments = max(deletions, need - deletions) + spare  # 2 * deletions + the others >= need + spare
        share = min(low / segments, 60.0)  # shingles of a small set in a segment
        signatures = segments + deletions * high / segments
        empty = math.exp(-share)
        # two sets meet by chance where both are empty, with neighbourhoods also where both hold one shingle
        meet = segments * empty**2 * ((1 + share) ** 2 if deletions else 1.0)
        if spare:  # both must have more empty segments than the spare ones
            meet *= _more_than(spare, segments * empty)
        cost = signatures + COMPARE * sets * meet
        if best is None or cost < best[0]:
            best = (cost, segments, deletions, spare)
    return best[1:]


def _more_than(number: int, mean: float) -> float:
    """Chance that a Poisson variable exceeds ``number``."""
    term = total = math.exp(-mean)
    for k in range(1, number + 1):
        term *= mean / k
        total += term
    return max(0.0, 1.0 - total)


class Signer:
    """Signatures of sets, for a corpus of so many sets."""

    def __init__(self, sets: int, num: int, den: int):
        self.sets, self.num, self.den = sets, num, den
        self.starts = bands(1 << 20)
        self.allocate = lru_cache(None)(self._allocate)

    def _band(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts = bands(2 * size)
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def _allocate(self, band: int) -> tuple[int, int, int]:
        low, high = self.starts[band], self.starts[band + 1] - 1
        return allocation(low, high, max(1, self.sets // 10), self.num, self.den)

    def signatures(self, values: np.ndarray) -> np.ndarray:
        """Of the set's own band, and of larger bands in which it may have partners; one of two linked sets' is equal."""
        return np.concatenate([self._compared(*parts) for parts in self._by_band(values)])

    def indexed(self, values: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """By band: all signatures, and how many of the rarest have to be looked up.

        Of the segments that two linked sets look at, more than the spare ones are equal. So if each set leaves out as many of its
        signatures as there are spare segments, the same most frequent ones first, one equal pair is left.
        """
        found = []
        for whole, _, near, spare in self._by_band(values):
            own = np.concatenate([whole, near])
            found.append((own, len(own) - spare if not len(near) else len(own)))
        return found

    @staticmethod
    def _compared(whole: np.ndarray, filled: np.ndarray, near: np.ndarray, spare: int) -> np.ndarray:
        if (~filled).sum() <= spare:
            whole = whole[filled]
        return np.concatenate([whole, near])

    def _by_band(self, values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        size = len(values)
        partner = size * self.den // self.num
        own, last = self._band(size), self._band(partner)
        return [self._of_band(values, band, min(partner, self.starts[band + 1] - 1)) for band in range(own, last + 1)]

    def _of_band(self, values: np.ndarray, band: int, partner: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """A signature of each segment looked at, whether it holds a shingle, those of the neighbourhoods, spare segments."""
        segments, deletions, spare = self.allocate(band)
        # so many segments have to be in the index of both; those with neighbourhoods, the first ones, count twice
        need = most_difference(len(values) + partner, self.num, self.den) + 1 + spare
        used = -(-need // 2) if need <= 2 * deletions else need - deletions
        place = (mix(values + np.uint64(band + 1)) >> np.uint64(32)) % np.uint64(segments)
        order = np.argsort(place, kind="stable")
        place, parts = place[order], mix(values[order] ^ _SEED)
        sums = np.zeros(segments, np.uint64)
        if len(place):
            first = np.flatnonzero(np.diff(place, prepend=np.uint64(segments)))
            sums[place[first]] = np.add.reduceat(parts, first)
        tags = mix(np.arange(segments, dtype=np.uint64) + np.uint64((band + 1) << 32))
        filled = np.zeros(segments, bool)
        filled[place] = True
        whole = mix(sums + tags)[:used]
        if not deletions:
            return whole, filled[:used], whole[:0], spare
        near = place < min(deletions, used)
        return whole, filled[:used], mix(sums[place[near]] - parts[near] + tags[place[near]]), spare


@dataclass(frozen=True)
class Join:
    """The parameters: shingles of ``size`` words, similarity ``num/den``, in a corpus of ``corpus`` documents."""

    size: int
    num: int
    den: int
    corpus: int

    def signer(self) -> Signer:
        return Signer(self.corpus, self.num, self.den)


def document_sets(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, n, f1, f2 (a 128-bit fingerprint of the set); by band sigs, and the number of them to be looked up; a number of the row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = join.signer()
        for batch in batches:
            sizes, prints, sigs, wanted, ends, bands_ = [], [], [], [], [0], [0]
            for text in batch.column("text"):
                values = shingle_set(text.as_py() or "", join.size)
                sizes.append(len(values))
                prints.append((np.sum(mix(values ^ _SEED)), np.sum(mix(values + _SEED))))
                for own, number in signer.indexed(values) if len(values) else ():
                    sigs.append(own)
                    wanted.append(number)
                    ends.append(ends[-1] + len(own))
                bands_.append(len(wanted))
            flat = np.concatenate(sigs or [np.zeros(0, np.uint64)]).view(np.int64)
            pair = np.array(prints, np.uint64).reshape(-1, 2).view(np.int64)
            by_band = pa.StructArray.from_arrays(
                [pa.array(wanted, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["wanted", "sigs"]
            )
            lists = pa.ListArray.from_arrays(pa.array(bands_, pa.int32()), by_band)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy()), lists],
                names=["doc_id", "n", "f1", "f2", "bands"],
            )

    found = docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(
        rows, "doc_id long, n long, f1 long, f2 long, bands array<struct<wanted: int, sigs: array<long>>>"
    )
    return found.withColumn("row", F.monotonically_increasing_id())


class _Union:
    """Which members of a block are connected already."""

    def __init__(self, labels: Sequence[int]):
        self.up = {label: label for label in labels}

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


Set = tuple[int, int, np.ndarray, np.ndarray]  # id, component, sorted hashes, signatures


def block_links(asks: list[Set], members: list[Set], num: int, den: int) -> list[tuple[int, int]]:
    """Links (id, id) between asking sets and members that connect different components.

    Only sets with a signature in common are compared. Pairs that other links of the block connect are
    left out.
    """
    links: list[tuple[int, int]] = []
    holders: dict[int, list[int]] = {}
    for k, (_, _, _, signatures) in enumerate(members):
        for signature in signatures.tolist():
            holders.setdefault(signature, []).append(k)
    joined = _Union([c for _, c, _, _ in asks] + [c for _, c, _, _ in members])
    for key, component, values, signatures in asks:
        near = {k for signature in signatures.tolist() for k in holders.get(signature, ())}
        for k in sorted(near):
            other, own, theirs, _ = members[k]
            if joined.find(own) == joined.find(component):
                continue
            low, high = sorted((len(values), len(theirs)))
            if den * low < num * high:
                continue
            at = np.minimum(np.searchsorted(values, theirs), len(values) - 1)
            common = int((values[at] == theirs).sum())
            if den * common >= num * (low + high - common):
                joined.join(component, own)
                links.append((min(key, other), max(key, other)))
    return links


def _verified(blocks: DataFrame, join: Join) -> DataFrame:
    """Links (a, b) within each block; rows: block columns, rep, component, asks, member, vals."""
    keys = ["unit", "block", "part"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, asks, members, signer = None, [], [], join.signer()

        def found() -> pa.RecordBatch:
            pair = np.array(block_links(asks, members, join.num, join.den), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in (*keys, "rep", "component", "asks", "member")]
            for *key, rep, component, asking, member, k in zip(*columns, range(batch.num_rows)):
                if key != current:
                    if current is not None:
                        yield found()
                    current, asks, members = key, [], []
                values = batch.column("vals")[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                signatures = signer.signatures(values)
                if asking:
                    asks.append((rep, component, values, signatures))
                if member:
                    members.append((rep, component, values, signatures))
        if current is not None:
            yield found()

    columns = [*keys, "rep", "component", "asks", "member", "vals"]
    dealt = blocks.select(*columns).repartition(*keys).sortWithinPartitions(*keys, "rep")
    return dealt.mapInArrow(rows, "a long, b long")


def _sent(df: DataFrame, most: int) -> DataFrame:
    """``df`` written once, and broadcast if it has at most ``most`` rows; a longer one is joined by shuffle."""
    done = compact(df)
    return F.broadcast(done) if done.count() <= most else done


def _sets_of(documents: DataFrame, units: DataFrame, join: Join) -> DataFrame:
    """The sets of the documents in ``units`` (rep, unit, k, blocks), each its own component for now."""
    names = ["rep", "unit", "k", "blocks"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py() or "", join.size).view(np.int64) for t in batch.column("text")]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sets, pa.list_(pa.int64()))], names=[*names, "vals"])

    chosen = documents.select(F.col("doc_id").cast("long").alias("rep"), "text").join(units, "rep")
    schema = "rep long, unit long, k long, blocks long, vals array<long>"
    return chosen.select(*names, "text").mapInArrow(rows, schema).withColumn("component", F.col("rep"))


def _hash_part(column: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(column), parts).cast("int")


def _family_links(documents: DataFrame, sizes: DataFrame, candidates: DataFrame, join: Join) -> DataFrame:
    """Verified links (a, b), enough to connect what links connect.

    ``sizes``: rep and n of each class; ``candidates``: pairs (a, b) that connect all that share a signature.
    """
    families = connected_components(candidates).select(F.col("node").alias("rep"), F.col("component").alias("family"))
    # the larger of two linked sets is in the size class of the smaller one or in the next
    width = math.log(join.den / join.num) * (1 + 1e-9) if join.den > join.num else 1.0
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("int")
    own = families.join(sizes, "rep").withColumn("step", step)
    # a unit is a size class of a family together with the next larger one
    named = own.withColumn("class", F.explode(F.array("step", F.col("step") - 1)))
    named = named.select("rep", F.xxhash64("family", "class").alias("unit"), (F.col("class") == F.col("step")).alias("lower"), "n").distinct()
    counts = named.groupBy("unit").agg(F.count(F.lit(1)).alias("k"), F.count_if("lower").alias("low"), F.max("n").alias("n"))
    counts = counts.where((F.col("low") > 0) & (F.col("k") > 1)).select("unit", "k", _blocks_of("k", "n").alias("blocks"))
    units = compact(named.join(counts, "unit").select("rep", "unit", "k", "blocks"))
    yes = F.lit(True)
    small = _sets_of(documents, _sent(units.where(F.col("k") <= SMALL), SENT_IDS), join)
    links = _verified(small.withColumns({"block": F.lit(0), "part": F.lit(0), "asks": yes, "member": yes}), join)
    large_units = units.where(F.col("k") > SMALL)
    if large_units.isEmpty():
        return links
    large = durable(_sets_of(documents, _sent(large_units, SENT_IDS), join)).withColumn("part", F.lit(0))
    return links.unionByName(_large_links(large, large_units, join))


def _blocks_of(members: str, most: str) -> Column:
    """Into so many blocks a unit is cut, by its members and the size of its largest set."""
    of_short = F.floor(F.lit(BLOCK_SHINGLES) / F.col(most))
    return F.ceil(F.col(members) / F.greatest(F.lit(BLOCK), F.least(F.lit(BLOCK * SHORT), of_short))).cast("long")


def _large_links(large: DataFrame, large_units: DataFrame, join: Join) -> DataFrame:
    """Verified links in units of more than one block."""
    yes, no = F.lit(True), F.lit(False)
    links = compact(_verified(_against_pivots(large, large, large_units, 0), join))
    seed, work_before = 1, None
    while True:
        labels = connected_components(links).withColumnRenamed("node", "rep")
        now = compact(large_units.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
        parts = now.groupBy("unit", "component").agg(F.count(F.lit(1)).alias("n"))
        main = parts.groupBy("unit").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"))
        main = main.select("unit", F.col("main.component").alias("main"), (F.col("all") - F.col("main.n")).alias("rest"))
        open_ = now.join(main.where(F.col("rest") > 0), "unit")
        work = open_.agg(F.sum("rest").alias("w")).first().w or 0  # pairs left, whether or not they share a signature
        if not work:
            return links
        labelled = large.drop("component").join(open_.select("rep", "unit", "component", "main", "rest"), ["rep", "unit"])
        rest = labelled.where(F.col("component") != F.col("main"))
        if work <= FINAL_PAIRS or (work_before is not None and work > 0.8 * work_before):
            # everything that isn't in the main component against all members, block by block
            pieces = F.ceil(F.col("rest") * F.col("blocks") / F.col("k")).cast("long")  # as large as blocks
            asking = rest.withColumn("part", _hash_part("rep", pieces)).withColumn(
                "block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
            )
            asked = labelled.withColumn("block", _hash_part("rep", F.col("blocks"))).withColumn(
                "part", F.explode(F.sequence(F.lit(0), (pieces - 1).cast("int")))
            )
            crossing = asking.withColumns({"asks": yes, "member": no}).unionByName(asked.withColumns({"asks": no, "member": yes}))
            return links.unionByName(_verified(crossing, join))
        more = _verified(_against_pivots(labelled, rest, large_units, seed), join)
        links = compact(links.unionByName(more))
        seed, work_before = seed + 1, work


def _against_pivots(sets: DataFrame, members: DataFrame, units: DataFrame, seed: int) -> DataFrame:
    """Blocks in which some pivots of each unit, drawn by hash, ask the members."""
    draw = F.xxhash64(F.lit(seed), F.col("rep"))
    pivots = (
        units.groupBy("unit", F.pmod(draw, F.lit(PIVOTS)).alias("slot"))
        .agg(F.min_by("rep", draw).alias("rep"))
        .select("unit", "rep")
    )
    asking = sets.join(pivots, ["rep", "unit"], "left_semi").withColumn(
        "block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
    )
    asked = members.withColumn("block", _hash_part("rep", F.col("blocks")))
    return asking.withColumns({"asks": F.lit(True), "member": F.lit(False)}).unionByName(
        asked.withColumns({"asks": F.lit(False), "member": F.lit(True)})
    )


def _place(blocks: int, places: int) -> list[Column]:
    """Of a signature: the block of its bucket, the word there, the first of the bucket's bits there, of a word for ``places`` buckets."""
    sig, shift = F.col("sig"), (BLOCKS - 1).bit_length()
    word = F.shiftrightunsigned(sig, shift).bitwiseAND(F.lit(WORDS - 1)).cast("int")
    place = F.shiftrightunsigned(sig, shift + 6).bitwiseAND(F.lit(places - 1)).cast("int")
    return [sig.bitwiseAND(F.lit(blocks - 1)).alias("block"), word.alias("word"), (64 // places * place).alias("place")]


def _blocks(number: int, places: int) -> int:
    """So many blocks have ``BUCKETS`` buckets a signature, or as many as may be sent."""
    return min(BLOCKS, 1 << (number * BUCKETS // (WORDS * places)).bit_length())


def _levels(repeated: DataFrame, blocks: int) -> DataFrame:
    """block, words: for each bucket the binary logarithm of its most frequent signature's sets (15 at most), 0 if it has none."""
    level = F.least(F.floor(F.log2(F.col("sets").cast("double"))), F.lit(PLACES - 1)).cast("long").alias("level")
    most = repeated.select(*_place(blocks, PLACES), level).groupBy("block", "word", "place").agg(F.max("level").alias("value"))
    return _filled(most)


def _bits(repeated: DataFrame, blocks: int) -> DataFrame:
    """block, words: for each bucket a bit that says whether it has a signature."""
    return _filled(repeated.select(*_place(blocks, BITS), F.lit(1).cast("long").alias("value")))


def _filled(values: DataFrame) -> DataFrame:
    """block, words: the values (block, word, place, value), each at its place of its word."""
    words = values.groupBy("block", "word").agg(F.bit_or(F.expr("shiftleft(value, place)")).alias("filled"))
    by_word = F.map_from_entries(F.collect_list(F.struct("word", "filled")))
    filled = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.try_element_at(F.col("of"), w), F.lit(0).cast("long")))
    return words.groupBy("block").agg(by_word.alias("of")).select("block", filled.alias("words"))


def _shared(signed: DataFrame, repeated: DataFrame) -> DataFrame:
    """``signed`` with ``often``, a number by which signatures are ordered, without most of those that one set alone has.

    ``repeated``: the signatures of several sets, with their number of sets. A level is that of the bucket, so it is the same
    wherever the signature is; in a bucket without any of them all are of one set only. Of more signatures than there are
    levels for, those in a bucket with any are joined with the numbers themselves: however few buckets a signature are left,
    no more than all of them move, in rows of ``signed``.
    """
    number = repeated.count()
    if number * LEAST_BUCKETS > BLOCKS * WORDS * PLACES:
        places, sent = BITS, _bits
    else:
        places, sent = PLACES, _levels
    blocks = _blocks(number, places)
    placed = signed.select("*", *_place(blocks, places)).join(F.broadcast(sent(repeated, blocks)), "block")
    value = F.expr(f"shiftrightunsigned(get(words, word), place) & {(1 << 64 // places) - 1}")
    found = placed.withColumn("often", value).where("often > 0").select(*signed.columns, "often")
    return found if sent is _levels else found.drop("often").join(repeated.withColumnRenamed("sets", "often"), "sig")


def _candidates(reps: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect all classes which share one of the signatures they look up.

    Signatures are ordered by how many sets have them. Those of one set only come first and are counted, not kept, so a set with as
    many of them as it looks up has no candidates. What moves of a signature is the number of its row and its band besides itself.
    """
    by_band = reps.select("row", F.col("doc_id").alias("rep"), F.inline(F.transform("bands", lambda x, k: F.struct(x.alias("own"), k.alias("k")))))
    signed = by_band.select("row", "k", F.explode("own.sigs").alias("sig"))
    repeated = compact(signed.groupBy("sig").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"))
    shared = _shared(signed, repeated)
    per = shared.groupBy("row", "k").agg(F.sort_array(F.collect_list(F.struct("often", "sig"))).alias("shared"))
    left_out = by_band.select("row", "k", "rep", (F.col("own.wanted") - F.size("own.sigs")).alias("left_out"))
    left = F.size("shared") + F.col("left_out")  # of a set's signatures, those it shares come last
    kept = per.join(left_out, ["row", "k"]).where(left > 0).select("rep", F.explode(F.slice("shared", F.lit(1), left)).alias("s"))
    meeting = compact(kept.select("rep", F.col("s.sig").alias("sig")))
    lowest = meeting.groupBy("sig").agg(F.min("rep").alias("low"))
    pairs = meeting.join(lowest, "sig").where(F.col("rep") != F.col("low"))
    return pairs.select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()


def linked_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest id with an equal set), component_id of every document."""
    documents = docs.select("doc_id", "text")
    join = Join(size, num, den, max(1, docs.count()))
    sets = durable(document_sets(documents, join))
    full = sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = durable(full.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep")))
    # what doesn't stand for its class is left out by a list of it, which is shorter than what does
    narrow = full.select("doc_id", "f1", "f2", "n").join(classes, ["f1", "f2", "n"])
    copies = _sent(narrow.where(F.col("doc_id") != F.col("rep")).select("doc_id", "f1", "f2").distinct(), SENT_IDS)
    reps = full.join(copies, ["doc_id", "f1", "f2"], "left_anti")
    candidates = _candidates(reps)
    links = _family_links(documents, classes.select("rep", "n").distinct(), candidates, join)
    several = full.groupBy("doc_id").agg(F.min("f1").alias("low"), F.max("f1").alias("high")).where(F.col("low") < F.col("high"))
    several = compact(several.select("doc_id"))
    if not several.isEmpty():  # classes that share an id are one node
        of_several = full.join(several, "doc_id", "left_semi").join(classes, ["f1", "f2", "n"])
        links = links.unionByName(of_several.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    components = connected_components(links).withColumnRenamed("node", "rep")
    named = classes.join(components, "rep", "left").select(
        "f1", "f2", "n", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id")
    )
    known = F.col("doc_id").isNotNull()
    return sets.join(named, ["f1", "f2", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(known, F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents, all columns, one of each component: the one with the smallest id.

    Rows are told apart by id and text: rows with the same id and other texts are documents of their own, and only the row whose own
    text is a copy goes. Rows that are equal in id and text are one document; the one with the smallest hash of all columns
    stays. Documents without id are treated alike: they go if they are linked to one with an id or a smaller hash of their text.
    """
    own = F.xxhash64(F.lit("row"), "doc_id", text_of())
    known = F.col("doc_id").isNotNull()
    texts = docs.where(known).groupBy("doc_id").agg(F.min(own).alias("one"), F.max(own).alias("other"))
    several = compact(texts.where(F.col("one") < F.col("other")).select(F.col("doc_id").alias("_several")))
    several = F.broadcast(several) if several.count() <= SENT_IDS else several
    # an id with one text is its own key, so that the smallest key of a component is its smallest id
    alone = known & F.col("_several").isNull()
    row = F.struct(*docs.columns).alias("row")
    keyed = docs.join(several, F.col("doc_id") == F.col("_several"), "left").select(
        F.when(alone, F.col("doc_id").cast("long")).otherwise(own).alias("doc_id"), "text", F.col("doc_id").alias("_id"), row
    )
    found = durable(linked_components(keyed, size, num, den).select("doc_id", "component_id"))
    linked = found.where(F.col("doc_id") != F.col("component_id")).select("component_id").distinct()
    members = found.join(linked, "component_id", "left_semi").distinct()
    ids = keyed.where(~F.coalesce(F.col("_id").cast("long") == F.col("doc_id"), F.lit(False))).select("doc_id", F.col("_id").cast("long").alias("_id"))
    ids = _sent(ids.distinct(), SENT_IDS)  # of rows without id and of repeated ids
    named = members.join(ids.withColumn("_other", F.lit(True)), "doc_id", "left")
    rank = F.struct(
        F.when(F.col("_other"), F.col("_id").isNull()).otherwise(F.lit(False)).alias("nameless"),
        F.when(F.col("_other"), F.col("_id")).otherwise(F.col("doc_id")).alias("id"),
        F.col("doc_id").alias("key"),
    )
    best = named.groupBy("component_id").agg(F.min(rank)["key"].alias("best"))
    gone = members.join(best, "component_id").where(F.col("doc_id") != F.col("best")).select("doc_id").distinct()
    kept = keyed.join(_sent(gone, SENT_IDS), "doc_id", "left_anti")
    twice = _sent(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), SENT_IDS)
    hashed = [F.col("row")[c] for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    first = F.min_by("row", F.xxhash64(*hashed))
    names = [F.col("row")[c].alias(c) for c in docs.columns]
    if twice.isEmpty():
        return kept.select(*names)
    once = kept.join(twice, "doc_id", "left_anti").select("row")
    of_many = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(first.alias("row"))
    return once.unionByName(of_many.select("row")).select(*names)
