"""Packing of token sequences into windows: best fit decreasing, in groups of bounded size.

A document is its token ids and an id that ends it. Documents longer than a window are first cut into full
windows; what is left of each is a piece. The pieces of a group are taken from the longest to the
shortest, and each goes to the tightest open window that still has room for it. A segment tree indexed by
remaining capacity finds that window: a leaf for each capacity says how many windows have it left, and an
inner node whether any below it has.

Some windows then have room left. Those with more than ``slack`` tokens of room are closed by cutting: the
emptiest windows are given up, and their pieces, cut where a window is full, fill the room in the others. So at most
one window a group is not filled; it is split into windows whose sizes are powers of two, which need no padding.
With ``slack`` 0 there is no padding at all.

Scale: one pass in Arrow batches and no shuffle. Each task packs its own documents in groups of some ``GROUP``
tokens, some thousands of windows, so that memory doesn't grow with the table. A window is named by its task's partition and
a number. Executors may be lost: a task that runs again gives a complete packing of its rows. (If the rows of a
partition come in another order then, it is another packing; write the result once if several readers need the same.)

Null and empty texts have the ending id only. Repeated rows and ids are packed each; equally long pieces
go in the order in which they come; an empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.token_counts import encoder

WINDOW = 2048
#: a window may keep room for so many tokens (0.8 %; random sizes leave 0.02 % of all, with a tenth of the cuts of none)
SLACK = 16
#: a group of documents is packed when it has so many tokens
GROUP = 1 << 22
#: numbers of windows that a partition may have
_NAMES = 1 << 40

Piece = tuple[int, int, int]  # document, first token, tokens


class RoomTree:
    """Segment tree over remaining capacities: the smallest capacity of at least ``needed`` that some open window has."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()  # leaves 0 .. window
        self.open = [0] * (2 * self.base)

    def add(self, capacity: int, number: int) -> None:
        at = capacity + self.base
        while at:
            self.open[at] += number
            at >>= 1

    def tightest(self, needed: int) -> int:
        """-1 if no open window has room."""
        at = needed + self.base
        # up to the first node whose right neighbour, or itself, has an open window
        while not self.open[at]:
            while at & 1:  # a right child: go up
                at >>= 1
                if not at:
                    return -1
            at += 1
        while at < self.base:
            at *= 2
            if not self.open[at]:
                at += 1
        return at - self.base


def best_fit(pieces: Sequence[Piece], window: int = WINDOW) -> tuple[list[list[Piece]], list[int]]:
    """The windows' pieces and the room left in each; longest pieces first, each into the tightest window."""
    tree = RoomTree(window)
    windows: list[list[Piece]] = []
    room: list[int] = []
    by_room: dict[int, list[int]] = {}
    for piece in sorted(pieces, key=lambda p: -p[2]):  # stable: equally long ones as they come
        size = piece[2]
        capacity = tree.tightest(size)
        if capacity < 0:
            at, capacity = len(windows), window
            windows.append([])
            room.append(window)
        else:
            at = by_room[capacity].pop()
            tree.add(capacity, -1)
        windows[at].append(piece)
        room[at] = capacity - size
        if room[at]:
            by_room.setdefault(room[at], []).append(at)
            tree.add(room[at], 1)
    return windows, room


def filled(windows: list[list[Piece]], room: list[int], window: int = WINDOW, slack: int = SLACK) -> list[list[Piece]]:
    """The windows with room of at most ``slack`` tokens, but for last ones whose sizes are powers of two."""
    order = sorted(range(len(windows)), key=lambda k: (room[k], k))
    done = [windows[k] for k in order if room[k] <= slack]
    open_ = [k for k in order if room[k] > slack]
    loose: list[Piece] = []  # pieces of windows that were given up
    low, high = 0, len(open_)
    while low < high:
        # the window with the least room takes from the emptiest one
        taker, need = windows[open_[low]], room[open_[low]]
        low += 1
        while need:
            if not loose:
                if low == high:
                    break
                high -= 1
                loose = windows[open_[high]][::-1]
            document, first, size = loose.pop()
            took = min(size, need)
            taker.append((document, first, took))
            need -= took
            if took < size:
                loose.append((document, first + took, size - took))
        if need:
            loose = taker[::-1]  # the last one, with nothing left to fill it
        else:
            done.append(taker)
    rest = sum(size for _, _, size in loose)
    while rest:
        power = min(window, 1 << (rest.bit_length() - 1))
        part: list[Piece] = []
        need = power
        while need:
            document, first, size = loose.pop()
            took = min(size, need)
            part.append((document, first, took))
            need -= took
            if took < size:
                loose.append((document, first + took, size - took))
        done.append(part)
        rest -= power
    return done


def packed(sizes: Sequence[int], window: int = WINDOW, slack: int = SLACK) -> list[list[Piece]]:
    """Windows of pieces (document, first token, tokens) that hold each token of documents of the given sizes once."""
    full, pieces = [], []
    for document, size in enumerate(sizes):
        rest = size % window
        full += [[(document, first, window)] for first in range(0, size - rest, window)]
        if rest:
            pieces.append((document, size - rest, rest))
    return full + filled(*best_fit(pieces, window), window, slack)


def _sequence_rows(documents: list[tuple], window: int, slack: int, names: Iterator[int]) -> Iterator[pa.RecordBatch]:
    """Rows of the packed documents (id, ids), some thousand windows a batch."""
    windows = packed([len(ids) for _, ids in documents], window, slack)
    for begin in range(0, len(windows), 1024):
        columns: list[list] = [[] for _ in range(7)]
        for pieces in windows[begin : begin + 1024]:
            name, offset = next(names), 0
            for document, first, size in pieces:
                key, ids = documents[document]
                row = (key, first, size, ids[first : first + size].tobytes(), len(ids), name, offset)
                for column, value in zip(columns, row):
                    column.append(value)
                offset += size
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMED)


_NAMED = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit numbers; ``start`` counts the document's ids before the piece, ``offset`` those
    of the window.
    """
    name, content = Path(tokenizer_path).name, Path(tokenizer_path).read_bytes()
    group = GROUP

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode: Callable[[str], np.ndarray] | None = None
        names = iter(range(TaskContext.get().partitionId() * _NAMES, (TaskContext.get().partitionId() + 1) * _NAMES))
        documents, tokens = [], 0
        for batch in batches:
            encode = encode or encoder(name, content)
            for key, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                documents.append((key.as_py(), ids))
                tokens += len(ids)
                if tokens >= group:
                    yield from _sequence_rows(documents, window, slack, names)
                    documents, tokens = [], 0
        if documents:
            yield from _sequence_rows(documents, window, slack, names)

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(rows, PIECES)


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """sequence_id, ids (binary as in the pieces, whole windows), n_padding: what a trainer reads.

    A window meets in one task; it has at most ``window`` pieces. Those that aren't a power of two long are filled with zeros.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    whole = pieces.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"),
        F.expr("aggregate(p, 0L, (a, x) -> a + x.length)").alias("n"),
    )
    power = F.expr("(n & (n - 1)) = 0")
    missing = F.when(power, F.lit(0)).otherwise(F.lit(window) - F.col("n")).cast("int")
    zeros = F.unhex(F.repeat(F.lit("00000000"), missing))
    return whole.select("sequence_id", F.concat("ids", zeros).alias("ids"), missing.cast("long").alias("n_padding"))
