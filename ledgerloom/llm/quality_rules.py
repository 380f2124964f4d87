"""Quality rules: word counts and repeats, then bands of the zstandard ratio.

Base rules: fewer than ``LEAST_WORDS`` words, or more than 30 % of the words in 8-word windows that
occur twice or more in the text, fail. The verdict on the rest: the ratio (bytes to compressed bytes)
of the whole text, and of each chunk of ``CHUNK`` bytes, has to lie in the band of its length;
repetitive text compresses too well, random text too badly. One chunk in ``TOLERANCE`` may be out of band, as
long texts quote lists and tables; shorter texts may have none. A last chunk too short for a band doesn't count.

One pass in Arrow batches, no shuffle; every text is measured whole. Null texts count as empty: no
words, so they fail. Repeated rows get equal results; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

LEAST_WORDS = 20
WINDOW = 8
LEVEL = 3
CHUNK = 4096
#: Fixed limits: from this many bytes on, least and largest ratio. Short texts hardly compress; long
#: ones repeat their own vocabulary more.
BANDS = (
    (0, 0.0, 1e9),
    (100, 0.8, 2.5),
    (300, 1.1, 2.8),
    (1_000, 1.3, 3.2),
    (3_000, 1.5, 3.8),
    (10_000, 1.6, 4.5),
    (100_000, 1.7, 5.5),
)
#: Of 3,879 chunks of the 1,524 test texts over one chunk that pass all else, none is out of band.
TOLERANCE = 20
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur at least twice. Exact: windows are numbered by doubling."""
    n = len(words)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    width = 1
    while width < window:  # ids[i] numbers the words i .. i + width - 1
        pairs = ids[:-width] * (len(ids) + 1) + ids[width:]
        _, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        width *= 2
        if len(counts) == len(ids):  # all windows differ already
            return 0
    starts = np.flatnonzero(counts[ids] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def in_band(size: int, ratio: float) -> bool:
    low, high = next((low, high) for start, low, high in reversed(BANDS) if size >= start)
    return low <= ratio <= high


def compression(raw: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, int, int]:
    """The ratio of the whole, the number of chunks and of those out of band."""
    if not raw:
        return 0.0, 0, 0
    ratio = len(raw) / len(packer.compress(raw))
    if len(raw) <= CHUNK:
        return ratio, 1, int(not in_band(len(raw), ratio))
    chunks = [raw[k : k + CHUNK] for k in range(0, len(raw), CHUNK)]
    bad = sum(not in_band(len(c), len(c) / len(packer.compress(c))) for c in chunks)
    return ratio, len(chunks), bad


def measure(text: str, packer: zstandard.ZstdCompressor) -> tuple:
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n_words = len(words)
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    repeats = repeated_words(words)
    base_failed = n_words < LEAST_WORDS or 100 * repeats > 30 * n_words
    ratio, chunks, bad = compression(raw, packer)
    judged = chunks - (0 < len(raw) % CHUNK < BANDS[1][0])
    kept = not base_failed and in_band(len(raw), ratio) and TOLERANCE * bad <= judged
    return (
        n_words,
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        base_failed,
        kept,
        ratio,
        chunks,
        bad,
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """The measures and the verdict of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        types = {"boolean": pa.bool_(), "long": pa.int64(), "double": pa.float64()}
        kinds = [types[part.split()[1]] for part in SCHEMA.split(", ")]
        for batch in batches:
            found = [measure(text.as_py() or "", packer) for text in batch.column("text")]
            columns = list(zip(*found)) or [()] * (len(names) - 1)
            arrays = [batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(columns, kinds[1:])]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(rows, SCHEMA)
