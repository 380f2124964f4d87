"""Toxicity: embeddings of character n-grams, averaged into a linear softmax, trained jointly in numpy.

A text is lower-cased and cut into windows of ``WINDOW`` words, half overlapping, so that a few words
count in a long text too. A window is the bag of the character n-grams (``SIZES``, word edges
included) of its words; their embeddings are averaged and a linear softmax gives its probability. The
score of a text is that of its worst window. A misspelt word that training never saw shares most
n-grams with the word it stands for, hence most of its vector.

Training takes a bounded sample of labelled rows (``limits`` rows of each label). Embeddings and softmax are
learnt together; the first epoch averages whole texts, later ones the worst window of every text.
Scoring needs no shuffle: for a trained model the softmax of an average is an average of one number
per n-gram, added up over Arrow batches in numpy, piece by piece, over whole texts.

Null and empty texts and texts without letters or digits have no window and score 0. Without labels of
both kinds all scores are 0 (nothing is known to be toxic). Repeated rows get equal scores, an empty table
gives none, and other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ledgerloom.llm.common import id_remainder, labelled_sample, texts_in_parts

BITS = 17
SIZES = (3, 4, 5, 6)
WINDOW = 2
DIMENSIONS = 8
LIMITS = {0: 4000, 1: 1000}
PART_BYTES = 500_000
THRESHOLD = 0.3
#: a label that the half-trained model gives less than this chance counts as an error
ABSURD = 0.2

_WORD_SIGN = np.array([chr(c).isalnum() for c in range(1 << 16)])


@dataclass
class Grams:
    """The n-grams of some texts by the position they start at, and the windows over them."""

    buckets: list[np.ndarray]  # for each size, the bucket at each position
    valid: list[np.ndarray]
    starts: np.ndarray  # windows, as ranges of positions
    ends: np.ndarray
    owners: np.ndarray  # the text of each window


def grams_of(texts: Sequence[str]) -> Grams:
    lowered = [f" {text.lower()} " for text in texts]
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    sign = _WORD_SIGN[np.minimum(codes, 0xFFFF)] & (codes < 1 << 16)
    codes = np.where(sign, codes, np.uint32(32))
    buckets, valid = [], []
    rolling, inside = codes.copy(), np.ones(len(codes), bool)  # inside: all but first and last are signs
    for n in range(2, max(SIZES) + 1):
        rolling = rolling[:-1] * np.uint32(0x01000193) + codes[n - 1 :]
        if n > 2:
            inside = inside[:-1] & sign[n - 2 : len(codes) - 1]
        else:
            inside = inside[:-1]
        if n in SIZES:
            mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x9E3779B1)
            buckets.append((mixed >> np.uint32(32 - BITS)).astype(np.int32))
            valid.append(inside.copy())
    begins = np.flatnonzero(sign[1:] & ~sign[:-1])  # the edge before each word
    text_ends = np.cumsum(lengths)
    owner = np.searchsorted(text_ends, begins, side="right")
    # every WINDOW // 2 words of a text a window begins; its end is WINDOW words later or the text's end
    first = np.searchsorted(owner, np.arange(len(texts)), side="left")
    rank = np.arange(len(begins)) - first[owner] if len(begins) else np.zeros(0, np.int64)
    count = np.bincount(owner, minlength=len(texts))
    step = WINDOW // 2
    opens = np.flatnonzero((rank % step == 0) & ((rank == 0) | (rank + step < count[owner])))
    after = opens + WINDOW
    own_end = text_ends[owner[opens]]
    within = (after < len(begins)) & (rank[opens] + WINDOW < count[owner[opens]])
    ends = np.where(within, begins[np.minimum(after, max(len(begins) - 1, 0))] if len(begins) else 0, own_end)
    return Grams(buckets, valid, begins[opens], ends, owner[opens])


def window_means(grams: Grams, values: np.ndarray) -> np.ndarray:
    """The mean of ``values`` (one for each bucket) over the n-grams of each window."""
    length = len(grams.buckets[0]) + SIZES[0]
    total, number = np.zeros(length + 1), np.zeros(length + 1)
    for bucket, valid in zip(grams.buckets, grams.valid):
        total[1 : len(bucket) + 1] += np.where(valid, values[bucket], 0.0)
        number[1 : len(bucket) + 1] += valid
    np.cumsum(total, out=total)
    np.cumsum(number, out=number)
    last = np.minimum(grams.ends, length)
    return (total[last] - total[grams.starts]) / np.maximum(number[last] - number[grams.starts], 1.0)


def worst_windows(owners: np.ndarray, means: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have windows, and the window with the largest mean of each."""
    order = np.lexsort((-means, owners))
    first = np.flatnonzero(np.diff(owners[order], prepend=-1))
    return owners[order][first], order[first]


def score_texts(texts: Sequence[str], values: np.ndarray, bias: float) -> np.ndarray:
    scores = np.zeros(len(texts))
    grams = grams_of(texts)
    if len(grams.starts):
        means = window_means(grams, values)
        owners, worst = worst_windows(grams.owners, means, len(texts))
        scores[owners] = 1.0 / (1.0 + np.exp(-np.clip(means[worst] + bias, -30, 30)))
    return scores


def _bags(grams: Grams, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, bag number) of the n-grams of the ranges."""
    ids, bags = [], []
    for k, (a, b) in enumerate(zip(starts, ends)):
        for bucket, valid in zip(grams.buckets, grams.valid):
            part = bucket[a:b][valid[a:b]]
            ids.append(part)
            bags.append(np.full(len(part), k))
    return np.concatenate(ids or [np.zeros(0, np.int32)]), np.concatenate(bags or [np.zeros(0, np.int64)])


def train(rows: Sequence[tuple[str, int]], epochs: int = 8, whole: int = 1, trusted: int = 4, rate: float = 0.05) -> tuple[np.ndarray, float] | None:
    """One number for each bucket and the bias of the trained model; None unless both labels occur."""
    if len({y for _, y in rows}) < 2:
        return None
    random = np.random.default_rng(5)
    embedding = random.normal(0.0, 0.05, (1 << BITS, DIMENSIONS))
    softmax, bias = random.normal(0.0, 0.5, (DIMENSIONS, 2)), np.zeros(2)
    squares, softmax_squares, bias_squares = np.full(1 << BITS, 1e-6), 1e-6, 1e-6
    labels = np.array([y for _, y in rows])
    parts = _parts(rows)
    for epoch in range(epochs):
        for k in random.permutation(len(parts)):
            first, texts = parts[k]
            grams = grams_of(texts)
            if not len(grams.starts):
                continue
            if epoch < whole:
                owners = np.unique(grams.owners)
                starts = grams.starts[np.searchsorted(grams.owners, owners)]
                ends = grams.ends[np.searchsorted(grams.owners, owners, side="right") - 1]
            else:
                owners, worst = worst_windows(
                    grams.owners, window_means(grams, embedding @ (softmax[:, 1] - softmax[:, 0])), len(texts)
                )
                starts, ends = grams.starts[worst], grams.ends[worst]
            ids, bags = _bags(grams, starts, ends)
            number = np.maximum(np.bincount(bags, minlength=len(owners)), 1)[:, None]
            mean = np.stack([np.bincount(bags, embedding[ids, d], len(owners)) for d in range(DIMENSIONS)], 1) / number
            logits = mean @ softmax + bias
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            target = np.eye(2)[labels[first + owners]]
            error = chance - target
            if epoch >= trusted:  # labels have errors: what the model finds absurd by now is left out
                error[(chance * target).sum(1) < ABSURD] = 0.0
            # gradients of the embeddings, the softmax and its bias, with rates that adapt to their size
            back = (error @ softmax.T) / number
            touched, place = np.unique(ids, return_inverse=True)
            step = np.stack([np.bincount(place, back[bags, d], len(touched)) for d in range(DIMENSIONS)], 1)
            squares[touched] += (step * step).mean(1)
            embedding[touched] -= rate * step / np.sqrt(squares[touched])[:, None]
            turn = mean.T @ error
            softmax_squares += float((turn * turn).mean())
            softmax -= rate * turn / softmax_squares**0.5
            shift = error.sum(0)
            bias_squares += float((shift * shift).mean())
            bias -= rate * shift / bias_squares**0.5
    return (embedding @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def _parts(rows: Sequence[tuple[str, int]], most: int = 100_000, least: int = 15) -> list[tuple[int, list[str]]]:
    """Neighbouring rows of together about ``most`` characters, with the number of the first.

    Of small samples at least about ``least`` parts: each is a step of the training.
    """
    parts: list[tuple[int, list[str]]] = []
    most = min(most, sum(len(text) for text, _ in rows) // least)
    size = most
    for k, (text, _) in enumerate(rows):
        if size >= most:
            parts.append((k, []))
            size = 0
        parts[-1][1].append(text)
        size += len(text)
    return parts


def score_column(model: tuple[np.ndarray, float] | None, text: Column) -> Column:
    """Probability that a text is toxic."""
    if model is None:
        return F.lit(0.0)
    values, bias = model

    @arrow_udf("double")
    def toxicity_score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            scores = [score_texts(part, values, bias) for part in texts_in_parts(batch, PART_BYTES)]
            yield pa.array(np.concatenate(scores or [np.zeros(0)]), pa.float64())

    return toxicity_score(text)


def trained_model(
    docs: DataFrame, labels: DataFrame, eligible: Column, limits: dict[int, int] | None = None
) -> tuple[np.ndarray, float] | None:
    return train(labelled_sample(docs, labels, "toxic", eligible, limits or LIMITS))


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out_modulus: int = 4,
    held_out_remainder: int = 2,
    threshold: float = THRESHOLD,
    limits: dict[int, int] | None = None,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; only the text is an input of the score."""
    held_out = id_remainder(held_out_modulus) == held_out_remainder
    model = trained_model(docs, labels, ~held_out, limits)
    scored = docs.select("doc_id", held_out.alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    held_out_modulus: int = 4,
    held_out_remainder: int = 2,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents, all columns, whose score is under the threshold."""
    model = trained_model(docs, labels, id_remainder(held_out_modulus) != held_out_remainder)
    return docs.where(score_column(model, F.col("text")) < threshold)
