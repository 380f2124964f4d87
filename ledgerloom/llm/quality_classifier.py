"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A text becomes tokens (runs of letters and digits, runs of other signs); tokens and pairs of
neighbouring tokens are hashed into ``2**bits`` weights. A token that repeats the one before counts as
one pair shared by all tokens. The score is a sparse dot product through the logistic function.

Labels come from a bounded sample (``limits``: rows of each label); training is one pass of numpy over
it, ``epochs`` times. Scoring is a column expression over whole texts, in Arrow batches, without any
shuffle. Null and empty texts have no features: they get the score of the bias alone. Without labels
of both kinds the score is 1 for every text (nothing is known to be bad). Repeated rows get equal scores, an
empty table gives none, and other columns don't matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ledgerloom.llm.common import id_remainder, labelled_sample

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
BITS = 18
LIMITS = {0: 1500, 1: 3500}


def feature_ids(text: str, bits: int = BITS) -> np.ndarray:
    """Hashed tokens and token pairs of a text, repeats included."""
    tokens = TOKEN.findall(text.encode("utf-8", "replace"))
    one = np.fromiter(map(zlib.crc32, tokens), np.uint32, len(tokens))
    one *= np.uint32(0x9E3779B1)
    left, right = one[:-1], one[1:]
    pair = (left ^ (right >> np.uint32(15))) * np.uint32(0x85EBCA77) + right * np.uint32(0xC2B2AE3D)
    pair[left == right] = np.uint32(0x27D4EB2F)
    return np.concatenate([one, pair]) >> np.uint32(32 - bits)


class Ftrl:
    """Logistic regression by FTRL-proximal; rates are per coordinate, l1 keeps the weights sparse."""

    def __init__(self, bits: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        size = (1 << bits) + 1  # the last one is the bias
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, ids: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[ids]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(
            np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(self.n[ids])) / self.alpha + self.l2)
        )

    def learn(self, ids: np.ndarray, values: np.ndarray, y: int, weight: float) -> None:
        w = self.weights(ids)
        gradient = weight * (probability(float(w @ values)) - y) * values
        before = self.n[ids]
        after = before + gradient * gradient
        self.z[ids] += gradient - (np.sqrt(after) - np.sqrt(before)) / self.alpha * w
        self.n[ids] = after


def probability(logit: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(logit, -30.0, 30.0))))


def train(rows: Sequence[tuple[str, int]], bits: int = BITS, epochs: int = 4) -> np.ndarray | None:
    """Weights, the bias last; None unless both labels occur."""
    if len({y for _, y in rows}) < 2:
        return None
    bags = []
    for text, y in rows:
        ids, counts = np.unique(feature_ids(text, bits), return_counts=True)
        scale = max(1.0, counts.sum()) ** 0.5
        bags.append((np.append(ids, 1 << bits).astype(np.int64), np.append(counts / scale, 1.0), y))
    model, order = Ftrl(bits), np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(bags)):
            model.learn(*bags[k], 1.0)
    return model.weights().astype(np.float32)


def score_column(weights: np.ndarray | None, text: Column) -> Column:
    """Probability of label 1 of each text."""
    if weights is None:
        return F.lit(1.0)

    @arrow_udf("double")
    def quality_score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits = len(weights).bit_length() - 1
        for batch in batches:
            out = []
            for scalar in batch:
                ids = feature_ids(scalar.as_py() or "", bits)
                dot = float(weights[ids].sum(dtype=np.float64)) / max(1.0, len(ids)) ** 0.5
                out.append(probability(dot + float(weights[-1])))
            yield pa.array(out, pa.float64())

    return quality_score(text)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out_modulus: int = 3,
    held_out_remainder: int = 1,
    threshold: float = 0.5,
    limits: dict[int, int] | None = None,
) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; only the text is an input of the score."""
    held_out = id_remainder(held_out_modulus) == held_out_remainder
    weights = train(labelled_sample(docs, labels, "quality", ~held_out, limits or LIMITS))
    scored = docs.select("doc_id", held_out.alias("held_out"), score_column(weights, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
