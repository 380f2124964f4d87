"""Token counts with a digest cache.

A cache row is (digest of the normalised content, digest of the tokenizer version, tokens, bytes). A
run hashes every text, finds the distinct digests that the cache lacks, encodes one text for each of
them, appends the counts to the cache and joins all documents with it. Running again, or on a corpus
that shares texts, encodes nothing twice; another tokenizer file or library version has another digest
and doesn't mix with the rows of the first.

Normalisation must keep the count; for byte-level tokenizers that is only null to empty text.

``.json`` files are counted as the tokenizers library does it (no special tokens added, no truncation
or padding; special strings inside a text count as one token, its default), ``.model`` files by
sentencepiece. A byte-level BPE file whose merges and ids give the usual ranks is encoded by tiktoken
with ranks from the same file, four times as fast; texts beyond Latin letters go to the tokenizers
library itself, because the two may know different versions of Unicode. Long texts are encoded in pieces cut before
white space, where words of the splitting rule end anyway; a very long run of white space is one word and skips the rule.

Scale: texts move once, to meet equal ones (partial aggregation leaves one copy per task); everything else
is digests and counts. The result reads the cache, a table in the shared folder. A digest that a third
of all documents share is one row on the cache side; adaptive execution splits its documents.

Null texts count as empty: no tokens. Repeated rows get equal counts; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from importlib.metadata import version
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_of

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long, n_bytes long"
#: Fixed value: the splitting rule of the byte-level pre-tokenizer.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: long texts are encoded in pieces of about so many characters
PIECE = 1 << 20
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")
#: longer runs of white space exceed the stack of the splitting rule; those up to ɏ that Unicode calls white space
_LONG_WHITE = re.compile("[\t-\r \x85\xa0]{50000,}")
_BEFORE_WHITE = re.compile(r"(?<=\S)(?=[\t-\r ])")


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer: its file and the library that applies it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    return hashlib.sha256(Path(path).read_bytes() + f"{library} {version(library)}".encode()).hexdigest()


def _byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks for tiktoken, if the file is plain byte-level BPE in rank order."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and spec.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if not plain:
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    special = {t["content"] for t in spec.get("added_tokens", ())}
    ranks = {bytes(byte_of[c] for c in token): k for token, k in model["vocab"].items() if token not in special}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    in_order = all(model["vocab"].get(m) == 256 + k for k, m in enumerate(merged))
    return ranks if in_order and len(ranks) == 256 + len(merged) else None


def encoder(name: str, content: bytes) -> Callable[[str], np.ndarray]:
    """A function from a text to its token ids, built from the file's content."""
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda text: np.array(pieces.encode(text, num_threads=1), np.uint32)
    import tokenizers

    reference = tokenizers.Tokenizer.from_str(content.decode("utf-8"))
    reference.no_truncation()
    reference.no_padding()

    def by_library(text: str) -> np.ndarray:
        return np.array(reference.encode(text, add_special_tokens=False).ids, np.uint32)

    spec = json.loads(content)
    ranks = _byte_ranks(spec)
    added = spec.get("added_tokens", ())
    spaced = any(re.search(r"\s", t["content"]) for t in added)
    if ranks is None or spaced or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        return by_library
    import tiktoken

    fast = tiktoken.Encoding(
        "file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={t["content"]: t["id"] for t in added}
    )

    def by_ranks(text: str) -> np.ndarray:
        return fast.encode_to_numpy(text, allowed_special="all")

    def white(run: str) -> np.ndarray:
        """A run of white space that is one word of the splitting rule."""
        return np.array(fast._encode_single_piece(run), np.uint32)

    def ids(text: str) -> np.ndarray:
        parts = []
        for piece in _pieces(text):
            if _BEYOND_LATIN.search(piece):
                parts.append(by_library(piece))
                continue
            at = 0
            for run in _LONG_WHITE.finditer(piece):
                # its last sign belongs to what follows, if anything does
                end = run.end() if run.end() == len(piece) else run.end() - 1
                parts += [by_ranks(piece[at : run.start()]), white(piece[run.start() : end])]
                at = end
            parts.append(by_ranks(piece[at:]))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    return ids


def _pieces(text: str) -> Iterator[str]:
    """A long text cut before white space; the splitting rule never joins a sign to white space after it."""
    at = 0
    while len(text) - at > PIECE:
        cut = _BEFORE_WHITE.search(text, at + PIECE)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def counter(name: str, content: bytes) -> Callable[[list[str]], list[int]]:
    """A function from texts to their numbers of tokens."""
    encode = encoder(name, content)
    return lambda texts: [len(encode(text)) for text in texts]


def digest_of(column: str = "text"):
    return F.unhex(F.sha2(text_of(column), 256))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """doc_id, digest, n_bytes, n_tokens of every document; the cache folder gains the distinct misses."""
    spark = docs.sparkSession
    name, content, tokenizer = Path(tokenizer_path).name, Path(tokenizer_path).read_bytes(), tokenizer_digest(tokenizer_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or counter(name, content)
            numbers: list[int] = []
            for text in batch.column("text"):  # one by one: memory for the ids of one text only
                numbers.extend(count([text.as_py()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(numbers, pa.int64()), batch.column("n_bytes")], names=["digest", "n_tokens", "n_bytes"]
            )

    # creates the folder of a new cache; an old one gains an empty file
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    texts = docs.select(digest_of().alias("digest"), text_of().alias("text"), F.octet_length(text_of()).cast("long").alias("n_bytes"))
    misses = texts.join(_known(spark, cache_path, tokenizer), "digest", "left_anti").dropDuplicates(["digest"])
    counted = misses.mapInArrow(encode, "digest binary, n_tokens long, n_bytes long")
    counted.select("digest", F.lit(tokenizer).alias("tokenizer"), "n_tokens", "n_bytes").write.mode("append").parquet(cache_path)
    known = _known(spark, cache_path, tokenizer)
    return docs.select("doc_id", digest_of().alias("digest")).join(known, "digest")


def _known(spark, cache_path: str, tokenizer: str) -> DataFrame:
    """One row per digest, also where two runs have appended the same."""
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"), F.max("n_bytes").alias("n_bytes"))
