import edge
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import token_counts as t

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
FAST = t.counter("byte_bpe_50k.json", open(PATH, "rb").read())


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_every_latin_character_counts_as_in_the_library():
    for c in range(0x250):
        for text in (chr(c), f"a{chr(c)}b", f" {chr(c)}{chr(c)} x", f"1{chr(c)}\n\n{chr(c)}'s", f"  {chr(c)}  "):
            assert FAST([text]) == [library(text)], hex(c)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x250), st.sampled_from(" \n\t'sé½²<|endoftext|>")), max_size=60) | st.text(max_size=40))
def test_random_texts(text):
    text = text.encode("utf-8", "replace").decode()
    assert FAST([text]) == [library(text)]


def test_special_strings_count_as_one_token():
    for text in ("a<|endoftext|>b", "<|endoftext|><|endoftext|>", "<|endoftext", " <|endoftext|> \n"):
        assert FAST([text]) == [library(text)]
    assert FAST(["<|endoftext|>"]) == [1]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files(name):
    path = public_tokenizers.path(name)
    count = t.counter(name, open(path, "rb").read())
    texts = [row[1] or "" for row in edge.ROWS]
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        assert count(texts) == [len(model.encode(x)) for x in texts]
    else:
        own = tokenizers.Tokenizer.from_file(path)
        assert count(texts) == [len(own.encode(x, add_special_tokens=False).ids) for x in texts]


def test_cache_is_used_and_grows_by_the_misses(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = edge.documents(spark)
    first = {(r.doc_id, r.n_tokens, r.n_bytes) for r in t.count_tokens(docs, PATH, cache).collect()}
    distinct = {row[1] or "" for row in edge.ROWS}
    expected = {(row[0], library(row[1] or ""), len((row[1] or "").encode())) for row in edge.ROWS}
    assert first == expected
    stored = spark.read.parquet(cache)
    assert stored.count() == len(distinct)
    more = docs.union(edge.documents(spark, [(77, "a new text", "en", "a", 1)]))
    assert t.count_tokens(more, PATH, cache).count() == len(edge.ROWS) + 1
    assert spark.read.parquet(cache).count() == len(distinct) + 1
    # what is in the cache is not encoded again
    marked = spark.read.parquet(cache).selectExpr("digest", "tokenizer", "cast(-5 as long) as n_tokens", "n_bytes")
    marked.write.parquet(str(tmp_path / "marked"))
    assert {r.n_tokens for r in t.count_tokens(docs, PATH, str(tmp_path / "marked")).collect()} == {-5}
    other = public_tokenizers.path("word_bpe_49k.json")
    assert {r.n_tokens for r in t.count_tokens(docs, other, str(tmp_path / "marked")).collect()} != {-5}


def test_empty_table(spark, tmp_path):
    assert t.count_tokens(edge.empty(spark), PATH, str(tmp_path / "cache")).count() == 0


@pytest.mark.parametrize("sign", [" ", "\n", "\t", "\r\n", " \xa0", "x", "#", "x "])
def test_long_runs_of_one_sign(sign):
    for number in (1000, 49_999, 50_000, 50_001, 1_000_000):
        run = sign * (number // len(sign))
        for text in (run, f"ab{run}cd 'll"):
            assert FAST([text]) == [library(text)], (number, len(text))


def test_many_million_spaces():
    text = " " * 5_000_000
    assert FAST([text]) == [library(text)] == [5_000_000]
    assert FAST([f"word{' ' * 20_000_000}word"]) == [20_000_001]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab 1'sé\n\t\xa0　中"), max_size=80))
def test_pieces_of_long_texts(text):
    size, white = t.PIECE, t._LONG_WHITE
    try:
        t.PIECE, t._LONG_WHITE = 7, t.re.compile("[\t-\r \x85\xa0]{3,}")
        assert FAST([text]) == [library(text)]
    finally:
        t.PIECE, t._LONG_WHITE = size, white
