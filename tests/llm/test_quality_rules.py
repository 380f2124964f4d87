import base64
import random

import edge
import pytest
import zstandard

from ledgerloom.llm import quality_rules as q

PACKER = zstandard.ZstdCompressor(level=q.LEVEL)


def brute(words):
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    return len({k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)})


@pytest.mark.parametrize("seed", range(12))
def test_repeated_words(seed):
    r = random.Random(seed)
    words = [r.choice([b"a", b"b", b"c", b"d", b"e"][: 1 + seed % 5]) for _ in range(r.randrange(0, 120))]
    if seed % 2 and len(words) > 20:
        words += words[5:18]
    assert q.repeated_words(words) == brute(words)


def test_bands():
    text = lambda n, seed=0: " ".join("".join(random.Random(seed * 99991 + k).choices("etaoinshrdlu", k=5)) for k in range(n))
    noise = "".join(random.Random(4).choices([chr(c) for c in range(33, 1000)], k=3000))
    spaced = " ".join(noise[k : k + 6] for k in range(0, 3000, 6))
    verdict = lambda s: q.measure(s, PACKER)[6]
    assert verdict(text(400))
    assert not verdict(spaced)
    assert not verdict("\n".join(f"same line again and again number {k % 7}" for k in range(400)))
    assert not verdict(text(19)) and verdict(text(20))


@pytest.mark.parametrize(("chunks", "every", "tail", "kept"), [(10, 3, 0, False), (49, 3, 0, False), (9, 9, 0, False), (19, 19, 50, False), (20, 20, 50, True), (41, 20, 0, True)])
def test_chunks_of_noise(chunks, every, tail, kept):
    r = random.Random(chunks)
    words = ["".join(r.choices("etaoinshrdlu", k=r.randrange(2, 9))) for _ in range(3000)]
    prose = lambda n: " ".join(r.choices(words, k=n))[:n]
    noise = lambda n: base64.b64encode(r.randbytes(n))[:n].decode()
    text = "".join((noise if k % every == every - 1 else prose)(q.CHUNK) for k in range(chunks)) + prose(tail)
    *_, failed, verdict, ratio, n_chunks, bad = q.measure(text, PACKER)
    assert not failed and q.in_band(len(text), ratio) and (n_chunks, bad) == (chunks + (tail > 0), chunks // every)
    assert verdict == kept


def test_counts():
    n, chars, symbols, dups, repeats, failed, kept, *_ = q.measure("a #b\n\n a #b\na #b\n\x0b\n\x0b\n", PACKER)
    assert (n, chars, symbols, dups, repeats, failed, kept) == (6, 9, 3, 1, 0, True, False)
    assert q.measure("", PACKER)[:7] == (0, 0, 0, 0, 0, True, False)


def test_edges(spark):
    out = q.quality_rules(edge.documents(spark)).toPandas()
    assert len(out) == len(edge.ROWS)
    assert out[out.doc_id.isin([2, 3, 4])].n_words.tolist() == [0, 0, 0]
    assert out.kept.dtype == bool and not out[out.n_words < 20].kept.any()
    assert q.quality_rules(edge.empty(spark)).count() == 0
