"""Helpers of the operators: hashes, winnowing, Elias-Fano lists, encoders, links, order."""

from __future__ import annotations

import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rosterlake.llm import simhash
from rosterlake.llm.keys import in_order
from rosterlake.llm.token_files import EliasFano, Encoder, _cuts
from rosterlake.llm.words import LETTERS, Texts, grams, passes, rightmost_minimum, sequence
from tests.llm.brute import WORD, small_letters


@settings(deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAb \t\n\x0b\x1cé日#", max_size=12)), max_size=8))
def test_texts(texts):
    got = Texts(pa.array(texts, pa.string()))
    words = [WORD.findall(t or "") for t in texts]
    assert np.diff(got.first).tolist() == list(map(len, words))
    assert [got.data[a:b].tobytes().decode() for a, b in zip(got.start, got.end, strict=True)] == sum(words, [])
    assert got.joined(np.ones(len(got.start), bool)).to_pylist() == [" ".join(w) for w in words]
    keep = np.arange(len(got.start)) % 2 == 0
    kept, at = [], 0
    for w in words:
        kept.append(" ".join(x for i, x in enumerate(w) if (at + i) % 2 == 0))
        at += len(w)
    assert got.joined(keep).to_pylist() == kept
    hashes = dict(zip(sum(words, []), got.hashes().tolist(), strict=True))
    assert len(set(hashes.values())) == len(hashes)
    assert got.hashes().tolist() == [hashes[w] for w in sum(words, [])]


def test_letters_and_small_letters():
    got = Texts(pa.array(["Ab-C9 É_x\x7f"]), LETTERS, lower=True)
    assert [got.data[a:b].tobytes().decode() for a, b in zip(got.start, got.end, strict=True)] == ["ab", "c9", "É", "x"]
    assert small_letters("AÉZ") == "aÉz"


def test_equal_stretches_have_equal_hashes():
    words = Texts(pa.array(["a b c a b c d", "b c d"])).hashes()
    threes = grams(sequence(words), len(words), 3).tolist()
    assert threes[0] == threes[3] and threes[4] == threes[7] and len(set(threes)) == 6


@given(st.lists(st.integers(0, 4), min_size=1, max_size=40), st.integers(1, 12))
def test_rightmost_minimum(values, n):
    got = rightmost_minimum(np.array(values), n).tolist()
    want = [max(range(i, i + n), key=lambda k: (-values[k], k)) for i in range(len(values) - n + 1)]
    assert got == want


def test_passes():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 5, None, "b" * 50, "", "c" * 3])], ["text"])
    parts = [p.column("text").to_pylist() for p in passes(batch, size=10)]
    assert parts == [["a" * 5, None], ["b" * 50], ["", "c" * 3]]
    assert list(passes(batch.slice(0, 0))) == []
    assert list(_cuts([5, 0, 50, 0, 3], 10)) == [(0, 2), (2, 3), (3, 5)] and list(_cuts([], 3)) == []


@settings(deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=700))
def test_elias_fano(gaps):
    values = np.cumsum(gaps).astype(np.int64)
    blob = EliasFano.encode(values)
    got = EliasFano(blob)
    assert got.all().tolist() == values.tolist()
    assert [got.select(i) for i in range(0, len(values), 7)] == values[::7].tolist()
    if len(values):
        bits = 2 + np.log2(max(1, values[-1] / len(values)))
        assert len(blob) <= 40 + len(values) * bits / 8 + 4 * (len(values) / 256 + 1)
    with pytest.raises(IndexError):
        got.select(len(values))


def test_encoder_against_the_library():
    encode, rng = Encoder("word_bpe_49k.json"), random.Random(3)
    assert encode.by_word and not Encoder("byte_bpe_50k.json").by_word
    texts = ["", " \n", "İstanbul ÀÉ <|endoftext|> x", "a\x1cb c\xa0d\x85e", "don't I'LL we'S '' 's !!'s ''s", "x²y½ 12 ªº µ", "é 日本", "ǅ ß ẞ", "é"]
    texts += ["".join(rng.choice("aB'sSlL!1 \n\té²ªÿ.-<|>") for _ in range(rng.randrange(60))) for _ in range(2000)]
    want = [encode._whole(t) for t in texts]
    assert encode(texts) == want
    encode.MOST = 50  # starts over again and again
    encode.pieces.clear()
    assert [x for i in range(0, len(texts), 7) for x in encode(texts[i : i + 7])] == want


def by_hand(values, bits):
    group = {v: v for v in values}

    def top(v):
        while group[v] != v:
            v = group[v]
        return v

    for a in values:
        for b in values:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits:
                x, y = sorted((top(a), top(b)))
                group[y] = x
    return {v: top(v) for v in values}


@pytest.mark.parametrize("n", [1, 100, 5000, 10**6, 10**9, 10**13])
def test_block_masks(n):
    masks, rng = simhash.block_masks(n, 4), random.Random(n)
    assert min(m.bit_count() for m in masks) >= min(36, n.bit_length() + 1)
    for _ in range(200):  # any four differing bits leave one choice of blocks alone
        apart = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not apart & m for m in masks)


@pytest.mark.parametrize("part", [3, 40, 2000])
def test_a_large_group_of_near_copies(spark, part):
    """A third of all fingerprints within a few bits of each other: all are found linked, with few edges."""
    rng = random.Random(11)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    center = rng.getrandbits(64)
    near = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in range(150)}
    far = {rng.getrandbits(64) for _ in range(300)}
    chain = [rng.getrandbits(64)]
    for _ in range(30):
        chain.append(chain[-1] ^ sum(1 << b for b in rng.sample(range(64), 4)))
    values = sorted({signed(v) for v in near | far | set(chain)})
    prints = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
    edges = simhash.links(prints, part=part)
    masks = len(simhash.block_masks(len(values), 4))
    cells = -(-len(near) // part) + 2
    assert edges.count() <= len(values) * masks * cells
    found = {r.u: r.v for r in simhash.roots(edges).collect()}
    assert {v: found.get(v, v) for v in values} == by_hand(values, 4)


def test_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 5).alias("n"))
    got = in_order(df, [F.col("k")], "test", F.col("n")).orderBy("k").collect()
    assert [r["_place"] for r in got] == list(range(1000))
    assert [r["_before"] for r in got] == [sum(x["n"] for x in got[:i]) for i in range(1000)]
    assert in_order(df.limit(0), [F.col("k")], "test").count() == 0


def test_nothing_else_imports_this_subpackage():
    import subprocess

    code = "import sys, rosterlake.__main__, harness.catalog; print(any('rosterlake.llm' in m for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.strip() == "False"


def test_encoder_looks_up_only_what_it_lacks(monkeypatch):
    encode = Encoder("word_bpe_49k.json")
    texts = ["Tall trees, I'll say\t2 ÀÉ", "", "tall TREES fall", " ", "日本 tall"]
    learnt, learn = [], encode._learn
    monkeypatch.setattr(encode, "_learn", lambda new: (learnt.append(sorted(new)), learn(new)))
    want = [encode._whole(t) for t in texts]
    assert encode(texts[:2]) == want[:2] and encode(texts) == want and encode(texts) == want
    assert learnt == [["'ll", ",", "2", "i", "say", "tall", "trees", "àé"], ["fall"], []]
    encode.MOST = 9  # what was found before the memory is cleared still counts
    assert encode(["tall new trees"]) == [encode._whole("tall new trees")] and learnt[-1] == ["new"] == [*encode.pieces]
