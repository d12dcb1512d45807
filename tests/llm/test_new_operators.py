"""Manifest, suffix-array dedup and spelling variants: brute force, awkward rows, and what their methods promise."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import manifest, spelling, suffixes
from tests.llm import brute
from tests.llm.conftest import prose, tuples


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def written(df, folder):
    df.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


# --- manifest -------------------------------------------------------------------------------------------


def test_manifest_of_awkward_rows(spark, odd, odd_rows, tmp_path):
    got = manifest.op11_manifest(spark, written(odd, tmp_path))
    assert tuples(got) == ordered(brute.manifest(odd_rows))


@pytest.mark.parametrize("n, groups", [(1, 1), (8, 1), (9, 3), (64, 1), (65, 2), (600, 1), (4200, 70)])
def test_manifest_of_any_size(spark, tmp_path, n, groups):
    rows = [dict(doc_id=i * 7 % (n + 3), text=f"Text {i}" if i % 5 else None, lang=None if i % groups == 0 else f"l{i % groups}", source="é", n_chars=i) for i in range(n)]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = manifest.op11_manifest(spark, written(docs.repartition(5), tmp_path))
    assert tuples(got) == ordered(brute.manifest(rows))


def test_manifest_of_nothing(spark, nothing, tmp_path):
    assert manifest.op11_manifest(spark, written(nothing, tmp_path)).collect() == []


def test_manifest_finds_any_change(odd):
    """A leaf that is not the row's does not lead to the root, nor does a changed path."""
    found = manifest.manifest(odd)
    path = F.col("path")
    other = F.transform(path, lambda p: F.struct(p["right"].alias("left"), p["left"].alias("right")))
    shown = found.select(
        (manifest.folded(F.col("leaf"), path) == F.col("root")).alias("own"),
        (manifest.folded(manifest.digest(F.col("leaf")), path) == F.col("root")).alias("changed"),
        (manifest.folded(F.col("leaf"), other) == F.col("root")).alias("turned"),
    ).collect()
    assert shown and all(r.own and not r.changed and not r.turned for r in shown)


# --- suffix array ---------------------------------------------------------------------------------------


def test_suffix_order():
    rng = random.Random(5)
    for _ in range(800):
        n, letters = rng.randrange(1, 70), rng.choice([1, 2, 3, 26])
        text = np.array([rng.randrange(letters) + 1 for _ in range(n)])
        assert suffixes.suffix_order(text, 10**9).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())
        depth = rng.randrange(1, 20)
        order = suffixes.suffix_order(text, depth).tolist()
        starts = [text[i : i + depth].tolist() for i in order]
        assert sorted(order) == list(range(n)) and starts == sorted(starts)


def test_suffix_order_of_large_numbers():
    """Numbers whose triples need more than 64 bits."""
    rng = np.random.default_rng(1)
    text = rng.choice(rng.integers(1, 1 << 40, 40), 500)
    assert suffixes.suffix_order(text, 10**9).tolist() == sorted(range(500), key=lambda i: text[i:].tolist())


def test_suffix_order_of_some_places():
    rng = random.Random(6)
    for _ in range(800):
        n, letters = rng.randrange(1, 70), rng.choice([1, 2, 3, 26, 500])
        text = np.array([rng.randrange(letters) + 1 for _ in range(n)])
        wanted = np.array([rng.random() < 0.3 for _ in range(n)])
        places = np.flatnonzero(wanted).tolist()
        assert suffixes.suffix_order(text, 10**9, wanted=wanted).tolist() == sorted(places, key=lambda i: text[i:].tolist())
        depth = rng.randrange(1, 60)
        order = suffixes.suffix_order(text, depth, wanted=wanted).tolist()
        starts = [text[i : i + depth].tolist() for i in order]
        assert sorted(order) == places and starts == sorted(starts)


@pytest.mark.parametrize("ids", ["int", "str"])
def test_shared_runs_in_any_batches(ids):
    """Anchors go on over batches of any size; which runs are copies, and which strings of crowded anchors, does not depend on that."""
    rng = random.Random(7)
    for _ in range(300):
        name = (lambda i: i) if ids == "int" else "d{}".format
        rows = sorted((rng.randrange(4), rng.randrange(rng.choice([1, 2, 5])), name(rng.randrange(5))) for _ in range(rng.randrange(25)))
        hot, expected = rng.randrange(4), []
        for anchor in {a for a, _, _ in rows}:
            firsts = {}
            for a, h, d in rows:
                if a == anchor and firsts.setdefault(h, d) != d:
                    expected.append((d, h, 0))
            if len(firsts) > 1 and len({d for a, _, d in rows if a == anchor}) > 1:
                expected += [(d, h, 1) for h, d in firsts.items()] + [(None, anchor, len(firsts))] * (len(firsts) > hot)
        batches, at = [], 0
        while at < len(rows):
            size = rng.randrange(4)
            cut = rows[at : at + size]
            batches.append(pa.RecordBatch.from_pylist([dict(doc_id=d, anchor=a, hash=h) for a, h, d in cut], pa.schema([("doc_id", pa.int64() if ids == "int" else pa.string()), ("anchor", pa.int64()), ("hash", pa.int64())])))
            at += size
        got = [tuple(r.values()) for b in suffixes._shared(hot)(iter(batches)) for r in b.to_pylist()]
        assert ordered(got) == ordered(expected)


def test_texts_are_hashed_three_times(spark, odd, monkeypatch):
    """For runs, for the strings of several to an anchor and at the end: each time costs as much as the rest of a task."""
    plans, swept = [], suffixes.swept

    def watched(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return swept(df, label)

    monkeypatch.setattr(suffixes, "swept", watched)
    plans.append(suffixes.without_repeats(odd)._jdf.queryExecution().optimizedPlan().toString())
    assert sum(p.count("MapInArrow") for p in plans if "text" in p) <= 4  # one of them reads the runs of the first


def _rows(spark, texts):
    rows = [dict(doc_id=i, text=t) for i, t in texts]
    return rows, spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id bigint, text string").repartition(3)


@pytest.mark.parametrize("window, gram", [(50, 20), (12, 6), (3, 1), (50, 49)])
def test_bytes_removed(odd, odd_rows, window, gram):
    got = suffixes.without_repeats(odd, window=window, gram=gram)
    assert got.schema["row"].dataType.fieldNames() == odd.columns
    assert tuples(got.select("row.*")) == tuples(odd)
    found = got.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert tuples(found) == ordered(brute.bytes_removed(odd_rows, window))


@pytest.mark.parametrize("block, hot", [(4_000, 4_000), (7, 2)])
def test_crowded_anchors(spark, block, hot):
    """One line in many documents, each time between other words: more strings of its anchors than a block takes."""
    line = "the line that all of these documents have in common, whatever else they hold"
    texts = [(i, prose(8, i, 30) + line + prose(8, 1000 + i, 30)) for i in range(60)] + [(100, "a" * 300), (101, "a" * 200 + "b"), (102, "ab" * 90)]
    rows, docs = _rows(spark, texts)
    got = suffixes.without_repeats(docs, block=block, hot=hot, carry=["doc_id"])
    assert tuples(got.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))) == ordered(brute.bytes_removed(rows))


def test_texts_longer_than_a_slice(spark, monkeypatch):
    """Cut at other places, equal stretches are still found."""
    monkeypatch.setattr(suffixes, "SLICE", 1 << 12)
    monkeypatch.setattr(suffixes, "_STRETCH", 1 << 8)
    passage = prose(1500, 3)
    data = [np.frombuffer((x + " ").encode(), np.uint8) for x in (prose(700, 1) + passage, passage + prose(50, 2))]
    whole = [suffixes.Runs(d, np.array([0, len(d)]), 50, 20) for d in data]
    monkeypatch.setattr(suffixes, "SLICE", 1 << 22)
    again = [suffixes.Runs(d, np.array([0, len(d)]), 50, 20) for d in data]
    for a, b in zip(whole, again):
        covered = lambda r: sorted(x for f, n in zip(r.first.tolist(), r.size.tolist()) for x in range(f, f + n))
        assert covered(a) == covered(b) == list(range(len(covered(b)))) and set(a.anchor) == set(b.anchor)


def test_bytes_of_nothing(spark, nothing):
    assert suffixes.without_repeats(nothing).count() == 0
    rows, docs = _rows(spark, [(1, None), (2, ""), (3, "é" * 25), (4, "é" * 25), (None, "é" * 25)])
    got = suffixes.without_repeats(docs, carry=["doc_id"]).select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert tuples(got) == ordered(brute.bytes_removed(rows))


# --- spelling -------------------------------------------------------------------------------------------


def test_spelling_of_awkward_rows(odd, odd_rows, nothing):
    rows = [d | {"text": (d["text"] or "") + " Fahrräder fahrrader FAHRRÄDER " * 3} for d in odd_rows]
    docs = odd.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" Fahrräder fahrrader FAHRRÄDER " * 3)))
    assert tuples(spelling.variants(docs)) == ordered(brute.spelling(rows))
    assert spelling.variants(nothing).count() == 0


def _words(n, letters, seed):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 12)))
        words |= {w, w[:3] + w[4:] if len(w) > 6 else w, w[:2] + rng.choice(letters) + w[2:], rng.choice(letters) + w[1:], w[:-1] + rng.choice(letters)}
    return sorted(w for w in words if len(w) >= 6)


@pytest.mark.parametrize("frequent", [0.0, 0.01, 1.0])
@pytest.mark.parametrize("letters", ["ab", "abcÿ", "abcdefghijklmnopqrstuvwxyzàß"])
def test_every_near_pair_is_found(spark, letters, frequent):
    words = _words(250, letters, len(letters))
    got = spelling.near_pairs(spark.createDataFrame([(w, 5) for w in words], "word string, n bigint"), frequent)
    assert tuples(got) == sorted((a, b) for a in words for b in words if brute.near(a, b))


def test_a_word_has_an_unaffected_gram_at_any_place():
    """The bound that lets lists of grams find everything: it never is nothing, and never more than what two near words share."""
    rng = np.random.default_rng(2)
    grams = rng.random((spelling.ALPHABET,) * 3) < 0.5
    grams &= (rng.random((spelling.ALPHABET,) * 2) < 0.5)[:, :, None]
    for size in range(6, 12):
        letters = rng.integers(0, 4, (300, size))
        ends, kept = spelling.decomposed(letters, grams)
        for k, (a, b, n) in enumerate(spelling.unaffected(letters, grams)):
            assert (n >= 1).all() and ((a > 0) | (b > 0)).all() and (size - a - b < spelling.GAP).all()
            if k < size:
                changed = letters.copy()
                changed[:, k] = rng.integers(0, 4, 300)
                other_ends, other_kept = spelling.decomposed(changed, grams)
                assert ((kept & other_kept & (ends == other_ends)).sum(axis=1) >= n).all()


def test_damaged_runs_and_counts(spark):
    """Checksums of long and short runs alike, with letters of two bytes."""
    rng = random.Random(9)
    texts = [(i, " ".join("".join(rng.choice("abcdéÿ") for _ in range(rng.choice([5, 6, 7, 70, 300]))) for _ in range(400)) * 5) for i in range(4)]
    rows, docs = _rows(spark, [*texts, (None, "abcdéÿ " * 9), (7, None)])
    assert tuples(spelling.variants(docs)) == ordered(brute.spelling(rows))
