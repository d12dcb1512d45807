"""Scores of the classifiers, text by text in plain Python: the optimiser step by step, statistics and rules one by one."""

from __future__ import annotations

import math
import os
import random
import re
import struct
import zlib

import pytest
import xxhash

from rosterlake.llm import catalog, quality, toxicity
from tests.llm.brute import WORD, small_letters

SMALL = "/root/testdata/sf0.001"
supplied = pytest.mark.skipif(not os.path.isdir(SMALL), reason="supplied tables are not here")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CALM, RUDE = "stone river cloud maple lantern".split(), "Grumble blockhead nincompoop".split()


def text_of(rng: random.Random, rude: bool) -> str:
    words = [rng.choice(CALM) for _ in range(rng.randrange(3, 9))]
    for _ in range(2 * rude):
        words.insert(rng.randrange(len(words)), rng.choice(RUDE))
    return rng.choice([" ", ", ", "\n"]).join(words)


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    """A folder with 90 documents, some empty, null or repeated, and labels of most, some given more than once or null."""
    folder, rng = str(tmp_path_factory.mktemp("labelled")), random.Random(5)
    toxic = {i: int(rng.random() < 0.4) for i in range(90)}
    docs = [(i, text_of(rng, toxic[i])) for i in range(90)]
    docs += [(90, ""), (91, None), (92, "- "), (93, docs[3][1]), (None, docs[4][1]), (3, docs[3][1])]
    labels = [(i, 1 - toxic[i], toxic[i]) for i in range(80)]
    labels += [(90, 0, 0), (91, 0, 0), (92, 0, 1), (7, 1, 1), (8, None, None), (None, 1, 1), (1000, 1, 1)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, docs, labels


def held(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def training(docs, labels, column: int):
    """Texts and labels in the order of learning: by the hash of the id, the id, the hash of the text."""
    known = {}
    for row in labels:
        if row[0] is not None and row[column] is not None and not held(row[0]):
            known[row[0]] = max(row[column], known.get(row[0], 0))
    signed = lambda b: struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(b, 42)))[0]
    rows = [(signed(struct.pack("<q", i)), i, 42 if t is None else signed(t.encode()), t, known[i]) for i, t in docs if i in known]
    return [(t, label) for *_, t, label in sorted(rows, key=lambda r: r[:3])]


def grams(text) -> set:
    """A word, neighbours, and two words with one or two between."""
    words = TOKEN.findall(small_letters(text or ""))
    found = {("",)}
    for gap in range(4):
        found |= {(gap, words[i], words[i + gap]) for i in range(len(words) - gap)}
    return found


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x))


def ftrl(examples, alpha=3.0, beta=1.0, l1=8.0, l2=0.1, epochs=6) -> dict:
    """Weights by feature, each step by the formulas of the published algorithm; the feature of every text has no L1 term."""
    z, n = {}, {}

    def weight(f) -> float:
        bound = 0.0 if f == ("",) else l1
        if abs(z.get(f, 0.0)) <= bound:
            return 0.0
        return -(z[f] - math.copysign(bound, z[f])) / ((beta + math.sqrt(n[f])) / alpha + l2)

    for _ in range(epochs):
        for text, label in examples:
            features = sorted(grams(text), key=repr)
            weights = [weight(f) for f in features]
            g = sigmoid(math.fsum(weights)) - label
            for f, w in zip(features, weights, strict=True):
                before = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / alpha * w
                n[f] = before + g * g
    return {f: w for f in z if (w := weight(f))}


def test_toxicity_step_by_step(spark, labelled):
    folder, docs, labels = labelled
    weights = ftrl(training(docs, labels, 2))
    assert 5 < len(weights) < 200
    want = sorted(((i, held(i), sigmoid(math.fsum(weights.get(f, 0.0) for f in grams(t)))) for i, t in docs), key=repr)
    got = catalog.QUERIES["op3_toxicity"](spark, folder).collect()
    rows = sorted(((r.doc_id, r.held_out, r.score) for r in got), key=repr)
    assert [r[:2] for r in rows] == [r[:2] for r in want]
    assert [r[2] for r in rows] == pytest.approx([r[2] for r in want], abs=1e-9)
    assert all(r.predicted == (r.score >= 0.5) for r in got) and max(r[2] for r in want) > 0.9 and min(r[2] for r in want) < 0.1


@pytest.mark.parametrize("rows", [7, 40])
def test_the_first_rows_in_turn_are_learnt_from(spark, labelled, rows):
    """A bound below the number of labelled texts, in documents of which one is repeated more often than that."""
    folder, docs, labels = labelled
    known = sorted({i for i, _, y in labels if i is not None and y is not None and not held(i)}, key=lambda i: xxhash.xxh64_intdigest(struct.pack("<q", i), 42) ^ 1 << 63)
    often = [*docs, *[docs[known[2]]] * 50]
    frames = spark.createDataFrame(often, "doc_id long, text string").repartition(5), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(*frames, rows=rows)
    some = [row for row in labels if row[0] in known[:rows]]
    weights = ftrl(training(often, some, 2)[:rows])
    want = [sigmoid(math.fsum(weights.get(f, 0.0) for f in grams(t))) for _, t in docs]
    got = toxicity.scored(spark.createDataFrame(list(enumerate(t for _, t in docs)), "n long, text string"), model).orderBy("row.n").collect()
    assert [r.score for r in got] == pytest.approx(want, abs=1e-9)


def statistics(text) -> dict[str, float]:
    words, data = WORD.findall(text or ""), (text or "").encode()
    share = lambda x, of: x / of if of > 0 else 0.0
    sizes, fours = [len(w.encode()) for w in words], [tuple(words[i : i + 4]) for i in range(len(words) - 3)]
    kinds = {
        "capitals": lambda b: 65 <= b <= 90,
        "digits": lambda b: 48 <= b <= 57,
        "symbols": lambda b: b in b"#*$%&|<>{}[]\\^~=_@+/",
        "bars": lambda b: b in b"|",
        "shouts": lambda b: b in b"!?",
        "stops": lambda b: b in b".,;:",
        "beyond_ascii": lambda b: b >= 0xC0,
        "lines": lambda b: b == 10,
    }
    return {name: share(sum(map(kind, data)), len(words)) for name, kind in kinds.items()} | {
        "words": math.log1p(len(words)),
        "word_length": share(sum(sizes), len(words)),
        "distinct_words": share(len(set(words)), len(words)),
        "repeats_next": share(sum(a == b for a, b in zip(words, words[1:], strict=False)), len(words)),
        "distinct_fours": share(len(set(fours)), len(fours)),
        "longest_word": max(sizes, default=0),
    }


def holds(rule: quality.Rule, of: dict[str, float]) -> bool:
    return all(of[s] > t if above else of[s] <= t for s, above, t in rule.terms)


@supplied
def test_quality_rule_by_rule(spark):
    """On a supplied table: statistics, rules, score."""
    folder = SMALL
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    ensemble = quality.fit(docs, labels)
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    of = {i: statistics(t) for i, t in texts}
    found = quality.with_statistics(docs, carry=["doc_id"]).collect()
    assert len(found) == len(texts) and ensemble.rules
    for r in found:
        assert [r[s] for s in quality.STATISTICS] == pytest.approx([of[r.row.doc_id][s] for s in quality.STATISTICS], abs=1e-12)
    want = {i: sigmoid(ensemble.intercept + sum(w for rule, w in ensemble.rules if holds(rule, of[i]))) for i, _ in texts}
    got = {r.doc_id: r.score for r in catalog.QUERIES["op6_quality"](spark, folder).collect()}
    assert got == pytest.approx(want, abs=1e-9)


@supplied
def test_quality_weights_are_those_of_the_lasso(spark):
    """At the least loss the mean gradient of a rule is the penalty against its weight's sign, and no more than it where there is no
    weight."""
    folder, penalty = SMALL, 0.02
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    ensemble = quality.fit(docs, labels, penalty=penalty)
    rows = training([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in labels.select("doc_id", "quality").collect()], 1)
    of = [statistics(t) for t, _ in rows]
    odds = [ensemble.intercept + sum(w for rule, w in ensemble.rules if holds(rule, s)) for s in of]
    error = [sigmoid(o) - y for o, (_, y) in zip(odds, rows, strict=True)]
    assert abs(math.fsum(error)) / len(rows) < penalty / 20 and ensemble.rules
    for rule, weight in ensemble.rules:
        gradient = math.fsum(e for e, s in zip(error, of, strict=True) if holds(rule, s)) / len(rows)
        assert gradient == pytest.approx(-math.copysign(penalty, weight), abs=penalty / 10)
