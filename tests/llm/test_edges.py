"""Every operator and stage on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rosterlake.llm import decontamination, mixing, quality, rules, secrets, simhash, substrings, token_counts, token_files, toxicity
from rosterlake.sources.tables import scratch_path
from tests.llm import brute
from tests.llm.conftest import CLASHING, prose, tuples


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def whole_rows(df, docs):
    """``df`` has a ``row`` that is a whole row of ``docs``."""
    assert df.schema["row"].dataType.fieldNames() == docs.columns
    assert tuples(df.select("row.*")) == tuples(docs)


# --- mixing ---------------------------------------------------------------------------------------------


def test_planned(odd, odd_rows):
    got = mixing.planned(odd)
    whole_rows(got, odd)
    rows = got.select("row.doc_id", "row.text", "row.source", "size", "source_size", "target", "copies").collect()
    sizes: dict = {}
    for d in odd_rows:
        sizes[d["source"]] = sizes.get(d["source"], 0) + len(brute.WORD.findall(d["text"] or ""))
    assert {r.source: r.source_size for r in rows} == sizes
    assert all(r["size"] == len(brute.WORD.findall(r.text or "")) and 0 <= r.copies <= 2 for r in rows)
    targets = {r.source: r.target for r in rows}
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    # Below the cap all sources have the same target by weight.
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    free = {s: targets[s] / weight[s] for s in sizes if targets[s] < 2 * sizes[s]}
    assert len(set(map(lambda x: round(x, 6), free.values()))) == 1
    level = next(iter(free.values()))
    assert all(targets[s] == 2 * sizes[s] and level * weight[s] >= 2 * sizes[s] for s in sizes if s not in free)


def test_targets_round_by_round(spark):
    sizes = spark.createDataFrame([("a", 1), ("b", 100), ("c", 10), ("d", 0), (None, 50), ("é", 1000)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(sizes, (3, 1, 2), 1.5, 2.0).collect()}
    left, open_, weights = 1.5 * 1161, {"a": 1, "b": 100, "c": 10, "d": 0, "é": 1000, None: 50}, {"a": 3, "b": 1, "c": 2, "d": 3, "é": 1, None: 2}
    want = {}
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * open_[s]]
        if not above:
            break
        for s in above:
            want[s] = 2.0 * open_.pop(s)
            left -= want[s]
    assert got == pytest.approx(want | share)


def test_mix_repeats_and_reruns(odd):
    first, again = tuples(mixing.mix(odd)), tuples(mixing.mix(odd))
    assert first == again and mixing.mix(odd).columns == odd.columns
    plan = mixing.planned(odd).select("row.*", "copies").collect()
    assert len(first) == sum(r[-1] for r in plan)


def test_mix_of_nothing(nothing, spark):
    assert mixing.mix(nothing).count() == mixing.planned(nothing).count() == 0
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert [(r.target, r.copies) for r in mixing.planned(wordless).collect()] == [(0.0, 0)] * 2


# --- token counts and files -----------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts_and_cache(spark, odd, odd_rows, name):
    cache = scratch_path(spark, "cache")
    got = token_counts.count_tokens(odd, cache, name)
    whole_rows(got, odd)
    count = token_counts._counter(name)
    want = ordered((d["doc_id"], n) for d, n in zip(odd_rows, count([d["text"] or "" for d in odd_rows]), strict=True))
    assert tuples(got.select("row.doc_id", "n_tokens")) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == len({d["text"] or "" for d in odd_rows})
    # Known texts are not encoded again; another tokenizer has counts of its own.
    assert tuples(token_counts.count_tokens(odd, cache, name).select("row.doc_id", "n_tokens")) == want
    assert spark.read.parquet(cache).count() == stored.count()
    token_counts.count_tokens(odd.limit(3), cache, "word_bpe_49k.json").count()
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def test_counts_come_from_the_cache(spark):
    docs, cache = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id bigint, text string"), scratch_path(spark, "cache")
    token_counts.count_tokens(docs.limit(0), cache).count()
    assert spark.read.parquet(cache).count() == 0
    token_counts.count_tokens(docs.where("doc_id = 1"), cache).count()
    (row,) = spark.read.parquet(cache).collect()
    doctored = spark.createDataFrame([(row.tokenizer, row.content, 77)], token_counts.CACHE)
    doctored.write.mode("overwrite").parquet(cache)
    assert tuples(token_counts.count_tokens(docs, cache).select("row.doc_id", "n_tokens"))[0] == (1, 77)


def test_counts_beyond_what_is_broadcast(spark, odd, monkeypatch):
    usual = tuples(token_counts.count_tokens(odd, scratch_path(spark, "cache")).select("row.doc_id", "n_tokens"))
    monkeypatch.setattr(token_counts, "FEW", 0)
    assert tuples(token_counts.count_tokens(odd, scratch_path(spark, "cache")).select("row.doc_id", "n_tokens")) == usual


@pytest.mark.parametrize("name, segment", [("word_bpe_49k.json", token_files.SEGMENT), ("word_bpe_49k.json", 50), ("byte_bpe_50k.json", 1000)])
def test_files_round_trip(spark, odd, odd_rows, name, segment):
    path = scratch_path(spark, "files")
    token_files.write_tokens(odd, path, tokenizer=name, end_id=2, segment=segment)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    encode = token_files.Encoder(name)._whole
    width = token_files.Encoder(name).kind.itemsize
    want = []
    for d in odd_rows:
        ids = encode(d["text"] or "")
        want.append((d["doc_id"], b"".join(ids[i : i + width].ljust(4, b"\0") for i in range(0, len(ids), width)) + b"\2\0\0\0"))
    assert ordered((r.doc_id, bytes(r.ids)) for r in got) == ordered(want)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    assert [r.doc_id for r in got] == sorted((d["doc_id"] for d in odd_rows), key=lambda i: (i is not None, i))
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    segments = spark.read.parquet(path).orderBy("shard", "segment").collect()
    picked = [(s["keys"][i], token_files.document_ids(s, i).astype("<u4").tobytes()) for s in segments for i in range(len(s["keys"]))]
    assert picked == [(r.doc_id, bytes(r.ids)) for r in got]


def test_files_of_nothing(spark, nothing):
    path = scratch_path(spark, "files")
    token_files.write_tokens(nothing, path)
    assert token_files.read_tokens(spark, path).collect() == []


# --- classifiers ----------------------------------------------------------------------------------------


def test_toxicity(odd, nothing, labels):
    model = toxicity.fit(odd, labels)
    got = toxicity.scored(odd, model)
    whole_rows(got, odd)
    assert all(0 <= r.score <= 1 for r in got.select("score").collect())
    assert toxicity.scored(nothing, model).count() == 0
    blank = toxicity.fit(odd, labels.limit(0))
    assert {r.score for r in toxicity.scored(odd, blank).collect()} == {0.5}
    assert {r.score for r in toxicity.scored(odd, toxicity.fit(nothing, labels)).collect()} == {0.5}


def test_quality(odd, nothing, labels):
    ensemble = quality.fit(odd, labels)
    got = quality.scored(odd, ensemble)
    whole_rows(got, odd)
    assert all(0 <= r.score <= 1 for r in got.select("score").collect())
    assert quality.scored(nothing, ensemble).count() == 0
    for none in (quality.fit(odd, labels.limit(0)), quality.fit(nothing, labels)):
        assert {r.score for r in quality.scored(odd, none).collect()} == {0.5}


# --- substrings and benchmark ---------------------------------------------------------------------------


def test_substrings(odd, odd_rows, nothing):
    got = substrings.without_repeats(odd)
    whole_rows(got, odd)
    found = tuples(got.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256)))
    assert found == ordered(brute.windows_removed(odd_rows))
    assert substrings.without_repeats(nothing).count() == 0


@pytest.mark.parametrize("window, gram", [(5, 2), (8, 8), (3, 1), (1, 1), (20, 3)])
def test_substrings_of_other_sizes(odd, odd_rows, window, gram):
    got = substrings.without_repeats(odd, window=window, gram=gram, carry=["doc_id"])
    assert tuples(got.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256))) == ordered(brute.windows_removed(odd_rows, window))


@pytest.mark.parametrize("index_rows", [decontamination.INDEX_ROWS, 0])
@pytest.mark.parametrize("window", [10, 4, 1])
def test_benchmark(odd, odd_rows, items, index_rows, window):
    got = decontamination.judged(odd, items, window=window, index_rows=index_rows)
    whole_rows(got, odd)
    ids = F.col("items")
    found = tuples(got.select("row.doc_id", "n_words", "n_hit", F.size(F.array_compact(ids)), decontamination.digest(F.array_compact(ids)), F.col("n_hit") > 0))
    assert found == ordered(brute.benchmark_hits(odd_rows, [r.asDict() for r in items.collect()], window))


@pytest.mark.parametrize("index_rows", [decontamination.INDEX_ROWS, 0])
def test_large_ids_beside_one_that_is_null(spark, index_rows):
    """Ids that a float can't tell apart."""
    one, two = prose(12, 5), prose(12, 6)
    items = spark.createDataFrame([(2**53, one), (2**53 + 1, two), (None, one), (2**63 - 1, two)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, one + " x " + two), (2, two), (3, "x")], "doc_id bigint, text string")
    got = decontamination.judged(docs, items, index_rows=index_rows)
    found = got.select("row.doc_id", F.array_sort(F.array_compact("items")).alias("ids")).collect()
    assert {r.doc_id: r.ids for r in found} == {1: [2**53, 2**53 + 1, 2**63 - 1], 2: [2**53 + 1, 2**63 - 1], 3: []}


@pytest.mark.parametrize("index_rows", [decontamination.INDEX_ROWS, 0])
def test_ids_that_are_text(spark, items, odd, index_rows):
    named = items.withColumn("item_id", F.concat(F.lit("i"), "item_id"))
    by_number, by_name = (decontamination.judged(odd, i, index_rows=index_rows, carry=["doc_id"]).select("row.doc_id", F.array_compact("items").alias("ids")) for i in (items, named))
    assert tuples(by_name) == tuples(by_number.select("doc_id", F.transform("ids", lambda i: F.concat(F.lit("i"), i))))


@pytest.mark.parametrize("index_rows", [decontamination.INDEX_ROWS, 0])
def test_empty_benchmark(odd, nothing, items, index_rows):
    assert tuples(decontamination.decontaminated(odd, items.limit(0), index_rows=index_rows)) == tuples(odd)
    assert decontamination.decontaminated(nothing, items, index_rows=index_rows).columns == nothing.columns


# --- rules and secrets ----------------------------------------------------------------------------------


def test_rules(odd, odd_rows, nothing):
    order = rules.ordered(odd)
    assert sorted(r.name for r in order) == sorted(r.name for r in rules.RULES)
    got = rules.judged(odd, order, measures=list(rules.MEASURES))
    whole_rows(got, odd)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    found = got.select("row.doc_id", *rules.MEASURES, failed)
    assert tuples(found) == ordered(brute.rule_counts(odd_rows))
    verdicts = {tuple(tuples(rules.judged(odd, o, carry=["doc_id"]).select("row.doc_id", "kept"))) for o in (order, rules.RULES, rules.RULES[::-1])}
    assert len(verdicts) == 1
    assert rules.filtered(odd).columns == odd.columns
    assert rules.filtered(nothing).count() == 0


def test_secrets(odd, odd_rows, nothing):
    got = secrets.scanned(odd, carry=odd.columns)
    whole_rows(got, odd)
    base = F.filter("spans", lambda s: s["kind"] < 3)
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k))
    assert tuples(got.select("row.doc_id", n(0), n(1), n(2), F.sha2(secrets.shown(base), 256))) == ordered(brute.base_spans(odd_rows))
    assert secrets.scanned(nothing).count() == 0


def test_ownership(spark):
    key, example = "Zq" + "1a" * 12, "Zz9" + "b2" * 12
    rows = [(1, f"see {key} é", "a"), (2, f"é{example}", "a"), (3, f"x {example}", "b"), (4, f"y {example}", "c"), (5, f"token={example}", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r[0]: (r[1], r[2]) for r in secrets.scanned(docs).select("row.doc_id", secrets.shown(F.col("spans")), "spans").collect()}
    assert got[1][0] == f"opaque:4:{4 + len(key)}" and got[1][1][0].n_owners == 1
    assert [got[i][0] for i in (2, 3, 4)] == ["", "", ""]
    (span,) = got[5][1]
    assert (span.kind, span.n_owners, span.n_repositories, span.live) == (0, 4, 4, False)


def test_copies_within_one_owner(spark):
    """A value in many repositories is copied, also if all are one owner's."""
    few, many = "Zq" + "1a" * 12, "Zz9" + "b2" * 12
    rows = [(i, f"{many} {few if i < 9 else ''}", "a") for i in range(10)]
    got = secrets.scanned(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    assert {r.doc_id: r.spans for r in got.select("row.doc_id", secrets.shown(F.col("spans")).alias("spans")).collect()} == {
        i: f"opaque:{len(many) + 1}:{len(many) + 1 + len(few)}" if i < 9 else "" for i in range(10)
    }


def test_very_many_matches(spark):
    """Places are right beyond a block, and the time does not grow with the square."""
    import time

    n = 40_000
    text = "".join(f"é {i} token = 'abcdefgh{i % 7}' " for i in range(n))
    docs = spark.createDataFrame([(1, text, "a")], "doc_id bigint, text string, source string")
    begun = time.perf_counter()
    (row,) = secrets.scanned(docs).select(secrets.shown(F.col("spans")).alias("spans")).collect()
    assert time.perf_counter() - begun < 40
    want = [(m.start(), m.end()) for m in brute.ASSIGN.finditer(text)]
    assert len(want) == n and row.spans == ",".join(f"assign:{a}:{b}" for a, b in want)


# --- near duplicates ------------------------------------------------------------------------------------


def test_simhash(odd, odd_rows, nothing):
    got = simhash.with_components(odd, carry=odd.columns)
    whole_rows(got, odd)
    found = got.select("row.doc_id", F.lower(F.lpad(F.hex(got["fingerprint"]), 16, "0")), "component_id")
    assert tuples(found) == ordered(brute.simhash(odd_rows))
    assert simhash.with_components(nothing).count() == 0
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({c for _, _, c in brute.simhash(odd_rows)})
    assert simhash.deduplicated(nothing).count() == 0


# --- the pipeline ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("name, function", corpus_pipeline.STAGES)
def test_stage(spark, odd, nothing, items, labels, tmp_path, name, function):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    last = name == corpus_pipeline.STAGES[-1][0]
    for docs in (odd, nothing):
        got = function(spark, docs, str(tmp_path))
        assert last or got.columns == docs.columns
        assert got.count() <= 2 * docs.count()
    assert set(CLASHING) < set(odd.columns)
