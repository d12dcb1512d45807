"""Substring dedup by seed and extend.

A window is ``window`` consecutive words of a document. Each window's seed is an anchor: of the hashes of ``gram`` words that
it holds the smallest, the last such one (winnowing), so equal windows have equal anchors. The neighbouring windows with
the same anchor occurrence make a run, the longest stretch that the anchor alone can stand for.

1. Documents are joined on anchors: those of one document alone seed nothing and go.
2. Runs that are equal as a whole are settled as a whole: all but that of the smallest document are repeated.
3. Where an anchor has different runs, the one document that stands for each run extends it window by window, and its
   windows are settled likewise. So a group of copies of any size counts once, and no pairs are made.

Maximal repeats are the unions of the windows that are settled as repeated. Runs and windows are compared by
anchor and content, two 64-bit hashes of which both have to agree, within what shares the anchor.

A window is repeated if a document with a smaller doc_id has it. Null texts have no words. A null doc_id is neither smaller
nor larger than any, so such a document loses nothing. Rows of equal doc_id don't take words from each other. An empty
table stays empty. Other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.carry import computed
from rosterlake.llm.keys import free, stage
from rosterlake.llm.words import Texts, grams, mix, passes, rightmost_minimum, sequence

WINDOW = 50
GRAM = 12


class Runs:
    """Of a pass of texts: windows by first word ``at`` with their ``anchor`` and ``window`` hash, the ``run`` each belongs
    to, and by run its first and last window (as numbers of windows), ``run_hash`` and ``run_anchor``."""

    def __init__(self, texts: Texts, window: int, gram: int):
        n_words = len(texts.start)
        self.at = np.flatnonzero(texts.within(window)) if n_words >= window else np.zeros(0, np.int64)
        if not len(self.at):
            self.anchor = self.window = self.run_hash = self.run_anchor = np.zeros(0, np.uint64)
            self.run = self.first = self.last = np.zeros(0, np.int64)
            return
        prefix = sequence(texts.hashes())
        small = grams(prefix, n_words, gram)
        place = rightmost_minimum(small, window - gram + 1)[self.at]
        self.anchor, self.window = small[place], prefix(self.at, self.at + window)
        # A later window of another text, or with another anchor, begins a run.
        begins = np.concatenate([[True], (place[1:] != place[:-1]) | (self.at[1:] != self.at[:-1] + 1)])
        self.run, self.first = np.cumsum(begins) - 1, np.flatnonzero(begins)
        self.last = np.concatenate([self.first[1:], [len(self.at)]]) - 1
        begin, end = self.at[self.first], self.at[self.last] + window
        self.run_anchor = self.anchor[self.first]
        self.run_hash = mix(prefix(begin, end) ^ mix((place[self.first] - begin).astype(np.uint64)))


def _once(of: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the distinct pairs."""
    return np.unique(mix(values ^ mix(of.astype(np.uint64))), return_index=True)[1]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _held(part: pa.RecordBatch, column: str) -> np.ndarray:
    """The numbers that a row lists, tied to the row."""
    lists = part.column(column)
    of = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
    return mix(np.asarray(lists.flatten(), np.int64).view(np.uint64) ^ mix(of.astype(np.uint64)))


def _isin(docs: np.ndarray, values: np.ndarray, held: np.ndarray) -> np.ndarray:
    return np.isin(mix(values ^ mix(docs.astype(np.uint64))), held)


def _runs(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                texts = Texts(part.column("text"))
                found = Runs(texts, window, gram)
                docs = texts.doc[found.at[found.first]]
                once = _once(docs, found.run_hash ^ found.run_anchor)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(docs[once])), _signed(found.run_anchor[once]), _signed(found.run_hash[once])],
                    ["doc_id", "anchor", "hash"],
                )

    return run


def _windows(window: int, gram: int):
    """The windows of the runs that a row lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                texts = Texts(part.column("text"))
                found = Runs(texts, window, gram)
                docs = texts.doc[found.at]
                asked = _isin(texts.doc[found.at[found.first]], found.run_hash, _held(part, "runs"))[found.run]
                docs, anchors, hashes = docs[asked], found.anchor[asked], found.window[asked]
                once = _once(docs, hashes ^ anchors)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(docs[once])), _signed(anchors[once]), _signed(hashes[once])],
                    ["doc_id", "anchor", "hash"],
                )

    return run


def _kept(window: int, gram: int):
    def compute(part: pa.RecordBatch) -> list[pa.Array]:
        texts = Texts(part.column("text"))
        gone, held = np.zeros(len(texts.start) + 1, np.int64), _held(part, "repeated")
        if len(held):
            found = Runs(texts, window, gram)
            whole = _isin(texts.doc[found.at[found.first]], found.run_hash, held)[found.run]
            at = found.at[whole | _isin(texts.doc[found.at], found.window, held)]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + window, -1)
        removed = np.cumsum(gone[:-1]) > 0
        counts = texts.per_text(np.ones(len(removed))), texts.per_text(removed)
        return [*map(pa.array, counts), texts.joined(~removed).cast(pa.string())]

    return compute


def _repeats(found: DataFrame, firsts: DataFrame) -> DataFrame:
    """Which documents of ``found`` have an anchor and hash that a smaller one has."""
    several = firsts.where("first < last").select("anchor", "hash", "first")
    return found.join(several, ["anchor", "hash"]).where("doc_id > first").select("doc_id", "hash")


def _firsts(found: DataFrame) -> DataFrame:
    return found.groupBy("anchor", "hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


def without_repeats(
    docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, carry: Sequence[str] | None = None
) -> DataFrame:
    """Per document ``row`` (the columns ``carry``, or all), ``n_words``, ``n_removed`` and ``kept``, the words that no
    repeat covers, with one space between."""
    texts = docs.select("doc_id", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, anchor bigint, hash bigint"
    runs = stage(texts.where("doc_id is not null").mapInArrow(_runs(window, gram), schema), "runs")
    # 1. Anchors of several documents. What is joined with occurrences is staged first here and below: nothing then stands
    # between it and the join, and adaptive execution can split an anchor that very many documents have.
    shared = runs.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    seeded = stage(runs.join(stage(shared.select("anchor"), "shared-anchors"), "anchor", "left_semi"), "seeded")
    # 2. Whole runs.
    firsts = stage(_firsts(seeded), "first-runs")
    # 3. Windows, where an anchor has different runs.
    differing = firsts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    asked = (
        firsts.join(stage(differing, "differing-anchors"), "anchor", "left_semi")
        .groupBy(F.col("first").alias("of_doc"))
        .agg(F.collect_list("hash").alias("runs"))
    )
    extended = texts.join(asked, F.col("doc_id") == F.col("of_doc")).select("doc_id", "text", "runs")
    windows = stage(extended.mapInArrow(_windows(window, gram), schema), "windows")
    repeats = _repeats(seeded, firsts).union(_repeats(windows, stage(_firsts(windows), "first-windows")))
    listed = repeats.groupBy(F.col("doc_id").alias("of_doc")).agg(F.collect_list("hash").alias("hashes"))
    name = free(docs, "repeated")
    packed = docs.select(F.struct("*").alias("all"))
    joined = packed.join(listed, F.col("all.doc_id") == F.col("of_doc"), "left").select("all.*", F.col("hashes").alias(name))
    return computed(
        joined, _kept(window, gram), "n_words bigint, n_removed bigint, kept string",
        carry=docs.columns if carry is None else carry, given={"repeated": F.col(name)},
    )


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
with doc as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), place as (
  select doc_id, w, unnest(range(1, len(w) - 48)) as i from doc where len(w) >= 50
), win as (
  select doc_id, i, sha256(array_to_string(w[i : i + 49], ' ')) as h from place
), first as (
  select h, min(doc_id) as first_id from win group by h having min(doc_id) < max(doc_id)
), gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as p from win join first using (h) where doc_id > first_id
), word as (
  select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from doc
), kept as (
  select word.doc_id, count(gone.p) as n_removed, coalesce(string_agg(word, ' ' order by word.p) filter (gone.p is null), '') as kept
  from word left join gone on gone.doc_id = word.doc_id and gone.p = word.p group by word.doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from doc left join kept using (doc_id)
"""
