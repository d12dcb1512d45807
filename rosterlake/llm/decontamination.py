"""Benchmark decontamination by winnowing.

Words are A-Z made small, then runs of letters, digits and anything beyond ASCII. A window is ``window`` consecutive words of an
item; an item with fewer words, but not none, is one window. Of each stretch of 6 (for windows of 10) hashes of 5 words the
smallest, the last such one, is its fingerprint, so a document that holds a window has its fingerprint too. Training and
benchmark fingerprints are joined and a hit is extended to the whole window, which has to agree.

Below ``index_rows`` windows the benchmark is a sorted array that every task gets (at most some 50 MB), and a document is
read once. Items are numbered by Spark and come back as their ids by the table of numbers, which ships with the array; an id is
never a literal of the plan or a float. Beyond, fingerprints and then windows are joined as tables.

Null texts have no words, an item with a null id marks words but is not listed, items of equal id are one, repeated
documents are each judged alike. An empty benchmark marks nothing. Documents' other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from rosterlake.llm.carry import computed
from rosterlake.llm.keys import free, stage
from rosterlake.llm.words import LETTERS, Texts, grams, mix, passes, rightmost_minimum, sequence

WINDOW = 10
INDEX_ROWS = 1_000_000


class Fingerprints:
    """Of a pass of texts: the windows of ``n`` words by first word ``at``, their hash and their fingerprint."""

    def __init__(self, texts: Texts, n: int):
        k = max(1, n // 2)
        prefix, n_words = sequence(texts.hashes()), len(texts.start)
        self.at = np.flatnonzero(texts.within(n)) if n_words >= n else np.zeros(0, np.int64)
        if not len(self.at):
            self.window = self.print = np.zeros(0, np.uint64)
            return
        small = grams(prefix, n_words, k)
        self.print = small[rightmost_minimum(small, n - k + 1)][self.at]
        self.window = prefix(self.at, self.at + n)


def _read(column: pa.Array) -> Texts:
    return Texts(column, LETTERS, lower=True)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _item_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                texts = _read(part.column("text"))
                n_words = texts.per_text(np.ones(len(texts.start)))
                for n in {min(window, int(x)) for x in n_words if x}:
                    found = Fingerprints(texts, n)
                    mine = np.flatnonzero((n_words == n) | ((n == window) & (n_words > n)))
                    keep = np.isin(texts.doc[found.at], mine)
                    at, items = found.at[keep], part.column("item_id")
                    yield pa.RecordBatch.from_arrays(
                        [items.take(pa.array(texts.doc[at])), pa.array(np.full(len(at), n, np.int32)), _signed(found.print[keep]), _signed(found.window[keep])],
                        ["item_id", "n", "print", "window"],
                    )

    return run


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The distinct windows of the items: ``item_id``, ``n`` words, ``print``, ``window``."""
    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select("item_id", "text").mapInArrow(_item_windows(window), f"item_id {kind}, n int, print bigint, window bigint")
    return rows.distinct()


class Index:
    """All windows of a benchmark of bounded size."""

    def __init__(self, rows: pa.Table, ids: pa.Array):
        self.sizes = {}
        # The number of a window's item; none, if the id is null.
        item = pc.fill_null(pc.index_in(rows.column("item_id"), value_set=ids, skip_nulls=True), -1)
        item, sizes, prints, windows = (x.to_numpy() for x in (item, *map(rows.column, ("n", "print", "window"))))
        for n in np.unique(sizes).tolist():
            order = np.flatnonzero(sizes == n)
            order = order[np.lexsort((item[order], windows[order].view(np.uint64)))]
            of_size = prints[order].view(np.uint64)
            self.sizes[n] = (np.unique(of_size), windows[order].view(np.uint64), of_size, item[order].astype(np.int64))

    def hits(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are hit, and pairs of text and item (a number; -1: without id)."""
        change, docs, items = np.zeros(len(texts.start) + 1, np.int64), [], []
        for n, (prints, windows, window_prints, window_items) in self.sizes.items():
            found = Fingerprints(texts, n)
            place = np.searchsorted(prints, found.print)
            near = np.flatnonzero(prints[np.minimum(place, len(prints) - 1)] == found.print)
            at, window, print_ = found.at[near], found.window[near], found.print[near]
            low, high = np.searchsorted(windows, window, "left"), np.searchsorted(windows, window, "right")
            hit = np.flatnonzero(high > low)
            hit = hit[window_prints[low[hit]] == print_[hit]]
            np.add.at(change, at[hit], 1)
            np.add.at(change, at[hit] + n, -1)
            # Of one window in one text the items are listed once.
            pair = np.unique(np.stack([texts.doc[at[hit]], low[hit], high[hit]]), axis=1)
            count = pair[2] - pair[1]
            docs.append(np.repeat(pair[0], count))
            items.append(window_items[np.repeat(pair[1] - np.cumsum(count) + count, count) + np.arange(count.sum())])
        pairs = np.stack([np.concatenate([np.zeros(0, np.int64), *docs]), np.concatenate([np.zeros(0, np.int64), *items])])
        pairs = np.unique(pairs, axis=1)
        return np.cumsum(change[:-1]) > 0, *pairs[:, pairs[1] >= 0]


def _lists(docs: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    """Lists by text of values that are sorted by text."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(docs, np.arange(n + 1)).astype(np.int32)), values)


def _judged(index: Index, ids: pa.Array):
    def compute(part: pa.RecordBatch) -> list[pa.Array]:
        texts = _read(part.column("text"))
        hit, docs, items = index.hits(texts)
        counts = texts.per_text(np.ones(len(hit))), texts.per_text(hit)
        return [*map(pa.array, counts), _lists(docs, ids.take(pa.array(items)), len(texts))]

    return compute


def _near(sizes: list[int]):
    """The distinct windows of every document, ``doc`` being its number in ``of``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                texts = _read(part.column("text"))
                for n in sizes:
                    found = Fingerprints(texts, n)
                    _, once = np.unique(mix(found.window ^ mix(texts.doc[found.at].astype(np.uint64))), return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key").take(pa.array(texts.doc[found.at[once]])), pa.array(np.full(len(once), n, np.int32)), _signed(found.print[once]), _signed(found.window[once])],
                        ["key", "n", "print", "window"],
                    )

    return run


def _marked(sizes: list[int]):
    """Words, and words within the windows that the row lists."""

    def compute(part: pa.RecordBatch) -> list[pa.Array]:
        texts, hits = _read(part.column("text")), part.column("windows")
        of = np.repeat(np.arange(len(texts)), np.asarray(hits.value_lengths().fill_null(0)))
        listed = mix(np.asarray(hits.flatten(), np.int64).view(np.uint64) ^ mix(of.astype(np.uint64)))
        change = np.zeros(len(texts.start) + 1, np.int64)
        for n in sizes:
            found = Fingerprints(texts, n)
            at = found.at[np.isin(mix(found.window ^ mix(texts.doc[found.at].astype(np.uint64))), listed)]
            np.add.at(change, at, 1)
            np.add.at(change, at + n, -1)
        hit = np.cumsum(change[:-1]) > 0
        return [*map(pa.array, (texts.per_text(np.ones(len(hit))), texts.per_text(hit)))]

    return compute


def judged(
    docs: DataFrame, items: DataFrame, *, window: int = WINDOW, index_rows: int = INDEX_ROWS, carry: Sequence[str] | None = None
) -> DataFrame:
    """Per document ``row`` (the columns ``carry``, or all), ``n_words``, ``n_hit`` words and ``items``: ids whose windows
    it holds."""
    kind = items.schema["item_id"].dataType
    windows = stage(item_windows(items, window), "benchmark-windows")
    if windows.count() <= index_rows:
        # At most as many ids as windows. Their order is that of the list that every task gets.
        ids = windows.select("item_id").where("item_id is not null").distinct().orderBy("item_id").toArrow().column("item_id").combine_chunks()
        rows = windows.select("item_id", "n", "print", "window").toArrow()
        found = computed(
            docs, _judged(Index(rows, ids), ids), f"n_words bigint, n_hit bigint, items array<{kind.simpleString()}>", carry=carry
        )
        return found

    sizes = [r[0] for r in windows.select("n").distinct().collect()]
    # A document's key is never null and differs for different documents; repeated rows share it.
    key = F.concat_ws(":", F.xxhash64("doc_id", "text"), F.xxhash64("text", "doc_id"))
    mine = docs.select(key.alias("key"), "text").mapInArrow(_near(sizes), "key string, n int, print bigint, window bigint")
    prints = windows.select("n", "print").distinct()
    hits = stage(mine.join(prints, ["n", "print"], "left_semi").join(windows, ["n", "print", "window"]), "benchmark-hits")
    listed = hits.groupBy("key").agg(F.collect_set("window").alias("windows"), F.array_sort(F.collect_set("item_id")).alias("items"))
    found_in = free(docs, "windows_and_items")
    joined = docs.select(F.struct("*").alias("all"), key.alias("key")).join(listed, "key", "left").select(
        "all.*", F.struct("windows", "items").alias(found_in)
    )
    found = computed(
        joined, _marked(sizes), "n_words bigint, n_hit bigint", given={"windows": F.col(found_in)["windows"]},
        carry=[*(docs.columns if carry is None else carry), found_in],
    )
    items_of = F.coalesce(F.col("row").getField(found_in)["items"], F.array().cast(ArrayType(kind)))
    return found.select(F.col("row").dropFields(found_in).alias("row"), "n_words", "n_hit", items_of.alias("items"))


def decontaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The documents that hold no window of the benchmark."""
    return judged(docs, items, **settings).where("n_hit = 0").select("row.*")


def digest(items: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(items.cast("array<string>")), ","), 256)


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return judged(docs, items, carry=["doc_id"]).select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
with doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), sized as (
  select item_id, w, least(len(w), 10) as n from item where len(w) > 0
), wanted as (
  select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as gram
  from (select *, unnest(range(1, len(w) - n + 2)) as i from sized)
), place as (
  select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from doc, (select distinct n from wanted) where len(w) >= n
), held as (
  select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as gram from place
), hit as (
  select doc_id, n, i, item_id from held join wanted using (n, gram)
), word as (
  select doc_id, count(distinct p) as n_hit from (select distinct doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id
), listed as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, item_id::varchar as id from hit where item_id is not null) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join word using (doc_id) left join listed using (doc_id)
"""
