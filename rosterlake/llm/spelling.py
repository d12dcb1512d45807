"""Spelling variants grouped by an index of variable-length grams.

1. Words are counted over the whole corpus. The gram dictionary holds every gram of two letters, and those of three whose first
   two are frequent among the words: a gram that would have a long list is split into longer ones.
2. A word is decomposed into the longest dictionary gram at each place, without those inside an earlier one.
3. For every place of a possible edit it is known which grams of the word it may affect: those over the place, one of two letters
   just before it that the new letter could make longer, and one just after it that a longer gram could swallow. The others are
   in every word that differs by this edit, at the same distance from the start or from the end. Of a word of six letters or more
   at least one always is.
4. So for each place the lists of the last unaffected gram before and of the first one after are merged, both with all that lies
   outside between them and the word's ends, for words of the same length, a letter less and one more. Words that meet there are
   verified by edit distance.

There are at most 729,000 grams of three letters, as the alphabet has 90; the dictionary is a bitmap of that many bits in every
task. Everything else is joined by shuffle, and lists are never collected.

Words are letters a-z and U+00C0 to U+00FF after A-Z are made small. Null and empty texts have none; a null doc_id is written as
an empty text. Repeated rows count each. An empty table has no words. Very long runs of letters are words like any other. Other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.keys import stage
from rosterlake.llm.words import Texts, passes

LEAST_LETTERS = 6
LEAST_COUNT = 5
#: One run in so many loses a letter.
DAMAGED = 199
#: A form occurs so many times as often as the word.
RATIO = 5
#: A gram of two letters is split where more than this share of all such grams is equal to it.
FREQUENT = 0.001
#: Letters a-z, then U+00C0 to U+00FF.
ALPHABET = 90
#: Letters of a word that no unaffected gram covers, at most, and one for the length of the other word.
GAP = 9
_LONG = 64

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
#: The first byte of U+00C0 to U+00FF, and of nothing else.
_LEAD = 0xC3


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> 1), c >> 1)
    return c


_CRC = _crc_table()


def _checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC-32 of each run, going on from the checksum ``begun``."""
    state = begun ^ np.uint32(0xFFFFFFFF)
    sizes = end - start
    order = np.argsort(-sizes, kind="stable")
    n_long = int((sizes > _LONG).sum())
    for k in order[:n_long].tolist():
        state[k] = zlib.crc32(data[start[k] : end[k]].tobytes(), int(begun[k])) ^ 0xFFFFFFFF
    order = order[n_long:]
    active = state[order]
    at, left = start[order], sizes[order]
    for j in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -j, side="left"))
        now = active[:n]
        active[:n] = _CRC[(now ^ data[at[:n] + j]) & 0xFF] ^ (now >> 8)
    state[order] = active
    return state ^ np.uint32(0xFFFFFFFF)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each pass and how often they occur in it."""
    for batch in batches:
        for part in passes(batch):
            texts = Texts(part.column("text"), lower=True)
            data = texts.data
            lead = data == _LEAD
            inside = _LETTER[data] | lead
            inside[1:] |= lead[:-1]
            edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
            start, end = edges[0::2], edges[1::2]
            leads = np.concatenate([[0], np.cumsum(lead, dtype=np.int32)])
            letters = (end - start) - (leads[end] - leads[start])
            keep = letters >= LEAST_LETTERS
            start, end, letters = start[keep], end[keep], letters[keep]
            doc = np.searchsorted(texts.bounds, start, side="right") - 1
            ids = part.column("doc_id").to_pylist()
            begun = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids] or [0], np.uint32)
            sums = _checksums(data, start, end, begun[doc])
            hit = sums % DAMAGED == 0
            found = [_counted(data, start[~hit], end[~hit])]
            damaged = []
            for a, b, n, c in zip(start[hit].tolist(), end[hit].tolist(), letters[hit].tolist(), sums[hit].tolist()):
                if n > LEAST_LETTERS:
                    word = data[a:b].tobytes().decode()
                    damaged.append(word[: c % n] + word[c % n + 1 :])
            if damaged:
                counts = pc.value_counts(pa.array(damaged, pa.string()))
                found.append((counts.field(0), counts.field(1)))
            for words, counts in found:
                yield pa.RecordBatch.from_arrays([words, counts.cast(pa.int64())], ["word", "n"])


def _counted(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[pa.Array, pa.Array]:
    change = np.zeros(len(data) + 1, np.int8)
    change[start] += 1
    change[end] -= 1
    kept = data[np.cumsum(change[:-1], dtype=np.int8) > 0]
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    all_words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(kept.tobytes()))
    counts = pc.value_counts(all_words)
    return counts.field(0).cast(pa.string()), counts.field(1)


def counted_words(docs: DataFrame) -> DataFrame:
    """Words of enough letters and occurrences: ``word``, ``n``."""
    runs = docs.select("doc_id", "text").mapInArrow(_runs, "word string, n bigint")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- grams ----------------------------------------------------------------------------------------------


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of one length, and their letters as numbers, a row for each."""
    texts = words.to_pylist()
    sizes = np.array([len(w) for w in texts], np.int64)
    for size in np.unique(sizes):
        of_size = np.flatnonzero(sizes == size)
        points = np.frombuffer("".join(texts[i] for i in of_size).encode("utf-32-le"), "<u4").astype(np.int64).reshape(-1, size)
        yield of_size, np.where(points < 0x80, points - 0x61, points - 0xC0 + 26)


def _grams_of(letters: np.ndarray, n: int) -> np.ndarray:
    """The number of the gram of ``n`` letters at each place."""
    size = letters.shape[1] - n + 1
    code = np.zeros((len(letters), size), np.int64)
    for k in range(n):
        code = code * ALPHABET + letters[:, k : k + size]
    return code


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals = np.zeros(ALPHABET**3, np.int64)
        for _, letters in _by_length(batch.column("word")):
            totals += np.bincount(_grams_of(letters, 3).ravel(), minlength=ALPHABET**3)
        found = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(totals[found])], ["gram", "n"])


def dictionary(words: DataFrame, frequent: float = FREQUENT) -> np.ndarray:
    """Which grams of three letters are in the dictionary; a row for each letter, second and third ones along the others."""
    counts = words.select("word").mapInArrow(_gram_counts, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    found = np.array([tuple(r) for r in counts.collect()], np.int64).reshape(-1, 2)  # at most one row for each gram of the alphabet
    totals = np.zeros(ALPHABET**3, np.int64)
    totals[found[:, 0]] = found[:, 1]
    totals = totals.reshape(ALPHABET, ALPHABET, ALPHABET)
    split = totals.sum(axis=2) > frequent * totals.sum()
    return (totals > 0) & split[:, :, None]


def decomposed(letters: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For words of one length, at each place where a gram can begin: where the longest one ends, and whether it is kept."""
    size = letters.shape[1]
    starts = np.arange(size - 1)
    ends = np.broadcast_to(starts + 2, (len(letters), size - 1)).copy()
    ends[:, :-1] += grams[letters[:, :-2], letters[:, 1:-1], letters[:, 2:]]
    before = np.maximum.accumulate(ends, axis=1)
    kept = np.ones_like(ends, bool)
    kept[:, 1:] = ends[:, 1:] > before[:, :-1]
    return ends, kept


def unaffected(letters: np.ndarray, grams: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each place of an edit: how many letters at the start and at the end the unaffected grams before and after it reach
    over, and how many such grams there are."""
    size = letters.shape[1]
    ends, kept = decomposed(letters, grams)
    starts = np.arange(size - 1)
    pairs = letters[:, :-1], letters[:, 1:]
    grows, is_swallowed = grams.any(axis=2)[pairs], grams.any(axis=0)[pairs]
    short = ends == starts + 2
    # A letter replaced or removed lies between the two, an inserted one between ``before`` and the next letter.
    for before, after in [(i, i + 1) for i in range(size)] + [(j, j) for j in range(size + 1)]:
        left = kept & (ends <= before)
        if 2 <= before <= size:
            left[:, before - 2] &= ~(short[:, before - 2] & grows[:, before - 2])
        right = kept & (starts >= after)
        if after < size - 1:
            right[:, after] &= ~(short[:, after] & is_swallowed[:, after])
        first = np.where(right, starts, size).min(axis=1)
        yield np.where(left, ends, 0).max(axis=1), size - first, (left | right).sum(axis=1)


def _keyed(of: np.ndarray, words: list[str], a: np.ndarray, b: np.ndarray, longer: int = 0) -> pa.RecordBatch:
    """Both ends of words, with the length of the words that are listed under them."""
    chosen = [words[i] for i in of.tolist()]
    keys = [f"{w[:x]}{len(w) + longer}{w[len(w) - y :]}" for w, x, y in zip(chosen, a.tolist(), b.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(chosen, pa.string())], ["key", "word"])


def _asked(grams: np.ndarray):
    """The pairs of lists that each word merges. Of two pairs, one within the other, the shorter finds all that the longer does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for of_size, letters in _by_length(batch.column("word")):
                reach = [(a, b) for a, b, _ in unaffected(letters, grams)]
                a, b = (np.stack(x, axis=1) for x in zip(*reach))
                need = np.ones_like(a, bool)
                for k in range(a.shape[1]):
                    within = (a <= a[:, [k]]) & (b <= b[:, [k]])
                    same = (a == a[:, [k]]) & (b == b[:, [k]])
                    same[:, k:] = False
                    need[:, k] = ~((within & ((a < a[:, [k]]) | (b < b[:, [k]]))) | same).any(axis=1)
                rows, places = np.nonzero(need)
                for longer in (-1, 0, 1):
                    yield _keyed(of_size[rows], words, a[rows, places], b[rows, places], longer)

    return run


def _listed(grams: np.ndarray):
    """The pairs of lists that hold each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for of_size, letters in _by_length(batch.column("word")):
                size = letters.shape[1]
                ends, kept = decomposed(letters, grams)
                ended = np.zeros((len(letters), size + 1), bool)
                begun = np.zeros((len(letters), size + 1), bool)
                ended[:, 0] = begun[:, size] = True
                rows, places = np.nonzero(kept)
                ended[rows, ends[rows, places]] = True
                begun[rows, places] = True
                for a in range(size + 1):
                    for start in range(a, min(size, a + GAP) + 1):
                        held = np.flatnonzero(ended[:, a] & begun[:, start])
                        if len(held) and (a or start < size):
                            yield _keyed(of_size[held], words, np.full(len(held), a), np.full(len(held), size - start))

    return run


def near_pairs(words: DataFrame, frequent: float = FREQUENT) -> DataFrame:
    """All pairs ``word``, ``other`` (in both orders) that differ by one inserted, deleted or replaced letter."""
    grams = dictionary(words, frequent)
    asked = words.select("word").mapInArrow(_asked(grams), "key string, word string")
    lists = words.select("word").mapInArrow(_listed(grams), "key string, word string").withColumnRenamed("word", "other")
    close = F.levenshtein("word", "other", 1) == 1
    return stage(asked, "asked-lists").join(stage(lists, "gram-lists"), "key").where(close).select("word", "other").distinct()


# --- forms ----------------------------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """The last of the forms that lead on from each ``word``, by doubling: forms occur five times as often each, so chains are short."""
    steps = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        steps = stage(steps, "roots")
        onward = steps.select(F.col("word").alias("at"), F.col("root").alias("beyond"))
        joined = steps.join(onward, F.col("root") == F.col("at"), "left")
        if joined.where("at is not null").isEmpty():
            return steps
        steps = joined.select("word", F.coalesce("beyond", "root").alias("root"))


def variants(docs: DataFrame, *, frequent: float = FREQUENT) -> DataFrame:
    """Per word ``word``, ``n``, ``n_near`` words, ``form`` (the most frequent near word, if that is far more frequent), ``form_n``
    and ``root``."""
    words = stage(counted_words(docs), "words")
    pairs = near_pairs(words, frequent)
    sized = pairs.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    # The greatest count, then the first word.
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    nearest = sized.groupBy("word").agg(F.count("*").alias("n_near"), best)
    far = -F.col("best.less") >= RATIO * F.col("n")
    formed = stage(
        words.join(nearest, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(far, F.col("best.other")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"),
        ), "forms",
    )
    roots = _roots(formed).select(F.col("word").alias("of"), "root")
    return formed.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
with recursive crc as (
  select list(list_reduce([n::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) order by n) as tab from range(256) r(n)
), run as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) as w
  from documents
), occurrence as (
  select w, coalesce(doc_id::varchar, '') || ':' || w as keyed, count(*) as n from run where length(w) >= 6 group by all
), summed as (
  select w, n, hex(encode(keyed)) as bytes from occurrence
), hashed as (
  select w, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(0, length(bytes) // 2), lambda i: ('0x' || substr(bytes, (2 * i + 1)::int, 2))::bigint)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) as h
  from summed, crc
), damaged as (
  select n, case when h % 199 = 0 then substr(w, 1, (h % length(w))::int) || substr(w, (h % length(w) + 2)::int) else w end as word from hashed
), word as (
  select word, sum(n)::bigint as n from damaged where length(word) >= 6 group by word having sum(n) >= 5
), gap as (
  select word, n, i, substr(word, 1, i::int) || substr(word, (i + 2)::int) as rest from (select *, unnest(range(0, length(word))) as i from word)
), near as (
  select a.word, b.word as other from gap a join gap b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union
  select a.word, a.rest from gap a join word b on b.word = a.rest
  union
  select a.rest, a.word from gap a join word b on b.word = a.rest
), best as (
  select near.word, count(*) as n_near, max(o.n) as form_n, arg_min(near.other, (-o.n, near.other)) as form
  from near join word o on o.word = near.other group by near.word
), formed as (
  select word.word, word.n, coalesce(n_near, 0) as n_near, case when form_n >= 5 * n then form end as form, case when form_n >= 5 * n then form_n end as form_n
  from word left join best using (word)
), chain(word, here, depth) as (
  select word, word, 0 from formed
  union all
  select chain.word, formed.form, depth + 1 from chain join formed on formed.word = chain.here where formed.form is not null
)
select formed.word, form, root, n, n_near, form_n
from formed join (select word, arg_max(here, depth) as root from chain group by word) using (word)
"""
