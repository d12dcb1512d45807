"""Exact byte-level dedup by a suffix array, built by the difference-cover algorithm.

A window is ``window`` consecutive bytes of a text's UTF-8. In a suffix array of all texts equal windows are neighbours, so that
a comparison of adjacent prefixes finds them. The array is built in blocks that Spark deals out:

1. Each window has an anchor: of the hashes of ``gram`` bytes that it holds the smallest, the last such one. Equal windows have
   equal anchors. The neighbouring windows with the same anchor occurrence are a run, and equal runs are one string, owned by its
   smallest document: larger ones repeat it whole. Runs are dealt and sorted by anchor, once, which shows this, and which
   anchors only one document has or have only one string: these need no suffixes.
2. Strings with the same anchor are dealt to the same block, so suffixes of different blocks share no window and need no order.
   Where one anchor has more strings than ``hot``, its windows are dealt one by one, by their hash.
3. In a block the suffixes are sorted by difference cover: triples at two places of three are sorted and named, the sequence of
   names is sorted by recursion, until names are distinct or one or two in a row stand for a window or more, and the remaining
   suffixes are merged in by their first letters and the rank of the sampled suffix behind. Triples of few letters are names as
   they are; places that begin no window of a string, and that no such place needs, are not sorted.
4. Adjacent windows with an equal prefix of ``window`` bytes are one class; those of a document larger than the class's smallest
   are repeated.

A byte is removed if a window that a smaller document holds too covers it. Anchors and runs are compared by 64-bit hashes, two for
a run; windows in a block by their bytes. Null texts are empty. A null doc_id is neither smaller nor larger than any, so such a
document loses nothing. Rows of equal doc_id don't take bytes from each other. Texts of any length are read in slices of bounded
memory. An empty table stays empty. Other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.carry import computed
from rosterlake.llm.keys import free, stage, swept
from rosterlake.llm.words import mix, mixed_range, passes, slid_minimum, text_bytes

WINDOW = 50
GRAM = 20
#: Strings in a block, about.
BLOCK = 4_000
#: Different strings of one anchor that one block takes.
HOT = 4_000
#: Bytes that are hashed at a time; more than a pass of several texts has.
SLICE = 4 << 20

_VALUES = mixed_range(256, 29)
_FACTOR = 0x9E3779B97F4A7C15
_LAST = np.uint64(0xFFFFFFFF)
_STRETCH = 1 << 16
#: Triples below this are not named: three of them fit into 63 bits.
_PLAIN = 1 << 20


# --- anchors and runs -----------------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place, put together from those of 1, 2, 4 and so on."""
    part, whole, done, size = _VALUES[data], None, 0, 1
    while True:
        if gram & size:
            whole = part if whole is None else whole[: max(0, len(part) - done)] * np.uint64(pow(_FACTOR, size, 1 << 64)) + part[done : done + len(whole)]
            done += size
        if done == gram:
            return mix(whole)
        part = part[: max(0, len(part) - size)] * np.uint64(pow(_FACTOR, size, 1 << 64)) + part[size:]
        size *= 2


def _anchored(data: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the gram at each place, and for each window in its upper half that of its anchor (32 bits of it), in its lower
    half how far before the buffer's 2^32nd byte the anchor is. Worked out in stretches that stay in a processor's cache."""
    n = len(data) - window + 1
    hashes, least = np.empty(len(data) - gram + 1, np.uint64), np.empty(n, np.uint64)
    for a in range(0, n, _STRETCH):
        b = min(n, a + _STRETCH)
        found = _gram_hashes(data[a : b + window - 1], gram)
        hashes[a : a + len(found)] = found
        places = _LAST - np.arange(a, a + len(found), dtype=np.uint64)
        # The smallest, of equal ones the last.
        least[a:b] = slid_minimum((found & ~_LAST) | places, window - gram + 1)
    return hashes, least


class Runs:
    """Of texts in one buffer: by run its text ``doc``, ``first`` window, number of windows ``size``, ``anchor`` and ``hash``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, window: int, gram: int):
        parts = [self._slice(data, bounds, s, window, gram) for s in range(0, max(1, len(data) - window + 1), SLICE)]
        self.doc, self.first, self.size, self.anchor, self.hash = (np.concatenate(x) for x in zip(*parts))

    @staticmethod
    def _slice(data: np.ndarray, bounds: np.ndarray, begin: int, window: int, gram: int):
        data = data[begin : begin + SLICE + window - 1]
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if len(data) < window:
            return none
        hashes, least = _anchored(data, window, gram)
        # Windows within one text, whose last byte in the buffer is a blank behind it.
        starts = np.maximum(bounds[:-1] - begin, 0)
        stops = np.minimum(bounds[1:] - begin - window, len(least))
        begins = np.empty(len(least), bool)
        begins[0] = True
        np.not_equal(least[1:], least[:-1], out=begins[1:])
        at = 0
        for a, b in zip(starts.tolist(), stops.tolist()):
            if b > a:
                begins[at:a] = False
                begins[a] = True
                at = b
        begins[at:] = False
        first = np.flatnonzero(begins)
        if not len(first):
            return none
        doc = np.searchsorted(bounds - begin, first, side="right") - 1
        until = np.minimum(np.concatenate([first[1:], [len(least)]]), stops[doc])
        anchor, end = (_LAST - (least[first] & _LAST)).astype(np.int64), until + window - 1
        own = mix((anchor - first).astype(np.uint64) + (np.uint64(1) << np.uint64(32)) * (end - first).astype(np.uint64))
        for k in range(-(-(2 * window - gram) // gram)):
            own = mix(own * np.uint64(_FACTOR) + hashes[np.minimum(first + k * gram, end - gram)])
        return doc, first + begin, until - first, hashes[anchor], own


def _once(of: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A place of each of the distinct pairs."""
    pairs = _of_rows(of, values)
    order = np.argsort(pairs)
    pairs = pairs[order]
    return order[np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))] if len(order) else order


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _tied(part: pa.RecordBatch, values: pa.ListArray) -> np.ndarray:
    """The numbers that rows list, each tied to its row."""
    of = np.repeat(np.arange(len(values)), np.asarray(values.value_lengths().fill_null(0)))
    return mix(np.asarray(values.flatten(), np.int64).view(np.uint64) ^ mix(of.astype(np.uint64)))


def _of_rows(docs: np.ndarray, values: np.ndarray) -> np.ndarray:
    return mix(values ^ mix(docs.astype(np.uint64)))


def _text_runs(window: int, gram: int):
    """The runs of each text, equal ones once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                runs = Runs(*text_bytes(part.column("text")), window, gram)
                once = _once(runs.doc, runs.hash ^ runs.anchor)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(runs.doc[once])), _signed(runs.anchor[once]), _signed(runs.hash[once])],
                    ["doc_id", "anchor", "hash"],
                )

    return run


#: What a row of ``_shared`` says of its ``hash``, but for the number of strings of a crowded anchor.
_COPY, _STRING = 0, 1


def _shared(hot: int):
    """Of runs in the order of ``anchor``, ``hash`` and ``doc_id``, all of an anchor in one task: ``n`` is ``_COPY`` for a run that a
    smaller document has, ``_STRING`` for the first of equal runs where several documents have the anchor and it has several strings,
    and the number of strings for an anchor (as ``hash``) that has more than ``hot``. Of an anchor that goes on in the next batch its last
    run is kept, and, as long as it has one document or one string, the strings so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # of the open anchor: itself, its last hash, the first documents of that and of the anchor, whether there are others, strings
        waiting: list[tuple[pa.Array, np.ndarray]] = []
        kind = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.schema.field("doc_id").type
            doc, anchor, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "anchor", "hash"))
            opens, fresh = np.ones(len(doc), bool), np.ones(len(doc), bool)
            np.not_equal(anchor[1:], anchor[:-1], out=opens[1:])
            np.logical_or(opens[1:], own[1:] != own[:-1], out=fresh[1:])
            if last and last[0] == anchor[0]:
                opens[0], fresh[0] = False, last[1] != own[0]
            of = np.cumsum(opens)  # 0: the anchor that was open
            n, at = int(of[-1]) + 1, np.arange(1, len(doc) + 1)
            before = lambda value: np.concatenate([np.array([doc[0] if last is None else value], doc.dtype), doc])
            first = before(last and last[2])[np.maximum.accumulate(np.where(fresh, at, 0))]
            of_anchor = before(last and last[3])[np.maximum.accumulate(np.where(opens, at, 0))]
            others, strings = np.zeros(n, bool), np.bincount(of[fresh], minlength=n)
            others[of[doc != of_anchor]] = True
            if last:
                others[0] |= last[4]
                strings[0] += last[5]
            several = others & (strings > 1)
            copies, wanted = np.flatnonzero(doc != first), np.flatnonzero(fresh & several[of])
            crowded = np.flatnonzero(several[:-1] & (strings[:-1] > hot))
            names = np.concatenate([[last[0] if last else 0], anchor[opens]])[crowded]
            docs, hashes = [batch.column("doc_id").take(pa.array(np.concatenate([copies, wanted])))], [own[copies], own[wanted]]
            kinds = [np.full(len(copies), _COPY), np.full(len(wanted), _STRING)]
            if several[0]:
                docs += [d for d, _ in waiting]
                hashes += [h for _, h in waiting]
                kinds += [np.full(len(h), _STRING) for _, h in waiting]
            docs.append(pa.nulls(len(crowded), kind))
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(docs), pa.array(np.concatenate([*hashes, names])), pa.array(np.concatenate([*kinds, strings[crowded]]))], ["doc_id", "hash", "n"]
            )
            if n > 1 or several[0]:
                waiting = []
            if not several[-1]:
                more = np.flatnonzero(fresh & (of == n - 1))
                waiting.append((batch.column("doc_id").take(pa.array(more)), own[more]))
            last = anchor[-1], own[-1], first[-1], of_anchor[-1], bool(others[-1]), int(strings[-1])
        if last and last[4] and last[5] > max(hot, 1):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.array([last[0]]), pa.array([last[5]])], ["doc_id", "hash", "n"])

    return run


def _strings(window: int, gram: int):
    """The text of the runs that a row lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                data, bounds = text_bytes(part.column("text"))
                runs = Runs(data, bounds, window, gram)
                asked = np.flatnonzero(np.isin(_of_rows(runs.doc, runs.hash), _tied(part, part.column("asked"))))
                once = asked[_once(runs.doc[asked], runs.hash[asked])]
                texts = [data[a : a + n + window - 1].tobytes() for a, n in zip(runs.first[once].tolist(), runs.size[once].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(runs.doc[once])), _signed(runs.anchor[once]), _signed(runs.hash[once]), pa.array(texts, pa.binary())],
                    ["doc_id", "anchor", "hash", "bytes"],
                )

    return run


# --- suffix arrays --------------------------------------------------------------------------------------


def _joint(*fields: np.ndarray) -> np.ndarray:
    """One number for each row of the fields, in their order."""
    key = fields[0]
    for field in fields[1:]:
        size = int(field.max(initial=0)) + 1
        if int(key.max(initial=0)) >= (1 << 62) // size:
            key = np.unique(key, return_inverse=True)[1]
        key = key * size + field
    return key


def suffix_order(text: np.ndarray, depth: int, covered: int = 1, wanted: np.ndarray | None = None) -> np.ndarray:
    """The places of ``text`` (numbers from 1), or those ``wanted``, in the order of their suffixes, as far as ``depth`` bytes decide it;
    a number stands for ``covered`` bytes."""
    n = len(text)
    if n < 3:
        return np.array(sorted((i for i in range(n) if wanted is None or wanted[i]), key=lambda i: text[i:].tolist()), np.int64)
    t = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    # One place beyond the end, if it ends the sequence of the first kind, keeps that apart from the second.
    ones, twos, rest = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sampled = np.concatenate([ones, twos])
    asked = None
    if wanted is not None:
        # The merge looks at the sampled suffixes one or two places behind those wanted.
        asked = np.concatenate([wanted, np.zeros(3, bool)])
        asked[2:] |= asked[1:-1] | asked[:-2]
        asked[1] |= wanted[0]
        asked = asked[sampled]
        ones, twos, rest = (x[wanted[np.minimum(x, n - 1)] & (x < n)] for x in (ones, twos, rest))
    names = _joint(t[sampled], t[sampled + 1], t[sampled + 2])
    # Triples of small numbers are names as they are.
    distinct = False
    if 3 * covered >= depth or int(names.max()) >= _PLAIN:
        values, names = np.unique(names, return_inverse=True)
        distinct = len(values) == len(sampled)
    if not distinct and 6 * covered < depth:
        order = suffix_order(names + 1, depth, 3 * covered, asked)
    else:
        # Two triples in a row reach as far as ``depth``; one that ends the text is like no other.
        key = names if distinct or 3 * covered >= depth else _joint(names, np.append(names[1:] + 1, 0))
        order = np.argsort(key) if asked is None else np.flatnonzero(asked)[np.argsort(key[asked])]
    rank = np.zeros(n + 3, np.int64)
    rank[sampled[order]] = np.arange(1, len(order) + 1)
    sampled = sampled[order]
    sampled = sampled[sampled < n] if wanted is None else sampled[wanted[np.minimum(sampled, n - 1)] & (sampled < n)]
    if wanted is None:
        ones = ones[ones < n]
    # The others go by their first number and the sampled suffix behind it.
    both = np.concatenate([rest, ones])
    keys = _joint(t[both], rank[both + 1])
    mine, of_ones = keys[: len(rest)], np.sort(keys[len(rest) :])
    by_key = np.argsort(mine)
    both = np.concatenate([rest, twos])
    keys = _joint(t[both], t[both + 1], rank[both + 2])
    mine, of_rest = mine[by_key], keys[: len(rest)][by_key]
    before = np.searchsorted(of_ones, mine) + np.searchsorted(np.sort(keys[len(rest) :]), of_rest)
    place = np.arange(len(rest)) + np.maximum.accumulate(before)
    merged = np.empty(len(sampled) + len(rest), np.int64)
    free_places = np.ones(len(merged), bool)
    free_places[place] = False
    merged[place] = rest[by_key]
    merged[free_places] = sampled
    return merged


def _alike(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Whether ``size`` bytes from ``a`` and from ``b`` are equal."""
    if size < 8:
        return np.logical_and.reduce([data[a + k] == data[b + k] for k in range(size)])
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    same = np.ones(len(a), bool)
    for k in [*range(0, size - 7, 8), size - 8]:
        same &= words[a + k] == words[b + k]
    return same


def _repeated(window: int):
    """Of a block of strings which windows of each a string of a smaller document holds, as bits of ``mask``."""

    def run(table: pa.Table) -> pa.Table:
        strings = table.column("bytes").to_pylist()
        sizes = np.array([len(s) for s in strings], np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(strings) + bytes(window), np.uint8)
        letters = np.cumsum(np.bincount(data, minlength=256) > 0)[data]
        string = np.repeat(np.arange(len(strings)), sizes)
        whole = np.zeros(len(data), bool)
        whole[: len(string)] = np.arange(len(string)) + window <= ends[string]
        order = suffix_order(letters, window, wanted=whole)
        same = _alike(data, order[:-1], order[1:], window)
        begins = np.flatnonzero(np.concatenate([[True], ~same]))
        owner = np.unique(np.array(table.column("doc_id").to_pylist()), return_inverse=True)[1]
        owners = owner[string[order]]
        least = np.repeat(np.minimum.reduceat(owners, begins), np.diff(np.append(begins, len(order))))
        found = order[least < owners]
        mask = np.zeros(len(strings), np.int64)
        skip = table.column("skip").to_numpy()
        where = string[found]
        np.bitwise_or.at(mask, where, np.int64(1) << (found - (ends - sizes)[where] + skip[where]))
        some = pa.array(np.flatnonzero(mask))
        return pa.table({"doc_id": table.column("doc_id").take(some), "hash": table.column("hash").take(some), "mask": pa.array(mask).take(some)})

    return run


def _single_windows(window: int):
    """The windows of strings, each a string of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            sizes = np.array([len(s) - window + 1 for s in texts], np.int64)
            of = pa.array(np.repeat(np.arange(len(texts)), sizes))
            cut = [s[k : k + window] for s in texts for k in range(len(s) - window + 1)]
            skip = np.arange(len(cut)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(of), batch.column("hash").take(of), pa.array(cut, pa.binary()), pa.array(skip.astype(np.int32))],
                ["doc_id", "hash", "bytes", "skip"],
            )

    return run


def repeated_windows(strings: DataFrame, n_strings: int, hot: DataFrame, window: int, block: int = BLOCK) -> DataFrame:
    """Of ``strings`` (``doc_id``, ``anchor``, ``hash``, ``bytes``), ``n_strings`` of them, which windows are repeated: ``mask``. The anchors
    ``hot`` have ``n`` strings each."""
    kind = strings.schema["doc_id"].dataType.simpleString()
    in_hot = hot.agg(F.sum("n")).first()[0]
    n_blocks = n_strings // block + 1
    dealt = F.pmod(F.xxhash64("anchor"), F.lit(n_blocks))
    whole = strings.select("anchor", "doc_id", "hash", "bytes", F.lit(0).alias("skip"))
    if in_hot:
        crowded = hot.select("anchor")  # far fewer than strings
        single = whole.join(crowded, "anchor", "left_semi").select("doc_id", "hash", "bytes")
        single = single.mapInArrow(_single_windows(window), f"doc_id {kind}, hash bigint, bytes binary, skip int")
        # A string has some dozens of windows.
        by_window = F.pmod(F.xxhash64("bytes"), F.lit(in_hot * 32 // block + 1)) + n_blocks
        whole = whole.join(crowded, "anchor", "left_anti").select("doc_id", "hash", "bytes", "skip", dealt.alias("block"))
        whole = whole.union(single.select("*", by_window.alias("block")))
    else:
        whole = whole.select("doc_id", "hash", "bytes", "skip", dealt.alias("block"))
    by_block = whole.groupBy("block")
    return by_block.applyInArrow(lambda table: _repeated(window)(table), f"doc_id {kind}, hash bigint, mask bigint")


# --- documents ------------------------------------------------------------------------------------------


def _removed(window: int, gram: int):
    def compute(part: pa.RecordBatch) -> list[pa.Array]:
        data, bounds = text_bytes(part.column("text"))
        change = np.zeros(len(data) + 1, np.int32)
        lists = part.column("repeated")
        listed = lists.flatten()
        if len(listed):
            runs = Runs(data, bounds, window, gram)
            tied = _tied(part, pa.ListArray.from_arrays(lists.offsets, lists.values.field("hash")))
            order = np.argsort(tied, kind="stable")
            own = _of_rows(runs.doc, runs.hash)
            low, high = (np.searchsorted(tied[order], own, side) for side in ("left", "right"))
            masks = np.asarray(listed.field("mask"), np.int64)[order]
            hit = np.flatnonzero(high > low)
            low, high, mask = low[hit], high[hit], np.zeros(len(hit), np.int64)
            for k in range(int((high - low).max(initial=0))):
                more = low + k < high
                mask[more] |= masks[low[more] + k]
            first, size = runs.first[hit], runs.size[hit]
            whole = mask == -1
            np.add.at(change, first[whole], 1)
            np.add.at(change, first[whole] + size[whole] + window - 1, -1)
            first, mask = first[~whole], mask[~whole]
            for bit in range(window - gram + 1):
                at = first[(mask >> bit & 1).astype(bool)] + bit
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        text = np.ones(len(data), bool)
        text[bounds[1:] - 1] = False
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        per_text = lambda marked: np.diff(np.concatenate([[0], np.cumsum(marked, dtype=np.int64)])[bounds])
        kept = text & ~gone
        sizes = per_text(kept)
        offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
        remaining = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, offsets, pa.py_buffer(data[kept].tobytes())])
        return [pa.array(np.diff(bounds) - 1), pa.array(per_text(gone)), pa.array(per_text(begins)), remaining.cast(pa.binary())]

    return compute


def without_repeats(
    docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, block: int = BLOCK, hot: int = HOT, carry: Sequence[str] | None = None
) -> DataFrame:
    """Per document ``row`` (the columns ``carry``, or all), ``n_bytes``, ``n_removed``, ``n_spans`` (stretches removed) and ``kept``, the
    remaining bytes."""
    if not 0 < window - gram < 62:
        raise ValueError("a window has 1 to 61 bytes more than a gram")
    texts = docs.select("doc_id", "text").where("doc_id is not null")
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = texts.mapInArrow(_text_runs(window, gram), f"doc_id {kind}, anchor bigint, hash bigint")
    by_anchor = runs.repartition("anchor").sortWithinPartitions("anchor", "hash", "doc_id")
    shared = swept(by_anchor.mapInArrow(_shared(hot), f"doc_id {kind}, hash bigint, n bigint"), "shared-runs")
    firsts = shared.where(F.col("n") == _STRING)
    wanted = firsts.groupBy(F.col("doc_id").alias("of_doc")).agg(F.collect_list("hash").alias("asked"))
    with_runs = texts.join(swept(wanted, "asked-runs"), F.col("doc_id") == F.col("of_doc")).select("doc_id", "text", "asked")
    strings = swept(with_runs.mapInArrow(_strings(window, gram), f"doc_id {kind}, anchor bigint, hash bigint, bytes binary"), "strings")
    crowded = shared.where(F.col("n") > _STRING).select(F.col("hash").alias("anchor"), "n")
    masks = swept(repeated_windows(strings, firsts.count(), crowded, window, block), "repeated-windows")
    # Documents beyond a run's first repeat all of it.
    whole = shared.where(F.col("n") == _COPY).select("doc_id", "hash", F.lit(-1).cast("long").alias("mask"))
    by_doc = whole.union(masks).groupBy(F.col("doc_id").alias("of_doc")).agg(F.collect_list(F.struct("hash", "mask")).alias("repeats"))
    by_doc = swept(by_doc, "repeats")
    name = free(docs, "repeated")
    packed = docs.select(F.struct("*").alias("all"))
    nothing = F.array().cast("array<struct<hash:bigint,mask:bigint>>")
    joined = packed.join(by_doc, F.col("all.doc_id") == F.col("of_doc"), "left").select("all.*", F.coalesce("repeats", nothing).alias(name))
    return computed(
        joined, _removed(window, gram), "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary",
        carry=docs.columns if carry is None else carry, given={"repeated": F.col(name)},
    )


def op12_suffixes(spark, sf_dir: str) -> DataFrame:
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"])
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
