"""SimHash near-duplicates by pigeonhole blocks.

A text's fingerprint has a bit where over half of its shingles' hashes have it. Fingerprints are cut into blocks; if two differ
in at most ``d`` bits, at most ``d`` of the ``b`` blocks differ, so they agree in some choice of ``b - d`` blocks. They meet
under that choice's bits as key and are verified by Hamming distance. There are more blocks, hence longer keys, for
more distinct fingerprints, so that fingerprints that have nothing in common seldom meet.

Copies have one fingerprint and are one node. Under one key only a spanning forest of the links is kept, never all pairs, and
a key with many members is dealt out in cells of two bounded parts each, every two parts meeting in one. Components are
then found by alternating large and small stars, distributed, each round written before the next.

Null and empty texts have fingerprint 0, linked like any other. A component's id is its smallest doc_id; null ids are ignored
unless there is no other. Repeated rows are members like any other. Empty tables have no components.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.carry import computed
from rosterlake.llm.keys import stage
from rosterlake.llm.words import Texts

BITS = 4
SHINGLE = 4
#: Members of a key that are compared in one task.
PART = 2000


def _fingerprints(shingle: int):
    def compute(part: pa.RecordBatch) -> list[pa.Array]:
        texts = Texts(part.column("text"), lower=True)
        joined, sizes, digest = texts.joined(np.ones(len(texts.start), bool)), texts.end - texts.start + 1, xxhash.xxh64_intdigest
        prints = np.zeros(len(texts), np.uint64)
        for i, words in enumerate(joined):
            here = sizes[texts.first[i] : texts.first[i + 1]]
            if not len(here):
                continue
            data = words.as_buffer().to_pybytes()
            ends = np.cumsum(here)
            starts = (ends - here).tolist()
            until = (ends - 1).tolist()
            if len(until) <= shingle:
                hashes = [digest(data, 42)]
            else:
                hashes = [digest(data[a:b], 42) for a, b in zip(starts, until[shingle - 1 :], strict=False)]
            counts = np.zeros(64, np.int64)
            for k in range(0, len(hashes), 1 << 16):
                some = np.array(hashes[k : k + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
                counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            prints[i] = np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]
        return [pa.array(prints.view(np.int64))]

    return compute


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, carry: Sequence[str] | None = None) -> DataFrame:
    """Per document ``row`` (the columns ``carry``, or all) and ``fingerprint``, its 64 bits as a bigint."""
    return computed(docs, _fingerprints(shingle), "fingerprint bigint", carry=carry)


def block_masks(n_fingerprints: int, bits: int) -> list[int]:
    """The bits that are compared first: those of every choice of all but ``bits`` blocks, of as many blocks as it takes
    for keys longer than the logarithm of the number of fingerprints."""
    for n in range(bits + 1, 64):
        edges = [64 * i // n for i in range(n + 1)]
        blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
        masks = [sum(c) for c in combinations(blocks, n - bits)]
        if min(m.bit_count() for m in masks) > max(1, n_fingerprints).bit_length() or n >= bits + 6:
            return masks
    raise ValueError(bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(bits: int):
    """Of each group of fingerprints a spanning forest of its links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for members in batch.column("members"):
                values = np.unique(np.asarray(members.values, np.int64))
                if len(values) == 2:
                    a, b = values.tolist()
                    if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits:
                        low.append(a)
                        high.append(b)
                    continue
                left = values
                while len(left) > 1:
                    root, left, front = int(left[0]), left[1:], [left[0]]
                    while front and len(left):
                        near = np.bitwise_count((left ^ front.pop()).view(np.uint64)) <= bits
                        found, left = left[near], left[~near]
                        low += [root] * len(found)
                        high += found.tolist()
                        front += list(found)
            yield pa.RecordBatch.from_arrays([pa.array(high, pa.int64()), pa.array(low, pa.int64())], ["u", "v"])

    return run


def links(prints: DataFrame, *, bits: int = BITS, part: int = PART) -> DataFrame:
    """Edges ``u`` > ``v`` between the distinct ``fingerprint`` of ``prints`` that connect all that differ in at most
    ``bits`` bits."""
    masks = block_masks(prints.count(), bits)
    of_mask = F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("bits")) for i, m in enumerate(masks)))
    keys = prints.select("fingerprint", F.explode(of_mask).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / part).cast("int")
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(F.least(i, F.col("mine")), F.greatest(i, F.col("mine"))))
    groups = (
        keys.join(shared, "key")
        .withColumn("parts", parts)
        .withColumn("mine", mine)
        .select("key", "fingerprint", F.explode(cells).alias("cell"))
        .groupBy("key", "cell")
        .agg(F.collect_list("fingerprint").alias("members"))
        .where(F.size("members") > 1)
    )
    return groups.select("members").mapInArrow(_forest(bits), "u bigint, v bigint").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """Per node ``u`` of the edges other than the smallest of its component that smallest, ``v``."""
    edges = stage(edges, "links")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Staged, so that nothing stands between it and the join, and adaptive execution can split the edges of a hub.
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least-neighbours")
        large = stage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-stars")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least-neighbours")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = stage(small.distinct(), "small-stars")
        # Stars alone are left when no node points to two others or to one that points on itself.
        out = edges.groupBy("u").agg(F.count("*").alias("n"))
        onward = edges.select("v").distinct().join(out, F.col("v") == F.col("u"), "left_semi")
        if out.where("n > 1").isEmpty() and onward.isEmpty():
            return edges


def components(prints: DataFrame, *, bits: int = BITS, part: int = PART) -> DataFrame:
    """Of ``doc_id`` and ``fingerprint``: per distinct fingerprint ``of_fingerprint`` the component's ``root`` fingerprint
    and its smallest doc_id as ``component_id``."""
    nodes = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    found = roots(links(nodes.select("fingerprint"), bits=bits, part=part))
    rooted = nodes.join(found, F.col("fingerprint") == F.col("u"), "left").select("fingerprint", "first_id", F.coalesce("v", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select(F.col("fingerprint").alias("of_fingerprint"), "root", "component_id")


def with_components(docs: DataFrame, *, shingle: int = SHINGLE, bits: int = BITS, carry: Sequence[str] | None = None) -> DataFrame:
    """Per document ``row`` (the columns ``carry``, or all but the text), ``fingerprint``, ``root`` and ``component_id``."""
    kept = [c for c in docs.columns if c != "text"] if carry is None else carry
    prints = stage(fingerprints(docs, shingle=shingle, carry=kept), "simhash")
    found = stage(components(prints.select("row.doc_id", "fingerprint"), bits=bits), "components")
    return prints.join(found, F.col("fingerprint") == F.col("of_fingerprint")).drop("of_fingerprint")


def _key() -> list[Column]:
    """Never null, different for different documents, equal for repeated rows."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", "doc_id").alias("k2")]


def deduplicated(docs: DataFrame, *, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One document of each component, that with the smallest doc_id; ties go by a hash of the text."""
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id"), F.col("text"), *_key())
    named = with_components(keyed.select("doc_id", "text", "k1", "k2"), shingle=shingle, bits=bits, carry=["doc_id", "k1", "k2"])
    named = stage(named.select("row.*", "root"), "members")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("first")
    chosen = stage(named.groupBy("root").agg(first).select("first.k1", "first.k2"), "chosen")
    kept = keyed.join(chosen, ["k1", "k2"], "left_semi")
    if named.join(chosen, ["k1", "k2"], "left_semi").count() > chosen.count():  # rows that are repeated as they are
        kept = kept.groupBy("k1", "k2").agg(F.first("row").alias("row"))
    return kept.select("row.*")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = with_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"])
    return found.select("row.doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
