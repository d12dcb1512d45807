"""Token ids in binary files.

A folder of parquet files holds one row per segment: the ids of whole documents, one after another, little endian in as few
bytes as the vocabulary needs; the documents' keys; and the places where they end, Elias-Fano encoded. Files are in
ascending order of the key, ``shard`` by ``shard``, and ``before`` counts the ids of earlier segments of the shard, so the
offset of any document is one sum per shard away and no 64-bit offset is stored.

Null texts are empty: such a document has the end id alone. Null keys come first; rows of equal key are in the order of a
hash of their text, repeated rows are written as often as they come. An empty table gives a folder without segments. A text
of any length is one document; a document beyond the segment size is a segment of its own.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rosterlake.llm.token_counts import vocabulary
from rosterlake.sources.tables import scratch_path

#: Ids in a segment, or one document where that is longer.
SEGMENT = 1 << 18
SELECT_EVERY = 256
_HEAD = struct.Struct("<4sIIBI")


class EliasFano:
    """An ascending list of numbers below 2^32 in some 2 + log2(largest / count) bits each.

    The low bits of each number stand packed one after another, the high bits as unary gaps in a bit vector; number ``i``
    is found from the place of its one bit, and every 256th such place is stored to start from.
    """

    def __init__(self, blob: bytes):
        magic, self.count, self.largest, self.low, n_upper = _HEAD.unpack_from(blob)
        if magic != b"EF01":
            raise ValueError("not an Elias-Fano list")
        at, n_samples = _HEAD.size, -(-self.count // SELECT_EVERY)
        self.samples = np.frombuffer(blob, "<u4", n_samples, at)
        at += 4 * n_samples
        self.upper = np.frombuffer(blob, np.uint8, n_upper, at)
        self.lower = np.frombuffer(blob, np.uint8, -(-self.count * self.low // 8), at + n_upper)

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.int64)
        n, largest = len(values), int(values[-1]) if len(values) else 0
        low = max(0, (largest // n).bit_length() - 1) if n else 0
        ones = (values >> low) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        upper = np.packbits(bits, bitorder="little").tobytes()
        lower = np.packbits((values[:, None] >> np.arange(low)) & 1, bitorder="little").tobytes() if n else b""
        return _HEAD.pack(b"EF01", n, largest, low, len(upper)) + ones[::SELECT_EVERY].astype("<u4").tobytes() + upper + lower

    def _low(self, first: int, n: int) -> np.ndarray:
        bit = first * self.low
        bits = np.unpackbits(self.lower[bit // 8 : -(-(bit + n * self.low) // 8)], bitorder="little")
        return bits[bit % 8 :][: n * self.low].reshape(n, self.low) @ (1 << np.arange(self.low, dtype=np.int64))

    def select(self, i: int) -> int:
        """Number ``i`` without reading the others."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        place, left = int(self.samples[i // SELECT_EVERY]), i % SELECT_EVERY
        byte, skipped = place // 8, bin(int(self.upper[place // 8]) & ((1 << place % 8) - 1)).count("1")
        left += skipped
        while left >= (here := int(self.upper[byte]).bit_count()):
            left -= here
            byte += 1
        one = np.flatnonzero(np.unpackbits(self.upper[byte : byte + 1], bitorder="little"))[left]
        return ((byte * 8 + int(one) - i) << self.low) + int(self._low(i, 1)[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))
        return ((ones - np.arange(self.count)) << self.low) + self._low(0, self.count)


#: The split pattern of the word vocabulary, as its file states it, and the same for text of the characters
#: ``_PLAIN``, in small letters.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECES = re.compile(r"[a-zªµºß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9²³¹¼½¾]|[^\ta-z\n\r ªµºß-öø-ÿ0-9²³¹¼½¾]+").findall
#: Bytes of ISO 8859-1 that a plain text consists of, and all bytes in small letters.
_PLAIN = bytes([9, 10, 13, *range(32, 127), *range(161, 256)])
_SMALL = bytes(range(256)).decode("latin-1").lower().encode("latin-1")


class Encoder:
    """Texts to the bytes of their ids as the library encodes the whole text, without added special tokens.

    Where the vocabulary drops white space and splits words before its merges, a text of plain characters is the sum of the
    pieces it is split into, so pieces are encoded once and remembered. Any other text or vocabulary goes through the library whole.
    """

    #: Pieces remembered before starting over, some 200 bytes each.
    MOST = 500_000

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        splits = [p.get("pattern") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        self.by_word = (
            splits[:1] == [{"Regex": _WORD_PATTERN}]
            and steps == ["NFC", "Replace", "Lowercase"]
            and spec["model"].get("end_of_word_suffix") == "</w>"
            and not spec["post_processor"]
        )
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.kind = np.dtype("<u2" if max(self.tokenizer.get_vocab().values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.pieces: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, new: list[str]) -> None:
        lines = [new[k : k + 1000] for k in range(0, len(new), 1000)]
        for some, line in zip(lines, self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.asarray(line.ids, np.int64)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):  # a piece that is no word of the vocabulary's on its own
                self.pieces.update((p, self._whole(p)) for p in some)
                continue
            data, size = ids.astype(self.kind).tobytes(), self.kind.itemsize
            at = [0, *(ends * size).tolist()]
            self.pieces.update((p, data[at[i] : at[i + 1]]) for i, p in enumerate(some))

    def _split(self, text: str) -> list[str] | None:
        """The pieces of a plain text in small letters; None for another."""
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if data.translate(None, _PLAIN) or any(s in text for s in self.specials):
            return None
        return _PIECES(data.translate(_SMALL).decode("latin-1"))

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self._whole(t) for t in texts]
        split = [self._split(t) for t in texts]
        # One look into the large memory per piece; only pieces that it lacks are looked up again.
        found = [None if p is None else list(map(self.pieces.get, p)) for p in split]
        lacking = {i: [k for k, x in enumerate(f) if x is None] for i, f in enumerate(found) if f and None in f}
        new = {split[i][k] for i, places in lacking.items() for k in places}
        if len(self.pieces) + len(new) > self.MOST:
            self.pieces.clear()
        self._learn(list(new))
        for i, places in lacking.items():
            for k in places:
                found[i][k] = self.pieces[split[i][k]]
        return [self._whole(t) if f is None else b"".join(f) for t, f in zip(texts, found, strict=True)]


def _cuts(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > most:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str) -> Encoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]


def _segments(name: str, end_id: int, segment: int, fields: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = _encoder(name), TaskContext.get().partitionId()
        last = np.asarray([end_id], encode.kind).tobytes()
        keys, ids, held, number, before = [], [], 0, 0, 0

        def row():
            ends = np.cumsum([len(x) for x in ids]) // encode.kind.itemsize
            columns = [shard, number, before, int(ends[-1]), encode.kind.itemsize, keys, b"".join(ids), EliasFano.encode(ends)]
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for begin, end in _cuts(list(map(len, texts)), 1 << 20):
                for key, found in zip(batch.column("key").slice(begin, end - begin).to_pylist(), encode(texts[begin:end]), strict=True):
                    n = len(found) // encode.kind.itemsize + 1
                    if keys and held + n > segment:
                        yield row()
                        keys, ids, held, number, before = [], [], 0, number + 1, before + held
                    keys.append(key)
                    ids.append(found + last)
                    held += n
        if keys:
            yield row()

    return run


def write_tokens(
    docs: DataFrame, path: str, *, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, key: str = "doc_id", segment: int = SEGMENT
) -> None:
    """The ids of every document and ``end_id`` after each, in ascending order of ``key``, as files under ``path``."""
    rows = docs.select(F.col(key).alias("key"), F.col("text").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"shard int, segment int, before bigint, n_ids bigint, width int, keys array<{kind}>, ids binary, bounds binary"
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)
    (
        rows.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_segments(tokenizer, end_id, segment, fields), schema)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def _documents(fields: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = EliasFano(row["bounds"]).all()
                starts = np.concatenate([[0], ends[:-1]])
                data = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4").tobytes()
                ids = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [row["keys"], starts + row["shard_before"] + row["before"], ends - starts, ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    return run


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files ``key``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``, little
    endian in four bytes each."""
    segments = spark.read.parquet(path)
    # One row per file that was written: as many as the writer had partitions.
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long").alias("shard_before"))
    schema = f"{key} {segments.schema['keys'].dataType.elementType.simpleString()}, start bigint, n_tokens bigint, ids binary"
    fields = to_arrow_schema(spark.createDataFrame([], schema).schema)
    return segments.join(F.broadcast(shards), "shard").mapInArrow(_documents(fields), schema)


def document_ids(segment: Row, i: int) -> np.ndarray:
    """The ids of document ``i`` of a segment, found by two selects without decoding the other boundaries."""
    ends = EliasFano(segment["bounds"])
    start, end = ends.select(i - 1) if i else 0, ends.select(i)
    return np.frombuffer(segment["ids"], f"<u{segment['width']}")[start:end]


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
