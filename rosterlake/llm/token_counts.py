"""Token counts with a digest cache.

A text's count is stored under the digest of its content and the digest of the tokenizer. Counting joins the documents'
digests to the cache, encodes every content that is not there once, whole, and appends the counts.

Content is the text as it is, null being the empty text: no other normalisation leaves every tokenizer's counts alone. Copies
share one entry. Empty tables append nothing. Other columns are carried along whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.keys import stage
from rosterlake.sources.tables import scratch_path

CACHE = "tokenizer binary, content binary, n_tokens bigint"
#: Up to so many missing digests (of 32 bytes) are broadcast.
FEW = 100_000
#: Characters that are given to the tokenizer at once, or one text where that is longer.
AT_ONCE = 1 << 20


def vocabulary(name: str) -> str:
    """Where the file of a public tokenizer is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _counter(name: str):
    """A function from texts to their numbers of tokens, without added special tokens, truncation or padding."""
    if name.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=vocabulary(name))
        return lambda texts: list(map(len, processor.encode(texts, num_threads=1)))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(tokenizer.encode(t, add_special_tokens=False)) for t in texts]


def _counts(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(name)
        for batch in batches:
            texts, found, held, size = batch.column("content_text").to_pylist(), [], [], 0
            for text in texts:
                if held and size + len(text) > AT_ONCE:
                    found += count(held)
                    held, size = [], 0
                held.append(text)
                size += len(text)
            found += count(held) if held else []
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(found, pa.int64())], ["content", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, cache: str, tokenizer: str = "piece_bpe_32k.model") -> DataFrame:
    """Per document ``row`` (all its columns), ``n_bytes`` of its text in UTF-8 and ``n_tokens``. ``cache``: folder of the
    counts, made if it isn't there."""
    spark: SparkSession = docs.sparkSession
    version = bytearray(hashlib.sha256(tokenizer.rpartition(".")[2].encode() + Path(vocabulary(tokenizer)).read_bytes()).digest())
    spark.createDataFrame([], CACHE).write.mode("ignore").parquet(cache)
    known = lambda: spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == F.lit(version))

    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long").alias("n_bytes")
    keyed = docs.select(F.struct("*").alias("row"), size, text.alias("content_text"), F.unhex(F.sha2(text, 256)).alias("content"))
    missing = stage(keyed.select("content").distinct().join(known(), "content", "left_anti"), "missing-counts")
    contents = keyed.select("content", "content_text")
    # Copies are combined before the shuffle. Where little is missing, known texts are not shuffled at all.
    if missing.count() <= FEW:
        contents = contents.join(F.broadcast(missing), "content", "left_semi").groupBy("content").agg(F.first("content_text").alias("content_text"))
    else:
        contents = contents.groupBy("content").agg(F.first("content_text").alias("content_text")).join(missing, "content", "left_semi")
    counted = contents.mapInArrow(_counts(tokenizer), "content binary, n_tokens bigint")
    counted.select(F.lit(version).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache)
    # Two runs at once may have appended the same content. The counts are staged so that nothing stands between them and the
    # join, and adaptive execution can split the rows of a content with many copies.
    counts = stage(known().groupBy("content").agg(F.first("n_tokens").alias("n_tokens")), "counts")
    return keyed.join(counts, "content", "left").select("row", "n_bytes", "n_tokens")


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """Starts with an empty cache of its own, so that every distinct text is encoded in every run."""
    found = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_path(spark, "token-counts"))
    return found.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))
