"""From raw documents to token files, one stage after another, each over all that the one before kept.

A stage takes (spark, docs, folder of the tables) and returns a DataFrame. It is written as Parquet and read again as the next
one's documents, so a lost executor costs a stage at most.

1. quality: documents whose quality score is below 0.3 go.
2. near_duplicates: of each group of documents whose SimHash fingerprints (shingles of four words) are linked by at most four
   differing bits the one with the smallest doc_id stays.
3. decontamination: documents that hold a window of a benchmark item go.
4. mixing: documents are repeated, or left out, so that sources come near their target weights.
5. token_files: the documents' token ids are written as files; the files are read back as one row per document.

Nulls, empty texts, repeated rows and empty tables behave as each operator states. From stage 4 on documents repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm import decontamination, mixing, quality, simhash, token_files
from rosterlake.llm.keys import stage
from rosterlake.sources.tables import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensemble = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, ensemble).where("score >= 0.3").select("row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs, shingle=simhash.SHINGLE, bits=simhash.BITS)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def token_file_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(docs, path)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmarks),
    ("mixing", mixed),
    ("token_files", token_file_rows),
]

#: The classifier of the first stage can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
