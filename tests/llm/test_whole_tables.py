"""Queries without SQL against the brute force of their contract, on a whole supplied table."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.llm import brute

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.mark.parametrize(
    "query, truth",
    [("op2_token_counts", brute.token_counts), ("op8_token_files", brute.token_files), ("op10_simhash", brute.simhash), ("op11_manifest", brute.manifest), ("op12_suffixes", brute.bytes_removed), ("op13_spelling", brute.spelling)],
)
def test_query(spark, docs, query, truth):
    got = sorted(map(tuple, contract.queries()[query](spark, SF).collect()), key=repr)
    assert got == sorted(truth(docs), key=repr)
