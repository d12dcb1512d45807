"""Quality rules as a short-circuit cascade.

Each rule measures a text and rejects it or not. On a sample of at most ``rows`` documents every rule is timed and its verdicts
are noted; rules are then put in the order of rejections per cost, each judged on what the ones before it leave. In the
cascade a rule sees only the documents that no earlier rule has rejected. Order changes cost, never the outcome.

Null and empty texts have no words and are rejected for that. Repeated rows are judged alike, other columns are carried
along, an empty table stays empty.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.carry import computed
from rosterlake.llm.words import Texts, grams, mix, passes, sequence

ROWS = 2000
REPEAT = 8

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
#: Bytes that begin a character.
_BEGINS = (np.arange(256) & 0xC0) != 0x80


def n_words(texts: Texts) -> np.ndarray:
    return np.diff(texts.first)


def word_chars(texts: Texts) -> np.ndarray:
    """Characters in words."""
    begun = np.concatenate([[0], np.cumsum(_BEGINS[texts.data], dtype=np.int64)])
    return texts.per_text(begun[texts.end] - begun[texts.start])


def n_symbols(texts: Texts) -> np.ndarray:
    return texts.bytes_per_text(_SYMBOL[texts.data])


def _lines(texts: Texts, i: int) -> list[bytes]:
    return texts.data[texts.bounds[i] : texts.bounds[i + 1] - 1].tobytes().split(b"\n")


def n_dup_lines(texts: Texts) -> np.ndarray:
    """Lines with a word that are equal to an earlier line."""
    found = np.zeros(len(texts), np.int64)
    for i in range(len(texts)):
        worded = [x for x in _lines(texts, i) if x and not x.isspace()]
        found[i] = len(worded) - len(set(worded))
    return found


def n_repeat_words(texts: Texts) -> np.ndarray:
    """Words in windows of eight words that the text holds more than once, the first included."""
    words = texts.hashes()
    at = np.flatnonzero(texts.within(REPEAT)) if len(words) >= REPEAT else np.zeros(0, np.int64)
    if not len(at):
        return np.zeros(len(texts), np.int64)
    windows = mix(grams(sequence(words), len(words), REPEAT)[at] ^ mix(texts.doc[at].astype(np.uint64)))
    _, number, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = at[times[number] > 1]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + REPEAT, -1)
    return texts.per_text(np.cumsum(change[:-1]) > 0)


MEASURES = {f.__name__: f for f in (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Texts], np.ndarray]


def _too_few_words(texts: Texts) -> np.ndarray:
    return n_words(texts) < 20


def _too_many_repeats(texts: Texts) -> np.ndarray:
    return 100 * n_repeat_words(texts) > 30 * n_words(texts)


def _too_many_symbols(texts: Texts) -> np.ndarray:
    return 10 * n_symbols(texts) > 3 * n_words(texts)


def _odd_word_length(texts: Texts) -> np.ndarray:
    chars, words = word_chars(texts), n_words(texts)
    return (chars < 2 * words) | (chars > 12 * words)


def _too_many_dup_lines(texts: Texts) -> np.ndarray:
    """Over 30 of 100 lines with a word, and more than one: a single line that comes twice is no habit."""
    lines = np.array([sum(1 for x in _lines(texts, i) if x and not x.isspace()) for i in range(len(texts))], np.int64)
    repeated = n_dup_lines(texts)
    return (repeated > 1) & (100 * repeated > 30 * lines)


#: The first two are the base that every text has to pass.
RULES = (
    Rule("words", _too_few_words),
    Rule("repeats", _too_many_repeats),
    Rule("symbols", _too_many_symbols),
    Rule("word_length", _odd_word_length),
    Rule("dup_lines", _too_many_dup_lines),
)


def _timed(rules: Sequence[Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch):
                verdicts, seconds = [], []
                for rule in rules:
                    begun = time.thread_time()
                    texts = Texts(part.column("text"))
                    verdicts.append(rule.rejects(texts))
                    seconds.append(time.thread_time() - begun)
                each = np.array(verdicts).T.astype(np.int64) @ (1 << np.arange(len(rules)))
                cost = np.tile(np.array(seconds) / part.num_rows, (part.num_rows, 1))
                yield pa.RecordBatch.from_arrays([pa.array(each), pa.array(list(cost))], ["rejected_by", "seconds"])

    return run


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, *, rows: int = ROWS, seed: int = 3) -> list[Rule]:
    """The rules by rejections per second on the sample, each judged on the documents that the rules before it leave."""
    share = min(1.0, 2.0 * rows / max(1, docs.count()))
    sample = docs.select("text").sample(False, share, seed).limit(rows)
    found = sample.mapInArrow(_timed(rules), "rejected_by bigint, seconds array<double>").toPandas()
    if found.empty:
        return list(rules)
    verdicts = (found["rejected_by"].to_numpy()[:, None] >> np.arange(len(rules))) & 1
    costs = np.stack(found["seconds"].to_list()).mean(axis=0) + 1e-9
    left, alive, order = list(range(len(rules))), np.ones(len(found), bool), []
    while left:
        best = max(left, key=lambda k: (verdicts[alive, k].sum() / costs[k], -costs[k]))
        order.append(rules[best])
        left.remove(best)
        alive &= verdicts[:, best] == 0
    return order


def cascade(column: pa.Array, rules: Sequence[Rule]) -> tuple[np.ndarray, np.ndarray]:
    """By text whether no rule rejects it, and the number of rules that looked at it."""
    alive, looked = np.arange(len(column)), np.zeros(len(column), np.int64)
    texts = Texts(column)
    for rule in rules:
        if not len(alive):
            break
        looked[alive] += 1
        passed = ~np.asarray(rule.rejects(texts), bool)
        if not passed.all():
            alive = alive[passed]
            texts = Texts(column.take(pa.array(alive)))
    kept = np.zeros(len(column), bool)
    kept[alive] = True
    return kept, looked


def judged(docs: DataFrame, order: Sequence[Rule], *, measures: Sequence[str] = (), carry: Sequence[str] | None = None) -> DataFrame:
    """Per document ``row`` (the columns ``carry``, or all), ``kept``, ``n_looked`` (rules that had to look at it) and the
    ``measures`` asked for."""

    def compute(part: pa.RecordBatch) -> list[pa.Array]:
        found = [pa.array(x) for x in cascade(part.column("text"), order)]
        if measures:
            texts = Texts(part.column("text"))
            found += [pa.array(MEASURES[m](texts).astype(np.int64)) for m in measures]
        return found

    return computed(docs, compute, ", ".join(["kept boolean, n_looked bigint", *(f"{m} bigint" for m in measures)]), carry=carry)


def filtered(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that no rule rejects."""
    return judged(docs, ordered(docs, rules)).where("kept").select("row.*")


def op7_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged(docs, ordered(docs), measures=list(MEASURES), carry=["doc_id"]).select(
        "row.doc_id", *MEASURES, failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept")
    )


ORACLE = r"""
with doc as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), line as (
  select doc_id, unnest(string_split(text, chr(10))) as line from doc
), lines as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from line where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
), place as (
  select doc_id, w, unnest(range(1, len(w) - 6)) as i from doc where len(w) >= 8
), win as (
  select doc_id, i, array_to_string(w[i : i + 7], ' ') as gram from place
), again as (
  select doc_id, i, count(*) over (partition by doc_id, gram) as times from win
), repeated as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from again where times > 1) group by doc_id
), measured as (
  select doc_id, len(w)::bigint as n_words, len(array_to_string(w, ''))::bigint as word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
         coalesce(n, 0)::bigint as n_repeat_words, coalesce(n_lines, 0) as n_lines
  from doc left join lines using (doc_id) left join repeated using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or 10 * n_symbols > 3 * n_words
            or word_chars < 2 * n_words or word_chars > 12 * n_words or (n_dup_lines > 1 and 100 * n_dup_lines > 30 * n_lines)) as kept
from measured
"""
