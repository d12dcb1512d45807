"""Secret scans with corpus-wide ownership.

Base patterns find assignments, access keys and hexadecimal keys in each text. The method adds opaque tokens: long words of
letters and digits that no base span covers. Every candidate's hash is counted by the distinct repositories and owners that
have it: what several owners have, or many repositories of one, is a copied example; what few have is a credential of theirs
and looks live. Base spans always stay and carry the verdict; opaque spans are added only where they look live.

Only expressions of Spark SQL are used. A span is in code points, its end exclusive. Null and empty texts have no spans. A
null owner or repository counts as one of its own. Repeated rows have the same spans; they are one repository. Other columns
are carried along, an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.keys import stage

#: Kind, pattern, the group that holds the secret, and its least length. In the patterns of access and hex the
#: least length of the match is part of the pattern, which gives the same matches as dropping shorter ones; an assignment
#: that is too short still uses up its text.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", ASSIGN, 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
)
#: Twenty and more characters in a row, at least one of them a digit and one a letter.
OPAQUE = ("opaque", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}", 0, 20)
KINDS = [*(k for k, *_ in BASE), OPAQUE[0]]
#: From so many owners or repositories on a value is a copied example.
COPIED = 3
COPIED_REPOSITORIES = 10
#: Matches that are put in their places together. Arrays grow by copying, so one array for all would take quadratic time.
TOGETHER = 128

_SPAN = "struct<start:int,kind:int,end:int,value:binary>"


def _spans(text: Column, number: int, pattern: str, group: int, least: int) -> Column:
    """The matches of a pattern in order. The text is split at them; lengths of what lies between and of the matches add up
    to their places, first block by block, then within each block."""
    matches, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def next_span(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["between"])
        end = start + F.length(pair["match"])
        secret = F.regexp_extract(pair["match"], pattern, group) if group else pair["match"]
        span = F.when(F.length(secret) >= least, F.array(F.struct(
            start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), F.unhex(F.sha2(secret, 256)).alias("value")
        ))).otherwise(F.array().cast(f"array<{_SPAN}>"))
        return F.struct(end.alias("at"), F.concat(state["found"], span).alias("found"))

    none = F.array().cast(f"array<{_SPAN}>")
    length = lambda block: F.aggregate(block, F.lit(0), lambda n, p: n + F.length(p["between"]) + F.length(p["match"]))

    def cut(pairs: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / TOGETHER).cast("int")),
            lambda b: F.slice(pairs, b * TOGETHER + 1, F.lit(TOGETHER)),
        )

    def placed(blocks: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(blocks, first, lambda state, block: F.struct(
            (state["at"] + length(block)).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts")
        ))["starts"]
        of_block = lambda x: F.aggregate(x["blocks"], F.struct(x["starts"].alias("at"), none.alias("found")), next_span)["found"]
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("blocks"), starts.alias("starts")), of_block))

    pairs = F.arrays_zip(matches.alias("match"), F.slice(between, 1, F.size(matches)).alias("between"))
    return F.when(text.rlike(pattern), _with(pairs, lambda p: _with(cut(p), placed))).otherwise(none)


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once; an expression would be again for each element that refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scanned(
    docs: DataFrame, *, owner: str = "source", repository: str = "doc_id", copied: int = COPIED,
    copied_repositories: int = COPIED_REPOSITORIES, carry: Sequence[str] | None = None,
) -> DataFrame:
    """Per document ``row`` (the columns ``carry``, or all but the text) and ``spans`` by start and kind: ``kind`` (a
    number, see ``KINDS``), ``start``, ``end``, ``value`` (a digest), ``n_repositories``, ``n_owners`` and ``live``."""
    carry = [c for c in docs.columns if c != "text"] if carry is None else list(carry)
    text = F.coalesce("text", F.lit(""))
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"),
        # Never null, different for different documents, equal for repeated rows.
        F.xxhash64("doc_id", "text").alias("k1"),
        F.xxhash64("text", "doc_id").alias("k2"),
        F.coalesce(F.concat(F.lit("="), F.col(owner).cast("string")), F.lit("")).alias("owner"),
        F.coalesce(F.concat(F.lit("="), F.col(repository).cast("string")), F.lit("")).alias("repository"),
        F.concat(*(_spans(text, i, *spec[1:]) for i, spec in enumerate(BASE))).alias("base"),
        _spans(text, len(BASE), *OPAQUE[1:]).alias("opaque"),
    )
    covered = lambda o: F.exists("base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"]))
    found = packed.withColumn("all", F.concat("base", F.filter("opaque", lambda o: ~covered(o)))).drop("base", "opaque")
    found = stage(found, "secrets")
    each = found.where(F.size("all") > 0).select("k1", "k2", "owner", "repository", F.explode("all").alias("span"))
    # Distinct owners and repositories are combined before the shuffle; a value that a third of all rows hold is one row
    # per owner or repository and task.
    value = F.col("span.value").alias("value")
    spread = [
        each.select(value, who).distinct().groupBy("value").agg(F.count("*").alias(f"n_{many}"))
        for who, many in (("owner", "owners"), ("repository", "repositories"))
    ]
    counts = spread[0].join(spread[1], "value")
    # Rows that repeat are one here, and come back by their key below. The counts are staged, so that nothing stands between
    # them and the join and adaptive execution can split a value that very many documents have.
    once = each.select("k1", "k2", "span").distinct().withColumn("value", F.col("span.value"))
    judged = once.join(stage(counts, "owners"), "value").withColumn(
        "live", (F.col("n_owners") < copied) & (F.col("n_repositories") < copied_repositories)
    )
    judged = judged.where((F.col("span.kind") < len(BASE)) | F.col("live"))
    span = F.struct("span.start", "span.kind", "span.end", "value", "n_repositories", "n_owners", "live")
    lists = judged.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast(lists.schema["spans"].dataType)
    return found.join(lists, ["k1", "k2"], "left").select("row", F.coalesce("spans", none).alias("spans"))


def shown(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    found = scanned(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "row.doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_copied"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["n_owners"])), F.lit(0)).alias("most_owners"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["n_repositories"])), F.lit(0)).alias("most_repositories"),
    )
