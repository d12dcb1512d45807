"""Merkle manifest of a data set by concatenated-level strings.

Every row is a leaf: the SHA-256 of its fields, each with its length. The leaves of a group, in order, are hashed ``FAN`` at a
time, level by level, to the group's root, and the groups' roots likewise to the root of all.

Leaves are numbered within their group by a range sort, and ``FAN`` to the power of ``LEVELS`` aligned leaves are a block. A block
keeps each of its levels as one hex string: fixed-width substrings of it, hashed, are the next level's string, and the substrings
left and right of a node within its run are its sibling segments. A block ends in one node; those nodes are the leaves of the
next round, until a group is one block. Paths go down again by a join on blocks. So no task sees more than its range or block,
whatever a group's share of the rows.

Null fields count as ``-``, a null group is a group (the first), null order values come first. Rows of equal order are told apart
by leaf, equal rows by their place in the input: their leaves are the same, so it is open which of the two has which path.
Empty and very long texts are fields like any other. An empty table has no rows and no root. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.keys import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes under one parent.
FAN = 8
#: Levels of a block: 64 leaves, strings of 4,096 and 512 digits.
LEVELS = 2
#: Hex digits of a node.
WIDTH = 64
_BLOCK = FAN**LEVELS
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ROWS = (1 << 33) - 1


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_of(fields: Mapping[str, Column]) -> Column:
    """The leaf of the fields in their order."""
    texts = [c.cast("string") for c in fields.values()]
    return digest(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)))


def _placed(nodes: DataFrame, label: str) -> DataFrame:
    """``nodes`` (``g``, ``o``, ``node``, ``row``) with their place ``at`` in the group ``g`` by ``o``, and ``n``, its nodes."""
    by = ["g", "o", "node", "i"]
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Staged before it is sorted, since a range shuffle reads its input twice.
    source = stage(nodes.withColumn("i", F.monotonically_increasing_id()), label)
    ranged = source.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("i", F.monotonically_increasing_id())
    ordered = stage(ranged.drop("o"), f"{label}-in-order").withColumn("part", F.shiftright("i", 33))
    # One row per range, as many as there are shuffle partitions.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("part").agg(F.count("*").alias("rows")).select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    numbered = ordered.join(F.broadcast(parts), "part").select("g", "node", "row", (F.col("i").bitwiseAND(_ROWS) + F.col("before")).alias("place"))
    groups = numbered.groupBy(F.col("g").alias("of")).agg(F.min("place").alias("start"), F.count("*").alias("n"))
    # Few rows, if groups are languages: Spark broadcasts them from their size.
    joined = numbered.join(stage(groups, f"{label}-groups"), F.col("g").eqNullSafe(F.col("of")))
    return joined.select("g", "node", "row", (F.col("place") - F.col("start")).alias("at"), "n")


def _cut(string: Column, start: Column, length: Column) -> Column:
    """Nodes of a level's string by their number."""
    return F.substring(string, (start * WIDTH + 1).cast("int"), (length * WIDTH).cast("int"))


def _parents(string: Column) -> Column:
    """The next level's string."""
    runs = F.ceil(F.length(string) / (FAN * WIDTH)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda k: digest(_cut(string, k * FAN, F.lit(FAN)))), "")


def _segments(strings: Sequence[Column], at: Column) -> Column:
    """Siblings left and right of the node ``at`` and of its parents, one pair for each level that the block hashes."""
    pairs = []
    for level, string in enumerate(strings):
        place = F.floor(at / FAN**level).cast("int")
        run = place - place % FAN
        pair = F.struct(_cut(string, run, place - run).alias("left"), _cut(string, place + 1, run + FAN - 1 - place).alias("right"))
        pairs.append(F.when(F.col("n") > FAN**level, pair))
    return F.filter(F.array(*pairs), lambda p: p.isNotNull())


def _tree(nodes: DataFrame, label: str, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Of ``nodes`` (``g``, ``at``, ``node``, ``row``, ``n``) per node ``row``, ``path`` to the group's top and that ``top``; per group
    ``g`` its ``top``."""
    member = F.struct((F.col("at") % _BLOCK).cast("int").alias("at"), "node", "row")
    block = F.floor(F.col("at") / _BLOCK).alias("block")
    blocks = nodes.groupBy("g", "n", block).agg(F.array_sort(F.collect_list(member), lambda a, b: a["at"] - b["at"]).alias("members"))
    blocks = blocks.withColumn("s0", F.array_join(F.transform("members", lambda m: m["node"]), "")).withColumn(
        "members", F.transform("members", lambda m: m["row"])
    )
    for level in range(1, LEVELS + 1):
        blocks = blocks.withColumn(f"s{level}", F.when(F.col("n") > FAN ** (level - 1), _parents(F.col(f"s{level - 1}"))))
    top = F.coalesce(*(F.col(f"s{level}") for level in range(LEVELS, -1, -1)))
    blocks = stage(blocks.withColumn("node", top).drop(f"s{LEVELS}"), f"{label}-blocks")
    if most is None:
        most = blocks.agg(F.max("n")).first()[0] or 0
    if most <= _BLOCK:
        above = blocks.withColumn("path", F.array().cast("array<struct<left:string,right:string>>")).withColumnRenamed("node", "top")
        tops = blocks.select("g", F.col("node").alias("top"))
    else:
        upper = blocks.select("g", F.col("block").alias("at"), "node", F.struct("g", "block").alias("row"), F.ceil(F.col("n") / _BLOCK).alias("n"))
        paths, tops = _tree(upper, f"{label}-", -(-most // _BLOCK))
        paths = paths.select(F.col("row.g").alias("of"), F.col("row.block").alias("of_block"), "path", "top")
        above = blocks.join(paths, F.col("g").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block")))
    strings = [F.col(f"s{level}") for level in range(LEVELS)]
    of_member = F.transform("members", lambda row, i: F.struct(row.alias("row"), F.concat(_segments(strings, i), F.col("path")).alias("path")))
    return above.select("top", F.inline(of_member)).select("row", "path", "top"), tops


def manifest(
    docs: DataFrame, *, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", given: Mapping[str, Column] | None = None
) -> DataFrame:
    """Per row of ``docs`` ``row`` (``order`` and the columns ``given``), ``leaf``, ``path`` (sibling segments ``left`` and ``right`` of
    every level, from the leaf up), ``subroot`` of its group and ``root``."""
    leaf = leaf_of({c: F.col(c) for c in fields})
    kept = F.struct(F.col(order).alias(order), leaf.alias("leaf"), *(c.alias(name) for name, c in (given or {}).items()))
    nodes = docs.select(F.col(group).alias("g"), F.col(order).alias("o"), leaf.alias("node"), kept.alias("row"))
    # The group goes with the row, to find the group's own path.
    placed = _placed(nodes, "leaves")
    members, tops = _tree(placed.withColumn("row", F.struct("g", "row")), "leaves")
    subroots = tops.select(F.lit(0).alias("g"), F.col("g").alias("o"), F.col("top").alias("node"), F.col("g").alias("row"))
    groups, _ = _tree(_placed(subroots, "subroots"), "subroots")
    groups = stage(groups.select(F.col("row").alias("of"), F.col("path").alias("upper"), F.col("top").alias("root")), "subroot-paths")
    joined = members.join(groups, F.col("row.g").eqNullSafe(F.col("of")))
    return joined.select(
        F.col("row.row").dropFields("leaf").alias("row"), F.col("row.row.leaf").alias("leaf"), F.concat("path", "upper").alias("path"),
        F.col("top").alias("subroot"), "root",
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, p: digest(F.concat(p["left"], node, p["right"])))


def proof(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def op11_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(chosen, F.translate("text", _CAPITALS, _CAPITALS.lower())).otherwise(F.col("text"))
    tampered = leaf_of({c: text if c == "text" else F.col(c) for c in FIELDS})
    found = manifest(docs, given={"tampered": F.when(chosen, tampered)})
    shown = found.select(
        "row.doc_id", "leaf", "subroot", "root", digest(proof(F.col("path"))).alias("proof_sha256"),
        folded(F.coalesce("row.tampered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = r"""
with recursive doc as (
  select doc_id, lang, list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) as crc,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id::varchar, '-') || coalesce(strlen(source) || ':' || source, '-') ||
    coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars::varchar, '-') as head,
    coalesce(strlen(text) || ':' || text, '-') as body,
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') as lower_body
  from documents
), leaf as (
  select doc_id, lang, sha256(head || body) as node, sha256(head || case when xor(crc, 4294967295) % 3 = 0 then lower_body else body end) as tampered
  from doc
), placed as (
  select *, coalesce('l' || lang, '') as g, row_number() over (partition by lang order by doc_id nulls first, node) - 1 as place from leaf
), lev(g, lvl, place, node) as (
  select g, 0, place, node from placed
  union all
  select g, lvl + 1, place // 8, sha256(string_agg(node, '' order by place))
  from (select *, count(*) over (partition by g) as n from lev) where n > 1 group by g, lvl, place // 8
), height as (
  select g, max(lvl) as height from lev group by g
), sub as (
  select g, node, row_number() over (order by g) - 1 as place from lev join height using (g) where lvl = height
), upper(lvl, place, node) as (
  select 0, place, node from sub
  union all
  select lvl + 1, place // 8, sha256(string_agg(node, '' order by place))
  from (select *, count(*) over () as n from upper) where n > 1 group by lvl, place // 8
), root as (
  select node as root from upper order by lvl desc limit 1
), way as (
  select doc_id, placed.g, k as lvl, placed.place // (8 ** k)::bigint as place, false as up
  from placed join height using (g), lateral (select unnest(range(0, height)) as k)
  union all
  select doc_id, sub.g, 1000 + k, sub.place // (8 ** k)::bigint, true
  from placed join sub using (g), lateral (select unnest(range(0, (select max(lvl) from upper))) as k)
), node as (
  select g, lvl, place, node, false as up from lev union all select null, 1000 + lvl, place, node, true from upper
), sib as (
  select way.doc_id, way.lvl, coalesce(string_agg(node.node, '' order by node.place) filter (node.place < way.place), '') as l,
    coalesce(string_agg(node.node, '' order by node.place) filter (node.place > way.place), '') as r
  from way join node on node.up = way.up and (way.up or node.g = way.g) and node.lvl = way.lvl and node.place // 8 = way.place // 8
  group by way.doc_id, way.lvl
), step as (
  select *, row_number() over (partition by doc_id order by lvl) as k from sib
), fold(doc_id, k, acc) as (
  select doc_id, 0, tampered from placed
  union all
  select fold.doc_id, step.k, sha256(l || acc || r) from fold join step on step.doc_id = fold.doc_id and step.k = fold.k + 1
), folded as (
  select doc_id, arg_max(acc, k) as folded_root from fold group by doc_id
), proof as (
  select doc_id, string_agg(l || r, '' order by lvl) as proof from sib group by doc_id
)
select placed.doc_id, placed.node as leaf, sub.node as subroot, root, sha256(coalesce(proof, '')) as proof_sha256, folded_root, folded_root = root as verified
from placed join sub using (g) cross join root join folded on folded.doc_id = placed.doc_id left join proof on proof.doc_id = placed.doc_id
"""
