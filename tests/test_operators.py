from __future__ import annotations

import random
import re
from collections import Counter
from datetime import date

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from rosterlake import fixed_values as fv
from rosterlake.operators import late, quality as dq
from rosterlake.operators.dedupe import distinct_flag, duplicate_keys, duplicated_rows, keep_one
from rosterlake.operators.flags import flag_from
from rosterlake.operators.joins import keyed_join, repeated_right_join
from rosterlake.operators.late import keep_one_late
from rosterlake.operators.periods import extend_latest_period, sort_by_period
from rosterlake.operators.reconcile import reconcile_counts
from rosterlake.operators.shape import (
    align_schema,
    cast_strict,
    require_columns,
    require_schema,
    select_present,
    select_rename,
)
from rosterlake.operators.stages import expand_stages
from rosterlake.operators.upsert import has_hot_key, new_rows, updated_rows, upsert_with_overrides
from rosterlake.plans import hires
from rosterlake.sources.tables import stage
from tests.conftest import plan, values

# --- shape -------------------------------------------------------------------------------------------


def test_align_schema(table):
    df = table("m string, a string, extra int", ("1", "x", 5), ("abc", None, 6))
    got = align_schema(df, fv.layout(z="date", a="string", m="int"))
    assert got.dtypes == [("z", "date"), ("a", "string"), ("m", "int")]
    assert got.collect() == [(None, "x", 1), (None, None, None)]


def test_align_schema_of_nothing_keeps_the_schema(table):
    got = align_schema(table("a string"), fv.layout(a="int", b="date"))
    assert got.dtypes == [("a", "int"), ("b", "date")] and got.count() == 0


def test_select_rename_and_present(table):
    df = table("`Job ID` string, `A.b` int", ("x", 1))
    got = select_rename(df, {"A.b": "b", "Missing": "m", "Job ID": "job_id"})
    assert got.columns == ["b", "job_id"] and got.collect() == [(1, "x")]
    assert select_present(got, ["job_id", "nope", "b"]).columns == ["job_id", "b"]


def test_guards(table):
    df = table("a int, b string, c int", (1, "x", 2))
    require_schema(df, fv.layout(a="int", b="string"))
    with pytest.raises(ValueError, match="a is int instead of smallint"):
        require_schema(df, fv.layout(a="short"))
    with pytest.raises(ValueError, match="zz is absent instead of smallint"):
        require_schema(df, fv.layout(zz="short"))
    with pytest.raises(ValueError, match="missing required columns"):
        require_columns(df, ["a", "q"])


def test_cast_strict_fails_on_overflow(table):
    df = table("a int", 70000)
    with pytest.raises(ArithmeticException):
        cast_strict(df, fv.layout(a="short")).collect()


# --- dedupe ------------------------------------------------------------------------------------------


def random_rows(seed, n=400):
    rng = random.Random(seed)
    pick = lambda *xs: rng.choice(xs)
    return [
        (pick("hot", "hot", "a", "b", None, "c"), pick(1, 2, 3, None), pick("x", "y", None), rng.randint(0, 2))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("nulls_win", [False, True])
def test_keep_one_against_brute_force(table, seed, nulls_win):
    rows = random_rows(seed)
    least = lambda v: (v is not None, v if v is not None else 0)
    most = lambda v: (v is None, v if v is not None else 0)
    rank = lambda r: ((most if nulls_win else least)(r[1]), (r[2] is not None, r[2] or ""), r[3])
    best = {}
    for r in rows:
        if r[0] not in best or rank(r) > rank(best[r[0]]):
            best[r[0]] = r
    df = table("k string, d int, s string, n int", *rows)
    for shuffled in (df, df.repartition(7), df.orderBy("n")):
        got = keep_one(shuffled, ["k"], ["d"], nulls_win=nulls_win)
        assert got.columns == df.columns
        assert {r["k"]: tuple(r) for r in got.collect()} == best


def test_keep_one_reduces_before_its_only_shuffle(spark, tmp_path):
    spark.range(1000).selectExpr("id % 3 as k", "id as d", "cast(id as string) as s").write.parquet(f"{tmp_path}/t")
    shown = plan(keep_one(spark.read.parquet(f"{tmp_path}/t"), ["k"], ["d"]))
    assert shown.count("Exchange") == 1 and "partial_max" in shown and "Window" not in shown


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("nulls_win", [False, True])
def test_keep_one_late_is_keep_one(spark, table, tmp_path, seed, nulls_win):
    """From several files; ``few`` has many ties, repeated rows among them, and a key with a third of the rows."""
    rows = random_rows(seed)
    few = [("hot" if i % 3 else r[0], None if i % 5 == 0 else 7, r[2], i % 4) for i, r in enumerate(rows * 3)]
    for name, some in (("rows", rows), ("few", few), ("none", [])):
        table("k string, d int, s string, n int", *some).repartition(3).write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        for keys, prefer in ((["k"], ["d"]), (["k", "n"], []), (["n"], ["d", "s"])):
            got = keep_one_late(df, keys, prefer, nulls_win=nulls_win)
            assert got.columns == df.columns and values(got) == values(keep_one(df, keys, prefer, nulls_win=nulls_win))
    # After a projection and a filter that keep the file's rows apart.
    changed = spark.read.parquet(f"{tmp_path}/rows").where("n % 2 = 0").withColumn("d", F.col("d") % 3)
    assert values(keep_one_late(changed, ["k"], ["d"])) == values(keep_one(changed, ["k"], ["d"]))


def test_keep_one_late_sorts_no_wide_row(spark, tmp_path, monkeypatch):
    columns = [F.col("id").alias("n"), *(F.sha2(F.col("id").cast("string"), 256).alias(f"wide{i}") for i in range(5))]
    spark.range(3000).select((F.col("id") % 50).alias("k"), (F.col("id") % 700).alias("d"), *columns).write.parquet(f"{tmp_path}/t")
    plans = []
    monkeypatch.setattr(late, "stage", lambda df, label: plans.append(plan(df)) or stage(df, label))
    got = keep_one_late(spark.read.parquet(f"{tmp_path}/t"), ["k"], ["d"])
    assert got.count() == 50 and len(plans) == 2
    assert "wide" not in plans[0]
    ordered = [line for shown in plans for line in shown.splitlines() if re.search(r"Sort|Aggregate|SortMergeJoin", line)]
    assert ordered and not any("wide" in line for line in ordered)
    assert plans[1].count("ShuffledHashJoin") == 1 and "Window" not in plans[1]


def test_keep_one_on_key_columns_alone(table):
    assert values(keep_one(table("k string", "a", "a", None, None), ["k"])) == [(None,), ("a",)]


def test_duplicates_count_null_keys_as_equal(table):
    df = table("a string, b int, n int", ("x", 1, 0), ("x", 1, 1), (None, 1, 2), (None, 1, 3), ("x", None, 4))
    assert values(duplicate_keys(df, ["a", "b"])) == [(None, 1, 2), ("x", 1, 2)]
    assert sorted(r["n"] for r in duplicated_rows(df, ["a", "b"]).collect()) == [0, 1, 2, 3]
    assert dq.duplicate_violations(df, ["a", "b"]).collect() == [("unique", "a, b", 4)]
    assert dq.duplicate_violations(df, ["n"]).collect() == [("unique", "n", 0)]


def test_distinct_flag_keeps_null(table):
    got = distinct_flag(table("k string, x int", ("a", 1), ("a", 2), (None, 3), (None, 4)), "k", "has")
    assert values(got) == [(None, 1), ("a", 1)] and dict(got.dtypes)["has"] == "tinyint"


# --- joins -------------------------------------------------------------------------------------------


def joined_by_hand(left, right, how, null_safe=False):
    out = []
    for a in left:
        met = [b for b in right if a[0] == b[0] and (null_safe or a[0] is not None)]
        if how == "left":
            out += [(*a, b[1]) for b in met] or [(*a, None)]
        elif bool(met) == (how == "left_semi"):
            out.append(a)
    return Counter(out)


RIGHT = [("hot", 1), ("hot", 2), ("hot", 2), ("a", 3), (None, 4), ("b", 5), ("b", 6), ("only right", 7)]


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_keyed_join_is_a_join(table, how):
    left = [(r[0], i) for i, r in enumerate(random_rows(5, 60))] + [("only left", 0)]
    got = keyed_join(table("k string, i int", *left), table("k string, v int", *RIGHT), ["k"], how)
    assert Counter(tuple(r) for r in got.collect()) == joined_by_hand(left, RIGHT, how)
    with pytest.raises(ValueError):
        keyed_join(got, got, ["k"], "inner")


def test_keyed_join_on_two_keys(table):
    left = table("a string, b int, i int", ("x", 1, 0), ("x", None, 1), (None, 1, 2), ("y", 1, 3))
    right = table("v int, b int, a string", (5, 1, "x"), (6, None, "x"), (7, 1, None))
    assert values(keyed_join(left, right, ["a", "b"], "left"), "i", "v") == [(0, 5), (1, None), (2, None), (3, None)]
    assert values(keyed_join(left, right, ["a", "b"], "left_anti"), "i") == [(1,), (2,), (3,)]


@pytest.mark.parametrize("times", [0, 1, 40])
def test_repeated_right_join_is_a_join(table, times):
    left = [(r[0], i) for i, r in enumerate(random_rows(5, 60))] + [("only left", 0)]
    right = RIGHT + [("hot", 100 + i) for i in range(times)] + [("a", 1)] * times + [(None, 9)] * times
    got = repeated_right_join(table("k string, i int", *left), table("k string, v int", *right), ["k"])
    assert Counter(tuple(r) for r in got.collect()) == joined_by_hand(left, right, "left")
    none = repeated_right_join(table("k string, i int", *left), table("k string, v int"), ["k"])
    assert Counter(tuple(r) for r in none.collect()) == joined_by_hand(left, [], "left")


@pytest.fixture
def no_help(spark):
    """Neither adaptive skew handling nor broadcast: what spreads the rows has to be the join itself."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    for key, value in saved.items():
        spark.conf.set(key, value)


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_null_keys_stay_where_they_are(spark, no_help, tmp_path):
    spark.range(60000).selectExpr("if(id % 2 = 0, null, cast(id as string)) as k", "'same' as payload").write.parquet(f"{tmp_path}/l")
    spark.range(60000).selectExpr("cast(id as string) as k", "id as v").write.parquet(f"{tmp_path}/r")
    left, right = spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r")
    got = keyed_join(left, right, ["k"], "left")
    assert got.count() == 60000 and got.where("v is null").count() == 30000
    assert largest_share(left.join(right, "k", "left").where("v is not null or k is null")) > 0.49
    shown = plan(got)
    assert shown.count("Exchange hashpartitioning") == 2 and "Generate" not in shown and "isnull(k" in shown


def test_a_hot_right_key_spreads_without_a_job_at_plan_time(spark, no_help, tmp_path):
    spark.range(3000).selectExpr("cast(id as string) as k").union(spark.sql("select 'hot'")).write.parquet(f"{tmp_path}/l")
    spark.range(30000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id as v").write.parquet(
        f"{tmp_path}/r"
    )
    left, right = spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r")
    plain = left.join(right, "k", "left")
    spark.sparkContext.setJobGroup("planning", "planning")
    spread = repeated_right_join(left, right, ["k"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    assert spread.where("k = 'hot'").count() == 10000 and spread.count() == plain.count()
    assert largest_share(plain) > 0.75 and largest_share(spread) < 0.25


def test_rows_that_are_equal_spread_by_their_place(spark, no_help, tmp_path):
    spark.sql("select 'hot' as k").write.parquet(f"{tmp_path}/l")
    spark.range(30000).selectExpr("'hot' as k", "1 as v").write.parquet(f"{tmp_path}/r")
    left = spark.read.parquet(f"{tmp_path}/l")
    right = spark.read.parquet(f"{tmp_path}/r")
    place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    spread = repeated_right_join(left, right, ["k"], place)
    assert spread.columns == ["k", "v"] and spread.count() == 30000 and largest_share(spread) < 0.2


# --- upsert ------------------------------------------------------------------------------------------

MASTER = fv.layout(id="string", name="string", source="string", source_exception="string", note="string")


def upserted(table, master, incoming, columns="id string, name string, source string", **options):
    m = table("id string, name string, source string, source_exception string, note string", *master)
    return upsert_with_overrides(m, table(columns, *incoming), "id", MASTER, **options)


def test_upsert_precedence_and_new_rows(table):
    got = upserted(
        table,
        [
            ("1", "old", "old", None, "n"),  # updated
            ("2", "old", "old", "manual", "n"),  # override beats incoming
            ("3", "old", "old", "manual", "n"),  # override holds without a match, too
            ("4", "old", "old", None, "n"),  # untouched
            ("5", "old", "old", None, "n"),  # incoming null keeps the value
        ],
        [("1", "new", "new"), ("2", "new", "new"), ("5", None, None), ("6", "fresh", "fresh")],
    )
    assert values(got) == [
        ("1", "new", "new", None, "n"),
        ("2", "new", "manual", "manual", "n"),
        ("3", "old", "manual", "manual", "n"),
        ("4", "old", "old", None, "n"),
        ("5", "old", "old", None, "n"),
        ("6", "fresh", "fresh", None, None),
    ]


def test_upsert_null_keys_never_match(table):
    got = upserted(table, [(None, "old", None, None, "n")], [(None, "new", None), (None, "new", None)])
    assert values(got, "name") == [("new",), ("new",), ("old",)]


def test_upsert_repeated_incoming_keys(table):
    master, incoming = [("1", "old", None, None, "n")], [("1", "b", None), ("1", "a", None), (None, "x", None)]
    assert values(upserted(table, master, incoming), "name") == [("a",), ("b",), ("x",)]
    assert values(upserted(table, master, incoming, one_per_key=True), "name") == [("b",), ("x",)]


def test_override_needs_its_column_in_incoming(table):
    got = upserted(table, [("1", "old", "old", "manual", "n")], [("1", "new")], "id string, name string")
    assert values(got) == [("1", "new", "old", "manual", "n")]


def test_upsert_with_nothing_incoming(table):
    master = [("1", "old", "s", None, "n"), (None, "old", "s", "m", "n")]
    assert values(upserted(table, master, [])) == [(None, "old", "m", "m", "n"), ("1", "old", "s", None, "n")]


def test_upsert_aligns_what_comes_in(table):
    got = upserted(table, [("1", "old", "s", None, "n")], [(1, 5, "x"), (2, 6, "y")], "id int, name int, other string")
    assert values(got) == [("1", "5", "s", None, "n"), ("2", "6", None, None, None)]


def test_upsert_with_repeated_keys_gives_the_same_rows(table):
    master = [("hot", f"m{i}", None, None, "n") for i in range(30)] + [("1", "old", None, None, "n"), (None, "z", None, None, None)]
    incoming = [("hot", f"i{i}", "s") for i in range(3)] + [("new", f"n{i}", None) for i in range(30)] + [("1", "up", None)]
    assert values(upserted(table, master, incoming, repeated=True)) == values(upserted(table, master, incoming))


def test_a_hot_position_is_dealt_out(spark, no_help, tmp_path):
    """A third of the incoming rows under one position: no task of the upsert gets a quarter of them."""
    spark.range(400).selectExpr("concat('p', id) as jrpos_id", "cast(id as string) as job_requisition_id").write.parquet(f"{tmp_path}/m")
    incoming = "if(id % 3 = 0, 'p7', concat('p', id % 500)) as jrpos_id", "concat('e', id) as employee_id", "concat('s', id) as source"
    spark.range(9000).selectExpr(*incoming).write.parquet(f"{tmp_path}/i")
    m, i = spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/i")
    assert has_hot_key(i, "jrpos_id") and not has_hot_key(i.dropDuplicates(["jrpos_id"]), "jrpos_id")
    merged = hires.merge_hires(m, i)
    assert merged.where("jrpos_id = 'p7'").count() == 3012 and largest_share(merged.where("jrpos_id = 'p7'")) < 0.25
    plain = upsert_with_overrides(align_schema(m, fv.MASTER_HIRES), i, "jrpos_id", fv.MASTER_HIRES)
    assert values(merged) == values(plain)


def test_upsert_shuffles_each_side_once_by_its_key(spark, no_help, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) as id", "'old' as name").write.parquet(f"{tmp_path}/m")
    spark.range(500, 1500).selectExpr("cast(id as string) as id", "'new' as name").write.parquet(f"{tmp_path}/i")
    m, i = spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/i")
    shown = plan(updated_rows(m, i, "id"))
    assert shown.count("Exchange hashpartitioning") == 2 and "Generate" not in shown
    flagged = plan(flag_from(m, i.select("id", F.lit(1).cast("byte").alias("f")), "id", "f"))
    assert flagged.count("Exchange hashpartitioning") == 2 and "Generate" not in flagged
    fresh = plan(new_rows(m, i, "id", fv.layout(id="string", name="string")))
    assert fresh.count("Exchange hashpartitioning") == 3 and "Generate" not in fresh


def test_master_is_not_shuffled_for_a_small_update(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) as id", "'old' as name").write.parquet(f"{tmp_path}/m")
    spark.range(10).selectExpr("cast(id as string) as id", "'new' as name").write.parquet(f"{tmp_path}/i")
    m, i = spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/i")
    shown = plan(updated_rows(m, i, "id"))
    assert "BroadcastHashJoin" in shown and "Exchange hashpartitioning" not in shown
    shown = plan(new_rows(m, i, "id", fv.layout(id="string", name="string")))
    scan_to_semi = shown[shown.index("LeftSemi") :]
    assert "LeftAnti" in shown and "BroadcastHashJoin" in shown
    assert "Exchange hashpartitioning" not in scan_to_semi[: scan_to_semi.index("BroadcastExchange")]


# --- reconcile, stages, periods, flags ---------------------------------------------------------------


def test_reconcile_counts(table):
    declared = table("id string, n short", ("a", 2), ("b", 1), ("c", None), ("d", 0), ("e", 3), ("e", 1), (None, 4))
    observed = table("id string, x int", ("a", 1), ("b", 1), ("c", 1), ("z", 1), (None, 1))
    got = reconcile_counts(declared, "n", observed, "id")
    assert values(got) == [(None, 4, 0, 4), ("a", 2, 1, 1), ("c", 0, 1, 1), ("e", 3, 0, 3)]
    assert got.dtypes == [
        ("id", "string"), ("declared_count", "int"), ("observed_count", "bigint"), ("discrepancy", "bigint")
    ]


def test_reconcile_reuses_its_partitioning(spark, no_help):
    d = spark.range(100).selectExpr("cast(id as string) as id", "cast(1 as short) as n")
    shown = plan(reconcile_counts(d, "n", d, "id"))
    assert shown.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize(
    "last, unfinished, expected",
    [
        (4, True, [1, 2, 3]),
        (4, False, [1, 2, 3, 4]),
        (4, None, [1, 2, 3, 4]),
        (1, True, []),
        (1, False, [1]),
        (6, True, [1, 2, 3, 4]),
        (8, False, [1, 2, 3, 4, 6, 7, 8]),
        (None, False, []),
        (0, False, []),
    ],
)
def test_expand_stages(table, last, unfinished, expected):
    stages = {label: n for label, n in fv.STAGES.items() if n != 5}
    df = table("id int, last short, open boolean", (1, last, unfinished))
    got = expand_stages(df, F.col("last"), F.col("open"), stages).orderBy("stage_number").collect()
    assert [r["stage_number"] for r in got] == expected
    assert all(fv.STAGES[r["stage"]] == r["stage_number"] for r in got)


MONTHS = [date(2025, 1, 31), date(2025, 2, 28)]


def test_latest_period_is_carried_on(table):
    df = table("d date, e string", (MONTHS[0], "a"), (MONTHS[0], "b"), (MONTHS[1], "a"), (MONTHS[1], "c"), (None, "x"))
    got = extend_latest_period(df, "d", date(2025, 6, 3))
    assert got.columns == ["d", "e"]
    assert values(got.where("d > '2025-02-28'")) == [(date(2025, 6, 30), "a"), (date(2025, 6, 30), "c")]
    assert got.count() == 7


@pytest.mark.parametrize("as_of", [date(2025, 2, 1), date(2025, 1, 15), date(2024, 12, 5)])
def test_present_or_later_periods_are_left_alone(table, as_of):
    df = table("d date, e string", (MONTHS[0], "a"), (MONTHS[1], "a"))
    assert values(extend_latest_period(df, "d", as_of)) == values(df)


def test_period_of_nothing_and_of_text(table):
    assert extend_latest_period(table("d date, e string"), "d", date(2025, 6, 3)).count() == 0
    got = extend_latest_period(table("d string", "2025-01-31"), "d", date(2025, 2, 3))
    assert values(got) == [(MONTHS[0],), (MONTHS[1],)]


def test_extension_reads_rows_once_and_sorts_within_the_period(spark, tmp_path):
    spark.sql("select date'2025-01-31' as d, cast(id as string) as e from range(100)").write.parquet(f"{tmp_path}/t")
    got = extend_latest_period(spark.read.parquet(f"{tmp_path}/t"), "d", date(2025, 2, 3))
    assert plan(got).count("ReadSchema: struct<d:date,e:string>") == 1 and "CartesianProduct" not in plan(got)
    rows = [tuple(r) for r in sort_by_period(got, "d", ["e"]).collect()]
    assert rows == sorted(rows) and len(rows) == 200


def test_flag_from(table):
    df = table("k string, x int", ("a", 1), ("a", 2), ("b", 3), (None, 4))
    flags = table("k string, f byte", ("a", 1), ("c", 1), (None, 1))
    got = flag_from(df, flags, "k", "f")
    assert values(got, "x", "f") == [(1, 1), (2, 1), (3, 0), (4, 0)] and dict(got.dtypes)["f"] == "tinyint"


# --- quality -----------------------------------------------------------------------------------------


def test_violations_in_one_pass(table):
    df = table(
        "a int, s string, d date",
        (1, "OPEN", date(2025, 1, 1)), (None, "CAN", date(2025, 9, 9)), (9, None, None), (-1, "??", date(2025, 1, 1)),
    )
    checks = {
        **dq.not_null(["a", "s", "absent"], df.columns),
        **dq.in_domain({"s": ["OPEN", "CAN"]}),
        **dq.in_range("a", 0, 8),
        **dq.not_after("d", date(2025, 6, 1)),
        **dq.matches("s", "^[A-Z]+$"),
        **dq.implies("open_has_some", "a", F.col("s") == "OPEN", F.col("a") > 1),
    }
    report = dq.violations(df, checks)
    assert plan(report).count("Scan") == 1
    assert {(r["check"], r["column"]): r["violations"] for r in report.collect()} == {
        ("not_null", "a"): 1,
        ("not_null", "s"): 1,
        ("in_domain", "s"): 1,
        ("in_range", "a"): 2,
        ("not_after", "d"): 1,
        ("matches", "s"): 1,
        ("open_has_some", "a"): 1,
    }
