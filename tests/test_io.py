from __future__ import annotations

import os
import random
import time
from dataclasses import replace
from datetime import date
from types import SimpleNamespace

import pytest
from hypothesis import given, strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from rosterlake import fixed_values as fv
from rosterlake.__main__ import main
from rosterlake.operators.upsert import upsert_with_overrides
from rosterlake.plans import full_run
from rosterlake.sinks import tables as sinks
from rosterlake.sinks import versions
from rosterlake.sinks.merge import merge_table
from rosterlake.sources import drops, reports
from rosterlake.sources.tables import read_table, scratch_path, stage
from tests.conftest import plan, values

# --- names -------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "header, name",
    [
        ("Job Requisition ID", "job_requisition_id"),
        ("Positions Filled (Hire Selected)", "positions_filled_hire_selected"),
        ("target_hire_date", "target_hire_date"),
        ("  Name  ", "name"),
        ("A  B  C", "a_b_c"),
        ("", "col"),
        ("?!", "col"),
        ("__x__y__", "x_y"),
        ("Masterfile[Reporting Date]", "masterfile_reporting_date"),
        ("Sub-function", "sub_function"),
        ("Grade - Proposed", "grade_proposed"),
        ("Is cancelled?", "is_cancelled"),
        ("Größe (m²)", "größe_m²"),
    ],
)
def test_snake_name(header, name):
    assert reports.snake_name(header) == name


@given(st.lists(st.text(max_size=6), max_size=12))
def test_snake_names_are_distinct_and_tidy(headers):
    names = reports.snake_names(headers)
    assert len(names) == len(set(names)) == len(headers)
    assert all(n and n == n.strip("_") and "__" not in n and not any(c.isspace() for c in n) for n in names)


def test_snake_names_stay_distinct():
    assert reports.snake_names(["Name", "name", "NAME"]) == ["name", "name_1", "name_2"]
    assert reports.snake_names(["x", "x_1", "X"]) == ["x", "x_1", "x_2"]
    assert reports.snake_names([]) == []


# --- drops -------------------------------------------------------------------------------------------


def put(path, text="x\n", at=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    if at:
        os.utime(path, (at, at))


def test_newest_drop(spark, tmp_path):
    now = time.time()
    put(f"{tmp_path}/report 2025-06-01.csv", at=now - 50)
    put(f"{tmp_path}/report 2025-01-01.csv", at=now - 10)  # modified last, whatever its name says
    put(f"{tmp_path}/report 2024-01-01.csv/part-0.csv", at=now - 99)
    put(f"{tmp_path}/report 2024-01-01.csv/part-1.csv", at=now - 98)
    put(f"{tmp_path}/other.csv", at=now)
    newest = drops.newest_drop(spark, str(tmp_path), "report*.csv")
    assert newest["drop"] == "report 2025-01-01.csv" and newest["path"] == f"{tmp_path}/report 2025-01-01.csv"
    assert {r["drop"]: r["files"] for r in drops.list_drops(spark, f"{tmp_path}/", "report*").collect()} == {
        "report 2025-06-01.csv": 1, "report 2025-01-01.csv": 1, "report 2024-01-01.csv": 2}
    with pytest.raises(FileNotFoundError):
        drops.newest_drop(spark, str(tmp_path), "*.xlsx")
    with pytest.raises(FileNotFoundError):
        drops.newest_drop(spark, f"{tmp_path}/nowhere", "*")


def test_equally_new_drops(spark, tmp_path):
    now = time.time()
    for name in ("a.csv", "c.csv", "b.csv"):
        put(f"{tmp_path}/{name}", at=now)
    assert drops.newest_drop(spark, str(tmp_path), "*.csv")["drop"] == "c.csv"


def test_feed_date(spark, table):
    df = table("n string", "All Status 2025-06-01.csv", "r_2024-12-31_x2025-01-01", "none", "9999-99-99", None)
    got = [r[0] for r in df.select(drops.feed_date(F.col("n"))).collect()]
    assert got == [date(2025, 6, 1), date(2024, 12, 31), None, None, None]
    assert drops.require_feed_date("x 2025-06-01") == date(2025, 6, 1)
    for undated in ("nodate.csv", "9999-99-99"):
        with pytest.raises(ValueError, match="no date"):
            drops.require_feed_date(undated)


# --- reports -----------------------------------------------------------------------------------------


def report(preamble, header, *records):
    return "".join(f"{line}\n" for line in [*[f"about, line {i}" for i in range(preamble)], header, *records])


def test_report(spark, tmp_path):
    put(f"{tmp_path}/r.csv", report(3, 'ID,"Name, full",id,?', '1,"a, b",x,', "", '2,"say ""hi""",,y', '3,"",,'))
    got = reports.read_report(spark, f"{tmp_path}/r.csv", 3, snake=True)
    assert got.columns == ["id", "name_full", "id_1", "col"] and {d for _, d in got.dtypes} == {"string"}
    assert values(got) == [("1", "a, b", "x", None), ("2", 'say "hi"', None, "y"), ("3", "", None, None)]


def test_report_columns(spark, tmp_path):
    put(f"{tmp_path}/r.csv", report(0, "ID,Name", "1,a"))
    read = lambda **how: reports.read_report(spark, f"{tmp_path}/r.csv", **how)
    assert read().columns == ["ID", "Name"]
    assert read(names={"Name": "n", "Gone": "g"}).collect() == [("a",)]
    with pytest.raises(ValueError, match="Gone"):
        read(names={"Name": "n", "Gone": "g"}, strict=True)
    put(f"{tmp_path}/twice.csv", report(0, "ID,id", "1,a"))
    with pytest.raises(ValueError, match="repeats"):
        reports.read_report(spark, f"{tmp_path}/twice.csv")
    put(f"{tmp_path}/marked.csv", "\ufeff" + report(0, "ID,Name", "1,a"))
    assert reports.read_report(spark, f"{tmp_path}/marked.csv").columns == ["ID", "Name"]
    put(f"{tmp_path}/short.csv", "one\ntwo\n")
    with pytest.raises(ValueError, match="no header"):
        reports.read_report(spark, f"{tmp_path}/short.csv", 2)


@pytest.mark.parametrize("split", ["1k", "64m"])
def test_every_file_has_its_preamble_whatever_the_splits(spark, tmp_path, split):
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        expected = []
        for n in range(5):
            records = [f"{n},{i},{'x' * 20}" for i in range(40 * n + 1)]
            expected += [tuple(r.split(",")) for r in records]
            put(f"{tmp_path}/drop/part-{n}.csv", report(2, "file,line,text", *records))
        got = reports.read_report(spark, f"{tmp_path}/drop", 2)
        assert values(got) == sorted(expected, key=lambda r: [(True, v) for v in r])
        filtered = plan(got.where("line > 3 and text <> ''"))
        assert "Exchange" not in filtered and filtered.count("from_csv") == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)


def test_preamble_longer_than_a_batch(spark, tmp_path):
    saved = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        put(f"{tmp_path}/r.csv", report(13, "a,b", *[f"{i},x" for i in range(10)]))
        got = reports.read_report(spark, f"{tmp_path}/r.csv", 13)
        assert sorted(int(r["a"]) for r in got.collect()) == list(range(10))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", saved)


def test_a_file_with_another_header_fails(spark, tmp_path):
    put(f"{tmp_path}/drop/part-0.csv", report(1, "a,b", "1,2"))
    put(f"{tmp_path}/drop/part-1.csv", report(1, "b,a", "1,2"))
    with pytest.raises(PythonException, match="header differs"):
        reports.read_report(spark, f"{tmp_path}/drop", 1).collect()


@pytest.mark.parametrize("line_breaks", [False, True])
@pytest.mark.parametrize("record", ["3,Too,many,fields,here", "3", '3,"a,b"'])
def test_ragged_records_fail(spark, tmp_path, record, line_breaks):
    put(f"{tmp_path}/r.csv", report(2, "a,b,c", "1,2,3", record, "4,5,6"))
    with pytest.raises(Exception, match="r.csv.*(not 3 fields|Expected 3 columns)"):
        reports.read_report(spark, f"{tmp_path}/r.csv", 2, line_breaks=line_breaks).select("a").collect()


def test_quoted_line_breaks(spark, tmp_path):
    put(f"{tmp_path}/d/r.csv", report(2, "a,b,c", '1,Bob,"two', 'lines, ""here"""', "2, padded ,"))
    put(f"{tmp_path}/d/s.csv", report(2, "a,b,c", '3,"",x'))
    put(f"{tmp_path}/d/none.csv", "")
    got = reports.read_report(spark, f"{tmp_path}/d", 2, line_breaks=True)
    assert values(got) == [("1", "Bob", 'two\nlines, "here"'), ("2", " padded ", None), ("3", "", "x")]
    with pytest.raises(Exception, match="quoted line break"):
        reports.read_report(spark, f"{tmp_path}/d", 2).collect()


@pytest.fixture
def small_splits(spark):
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", saved)


def test_a_quoted_break_between_blocks(spark, tmp_path, small_splits):
    """Three tasks read the file, the second begins within one record and the third within another."""
    fields = [f"start {'x' * 80}\r\nmiddle, ""of"" the {'y' * 80}\n\nend", "plain", f"a\n{'z' * 130}\nb"]
    text = report(2, "a,b", *(f'"{f}",{i}' for i, f in enumerate(fields)), "last,9")
    put(f"{tmp_path}/r.csv", text)
    small_splits(len(text) // 3 + 1)
    got = reports.read_report(spark, f"{tmp_path}/r.csv", 2, line_breaks=True)
    blocks = spark.read.text(f"{tmp_path}/r.csv").select(F.col("_metadata.file_block_start").alias("at")).distinct().count()
    assert blocks == 3 and spark.read.text(f"{tmp_path}/r.csv").rdd.getNumPartitions() == 3
    assert values(got) == sorted([*((f.replace('""', '"'), str(i)) for i, f in enumerate(fields)), ("last", "9")])


@pytest.mark.parametrize("split", [40, 97, 400, 1 << 20])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_line_breaks_whatever_the_splits(spark, tmp_path, small_splits, split, ending):
    rng = random.Random(split)
    words = ["a", 'say ""so""', "\n", "\r\n", "\n\n", ",", "bc de", "é", "x" * 30, ""]
    expected = []
    for file in range(4):
        lines = ['preamble with a " quote', "id,note,more"]
        for i in range(rng.randrange(30)):
            note, more = ("".join(rng.choice(words) for _ in range(rng.randrange(6))) for _ in range(2))
            lines.append(f'{file}-{i},"{note}","{more}"')
            expected.append((f"{file}-{i}", note.replace('""', '"'), more.replace('""', '"')))
        os.makedirs(f"{tmp_path}/d", exist_ok=True)
        with open(f"{tmp_path}/d/f{file}.csv", "w", encoding="utf-8", newline="") as f:
            f.write(ending.join(lines) + ending * rng.randrange(2))
    small_splits(split)
    got = reports.read_report(spark, f"{tmp_path}/d", 1, line_breaks=True)
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_a_quoted_field_without_an_end_fails(spark, tmp_path):
    put(f"{tmp_path}/d/a.csv", report(1, "a,b", '"x,1', "y,2"))
    with pytest.raises(ValueError, match="a.csv: a quoted field does not end"):
        reports.read_report(spark, f"{tmp_path}/d", 1, line_breaks=True)


@pytest.mark.parametrize("line_breaks", [False, True])
def test_a_file_that_ends_before_its_header_fails(spark, tmp_path, line_breaks):
    put(f"{tmp_path}/d/a.csv", report(3, "a,b", "1,2"))
    put(f"{tmp_path}/d/b.csv", "one\ntwo\n")
    with pytest.raises(PythonException, match="no header"):
        reports.read_report(spark, f"{tmp_path}/d", 3, line_breaks=line_breaks).collect()


def test_a_preamble_beyond_the_first_block_fails(spark, tmp_path):
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        put(f"{tmp_path}/r.csv", report(40, "a,b", "1,2"))
        with pytest.raises((PythonException, ValueError), match="no header"):
            reports.read_report(spark, f"{tmp_path}/r.csv", 40).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)


# --- tables ------------------------------------------------------------------------------------------


def test_read_table_prunes_and_pushes(spark, tmp_path):
    spark.sql("select id as a, id as b, 'x' as c from range(10)").write.parquet(f"{tmp_path}/t")
    got = read_table(spark, f"{tmp_path}/t", ["c", "nope", "a"], F.col("b") > 7)
    shown = plan(got)
    assert got.columns == ["c", "a"] and got.count() == 2 and "GreaterThan(b,7)" in shown


def test_scratch_follows_the_session(spark):
    def session(folder=None, **conf):
        get = lambda k, d=None: conf.get(k[6:].replace(".", "_"), d)
        return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=SimpleNamespace(getCheckpointDir=lambda: folder))

    shared = session(master="spark://x", checkpoint_dir="s3a://shared/scratch/")
    assert scratch_path(shared, "x").startswith("s3a://shared/scratch/rosterlake/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")
    assert scratch_path(session("hdfs://c/1"), "x").startswith("hdfs://c/1/rosterlake/x-")
    for master in ("spark://x", "local[4]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(session(master=master), "x")


def test_staging(spark):
    staged = stage(spark.range(5).withColumn("v", F.lit(None).cast("date")), "numbers")
    assert staged.count() == 5 and "Range" not in plan(staged) and staged.dtypes[1] == ("v", "date")


def test_plain_sinks(spark, table, tmp_path):
    df = table("a int, b string", (1, "x"), (2, None))
    sinks.write_table(df, f"{tmp_path}/t.parquet")
    sinks.write_table(df, f"{tmp_path}/t.parquet")
    assert values(spark.read.parquet(f"{tmp_path}/t.parquet")) == [(1, "x"), (2, None)]
    assert [f for f in os.listdir(f"{tmp_path}/t.parquet") if f.endswith(".zstd.parquet")]
    sinks.write_refresh_date(spark, date(2025, 6, 1), f"{tmp_path}/refresh.csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/refresh.csv").collect() == [("2025-06-01",)]


def test_csv_keeps_text_as_it_is(spark, table, tmp_path):
    odd = ["  padded ", 'He said "hi", ok', "two\nlines", "", None, "back\\slash", '"', "a,b", "é　"]
    df = table("i int, v string, w string", *((i, v, v) for i, v in enumerate(odd)))
    sinks.write_csv(df, f"{tmp_path}/t.csv")
    assert values(sinks.read_csv(spark, f"{tmp_path}/t.csv", df.schema)) == values(df)
    with pytest.raises(Exception, match="(?i)malformed"):
        sinks.read_csv(spark, f"{tmp_path}/t.csv", "i int, v string").collect()


def test_versioned_table_can_replace_itself(spark, table, tmp_path):
    path = f"{tmp_path}/master.parquet"
    with pytest.raises(FileNotFoundError):
        sinks.read_current(spark, path)
    assert sinks.replace_table(table("a int", 1, 2), path) == 1
    first = sinks.read_current(spark, path)
    assert sinks.replace_table(first.union(table("a int", 3)), path) == 2
    assert values(sinks.read_current(spark, path)) == [(1,), (2,), (3,)]
    assert values(first) == [(1,), (2,)]
    with pytest.raises(ValueError, match=".parquet"):
        sinks.replace_table(first, f"{tmp_path}/master.csv")


def test_failed_replacement_leaves_the_table(spark, table, tmp_path):
    path = f"{tmp_path}/master.parquet"
    sinks.replace_table(table("a int", 1), path)
    broken = table("a int", 1).select(F.raise_error(F.lit("no")).cast("int").alias("a"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_table(broken, path)
    assert sinks.current_version(spark, path)[0] == 1 and values(sinks.read_current(spark, path)) == [(1,)]


def test_snapshots(spark, table, tmp_path):
    monday, tuesday = date(2025, 6, 2), date(2025, 6, 3)
    sinks.snapshot_tables({"t": table("a int", 1)}, str(tmp_path), monday)
    sinks.snapshot_tables({"t": table("a int", 2)}, str(tmp_path), tuesday)
    sinks.snapshot_tables({"t": table("a int", 3, 4)}, str(tmp_path), monday)
    got = spark.read.parquet(f"{tmp_path}/t")
    assert values(got) == [(2, tuesday), (3, monday), (4, monday)]
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan(got.where(F.col("snapshot_date") == F.lit(monday)))


def test_named_versions_and_vacuum(spark, table, tmp_path):
    path, folder = f"{tmp_path}/t.parquet", f"{tmp_path}/named"
    days = [date(2025, 6, 2), date(2025, 6, 3)]
    for n in range(1, 5):
        sinks.replace_table(table("a int", n), path)
        if n in (1, 3):
            sinks.name_versions(spark, {"t": path}, folder, days[n // 2])
    broken = table("a int", 1).select(F.raise_error(F.lit("no")).cast("int").alias("a"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_table(broken, path)
    gone = sinks.vacuum(spark, path, folder)
    assert len(gone) == 2 and gone[0].startswith("v000002-") and gone[1].startswith("v000005-")
    assert [values(sinks.read_named(spark, folder, d, "t")) for d in days] == [[(1,)], [(3,)]]
    assert values(sinks.read_current(spark, path)) == [(4,)]
    with pytest.raises(FileNotFoundError):
        sinks.read_named(spark, folder, days[0], "other")
    with pytest.raises(FileNotFoundError):
        sinks.vacuum(spark, f"{tmp_path}/none.parquet")


# --- a whole run from report drops -------------------------------------------------------------------


def csv_line(names, **cells):
    return ",".join(cells.get(new, "") for new in names.values())


@pytest.fixture
def folders(tmp_path):
    landing, historical = f"{tmp_path}/landing", f"{tmp_path}/historical"
    req_header = "Job Requisition ID,Target Hire Date,Positions Filled (Hire Selected),Positions Openings Available,MBPS Teams,Shift"
    named = lambda pattern, day: f"{landing}/{pattern.replace('*', '')} {day}.csv"
    old = report(13, req_header, "R90,2033-02-01,0,2,North,n")
    put(named(fv.REQUISITION_DROPS, "2033-04-09"), old, at=time.time() - 1000)
    put(
        named(fv.REQUISITION_DROPS, "2033-05-14"),
        report(13, req_header, "R31,2033-05-20,0,4,North,n", "R32,2031-01-02,3,0,South,n", "R31,45800,2,2,North,n",
               "R31,2033-01-09,5,0,North,n", "R33,2029-12-31,0,1,South,d"),
    )
    put(f"{landing}/Requisition - All Status of another firm.csv", report(13, req_header))
    put(
        named(fv.FULFILLMENT_DROPS, "2033-05-14"),
        report(7, ",".join(fv.FULFILLMENT_NAMES), "R31,P7,E41,Olu Adeyemi,Hire > Direct,2033-04-03,Level 2",
               "R38,P8,E48,Mei Sato,Transfer,2033-03-28,Level 6", "R32,P9,E49,Ana Ruiz,Hire,2033-04-11,Level 10"),
    )
    put(
        named(fv.HIRES_DROPS, "2033-05-14"),
        report(10, ",".join(fv.HIRES_NAMES), csv_line(fv.HIRES_NAMES, candidate_id="K5", employee_id="E41",
               candidate_start_date="2033-04-03", recruiter_completed_offer="Q5 (505)", source="Campus")),
    )
    common = dict(compensation_grade="Level 2", job_requisition_id="R31", source="Referral by staff",
                  added_date="2033/02/11", job_application_date="02/17/2033")
    put(
        named(fv.APPLICATION_DROPS, "2033-05-14"),
        report(16, ",".join(fv.APPLICATION_NAMES),
               csv_line(fv.APPLICATION_NAMES, **common, candidate_id="K4", last_recruiting_stage="Assessment",
                        candidate_recruiting_status="Rejected", referred_by_employee_id="E60", referred_by="Ivo",
                        recruiting_instruction='"first line\nsecond, ""quoted"""'),
               csv_line(fv.APPLICATION_NAMES, **common, candidate_id="K5", last_recruiting_stage="Ready for Hire",
                        candidate_recruiting_status="Offer Accepted", hired="Yes"),
               csv_line(fv.APPLICATION_NAMES, **{**common, "compensation_grade": "Level 10"}, candidate_id="K6")),
    )
    put(
        named(fv.PROSPECT_DROPS, "2033-05-14"),
        report(0, ",".join(fv.PROSPECT_NAMES), "K9,R31,E61,Noor (61),2033-03-05,Referral,,Prospect"),
    )
    put(
        f"{historical}/{fv.HEADCOUNT_DROPS.replace('*', '')}.csv",
        report(1, ",".join(fv.HEADCOUNT_NAMES), "2033-02-28 00:00:00,Oslo,Ops,Night,7,E60",
               "2033-03-31 00:00:00,Lima,Ops,Day,1,E61"),
    )
    return landing, historical


@pytest.fixture
def first_master(table):
    return table("jrpos_id string, job_requisition_id string, employee_id string", ("R31_P7", "R31", "E41"), ("R32_P6", "R32", "E42"))


DAY = date(2033, 5, 16)


def test_command_line(spark, folders, first_master, tmp_path):
    out = f"{tmp_path}/out"
    first_master.write.parquet(f"{tmp_path}/first")
    call = [folders[0], out, "--historical", folders[1], "--as-of", DAY.isoformat(), "--one-per-key"]
    with pytest.raises(FileNotFoundError):
        main(call)
    tables = main([*call, "--first-master", f"{tmp_path}/first"])
    assert tables["hires"].count() == 3 and tables["headcount"].count() == 3
    # Three years of requisitions without being told.
    assert values(tables["requisitions"], "job_requisition_id") == [("R31",), ("R32",)]
    with pytest.raises(SystemExit):
        main([*call, "--first-master", f"{tmp_path}/first"])


def test_full_run_from_drops(spark, folders, first_master, tmp_path, monkeypatch):
    out = f"{tmp_path}/out"
    sinks.replace_table(first_master, f"{out}/{full_run.MASTER}")
    found = full_run.read_reports(spark, *folders)
    assert found.refreshed == date(2033, 5, 14)
    tables = full_run.run(spark, found, out, DAY, 3)

    assert values(tables["requisitions"], "job_requisition_id", "target_hire_date", "jobreq_status") == [
        ("R31", date(2033, 5, 20), "OPEN"), ("R32", date(2031, 1, 2), "FILLED")]
    assert values(tables["hires"], "jrpos_id", "source") == [("R31_P7", "Campus"), ("R32_P6", None), ("R38_P8", None)]
    assert values(tables["hire_discrepancies"]) == [("R31", 0, 1, 1), ("R32", 3, 1, 2)]
    assert values(tables["applications"], "candidate_id", "recruiting_instruction") == [
        ("K4", 'first line\nsecond, "quoted"'), ("K5", None)]
    assert values(tables["offer_accepts"], "candidate_id") == [("K5",)]
    assert tables["funnel"].columns == fv.FUNNEL_COLUMNS and tables["funnel"].count() == 3 + 7
    assert values(tables["referrals"], "erp_id", "last_stage_number") == [("R31_E60_K4", 3), ("R31_E61_K9", 0), ("R31__K5", 8)]
    assert values(tables["headcount"], "headcount_id", "has_referral") == [("E60_2033-02", 1), ("E61_2033-03", 1), ("E61_2033-05", 0)]
    assert values(sinks.read_csv(spark, f"{out}/applications.csv", tables["applications"].schema)) == values(tables["applications"])
    assert spark.read.option("header", True).csv(f"{out}/refresh_date.csv").collect() == [("2033-05-14",)]
    for name, df in tables.items():
        named = sinks.read_named(spark, f"{out}/snapshots/processed", DAY, name)
        assert values(named.select(df.columns)) == values(df)
    assert spark.read.parquet(f"{out}/snapshots/raw/applications").count() == 3

    # A run that fails leaves every table as it was, and what it left behind can be removed.
    before = {name: values(df) for name, df in tables.items()}
    broken = lambda *a: tables["headcount"].select(F.raise_error(F.lit("broken off")).cast("date").alias("reporting_date"), F.lit("x").alias("employee_id"))
    monkeypatch.setattr(full_run, "with_referrals", broken)
    with pytest.raises(Exception, match="broken off"):
        full_run.run(spark, found, out, DAY, 3)
    monkeypatch.undo()
    seen = lambda: {name: values(full_run.read_run(spark, out, name).select(df.columns)) for name, df in tables.items()}
    assert seen() == before and full_run.last_run(spark, out)[0] == 1
    # What a writer leaves that falls after its data is written.
    versions.write_data(tables["headcount"], f"{out}/headcount.parquet", None)
    gone = full_run.vacuum(spark, out)
    assert len(gone["headcount"]) == 1 and set(gone) == {*tables, "hires_master", "headcount_months"}
    assert seen() == before

    # Started again, it takes what it had published: hires and the others are not worked on a second time.
    made = {name: sinks.current_version(spark, f"{out}/{name}.parquet").number for name in [*tables, "hires_master"]}
    assert made["hires_master"] == 3 and made["headcount"] == 1 and made["referrals"] == 2

    def never(*a, **b):
        raise AssertionError("worked on again")

    for name in ("incoming_hires", "merge_table", "read_applications", "corrected_applications", "clean_requisitions", "stage_funnel", "referral_funnel", "hire_discrepancies"):
        monkeypatch.setattr(full_run, name, never)
    again = full_run.run(spark, found, out, DAY, 3)
    monkeypatch.undo()
    now = {name: sinks.current_version(spark, f"{out}/{name}.parquet").number for name in made}
    assert now == made | {"headcount": 2} and full_run.last_run(spark, out)[0] == 2
    assert {name: values(df) for name, df in again.items()} == before == seen()

    # The next run is another, also with the same reports; hires are the master's files, not a copy.
    third = full_run.run(spark, found, out, DAY, 3)
    assert third["hires"].count() == 3 and sinks.current_version(spark, f"{out}/hires_master.parquet").number == 4
    assert sinks.current_version(spark, f"{out}/hires.parquet").paths == sinks.current_version(spark, f"{out}/hires_master.parquet").paths
    assert not os.path.exists(f"{out}/hires.parquet/data")

    # No month has changed, so none was written a second time.
    for name, n in {"headcount": 3, "headcount_months": 2, "applications": 1, "offer_accepts": 1, "funnel": 1}.items():
        first, last = (sinks.version_of(spark, f"{out}/{name}.parquet", n).paths for n in (1, 3))
        assert first == last and len(first) >= n
    with pytest.raises(FileNotFoundError):
        full_run.read_run(spark, out, "nothing")


def test_the_next_day_cleanses_only_months_that_changed(spark, folders, first_master, tmp_path, monkeypatch):
    """Of ten months of applications one row changes, and the oldest month leaves the scope: the tables are those of a run that
    starts from nothing."""
    found = full_run.read_reports(spark, *folders)
    given_on = F.element_at(F.array(*[F.lit(d) for d in ("12/17/2031", *(f"{m:02d}/17/2032" for m in range(1, 10)))]), (F.col("id") % 10 + 1).cast("int"))
    copies = found.applications.crossJoin(spark.range(200)).withColumns(
        {"candidate_id": F.concat_ws("-", "candidate_id", "id"), "job_application_date": given_on}
    )
    first_day = copies.drop("id")
    changed = F.when(F.col("candidate_id") == "K5-3", "Rejected").otherwise(F.col("candidate_recruiting_status"))
    second_day = first_day.withColumn("candidate_recruiting_status", changed)
    later, out, fresh = date(2032 + fv.APPLICATION_SCOPE_YEARS, 4, 1), f"{tmp_path}/out", f"{tmp_path}/fresh"
    for folder in (out, fresh):
        sinks.replace_table(first_master, f"{folder}/{full_run.MASTER}")
    full_run.run(spark, replace(found, applications=first_day), out, DAY, 3)
    before = {n: sinks.current_version(spark, f"{out}/{n}.parquet") for n in ("applications", "offer_accepts", "funnel")}
    assert {len(v.paths) for v in before.values()} == {10}
    cleansed = []
    correct = full_run.corrected_applications
    monkeypatch.setattr(full_run, "corrected_applications", lambda read: cleansed.append(read) or correct(read))
    got = full_run.run(spark, replace(found, applications=second_day), out, later, 3)
    monkeypatch.undo()
    wanted = full_run.run(spark, replace(found, applications=second_day), fresh, later, 3)
    for name in ("applications", "offer_accepts", "funnel", "referrals"):
        assert got[name].columns == wanted[name].columns and values(got[name]) == values(wanted[name])
    for name, earlier in before.items():
        paths = sinks.current_version(spark, f"{out}/{name}.parquet").paths
        assert len(paths) == 9 and {p[-10:] for p in set(paths) - set(earlier.paths)} == {"2032-03-01"}
    assert len(cleansed) == 1 and got["funnel"].where(F.col("candidate_id") == "K5-3").count() == 7


def test_two_writers_from_one_version(spark, table, tmp_path):
    path = f"{tmp_path}/t.parquet"
    sinks.replace_table(table("a int", 1), path)
    base = sinks.current_version(spark, path)
    assert sinks.replace_table(table("a int", 2), path, base=base) == 2
    with pytest.raises(sinks.Conflict):
        sinks.replace_table(table("a int", 3), path, base=base)
    assert values(sinks.read_current(spark, path)) == [(2,)]
    assert sinks.replace_table(sinks.read_current(spark, path).union(table("a int", 3)), path) == 3
    assert values(sinks.read_current(spark, path)) == [(2,), (3,)]
    assert not os.listdir(f"{path}/versions/_new")


def test_writers_at_once(spark, table, tmp_path):
    """Of several writers each version has one, and none is lost without an error."""
    from concurrent.futures import ThreadPoolExecutor

    path = f"{tmp_path}/t.parquet"
    sinks.replace_table(table("a int", -1), path)
    base = sinks.current_version(spark, path)

    def write(i):
        try:
            return sinks.replace_table(table("a int", i), path, base=base)
        except sinks.Conflict:
            return None

    with ThreadPoolExecutor(4) as workers:
        got = list(workers.map(write, range(4)))
    assert sorted(x for x in got if x) == [2] and values(sinks.read_current(spark, path)) == [(got.index(2),)]


MERGED = fv.layout(id="string", name="string", source="string", source_exception="string")


def _master(spark, path, files=100):
    """``files`` files of 20 rows; a row in each fifth file with an override."""
    rows = spark.range(0, files * 20, 1, files).selectExpr(
        "cast(id as string) as id", "'old' as name", "'old' as source", "if(id % 100 = 7, 'manual', null) as source_exception"
    )
    sinks.replace_table(rows, path)


def _files(spark, path):
    return set(versions.files_of(spark, path, sinks.current_version(spark, path)))


def test_a_small_update_rewrites_few_files(spark, table, tmp_path):
    path, plain = f"{tmp_path}/master.parquet", f"{tmp_path}/plain.parquet"
    _master(spark, path)
    before = sinks.read_current(spark, path)
    update = table("id string, name string, source string", *((str(i * 200 + 7), "new", "new") for i in range(10)), ("fresh", "new", "x"), (None, "new", "y"), (None, "new", "z"))
    want = stage(upsert_with_overrides(before, update, "id", MERGED), "want")
    # The first update settles the overrides of all rows, whether they match or not.
    merge_table(update.where("id = '7'"), path, "id", MERGED)
    assert sinks.current_version(spark, path).notes["settled"] == ["source"]
    assert values(sinks.read_current(spark, path).where("source_exception is not null"), "source") == [("manual",)] * 20
    files = _files(spark, path)
    merge_table(update, path, "id", MERGED)
    gone = files - _files(spark, path)
    assert 1 <= len(gone) <= 10 and len(files & _files(spark, path)) >= len(files) - 10
    assert values(sinks.read_current(spark, path)) == values(want)
    # What an old version names stays until it is removed.
    assert values(sinks.read_version(spark, path, sinks.version_of(spark, path, 1))) == values(before)
    assert sinks.vacuum(spark, path) and not any(os.path.exists(f"{tmp_path}/{f}") for f in gone)
    assert values(sinks.read_current(spark, path)) == values(want)
    # Nothing new rewrites nothing.
    files = _files(spark, path)
    merge_table(update.limit(0), path, "id", MERGED)
    assert files <= _files(spark, path) and values(sinks.read_current(spark, path)) == values(want)
    with pytest.raises(FileNotFoundError):
        merge_table(update, plain, "id", MERGED)


def test_merges_one_after_another_are_upserts(spark, table, tmp_path):
    """Updates with and without the overridden column, repeated and null keys, against upserts of whole tables."""
    path = f"{tmp_path}/master.parquet"
    _master(spark, path, 6)
    whole = sinks.read_current(spark, path)
    rng = random.Random(4)
    for k in range(4):
        columns = "id string, name string" if k % 2 == 0 else "id string, name string, source string"
        rows = [(rng.choice([str(rng.randrange(140)), None, f"n{rng.randrange(5)}"]), f"k{k}-{i}", f"s{k}") for i in range(8)]
        update = table(columns, *(r[: 2 + k % 2] for r in rows))
        for one in (True,) if k == 3 else (False,):
            whole = stage(upsert_with_overrides(whole, update, "id", MERGED, one_per_key=one), "whole")
            merge_table(update, path, "id", MERGED, one_per_key=one)
        assert values(sinks.read_current(spark, path)) == values(whole)
