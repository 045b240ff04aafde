"""Report files, stages and the analyses end to end from files."""

import glob

import pytest
from pyspark.sql import functions as F

from cardtide.__main__ import main
from cardtide.config import ClientRiskRules, RfmRules
from cardtide.plans.routines import ROUTINES, result_table, run
from cardtide.sinks import files, render

HEADER = "id,date,client_id,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors"


@pytest.fixture
def csv(tmp_path):
    rows = [HEADER]
    for i in range(40):
        place = [("Beulah", "ND"), ("Rome", "Italy"), ("ONLINE", "")][i % 3]
        chip = "Online Transaction" if i % 3 == 2 else "Swipe Transaction"
        error = '"Bad PIN,Glitch"' if i % 10 == 0 else ""
        rows.append(f"{i},2010-0{1 + i % 5}-01 {i % 24:02}:01:00,{i % 4},{i % 8},${10 + i}.50,{chip},{i % 6},{place[0]},{place[1]},1,{5411 + i % 2},{error}")
    (tmp_path / "in.csv").write_text("\n".join(rows) + "\n")
    return str(tmp_path / "in.csv")


def report(path):
    return [line for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f).read().splitlines()]


@pytest.mark.parametrize("name", sorted(ROUTINES))
def test_every_analysis_writes_a_report(spark, csv, tmp_path, name):
    out = f"{tmp_path}/out"
    assert run(spark, name, csv, out, files=1, properties={"min.uf.merchants": "1"}) is None
    written = report(out)
    assert written
    if name != "risk_analysis":
        keys = [line.split("\t")[0] for line in written]
        assert name == "category_by_time_period" or keys == sorted(keys)


def test_report_texts(spark, csv, tmp_path):
    run(spark, "amount_by_city", csv, f"{tmp_path}/a", files=1)
    assert report(f"{tmp_path}/a") == ["BEULAH\t420.00", "ONLINE\t396.50", "ROME\t383.50"]
    run(spark, "city_statistics", csv, f"{tmp_path}/b", files=1)
    assert report(f"{tmp_path}/b")[0].startswith("BEULAH\tTransações: 14 | Total: $")
    run(spark, "category_by_time_period", csv, f"{tmp_path}/c", files=1)
    assert [line.split("\t")[0] for line in report(f"{tmp_path}/c")][:3] == ["BEULAH [Manhã]", "BEULAH [Tarde]", "BEULAH [Noite]"]
    run(spark, "client_behavior", csv, f"{tmp_path}/d", files=1)
    assert any("Clients: " in line and "%) | High: " in line for line in report(f"{tmp_path}/d"))
    run(spark, "risk_analysis", csv, f"{tmp_path}/e", files=1)
    assert "--- TOP 10 HIGHEST RISK CLIENTS ---" in report(f"{tmp_path}/e")


def test_existing_output(spark, csv, tmp_path):
    run(spark, "chip_usage_count", csv, f"{tmp_path}/x")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        run(spark, "chip_usage_count", csv, f"{tmp_path}/x")
    run(spark, "chip_usage_count", csv, f"{tmp_path}/x", mode="overwrite")
    for _ in range(2):  # the risk analysis replaces its output by itself
        run(spark, "risk_analysis", csv, f"{tmp_path}/y")


def test_report_is_in_order_over_several_files(spark, tmp_path):
    df = spark.range(100).selectExpr("lpad(cast((id * 37) % 100 as string), 3, '0') as key", "'v' as text")
    files.write_report(df, f"{tmp_path}/r", files=4)
    written = report(f"{tmp_path}/r")
    assert len(glob.glob(f"{tmp_path}/r/part-*")) == 4
    assert written == sorted(written) and len(written) == 100


def test_stage_gives_the_same_table(spark, csv, tmp_path):
    for name in ("client_behavior", "merchant_risk", "rfm_by_state", "risk_analysis", "category_by_time_period"):
        whole = sorted(map(repr, result_table(spark, name, csv).collect()))
        staged = sorted(map(repr, result_table(spark, name, csv, stage=f"{tmp_path}/s-{name}").collect()))
        assert whole == staged


def test_command_line(spark, csv, tmp_path):
    main(["rfm_by_state", csv, f"{tmp_path}/out", "--files", "1", "-D", "top.cities=1", "-D", "rfm.freq.high=1"])
    assert all(line.split("\t")[1].startswith("Clients: ") for line in report(f"{tmp_path}/out"))


def test_properties():
    assert ClientRiskRules.from_properties({"risk.error.high": "0.1", "top.cities": "3"}) == ClientRiskRules(error_high=0.1)
    assert RfmRules.from_properties({"top.cities": "3"}).top_cities == 3


def test_compact_lines(spark):
    stats = spark.createDataFrame([("A", 2, 150, 75)], "city string, tx long, total_cents long, avg_cents long")
    assert render.render_city_statistics(stats, compact=True).first().text == "2\t1.50\t0.75"
    top = spark.createDataFrame([("A", 1, "5411", "Supermarkets", 3), ("A", 2, "9", "MCC-9", 1)],
                                "city string, rank int, mcc string, label string, tx long")
    assert render.render_top_categories(top, ["city"]).first().text == "Top-1: 5411 (Supermarkets) 3 | Top-2: 9 (MCC-9) 1"
    assert render.render_top_categories(top, ["city"], compact=True).first().text == "5411:3\t9:1"
    period = spark.createDataFrame([("A", 1, 0, 0, 1, "Manhã")], "city string, morning long, afternoon long, night long, total long, peak string")
    assert render.render_city_time_period(period, compact=True).first().text == "1\t0\t0\t1\tManhã"


def test_positions_over_many_parts(spark):
    """Skewed and repeated keys, descending order, empty table; no part sees more than its range."""
    from cardtide.operators.positions import positioned
    from cardtide.sinks.stages import Stages

    rows = [(i % 7 if i % 3 else 3, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(9)
    with Stages(spark) as stages:
        got = positioned(df, [F.desc("k"), F.asc("v")], stages)
        assert got.columns == ["k", "v", "position"]
        placed = sorted((r.position, r.k, r.v) for r in got.collect())
        assert placed == [(i + 1, k, v) for i, (k, v) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))]
        ties = sorted((r.position, r.k) for r in positioned(df.select("k"), [F.asc("k")], stages).collect())
        assert ties == [(i + 1, k) for i, k in enumerate(sorted(k for k, _ in rows))]
        assert positioned(df.where("false"), [F.asc("k")], stages).count() == 0


def test_stages_are_written_read_and_dropped(spark, tmp_path):
    from cardtide.sinks.stages import Stages

    df = spark.range(5).selectExpr("id", "cast(id as decimal(28,2)) d", "array(struct(id a, 'x' b)) s")
    with Stages(spark, f"file://{tmp_path}") as stages:
        kept, other = stages.keep(df, "one"), stages.keep(df, "one")
        assert kept.dtypes == df.dtypes and kept.count() == other.count() == 5
        assert len(list(tmp_path.glob("stages-*/one-*"))) == 2
    assert not list(tmp_path.glob("stages-*"))


@pytest.mark.parametrize("count", [1, 3, None])
def test_reports_are_read_back_line_by_line(spark, tmp_path, count):
    from cardtide.sinks.files import read_report, write_report

    lines = spark.range(4000).selectExpr("lpad(id * 7919 % 4000, 5, '0') key", "repeat('x', cast(id % 50 as int)) text")
    write_report(lines, f"{tmp_path}/r", count)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # several splits of one file
    try:
        got = sorted((r.position, r.part, r.line, r.text[:5]) for r in read_report(spark, f"{tmp_path}/r").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert [g[3] for g in got] == [f"{i:05}" for i in range(4000)] and [g[0] for g in got] == list(range(1, 4001))
    assert count is None or len({g[1] for g in got}) == count
    for part in {g[1] for g in got}:
        own = [g[2] for g in got if g[1] == part]
        assert own == list(range(1, len(own) + 1))


def test_lines_in_several_files_with_headers(spark, tmp_path):
    from cardtide.sinks.files import write_lines
    from cardtide.sources.lines import read_lines

    write_lines(spark.range(900).selectExpr("concat('line ', id) value"), f"{tmp_path}/l", 5, "id,date")
    files = sorted(tmp_path.glob("l/file=*/*.txt"))
    texts = [f.read_text().splitlines() for f in files]
    assert len(files) == 5 and all(t[0] == "id,date" and "id,date" not in t[1:] for t in texts)
    back = read_lines(spark, f"{tmp_path}/l")
    assert back.columns == ["value"] and back.count() == 905 and back.rdd.getNumPartitions() > 1


def test_large_lines_are_written_by_many_tasks(spark, tmp_path):
    """A folder is not one task's work: its lines come in as many files as their size asks for, each with the header."""
    from cardtide.sinks.files import write_lines
    from cardtide.sources.lines import read_lines

    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    rows = spark.range(0, 60_000, 1, 4).selectExpr("if(id % 3 = 0, 'same line', concat('line ', id, ' ', sha2(cast(id as string), 512))) value")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_lines(rows, f"{tmp_path}/l", 2, "id,date")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    texts = [f.read_text().splitlines() for f in tmp_path.glob("l/file=*/*.txt")]
    assert len(texts) > 8 and max(map(len, texts)) < 20_000
    assert all(t[0] == "id,date" and "id,date" not in t[1:] for t in texts)
    got = read_lines(spark, f"{tmp_path}/l").where("value <> 'id,date'")
    assert got.exceptAll(rows).isEmpty() and rows.exceptAll(got).isEmpty()


def test_no_lines_give_a_header_per_folder(spark, tmp_path):
    from cardtide.sinks.files import write_lines

    write_lines(spark.range(0).selectExpr("concat('line ', id) value"), f"{tmp_path}/l", 3, "id,date")
    assert [f.read_text() for f in tmp_path.glob("l/file=*/*.txt")] == ["id,date\n"] * 3
    write_lines(spark.createDataFrame([("a",), (None,), ("",)], "value string"), f"{tmp_path}/n", 2)
    assert sorted(line for f in tmp_path.glob("n/file=*/*.txt") for line in f.read_text().splitlines()) == ["", "", "a"]
