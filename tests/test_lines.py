"""Text input: headers, the three CSV dialects, arity, lookups."""

import os
import re

import pytest
from pyspark.sql import functions as F

from cardtide.functions import fixed
from cardtide.sources import dims, lines
from cardtide.sources.star import card_transactions

HEADER = ",".join(fixed.COLUMNS)
PLAIN = "1,2010-01-01 00:01:00,825,4524,$-77.00,Swipe Transaction,59935,Beulah,ND,58523.0,5499,"
QUOTED = '2,2010-01-01 00:02:00,825,4524,"$1,234.567",Swipe Transaction,59935,Beulah,ND,58523.0,5499,"Bad PIN,Insufficient Balance"'
OPEN = '3,x,1,1,"$5,a,b,c,d,e,f,g,h,i,j'
SHORT = "4,x,1,1,$5,a,b,c,d,e,f"
LONG = PLAIN + ",extra"


@pytest.fixture
def frame(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


def fields(frame, dialect, line):
    return frame(line).select(lines.DIALECTS[dialect](F.col("value")).alias("p")).first().p


def test_field_counts(frame):
    sizes = {d: [len(fields(frame, d, x)) for x in (PLAIN, QUOTED, OPEN, SHORT, LONG)] for d in lines.DIALECTS}
    assert sizes["toggle"] == [12, 12, 5, 11, 13]
    assert sizes["even_quotes"] == [12, 12, 11, 11, 13]
    assert sizes["naive"][:2] == [12, 14]


def test_quotes_by_dialect(frame):
    assert fields(frame, "toggle", QUOTED)[4] == "$1,234.567"
    assert fields(frame, "toggle", QUOTED)[11] == "Bad PIN,Insufficient Balance"
    assert fields(frame, "even_quotes", QUOTED)[4] == '"$1,234.567"'
    assert fields(frame, "naive", QUOTED)[4] == '"$1'
    assert fields(frame, "toggle", 'a"b,c"d,e') == ["ab,cd", "e"]


@pytest.mark.parametrize("line, toggled", [
    ('a,"b\x01c",d', ["a", "b\x01c", "d"]), ('a\x01,"b,c",\x02', ["a\x01", "b,c", "\x02"]),
    ('"\x02a\x01b\x02b",\x01', ["\x02a\x01b\x02b", "\x01"]), ("a\x01b,c", ["a\x01b", "c"]),
])
def test_control_characters_in_fields(frame, line, toggled):
    assert fields(frame, "toggle", line) == toggled
    assert [f.replace('"', "") for f in fields(frame, "even_quotes", line)] == toggled


def test_even_quotes_is_the_look_ahead_rule(frame):
    import re

    rule = re.compile(r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    samples = ['a,"b,c",d', 'a,"b,c', '"a,b"",c,"d', '",",', 'x"y,z"w,"', '""', '"', ',,"', 'a"b"c"d,e,f']
    df = frame(*samples)
    got = {r.value: r.p for r in df.select("value", lines.split_even_quotes(F.col("value")).alias("p")).collect()}
    assert got == {s: rule.split(s) for s in samples}


def test_headers_anywhere_and_arity(frame):
    df = frame(HEADER, PLAIN, HEADER, '"id",x', SHORT, LONG, QUOTED)
    assert lines.parse_transactions(df).count() == 3
    assert lines.parse_transactions(df, "even_quotes").count() == 3
    kept = frame("", "  ", "identity,1", " id,x", PLAIN)
    assert lines.drop_header(kept, "id_prefix").count() == 1
    assert lines.drop_header(kept).count() == 5
    with pytest.raises(ValueError):
        lines.drop_header(kept, "other")


def test_extra_fields_are_ignored(frame):
    row = lines.parse_transactions(frame(LONG)).first()
    assert row.asDict()["errors"] == "" and len(row) == 12


def test_reading_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\r\n{PLAIN}\n")
    (tmp_path / "b.csv").write_text(f"{HEADER}\n{PLAIN}\n{SHORT}\n")
    assert lines.read_transactions(spark, str(tmp_path)).count() == 2
    assert lines.read_transactions(spark, f"{tmp_path}/a.*").count() == 1


def test_house_lines(spark, tmp_path):
    from cardtide.operators.keyed import avg_by_keys

    (tmp_path / "h.csv").write_text(
        "brokered_by,status,price,bed,bath,acre,street,city\n"
        "1,for_sale,100.0,1,1,1,s,Adjuntas\n1,for_sale,200.0,1,1,1,s,adjuntas\n1,sold,,1,1,1,s,Ponce\n1,sold,5,1,1,1,s,\n1,x\n")
    rows = avg_by_keys(lines.read_house_lines(spark, str(tmp_path)), ["city", "status"], "price").collect()
    assert [(r.city, r.status, r.n, r.avg_value) for r in rows] == [("ADJUNTAS", "FOR_SALE", 2, 150.0)]


def test_lookup_tables(spark):
    assert dims.mcc_dim(spark, "long").count() == 108
    assert dims.mcc_dim(spark, "short").count() == 109
    assert dims.state_dim(spark).groupBy("region").count().count() == 5
    codes = spark.createDataFrame([("5812",), ("3000",), ("1",), (" ",)], "mcc string")
    both = dims.with_mcc_label(dims.with_mcc_label(codes, "long", out="l", known="kl"), "short", out="s", known="ks")
    got = {r.mcc: (r.l, r.s, r.kl, r.ks) for r in both.collect()}
    assert got == {
        "5812": ("Eating Places and Restaurants", "Restaurants", True, True),
        "3000": ("Unknown MCC Code: 3000", "Steelworks", False, True),
        "1": ("Unknown MCC Code: 1", "MCC-1", False, False),
        " ": ("Unknown MCC Code", "Unknown", False, False),
    }
    states = spark.createDataFrame([("MD",), ("ZZ",), ("ONLINE",)], "state string")
    got = {r.state: (r.state_name, r.region) for r in dims.with_region(dims.with_state_name(states)).collect()}
    assert got == {"MD": ("Maryland", "Southeast"), "ZZ": ("Unknown State: ZZ", "Unknown"), "ONLINE": ("Unknown State", "Unknown")}


def test_adapter_foreign_keys_hold(spark, small_dir):
    """The adapter leaves out joins it needs no column of; that is right only if keys are whole."""
    table = lambda n: spark.read.parquet(f"{small_dir}/{n}.parquet")
    items, orders, suppliers = table("lineitem"), table("orders"), table("supplier")
    assert items.join(orders, items.l_orderkey == orders.o_orderkey, "anti").count() == 0
    assert items.join(suppliers, items.l_suppkey == suppliers.s_suppkey, "anti").count() == 0
    assert orders.select("o_orderkey").distinct().count() == orders.count()
    assert card_transactions(spark, small_dir).count() == items.count()
    assert card_transactions(spark, small_dir, "mcc").columns == ["mcc"]


def test_size_decides_the_parts_of_an_exchange(spark, small_dir):
    """Not the session's number of shuffle partitions, which would be the number of tasks of any input; what the session names itself stands."""
    from cardtide.sources.lines import parts_by_size

    initial, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = {key: spark.conf.get(key, None) for key in (initial, size)}
    try:
        for key in kept:
            spark.conf.unset(key)
        plan = card_transactions(spark, small_dir, "client_id").groupBy("client_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "l_orderkey" in plan and plan.count(", 200)") >= 2
        assert (spark.conf.get(initial), spark.conf.get(size)) == ("200", "8m")
        spark.conf.set(initial, "9")
        spark.conf.set(size, "3m")
        parts_by_size(spark)
        assert (spark.conf.get(initial), spark.conf.get(size)) == ("9", "3m")
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


@pytest.mark.parametrize("off", ["spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled"])
def test_files_decide_the_parts_where_none_are_joined(spark, small_dir, monkeypatch, off):
    """Without joining, the session's number of shuffle partitions would be the number of tasks of any input."""
    number = "spark.sql.shuffle.partitions"
    kept = {key: spark.conf.get(key) for key in (number, off)}
    size = os.path.getsize(f"{small_dir}/lineitem.parquet")
    parts = lambda: int(re.search(r"hashpartitioning\(client_id#\d+, (\d+)\)", card_transactions(
        spark, small_dir, "client_id").groupBy("client_id").count()._jdf.queryExecution().executedPlan().toString())[1])
    try:
        spark.conf.set(off, "false")
        spark.conf.set(number, "3")
        assert parts() == 3  # small files leave the session's number
        monkeypatch.setattr(lines, "FILE_BYTES", size // 7 + 1)
        assert parts() == 7
        monkeypatch.setattr(lines, "FILE_BYTES", size // 5000)
        assert parts() == lines.PARTS
        spark.conf.set(number, "211")
        assert parts() == 211
        spark.conf.set(number, "3")
        lines.read_lines(spark, f"{small_dir}/line*.parquet")  # globs, as the reader takes them
        assert spark.conf.get(number) == str(lines.PARTS)
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("usual", ["64m", "64MB", "67108864"])
def test_the_usual_part_size_counts_as_not_named(spark, usual):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = spark.conf.get(size)
    try:
        spark.conf.set(size, usual)
        lines.parts_by_size(spark)
        assert spark.conf.get(size) == "8m"
        spark.conf.set(size, "128m")
        lines.parts_by_size(spark)
        assert spark.conf.get(size) == "128m"
    finally:
        spark.conf.set(size, kept)
