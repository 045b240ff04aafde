"""Every cleaning rule on ordinary and dirty texts."""

import datetime

import pytest
from pyspark.sql import functions as F

from cardtide.functions import clean

ALMOST_MAX = "$92233720368547758.07"


@pytest.mark.parametrize("rule, cases", [
    (clean.jtrim, {"\t x y \n": "x y", " ": "", "a": "a", "\x01b\x00": "b"}),
    (clean.trim_quotes, {' " a " ': "a", '"': '"', '""': "", 'a"': 'a"', None: ""}),
    (clean.norm_city, {" beulah ": "BEULAH", "": "UNKNOWN", "NULL": "UNKNOWN", "n/a": "UNKNOWN", '"La, X"': "LA, X",
                       None: "UNKNOWN", "\t": "UNKNOWN", '""': "UNKNOWN"}),
    (clean.norm_client, {"825": "825", "NULL": None, "null": "null", "N/A": None, " ": None, '"7"': "7", None: None}),
    (clean.us_state, {"nd": "ND", "PR": None, "": None, "Italy": None, '"ca"': "CA", None: None}),
    (clean.country, {"Italy": "ITALY", "ND": None, "PR": "PR", "n/a": None, "": None, None: None}),
    (clean.mcc_strict, {"5499": "5499", "54": "54", "bad": None, "": None, "5 4": None, ' "12" ': "12", "NULL": None,
                        "-1": None, None: None}),
    (clean.mcc_lenient, {"5499": "5499", "bad": "BAD", "": "UNKNOWN_MCC", "N/A": "UNKNOWN_MCC", "n/a": "N/A"}),
    (clean.nz_unknown, {" x ": "X", "": "UNKNOWN", None: "UNKNOWN", "N/A": "N/A"}),
    (clean.nz_empty, {' "x" ': "X", "": "", None: ""}),
    (clean.cents_exact, {
        "$-77.00": -7700, "1e3": 100_000, ".5": 50, "5.": 500, "+7": 700, "": None, "abc": None, "($5.00)": None,
        "1" + "0" * 22: None, "-0.005": -1, "0.0049999999": 0, '"$1,234.567"': 123_457, "$ 1 2.30": 1230, None: None,
        "NaN": None, "1.2.3": None, "0.00499999999999999999999": 0, "0.00500000000000000000001": 1,
        "-1.00499999999999999999999": -100, "$12.34999999999999999999999": 1235, ALMOST_MAX: 9223372036854775807, "$92233720368547758.08": None}),
    (clean.cents_double, {"-0.005": 0, "$1,234.56": 123_456, "$-77.00": -7700, "": None, "abc": None,
                          "0.005": 1, "1e30": 2**63 - 1, "-1e30": -(2**63), "NaN": 0}),
    (clean.amount_double, {"$5.25": 5.25, "$1,000.00": None, "-$3": -3.0, '"$1': None, "1e3": 1000.0}),
    (clean.txn_type, {
        "": "Unknown Transaction", None: "Unknown Transaction", "Swipe  transaction": "Swipe Transaction",
        "y": "Chip Transaction", "TRUE": "Chip Transaction", "0": "Swipe Transaction", "online": "Online Transaction",
        "contactless": "Contactless Transaction", "N/A": "Unknown Transaction", "tap": "Tap Transaction",
        "o'neil card": "O'neil Card Transaction"}),
    (clean.capitalize_words, {"a  bC\td": "A Bc D"}),
    (clean.truthy, {"1": True, "T": True, "yes": True, "no": False, "": False, None: False}),
    (clean.day_period, {
        "2010-01-01 00:01:00": "MORNING", "2010-01-01 11:59:59": "MORNING", "2010-01-01 12:00": "AFTERNOON",
        "2010-01-01 17:59:00": "AFTERNOON", "2010-01-01 23:00:00": "NIGHT", "x 18:99": "NIGHT", "2010-01-01": None,
        "2010-01-01 24:00:00": None, "2010-01-01 5.5:00": None, "18": None, "": None, None: None, "x -1:00": None,
        "x  18:00": None}),
    (lambda c: clean.mcc_category(c, "long"), {"5499": "Retail/Wholesale", "0": "Other Category", "": "Unknown Category"}),
    (lambda c: clean.mcc_category(c, "short"), {"5499": "Retail", "x": "Other", " ": "Unknown"}),
    (clean.mcc_error_cause, {
        "5411": "Supermarkets: high volume transactions", "5499": "Automotive: automated systems, connectivity",
        "4900": "Transportation/Utilities: infrastructure variability", "": "Unknown error pattern",
        "1711": "Standard transaction processing issues"}),
    (clean.severity_rank, {"CRITICAL": 4, "high": 3, "MEDIUM": 2, "LOW": 1, "x": 0}),
])
def test_text_rules(evaluate, rule, cases):
    assert dict(zip(cases, evaluate(rule, list(cases)))) == cases


@pytest.mark.parametrize("rule, errors", [
    ("no_error", {"": False, "Bad PIN": True, "no_error": False, "N/A": True, '" "': True, None: False}),
    ("any_text", {"": False, "N/A": True, "no_error": True, " ": False, None: False}),
    ("none_na", {"": False, "n/a": False, "None": False, "no_error": True, None: False}),
    ("null_na", {"": False, "N/A": False, "n/a": True, "NULL": False, "no_error": True, None: False}),
])
def test_error_rules(evaluate, rule, errors):
    assert dict(zip(errors, evaluate(lambda c: clean.has_error(c, rule), list(errors)))) == errors


@pytest.mark.parametrize("rule, online", [
    ("phrase", {"Online Transaction": True, "ONLINE": False, "": False}),
    ("phrase_or_word", {"online transaction": True, "online": True, "Swipe": False}),
    ("contains", {"Online Transaction": True, "ONLINE": False, "x Online": True, None: False}),
])
def test_online_rules(evaluate, rule, online):
    assert dict(zip(online, evaluate(lambda c: clean.is_online(c, rule), list(online)))) == online


def test_unknown_rules_are_refused():
    with pytest.raises(ValueError):
        clean.has_error(F.lit(""), "other")
    with pytest.raises(ValueError):
        clean.is_online(F.lit(""), "other")


def test_timestamps(evaluate):
    at = datetime.datetime
    cases = {
        "2010-01-01 00:01:00": at(2010, 1, 1, 0, 1), "2010-1-2 5:07": at(2010, 1, 2, 5, 7), "2010-02-30 00:01:00": None,
        "2010-01-01T00:01:00": None, "2010-01-01 24:00:00": None, "2010-01-01 00:01:60": None, "2010-01-01": None,
        "2010-01-01 00:01:00 UTC": at(2010, 1, 1, 0, 1), "soon": None, "": None, None: None, "2010-01-01 00:01:0Z": None,
    }
    assert dict(zip(cases, evaluate(clean.parse_ts, list(cases)))) == cases
    prefix = {
        "2010-01-01 00:01:00": at(2010, 1, 1, 0, 1), "2010-01-01 00:01": None, "2010-01-01 00:01:00.0": at(2010, 1, 1, 0, 1),
        "2010-01-01 00:01:00Z": at(2010, 1, 1, 0, 1), "2010-1-2 5:7:9 x": at(2010, 1, 2, 5, 7, 9), "2010-02-30 00:01:00": at(2010, 3, 2, 0, 1),
        "x2010-01-01 00:01:00": None, "2010-01-01 00:01:60": at(2010, 1, 1, 0, 2), "": None, None: None,
        # numbers beyond a field's range carry over
        "2001-02-30 18:00:00": at(2001, 3, 2, 18, 0), "2000-02-30 00:00:00": at(2000, 3, 1), "2010-13-01 00:00:00": at(2011, 1, 1),
        "2010-00-10 00:00:00": at(2009, 12, 10), "2010-03-00 00:00:00": at(2010, 2, 28), "2010-01-01 24:00:00": at(2010, 1, 2),
        "2010-12-31 23:59:61": at(2011, 1, 1, 0, 0, 1), "2010-25-400 30:70:80": at(2013, 2, 4, 7, 11, 20), "2010-1-1 0:0:9999999": None,
        "10-01-01 00:00:00": at(10, 1, 1), "99999999-01-01 00:00:00": None,
    }
    assert dict(zip(prefix, evaluate(clean.parse_ts_prefix, list(prefix)))) == prefix
    assert evaluate(lambda c: clean.epoch_ms(clean.parse_ts(c)), ["2010-01-01 00:01:00"]) == [1262304060000]


def test_state_rule(spark):
    cases = {
        ("nd", "x"): "ND", ("", "Online"): "ONLINE", ("", "x"): "UNKNOWN", ("online", "x"): "ONLINE", ("PR", "x"): "UNKNOWN",
        ("N/A", "ONLINE"): "ONLINE", ("PR", "ONLINE"): "UNKNOWN", (None, None): "UNKNOWN",
    }
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(cases)], "i int, s string, c string")
    rows = df.select("i", clean.norm_state(F.col("s"), F.col("c")).alias("v")).collect()
    assert [r.v for r in sorted(rows, key=lambda r: r.i)] == list(cases.values())


def test_numbers(spark):
    row = spark.range(1).select(
        clean.pct(F.lit(1), F.lit(3)).alias("p"), clean.pct(F.lit(1), F.lit(0)).alias("p0"),
        clean.int_div(F.lit(-7), F.lit(2)).alias("d"), clean.int_div(F.lit(5), F.lit(0)).alias("d0"),
        clean.fmt_money(F.lit(1234567)).alias("m"), clean.fmt_money(F.lit(1234567), True).alias("mt"),
        clean.fmt_money(F.lit(-5)).alias("mn"),
        clean.peak_period(F.lit(2), F.lit(2), F.lit(1)).alias("peak"),
        clean.lowest_period(F.lit(2), F.lit(1), F.lit(1)).alias("low"),
        clean.period_label(F.lit("X"), F.lit("NIGHT")).alias("label"),
        clean.period_order(F.lit("AFTERNOON")).alias("po"),
    ).first()
    assert row.p == 100.0 / 3 and row.p0 == 0.0 and row.d == -3 and row.d0 == 0
    assert (row.m, row.mt, row.mn) == ("12345.67", "12,345.67", "-0.05")
    assert (row.peak, row.low, row.label, row.po) == ("Manhã", "Tarde", "X [Noite]", 2)
