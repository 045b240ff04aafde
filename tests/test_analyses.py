"""Analyses on small hand-written tables: rules, boundaries, ties, invariants."""

import re

import pytest
from pyspark.sql import functions as F

from cardtide.config import ClientRiskRules, MerchantRules, RfmRules
from cardtide.operators import categories, city, clients, keyed, merchants, rfm, risk, summaries, totals, words


def table(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_totals(transactions):
    df = transactions(
        dict(merchant_city="a", amount="$1.00"), dict(merchant_city=" A ", amount="$-3.50"),
        dict(merchant_city="b", amount="x"), dict(merchant_city="", client_id="NULL"), dict(merchant_city="n/a"))
    by_city = table(totals.amount_by_city(df), "city")
    assert {k: (r.tx, r.total_cents, r.total) for k, r in by_city.items()} == {"A": (2, -250, -2.5), "UNKNOWN": (2, 2000, 20.0)}
    by_client = table(totals.amount_by_client(df), "client_id")
    assert {k: (r.tx, r.total_cents) for k, r in by_client.items()} == {"825": (3, 750)}
    stats = table(city.city_statistics(df), "city")
    assert stats["A"].avg_cents == -125
    assert city.city_statistics(transactions(dict(amount="-0.03"), dict(amount="-0.04"))).first().avg_cents == -3


def test_counts(transactions):
    df = transactions(dict(errors="N/A", mcc="bad"), dict(errors="no_error"), dict(errors="x", mcc=""), dict(merchant_state="PR"))
    assert {r.mcc: r.errors for r in totals.error_count_by_mcc(df).collect()} == {"BAD": 1, "UNKNOWN_MCC": 1}
    assert {r.state: r.tx for r in totals.count_by_state(df).collect()} == {"ND": 3, "UNKNOWN": 1}
    assert {r.txn_type: r.tx for r in totals.count_by_txn_type(df).collect()} == {"Swipe Transaction": 4}


def test_period_profile_ties(transactions):
    df = transactions(dict(date="2010-01-01 13:00"), dict(date="2010-01-01 19:00"), dict(date="bad"))
    row = city.city_time_period(df).first()
    assert (row.morning, row.afternoon, row.night, row.total, row.peak, row.lowest) == (0, 1, 1, 2, "Tarde", "Manhã")
    assert row.morning_pct + row.afternoon_pct + row.night_pct == 100.0


def test_top_categories_ties_and_places(transactions):
    df = transactions(
        dict(mcc="5541"), dict(mcc="5411"), dict(mcc="bad"), dict(mcc="9"), dict(mcc="5812"), dict(mcc="5812"),
        dict(merchant_state="PR"), dict(merchant_state="Italy"))
    top = categories.top_categories_by_city(df).orderBy("rank").collect()
    assert [(r.rank, r.mcc, r.label, r.tx) for r in top] == [
        (1, "5499", "Misc Food Stores", 2), (2, "5812", "Restaurants", 2), (3, "5411", "Supermarkets", 1)]
    assert {r.state for r in categories.top_categories_by_state(df).collect()} == {"ND"}
    assert {r.country for r in categories.top_categories_by_country(df).collect()} == {"PR", "ITALY"}
    ordered = categories.top_categories_by_city_period(transactions(dict(date="2010-01-01 19:00"), {})).orderBy("period_order")
    assert [r.period for r in ordered.collect()] == ["MORNING", "NIGHT"]


def test_client_profile(transactions):
    df = transactions(
        dict(merchant_state="nd", merchant_city="x", amount="$-5.00"), dict(merchant_state=" ND ", merchant_city="y", amount="-1"),
        dict(merchant_state="CA", merchant_city="", use_chip="online transaction", errors="N/A", amount="-2"),
        dict(merchant_state="CA", merchant_city="X"), dict(client_id=" "), dict(amount="bad"),
        dict(client_id="NULL", merchant_state=""))
    rows = table(clients.client_channel_profile(df), "client_id")
    assert set(rows) == {"825", "NULL"}
    r = rows["825"]
    # CA and ND tie at two transactions each: the smaller text wins; X leads among the cities
    assert (r.tx, r.online, r.errors, r.sum_cents, r.max_cents, r.state, r.city) == (4, 1, 1, 200, 1000, "CA", "X")
    assert (r.online_rate, r.error_rate, r.avg_cents) == (0.25, 0.25, 50)
    assert rows["NULL"].state == "UNKNOWN"
    refunds = clients.client_channel_profile(transactions(dict(amount="-1"))).first()
    assert (refunds.sum_cents, refunds.max_cents) == (-100, 0)


@pytest.mark.parametrize("error, online, avg, largest, risk_class", [
    (0.0, 0.0, 0, 0, "LOW"),
    (0.05, 0.61, 0, 0, "MED"),      # 0.05 in single precision is above 0.05
    (0.051, 0.60, 0, 0, "MED"),     # as is 0.60
    (0.051, 0.61, 0, 0, "HIGH"),
    (0.0, 0.80, 0, 0, "MED"), (0.0, 0.801, 0, 0, "HIGH"),
    (0.02, 0.0, 0, 0, "MED"), (0.0199, 0.0, 0, 0, "LOW"), (0.0, 0.60, 0, 0, "LOW"),
    (0.0, 0.0, 10_000, 0, "HIGH"), (0.0, 0.0, 9_999, 49_999, "LOW"), (0.0, 0.0, 0, 50_000, "HIGH"),
])
def test_client_risk_boundaries(spark, error, online, avg, largest, risk_class):
    row = spark.createDataFrame([(error, online, avg, largest)], "error_rate double, online_rate double, avg_cents long, max_cents long")
    assert clients.classify_client_risk(row).first().risk == risk_class


@pytest.mark.parametrize("tx, revenue, avg, error, online, largest, health, risk_class", [
    (1, 2_000_000, 0, 0.0, 0.0, 0, "A", "LOW"), (1, 1_999_999, 0, 0.02, 0.0, 0, "B", "MED"),
    (1, 500_000, 0, 0.0199, 0.69, 0, "B", "LOW"), (100, 499_999, 8_000, 0.0, 0.70, 0, "B", "MED"),
    (99, 499_999, 8_000, 0.05, 0.0, 0, "C", "MED"), (100, 0, 7_999, 0.051, 0.0, 0, "C", "HIGH"),
    (1, 0, 0, 0.0, 0.90, 0, "C", "HIGH"), (1, 0, 0, 0.0, 0.0, 500_000, "C", "HIGH"), (1, 0, 0, 0.0, 0.899, 499_999, "C", "MED"),
])
def test_merchant_boundaries(spark, tx, revenue, avg, error, online, largest, health, risk_class):
    schema = "tx long, sum_cents long, avg_cents long, error_rate double, online_rate double, max_cents long"
    row = merchants.classify_merchants(spark.createDataFrame([(tx, revenue, avg, error, online, largest)], schema)).first()
    assert (row.health, row.risk) == (health, risk_class)


def test_merchant_profile(transactions):
    df = transactions(
        dict(merchant_state="", errors="N/A"), dict(merchant_state="", errors="none", use_chip="online"),
        dict(merchant_state="ND", merchant_id=" m2 ", amount="-0.005", errors="no_error"), dict(merchant_id=""))
    rows = table(merchants.merchant_profile(df), "merchant_id")
    assert set(rows) == {"M2"}          # 59935 is mostly at a blank state
    assert (rows["M2"].sum_cents, rows["M2"].errors) == (0, 1)


def test_state_rollups(transactions):
    rules = ClientRiskRules()
    df = transactions(*[dict(client_id=str(i), amount="$200.00", merchant_city=f"c{i % 7}") for i in range(20)],
                      *[dict(client_id=str(100 + i)) for i in range(5)])
    classed = clients.classify_client_risk(clients.client_channel_profile(df), rules)
    row = clients.client_risk_by_state(classed).first()
    assert (row.total, row.low, row.med, row.high) == (25, 5, 0, 20)
    assert row.low_pct + row.med_pct + row.high_pct == 100.0
    assert [(s["rank"], s["city"], s["clients"]) for s in row.hotspots] == [
        (1, "C0", 3), (2, "C1", 3), (3, "C2", 3), (4, "C3", 3), (5, "C4", 3)]
    spots = clients.client_hotspots(classed).orderBy("rank").collect()
    assert [(s["rank"], s["city"], s["clients"]) for s in row.hotspots] == [(s["rank"], s.city, s.clients) for s in spots]


def test_merchant_rollup_minimum(transactions):
    df = transactions(*[dict(merchant_id=str(i), amount=f"${i}.00") for i in range(1, 8)], dict(merchant_state="CA", merchant_id="z"))
    classed = merchants.classify_merchants(merchants.merchant_profile(df))
    rows = merchants.merchant_health_by_state(classed).collect()
    assert [r.state for r in rows] == ["ND"]
    assert [m["merchant_id"] for m in rows[0].top_merchants] == ["7", "6", "5", "4", "3"]
    assert rows[0].total == rows[0].health_c == 7
    assert merchants.merchant_health_by_state(classed, MerchantRules(min_state_merchants=1, top_merchants=1)).count() == 2


def test_rfm(transactions):
    df = transactions(
        dict(date="2010-05-01 23:59:59"), dict(date="2010-02-30 00:00:00"), dict(date="2010-04-01 10:00", amount="$30.00"),
        dict(client_id="late", date="2010-06-10 00:00:00"))
    rows = table(rfm.rfm_client(df), "client_id")
    assert (rows["825"].frequency, rows["825"].avg_cents, rows["825"].recency_days) == (2, 2000, 30)
    assert rows["late"].recency_days == 0
    assert rfm.rfm_client(df, RfmRules(reference_date="")).count() == 2


@pytest.mark.parametrize("recency, frequency, avg, bucket", [
    (30, 900, 0, "HIGH"), (30, 0, 20_000, "HIGH"), (31, 900, 20_000, "MED"), (30, 899, 19_999, "MED"),
    (90, 0, 0, "MED"), (91, 399, 7_999, "LOW"), (91, 400, 0, "MED"), (91, 0, 8_000, "MED"),
])
def test_rfm_boundaries(spark, recency, frequency, avg, bucket):
    row = spark.createDataFrame([(recency, frequency, avg)], "recency_days int, frequency long, avg_cents long")
    assert rfm.classify_rfm(row).first().bucket == bucket


def test_risk_profile(transactions):
    df = transactions(
        dict(amount="$500.004", merchant_city="ONLINE", use_chip="Online Transaction"), dict(client_id="bad", amount="$1,0"),
        dict(client_id="bad", date="2010-02 30 00:00:00"), dict(client_id=" "), dict(client_id="r", amount="$-10.00", errors="null"),
        dict(client_id="r", amount="$20.01", mcc="", card_id="", merchant_city="b", date="2010-01-02 00:00:00"))
    profile = table(risk.client_risk_profile(df), "client_id")
    assert set(profile) == {"825", "bad", "", "r"}
    r = profile["r"]
    assert (r.tx, r.total, r.avg, r.cities, r.mccs, r.cards, r.errors, r.chargebacks, r.swipe) == (2, 30.01, 15.01, 2, 1, 2, 0, 1, 2)
    assert (r.first_ts, r.last_ts) == (1262304060000, 1262390400000)
    assert (profile["825"].avg, profile["825"].cities) == (500.0, 0)
    assert (profile["bad"].tx, profile["bad"].total, profile["bad"].first_ts) == (0, 0.0, None)
    scored = table(risk.risk_score(risk.client_risk_profile(df)), "client_id")
    assert set(scored) == {"825", "bad", "r"}
    assert (scored["bad"].category, scored["bad"].factors, scored["bad"].score) == ("LOW", "NORMAL_BEHAVIOR", 0)
    # mean 500.00 is not over 500; only online is unbalanced
    assert scored["825"].factors == "MEDIUM_AVG_AMOUNT[500.00]; UNBALANCED_CHANNELS[100%_online]"
    assert scored["r"].factors == "DUAL_CARDS[2_cards]; CHARGEBACKS[1]; UNBALANCED_CHANNELS[0%_online]"


@pytest.mark.parametrize("values, score, factors", [
    (dict(cities=5, mccs=10, cards=3, errors=20, chargebacks=3, avg=500.0, online=80),
     8 + 6 + 8 + 12 + 10 + 7, "MEDIUM_MOBILITY[5_cities]; VARIED_MCC[10_categories]; DUAL_CARDS[3_cards]; "
     "MEDIUM_ERROR_RATE[20.0%]; CHARGEBACKS[3]; MEDIUM_AVG_AMOUNT[500.00]"),
    (dict(cities=6, mccs=11, cards=4, errors=21, chargebacks=4, avg=500.01, online=81), 122, "HIGH_MOBILITY[6_cities]; "
     "DIVERSE_MCC[11_categories]; MULTIPLE_CARDS[4_cards]; HIGH_ERROR_RATE[21.0%]; FREQUENT_CHARGEBACKS[4]; "
     "HIGH_AVG_AMOUNT[500.01]; UNBALANCED_CHANNELS[81%_online]"),
    (dict(cities=3, mccs=6, cards=1, errors=10, chargebacks=0, avg=200.0, online=20), 0, "NORMAL_BEHAVIOR"),
    (dict(cities=3, mccs=6, cards=1, errors=10, chargebacks=0, avg=200.0, online=19), 10, "UNBALANCED_CHANNELS[19%_online]"),
])
def test_risk_score_boundaries(spark, values, score, factors):
    row = dict(client_id="1", tx=100, total=1.0, **values)
    types = {"client_id": "string", "total": "double", "avg": "double"}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {types.get(k, 'long')}" for k in row))
    got = risk.risk_score(df).first()
    assert (got.score, got.factors) == (score, factors)


def test_risk_categories(spark):
    df = spark.createDataFrame([(s,) for s in (30, 31, 60, 61, 85, 86)], "s int")
    got = [r.c for r in df.select("s", risk.risk_category(F.col("s")).alias("c")).orderBy("s").collect()]
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]


def test_risk_report_order_and_leaders(spark):
    rows = [(f"c{i:02}", "LOW", 10, "f", 2, 1.5) for i in range(15)] + [("z", "CRITICAL", 90, "g", 4, 2.0)]
    df = spark.createDataFrame(rows, "client_id string, category string, score int, factors string, tx long, total double")
    report = risk.risk_report(df.repartition(5)).collect()
    assert [r.category for r in report] == ["CRITICAL", "LOW"]
    low = report[1]
    assert (low.clients, low.avg_score, low.total_amount, low.avg_amount, low.avg_tx) == (15, 10.0, 22.5, 1.5, 2.0)
    assert [c["client_id"] for c in low.top_clients] == [f"c{i:02}" for i in range(10)]


def test_summaries(spark):
    agg = spark.createDataFrame([("b", 3, 500), ("a", 1, 500), ("c", 2, -9), ("d", 2, -9)], "city string, tx long, total_cents long")
    row = summaries.summary_amount(agg).first()
    assert (row["keys"], row.grand_cents, row.avg_cents, row.highest_city, row.lowest_city, row.lowest_total_cents) == (4, 982, 245, "a", "c", -9)
    negative = summaries.summary_amount(agg.where("total_cents < 0")).first()
    assert (negative.highest_city, negative.highest_total_cents) == (None, 0)
    empty = summaries.summary_amount(agg.limit(0)).first()
    assert (empty["keys"], empty.grand_cents, empty.avg_cents) == (0, 0, 0)
    types = spark.createDataFrame([("A", 81), ("B", 19)], "txn_type string, tx long")
    assert summaries.summary_types(types).first().balance == "strong"
    clients_agg = agg.withColumnRenamed("city", "client_id")
    row = summaries.summary_amount_client(clients_agg).first()
    assert (row.tx, row.avg_tx, row.has_refunds) == (8, 2.0, True)
    stats = spark.createDataFrame([("a", 10, 100, 10), ("b", 9, 900, 100), ("c", 11, 55, 5)], "city string, tx long, total_cents long, avg_cents long")
    row = summaries.summary_city_stats(stats).first()
    assert (row.most_tx_city, row.highest_total_city, row.highest_avg_city, row.lowest_avg_city) == ("c", "b", "a", "c")


def test_diversity_needs_five(spark):
    counts = spark.createDataFrame([("a", str(i), 1) for i in range(4)] + [("b", "1", 1)], "city string, mcc string, tx long")
    row = summaries.summary_diversity(counts, "city").first()
    assert (row.most_diverse, row.most_categories, row.least_diverse, row.least_categories, row.diversity) == (None, 0, "b", 1, "low")


def test_declared_orders(spark):
    stats = spark.createDataFrame([("a", 1, 5), ("b", 2, 1), ("c", 2, 9)], "city string, tx long, total_cents long")
    assert [r.city for r in summaries.ranked(stats, "city_statistics").collect()] == ["c", "b", "a"]


def test_words(spark):
    df = spark.createDataFrame([("Don't  stop,\n STOP! é --- 42",), ("",), (None,)], "text string")
    assert {r.word: r.n for r in words.word_count(df, "text").collect()} == {"dont": 1, "stop": 2, "42": 1}


def test_words_match_brute_force(spark, small_dir):
    import re
    from collections import Counter

    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("text")
    want = Counter(
        w for r in docs.collect() for t in re.split(r"[ \t\n\x0b\f\r]+", r.text) if (w := re.sub("[^a-zA-Z0-9]", "", t.lower())))
    assert {r.word: r.n for r in words.word_count(docs, "text").collect()} == dict(want)


def test_mean_by_keys(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0), ("", "x", 9.0), ("a", None, 9.0)], "k string, l string, v double")
    assert [tuple(r) for r in keyed.avg_by_keys(df, ["k", "l"], "v").collect()] == [("a", "x", 2, 1.5)]


def test_results_do_not_depend_on_partitioning(transactions):
    rows = [dict(client_id=str(i % 3), amount=f"${i}.{i % 100:02}", merchant_city=f"c{i % 5}", merchant_state=["ND", "CA", ""][i % 3],
                 mcc=str(5400 + i % 4), card_id=str(i % 4)) for i in range(60)]
    df = transactions(*rows)
    for build in (
        clients.client_channel_profile, merchants.merchant_profile, rfm.rfm_client, risk.client_risk_profile,
        lambda d: risk.risk_report(risk.risk_score(risk.client_risk_profile(d))),
        categories.top_categories_by_city,
    ):
        as_set = lambda d: sorted(map(repr, build(d).collect()))
        assert as_set(df.repartition(1)) == as_set(df.repartition(7, "amount"))


def test_a_hot_owner_is_reduced_before_it_is_exchanged(spark):
    """With all rows of one owner, an exchange moves one partial result per place and input partition,
    and hash aggregates alone see them."""
    rows = spark.range(20_000, numPartitions=4).selectExpr(
        "cast(7 + id div 100000 as string) client_id", "concat('$', id % 90, '.00') amount", "'Swipe' use_chip", "concat('c', id % 9) merchant_city",
        "concat('s', id % 3) merchant_state", "'' errors")
    profile = clients.client_channel_profile(rows)
    assert [(r.tx, r.state, r.city) for r in profile.collect()] == [(20_000, "S0", "C0")]
    plan = profile._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ObjectHashAggregate" not in final and "mode(" not in final
    assert re.search(r"[^t]HashAggregate\(keys=\[client_id#\d+, state#\d+, city#\d+\], functions=\[partial_count", final)
    raw = final.split("Range (0, 20000")[0]  # what stands above the raw rows, up to the first exchange
    assert "Sort" not in raw[raw.rindex("Exchange"):]


def test_huge_amounts_keep_their_rows(transactions):
    df = transactions(dict(amount="1e20"), dict(amount="$-1.50"), dict(amount="NaN", client_id="n"), dict(amount="1e300", client_id="h"))
    rows = table(risk.client_risk_profile(df), "client_id")
    assert (rows["825"].tx, rows["825"].cards, rows["825"].chargebacks) == (2, 1, 1)
    assert rows["825"].total == 1e20 and rows["825"].avg == 5e19
    assert rows["h"].tx == rows["n"].tx == 1 and rows["h"].total == 1e300
    scored = table(risk.risk_score(risk.client_risk_profile(df)), "client_id")
    assert "HIGH_AVG_AMOUNT" in scored["825"].factors and "AVG_AMOUNT" not in scored["n"].factors
    report = risk.risk_report(risk.risk_score(risk.client_risk_profile(df.where("amount <> 'NaN'"))))
    assert sorted((r.clients, r.total_amount) for r in report.collect()) == [(1, 1e20), (1, 1e300)]


def test_saturated_merchant_amounts(transactions):
    df = transactions(dict(amount="1e30"), dict(amount="1e30"), dict(amount="$2.00"), dict(merchant_id="m", amount="-1e30"))
    rows = table(merchants.merchant_profile(df), "merchant_id")
    assert (rows["59935"].tx, rows["59935"].sum_cents, rows["59935"].max_cents) == (3, 2**63 - 1, 2**63 - 1)
    assert (rows["M"].tx, rows["M"].sum_cents) == (1, -(2**63))


def test_risk_timestamps_with_text_behind(transactions):
    df = transactions(dict(date="2010-01-01 00:01:00.0"), dict(date="2010-01-02 00:01:00Z"), dict(date="2010-01-03 00:01"))
    row = risk.client_risk_profile(df).first()
    assert (row.tx, row.first_ts, row.last_ts) == (2, 1262304060000, 1262390460000)
    assert rfm.rfm_client(df).first().frequency == 1


def test_the_reference_day_is_utc(spark):
    day = lambda: spark.range(1).select(rfm._reference_day(RfmRules(reference_date="")).alias("d")).first().d
    zone = spark.conf.get("spark.sql.session.timeZone")
    days = []
    try:
        for name in ("UTC", "Pacific/Kiritimati", "Pacific/Pago_Pago"):
            spark.conf.set("spark.sql.session.timeZone", name)
            days.append(day())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(set(days)) == 1


def test_the_predominant_value_of_many_owners(transactions, spark):
    """More owners than any fallback threshold; ties go to the smallest text, whatever carries the measures."""
    rows = spark.range(30_000).selectExpr(
        "concat('c', id % 1500) client_id", "concat('$', id % 90, '.00') amount", "'Swipe' use_chip",
        "concat('y', (id div 1500) % 4) merchant_city", "concat('s', (id div 3000) % 2) merchant_state", "'' errors")
    got = {r.client_id: (r.tx, r.sum_cents, r.max_cents, r.state, r.city) for r in clients.client_channel_profile(rows).collect()}
    want = {}
    for c in range(1500):
        ids = range(c, 30_000, 1500)
        amounts = [i % 90 * 100 for i in ids]
        want[f"c{c}"] = (20, sum(amounts), max(amounts), "S0", "Y0")
    assert got == want
    by_hand = spark.createDataFrame([("o", "b", 2), ("o", "a", 2), ("o", None, 2), ("p", "z", 1), ("q", "a", None)], "o string, v string, n int")
    from cardtide.operators.profiles import predominant
    from pyspark.sql import functions as F
    assert {r.o: r.m for r in by_hand.where("v is not null").groupBy("o").agg(predominant(F.col("v"), F.col("n")).alias("m")).collect()} == {
        "o": "a", "p": "z", "q": None}


def test_leaders_per_category_are_bounded_lists(spark):
    rows = [(f"c{i:03}", c, s, "f", 1, 1.0) for i, (c, s) in enumerate(
        [("LOW", 5)] * 30 + [("HIGH", 70)] * 3 + [("CRITICAL", 90 + i % 7) for i in range(40)])]
    risks = spark.createDataFrame(rows, "client_id string, category string, score int, factors string, tx long, total double")
    got = [(r.category, r.rank, r.client_id, r.score) for r in risk.top_risk_clients(risks, 4).collect()]
    want = []
    for category in {r[1] for r in rows}:
        best = sorted((r for r in rows if r[1] == category), key=lambda r: (-r[2], r[0]))[:4]
        want += [(category, i + 1, r[0], r[2]) for i, r in enumerate(best)]
    assert sorted(got) == sorted(want)
    plan = risk.risk_report(risks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 4 and "Window" not in plan


def test_impossible_dates_carry_over_in_the_risk_analysis_alone(transactions):
    df = transactions(dict(date="2001-02-30 18:00:00"), dict(date="2001-03-01 00:00:00"))
    row = risk.client_risk_profile(df).first()
    assert (row.tx, row.first_ts, row.last_ts) == (2, 983404800000, 983556000000)  # 1 March, 2 March 18:00
    assert rfm.rfm_client(df).first().frequency == 1
