import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("8")


@pytest.fixture(scope="session")
def small_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not available")
    return SMALL


@pytest.fixture
def evaluate(spark):
    """Values of a column expression for a list of texts."""
    from pyspark.sql import functions as F

    def run(rule, texts, column="c"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {column} string")
        rows = df.select("i", rule(F.col(column)).alias("v")).collect()
        return [r.v for r in sorted(rows, key=lambda r: r.i)]

    return run


@pytest.fixture
def transactions(spark):
    """Transactions from dicts; columns that are not given have ordinary values."""
    from cardtide.functions.fixed import COLUMNS

    usual = dict(
        id="1", date="2010-01-01 00:01:00", client_id="825", card_id="4524", amount="$10.00",
        use_chip="Swipe Transaction", merchant_id="59935", merchant_city="Beulah", merchant_state="ND",
        zip="58523.0", mcc="5499", errors="",
    )

    def make(*rows, **common):
        data = [tuple({**usual, **common, **row}[c] for c in COLUMNS) for row in rows]
        return spark.createDataFrame(data, ", ".join(f"{c} string" for c in COLUMNS))

    return make
