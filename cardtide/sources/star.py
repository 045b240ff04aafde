"""Adapter: a star schema of orders, line items and suppliers seen as card transactions.

``lineitem`` is the fact table. ``orders`` (key ``o_orderkey``) and ``supplier`` (key
``s_suppkey``) are looked up by foreign key, and only when a requested column comes from them,
so an analysis by merchant never pays for the join with ``orders``. ``orders`` grows with the facts
and is never a side to broadcast, so its join asks for an exchange of both sides by order key, as a
large table needs it; the cleaning and aggregation that follow then run in all partitions. Facts are
dealt out by their size (``lines.parts_by_size``), so hash tables of a task stay small. The join
with ``supplier`` is left to the optimizer, which broadcasts it only when its measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed
from .lines import parts_by_size

# Location per supplier nation and category per part (fixed values of the adapter).
_LOCATIONS = (
    "CA", "NY", "TX", "FL", "WA", "OH", "IL", "GA", "PA", "MI", "NC", "NJ", "VA", "AZ", "MA", "TN", "CO", "MN", "OR", "DC",
    "Canada", "Mexico", "Italy", "", "N/A",
)
_CODES = ("5812", "5541", "5411", "4784", "4900", "5942", "5814", "4829", "5311", "9999", "bad")

_FROM_ORDERS = {"client_id", "card_id"}
_FROM_SUPPLIER = {"use_chip", "merchant_city", "merchant_state"}


def _text(c: Column) -> Column:
    return c.cast("string")


def _two_digits(c: Column) -> Column:
    return F.lpad(_text(c), 2, "0")


def _expressions(names: tuple[str, ...]) -> list[Column]:
    """The named transaction columns over the joined tables; only these are built."""
    col = F.col

    def cents() -> Column:
        return F.round(col("l_extendedprice") * 100).cast("bigint") % 60000

    def online() -> Column:
        return col("st") == ""

    def refunded() -> Column:
        return (col("l_returnflag") == "R") & (col("l_linenumber") % 5 == 0)

    rules = {
        "id": lambda: _text(col("l_orderkey") * 10 + col("l_linenumber")),
        "date": lambda: F.concat(
            _text(col("l_shipdate").cast("date")), F.lit(" "),
            _two_digits((col("l_orderkey") * 7 + col("l_linenumber") * 5) % 24), F.lit(":"),
            _two_digits((col("l_partkey") * 13) % 60), F.lit(":00"),
        ),
        "client_id": lambda: _text(col("o_custkey")),
        "card_id": lambda: _text(col("o_custkey") * 10 + col("l_orderkey") % (1 + col("o_custkey") % 5)),
        "amount": lambda: F.concat(
            F.lit("$"), F.when(refunded(), "-").otherwise(""),
            _text(F.floor(cents() / 100)), F.lit("."), _two_digits(cents() % 100),
        ),
        "use_chip": lambda: F.when(online(), "Online Transaction")
        .when(col("l_linestatus") == "O", "Chip Transaction")
        .otherwise("Swipe Transaction"),
        "merchant_id": lambda: _text(col("l_suppkey")),
        "merchant_city": lambda: F.when(online(), "ONLINE").otherwise(
            F.concat(F.lit("City "), _text(col("l_suppkey") % 7))),
        "merchant_state": lambda: col("st"),
        "zip": lambda: _text(col("l_suppkey") % 1000),
        "mcc": lambda: F.get(F.array(*map(F.lit, _CODES)), (col("l_partkey") % 11).cast("int")),
        "errors": lambda: F.when((col("l_returnflag") == "R") & (col("l_partkey") % 4 == 0), "Insufficient Balance")
        .when((col("l_returnflag") == "A") & (col("l_partkey") % 29 == 0), "Bad PIN,Technical Glitch")
        .otherwise(""),
    }
    return [rules[name]().alias(name) for name in names]


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the schema, partitioned as its files are."""
    return spark.read.parquet(_path(sf_dir, name))


def _facts(spark: SparkSession, sf_dir: str, needed: set[str]) -> DataFrame:
    parts_by_size(spark, _path(sf_dir, "lineitem"))
    facts = read_table(spark, sf_dir, "lineitem")
    if needed & _FROM_ORDERS:
        orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").hint("shuffle_hash")
        facts = facts.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if needed & _FROM_SUPPLIER:
        location = F.get(F.array(*map(F.lit, _LOCATIONS)), F.col("s_nationkey"))
        suppliers = read_table(spark, sf_dir, "supplier").select("s_suppkey", F.coalesce(location, F.lit("")).alias("st"))
        facts = facts.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return facts


def card_transactions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The requested transaction columns (default: all 12), one row per line item."""
    names = columns or fixed.COLUMNS
    return _facts(spark, sf_dir, set(names)).select(*_expressions(names))


def card_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same transactions as raw text lines, with the usual dirt of such files.

    Among the lines of one line number, some are a repeated header, some have lost their last
    field, gained one, or carry a blank, textual or oddly written value, or text after the date.
    Error texts with a comma are quoted.
    """
    # Three plain steps instead of one nested expression, which would be too large to compile.
    facts = _facts(spark, sf_dir, _FROM_ORDERS | _FROM_SUPPLIER)
    typed = facts.select("l_linenumber", "l_partkey", *_expressions(fixed.COLUMNS))
    hit = lambda number, remainder: (F.col("l_linenumber") == number) & (F.col("l_partkey") % 10 == remainder)
    errors = F.col("errors")
    fields = typed.withColumns({
        "amount": F.when(hit(1, 0), "abc").when(hit(1, 1), '"$1,234.56"').when(hit(1, 2), "").otherwise(F.col("amount")),
        "client_id": F.when(hit(2, 0), "NULL").when(hit(2, 1), " ").otherwise(F.col("client_id")),
        "merchant_city": F.when(hit(3, 0), "n/a").when(hit(3, 1), "").otherwise(F.col("merchant_city")),
        "merchant_state": F.when(hit(3, 2), "pr").when(hit(3, 3), "online").otherwise(F.col("merchant_state")),
        "use_chip": F.when(hit(4, 0), "y").when(hit(4, 1), "0").when(hit(4, 2), "tap").otherwise(F.col("use_chip")),
        "date": F.when(hit(4, 3), "2001-02-30 18:00:00").when(hit(4, 4), "soon")
        .when(hit(4, 5), F.concat("date", F.lit(".0"))).when(hit(4, 6), F.concat("date", F.lit("Z"))).otherwise(F.col("date")),
        "errors": F.when(hit(5, 0), "N/A").when(hit(5, 1), "no_error")
        .when(errors.contains(","), F.concat(F.lit('"'), errors, F.lit('"'))).otherwise(errors),
    })
    whole = fields.withColumn("most", F.concat_ws(",", *fixed.COLUMNS[:-1]))
    value = (
        F.when(hit(6, 0), ",".join(fixed.COLUMNS))
        .when(hit(6, 1), F.col("most"))
        .when(hit(6, 2), F.concat_ws(",", "most", "errors", F.lit("extra")))
        .otherwise(F.concat_ws(",", "most", "errors"))
    )
    # The generator keeps later filters from being pushed into (and repeating) the construction.
    return whole.select(F.explode(F.array(value)).alias("value"))


def house_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as lines of house sales: type as city, brand as status, retail price as price.

    Some lines are repeated headers, and some have lost a field's text.
    """
    hit = lambda remainder: F.col("p_partkey") % 40 == remainder
    filled = lambda column, remainder: F.when(hit(remainder), "").otherwise(F.col(column).cast("string"))
    fields = F.concat_ws(
        ",", F.lit("agent"), filled("p_brand", 1), filled("p_retailprice", 2), F.lit("bed"), F.lit("bath"), F.lit("acre"),
        F.lit("street"), filled("p_type", 3), F.lit("end"))
    value = F.when(hit(0), "brokered_by,status,price,bed,bath,acre,street,city").otherwise(fields)
    return read_table(spark, sf_dir, "part").select(value.alias("value"))
