"""Line-oriented CSV input.

A file is read as text lines and split by one of three dialects, because the analyses disagree
on what a quoted comma means. Spark's own CSV reader knows only one of them, and would skip a
header once per file where the rule is "wherever such a line occurs".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed
from ..functions.clean import jtrim

# Stand for a field boundary, and begin an escape, while a quoted line is split.
_MARK, _ESCAPE = "\u0001", "\u0002"

#: Parts with which an exchange starts, and the compressed size up to which small ones are joined.
#: Up to 200 parts Spark's writers pass rows on to files; beyond that they hold and sort them.
PARTS, PART_SIZE = 200, "8m"
#: Bytes of input files for which an exchange has a part where adaptive execution joins none.
FILE_BYTES = 4 << 20
_INITIAL_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_PART_SIZE, _USUAL_SIZES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", ("67108864b", "67108864", "65536k", "65536kb", "64m", "64mb")
_JOINING = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
_SHUFFLE_PARTS = "spark.sql.shuffle.partitions"


def _bytes_of_files(spark: SparkSession, paths: tuple[str, ...]) -> int:
    total = 0
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        total += sum(files.getContentSummary(found.getPath()).getLength() for found in files.globStatus(path) or ())
    return total


def parts_by_size(spark: SparkSession, *paths: str) -> None:
    """Let the size of an exchange decide its parts, whatever the session's number of shuffle partitions.

    Exchanges start with ``PARTS`` parts, and adaptive execution joins small neighbours up to
    ``PART_SIZE``. A fixed number of tasks would hold ever larger hash tables as the input grows, and so
    would parts of 64 MB: rows of a few short texts take thirty times their compressed size there. What
    the session names itself stands; the usual 64 MB count as not named, however they are written.

    A session without adaptive execution, or one that joins no parts, has only its number of shuffle
    partitions. There the files at ``paths`` decide: one part per ``FILE_BYTES``, up to ``PARTS``, and
    never fewer than the session has. The settings stay in the session, as plans are made when they run.
    """
    own = int(spark.conf.get(_SHUFFLE_PARTS))
    if any(spark.conf.get(key).lower() != "true" for key in _JOINING):
        if own < PARTS and (needed := min(PARTS, -(-_bytes_of_files(spark, paths) // FILE_BYTES))) > own:
            spark.conf.set(_SHUFFLE_PARTS, str(needed))
        return
    if not spark.conf.get(_INITIAL_PARTS, None) and own < PARTS:
        spark.conf.set(_INITIAL_PARTS, str(PARTS))
    if spark.conf.get(_PART_SIZE).lower() in _USUAL_SIZES:
        spark.conf.set(_PART_SIZE, PART_SIZE)


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Text files, directories or globs as one ``value`` column, one row per line."""
    parts_by_size(spark, *paths)
    return spark.read.text(list(paths)).select("value")


def is_header(line: Column, mode: str = "id_field") -> Column:
    """Header test, applied to every line of every file.

    ``id_field``: starts with ``id,`` or ``"id"``. ``id_prefix``: the trimmed line is empty or
    starts with ``id``.
    """
    if mode == "id_field":
        return line.startswith("id,") | line.startswith('"id"')
    if mode == "id_prefix":
        t = jtrim(line)
        return (t == "") | t.startswith("id")
    raise ValueError(f"unknown header mode: {mode}")


def drop_header(lines: DataFrame, mode: str = "id_field") -> DataFrame:
    return lines.where(~is_header(F.col("value"), mode))


def _replaced(c: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _at_marks(line: Column, marked: int, glue: str) -> Column:
    pieces = F.transform(
        F.split(line, '"', -1),
        lambda piece, i: F.when(i % 2 == marked, F.translate(piece, ",", _MARK)).otherwise(piece),
    )
    return F.split(F.array_join(pieces, glue), _MARK, -1)


def _split_marked(line: Column, marked: int, glue: str) -> Column:
    """Split at the commas in every second piece of the line cut at its quotes, from ``marked`` on.

    A line that holds the boundary mark itself has it escaped before and restored after.
    """
    escaped = _replaced(line, (_ESCAPE, _ESCAPE + "b"), (_MARK, _ESCAPE + "a"))
    restored = F.transform(
        _at_marks(escaped, marked, glue),
        lambda field: _replaced(field, (_ESCAPE + "a", _MARK), (_ESCAPE + "b", _ESCAPE)))
    special = line.contains(_MARK) | line.contains(_ESCAPE)
    return F.when(special, restored).otherwise(_at_marks(line, marked, glue))


def _unless_plain(line: Column, quoted: Column) -> Column:
    """A line without quotes takes the plain split, whatever the dialect."""
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ",", -1))


def split_toggle(line: Column) -> Column:
    """Every quote switches quoting on or off and is removed; an unclosed one hides later commas.

    A comma separates fields when an even number of quotes stands before it.
    """
    return _unless_plain(line, _split_marked(line, 0, ""))


def split_even_quotes(line: Column) -> Column:
    """Split at commas followed by an even number of quotes; quotes stay in the fields.

    With an even number of quotes in the line these are the commas after an even number, else
    those after an odd number; so one linear pass does, without looking ahead from every comma.
    """
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    quoted = F.when(quotes % 2 == 0, _split_marked(line, 0, '"')).otherwise(_split_marked(line, 1, '"'))
    return _unless_plain(line, quoted)


def split_naive(line: Column) -> Column:
    """Split at every comma, quoted or not."""
    return F.split(line, ",", -1)


DIALECTS = {"toggle": split_toggle, "even_quotes": split_even_quotes, "naive": split_naive}


def with_fields(lines: DataFrame, dialect: str, at_least: int = len(fixed.COLUMNS)) -> DataFrame:
    """``parts``, the fields of each line under a dialect, for lines with enough fields.

    Extra fields are ignored later. The arity test sits inside the generator on purpose: as a
    plain filter it would be pushed below the split and every line would be split twice.
    """
    value = jtrim(F.col("value")) if dialect == "naive" else F.col("value")
    candidate = F.array(DIALECTS[dialect](value))
    long_enough = F.filter(candidate, lambda parts: F.size(parts) >= at_least)
    return lines.select(F.explode(long_enough).alias("parts"))


def name_fields(split: DataFrame, names: tuple[str, ...] = fixed.COLUMNS) -> DataFrame:
    return split.select(*[F.get("parts", F.lit(i)).alias(name) for i, name in enumerate(names)])


def parse_transactions(lines: DataFrame, dialect: str = "toggle") -> DataFrame:
    """Lines to the 12 text columns: header dropped, short lines dropped, fields named."""
    header = "id_prefix" if dialect == "naive" else "id_field"
    return name_fields(with_fields(drop_header(lines, header), dialect))


def read_transactions(spark: SparkSession, *paths: str, dialect: str = "toggle") -> DataFrame:
    return parse_transactions(read_lines(spark, *paths), dialect)


def parse_house_lines(lines: DataFrame) -> DataFrame:
    """House sales: status, price and city from plain comma-separated lines.

    Lines starting with ``brokered_by`` are headers; a row needs all three fields.
    """
    parts = F.split("value", ",", -1)
    fields = lines.where(~F.col("value").startswith("brokered_by")).select(
        F.upper(F.get(parts, F.lit(7))).alias("city"),
        F.upper(F.get(parts, F.lit(1))).alias("status"),
        F.get(parts, F.lit(2)).alias("price"),
    )
    present = [F.coalesce(F.col(c), F.lit("")) != "" for c in ("city", "status", "price")]
    return fields.where(present[0] & present[1] & present[2]).withColumn("price", F.col("price").try_cast("double"))


def read_house_lines(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_house_lines(read_lines(spark, *paths))
