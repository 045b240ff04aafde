"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: Rows of one partition that ids leave room for.
_WITHIN = (1 << 33) - 1


def write_report(lines: DataFrame, path: str, files: int | None = None, mode: str = "errorifexists",
                 order: list[str] | None = None) -> None:
    """Write ``key \\t text`` lines sorted by key (or by ``order``).

    Rows are range-partitioned, so the files together are in order and each file is sorted. With
    ``files`` their number is fixed; otherwise Spark chooses it by size.
    """
    order = order or ["key"]
    if files:
        lines = lines.repartitionByRange(files, *order).sortWithinPartitions(*order)
    else:
        lines = lines.orderBy(*order)
    lines.select(F.concat_ws("\t", "key", "text").alias("value")).write.mode(mode).text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """``part, line, position, text`` of a written report: the number of the file and of the line in it,
    and the line's place when the files are read one after the other.

    Lines are numbered by where their split of the file starts and their place in it; each file is
    numbered on its own, and only one number per file meets in one task.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("text"), F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("part"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    line = F.row_number().over(Window.partitionBy("part").orderBy("start", "at"))
    numbered = lines.select("part", line.cast("long").alias("line"), "text")
    sizes = numbered.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return numbered.join(starts, "part").select("part", "line", (F.col("before") + F.col("line")).alias("position"), "text")


def write_lines(lines: DataFrame, path: str, files: int, header: str | None = None) -> None:
    """Raw lines as ``files`` folders of text files, each file starting with ``header`` where given.

    Lines are dealt out in parts of a size that Spark's adaptive execution bounds, as many as the data
    need, and one task writes a part; equal lines of several input partitions may go to several parts.
    Small data give one file per folder, large data one per part and folder. A part has the headers of
    all its files before its first line.
    """
    number = F.pmod(F.xxhash64("value"), F.lit(files)).cast("int").alias("file")
    body = lines.select(number, "value", F.spark_partition_id().alias("source"))
    if header is not None:  # one row that is no line: there is a part, and so a header, without any line too
        body = body.unionAll(lines.sparkSession.range(1).select(F.lit(None).cast("int").alias("file"), F.lit(header).alias("value"), F.lit(0).alias("source")))
    parts = body.hint("rebalance", "value", "source").withColumn("at", F.monotonically_increasing_id())
    line = F.filter(F.array(F.struct("file", F.lit(1).alias("body"), "value")), lambda row: row["file"].isNotNull())
    if header is not None:
        heads = F.transform(F.sequence(F.lit(0), F.lit(files - 1)), lambda i: F.struct(
            i.alias("file"), F.lit(0).alias("body"), F.lit(header).alias("value")))
        line = F.when(F.col("at").bitwiseAND(_WITHIN) == 0, F.concat(heads, line)).otherwise(line)
    sorted_ = parts.select(F.inline(line)).sortWithinPartitions("file", "body")
    sorted_.select("file", "value").write.partitionBy("file").text(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write a typed table and return it as read back, so later steps do not recompute it."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
