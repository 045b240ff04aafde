"""Sharding by sampled splitters: near equal bytes per shard, equal texts side by side.

Records are ordered by the key (first 60 bits of the text's MD5, then doc_id). A size-weighted sample
of keys gives quantile boundaries, which cut the records into many more ranges than shards. Exact
sizes per range and running sums inside each range then place every record, so the sample decides
only how even the work is, never the result, which SQL can state as one running sum. A range that
turns out overfull is subdivided by a second sample drawn inside it. Rows equal in text and id travel
as counts and are dealt out again at the end, so even a third of all rows being equal is no single
task's work. Everything is DataFrame expressions.

Beyond MAX_RANGES * RANGE_BYTES of text (1 TB) ranges grow with the input; what a range holds of a
document is some 60 bytes, sorted with spilling.

Ties and nulls: a null text counts as no bytes (size 1) and is grouped with empty texts; repeated
rows each get a slot of their own; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage, whole_row

SHARDS = 16
#: Ranges per shard at least, and bytes of records a range should hold at most.
RANGES_PER_SHARD, RANGE_BYTES = 16, 256 << 20
#: Sampled keys per range. There are at most MAX_RANGES splitters, the bound of what is broadcast.
SAMPLES_PER_RANGE, MAX_RANGES = 20, 1 << 12
BUCKET_BITS = 12
LOWEST = -(1 << 63)
#: A group of equal texts up to this share of a shard is never cut.
WHOLE_GROUP_SHARE = 0.01
#: Copies of a row that travel as one record at most.
COPIES = 1024


def _bytes() -> Column:
    return F.col("size") * F.col("copies")


def records(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, key``: what the placement needs of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        # Sixty bits, moved to the range of a long so that the sign takes part in the order of ranges.
        ((F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") - (1 << 59)) * 16).alias("key"),
    )


def counted(rows: DataFrame) -> DataFrame:
    """Equal rows as one record with ``copies``; records of more than COPIES rows lie in chunks."""
    equal = rows.groupBy("key", "doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    chunked = equal.select("*", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})")).alias("chunk"))
    return chunked.withColumn("copies", F.least(F.lit(COPIES), F.col("n") - F.col("chunk") * COPIES)).drop("n")


def _sampled_keys(rows: DataFrame, total: int, wanted: int) -> DataFrame:
    """Keys drawn with probability in proportion to weight; a record much larger than the step counts
    as often as it holds steps. The draw hashes the record, so a rerun repeats it."""
    step = max(total / wanted, 1.0)
    dice = F.pmod(F.xxhash64("key", "doc_id", "chunk", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    hits = F.floor(F.col("weight") / step + dice).cast("int")
    return rows.select("key", F.coalesce("doc_id", F.lit(LOWEST)).alias("doc_id"), hits.alias("hits")).where("hits > 0")


def _quantiles(sample: DataFrame, ranges: int) -> DataFrame:
    """``key, doc_id``: the sampled keys at the inner quantiles.

    The sample has a size fixed by the number of ranges, whatever the input, so its running sum is
    one small window. A boundary is moved to the start of its group of equal keys, except inside a
    group that holds several boundaries: such a group is larger than a range and is subdivided.
    """
    in_order = Window.orderBy("key", "doc_id")
    summed = sample.select(
        "key", "doc_id", "hits",
        F.sum("hits").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("hits").over(Window.partitionBy()).alias("all"))
    step = lambda hits: F.floor(hits * F.lit(ranges) / F.col("all"))
    cuts = summed.where((step(F.col("upto")) > step(F.col("upto") - F.col("hits"))) & (F.col("upto") < F.col("all")))
    first_of_key = F.coalesce(F.lag("key").over(in_order) != F.col("key"), F.lit(True))
    return cuts.select("key", F.when(first_of_key, F.lit(LOWEST)).otherwise(F.col("doc_id")).alias("doc_id"))


def _with_range(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` with ``part``: the number of cuts at or below a record's key.

    Keys are hashes, so their top bits spread the cuts over fixed buckets; a row looks up its bucket
    (a table of 2 ** BUCKET_BITS rows) and compares with the cuts of that bucket only.
    """
    bucket = F.shiftright("key", 64 - BUCKET_BITS).alias("bucket")
    half = 1 << (BUCKET_BITS - 1)
    own = cuts.distinct().groupBy(bucket).agg(F.collect_list(F.struct("key", "doc_id")).alias("cuts"))
    every = rows.sparkSession.range(-half, half).select(F.col("id").alias("bucket"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = every.join(own, "bucket", "left")
    lookup = held.select(
        "bucket", "cuts",
        F.coalesce(F.sum(F.when(F.col("cuts").isNull(), 0).otherwise(F.size("cuts"))).over(before), F.lit(0)).alias("base"))
    reached = F.filter("cuts", lambda c: c <= F.struct(F.col("key"), F.coalesce("doc_id", F.lit(LOWEST)).alias("doc_id")))
    inside = F.when(F.col("cuts").isNull(), 0).otherwise(F.size(reached))
    return rows.withColumn("bucket", bucket).join(F.broadcast(lookup), "bucket").select(
        *rows.columns, (F.col("base") + inside).cast("int").alias("part"))


def range_partitioned(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Counted ``rows`` with ``part``, the range of each record, and ``cut``, whether its group of equal
    texts is larger than a group that stays whole and lies in several ranges; ranges follow the key order.

    A record weighs its size plus the mean size, so neither bytes nor rows pile up in one range,
    even where a third of all texts are empty.
    """
    total, count = rows.agg(F.sum(_bytes()), F.sum("copies")).first()
    total, count = total or 0, count or 0
    weighed = rows.withColumn("weight", _bytes() + F.col("copies") * (total // max(count, 1)))
    ranges = int(min(MAX_RANGES, max(shards * RANGES_PER_SHARD, total // RANGE_BYTES)))
    cuts = stage(_quantiles(_sampled_keys(weighed, 2 * total, ranges * SAMPLES_PER_RANGE), ranges), "cuts")
    # Subdivide ranges that hold far more than their share, where the sample missed a dense stretch.
    held = _with_range(weighed, cuts).groupBy("part").agg(F.sum("weight").alias("held"))
    overfull = stage(held.where(F.col("held") > 8 * total / ranges), "overfull")
    found, inside = overfull.agg(F.count("*"), F.sum("held")).first()
    if found:
        dense = _with_range(weighed, cuts).join(F.broadcast(overfull.select("part")), "part").select(*weighed.columns)
        more = min(ranges, 64 * found)
        finer = _quantiles(_sampled_keys(dense, inside, more * SAMPLES_PER_RANGE), more)
        cuts = stage(cuts.union(finer), "cuts")
    # A cut inside a group that has to stay whole moves to the group's start. There are at most as many
    # such groups as cuts.
    entered = F.broadcast(cuts.where(F.col("doc_id") != LOWEST).select("key").distinct())
    sizes = rows.join(entered, "key").groupBy("key").agg(F.sum(_bytes()).alias("held"))
    large = stage(sizes.where(F.col("held") > total / shards * WHOLE_GROUP_SHARE).select("key", F.lit(True).alias("cut")), "large")
    kept = cuts.join(F.broadcast(large), "key", "left").select("key", F.when(F.col("cut"), F.col("doc_id")).otherwise(F.lit(LOWEST)).alias("doc_id"))
    ranged = _with_range(rows, stage(kept.distinct(), "cuts")).join(F.broadcast(large), "key", "left")
    return ranged.withColumn("cut", F.coalesce("cut", F.lit(False)))


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    Law ``bytes``: with the records laid end to end in key order, shard ``s`` takes those whose
    middle lies in the ``s``-th of ``shards`` equal parts; a group of equal texts that is small
    against a shard is placed by the middle of the group, so it stays whole. ``slot`` numbers the
    records of a shard without gaps.
    """
    rows = stage(counted(records(docs)), "records")
    ranged = stage(range_partitioned(rows, shards), "ranged")
    sizes = ranged.groupBy("part").agg(F.sum(_bytes()).alias("bytes"), F.sum("copies").alias("n"))
    # At most MAX_RANGES (plus subdivisions) rows: one small window.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    upto = Window.partitionBy("part").orderBy("key", "doc_id", "chunk").rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy("part", "key")
    at = ranged.join(F.broadcast(offsets), "part").select(
        "*", (F.col("bytes_before") + F.sum(_bytes()).over(upto) - _bytes()).alias("start"),
        (F.col("rows_before") + F.sum("copies").over(upto) - F.col("copies")).alias("position"))
    grouped = at.select("*", F.min("start").over(group).alias("group_start"), F.sum(_bytes()).over(group).alias("group_bytes"))
    target = F.col("total") / F.lit(float(shards))
    whole = ~F.col("cut") & (F.col("group_bytes") <= target * WHOLE_GROUP_SHARE)
    places = stage(grouped.select(
        "key", "doc_id", "chunk", "size", "text_crc32", "copies", "start", "position", target.alias("target"),
        F.when(whole, F.col("group_start") + F.col("group_bytes") / 2).alias("group_middle")), "places")
    # Copies are dealt over all tasks before they become rows again.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = places.repartition(tasks, "key", "doc_id", "chunk").select(
        "*", F.explode(F.expr("sequence(0L, copies - 1)")).alias("copy"))
    middle = F.coalesce("group_middle", F.col("start") + F.col("copy") * F.col("size") + F.col("size") / 2)
    placed = copies.select(
        "doc_id", "size", "text_crc32", (F.col("position") + F.col("copy")).alias("position"),
        F.least(F.floor(middle / F.col("target")), F.lit(shards - 1)).cast("int").alias("shard"))
    # Shards follow the key order, so a slot is the distance from the shard's first record.
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents in their columns, one folder ``shard=<s>`` each, in slot order inside files; where
    a column has that name, the folders are called ``shard_of=<s>``, and so on.

    Rows with equal id and text are written as often as they occur.
    """
    folder = "shard"
    while folder in map(str.lower, docs.columns):
        folder += "_of"
    placed = assign_shards(docs, shards).groupBy("doc_id", "text_crc32").agg(F.min(F.struct("shard", "slot")).alias("at"))
    places = placed.select(F.col("doc_id").alias("id"), F.col("text_crc32").alias("crc"), "at")
    own = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("own")
    joined = docs.select(whole_row(docs), "doc_id", own).join(
        places, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("crc")))
    ordered = joined.repartitionByRange("at").sortWithinPartitions("at").select("row.*", F.col("at.shard").alias(folder))
    ordered.write.partitionBy(folder).parquet(path)
