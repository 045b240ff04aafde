"""Helpers shared by the operators: input columns, stage tables, membership filters, words."""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows handed to Python at once; with documents of 20,000 words this is a few dozen MB.
BATCH_ROWS = 512

_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *more: str) -> DataFrame:
    """``doc_id, text`` (null text: empty) and the further columns named; others are left behind,
    so an input may have any extra columns."""
    return df.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def quoted(name: str) -> str:
    """A column name as it stands in expressions, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``row``: helper columns beside it cannot clash with them, and
    ``select("row.*")`` brings them back."""
    return F.struct(*[F.col(quoted(name)) for name in df.columns]).alias("row")


def map_batches(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``function`` over batches of rows of bounded length, partition by partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), BATCH_ROWS):
                yield function(batch.iloc[start:start + BATCH_ROWS])
    return df.mapInPandas(run, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset, in a session of one process as in tests, a temporary folder is made and set.
    """
    place = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not place:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="cardtide-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: lineage ends here, and a
    lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Membership:
    """A filter of fixed size over 64-bit hashes: no member is missed, others may pass.

    It only thins out rows before an exact join. Its size does not grow with the data; when it
    fills up it lets more rows pass, and the join does the rest.
    """

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @staticmethod
    def build(hashes: DataFrame, column: str, bits: int = 1 << 23) -> Membership:
        slots = bits // 64
        parts = (
            hashes.select(
                F.expr(f"cast(shiftrightunsigned({column}, 6) & {slots - 1} as int)").alias("slot"),
                F.expr(f"shiftleft(1L, cast({column} & 63L as int))").alias("bit"))
            .groupBy("slot").agg(F.bit_or("bit").alias("bits"))
        )
        words = np.zeros(slots, dtype=np.uint64)
        rows = parts.toPandas()  # at most ``slots`` rows
        words[rows["slot"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
        return Membership(words)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes.astype(np.int64, copy=False).view(np.uint64)
        slot = (h >> np.uint64(6)) & np.uint64(len(self.words) - 1)
        return (self.words[slot] >> (h & np.uint64(63))) & np.uint64(1) == 1


def lower_ascii(text: str) -> bytes:
    """UTF-8 bytes with A-Z as a-z and nothing else changed."""
    return text.encode("utf-8", "surrogatepass").translate(_UPPER)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (finalizer of splitmix64)."""
    h = h.astype(np.uint64, copy=False)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
     0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash for each window of ``width`` (at most 8) words; none for shorter texts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        total += mix(hashes[i:i + n] + _FACTORS[i]) * _FACTORS[i]
    return mix(total)


def crc_fold(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
