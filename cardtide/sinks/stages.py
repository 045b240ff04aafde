"""Typed tables between the jobs of an analysis, with a place and a lifetime of their own."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .files import write_table


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a session of one process, as in tests, falls back to a temporary folder.
    """
    place = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not place:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="cardtide-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


class Stages:
    """The stages of one run, in one folder below ``place`` (default: the shared folder).

    A stage is written and read back with its schema, so what follows it neither recomputes nor
    depends on what came before, also when executors are lost. ``drop`` deletes the folder; as a
    context manager the stages live as long as the block.
    """

    def __init__(self, spark: SparkSession, place: str | None = None) -> None:
        self.spark = spark
        self.folder = f"{(place or shared_folder(spark)).rstrip('/')}/stages-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        """A new folder for what the caller writes."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a written table."""
        return write_table(df, self.path(name))

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


_OF_SESSION: dict[str, Stages] = {}


def session_stages(spark: SparkSession) -> Stages:
    """Stages for results that are read lazily: they live until the program ends."""
    key = spark.sparkContext.applicationId
    if key not in _OF_SESSION:
        _OF_SESSION[key] = stages = Stages(spark)
        atexit.register(_drop_quietly, stages)
    return _OF_SESSION[key]


def _drop_quietly(stages: Stages) -> None:
    try:
        stages.drop()
    except Exception:  # the session is gone already; the shared folder's own clean-up remains
        pass
