"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, dom_marginals, license_scan, mixing, nbsvm, partenum, rule_forest, sanitise, sharding, token_store, topk, variants, whitening
from .common import table
from .statements import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Gives the workers this package, unless their search path has it already."""
    if _ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep) or "cardtide.zip" in str(spark.sparkContext._python_includes):
        return
    base = os.path.join(tempfile.mkdtemp(), "cardtide")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", _ROOT, "cardtide"))


def _on(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(table(spark, sf_dir, name))
    return query


def _with_labels(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return query


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _tokens(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return token_store.encoded_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": _on("documents", license_scan.scan_documents),
    "op2_personal_data": _on("documents", lambda d: sanitise.find_personal_data(d).drop("text_hash")),
    "op3_token_store": _on("documents", _tokens),
    "op4_rule_forest": _with_labels(rule_forest.judged),
    "op5_mixing": _with_labels(mixing.document_rates),
    "op6_dom_marginals": _on("pages", dom_marginals.extract),
    "op7_partenum": _on("documents", partenum.jaccard_groups),
    "op8_sharding": _on("documents", sharding.assign_shards),
    "op9_pigeonhole": _benchmark,
    "op10_nbsvm": _with_labels(nbsvm.classify),
    "op11_columnar_topk": _on("embeddings", topk.nearest),
    "op12_jacobi_davidson": _on("embeddings", whitening.whiten),
    "op13_variant_tiles": _on("documents", variants.variants),
}
