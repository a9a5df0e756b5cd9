"""The registered queries of this folder: each applies one operator, with its
default parameters, to all documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm.alignment import op12_alignment
from shelfmark.llm.common import documents
from shelfmark.llm.elias_fano import op8_elias_fano
from shelfmark.llm.imatch import op9_imatch
from shelfmark.llm.license_scan import op2_license_scan
from shelfmark.llm.line_dedup import op1_line_dedup
from shelfmark.llm.mixing import op5_mixing
from shelfmark.llm.near_dedup import op7_lsh_forest
from shelfmark.llm.oracles import ORACLES
from shelfmark.llm.packing import op4_packing
from shelfmark.llm.prefix_trie import op13_prefix_trie
from shelfmark.llm.quality import op6_quality
from shelfmark.llm.repeats import op11_repeats
from shelfmark.llm.sharding import op10_sharding
from shelfmark.llm.toxicity import op3_toxicity
from shelfmark.session import ship

__all__ = ["ORACLES", "QUERIES"]

_BY_DOCUMENTS = {
    "op1_line_dedup": op1_line_dedup,
    "op2_license_scan": op2_license_scan,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_lsh_forest": op7_lsh_forest,
    "op8_elias_fano": op8_elias_fano,
    "op9_imatch": op9_imatch,
    "op10_sharding": op10_sharding,
    "op11_repeats": op11_repeats,
    "op12_alignment": op12_alignment,
}


def _over_documents(apply) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: apply(spark, documents(spark, sf_dir))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return op3_toxicity(spark, documents(spark, sf_dir), labels)


def _trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return op13_prefix_trie(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {name: _over_documents(apply) for name, apply in _BY_DOCUMENTS.items()}
QUERIES["op3_toxicity"] = _toxicity
QUERIES["op13_prefix_trie"] = _trie
