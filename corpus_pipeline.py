"""The corpus pipeline: documents judged, cleaned, deduplicated, mixed and packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All stages but the last return the
columns of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import store
from shelfmark.llm.line_dedup import drop_recurring_lines
from shelfmark.llm.mixing import mixed_documents
from shelfmark.llm.near_dedup import without_near_duplicates
from shelfmark.llm.packing import pack
from shelfmark.llm.quality import judge
from shelfmark.llm.tokens import default_tokenizer
from shelfmark.session import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return judge(docs).where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; those that held nothing else go."""
    cleaned = drop_recurring_lines(docs)
    left = (F.col("n_dropped") == 0) | F.col("row.text").rlike(r"[^ \t-\r]")
    row = F.col("row").withField("n_chars", F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.length("row.text")))
    return cleaned.where(left).select(row.alias("row")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship(spark)
    return without_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship(spark)
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their ids."""
    ship(spark)
    return pack(docs, default_tokenizer(), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing to target weights", mixing),
    ("packing", packing),
]

#: SQL can express neither the forest nor the tokens; tests hold each stage against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
