"""The corpus pipeline: quality, near-duplicates, contamination, secrets, mix.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage
before it kept; all but the last return the columns of ``documents``.  Rows are
judged one by one, under a number of their own: a row with a null id or with the
id of another row stays or goes by its own text.  Of a near-duplicate group the
row of the smallest id stays (null ids last), of rows with equal ids the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, mixing, quality, secrets, simhash_dedup
from ledgerline.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the quality network accepts; it learns from the labelled rows of ``docs``."""
    net = quality.train(docs, _table(spark, sf_dir, "labels"))
    return docs.select(*COLUMNS).where(quality.score_column(F.col("text"), net) >= quality.THRESHOLD)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number per row, written so that it stays the same in every later read."""
    return materialize(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "numbered-rows")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The numbered rows but for those in ``gone``."""
    return docs.join(materialize(gone.select("row").distinct(), "gone"), "row", "left_anti").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each SimHash group."""
    rows = numbered(docs)
    groups = simhash_dedup.simhash_groups(rows, id_col="row").select("row", "component_id")
    groups = materialize(groups.join(rows.select("row", "doc_id"), "row"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    kept = groups.groupBy("component_id").agg(first).select(F.col("first.row").alias("row"))
    return without(rows, groups.select("row").join(kept, "row", "left_anti"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that hold a benchmark item."""
    rows = numbered(docs)
    return without(rows, decontaminate.find_contamination(rows, _table(spark, sf_dir, "benchmark"), id_col="row"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; every document stays."""
    clean = secrets.redact(docs.select(*COLUMNS, F.col("text").alias("was")), secrets.learn(docs))
    length = F.when(F.col("text") == F.col("was"), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
    return clean.select("doc_id", "text", "lang", "source", F.coalesce(length, F.col("n_chars")).alias("n_chars"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the mix takes, with ``copies``, how often."""
    mixed = mixing.select_mixed(docs.select(*COLUMNS))
    return mixed.select(*COLUMNS, F.col("mix_copies").alias("copies"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# The trained network and XXH64 have no SQL form; tests/llm holds run() against
# brute force and the stages against their operators.
ORACLE_SQL = None
