"""The corpus pipeline: quality, near duplicates, leakage, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; the tables `labels` and `benchmark`
come from sf_dir. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsink.llm.common import free_name, table, written
from docsink.llm.decontaminate import build_index, search
from docsink.llm.near_duplicates import near_duplicates
from docsink.llm.packing import pack_documents
from docsink.llm.personal_data import redact, train
from docsink.llm.quality_model import THRESHOLD, score_of, with_statistics
from docsink.llm.quality_model import train as train_quality


def _rows(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """docs, written with a number for each row, by which the stages tell rows apart; (doc_id, text) of it, the number being the doc_id; and the number's column."""
    row = free_name(docs, "pipeline_row")
    rows = written(spark, docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    return rows, rows.select(F.col(row).alias("doc_id"), "text"), row


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts, each by its own text; a null doc_id has no label, and is judged like any other."""
    statistics = free_name(docs, "pipeline_statistics")
    rows = written(spark, with_statistics(docs, statistics), "statistics")
    model = train_quality(spark, rows.select("doc_id", f"{statistics}.*"), table(spark, sf_dir, "labels"), "quality")
    return rows.where(score_of(model, statistics) >= THRESHOLD).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates: that of the least doc_id, a null one coming last; of equal ones, any one."""
    rows, numbered, row = _rows(spark, docs)
    classes = near_duplicates(spark, numbered).select(F.col("doc_id").alias(row), "class_id").join(rows.select(row, F.col("doc_id").alias("id")), row)
    firsts = classes.groupBy("class_id").agg(F.min_by(row, F.struct(F.col("id").isNull().alias("none"), "id", row)).alias(row))
    return rows.join(firsts, row, "left_semi").select(*docs.columns)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any passage of a benchmark item, each by its own text, whatever its doc_id."""
    rows, numbered, row = _rows(spark, docs)
    index = written(spark, build_index(numbered), "index")
    hit = search(spark, index, table(spark, sf_dir, "benchmark")).where("n_hit > 0").select(F.col("doc_id").alias(row))
    return rows.join(hit, row, "left_anti").select(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    clean = redact(docs, train(docs))
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences."""
    return pack_documents(spark, docs)


STAGES = [("quality", good), ("near duplicates", distinct), ("decontamination", unleaked), ("personal data", private), ("packing", packed)]
#: The classifier, the near duplicates' sketches and the packing can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
