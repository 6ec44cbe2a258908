"""From raw documents to packed training sequences in five stages, each on all that the one before kept.

``run`` writes every stage's result as Parquet in the shared folder and hands the next stage a scan of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm._common import stored, table
from starloom.llm.simhash import similar_groups
from starloom.llm.language_id import held_out, predict, train
from starloom.llm.line_dedup import dedup_lines
from starloom.llm.mixing import mix, mixed_order
from starloom.llm.packing import pack

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language the classifier rejects; a null lang becomes the predicted one."""
    model = train(docs.where(~held_out()).select("text", "lang"))
    found = predict(docs.select(*COLUMNS), model, keep_text=True).where("accepted")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of runs of lines, and documents of which nothing is left; n_chars follows."""
    found = dedup_lines(docs.select(*COLUMNS)).where((F.col("lines_removed") == 0) | (F.col("lines_removed") < F.col("line_count")))
    changed = F.col("lines_removed") > 0
    return found.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, Jaccard similarity 0.8) the document with the least doc_id stays (null: last; then the first row)."""
    rows = docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id())
    groups = similar_groups(rows.select("row", "text"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = groups.join(rows.select("row", "doc_id"), "row").groupBy("part").agg(F.min(order).alias("first"))
    return rows.join(first.select(F.col("first.row").alias("row")), "row", "left_semi").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of a mixture that gives every source the square root of its size as its weight."""
    return mixed_order(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in training sequences of the permitted lengths; in the order of bin_id they keep the mixture.

    The mixture's slots follow from the rows alone, so they are found again and not read from the files' order.
    """
    return pack(mix(docs.select(*COLUMNS)), order=("mix_slot", "mix_row"))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", unrepeated_lines),
    ("simhash", distinct_documents),
    ("mixing", mixed),
    ("packing", packed),
]

#: The classifier, BK-tree linking and best-fit packing have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
