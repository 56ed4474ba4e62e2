"""Training-data pipeline: quality filter, line dedup, near-dedup, mixing, BPE encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next stage's ``docs``.  All but the last return the columns of
``documents``.  Defined results for odd rows are those of the operators: null texts
count as empty, rows of one id or without one are told apart by a number per row (of copies the
first one stays), ties go to the smaller number, very long texts are read whole, an empty table gives an
empty result, and columns other than those of ``documents`` are dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import bpe, lines, minhash, mixing, quality
from wardline.llm.common import stage_table, table_of, with_uid
from wardline.llm.queries import PATTERN, RANKS, WEIGHTS, mix_levels

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score of 0.3 or more)."""
    forest = quality.train(docs, table_of(spark, sf_dir, "labels"))
    return _columns(quality.score(docs, forest, ("doc_id", "lang", "source")).filter("score >= 0.3"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that are equal to or nearly equal to an earlier line.  Documents
    that lose every line with words go: all of their text stands in earlier ones."""
    out = lines.dedup_lines(docs, keep=("lang", "source"))
    return _columns(out.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    docs = with_uid(docs.select(*COLUMNS)).withColumnRenamed("uid", "row_key")
    kept = minhash.near_duplicates(docs, id_col="row_key").filter("kept").select("row_key")
    return _columns(docs.join(kept, "row_key"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, by the target weights: a document stands once for every epoch that
    it is read (four at most), so small domains repeat and large ones are cut; what a domain cannot fill goes to
    the others."""
    docs = with_uid(docs.select(*COLUMNS))
    taken = mixing.mix(docs, mix_levels(), WEIGHTS, uid_col="uid", max_epochs=4, fill=True).select("uid", "epochs")
    rows = docs.join(taken, "uid").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("epochs").cast("int"))))
    return _columns(rows)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their number and digests of ids and decoded bytes."""
    keep = ("doc_id", "lang", "source")
    return bpe.digests(bpe.encode(docs, RANKS, PATTERN, keep, decoded=True), *keep, "ids")


STAGES = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Boosted trees, signatures and merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table_of(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
