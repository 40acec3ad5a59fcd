"""Documents made ready for training: rules, boilerplate, near copies, benchmark leaks, and packing into sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return
the columns of their input. Tables are handed on as Parquet in the shared folder.
"""

from pyspark.sql import DataFrame, SparkSession

from ratinglens.llm import stages
from ratinglens.llm.staging import staged


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.keep_good(docs)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.drop_boilerplate(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.keep_one_of_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.drop_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.pack(docs)


STAGES = [
    ("quality_rules", keep_good_documents),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# MinHash groups and best-fit packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs)
    return docs
