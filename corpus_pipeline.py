"""From raw documents to packed training sequences: five stages, each over all rows that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codeloom.llm import minhash, packing, pii, quality, substring
from codeloom.llm.queries import vocabulary
from codeloom.session import new_table_path

#: Five-word similarity from which documents are near duplicates; 85 is the contract of op3 only.
NEAR_PERCENT = 80
#: Documents of a host with a line from which it is boilerplate on a host of any size; op7's SQL knows only the 5 %.
MAX_LINE_DOCS = 1000
#: Bytes of a packing worker's tables of seen chunks and words; op8 has more, but there no other stage has filled the JVM.
SEEN_BYTES = (96 << 20, 48 << 20)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_documents(docs, quality.QualityParams(max_line_docs=MAX_LINE_DOCS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs, percent=NEAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.without_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack_documents(docs, vocabulary(), seen_bytes=SEEN_BYTES))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("personal data", personal_data),
    ("packing", packed),
]

#: Tokenising and packing cannot be said in SQL; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_table_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
