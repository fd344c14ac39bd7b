"""Documents made ready for training, in five stages.

Each stage works on all rows that the one before it kept, whatever further columns they
have. Rows with a null or empty text leave with the quality stage. All other cases are
those of the operators, stated in their modules; an empty table passes as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordops.llm import byte_pairs, decontamination, minhash_forest, quality, suffix_sort
from recordops.llm.base import row_key, settle, table

#: No stage can be put in SQL over whole tables: learnt scores, links on all sets, byte matches, merges.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, fitted on these very rows, keeps."""
    model = quality.fit(docs)
    scored = quality.score(docs.select(F.struct("*").alias("row"), "doc_id", "text"), model)
    return scored.filter("quality_kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest document id.

    Sets of five-word shingles, similarity 0.8. Rows of one id are one
    document, of which any one row stays; rows without an id stay.
    """
    found = minhash_forest.near_duplicates(docs, size=5, percent=80)
    kept = found.filter("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi").select(docs.columns)
    return rows.dropDuplicates(["doc_id"]).unionByName(docs.filter("doc_id is null"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without the bytes of strings of 200 bytes that stand elsewhere too.

    A character of which bytes are removed goes as a whole; n_chars is that of the new text.
    """
    left = suffix_sort.remove_repeats(docs, size=200, carry=True)

    @F.pandas_udf("string")
    def text_of(kept):
        return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    text = F.when(F.col("n_removed") > 0, text_of("kept")).otherwise(F.col("kept").cast("string"))
    left = left.withColumn("row", F.col("row").withField("text", text))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("row", F.col("row").withField("n_chars", F.length("row.text").cast(kind)))
    return left.select("row.*").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated: hit words are less than a twentieth of their words."""
    flags = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    rows = docs.select(F.struct("*").alias("row"), row_key("doc_id", "text").alias("_key"))
    return rows.join(flags.filter("contaminated").select("_key"), "_key", "left_anti").select("row.*")


def byte_pair_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row with their digest and that of the decoded bytes."""
    return byte_pairs.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_pair_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
