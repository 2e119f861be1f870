"""A training corpus from raw documents, stage by stage.

Every stage takes the documents its predecessor kept and returns the rows that go
on, with the columns of documents; the last returns the pieces of the packed
sequences. Nulls, empty and repeated texts have the results that the operators'
docstrings name; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.llm import minhash, mixing, packing, quality, seed_extend
from cohortia.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every group that is similar at 0.8 in runs of five words."""
    return minhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 20 words that start earlier too; a text that loses none stays as it was.

    n_chars follows the text; one that loses all its words stays as an empty one.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = seed_extend.remove_repeats(docs, layout=True, carry=["doc_id", *rest])
    text = {"text": F.col("kept_text")}
    if "n_chars" in rest:
        text["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[text.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 1024 tokens: whose, where from, and where to."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mixed sources", mixed_sources),
    ("packing", packed_windows),
]
#: SQL cannot express the random rounding and the packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
