"""The corpus pipeline: documents in, token ids of the documents worth keeping out.

Stages, in order (each works on all rows its predecessor kept):

1. quality classifier: documents scored below 0.3 go;
2. line dedup: repeated runs of lines go from the text (``n_chars`` follows);
3. SimHash near-dedup: one document of each group stays, the one of smallest id;
4. benchmark decontamination: documents with a benchmark window go;
5. byte-level BPE: ids of every text, and a digest of the bytes they decode to.

All but the last return the columns of their input. A null text is empty, rows
that repeat are documents of their own until stage 3, extra columns pass
through, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.llm import bpe, decontaminate, line_dedup, quality_cnn, simhash
from restock.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = quality_cnn.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_cnn.score(docs, net, least=quality_cnn.THRESHOLD).select("row.*")


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=simhash.SHINGLE, radius=simhash.RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns without the text, with tokens and digests."""
    import public_tokenizers
    vocabulary = bpe.Vocabulary(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    others = [c for c in docs.columns if c != "text"]
    done = bpe.round_trip(docs, vocabulary, columns=others)
    return done.select(*[F.col("row").getField(c).alias(c) for c in others], "tokens", F.size("tokens").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [("quality_classifier", quality_classifier), ("line_dedup", line_deduplication),
          ("simhash_near_dedup", near_deduplication), ("benchmark_decontamination", decontamination),
          ("byte_bpe", tokenisation)]

# The classifier is a trained network: SQL cannot state it. tests/llm holds the
# pipeline against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written as Parquet
    in the checkpoint folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
