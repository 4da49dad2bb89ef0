"""The corpus pipeline: five stages from ``documents`` to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racestream.llm import decontaminate, jaccard_join, packing, pii, toxicity
from racestream.llm.common import materialise, table
from racestream.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents scored as toxic go."""
    ship_package(spark)
    lexicon = toxicity.learn_lexicon(docs, toxicity.training_labels(spark, sf_dir))
    scored = toxicity.score_toxicity(docs, lexicon, docs.columns)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5 (five words, similarity 0.8): one document of each group stays, the smallest id."""
    ship_package(spark)
    return jaccard_join.one_per_class(docs, width=5, num=80, den=100).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a benchmark window go."""
    ship_package(spark)
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), docs.columns)
    return found.where(F.size("hits") == 0).select("row.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: personal data is replaced by its kind; n_chars follows the new text."""
    ship_package(spark)
    found = pii.extract(docs, docs.columns, pii.learn_patterns(docs), redact=True)
    new = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast(docs.schema["n_chars"].dataType)}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the pieces of all documents and their places in sequences of 4096 tokens."""
    ship_package(spark)
    return packing.pack_documents(docs, ["doc_id"]).select(
        "row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: tokenizer ids and learned models are beyond SQL; tests/llm compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
