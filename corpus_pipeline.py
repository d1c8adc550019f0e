"""Clean a corpus stage by stage; every stage is written and read again before the next.

Each stage works on all documents that the one before kept, and returns the columns of
``documents``; the last adds token ids and their number. Tables may be empty, and may have columns
of any name besides ``doc_id``, ``text`` and ``n_chars``, which stay as they are; the ids of documents may
be null or repeated, as nothing is told apart by them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandpanel.llm import bpe, decontaminate, neardup, pii, quality
from demandpanel.llm.queries import RANKS
from demandpanel.sources.checkpoints import ensure_checkpoint_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; a null text is judged like an empty one, and
    equal texts alike."""
    return quality.accepted(docs, quality.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document of the least id (null last); one of repeated
    rows. Null, empty and wordless texts are near none and all stay, and so do different texts under one id."""
    return neardup.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is inside benchmark windows; those
    without words stay, and of repeated rows all or none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    column = "__contamination"
    found = decontaminate.hits(docs, benchmark, column=column)
    hit = decontaminate.n_hit(column)
    bad = (hit > 0) & (hit * 20 >= F.col(column)["n_words"])
    return found.where(~bad).select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and ``n_chars`` of the new texts. All rows
    stay, a null text with what ``n_chars`` it had; equal texts are changed alike."""
    return pii.redact(docs, pii.fit(docs), size="n_chars").select(*docs.columns)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``n_tokens`` and ``ids``, in place of columns of these names, and the text as decoded
    from the ids. All rows stay; a null text stays null and has no tokens, like an empty one."""
    ranks = bpe.broadcast_ranks(spark, public_tokenizers.path(RANKS))
    names = [c for c in docs.columns if c not in ("ids", "n_tokens")]
    absent = "__tokens_absent"
    marked = docs.select(*names, F.col("text").isNull().alias(absent))
    both = bpe.round_trip(marked, ranks, public_tokenizers.PATTERN)
    text = F.when(~F.col(absent), F.decode("text", "UTF-8")).alias("text")
    return both.select(
        *[text if c == "text" else F.col(c) for c in names],
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
    )


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("personal_data", without_personal_data),
    ("tokens", tokenized),
]

#: Trained models and MinHash bands have no SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps goes to the folder of checkpoints."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
