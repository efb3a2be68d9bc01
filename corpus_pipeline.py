"""A training corpus in five stages, each over everything that the stage before it kept.

Every function takes ``(spark, docs, sf_dir)``; all but the last return rows with the columns of
``documents``. ``run`` writes each stage's rows to the session's checkpoint folder before the next.

For all stages: a null text counts as empty and stays what it is; repeated rows are rows of their own
unless a stage says otherwise; an empty table gives an empty one; other columns, whatever their
names, come through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.llm import contamination, jaccard, mixing, packing, quality
from gridwarden.llm.common import remainder, table, without_ids
from gridwarden.session import cut_lineage

MIN_QUALITY = 0.3

#: No stage but the mix could be put in SQL, so the rows are tested against plain Python instead.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier scores below 0.3. A score of exactly 0.3 stays;
    null ids and texts are scored as the empty text is; equal texts share their score."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = quality.quality_model(docs, labels)
    column = max(docs.columns, key=len) + "_quality"  # longer than every other name
    return quality.scored(docs, model, column=column).where(F.col(f"`{column}`") >= MIN_QUALITY).drop(column)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingle sets (five words) have a similarity of 0.8 or more: the
    one with the smallest id. Of rows with that id one stays, the first by text. Rows without an id
    or without words are near nothing and all stay."""
    return jaccard.one_of_each(docs, width=5, threshold=jaccard.Threshold(80, 100))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a window of a benchmark item occurs. Rows of one id go together;
    null ids are one id; documents without words stay."""
    hits = contamination.phrase_matches(docs, table(spark, sf_dir, "benchmark"))
    return without_ids(docs, cut_lineage(hits.select("doc").distinct()))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, at most twice. Null sources are one
    source, the last; within a source documents follow a hash of their id, and rows of one id go
    together; documents without words have size 0."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids: every row's tokens, whole, in rows of the packer's own columns. Rows without
    text have no tokens and so no place."""
    import public_tokenizers

    return packing.pack_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_good),
    ("near_copies", one_of_near_copies),
    ("benchmark", without_benchmark),
    ("mix", mixed),
    ("pack", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
