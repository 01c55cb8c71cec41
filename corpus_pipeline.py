"""Documents to packed training sequences: quality classifier, SimHash
near-dedup, passage dedup, packing.

Every stage works on all that its predecessor kept. ``run`` writes each
stage's rows to the shared folder and reads them again, so a lost executor
costs work of one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.llm import packing, quality, simhash, substring
from metroframe.llm.common import stored, table, unused
from metroframe.llm.queries import ACCEPT, training_labels


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a score of at least ACCEPT; the others go. The classifier is
    fitted on the labelled rows outside the held-out fold. Null and empty texts
    have the score of no evidence; rows of null or repeated ids are judged by
    their own texts; a score of exactly ACCEPT stays; an empty table stays
    empty. Other columns are carried, whatever their names."""
    weights = quality.fit(docs, training_labels(spark, sf_dir))
    score, = unused(docs.columns, "score")
    scored = quality.score(docs, weights, score_col=score)
    return scored.where(F.col(score) >= ACCEPT).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: that of the smallest id.
    Null and empty texts have the fingerprint zero and are copies of each other;
    of rows equal in id and text one stays; an empty table stays empty."""
    return simhash.keep_first(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans of sentences that an earlier place has already
    given; n_chars follows the new text. Every row stays, null and emptied texts
    too; rows equal in id and text lose the same spans; an empty table stays
    empty. Other columns are carried, whatever their names."""
    return substring.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document in a sequence of 2048 tokens. Null and
    empty texts are documents of one token; rows of null or repeated ids are
    documents like any other; a very long text fills whole sequences; an empty
    table gives no piece. Other columns are not read."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", accept_quality),
    ("simhash", drop_near_duplicates),
    ("lines", drop_repeated_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has no XXH64, no training and no tokenizer: tests/llm holds the stages against brute force
ORACLE_SQL = None
