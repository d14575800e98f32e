"""The training-data pipeline: stages over documents, each written and read by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.llm import bpe, mixing, quality, simhash
from feedwright.llm.common import read, stored, unused
from feedwright.llm.exact_dedup import exact_dedup
from feedwright.llm.queries import TOKENIZER, token_digests

# Every stage takes an empty table and returns one. Columns of documents stay, also those that the operators' results would clash with.
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of good quality is at least the threshold.

    Null and empty texts have the probability of no features and all stay or all go; repeated rows
    have one probability. The model is learnt anew from documents and labels, whatever `docs` holds.
    """
    model = quality.fit_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    score = unused(docs, "_score")
    return quality.score_quality(docs, model, out=score).filter(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the largest doc_id.

    Null counts as empty, and a null doc_id is smaller than any other; of rows repeated under that id one stays.
    """
    return exact_dedup(docs).filter("kept").select(*docs.columns)


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one with the smallest doc_id.

    Null and empty texts have fingerprint zero; a null doc_id is greater than any other; of rows repeated under
    the id that stays one does.
    """
    return simhash.near_duplicates(docs).filter("kept").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, each as often as it is taken.

    A null source is one of its own. Documents without words are taken like others of their source; a source
    without words has none taken.
    """
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digests of the ids and of what they decode to; null and empty texts have no ids."""
    tokenizer = public_tokenizers.path(TOKENIZER)
    coded = token_digests(bpe.encode_and_decode(docs, tokenizer))
    return coded.select("doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("exact_dedup", one_of_equal),
    ("simhash_near_dedup", one_of_near),
    ("mix_sources", mixed),
    ("bpe", tokens),
]

# Scores, fingerprints, the sample and the tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; every one but the last is stored."""
    docs = read(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES):
            docs = stored(docs)
    return docs
