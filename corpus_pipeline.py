"""From raw documents to encoded training text: five stages, each over all its input.

``STAGES`` names them in order; every function takes (spark, docs, sf_dir) and
returns the rows its decisions leave, with the columns of ``documents``, the last one
a row per document for the encoded text.  ``run`` writes each stage's rows as Parquet
to the shared folder and reads them back as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderwell.llm import exact_dedup, language_id, mixing, near_dedup, pieces
from orderwell.llm.queries import PIECE_FILE, documents
from orderwell.llm.shipping import ship
from orderwell.sources.tables import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected.

    The model learns from the training fold of what it is given.  Texts that are null or
    have no letter are rejected, others by their confidence; each row is judged by its
    text alone, so repeated rows and rows without an id share their text's answer.
    Where nothing is labelled there is no model to reject a document, and all stay.  An
    empty table stays empty.
    """
    ship(spark)
    model = language_id.train(docs.filter(~language_id.held_out()))
    return docs if model is None else language_id.drop_rejected(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of those with equal texts (A-Z as a-z; null as empty): that with the
    largest doc_id, any of them where it is repeated; one without an id only if none has
    one.  An empty table stays empty."""
    ship(spark)
    return exact_dedup.drop_copies(docs)


#: Least similarity of word shingles, in percent, at which the stage takes two documents
#: for near copies: op4's.
NEAR_PERCENT = near_dedup.PERCENT


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingles that with the smallest doc_id.

    Null and empty texts have no shingles and stay.  A row without an id goes if a
    document has its shingles; of an id's several texts only those go that are not kept.
    An empty table stays empty.
    """
    ship(spark)
    return near_dedup.drop_near_copies(docs, percent=NEAR_PERCENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A null source is one of its own, last in order; texts without words weigh nothing
    and are taken by their source's rate like others.  Repeated rows are taken one by
    one, and draw alike.  An empty table stays empty.
    """
    ship(spark)
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix, copies included; a null
    text is empty and has no tokens, ids may be null or repeated."""
    ship(spark)
    return pieces.digest(docs, public_tokenizers.path(PIECE_FILE))


STAGES = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mix", mixed),
    ("encode", encoded),
]

#: The language model and the encoding are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
