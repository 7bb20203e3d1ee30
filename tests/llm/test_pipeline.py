"""The pipeline's rows against brute force, stage by stage."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderwell.llm import language_id
from orderwell.llm.pieces import PieceEncoder
from orderwell.llm.queries import PIECE_FILE

from . import brute
from .conftest import DOCUMENT


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    blank = real.limit(3).withColumns({"doc_id": F.col("doc_id") + 9000, "text": F.lit("12 34 --")})
    real.unionByName(blank).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages_match_brute_force(spark, raw):
    docs = spark.read.parquet(f"{raw}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    model = language_id.train(docs.filter(~language_id.held_out()))
    rejected = {r.doc_id for r in language_id.predict(docs, model).collect() if r.rejected}
    rows = [r for r in rows if r[0] not in rejected]
    assert rejected >= {i for i in range(9000, 9200) if any(r[0] == i for r in rows)} and len(rejected) < 8
    kept = {f[0] for f in brute.exact(rows) if f[3]}
    rows = sorted(r for r in rows if r[0] in kept)
    sets = [brute.shingles(r[1]) for r in rows]
    roots = brute.components(len(rows), lambda i, j: brute.similar(sets[i], sets[j]))
    rows = [r for i, r in enumerate(rows) if roots[i] == i]
    sizes, targets = brute.mixing(rows)
    encoder = PieceEncoder(public_tokenizers.path(PIECE_FILE)).library
    expected = {r[0]: (len(encoder.encode(r[1])), targets[r[3]] / sizes[r[3]]) for r in rows}
    copies = {}
    for r in corpus_pipeline.run(spark, raw).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert r.n_tokens == expected[r.doc_id][0]
    for doc_id, (_, rate) in expected.items():
        assert abs(copies.get(doc_id, 0) - rate) < 1


FILTERS = [function for _, function in corpus_pipeline.STAGES[:3]]


def counted(df):
    from collections import Counter

    return Counter(map(tuple, df.collect()))


def test_stages_take_odd_rows(spark, docs, rows):
    """Null ids and texts, repeated rows, ties and columns with clashing names: every
    stage keeps whole rows of its input, and those that must stay."""
    left = docs
    for stage_of in FILTERS:
        before, left = left, stage_of(spark, left, "")
        assert left.columns == docs.columns and not counted(left) - counted(before)
    kept = {(r.doc_id, r.text) for r in left.collect()}
    texts = [r[1] for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert {brute.lower(t) for _, t in kept} <= {brute.lower(t) for t in texts}
    assert any(i is None for i, _ in kept)  # a text that only rows without an id have
    copies = [brute.lower(t) for _, t in kept]
    assert len(copies) == len(set(copies))
    taken = corpus_pipeline.mixed(spark, left, "")
    assert taken.columns == docs.columns and set(counted(taken)) <= set(counted(left))
    found = corpus_pipeline.encoded(spark, docs, "").collect()
    assert len(found) == len(rows)
    assert {r.n_tokens for r, (_, t, *_) in zip(sorted(found, key=lambda r: r.n_tokens), rows) if r.n_tokens == 0} == {0}


def test_nothing_goes_for_want_of_labels(spark, docs, rows):
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.known_language(spark, bare, "").count() == len(rows)


def test_empty_tables_stay_empty(spark, no_docs, tmp_path):
    for stage_of in (function for _, function in corpus_pipeline.STAGES):
        assert stage_of(spark, no_docs, "").count() == 0
    spark.createDataFrame([], DOCUMENT).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
