import itertools
import math
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderwell.llm import language_id, lm_scoring

from . import brute
from .conftest import DOCUMENT, by_row


# --- language ---------------------------------------------------------------


@pytest.fixture(scope="module")
def model(real):
    return language_id.train(real.filter(~language_id.held_out()))


def test_held_out_accuracy(real, model):
    held = real.filter(language_id.held_out())
    found = language_id.predict(held, model).join(held.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(found) > 40
    assert (found["lang_pred"] == found["lang"]).mean() > 0.95
    assert found["score"].between(0, 1).all() and not found["rejected"].mean() > 0.02


def test_odd_rows_have_an_answer(docs, rows, model):
    got = {(r.doc_id, r.lang_pred == "und", r.rejected) for r in language_id.predict(docs, model).collect()}
    for doc_id, text, *_ in rows:
        readable = any(c.isalpha() for c in text or "")
        if not readable:
            assert (doc_id, True, True) in got
        else:
            assert any(g[0] == doc_id and not g[1] for g in got)
    assert language_id.predict(docs, model).count() == len(rows)


def test_prediction_reads_the_text_only(spark, model):
    text = "The reading of the thing is there and that was in it."
    rows = [(1, text, "en", "a", 1), (-9, text, None, None, 7), (None, text, "zz", "b", None)]
    got = {(r.lang_pred, r.score) for r in language_id.predict(spark.createDataFrame(rows, DOCUMENT), model).collect()}
    assert len(got) == 1


def test_training_is_repeatable(real, model):
    again = language_id.train(real.filter(~language_id.held_out()).repartition(5))
    assert again.languages == model.languages and np.array_equal(again.embeddings, model.embeddings)


def test_without_labels(spark, docs, no_docs):
    assert language_id.train(no_docs) is None
    got = language_id.predict(docs, None)
    assert {(r.lang_pred, r.score, r.rejected) for r in got.collect()} == {("und", 0.0, True)}
    assert language_id.predict(no_docs, None).count() == 0
    one = language_id.train(spark.createDataFrame([(1, "abc", "en", "s", 0)], DOCUMENT))
    assert one.languages == ["en"]


def test_rejected_rows_go_and_columns_stay(docs, rows, model):
    left = language_id.drop_rejected(docs, model)
    assert left.columns == docs.columns
    judged = [r for r in language_id.predict(docs, model).collect() if not r.rejected]
    assert sorted((repr(r.doc_id) for r in left.collect())) == sorted(repr(r.doc_id) for r in judged)


def test_huge_texts_count_in_parts():
    data = np.frombuffer(("été Bon jour " * 90_000).encode(), np.uint8)
    (whole,) = language_id.subword_counts(data, np.array([0, len(data)]))
    (short,) = language_id.subword_counts(data[: len(data) // 90_000], np.array([0, len(data) // 90_000]))
    assert (whole == 90_000 * short).all()


# --- hidden Markov model ----------------------------------------------------


def small_model(states=3, symbols=5):
    rng = np.random.default_rng(6)
    draw = lambda *shape: rng.dirichlet(np.ones(shape[-1]), shape[:-1] or None)
    return lm_scoring.Markov(draw(states), draw(states, states), draw(states, symbols).T)


SEQUENCES = [np.array(s) for s in ([4], [0, 4], [1, 1, 2, 4], [3, 0, 4], [2, 2, 0, 1, 3, 4], [0, 4])]


def paths(model, sequence):
    """Every path of states with its probability."""
    for path in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]]
        for t, (state, symbol) in enumerate(zip(path, sequence)):
            p *= model.emits[symbol, state] * (model.moves[path[t - 1], state] if t else 1)
        yield path, p


@pytest.mark.parametrize("block", [lm_scoring.BLOCK_TOKENS, 4, 2, 1])
def test_likelihoods_equal_the_sum_over_paths(monkeypatch, block):
    """Sequences as a whole, and longer than a block."""
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", block)
    model = small_model()
    got = lm_scoring.log10_likelihoods(model, SEQUENCES)
    expected = [math.log10(sum(p for _, p in paths(model, s))) for s in SEQUENCES]
    assert got == pytest.approx(expected)


@pytest.mark.parametrize("block", [lm_scoring.BLOCK_TOKENS, 4, 2, 1])
def test_expected_counts_equal_the_sum_over_paths(monkeypatch, block):
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", block)
    model = small_model()
    starts, moves, emits = (np.zeros(s) for s in ((3,), (3, 3), (5, 3)))
    for sequence in SEQUENCES:
        every = list(paths(model, sequence))
        total = sum(p for _, p in every)
        for path, p in every:
            starts[path[0]] += p / total
            for t, (state, symbol) in enumerate(zip(path, sequence)):
                emits[symbol, state] += p / total
                if t:
                    moves[path[t - 1], state] += p / total
    got = lm_scoring.expected_counts(model, SEQUENCES)
    for ours, theirs in zip(got, (starts, moves, emits)):
        assert ours == pytest.approx(theirs, abs=1e-4)


def test_a_long_sequence_takes_bounded_memory(monkeypatch):
    sequence = np.random.default_rng(4).integers(0, 5, 120_000).astype("<u2")
    model = small_model(8)
    whole = lm_scoring.log10_likelihoods(model, [sequence])[0], lm_scoring.expected_counts(model, [sequence])
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 5_000)
    tracemalloc.start()
    cut = lm_scoring.log10_likelihoods(model, [sequence])[0], lm_scoring.expected_counts(model, [sequence])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120_000 * 8 * 8 / 3  # the states of all steps alone take three times that
    assert cut[0] == pytest.approx(whole[0], rel=1e-12)
    for ours, theirs in zip(cut[1], whole[1]):
        assert ours == pytest.approx(theirs, rel=1e-3, abs=1e-2)


def test_passes_raise_the_likelihood(spark):
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 6, 40) + 6 * (i % 2) for i in range(40)]
    sequences = [np.append(t, 13) for t in texts]
    counts = np.bincount(np.concatenate(sequences), minlength=14) + 0.1
    table = spark.createDataFrame([(bytes(s.astype("<u2")),) for s in sequences], "symbols binary").repartition(3)
    scores = [
        lm_scoring.log10_likelihoods(lm_scoring.train(table, counts, 2, n), sequences).sum() for n in (0, 1, 3)
    ]
    assert scores[0] < scores[1] < scores[2]


COUNTS = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")


def base_brute(rows):
    end = object()
    tokens = [[*brute.words(brute.lower(r[1])), end] for r in rows]
    held = [brute.remainder(r[0], 10) == 0 for r in rows]
    c = Counter(t for own, h in zip(tokens, held) if not h for t in own)
    n, v = sum(c.values()), len(c)
    return [
        (r[0], h, len(own), sum(c[t] > 0 for t in own), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own))
        for r, own, h in zip(rows, tokens, held)
    ]


@pytest.mark.parametrize("frequent", [lm_scoring.FREQUENT, 40, 0])
def test_counts_and_base_scores_match_brute_force(docs, rows, frequent):
    got = sorted(map(tuple, lm_scoring.score(docs, frequent=frequent).drop("score").collect()), key=repr)
    for ours, theirs in zip(got, sorted(base_brute(rows), key=repr)):
        assert ours[:5] == theirs[:5] and ours[5] == pytest.approx(theirs[5], rel=1e-9)


def test_scores_are_probabilities_of_whole_texts(spark):
    """Over all one-word texts and all others the probabilities leave no gap: with
    every word frequent, what the model gives to texts of up to two words is below 1
    and grows with their number."""
    words = ["a", "b"]
    texts = [" ".join(p) for k in range(3) for p in itertools.product(words, repeat=k)]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts * 6)]
    got = lm_scoring.score(spark.createDataFrame(rows, DOCUMENT)).toPandas()
    one_each = got[got["doc_id"] < len(texts)]
    assert 0.5 < (10 ** one_each["score"]).sum() < 1


def test_held_out_texts_are_likelier_than_by_counts_alone(real):
    got = lm_scoring.score(real).toPandas()
    held = got[got["held_out"]]
    assert len(held) > 10
    assert held["score"].sum() > held["base_score"].sum()
    assert got["score"].lt(0).all()


def test_no_texts_and_no_training(spark, no_docs):
    assert lm_scoring.score(no_docs).count() == 0
    only_held = [(i, "a b", None, None, 0) for i in range(300) if brute.remainder(i, 10) == 0]
    got = lm_scoring.score(spark.createDataFrame(only_held, DOCUMENT)).collect()
    assert {(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(True, 3, 0, 0, 0.0)}


def plain_language(model, text):
    """Language and confidence by the model's tables, gram by gram."""
    raw = (text or "").translate(brute.LOWER).encode()
    blank = b" \t\n\v\f\r"
    grams = Counter()
    for n in language_id.GRAMS:
        for i in range(len(raw) - n + 1):
            gram = raw[i : i + n]
            if any(b in blank for b in gram):
                continue
            h = n * 0x9E3779B1 % 2**32
            for b in gram:
                h = (h ^ b) * 0x01000193 % 2**32
            h ^= 0x5BD1E995 if i == 0 or raw[i - 1] in blank else 0
            h ^= 0x27D4EB2F if i + n == len(raw) or raw[i + n] in blank else 0
            h = (h ^ h >> 15) * 0x2C1B3C6D % 2**32
            grams[(h ^ h >> 13) % language_id.BUCKETS] += 1
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, True
    total = sum(grams.values())
    mean = [sum(c * float(model.embeddings[g, d]) for g, c in grams.items()) / total for d in range(language_id.DIMENSIONS)]
    logits = [
        (sum(m * float(model.weights[d, k]) for d, m in enumerate(mean)) + float(model.bias[k])) / model.temperature
        for k in range(len(model.languages))
    ]
    top = max(logits)
    chances = [math.exp(x - top) for x in logits]
    best = max(chances) / sum(chances)
    return model.languages[logits.index(top)], best, best < model.threshold


def test_predictions_match_brute_force(real, docs, model):
    """Every text of both tables, long and odd ones too, scored in plain Python."""
    for table in (docs, real.limit(60)):
        texts = [r.text for r in table.select("text").collect()]
        found = language_id.predict(table.withColumn("at", F.monotonically_increasing_id()), model, id_col="text").collect()
        got = {r.text: (r.lang_pred, r.score, r.rejected) for r in found}
        assert set(got) == set(texts)
        for text in set(texts):
            name, score, rejected = plain_language(model, text)
            assert got[text][0] == name and got[text][1] == pytest.approx(score, abs=1e-9)
            assert got[text][2] == rejected
