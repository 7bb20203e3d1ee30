import random

import numpy as np
import pytest

from orderwell.llm import line_dedup, mixing
from orderwell.llm.line_dedup import CuckooFilter, LineIndex

from . import brute
from .conftest import DOCUMENT, by_row

LINES = ("doc_id", "n_lines", "n_dropped", "kept_text")


def index_of(spark, path, *batches):
    index = LineIndex(spark, str(path))
    for batch in batches:
        index.insert(batch)
    return index


def test_lines_match_brute_force(spark, docs, rows, tmp_path):
    got = by_row(index_of(spark, tmp_path / "i", docs).rewrite(docs), *LINES)
    assert got == brute.line_dedup(rows)
    assert any(r[2] for r in got)


def test_without_filters_the_exact_table_settles_all(spark, docs, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", -1)
    assert by_row(index_of(spark, tmp_path / "i", docs).rewrite(docs), *LINES) == brute.line_dedup(rows)


def line_rows(rng, n, first=0):
    pool = [f"shared line number {i} " + "of many words " * 3 for i in range(12)]
    return [
        (first + i, "\n".join(rng.choices([*pool, "short", f"own {first + i} " + "x" * 50], k=rng.randrange(1, 6))), "en", "s", 0)
        for i in range(n)
    ]


def test_batches_and_deletions_leave_what_one_load_would(spark, tmp_path):
    rng = random.Random(2)
    first, second = line_rows(rng, 40), line_rows(rng, 30, first=100)
    frame = lambda rows: spark.createDataFrame(rows, DOCUMENT)
    index = index_of(spark, tmp_path / "i", frame(first), frame(second), frame(first[:5]))
    assert by_row(index.rewrite(frame(first + second)), *LINES) == brute.line_dedup(first + second)

    gone = {r[0] for r in second[::2]} | {3, 4}
    index.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    left = [r for r in first + second if r[0] not in gone]
    assert by_row(index.rewrite(frame(left)), *LINES) == brute.line_dedup(left)

    index.insert(frame([r for r in first + second if r[0] in gone]))
    again = LineIndex(spark, str(tmp_path / "i"))
    assert again.version == index.version == 5
    assert by_row(again.rewrite(frame(first + second)), *LINES) == brute.line_dedup(first + second)


def test_no_lines(spark, no_docs, tmp_path):
    assert index_of(spark, tmp_path / "i", no_docs).rewrite(no_docs).count() == 0


def test_cuckoo_filter_holds_and_forgets():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    held = CuckooFilter(expected=100)  # far too small: it must grow
    held.insert(hashes)
    assert len(held.tables) > 1 and held.contains(hashes).all()
    held.delete(hashes[::2])
    again = CuckooFilter(held.as_bytes())
    assert again.contains(hashes[1::2]).all()
    assert again.contains(hashes[::2]).mean() < 0.01
    assert again.contains(rng.integers(0, 2**63, 10000, dtype=np.uint64)).mean() < 0.01


# --- mixing -----------------------------------------------------------------


def test_plan_matches_brute_force(docs, rows):
    got = mixing.plan(docs).collect()
    sizes, targets = brute.mixing(rows)
    source = {}
    for doc_id, text, _, s, *_ in rows:
        source.setdefault((doc_id, len(brute.words(text))), set()).add((sizes[s], targets[s]))
    assert len(got) == len(rows)
    for r in got:
        assert (r.source_size, pytest.approx(r.target)) in [
            (a, pytest.approx(b)) for a, b in source[r.doc_id, r.size]
        ]
        assert r.taken == r.size * r.copies and r.copies <= 3
        if r.source_size:
            assert abs(r.copies - r.target / r.source_size) < 1
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_agree_and_mix_repeats_rows(docs):
    first, second = (by_row(mixing.plan(docs), "doc_id", "size", "taken") for _ in range(2))
    assert first == second
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(brute.words(r.text)) for r in mixed.collect()) == sum(t[2] for t in first)


def test_taken_words_come_near_their_targets(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(5, 40), None, f"s{min(i % 10, 6)}", 0) for i in range(6000)]
    got = mixing.plan(spark.createDataFrame(rows, DOCUMENT)).toPandas()
    got["source"] = [f"s{min(i % 10, 6)}" for i in got["doc_id"]]
    for _, own in got.groupby("source"):
        target, size = own["target"].iloc[0], own["size"]
        rest = target / size.sum() % 1
        spread = (rest * (1 - rest) * (size**2).sum()) ** 0.5
        assert abs(own["taken"].sum() - target) < 4 * spread < 0.3 * target


def test_many_sources_are_capped_in_turn(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([1, 2, 500]), None, rng.choice([None, f"ключ{i % 97}", f"k{i % 13}"]), 0) for i in range(500)]
    got = {(r.source_size, round(r.target, 6)) for r in mixing.plan(spark.createDataFrame(rows, DOCUMENT)).collect()}
    sizes, targets = brute.mixing(rows)
    assert got == {(sizes[s], round(targets[s], 6)) for s in sizes}


def test_nothing_to_mix(spark, no_docs):
    assert mixing.plan(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a", 0), (2, " ", None, None, 0)], DOCUMENT)
    assert [(r.size, r.target, r.taken) for r in mixing.plan(blank).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mix(blank).count() == 0


def test_plan_is_native(docs):
    for df in (mixing.plan(docs), mixing.mix(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
