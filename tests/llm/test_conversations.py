import hashlib
import itertools
import random
import re
import tracemalloc

import numpy as np
import pytest

from orderwell.llm import prefix_trie, turn_repair
from orderwell.llm.prefix_trie import Lending, Walk
from orderwell.llm.turn_repair import Row, lightest

from . import brute
from .conftest import by_row

CONVERSATION = "conv_id long, turn long, role string, text string"
NODE = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
)


def messy_talks():
    """Few different turns, so that beginnings are shared; copies, ties, nulls, gaps."""
    rng = random.Random(8)
    says = ["Hi.", "héllo 🙂?", "", None, "a b\nc", " \t", "why!", "x" * 3000]
    roles = ["user", "assistant", "system", None, ""]
    rows = []
    for conv in [*range(60), -7, -6, -5, -1, 10**15 + 1]:
        for turn in range(rng.randrange(0, 9)):
            rows.append((conv, None if rng.random() < 0.05 else turn, roles[rng.randrange(3) if turn else 0], rng.choice(says[:3])))
    rows += [(70 + i, t, r, x) for i in range(15) for t, r, x in ((0, "user", "the same"), (1, "assistant", "again."))]
    rows += [(200, t, roles[t % 2], rng.choice(says)) for t in range(40)]
    rows += [(201, 1, None, None), (201, 1, "user", "tie"), (201, 1, "user", "tie"), (None, 0, "user", "no id"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def talks():
    return messy_talks()


@pytest.fixture(scope="module")
def talk_rows(spark, talks, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("talks") / "rows")
    clashes = ("conv", "block", "key", "size", "shard", "node0", "kind", "place", "owner", "id")
    df = spark.createDataFrame(talks, CONVERSATION).repartition(3)
    df.selectExpr("*", *[f"'own' AS `{c}`" for c in clashes]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("shard_turns", [1, 37, 8192])
def test_trie_matches_brute_force(talk_rows, talks, shard_turns):
    """Shards of a block each, of a few blocks, and one for all give the same nodes."""
    expected = brute.trie(brute.rebuilt(brute.told(talks)))
    assert by_row(prefix_trie.trie(talk_rows, Lending(), shard_turns=shard_turns), *NODE) == expected


def test_trie_of_conversations_as_they_are(talk_rows, talks):
    expected = brute.trie(brute.told(talks))
    assert by_row(prefix_trie.trie(talk_rows, shard_turns=50), *NODE) == expected
    copies = [r for r in expected if r[1] == 2 and r[3] >= 15]
    assert copies and copies[0][7] == brute.sha(",".join(str(70 + i) for i in range(15)))


def test_long_end_lists_are_digested_in_order(spark):
    rows = [(i, t, "user", f"turn {t}") for i in range(3000) for t in range(2)]
    got = by_row(prefix_trie.trie(spark.createDataFrame(rows, CONVERSATION), shard_turns=1500), *NODE)
    ends = brute.sha(",".join(map(str, range(3000))))
    none = prefix_trie.EMPTY_SHA256
    assert got == sorted([
        (0, 0, None, 3000, 1, 1, 2999 * 12, none),
        (0, 1, 0, 3000, 1, 1, 2999 * 12, none),
        (0, 2, 0, 3000, 0, 1, 2999 * 6, ends),
    ], key=repr)


def test_one_very_long_conversation(spark):
    rows = spark.range(120_000).selectExpr("id div 60000 AS conv_id", "id % 60000 AS turn", "'user' AS role", "'t' || id % 60000 AS text")
    found = prefix_trie.trie(rows, shard_turns=10)
    assert found.count() == 60_001
    assert found.agg({"n_convs": "min", "n_leaves": "max"}).first()[0:2] in ((2, 1), (1, 2))


def test_conversations_without_turns_of_their_own(spark):
    # 6 takes its first turns from 5, which is not there, in place of its own.
    rows = [(c, 0, "user", "only") for c in (6, 7, 8, 9)]
    expected = brute.trie(brute.rebuilt(brute.told(rows)))
    assert any(r[1] == 0 and r[7] != prefix_trie.EMPTY_SHA256 for r in expected)
    assert by_row(prefix_trie.trie(spark.createDataFrame(rows, CONVERSATION), Lending()), *NODE) == expected


def test_no_conversations(spark):
    assert prefix_trie.trie(spark.createDataFrame([], CONVERSATION), Lending()).count() == 0
    nobody = spark.createDataFrame([(None, 1, "user", "x")], CONVERSATION)
    assert prefix_trie.trie(nobody).count() == 0


def test_walk_intersects_bitmaps():
    keys = lambda s: b"".join(hashlib.md5(c.encode()).digest() for c in s)
    walk = Walk([3, 5, 9], np.array([3, 2, 2]), keys("abcabax"))
    assert sorted(zip(walk.owner.tolist(), walk.depth.tolist(), walk.count.tolist())) == [
        (3, 0, 3), (3, 1, 3), (3, 2, 2), (3, 3, 1), (9, 2, 1)
    ]
    assert len(walk.bitmaps) == 2  # turns that one conversation alone has need none


REPAIRED = (
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
)


def test_damage_matches_brute_force(talk_rows, talks):
    got = by_row(turn_repair.damage(talk_rows), *CONVERSATION.replace(" long", "").replace(" string", "").split(", "))
    assert got == sorted(brute.damaged(talks), key=repr)


def test_repairs_match_brute_force(talk_rows, talks):
    """All kinds of faults, null ids, turns, roles and texts, ties and repeated rows."""
    got = by_row(turn_repair.repair(turn_repair.damage(talk_rows), known=talk_rows), *REPAIRED)
    assert got == brute.repair(brute.damaged(talks), {r[0] for r in talks})
    assert {c for r in got for c in r[7]} == set("DIKR")
    assert None in {r[0] for r in got}
    assert by_row(turn_repair.repair(talk_rows), *REPAIRED) == brute.repair(talks)


def test_every_short_conversation_is_repaired_at_least_cost():
    kinds = [Row(i, d, u) for i in "sua " for d, u in ((False, False), (True, False), (False, True))]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            assert lightest(rows) == brute.repairs(rows), rows
            if n < 2 or rows[0].initial != rows[1].initial:
                assert lightest(rows) == brute.all_repairs(rows), rows


def test_long_conversations_are_repaired_at_least_cost():
    rng = random.Random(5)
    for _ in range(40):
        rows = [Row(rng.choice("suua a"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(30))]
        assert lightest(rows) == brute.repairs(rows)


def test_a_conversation_of_very_many_rows_takes_little_memory():
    rows = [_ROW_KINDS[i % 3] for i in range(60_000)]
    tracemalloc.start()
    cost, audit = lightest(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (cost, audit) == (80_000, "KKD" * 20_000)
    assert peak < 60_000 * 600


_ROW_KINDS = [Row("u", False, False), Row("a", False, False), Row("u", True, False)]


def test_repaired_rows_are_legal_and_digested(talk_rows):
    rows = turn_repair.damage(talk_rows)
    written = turn_repair.repaired(rows).collect()
    digests = {r.conv_id: (r.audit, r.repaired_sha256) for r in turn_repair.repair(rows).collect()}
    lines = {conv: [] for conv in digests}
    for r in sorted(written, key=lambda r: (str(r.conv_id), r.place)):
        lines[r.conv_id].append(r)
    for conv, own in lines.items():
        audit, digest = digests[conv]
        assert "".join(r.edit for r in own) == audit.replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in own))
        assert digest == brute.sha("\n".join(f"{r.role}:{r.text}" for r in own))


def test_nothing_to_repair(spark):
    none = spark.createDataFrame([], CONVERSATION)
    assert turn_repair.repair(turn_repair.damage(none), known=none).count() == 0
    only = spark.createDataFrame([(3,), (None,)], "conv_id long")
    empty = brute.sha("")
    assert by_row(turn_repair.repair(none, known=only), *REPAIRED) == [
        (3, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)
    ]
    assert turn_repair.repaired(none).count() == 0
