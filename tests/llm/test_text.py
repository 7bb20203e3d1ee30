import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from orderwell.llm import text as T

from .brute import lower, shingles, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x1faAbBé 中", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 12))
def test_words_are_hashed_as_whole_texts_would_be(texts, block):
    array = pa.array(["unseen", *texts], pa.string())[1:]
    kept, T.BLOCK_BYTES = T.BLOCK_BYTES, block
    try:
        hashes, counts = T.word_hashes(*T.as_arrays(array))
    finally:
        T.BLOCK_BYTES = kept
    expected = [words(lower(t)) for t in texts]
    assert counts.tolist() == [len(w) for w in expected]
    names = [w for own in expected for w in own]
    assert len(set(zip(names, hashes.tolist()))) == len(set(names)) == len(set(hashes.tolist()))


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_shingle_sets_overlap_like_word_tuples(texts):
    sets = T.shingle_sets(*T.as_arrays(pa.array(texts, pa.string())))
    expected = [shingles(t) for t in texts]
    for a, x in zip(sets, expected):
        assert len(a) == len(x)
        for b, y in zip(sets, expected):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_blocks_keep_rows_and_order():
    batch = pa.record_batch({"t": pa.array(["aa", None, "b" * 50, "", "c"]), "n": pa.array(range(5))})
    parts = list(T.blocks(iter([batch]), "t", limit=10))
    assert [r for p in parts for r in p.column("n").to_pylist()] == list(range(5))
    assert len(parts) > 1
