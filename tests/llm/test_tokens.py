import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderwell.llm import pieces, token_counts, token_files
from orderwell.llm.queries import PIECE_FILE, WORD_FILE

from .brute import sha
from .conftest import by_row

WORD_PATH, PIECE_PATH = public_tokenizers.path(WORD_FILE), public_tokenizers.path(PIECE_FILE)
ODD = st.text(
    alphabet=st.one_of(
        st.sampled_from(list(" \t\n\x0b\x0c\r\x1c\x1f\x85  　abE'sl12.,!-é́İßΣ中가한🙂<|>")),
        st.characters(codec="utf-8"),
    ),
    max_size=60,
)


@pytest.fixture(scope="module")
def word_encoder():
    return token_files.WordEncoder(WORD_PATH)


def library_ids(encoder, texts):
    return [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(ODD, min_size=1, max_size=6))
def test_ids_by_word_are_the_library_s(word_encoder, texts):
    assert word_encoder.by_word
    texts = [*texts, "we'll <|endoftext|> <|startoftext|>x", ""]
    flat, counts = word_encoder.encode(pa.array(texts))
    expected = library_ids(word_encoder, texts)
    assert counts.tolist() == [len(i) for i in expected]
    assert flat.tolist() == [i for own in expected for i in own]


def test_other_files_are_encoded_whole():
    encoder = token_files.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not encoder.by_word
    texts = ["a  b", None, " x\n"]
    flat, counts = encoder.encode(pa.array(texts))
    expected = library_ids(encoder, ["a  b", "", " x\n"])
    assert flat.tolist() == [i for own in expected for i in own] and counts.tolist() == list(map(len, expected))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=700))
def test_boundaries_are_selected_exactly(steps):
    values = np.cumsum(steps).tolist()
    bounds = token_files.EliasFano.encode(values)
    assert bounds.all().tolist() == values
    assert [bounds.select(i) for i in range(len(values))] == values


@given(st.lists(st.binary(max_size=300), max_size=6))
def test_checksums_of_parts_join(parts):
    crcs = [zlib.crc32(p) for p in parts]
    assert token_files.joined_crc(crcs, list(map(len, parts))) == zlib.crc32(b"".join(parts))


def expected_index(rows):
    encoder = token_files.WordEncoder(WORD_PATH)
    held = []
    for doc_id, text, *_ in rows:
        ids = np.array([*library_ids(encoder, [text or ""])[0], 2], dtype="<u4")
        held.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    return held


@pytest.mark.parametrize("segment", [token_files.SEGMENT_IDS, 50])
def test_files_read_back(docs, rows, monkeypatch, segment):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", segment)
    got = by_row(token_files.index(docs, WORD_PATH), "start", "doc_id", "n_tokens", "ids_crc32")
    got.sort()
    assert sorted(((g[1], g[2], g[3]) for g in got), key=repr) == sorted(expected_index(rows), key=repr)
    ids = [g[1] for g in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [g[0] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]


def test_stored_ids_are_whole(spark, docs, rows, tmp_path):
    token_files.write(docs, str(tmp_path / "files"), WORD_PATH)
    runs = sorted(token_files.read_ids(spark, str(tmp_path / "files")).collect(), key=lambda r: (repr(r.doc_id), r.part))
    got = sorted((repr(r.doc_id), tuple(r.ids)) for r in runs)
    encoder = token_files.WordEncoder(WORD_PATH)
    expected = sorted((repr(r[0]), (*library_ids(encoder, [r[1] or ""])[0], 2)) for r in rows)
    assert got == expected


def test_no_documents(no_docs):
    assert token_files.index(no_docs, WORD_PATH).count() == 0
    assert pieces.digest(no_docs, PIECE_PATH).count() == 0
    assert pieces.encode(no_docs, PIECE_PATH).count() == 0
    assert token_counts.count(no_docs, PIECE_PATH).count() == 0


# --- SentencePiece ----------------------------------------------------------


@pytest.fixture(scope="module")
def piece_encoder():
    return pieces.PieceEncoder(PIECE_PATH)


@settings(max_examples=300, deadline=None)
@given(text=ODD)
def test_spans_cover_the_text(piece_encoder, text):
    (ids,) = piece_encoder.encode([text])
    starts, ends = piece_encoder.spans(text, ids)
    raw = text.encode()
    assert (starts <= ends).all() and (starts[1:] == ends[:-1]).all()
    if raw:
        assert starts[0] == 0 and ends[-1] == len(raw)
    for i, a, b in zip(ids, starts.tolist(), ends.tolist()):
        piece = piece_encoder.library.id_to_piece(i)
        if not piece_encoder.library.is_byte(i):
            assert raw[a:b].decode() in (piece.replace("▁", " "), piece.replace("▁", " ")[1:])


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf", "nfkc", "identity"])
@pytest.mark.parametrize("prefix,squeeze", [(True, True), (False, True), (True, False)])
def test_normalisation_is_the_library_s(rule, prefix, squeeze):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=squeeze
    )
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    own = pieces.Normaliser(model.normalizer_spec)

    @settings(max_examples=80, deadline=None)
    @given(ODD)
    def check(text):
        normal, origin = own.run(text.encode())
        assert normal.decode() == library.normalize(text)
        assert len(origin) == len(normal) + 1 and (np.diff(origin) >= 0).all()

    check()


def test_digests_are_the_library_s(docs, rows, piece_encoder):
    expected = []
    for doc_id, text, *_ in rows:
        ids = piece_encoder.library.encode(text or "")
        listed = ",".join(map(str, ids))
        expected.append((doc_id, len(ids), sha(listed), sha(piece_encoder.library.decode(ids)), len((text or "").encode())))
    got = by_row(pieces.digest(docs, PIECE_PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "covered")
    assert got == sorted(expected, key=repr)


def test_encoded_rows_hold_ids_and_spans(docs, rows, piece_encoder):
    got = pieces.encode(docs, PIECE_PATH).collect()
    expected = sorted(((r[0], piece_encoder.library.encode(r[1] or "")) for r in rows), key=repr)
    assert sorted(((g.doc_id, g.ids) for g in got), key=repr) == expected
    assert all(len(g.ids) == len(g.span_starts) == len(g.span_ends) for g in got)


# --- counts -----------------------------------------------------------------


def test_counts_are_the_library_s(docs, rows, piece_encoder):
    expected = []
    for doc_id, text, *_ in rows:
        n = len(piece_encoder.library.encode(text or ""))
        expected.append((doc_id, len((text or "").encode()), n, n > 4096))
    assert by_row(token_counts.count(docs, PIECE_PATH), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(
        expected, key=repr
    )


@settings(max_examples=150, deadline=None)
@given(
    text=st.lists(st.one_of(ODD, st.sampled_from(["aaaaaaaa", "the ", "  ", "ababab"])), max_size=40).map("".join),
    chunk=st.integers(4, 60),
    overlap=st.integers(1, 30),
)
def test_chunks_splice_to_the_whole_count(piece_encoder, text, chunk, overlap):
    counter = token_counts.TokenCounter(PIECE_PATH, chunk, overlap)
    assert counter.counts([text]) == [len(piece_encoder.library.encode(text))]


def test_overlaps_widen_without_a_stable_place(piece_encoder):
    counter = token_counts.TokenCounter(PIECE_PATH, 100, 10)
    text = "a" * 900 + " the end " + "a" * 500
    assert counter.counts([text]) == [len(piece_encoder.library.encode(text))]
    assert counter.widened


def test_json_counts_and_special_strings():
    counter = token_counts.TokenCounter(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["x <|endoftext|> y", "", "plain  text\n"]
    assert counter.counts(texts) == [
        len(e.ids) for e in counter.tokenizer.encode_batch(texts, add_special_tokens=False)
    ]


def test_a_long_text_of_new_words_takes_bounded_memory():
    """10 MB in one row, every word new: encoded in pieces, with the ids of the whole."""
    script = """
import random, resource
import pyarrow as pa
from orderwell.llm import token_files
import public_tokenizers
encoder = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
rng = random.Random(1)
text = " ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(1_000_000))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
ids, counts = encoder.encode(pa.array([text]))
assert counts.tolist() == [len(ids)]
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout) < 300


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice(["word", "é", "x", " ", "\t", "\n ", "don't", "12"]) for _ in range(3000)) + "y" * 900
    encoder = token_files.WordEncoder(WORD_PATH)
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 100)
    assert "".join(token_files._cut(text)) == text
    ids, counts = encoder.encode(pa.array([text]))
    assert ids.tolist() == whole and counts.tolist() == [len(whole)]


def test_select_reads_stored_samples():
    values = np.cumsum(np.random.default_rng(2).integers(0, 900, 5000))
    made = token_files.EliasFano.encode(values)
    read = token_files.EliasFano(made.n, made.low_bits, made.low, made.high, made.samples)
    assert len(made.samples) == 4 * -(-5000 // token_files.SELECT_STEP)
    assert [read.select(i) for i in range(5000)] == values.tolist() == read.all().tolist()
