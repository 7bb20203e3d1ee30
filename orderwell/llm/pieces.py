"""SentencePiece encoding that keeps the place of every piece in the original text.

The text is normalised by the rules compiled into the model: at each position the
longest matching key of the character map is replaced, everything else is copied a
character at a time, and for every byte of the result the byte of the original it
came from is recorded.  The pieces of the library's encoding tile the normalised
text, so each piece is projected back to a span of original bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.llm.text import blocks

SPACE_MARK = "▁".encode()
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 keys, then the
    replacement strings, each ending in a zero byte."""

    def __init__(self, blob: bytes):
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.strings = blob[4 + size :]
        else:
            self.units, self.strings = [], b""

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that begins at ``at``."""
        if not self.units:
            return None
        found, node = None, 0
        unit = self.units[0]
        node ^= _offset(unit)
        for end in range(at, len(text)):
            node ^= text[end]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != text[end]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, place = found
        return length, self.strings[place : self.strings.index(b"\0", place)]


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 0x200) >> 6)


def _character(text: bytes, at: int) -> int:
    """Length of the UTF-8 character that begins at ``at``."""
    lead = text[at]
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normaliser:
    def __init__(self, spec, user_pieces: list[bytes] = (), space_suffix: bool = False):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        self.mark = SPACE_MARK if spec.escape_whitespaces else b" "
        self.user_pieces = sorted(user_pieces, key=len, reverse=True)
        self.space_suffix = space_suffix
        #: Without a map and without squeezing, every byte but a space is itself.
        self.plain = not (self.map.units or self.squeeze or self.user_pieces or space_suffix)

    def run(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and the original byte each begins at, with the end
        of the original as a last entry."""
        return self._plain(text) if self.plain else self._mapped(text)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        if not text:
            return b"", np.zeros(1, np.int64)
        head = self.mark if self.prefix else b""
        widths = np.ones(len(text), dtype=np.int64)
        widths[np.frombuffer(text, np.uint8) == 0x20] = len(self.mark)
        origin = np.repeat(np.arange(len(text)), widths)
        normal = head + text.replace(b" ", self.mark)
        return normal, np.concatenate([np.zeros(len(head), np.int64), origin, [len(text)]])

    def _next(self, text: bytes, at: int) -> tuple[int, bytes]:
        for piece in self.user_pieces:
            if text.startswith(piece, at):
                return len(piece), piece
        found = self.map.longest(text, at)
        if found:
            return found
        n = _character(text, at)
        return n, text[at : at + n]

    def _mapped(self, text: bytes) -> tuple[bytes, np.ndarray]:
        at = 0
        if self.squeeze:
            while at < len(text):
                n, piece = self._next(text, at)
                if piece != b" ":
                    break
                at += n
        if at == len(text):
            return b"", np.full(1, len(text))
        out, origin = bytearray(), []
        if self.prefix and not self.space_suffix:
            out += self.mark
            origin += [at] * len(self.mark)
        after_space = self.squeeze
        while at < len(text):
            n, piece = self._next(text, at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                marked = piece.replace(b" ", self.mark)
                out += marked
                origin += [at] * len(marked)
                after_space = self.squeeze and piece.endswith(b" ")
            at += n
        if self.squeeze:
            while out.endswith(self.mark):
                del out[-len(self.mark) :], origin[-len(self.mark) :]
        end = origin[-1] + self._next(text, origin[-1])[0] if origin else at
        if self.prefix and self.space_suffix:
            out += self.mark
            origin += [end] * len(self.mark)
        return bytes(out), np.array([*origin, end], dtype=np.int64)


class PieceEncoder:
    """The library's encoding and decoding, with spans of original bytes."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        users = [p.piece.encode() for p in model.pieces if p.type == _USER]
        self.normaliser = Normaliser(
            model.normalizer_spec, users, model.trainer_spec.treat_whitespace_as_suffix
        )
        #: Bytes of normalised text that an id stands for; 0 where that varies.
        self.widths = np.array(
            [
                1 if p.type == _BYTE else 0 if p.type in (_UNKNOWN, _CONTROL) else len(p.piece.encode())
                for p in model.pieces
            ],
            dtype=np.int64,
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1, add_bos=False, add_eos=False, enable_sampling=False)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1) if ids else []

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-end original byte of each piece.

        Byte pieces of one character share its span.  A model that has ids of no
        fixed width (unknown pieces) is aligned by the surfaces the library gives.
        """
        raw = text.encode()
        normal, origin = self.normaliser.run(raw)
        widths = self.widths[np.asarray(ids, dtype=np.int64)]
        if not widths.all():
            widths = self._surface_widths(text)
        ends = np.cumsum(widths)
        if (int(ends[-1]) if len(ends) else 0) != len(normal):
            raise ValueError("the pieces do not tile the normalised text")
        return origin[ends - widths], origin[ends]

    def _surface_widths(self, text: str) -> np.ndarray:
        pieces = self.library.encode(text, return_type="proto").pieces
        return np.array([len(p.piece.encode()) for p in pieces], dtype=np.int64)


def _rows(path: str, columns: dict, make):
    """A mapInArrow function whose rows ``make`` computes from id, text and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(path)
        for batch in blocks(batches, "text"):
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            made = make(encoder, texts, encoder.encode(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(v, columns[k]) for k, v in made.items())],
                names=["id", *made],
            )

    return run


def _select(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id column, ids, span_starts, span_ends.

    Spans are byte offsets into the UTF-8 text as given.  Null counts as empty and
    has no pieces; an empty table gives no rows.
    """

    def make(encoder, texts, ids):
        spans = [encoder.spans(t, i) for t, i in zip(texts, ids)]
        return {"ids": ids, "span_starts": [s[0] for s in spans], "span_ends": [s[1] for s in spans]}

    kinds = {"ids": pa.list_(pa.int32()), "span_starts": pa.list_(pa.int64()), "span_ends": pa.list_(pa.int64())}
    kind = docs.schema[id_col].dataType.simpleString()
    return _select(docs, id_col, text_col).mapInArrow(
        _rows(path, kinds, make),
        f"id {kind}, ids array<int>, span_starts array<bigint>, span_ends array<bigint>",
    ).withColumnRenamed("id", id_col)


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id column, n_tokens, ids_sha256,
    decoded_sha256 and ``covered``, the original bytes that the spans cover.

    The same encoding as ``encode``, without sending the ids back through Spark.
    """

    def make(encoder, texts, ids):
        spans = [encoder.spans(t, i) for t, i in zip(texts, ids)]
        names = _decimals(len(encoder.widths))
        listed = [",".join([names[i] for i in own]) for own in ids]
        return {
            "n_tokens": [len(i) for i in ids],
            "ids_sha256": [_sha(t) for t in listed],
            "decoded_sha256": [_sha(t) for t in encoder.decode(ids)],
            "covered": [int(e[-1] - s[0]) if len(s) else 0 for s, e in spans],
        }

    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "covered": pa.int64()}
    kind = docs.schema[id_col].dataType.simpleString()
    return _select(docs, id_col, text_col).mapInArrow(
        _rows(path, kinds, make),
        f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, covered long",
    ).withColumnRenamed("id", id_col)


def _decimals(n: int) -> list[str]:
    return [str(i) for i in range(n)]


def _sha(text: str) -> str:
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()
