"""Token counts of texts of any length with bounded memory.

A huge document is encoded in overlapping chunks.  Two chunks are spliced at a place
in their overlap where both have a piece boundary that is stable: one between two
characters that stand side by side in no piece of the vocabulary.  No merge can
cross such a place whatever stands around it, so the pieces on either side are those
of the whole text.  Where an overlap has no such place it is widened, in the end to
the whole document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.llm.pieces import SPACE_MARK, PieceEncoder
from orderwell.llm.text import blocks

#: Characters of a chunk, and of the overlap tried first.
CHUNK, OVERLAP = 1 << 15, 256


class TokenCounter:
    """Counts for a tokenizers file (.json) or a sentencepiece model (.model)."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.chunk, self.overlap = chunk, overlap
        self.widened = 0
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self.pieces = None
        else:
            self.pieces = PieceEncoder(path)
            names = [self.pieces.library.id_to_piece(i) for i in range(len(self.pieces.widths))]
            self.inside = {a + b for name in names for a, b in zip(name, name[1:])}

    @property
    def splices(self) -> bool:
        """Whether chunks can be proved: the model merges normalised characters that
        are the characters of the text."""
        return self.pieces is not None and self.pieces.normaliser.plain

    def counts(self, texts: list[str]) -> list[int]:
        short = [t if not self.splices or len(t) <= self.chunk else "" for t in texts]
        if self.pieces is None:
            found = [len(e.ids) for e in self.tokenizer.encode_batch_fast(short, add_special_tokens=False)]
        else:
            found = [len(ids) for ids in self.pieces.encode(short)]
        return [n if s or not t else self.count_long(t) for n, s, t in zip(found, short, texts)]

    def _stable(self, text: str, at: int) -> bool:
        mark = SPACE_MARK.decode()
        return (text[at - 1 : at + 1].replace(" ", mark)) not in self.inside

    def _boundaries(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the whole text where pieces of one chunk begin, as characters,
        and the number of pieces before each; the chunk's end comes last."""
        part = text[start:end]
        (ids,) = self.pieces.encode([part])
        firsts, _ = self.pieces.spans(part, ids)
        raw = np.frombuffer(part.encode(), np.uint8)
        heads = (raw & 0xC0) != 0x80
        place = np.append(np.cumsum(heads) - heads, heads.sum())
        starts = np.append(place[firsts], len(part))
        whole = np.append(heads[firsts], True)  # a byte piece may begin inside a character
        kept = np.flatnonzero(whole)
        # The prefix put before a text is no character: several pieces may begin at 0.
        return starts[kept] + start, kept

    def count_long(self, text: str) -> int:
        """Pieces of the whole text from chunks of it.

        ``spliced`` is the place up to which pieces are counted for good.  The next
        chunk starts an overlap before it and must agree on a stable boundary.
        """
        overlap, start = self.overlap, 0
        end = min(len(text), self.chunk)
        places, before = self._boundaries(text, 0, end)
        counted, from_piece = 0, 0
        while end < len(text):
            next_start = max(start, end - overlap)
            next_end = min(len(text), next_start + max(self.chunk, 2 * overlap))
            next_places, next_before = self._boundaries(text, next_start, next_end)
            shared = np.intersect1d(places, next_places)
            shared = shared[(shared > next_start) & (shared < end)]
            meet = next((p for p in shared[::-1].tolist() if self._stable(text, p)), None)
            if meet is None:
                self.widened += 1
                if next_start == start:  # the overlap is the whole chunk: take more text
                    end = min(len(text), end + (end - start))
                    places, before, from_piece = self._again(text, start, end, places, before, from_piece)
                    overlap = self.overlap
                else:
                    overlap *= 2
                continue
            counted += int(before[np.searchsorted(places, meet)]) - from_piece
            places, before, start, end = next_places, next_before, next_start, next_end
            from_piece = int(before[np.searchsorted(places, meet)])
            overlap = self.overlap
        return counted + int(before[-1]) - from_piece

    def _again(self, text, start, end, places, before, from_piece):
        """The chunk encoded up to a later end; its first counted piece is the one at
        the same stable place as before."""
        at = int(places[np.searchsorted(before, from_piece)])
        places, before = self._boundaries(text, start, end)
        return places, before, 0 if not from_piece else int(before[np.searchsorted(places, at)])


def count(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096
) -> DataFrame:
    """One row per row of ``docs``: the id column, n_bytes, n_tokens, over_limit.

    Counts are the library's for the whole text, without begin, end or other added
    tokens.  Null counts as empty: no bytes, no tokens.  An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path)
        for batch in blocks(batches, "text"):
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counter.counts(texts), pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return (
        rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
        .withColumnRenamed("id", id_col)
    )
