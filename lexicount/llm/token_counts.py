"""Token counts by overlap resynchronisation (operator 8).

Texts of up to ``chunk`` characters are encoded by the library as they are.
A longer one is encoded in chunks that overlap; each chunk's tokens get their
character offsets, and neighbouring chunks are spliced at the first place in
the overlap where both have a token boundary that is proven stable. A place
between two characters is proven if no piece of the vocabulary contains the
two side by side: then no merge, in any context, crosses it, so the text
before and the text behind it are encoded independently, and either chunk's
tokens are those of the whole. If an overlap holds no such place it is
doubled, up to the end of the text.

The chunk's dummy prefix only affects tokens before its first proven place,
which the chunk before it supplies. Null texts are empty; an empty text has
no tokens.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicount.llm._spark import Batches, map_arrow, pick

VOCABULARY = "piece_bpe_32k.model"
CHUNK, OVERLAP = 16384, 256
LIMIT = 4096


class Counter:
    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        n = self.sp.get_piece_size()
        self.chars = np.zeros(n, dtype=np.int64)
        self.inner = np.zeros(n, dtype=bool)  # a further byte of a character
        pairs: set[str] = set()
        for i in range(n):
            p = self.sp.id_to_piece(i)
            if self.sp.is_byte(i):
                self.inner[i] = 0x80 <= int(p[3:5], 16) < 0xC0
                self.chars[i] = not self.inner[i]
            elif not (self.sp.is_control(i) or self.sp.is_unknown(i)):
                self.chars[i] = len(p)
                pairs.update(p[k : k + 2] for k in range(len(p) - 1))
        self.pairs = pairs

    def proven(self, a: str, b: str) -> bool:
        """No piece contains the characters side by side."""
        return (a + b).replace(" ", "▁") not in self.pairs

    def starts(self, ids: list[int], shift: int) -> np.ndarray:
        """The character each token starts in, ``shift`` being that of the first;
        a dummy prefix is part of the first token."""
        ids = np.asarray(ids, dtype=np.int64)
        n = self.chars[ids]
        return np.cumsum(n) - n - self.inner[ids] + shift

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of a text of any length."""
        if len(text) <= chunk:
            return len(self.sp.encode(text))
        total, a, from_ = 0, 0, 0  # tokens before ``from_`` are counted
        while True:
            b, wide = a + chunk, overlap
            if b >= len(text):
                tail = self.starts(self.sp.encode(text[a:]), a - 1)
                return total + int((tail >= from_).sum()) if from_ else total + len(tail)
            while True:
                end = min(len(text), b + wide)
                here = self.starts(self.sp.encode(text[a:end]), a - 1)
                if end == len(text):  # widened to the end: nothing is left to splice
                    return total + (int((here >= from_).sum()) if from_ else len(here))
                ahead = self.starts(self.sp.encode(text[b:end]), b - 1)
                at = self.splice(text, here, ahead, b + 1, end - 1)
                if at is not None:
                    break
                wide *= 2
            mine = here < at
            total += int((mine & (here >= from_)).sum()) if from_ else int(mine.sum())
            a, from_ = b, at

    def splice(self, text: str, here: np.ndarray, ahead: np.ndarray, lo: int, hi: int) -> int | None:
        """The first place in ``lo..hi`` where both have a boundary that is proven."""
        both = np.intersect1d(here[(here >= lo) & (here <= hi)], ahead[(ahead >= lo) & (ahead <= hi)])
        return next((int(p) for p in both if self.proven(text[p - 1], text[p])), None)


@functools.lru_cache(maxsize=2)
def counter(vocabulary: str) -> Counter:
    return Counter(vocabulary)


def _count(vocabulary: str, limit: int, chunk: int, overlap: int):
    def run(batches: Batches) -> Batches:
        c = counter(vocabulary)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                text = pc.fill_null(part.column("text"), "")
                values = text.to_pylist()
                short = [x for x in values if len(x) <= chunk]
                counts = iter([len(x) for x in c.sp.encode(short, num_threads=1)] if short else [])
                n = [next(counts) if len(x) <= chunk else c.count(x, chunk, overlap) for x in values]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pc.binary_length(text).cast(pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return run


def counted(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs``."""
    src = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    return map_arrow(src, _count(vocabulary, limit, chunk, overlap), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
