"""Token counts of whole texts by overlap resynchronisation.

A text above ``chunk_chars`` is not given to the tokenizer in one piece.  It is
encoded in overlapping chunks with character offsets, and neighbouring chunks
are spliced at a boundary that both have and that is proven stable:

* A cut between characters ``x`` and ``y`` is *closed* if no piece of the
  vocabulary holds ``x`` directly followed by ``y``.  Byte-pair merges only
  build pieces of the vocabulary, so none can cross a closed cut, in the whole
  text or in any chunk: tokens on either side do not depend on the other side.
* A chunk's tokens are therefore those of the whole text between its first and
  its last closed cut.  Chunks ``[a, b)`` and ``[b - overlap, c)`` are spliced
  at the last closed cut of the overlap at which both start a token.
* If the overlap has no such boundary (one endless word, a long run of spaces)
  it is doubled, at last back to the previous splice, from where the open part
  is encoded again together with the next chunk: the count is always the
  library's own for the whole text.

The dummy space that the library puts before a chunk can only change tokens
before the chunk's first closed cut, and those are never kept.

Null text counts as empty (0 bytes, 0 tokens).  Rows are handled one by one, so
repeated rows come back repeatedly; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts

CHUNK_CHARS = 1 << 14
OVERLAP_CHARS = 128
LIMIT = 4096


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> "Tokenizer":
    """One tokenizer a Python worker; the file is on every executor."""
    return Tokenizer(path)


class Tokenizer:
    """Counts tokens of the installed library for one vocabulary file."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode: Callable[[list[str]], list[int]] = (
                lambda rows: [len(x) for x in processor.encode(rows, num_threads=1)])
            self.starts: Callable[[str], np.ndarray] = lambda x: _in_characters(
                x, [p.begin for p in processor.encode(x, return_type="proto").pieces])
            self.inner: set[str] | None = _pairs_inside(processor)
        else:
            from tokenizers import Tokenizer as Hub

            hub = Hub.from_file(path)
            hub.no_truncation()
            hub.no_padding()
            self.encode = lambda rows: [len(x.ids) for x in hub.encode_batch(rows, add_special_tokens=False)]
            # Pre-tokenizers of .json files look ahead over white space and may
            # normalise; no cut is proven there, so such texts stay whole.
            self.inner = None

    def closed(self, x: str, y: str) -> bool:
        """No token can hold ``x`` directly followed by ``y``."""
        return self.inner is not None and (x + y).replace(" ", "▁") not in self.inner

    def counts(self, rows: list[str], chunk: int, overlap: int) -> list[int]:
        out: list[int | None] = [None] * len(rows)
        short = [i for i, x in enumerate(rows) if len(x) <= chunk or self.inner is None]
        for i, n in zip(short, self.encode([rows[i] for i in short])):
            out[i] = n
        return [self._spliced(x, chunk, overlap) if n is None else n for x, n in zip(rows, out)]

    def _spliced(self, text: str, chunk: int, overlap: int) -> int:
        """Tokens of ``text`` from overlapping chunks.

        ``left`` are the token starts (offsets in the text) of what is spliced
        so far minus what is already counted; a splice keeps the left chunk's
        tokens before the common boundary and the right chunk's from it on."""
        total, begin = 0, 0
        end = min(len(text), chunk)
        left = self.starts(text[:end])
        while end < len(text):
            wide, to = overlap, min(len(text), end + chunk)
            while True:
                # From the last splice one character earlier: it takes up the dummy space.
                low = end - wide if end - wide > begin else max(0, begin - 1)
                right = low + self.starts(text[low:to])
                k = self._common(text, left, right, max(low, begin), end)
                if k is None and low <= begin:
                    k = begin  # the open part and the next chunk are now one chunk
                if k is not None:
                    break
                wide *= 2
            total += int(np.count_nonzero(left < k))
            left, begin, end = right[right >= k], k, to
        return total + len(left)

    def _common(self, text: str, left: np.ndarray, right: np.ndarray, low: int, end: int) -> int | None:
        """The last closed cut in (low, end) at which both chunks start a token."""
        for k in np.intersect1d(left[left > low], right[right < end])[::-1].tolist():
            if self.closed(text[k - 1], text[k]):
                return k
        return None


def _in_characters(text: str, begins: list[int]) -> np.ndarray:
    """Byte offsets of ``text`` as character offsets."""
    raw = np.frombuffer(text.encode(), np.uint8)
    before = np.cumsum((raw & 0xC0) != 0x80)
    at = np.array(begins, np.int64)
    return np.where(at < len(raw), before[np.minimum(at, len(raw) - 1)] - 1, len(text))


def _pairs_inside(processor) -> set[str]:
    """Every two neighbouring characters inside a piece of the vocabulary."""
    out: set[str] = set()
    for i in range(processor.get_piece_size()):
        if not processor.is_byte(i) and not processor.is_control(i):
            piece = processor.id_to_piece(i)
            out.update(piece[k : k + 2] for k in range(len(piece) - 1))
    return out


def token_counts(docs: DataFrame, model_path: str, key: str = "doc_id", limit: int = LIMIT,
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row; no shuffle."""

    def count(part: dict) -> dict:
        tok = tokenizer(model_path)
        raw = [x or b"" for x in part["text"]]
        n = tok.counts([x.decode("utf-8", "replace") for x in raw], chunk_chars, overlap_chars)
        return {key: part[key], "n_bytes": [len(x) for x in raw], "n_tokens": n, "over_limit": [x > limit for x in n]}

    return map_batches(texts(docs, key), count,
                       f"`{key}` long, n_bytes long, n_tokens long, over_limit boolean").select(
        F.col(key), "n_bytes", "n_tokens", "over_limit")
