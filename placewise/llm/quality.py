"""Quality rules by compression bands.

A text is compressed with zstandard, once whole and once in fixed chunks of ``CHUNK`` bytes.
Repetitive text compresses too well, noise hardly at all; how well prose compresses depends
on its length, since a longer text repeats more of its own vocabulary. So each length class
has its own band of accepted ratios (compressed bytes over bytes).

A document is kept when its base rules pass, its whole ratio lies in the band of its length,
and less than ``CHUNK_SHARE`` of its chunks lie outside the chunk band.

Defined results: a null text is the empty text, has no words and fails the base rule of 20
words; equal rows get equal verdicts; the columns of the input travel in one struct, so none
of them can clash; an empty table gives an empty table. Texts are judged whole.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.llm.blocks import SPACES, as_bytes, bounds, over_blocks, totals, whole_text

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30

LEVEL = 3
CHUNK = 2048
#: From this many bytes on: the lowest and the highest accepted ratio. Shorter texts are not judged.
BANDS = ((128, 0.40, 1.10), (256, 0.40, 0.95), (512, 0.36, 0.85), (1024, 0.33, 0.75),
         (2048, 0.28, 0.70), (16384, 0.24, 0.68))
#: The band of a chunk; a last chunk of under half the size counts to none.
CHUNK_BAND = (0.30, 0.75)
CHUNK_SHARE = 0.25

FIELDS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, ratio double, "
          "n_chunks bigint, n_bad_chunks bigint")


def repeated_words(words: list[bytes], offsets: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per document: words inside a window of words that its text has at least twice."""
    n = len(words)
    if n < window:
        return np.zeros(len(offsets) - 1, dtype=np.int64)
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.uint64, count=n)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = np.flatnonzero(doc[: n - window + 1] == doc[window - 1:])
    mixed = np.zeros(len(starts), dtype=np.uint64)
    factors = np.random.default_rng(8).integers(1, 2**63, window + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for k in range(window):
        mixed += ids[starts + k] * factors[k]
    mixed += doc[starts].astype(np.uint64) * factors[window]
    order = np.argsort(mixed, kind="stable")
    twin = np.flatnonzero(mixed[order][1:] == mixed[order][:-1])
    left, right = starts[order[twin]], starts[order[twin + 1]]
    same = doc[left] == doc[right]
    for k in range(window):  # the hash proposes, the words decide
        same &= ids[left + k] == ids[right + k]
    marks = np.zeros(n + 1, dtype=np.int64)
    found = np.unique(np.concatenate([left[same], right[same]]))
    np.add.at(marks, found, 1)
    np.add.at(marks, found + window, -1)
    return totals(np.cumsum(marks[:-1]) > 0, offsets)


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def compression(data: bytes, pack: zstandard.ZstdCompressor) -> tuple[float | None, int, int]:
    """Whole ratio (None for an empty text), number of full chunks, chunks outside their band."""
    if not data:
        return None, 0, 0
    ratio = len(pack.compress(data)) / len(data)
    n = bad = 0
    for at in range(0, len(data) - CHUNK // 2 + 1, CHUNK):
        piece = data[at:at + CHUNK]
        share = len(pack.compress(piece)) / len(piece)
        n, bad = n + 1, bad + (not CHUNK_BAND[0] <= share <= CHUNK_BAND[1])
    return ratio, n, bad


def in_band(size: int, ratio: float | None) -> bool:
    band = next(((low, high) for least, low, high in reversed(BANDS) if size >= least), None)
    return band is None or band[0] <= ratio <= band[1]


def measure(block: dict[str, pa.Array]) -> list:
    data = as_bytes(block["text"])
    split = [x.split() for x in data]
    n_words = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    words = [w for own in split for w in own]
    repeat = repeated_words(words, bounds(n_words, len(split)))
    base_failed = (n_words < MIN_WORDS) | (100 * repeat > REPEAT_PERCENT * n_words)
    pack = zstandard.ZstdCompressor(level=LEVEL)
    chars, symbols, lines, kept, ratios, chunks, bad_chunks = [], [], [], [], [], [], []
    for raw, failed in zip(data, base_failed):
        text = raw.decode()
        chars.append(len(text) - sum(map(text.count, SPACES)))
        symbols.append(sum(map(text.count, SYMBOLS)))
        lines.append(duplicate_lines(text))
        ratio, n, bad = compression(raw, pack)
        ratios.append(ratio)
        chunks.append(n)
        bad_chunks.append(bad)
        kept.append(not failed and in_band(len(raw), ratio) and bad <= CHUNK_SHARE * n)
    return [n_words, chars, symbols, lines, repeat, base_failed, kept,
            pa.array(ratios, pa.float64()), chunks, bad_chunks]


def judge(docs: DataFrame, text: str | Column = "text", row: list[str] | None = None) -> DataFrame:
    """Column ``row`` (the document) and the measures and verdict of ``FIELDS``. No shuffle."""
    return over_blocks(docs, {"text": whole_text(text)}, measure, FIELDS, row)


def keep_good(docs: DataFrame, text: str | Column = "text") -> DataFrame:
    """The documents that are kept, with their own columns."""
    return judge(docs, text).where("kept").select("row.*")
