"""Token counts of whole texts by a public word-level BPE file, with a whole-token shortcut.

The tokenizer lowers a text, cuts it into pre-tokens and merges each one by itself. Before the
job, ``prove`` finds by the library itself (a) which vocabulary strings alone give exactly one
token and (b) for which characters case, composition and the pre-token class are settled without
context. A pre-token of such characters that is one of these strings counts one token without
any merging; only the rest is merged, each distinct one once for each Python worker.

Texts are cut at ASCII white space, which the tokenizer drops and over which neither a
pre-token nor a composed character nor a special string runs, so a text's count is the sum of
its chunks' counts. A chunk with other characters or a special string goes to the library whole.

The proof is as large as the vocabulary and travels as a broadcast; the texts are not shuffled.

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings inside texts
count as the library's default takes them; equal rows get equal counts; a very long text is
a block of its own; an empty table gives an empty table; input columns travel in one struct.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from placewise.llm.blocks import as_bytes, over_blocks, whole_text

DEFAULT_FILE = "word_bpe_49k.json"
LIMIT = 2048
WORD_END = "</w>"
#: Characters that are put to the proof: Latin letters, digits, marks and punctuation.
ALPHABET = "".join(chr(c) for c in range(0x21, 0x250) if not unicodedata.category(chr(c)).startswith(("C", "Z")))
#: The contractions that the tokenizer's pattern cuts off.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Remembered chunks per worker; a full memory starts anew, which costs time and changes nothing.
MEMORY = 400_000
#: Pre-tokens that are merged in one call.
RUN = 500
#: One token, and in the upper bits one that the shortcut counted.
DIRECT = 1 + (1 << 40)


def default_path() -> str:
    return public_tokenizers.path(DEFAULT_FILE)


def byte_characters() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself,
    the other bytes follow from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


@lru_cache(maxsize=4)
def library(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@dataclass(frozen=True)
class Proof:
    whole: frozenset[str]       # lowered strings that alone are one token
    lower: dict[int, str]       # of the settled characters
    letters: str
    numbers: str
    others: str
    special: tuple[str, ...]
    closes: np.ndarray          # whether an id ends a pre-token


def prove(path: str) -> Proof:
    """What the library shows about its vocabulary strings and the characters of ``ALPHABET``."""
    tokenizer, of_byte = library(path), byte_characters()
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    ids, texts = [], []
    for piece, number in content["model"]["vocab"].items():
        if piece.endswith(WORD_END):
            try:
                texts.append(bytes(of_byte[c] for c in piece[:-len(WORD_END)]).decode())
                ids.append(number)
            except (KeyError, UnicodeDecodeError):  # a part of a character is no pre-token
                continue
    made = tokenizer.encode_batch(texts, add_special_tokens=False)
    whole = frozenset(t for t, i, e in zip(texts, ids, made) if e.ids == [i])
    normal, cut = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
    lower, kinds = {}, {"letters": "", "numbers": "", "others": ""}
    for c in ALPHABET:
        low = normal(c)
        if len(low) != 1 or normal("e" + c) != "e" + low or normal(c + "e") != low + "e":
            continue
        pieces = [len(cut(x)) for x in ("a" + low, low + "a", "#" + low, low + low)]
        kind = {(1, 1, 2, 1): "letters", (2, 2, 2, 2): "numbers", (2, 2, 1, 1): "others"}.get(tuple(pieces))
        if kind:
            lower[ord(c)] = low
            if low not in kinds[kind]:
                kinds[kind] += low
    closes = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
    closes[[number for piece, number in content["model"]["vocab"].items() if piece.endswith(WORD_END)]] = True
    return Proof(whole, lower, **kinds, closes=closes, special=tuple(x["content"] for x in content.get("added_tokens", [])))


class Counter:
    """Counts tokens of texts by a proof, and how many of them the shortcut counted."""

    def __init__(self, proof: Proof, path: str):
        self.proof, self.tokenizer = proof, library(path)
        known = re.escape("".join(map(chr, proof.lower)))
        self.settled = re.compile(f"[{known}]+").fullmatch
        parts = [*map(re.escape, CONTRACTIONS), *(f"[{re.escape(x)}]{many}" for x, many in
                                                  ((proof.letters, "+"), (proof.numbers, ""), (proof.others, "+")) if x)]
        self.pieces = re.compile("|".join(parts)).findall
        self.special = re.compile("|".join(map(re.escape, proof.special)) or r"\Z.").search
        self.memory: dict[bytes, int] = {}
        self.merged: dict[str, int] = {}

    def _library(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merge(self, pieces: list[str]) -> list[int]:
        """Tokens of each pre-token. Many go to the library as one text, in which a token of a word's end closes each."""
        runs = [pieces[a:a + RUN] for a in range(0, len(pieces), RUN)]
        out = []
        for run, made in zip(runs, self.tokenizer.encode_batch_fast([" ".join(r) for r in runs], add_special_tokens=False)):
            ends = np.flatnonzero(self.proof.closes[np.array(made.ids, dtype=np.int64)])
            out += np.diff(ends, prepend=-1).tolist() if len(ends) == len(run) else self._library(run)
        return out

    def _learn(self, chunks: set[bytes]) -> None:
        whole, merged, cut, odd = self.proof.whole, self.merged, {}, []
        for chunk in chunks:
            text = chunk.decode()
            if self.settled(text) and not self.special(text):
                cut[chunk] = self.pieces(text.translate(self.proof.lower))
            else:
                odd.append(chunk)
        rest = list({p for pieces in cut.values() for p in pieces if p not in whole and p not in merged})
        merged.update(zip(rest, self._merge(rest)))
        for chunk, pieces in cut.items():
            self.memory[chunk] = sum([DIRECT if p in whole else merged[p] for p in pieces])
        self.memory.update(zip(odd, self._library([c.decode() for c in odd])))

    def count(self, texts: list[bytes]) -> tuple[list[int], list[int]]:
        """Tokens of each text, and those that needed no merging."""
        if len(self.memory) > MEMORY:
            self.memory, self.merged = {}, {}
        cut = [x.split() for x in texts]  # at the six ASCII space characters
        self._learn({c for chunks in cut for c in chunks if c not in self.memory})
        known = self.memory.__getitem__
        found = [divmod(sum(map(known, chunks)), 1 << 40) for chunks in cut]
        return [n for _, n in found], [direct for direct, _ in found]


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, text: str | Column = "text", row: list[str] | None = None,
                 tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Column ``row`` (the document), n_bytes, n_tokens, n_direct (tokens the shortcut counted), over_limit."""
    path = tokenizer or default_path()
    shared = docs.sparkSession.sparkContext.broadcast(prove(path))  # as large as the vocabulary

    def step(columns: dict[str, pa.Array]) -> list:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(shared.value, path)
        texts = as_bytes(columns["text"])
        totals, direct = _COUNTERS[path].count(texts)
        return [pa.array(list(map(len, texts)), pa.int64()), pa.array(totals, pa.int64()), pa.array(direct, pa.int64())]

    counted = over_blocks(docs, {"text": whole_text(text)}, step, "n_bytes bigint, n_tokens bigint, n_direct bigint", row,
                          limit=1 << 20)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
