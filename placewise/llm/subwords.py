"""Subword ids of whole texts by a public byte-level BPE tokenizer file.

Such a tokenizer first cuts a text into pieces that never run over a space or line break which
follows a visible character, and encodes each piece by itself. So a text's ids are those of its
chunks (blanks and what follows them up to the next blank), and each distinct chunk needs the
tokenizer only once per Python worker. Texts with other white space are encoded in one go,
since there a blank may belong to the run before it. Tests compare with plain encoding.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

DEFAULT_FILE = "byte_bpe_50k.json"
CHUNKS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
ODD_SPACE = re.compile("[^\\S \n]|[\x1c-\x1f\x85]")
#: Remembered chunks per worker; a full memory starts anew, which costs time and changes nothing.
MEMORY = 1_000_000


def default_path() -> str:
    return public_tokenizers.path(DEFAULT_FILE)


class Encoder:
    """Encodes texts to arrays of ids, as wide as the vocabulary needs."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code).newbyteorder("<")
        self.memory: dict[str, bytes | None] = {}

    def plain(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in made]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.memory) > MEMORY:
            self.memory = {}
        cut = list(map(CHUNKS.findall, texts))
        new = [c for c in set(chain.from_iterable(cut)) if c not in self.memory]
        self.memory.update(zip(new, self.plain(new)))
        self.memory.update((c, None) for c in filter(ODD_SPACE.search, new))  # not to be joined
        known, made = self.memory.__getitem__, []
        for text, chunks in zip(texts, cut):
            try:
                made.append(b"".join(map(known, chunks)))
            except TypeError:
                made.append(self.plain([text])[0])
        return [np.frombuffer(x, dtype=self.dtype) for x in made]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, loaded once for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
