"""Exact token ids of whole texts with the tokenizers library, at the speed of a dictionary.

For the lower-casing word tokenizer (NFC, white space to one blank, lower case, split by a pattern whose
matches hold no white space, byte-level pieces, BPE) a text's ids are those of its words one after another,
so every distinct word is encoded once and remembered. Words of printable Latin-1 letters need no
normaliser but lower case; their pattern pieces go straight to the library's BPE model, whose results are
remembered too. Anything else, and every other tokenizer, goes through the library as it is.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from gridlake.llm.shared import remembered

REMEMBER = 500_000     # words, and pieces, that a worker remembers before it starts anew

# The normaliser and pre-tokenizer for which the words of a text can be encoded one by one.
_BY_WORDS = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                   {"type": "Lowercase"}],
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder(dict):
    """Word -> its ids as bytes, filled as words come up."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        largest = max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        self.dtype = np.dtype("<u2") if largest < 1 << 16 else np.dtype("<u4")
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_words = (
            (spec.get("normalizer") or {}).get("normalizers") == _BY_WORDS["normalizer"]
            and split.get("pattern") == {"Regex": _BY_WORDS["pattern"]} and split.get("invert") is True
            and spec["model"]["type"] == "BPE")
        self.specials = tuple(t["content"] for t in spec.get("added_tokens", []))
        self._special = regex.compile("|".join(map(regex.escape, self.specials)) or "(?!)")
        self._pattern = regex.compile(_BY_WORDS["pattern"])
        self._tokenize = self.tokenizer.model.tokenize
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._letters = _byte_letters()
        self._pieces: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self._pieces.get(piece)
        if ids is None:
            letters = piece if piece.isascii() else "".join(map(self._letters.__getitem__, piece.encode()))
            got = self._tokenize(letters)
            ids = struct.pack(f"<{len(got)}{self._code}", *[t.id for t in got])
            self._pieces[piece] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        if word.isprintable() and _latin(word) and not self._special.search(word):
            low = word.lower()
            # What the pattern finds in most words: letters, with one sign or digit behind at most.
            if low.isalpha():
                ids = self._piece(low)
            elif (letters := low[:-1]).isalpha():
                ids = self._piece(letters) + self._piece(low[-1])
            else:
                ids = b"".join(map(self._piece, self._pattern.findall(low)))
        else:
            ids = self._library(word)
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The text's ids, little-endian, ``dtype.itemsize`` bytes each."""
        if not self.by_words:
            return self._library(text)
        if len(self) > REMEMBER:
            self.clear()
        if len(self._pieces) > REMEMBER:
            self._pieces.clear()
        if _latin(text):
            text = text.lower()                         # stays Latin-1, and is what the normaliser would do
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_encoders: dict[str, Encoder] = {}
remembered.append(_encoders)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; it lives until the worker turns to other work."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(texts: pa.Array, path: str, end_id: int) -> Iterator[np.ndarray]:
    """Each text's ids with the end id; a null text is empty."""
    enc = encoder(path)
    end = np.array([end_id], enc.dtype).tobytes()
    for text in texts:
        yield np.frombuffer(enc.encode(text.as_py() or "") + end, enc.dtype)
