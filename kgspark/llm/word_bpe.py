"""Fast, exact use of a ``tokenizers`` file whose words encode on their own.

Files whose normaliser and pre-tokeniser only change or cut text at white space or
inside words (the lower-casing word-end BPE) allow it: the ids of a text are those
of its white-space separated words, one after the other.  Ids of words met before come
from a cache; the others are encoded by the library, plain ones by its model
alone.  Any other file, and texts with separators that Python and the file disagree
on, go to the library whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np

from .common import sole_cache
from .piece_bpe import KEEP, LONG_PART, older_half

#: What a file must hold for its words to be separable (fixed values of that format).
_NORMALIZERS = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Words of these letters, digits and signs need no normaliser but lower case; their parts are the split's, and the byte-level alphabet is a plain mapping.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\\[-`{-~]+")
_PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\\[-`{-~]+")


def _byte_level() -> dict[int, str]:
    """How the byte-level alphabet writes the letters above ASCII: printable bytes as themselves, the others from 256 on."""
    itself = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in itself]
    sign = {b: chr(b) if b in itself else chr(256 + others.index(b)) for b in range(256)}
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


def _separable(spec: dict) -> bool:
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    norms = [(x["type"], (x.get("pattern") or {}).get("Regex")) for x in norm.get("normalizers", [])]
    pres = pre.get("pretokenizers", [])
    return (
        norms == _NORMALIZERS
        and len(pres) == 2
        and pres[0].get("pattern") == {"Regex": _SPLIT}
        and pres[0].get("invert") is True
        and pres[1]["type"] == "ByteLevel"
        and not pres[1].get("add_prefix_space")
    )


def _odd(text: str) -> bool:
    """Whether a text holds a separator that Python cuts at and the file doesn't."""
    return "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text


class _Known(dict):
    """Ids of short words met before, at most ``limit`` of them; others are learnt when looked up."""

    def __init__(self, learn: Callable[[str], bytes], limit: int):
        super().__init__()
        self.learn, self.limit = learn, limit

    def __missing__(self, word: str) -> bytes:
        return self.keep(word, self.learn(word))

    def keep(self, word: str, ids: bytes) -> bytes:
        if len(word) <= LONG_PART:
            if len(self) >= self.limit:
                older = older_half(self)
                self.clear()
                self.update(older)
            self[word] = ids
        return ids


class WordEncoder:
    """ids of whole texts as little-endian uint32 bytes, as ``encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str, keep: int = 2 * KEEP):
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # special tokens are found before anything else; those told apart by "<|" can't be in a plain word
        self.separable = _separable(spec) and all(x["content"].startswith("<|") and not x.get("lstrip") and not x.get("rstrip") for x in spec.get("added_tokens", []))
        self.known = _Known(self._learn, keep)
        self.bytes, self.model = _byte_level(), self.tokenizer.model

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        """The ids of one part in lower case; a part is a word of its own, so one cache serves both."""
        done = self.known.get(part)
        if done is None:
            signs = part if part.isascii() else part.translate(self.bytes)
            done = self.known.keep(part, array("I", [t.id for t in self.model.tokenize(signs)]).tobytes())
        return done

    def _learn(self, word: str) -> bytes:
        """The ids of a word met for the first time."""
        if word.isascii() and word.isalpha():
            return self._part(word.lower())
        if _PLAIN.fullmatch(word) and "<|" not in word:
            low = word.lower()
            return self._part(low) if low.isalpha() else b"".join([self._part(p) for p in _PARTS.findall(low)])
        return self._library(word)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of many whole texts (null: none)."""
        if not self.separable:
            return [np.array(x.ids, dtype="<u4").tobytes() for x in self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        ids = self.known.__getitem__
        return [b"" if not t else self._library(t) if _odd(t) else b"".join(map(ids, t.split())) for t in texts]


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, keep: int = 2 * KEEP) -> WordEncoder:
    """The encoder of a path that keeps so many words, until its Python worker ends or runs another operator."""
    sole_cache("word ids", _ENCODERS.clear)
    if (path, keep) not in _ENCODERS:
        _ENCODERS[path, keep] = WordEncoder(path, keep)
    return _ENCODERS[path, keep]
