"""Token ids of whole texts by a public BPE vocabulary, cached by word."""

from __future__ import annotations

import os
import re
from array import array
from unicodedata import is_normalized

from .common import kept_in_worker

CACHE_WORDS = 300_000  # in each of two generations
_PUNCTUATION = b".,!?;:|"
_PLAIN = re.compile(rb"[!-&(-~]+")  # printable ASCII but the apostrophe, which starts contractions
_PIECES = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")


def _byte_signs() -> list[str]:
    """The printable sign that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs, free = [""] * 256, 256
    for b in range(256):
        if b in plain:
            signs[b] = chr(b)
        else:
            signs[b], free = chr(free), free + 1
    return signs


_SIGNS = _byte_signs()


def _letters(word: str) -> str:
    """The lower-cased word if it is letters only, composed, before and after lower-casing; else empty."""
    if word.isalpha() and is_normalized("NFC", word):
        if word.islower():
            return word
        lower = "".join(map(str.lower, word))
        if lower.isalpha():
            return lower
    return ""


class WordIds(dict):
    """White-space separated chunk (ASCII lower-cased bytes) -> its ids as little-endian uint32 bytes.

    The vocabulary's pre-tokenizer never crosses white space and splits runs of
    letters, single digits and runs of other signs, so a text's ids are those
    of its chunks in order, and a chunk's are those of its runs. Chunks whose
    runs are plain to see (letters, or printable ASCII without contractions) go
    straight to the merges; all others through the whole tokenizer. At the size
    limit the cache starts afresh, which costs time only.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.old: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self._ids(chunk)
        if len(chunk) <= 64:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def _ids(self, chunk: bytes) -> bytes:
        if len(chunk) > 512:
            return self.encode(chunk.decode())
        if chunk.isalpha():  # ASCII letters
            return self._merged(chunk)
        if _PLAIN.fullmatch(chunk):
            runs = _PIECES.findall(chunk)
            return self._merged(chunk) if len(runs) == 1 else b"".join([self[r] for r in runs])
        word = chunk.decode()
        lower = _letters(word)
        if lower:
            return self._merged(lower.encode())
        if chunk[-1] in _PUNCTUATION and _letters(word[:-1]):
            return self[chunk[:-1]] + self[chunk[-1:]]
        return self.encode(word)

    def _merged(self, run: bytes) -> bytes:
        """Ids of one run of the pre-tokenizer."""
        signs = run.decode() if run.isalpha() else "".join([_SIGNS[b] for b in run])  # letters stand for themselves
        return array("I", [t.id for t in self.merges.tokenize(signs)]).tobytes()

    def encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def text_ids(self, text: bytes | None) -> bytes:
        """The ids of a whole text, four bytes each."""
        if not text:
            return b""
        lower = text.lower()
        if b"<|" in lower:  # may hold a special token, which is matched on the raw text
            return self.encode(text.decode())
        return b"".join([self[c] for c in lower.split()])


def word_ids(path: str) -> WordIds:
    """The cache of this worker process."""
    return kept_in_worker(("word ids", path), lambda: WordIds(path))


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
