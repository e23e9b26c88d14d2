"""Token ids of texts with a public tokenizer file.

The tokenizer breaks a text at white space before anything else, and then into pieces: runs of letters, single digits,
runs of other signs. A text's ids are the ids of its pieces, one after the other. Where a text has only characters whose
normal form and lower case are plain to see (printable ASCII, letters of Latin-1 and Latin Extended-A), one regular
expression finds the pieces of its words; other words go through the tokenizer whole. Words and pieces repeat, so their
ids are kept, and only a word that is not known is broken into pieces; the memory for both is bounded. A worker outlives
its task, so a task that ends should :meth:`~WordEncoder.forget` them.
"""

from __future__ import annotations

import re
from functools import cache

#: Letters beyond ASCII that are one code point in every normal form and have one lower-case letter. The capital dotted
#: I has two.
_LETTERS = "À-ÖØ-öø-įı-ſ"
_SPACE = r" \t\n\r\x0b\x0c"
_PLAIN = re.compile(f"[!-~{_SPACE}{_LETTERS}]*")
#: Pieces of a lower-case word of plain characters, as the tokenizer's own pattern finds them there. Fixed value.
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^{_SPACE}a-z0-9{_LETTERS}]+")
_WORDS = re.compile(f"[^{_SPACE}]+")
_ADDED = "<|"
KEPT_PIECES = 600_000
#: Longer pieces are encoded but not kept.
_LONG = 64


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: itself if it can be printed, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Ids(dict):
    """Ids of lower-case words of plain characters and of their pieces, found when first asked for."""

    def __init__(self, model) -> None:
        super().__init__()
        self._model = model
        self._letters = _byte_letters()

    def __missing__(self, word: str) -> bytes:
        pieces = _PIECES.findall(word)
        if len(pieces) > 1:
            ids = b"".join([self[piece] for piece in pieces])
        else:
            letters = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self._letters)
            ids = b"".join([t.id.to_bytes(4, "little") for t in self._model.tokenize(letters)])
        if len(word) <= _LONG:
            self[word] = ids
        return ids


class WordEncoder:
    """Ids as bytes: little-endian unsigned 32-bit integers, one after the other."""

    def __init__(self, path: str, kept: int = KEPT_PIECES) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._kept = kept
        self._ids = _Ids(self._tokenizer.model)
        self._others: dict[str, bytes] = {}

    def forget(self) -> None:
        """Free the words and pieces kept; they are found again when needed."""
        self._ids.clear()
        self._others.clear()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self._ids.__getitem__, text.lower().split()))

    def _other(self, word: str) -> bytes:
        ids = self._others.get(word)
        if ids is None:
            encoded = self._tokenizer.encode(word, add_special_tokens=False)
            ids = b"".join([i.to_bytes(4, "little") for i in encoded.ids])
            if len(word) <= _LONG:
                self._others[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Ids of a text in UTF-8."""
        if len(self._ids) > self._kept:
            self._ids.clear()
        if len(self._others) > self._kept // 4:
            self._others.clear()
        letters = text.decode("utf-8")
        if _ADDED not in letters and _PLAIN.fullmatch(letters):
            return self._plain(letters)
        parts, plain = [], []
        for word in _WORDS.findall(letters):
            if _ADDED not in word and _PLAIN.fullmatch(word):
                plain.append(word)
                continue
            parts += [self._plain(" ".join(plain)), self._other(word)]
            plain = []
        parts.append(self._plain(" ".join(plain)))
        return b"".join(parts)


@cache
def encoder(path: str) -> WordEncoder:
    """One per Python worker and tokenizer file."""
    return WordEncoder(path)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
