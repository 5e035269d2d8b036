"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded once."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# Words that a task keeps encoded; a full table is emptied, which changes no id.
KEPT_WORDS = 500_000
# Characters that are encoded at once.
SLICE = 1 << 20
# Byte-level vocabularies show the bytes that have no visible Latin-1 character, in order, as
# the characters from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
SHOWN = np.arange(256, dtype="<u4")
SHOWN[_HIDDEN] = 256 + np.arange(len(_HIDDEN))
# What words are joined by for the model: its token merges with no other.
NUL = "\0"
APART = chr(SHOWN[0])
# Words that the model gets in one call.
TOGETHER = 128
# Marks that end a word: after a letter each is a piece of its own.
ENDINGS = ".,;:!?"
# A word of Latin letters (letters to the library as well, whatever its Unicode version), with a
# line's end before it or without, and a mark after it or none.
LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
SIMPLE = re.compile(f"(?<=\0)((?:\n)?([{LETTERS}]+))([{ENDINGS}]?)(?=\0)").findall


class TextEncoder:
    """Encodes like ``Tokenizer.encode(text, add_special_tokens=False)``.

    A byte-level vocabulary splits a text before every space, and around every line end, that
    stands between two other characters, so the words between them can be encoded alone.  A text
    with any other white space beside one of these, or with the name of an added token, goes to
    the library as it is.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A byte that is part of no other token keeps words apart.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        alone = APART in vocabulary and all(APART not in t for t in vocabulary if t != APART)
        self.apart = vocabulary[APART] if alone else None
        self.spaced = np.zeros(self.size, bool)
        self.spaced[[n for t, n in vocabulary.items() if t[0] == chr(SHOWN[32])]] = True
        # By word, with the space before it; a word that begins a line has the line end there.
        self.words: dict[str, bytes | bool] = {}
        self.marks = {mark: self._plain(mark) for mark in ENDINGS}
        self.line_end = self._plain("\n")

    def encode(self, text: str) -> np.ndarray:
        """The ids as unsigned 32-bit integers."""
        if any(name in text for name in self.added):
            return np.frombuffer(self._plain(text), np.uint32)
        return np.frombuffer(b"".join(map(self._slice, slices(text))), np.uint32)

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _slice(self, text: str) -> bytes:
        # A text that begins a line of its own has that line's end before it; it is cut off again.
        if not text or text[0] == " ":
            extra, words = 0, text.replace("\n", " \n").split(" ")[1:]
        else:
            extra, words = len(self.line_end), ("\n" + text.replace("\n", " \n")).split(" ")
        parts = list(map(self.words.get, words))
        missing = [k for k, part in enumerate(parts) if part is None]
        if missing:
            learned = self._learned({words[k] for k in missing})
            for k in missing:
                parts[k] = learned[words[k]]
            if len(self.words) + len(learned) > KEPT_WORDS:
                self.words.clear()
            self.words.update(learned)
        try:
            return b"".join(parts)[extra:]
        except TypeError:  # a word with white space at an end
            return self._plain(text)

    def _learned(self, words: set[str]) -> dict[str, bytes | bool]:
        """The ids of words and of what stands before them; False if white space touches an end."""
        found: dict[str, bytes | bool] = {}
        simple = SIMPLE(f"{NUL}{NUL.join(words)}{NUL}") if self.apart is not None else []
        bases = dict.fromkeys(base for base, _, _ in simple)
        new = [base for base in bases if base not in self.words]
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            found.update(zip(some, self._pieces(some), strict=True))
        for base, letters, mark in simple:
            if mark:
                found[base + mark] = (found.get(base) or self.words[base]) + self.marks[mark]
        others = []
        for word in words.difference(found):
            body = word[1:] if word[:1] == "\n" else word
            if word in bases:
                found[word] = self.words[word]
            elif not body or body[0].isspace() or body[-1].isspace():
                found[word] = False
            elif word[0] == "\n":
                found[word] = self.line_end + self._plain(body)
            else:
                others.append(word)
        found.update(zip(others, self._spaced(others), strict=True))
        return found

    def _spaced(self, words: list[str]) -> list[bytes]:
        """The ids of words of any kind, each with a space before it, from one call."""
        raw = self._plain("".join([" " + word for word in words]))
        edges = np.flatnonzero(self.spaced[np.frombuffer(raw, np.uint32)]) * 4
        if len(edges) != len(words):  # not a vocabulary in which only words begin with a space
            return [self._plain(" " + word) for word in words]
        return [raw[a:b] for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(raw)])]

    def _pieces(self, words: list[str]) -> list[bytes]:
        """The ids of words that are one piece each, from one call of the model."""
        spaced = NUL.join([word[1:] if word[0] == "\n" else " " + word for word in words])
        shown = SHOWN[np.frombuffer(spaced.encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array([token.id for token in self.model.tokenize(shown)], np.uint32)
        edges = np.flatnonzero(ids == self.apart) * 4
        raw = ids.tobytes()
        spans = map(slice, [0, *(edges + 4).tolist()], [*edges.tolist(), len(raw)])
        before = self.line_end
        return [before + raw[s] if word[0] == "\n" else raw[s] for word, s in zip(words, spans, strict=True)]


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """A long text cut before single spaces, where its encoding can be cut as well."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while cut > 0 and (text[cut - 1].isspace() or not text[cut + 1 : cut + 2].strip()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


@lru_cache(maxsize=4)
def encoder(path: str) -> TextEncoder:
    """One per Python worker and vocabulary file."""
    return TextEncoder(path)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)
