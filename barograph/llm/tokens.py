"""Ids of a byte-level subword vocabulary, looked up by word.

The vocabulary splits a text into pre-tokens and then merges within each one, so the ids of a
pre-token never depend on its neighbours. A space that a visible character follows always starts a pre-token, whatever
is before it, so a text falls into words at such spaces, and the ids of a word are remembered. A new word with
only characters whose class Python's ``re`` and the vocabulary's pattern agree on is split here, and each distinct
pre-token is merged once; any other word goes through the tokenizer. Texts with a space before white space or a
character that might be such, or at their end, are split as a whole.
"""

from __future__ import annotations

import re

import numpy as np

#: Letters below U+0250 without ª º (kept out for safety) and the characters around them.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = re.compile(f"[\t\n\r -~{LETTERS}]*")
#: The vocabulary's split pattern, for such texts (fixed by the vocabulary).
SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\\s{LETTERS}0-9]+|\\s+(?!\\S)|\\s+"
)
#: What surely is no white space.
VISIBLE = re.compile(f"[!-~{LETTERS}]")
#: One pre-token behind a space, or one and a mark.
SIMPLE = re.compile(f"([{LETTERS}]+)([.,:;!?]?)")
MARKS = frozenset(".,:;!?")
REMEMBERED = 300_000
#: Words, whose long tail is most of the work, are remembered in larger numbers: about 150 MB in a worker.
WORDS = 1_000_000
#: Longer words, and words across lines, hardly come again: they are not remembered.
LONGEST = 64


def _symbols() -> dict[int, str]:
    """The character that stands for a byte in a byte-level vocabulary: itself if visible, else the next from U+0100."""
    seen = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    unseen = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(unseen)}


SYMBOLS = _symbols()
SPACE = SYMBOLS[0x20]


def symbols_of(part: str) -> str:
    return part.encode().decode("latin-1").translate(SYMBOLS)


class _Whole(Exception):
    """The text cannot be taken word by word."""


class Tokens(dict):
    """uint32 little-endian ids by pre-token; ``of`` gives those of a text."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: A character that all special tokens share: a text without it has none of them.
        self.sign = min(set.intersection(*map(set, self.special)), default=None) if self.special else None
        self.words = _Words(self)

    def holds_special(self, text: str) -> bool:
        return (self.sign is None or self.sign in text) and any(s in text for s in self.special)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[part] = self.merged(symbols_of(part))
        return ids

    def merged(self, symbols: str) -> bytes:
        found = self.model.tokenize(symbols)
        if len(found) == 1:
            return self.bytes_of[found[0].id]
        return b"".join([self.bytes_of[t.id] for t in found])

    def split(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and not self.holds_special(text):
            return b"".join(map(self.__getitem__, SPLIT.findall(text)))
        return self.whole(text)

    def behind_space(self, word: str) -> bytes | None:
        """Ids of a space and ``word``, not remembered; None where they depend on what is around it."""
        if simple := SIMPLE.fullmatch(word):
            stem, mark = simple.groups()
            ids = self.merged(symbols_of(" " + stem))
            return ids + self[mark] if mark else ids
        if not VISIBLE.match(word) or self.holds_special(word):
            return None
        return self.split(" " + word)

    def of(self, text: str) -> bytes:
        first, *words = text.split(" ")
        if self.holds_special(first):
            return self.whole(text)
        try:
            rest = b"".join(map(self.words.__getitem__, words))
        except _Whole:
            return self.split(text)
        return self.split(first) + rest


class _Words(dict):
    """Ids of a space and the word behind it, by word."""

    def __init__(self, tokens: Tokens):
        super().__init__()
        self.tokens = tokens

    def __missing__(self, word: str) -> bytes:
        if word.isascii():  # the simple words among these, without the pattern
            if word.isalpha():
                ids = self.tokens.merged(SPACE + word)
                if len(word) <= LONGEST:
                    self.remember(word, ids)
                return ids
            if word[-1:] in MARKS and (stem := word[:-1]).isalpha():
                ids = self[stem] + self.tokens[word[-1]]
                if len(word) <= LONGEST:
                    self.remember(word, ids)
                return ids
        elif simple := SIMPLE.fullmatch(word):
            stem, mark = simple.groups()
            ids = self[stem] + self.tokens[mark] if mark else self.tokens.merged(symbols_of(" " + word))
            if len(word) <= LONGEST:
                self.remember(word, ids)
            return ids
        if not VISIBLE.match(word) or self.tokens.holds_special(word):
            raise _Whole
        ids = self.tokens.split(" " + word)
        if len(word) <= LONGEST and "\n" not in word:
            self.remember(word, ids)
        return ids

    def remember(self, word: str, ids: bytes) -> None:
        if len(self) >= WORDS:
            self.clear()
        self[word] = ids
