"""Encoding of many whole texts with a public tokenizer, each distinct word once per worker."""

from __future__ import annotations

import re
from array import array

import numpy as np

# Text between blanks is encoded on its own: no pre-token of the supported byte-level tokenizers
# runs from a non-blank into a blank. Texts with any other white space are encoded as they are.
_CHUNK = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_OTHER_SPACE = re.compile(r"[^\S \t\n\r]")
#: The same for bytes of Latin-1, where a deletion is far cheaper than a search.
_OTHER_LATIN = bytes(i for i in range(256) if _OTHER_SPACE.match(chr(i)))
# A blank, Latin letters, then punctuation without an apostrophe: at most three pre-tokens.
_PLAIN = re.compile(r"([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿŒœ]+)([!-&(-/:-@\[-`{-~]*)")
# Such punctuation after such a letter and before one, a blank or the end: pre-tokens of its own.
_MARKS = re.compile(r"[!-&(-/:-@\[-`{-~](?<=[A-Za-zÀ-ÖØ-öø-ÿŒœ].)[!-&(-/:-@\[-`{-~]*+(?![^ \t\n\rA-Za-zÀ-ÖØ-öø-ÿŒœ])")
_KEPT: dict[str, Encoder] = {}


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(rest)}


class _Words(dict):
    """Word -> id bytes, filled on demand; words in use come over from the table before."""

    def __init__(self, owner: Encoder, before: dict[str, bytes]):
        super().__init__()
        self.owner, self.before = owner, before

    def __missing__(self, word: str) -> bytes:
        out = self.before.get(word)
        if out is None:
            out = self.owner.one(word)
        self[word] = out
        return out


def _latin(text: str) -> bytes | None:
    """The text in Latin-1, None where it has other characters."""
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


class Encoder:
    """Ids of texts as little-endian bytes, `width` bytes an id."""

    def __init__(self, path: str, entries: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: A text that holds one of these is encoded as it is: the library cuts them out first.
        self.literals = [x.content for x in added]
        self.rewritten = self.tokenizer.normalizer is not None and any(x.normalized for x in added)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.kind = np.dtype(f"<u{self.width}")
        self.entries = entries
        self.words = _Words(self, {})
        self.letters = _byte_letters()
        self.lower = self._ids("A") == self._ids("a")
        blanks = [" ", "\t", "\n", "\r", "\r\n", " \n \t"]
        #: Blanks only part words: they have no ids and change none.
        self.drops = all(not self._ids(b) and self._ids(f"{b}a{b}b.{b}") == self._ids("a") + self._ids("b.") for b in blanks)
        self.plain = True
        probes = ["the", " The", "Éé", " éa", "\nWord,", " x-|", "ABCdef", " straße).", "œuvre", " Øre!!"]
        self.plain = all(self.one(x) == self.pack(self._ids(x)) for x in probes)
        self.words.clear()

    def pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pretoken(self, text: str) -> bytes:
        if not text.isascii() or " " in text:
            text = text.encode().decode("latin-1").translate(self.letters)
        return self.pack([x.id for x in self.model.tokenize(text)])

    def one(self, word: str) -> bytes:
        """A word between blanks; plain ones go straight to the tokenizer's merge model."""
        m = _PLAIN.fullmatch(word) if self.plain else None
        if m is None:
            return self.pack(self._ids(word))
        blank, letters, marks = m.groups()
        if self.lower:
            letters = letters.lower()
        if marks:
            return self.words[blank + letters] + self.words[marks]
        if self.drops or not blank:
            return self._pretoken(letters) if letters == word else self.words[letters]
        return self._pretoken(" " + letters) if blank == " " else self.words[blank] + self.words[letters]

    def _whole(self, text: str, latin: bytes | None) -> bool:
        """Whether words between blanks can't be encoded one by one."""
        other = _OTHER_SPACE.search(text) if latin is None else len(latin.translate(None, _OTHER_LATIN)) < len(latin)
        return bool(other) or self.rewritten or any(x in text for x in self.literals)

    def _parts(self, text: str, latin: bytes | None) -> list[str]:
        """What is encoded on its own. Where blanks only part words, these come without them, and in
        lower case and without their punctuation where that changes no id, so that few differ."""
        if not self.drops:
            return _CHUNK.findall(text)
        if self.lower and latin is not None:
            text = text.lower()
        return (_MARKS.sub(r" \g<0> ", text) if self.plain else text).split()

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for x in texts:
            if 2 * len(self.words) > self.entries:
                self.words.before = {}
                self.words = _Words(self, self.words)
            latin = _latin(x)
            if self._whole(x, latin):
                out.append(self.pack(self._ids(x)))
            else:
                out.append(b"".join(map(self.words.__getitem__, self._parts(x, latin))))
        return out


def encoder(path: str, entries: int = 1_000_000) -> Encoder:
    """The worker's encoder for this file, which remembers about `entries` words; kept between tasks."""
    if path not in _KEPT:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _KEPT[path] = Encoder(path)
    _KEPT[path].entries = entries
    return _KEPT[path]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
