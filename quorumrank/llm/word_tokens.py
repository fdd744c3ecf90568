"""Tokenisation by a ``tokenizers`` file that drops white space, remembering pieces of words."""

from __future__ import annotations

import functools
import os
import re
import struct

#: Pieces of one generation of a Python worker's memory; two generations are held.
CACHE_PIECES, CACHE_CHARS = 250_000, 40

# Characters whose handling is the same for all: ASCII without the rarer controls, and the Latin-1 letters.
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
#: English endings, runs of letters, single digits, and runs of anything else that isn't white space.
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")
#: One such piece of a plain lower-cased text.
_ONE = re.compile(f"[{_LETTERS}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[!-/:-@[-`{{-~]+")
#: How byte-level models write the bytes of what isn't ASCII: those without a visible Latin-1 character from 256 on.
_UNSEEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_WRITTEN = {c: "".join(chr(256 + _UNSEEN.index(b) if b in _UNSEEN else b) for b in chr(c).encode()) for c in range(128, 256)}


class Memory(dict):
    """A dict that makes missing values and forgets those not used for a generation."""

    def __init__(self, make, most: int = CACHE_PIECES) -> None:
        self._make, self._most, self._old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(key) <= CACHE_CHARS:
            if len(self) >= self._most:
                self._old = dict(self)
                self.clear()
            self[key] = value
        return value


class WordTokens:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    Only for tokenizers that ignore case, drop white space and merge inside the pieces above alone (checked on a
    probe): then a text's ids are those of its pieces, and each piece is tokenized once. Texts with other characters
    than ASCII and Latin-1 letters are tokenized line by line and word by word.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._model = self._tokenizer.model
        self._pieces = Memory(self._by_model if self._model_agrees() else self._ids)
        probe = "Ab's  c12\n\nd. ÉtÉ*** e_ x'T don't, ''s *'s I'LL'd ß--1st"
        if self._text(probe) != self._ids(probe):
            raise ValueError("this tokenizer keeps white space or merges across pieces")

    def _ids(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids if text else ()
        return struct.pack(f"<{len(ids)}I", *ids)

    def _by_model(self, piece: str) -> bytes:
        """The ids of one piece, without the tokenizer's own normalising and dividing where the piece needs neither."""
        if not _ONE.fullmatch(piece):
            return self._ids(piece)
        ids = [t.id for t in self._model.tokenize(piece if piece.isascii() else piece.translate(_WRITTEN))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _model_agrees(self) -> bool:
        if any(_ONE.fullmatch(s) or s in "'re've'll" for s in self._special):
            return False  # the model alone knows no special tokens; none of these may lie inside a piece
        plain = [c for c in map(chr, range(33, 256)) if _PLAIN.fullmatch(c) and c == c.lower()]
        probes = plain + [f"{a}{b}" for a in plain for b in ("a", "é", ".", a) if _ONE.fullmatch(f"{a}{b}")]
        probes += ["'s", "'re", "information", "überprüfung", "élèves", "niño", "...", "!?", "=-=-", "q" * 300]
        try:
            return all(self._by_model(x) == self._ids(x) for x in probes)
        except Exception:  # models without bytes may refuse a piece
            return False

    def _text(self, text: str) -> bytes:
        look = self._pieces.__getitem__
        if _PLAIN.fullmatch(text) and not any(s in text for s in self._special):
            return b"".join(map(look, _PIECES.findall(text.lower())))
        return b"".join(map(look, text.replace("\n", " ").split(" ")))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self._text(t or "") for t in texts]


@functools.cache
def word_tokens(path: str) -> WordTokens:
    """One memory for all tasks of a Python worker."""
    return WordTokens(path)
