"""Token ids by the tokenizers library, word by word.

Where a tokenizer drops white space and merges within words only, the ids of a text are the ids of its
words in turn. Each worker encodes a new word once and remembers it. Words of plain lower-case letters, which
normalizer and pre-tokenizer leave whole, go straight to the library's merging model; so do those in capitals of
Latin-1 that they make lower-case. Marks after such letters are a word of their own. Other new words go through all
steps of the library.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from struct import pack

from tokenizers import Tokenizer

#: Words a worker remembers unless told otherwise: this many lately met ones, and as many from before, some
#: 200 MB in all. Fewer take less memory and more time. Longer words than LONGEST bytes are not remembered.
REMEMBERED = 600_000
LONGEST = 64
#: Letters of a normal form of one letter, lower-case or made so alone.
_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
_PLAIN = re.compile(f"[{_LETTERS}]+")
#: ASCII marks but the apostrophe, which may go with the letters after it.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_MARKED = re.compile(f"([{_LETTERS}]+)([{re.escape(_MARKS)}]+)")
#: A mark that ends a word, where it stands between a letter or digit and white space.
_END_MARK = re.compile(rb"[.,](?=[ \n])(?:(?<=[A-Za-z0-9][.,])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][.,]))")


def _lowers(spec: dict | None) -> bool:
    return bool(spec) and (spec.get("type") == "Lowercase" or any(map(_lowers, spec.get("normalizers", ()))))


class _Words(dict):
    """Ids by word. Looking up a word that is not there encodes it."""

    def __init__(self, tokenizer: Tokenizer, before: dict[bytes, bytes]) -> None:
        super().__init__()
        self._tokenizer = tokenizer
        self._model = tokenizer.model
        self._letters = _own_letters(tokenizer)
        self._marks = bool(self._letters) and _marks_apart(tokenizer)
        self.before = before

    def __missing__(self, word: bytes) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self._encode(word.decode())
        if len(word) <= LONGEST:
            self[word] = ids
        return ids

    def _encode(self, text: str) -> bytes:
        if self._letters and _PLAIN.fullmatch(text):
            ids = [t.id for t in self._model.tokenize(text if text.isascii() else text.translate(self._letters))]
        elif self._marks and (parts := _MARKED.fullmatch(text)):
            return self[parts[1].encode()] + self[parts[2].encode()]
        else:
            [found] = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = found.ids
        return pack(f"<{len(ids)}I", *ids)


def _own_letters(tokenizer: Tokenizer) -> dict[int, str] | None:
    """What the model sees for each plain letter, if a word of them reaches it whole and a-z as they are."""
    normalizer, splitter = tokenizer.normalizer, tokenizer.pre_tokenizer

    def seen(text: str) -> list[str]:
        text = normalizer.normalize_str(text) if normalizer else text
        return [part for part, _ in splitter.pre_tokenize_str(text)] if splitter else [text]

    table = {ord(c): "".join(seen(c)) for c in _LETTERS}
    whole = all(seen(w) == [w.translate(table)] for w in (_LETTERS, _LETTERS[::-1], *(c + "re" for c in _LETTERS)))
    return table if whole and all(table[ord(c)] == c for c in _LETTERS if c.isascii()) else None


def _marks_apart(tokenizer: Tokenizer) -> bool:
    """Whether letters and the marks after them are encoded apart: the pre-tokenizer cuts there, and no added token joins them."""
    splitter = tokenizer.pre_tokenizer
    joined = re.compile(f"[{_LETTERS}]*[{re.escape(_MARKS)}]*")
    if splitter is None or any(joined.fullmatch(t.content) for t in tokenizer.get_added_tokens_decoder().values()):
        return False

    def seen(text: str) -> list[str]:
        text = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
        return [part for part, _ in splitter.pre_tokenize_str(text)]

    return all(seen(a + m + n) == seen(a) + seen(m + n) for a in ("re", *_LETTERS) for m in _MARKS for n in ("", m, "."))


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, equal to `Tokenizer.encode(text).ids`.

    Holds for tokenizers that never join characters across ASCII white space (0x09-0x0D, 0x20) and give
    it no ids, as with a normalizer of NFC and lower case and a split by a pattern without white space.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._remembered = remembered
        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._lowers = _lowers(spec["normalizer"])
        self._added = [t["content"].lower().encode() for t in spec["added_tokens"]]

        def ids(text: str) -> list[int]:
            return self._tokenizer.encode(text, add_special_tokens=False).ids

        # An end mark is a word of its own, if it never merges with what stands before it.
        self._cuts = all(ids(a + m) == ids(a) + ids(m) for a in ("a", "the", "Z", "7", "é", "É") for m in ".,")
        self._known = _Words(self._tokenizer, {})

    def _words(self, text: str) -> list[bytes]:
        """Its words; in lower case if that changes nothing, as special tokens are found before lowering."""
        raw = text.encode()
        if self._lowers:
            low = raw.lower()
            if not any(t in low for t in self._added):
                raw = low
        return (_END_MARK.sub(rb" \g<0>", raw) if self._cuts else raw).split()

    def encode(self, text: str) -> bytes:
        ids = b"".join(map(self._known.__getitem__, self._words(text)))
        if len(self._known) > self._remembered:
            self._known.before = {}
            self._known = _Words(self._tokenizer, dict(self._known))
        return ids


@lru_cache(maxsize=2)
def word_encoder(path: str, remembered: int = REMEMBERED) -> WordEncoder:
    return WordEncoder(path, remembered)
