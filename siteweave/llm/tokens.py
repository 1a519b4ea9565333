"""Word-level encoding with a public tokenizer file: the library encodes each distinct word once per worker.

The tokenizer's normalizer and pre-tokenizer never look across white space, so a text's ids are those of its
white-space-separated pieces in order. Pieces repeat, the library call is what costs, so pieces are cached. A
piece of plain Latin letters with closing ASCII marks is, to the pre-tokenizer, its lower-case word and its marks,
each whole; these go straight to the library's BPE model and are cached apart. All other pieces take the whole
tokenizer. Caches are emptied at a fixed number of entries.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: White space as the tokenizer's pattern has it; str.split() would also cut at the four separators below.
SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
ODD = re.compile("[\x1c-\x1f]")
PLAIN = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
CACHE_ENTRIES = 500_000


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 characters stand for their bytes, the other bytes follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


BYTE_LETTERS = _byte_letters()

_loaded: dict[tuple[str, bool], "WordEncoder"] = {}


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Words(dict):
    """Lower-case Latin word, or run of marks -> ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, model):
        self.tokenize = model.tokenize

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        letters = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = self[word] = b"".join([t.id.to_bytes(4, "little") for t in self.tokenize(letters)])
        return ids


class _Pieces(dict):
    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, _Words(tokenizer.model)

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        if plain := PLAIN.fullmatch(piece):
            word, marks = plain.groups()
            ids = self.words[word.lower()]
            if marks:
                ids += self.words[marks]
        else:
            ids = np.asarray(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()
        self[piece] = ids
        return ids


class WordEncoder:
    """encode(text) -> ids as little-endian unsigned 32-bit bytes, equal to the library's ids of the whole text.

    As the library does by default, a special token's string in a text gives that token; with ``special_as_text`` it is
    ordinary text, so that no document can write a special token.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = special_as_text
        self._pieces = _Pieces(tokenizer)

    def encode(self, text: str) -> bytes:
        pieces = text.split() if not ODD.search(text) else [p for p in SPACES.split(text) if p]
        return b"".join(map(self._pieces.__getitem__, pieces))


def word_encoder(path: str, special_as_text: bool = False) -> WordEncoder:
    """One encoder per Python worker, file and reading of special tokens."""
    if (path, special_as_text) not in _loaded:
        _loaded[path, special_as_text] = WordEncoder(path, special_as_text)
    return _loaded[path, special_as_text]


def vocabulary_size(path: str) -> int:
    """One more than the largest id of the tokenizer, special tokens included."""
    from tokenizers import Tokenizer

    return 1 + max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())
