"""The tokenizers library's byte-level BPE, word by word with a store of bounded size.

A single space between two characters that are not white space always begins a piece of the
library's pre-tokenizer, so the text may be cut before it; a stretch that was encoded before costs a
lookup. Texts with a special token go to the library whole.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerline.llm.prefix_bpe import Store


#: A word of letters (ASCII, or U+00C0 to U+00FF but for the two signs there), then signs: one or two pieces.
SIMPLE = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")


class LibraryBPE:
    def __init__(self, path: str, store: int = 700_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.pre_tokenizer = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.cut = re.compile(r"(?<=\S) (?=\S)")
        self.store, self.pieces, self.signs = Store(store), Store(store // 4), Store(store // 20)
        self.letters = {}  # of each byte of two-byte letters, as the pre-tokenizer spells it
        for c in range(0xC0, 0x100):
            self.letters |= dict(zip(chr(c).encode(), self.pre_tokenizer.pre_tokenize_str(chr(c))[0][0]))
        self.space = self.pre_tokenizer.pre_tokenize_str(" a")[0][0][0]
        self.code = "H" if self.width == "<u2" else "I"

    def _packed(self, spelt: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        """Ids of a space and a word."""
        simple = SIMPLE.fullmatch(word)
        if not simple:
            return self._stretch(" " + word.decode("utf-8", "replace"))
        letters, signs = simple.groups()
        ids = self.pieces.young.get(letters) or self.pieces.get(letters)
        if ids is None:
            spelt = letters.decode() if letters.isascii() else letters.decode("latin-1").translate(self.letters)
            self.pieces.put(letters, ids := self._packed(self.space + spelt))
        if signs:
            after = self.signs.get(signs)
            if after is None:
                self.signs.put(signs, after := self._packed(signs.decode()))
            ids += after
        return ids

    def _stretch(self, text: str) -> bytes:
        return b"".join(self._packed(spelt) for spelt, _ in self.pre_tokenizer.pre_tokenize_str(text))

    def encode(self, text: bytes) -> bytes:
        """Ids of the text, little-endian, two bytes each where the vocabulary allows it."""
        if any(s in text for s in self.special):
            whole = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False)
            return np.array(whole.ids, dtype=self.width).tobytes()
        words = text.split(b" ")
        found = self._words(words)
        if found is None:  # white space of more than one character
            whole = text.decode("utf-8", "replace")
            found = self._words([s.encode() for s in self.cut.split(whole)], edges=True)
        return b"".join(found)

    def _words(self, words: list[bytes], edges: bool = False) -> list[bytes] | None:
        """Ids of words that had one space between them; None if white space is left at a border, unless *edges* allows it."""
        found = list(map(self.store.young.get, words))
        found[0], k = None, -1
        while True:
            try:
                k = found.index(None, k + 1)
            except ValueError:
                return found
            word = words[k]
            ids = self.store.get(word) if k else None
            if ids is None:
                text = word.decode("utf-8", "replace")
                plain = text and not text[0].isspace() and not text[-1].isspace()
                if not plain and not edges:
                    return None
                if not plain or not k:
                    ids = self._stretch(" " + text if k else text)
                else:
                    self.store.put(word, ids := self._word(word))
            found[k] = ids

    def count(self, text: bytes) -> int:
        return len(self.encode(text)) // int(self.width[-1])


@lru_cache(maxsize=2)
def library(name: str) -> LibraryBPE:
    """One encoder for each worker process; its store lives across tasks."""
    return LibraryBPE(public_tokenizers.path(name))
