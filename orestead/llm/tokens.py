"""Token ids of many texts by a word-level cache over a public tokenizer file."""

from __future__ import annotations

from array import array

import numpy as np

#: Words whose ids a worker keeps; then the cache starts anew.
CACHE_WORDS = 500_000
_TAIL = frozenset(".,;:!?")


class CachedTokenizer:
    """Ids equal to Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids.

    For tokenizers whose pre-tokens never hold white space and end where words end: a text's ids are then those of its
    words. Words are cut at space and line feed alone; whatever else is in a word goes through the whole tokenizer.
    Only a word of Latin-1 letters (lower-cased, one pre-token, its own NFC) goes to the model directly, and one
    punctuation mark after a letter at a word's end is a pre-token of its own.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.pool, self.first, self.size = array("I"), array("q", [0]), array("q", [0])

    def _ids(self, word: str) -> list[int]:
        if word.isalpha() and word == word.lower():
            if word.isascii():
                return [t.id for t in self.tokenizer.model.tokenize(word)]
            if _latin(word):
                return [t.id for t in self.tokenizer.model.tokenize(self.bytes.pre_tokenize_str(word)[0][0])]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _add(self, word: str) -> None:
        if word in self.index:
            return
        if len(word) > 1 and word[-1] in _TAIL and word[-2].isalpha() and _latin(word):
            core, tail = word[:-1], word[-1]
            self._add(core)
            self._add(tail)
            ids = self._known(core) + self._known(tail)
        else:
            ids = self._ids(word)
        self.index[word] = len(self.first)
        self.first.append(len(self.pool))
        self.size.append(len(ids))
        self.pool.extend(ids)

    def _known(self, word: str) -> list[int]:
        at = self.index[word]
        return self.pool[self.first[at] : self.first[at] + self.size[at]].tolist()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        if len(self.index) > CACHE_WORDS:
            self.clear()
        words: list[list[str]] = []
        for text in texts:
            if _latin(text):
                text = text.lower()
            words.append(text.replace("\n", " ").split(" "))
        known = self.index
        for ws in words:
            for w in ws:
                if w not in known:
                    self._add(w)
        at = [np.array([known[w] for w in ws], dtype=np.int64) for ws in words]
        pool, first, size = np.frombuffer(self.pool, dtype=np.uint32) if self.pool else np.zeros(0, np.uint32), np.frombuffer(self.first, dtype=np.int64), np.frombuffer(self.size, dtype=np.int64)
        out = []
        for ws in at:
            n = size[ws]
            end = np.cumsum(n)
            out.append(pool[np.repeat(first[ws] - (end - n), n) + np.arange(end[-1] if len(end) else 0)])
        return out


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True
