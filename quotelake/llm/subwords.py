"""Subword ids of whole texts, word by word.

The vocabulary file drops white space and lower-cases, so the ids of a text are the ids of its
words one after another. Words repeat; each is encoded once per cache.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from quotelake.llm.common import LOWER

#: Words kept at most; the cache is emptied when full.
CACHE_WORDS = 1_500_000

#: Letters whose lower case is one letter and which do not compose with others, then ASCII marks.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~]*)")

#: What ``str.split`` takes for white space and ``bytes.split`` does not.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_MARKUP = b"<|"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(other)}


class WordEncoder:
    """Little-endian unsigned 32-bit ids of words and texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.letters = _byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _encoded(self, text: str) -> bytes:
        ids = self.full.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        """A whole pre-token of letters goes to the model at once; all else takes the full way."""
        text = word.decode("utf-8")
        plain = _PLAIN.fullmatch(text)
        if not plain:
            return self._encoded(text)
        head, tail = plain.groups()
        if tail:
            if tail not in self.marks:
                self.marks[tail] = self._encoded(tail)
            own = head.encode("utf-8")
            ids = self.words.get(own)
            if ids is None:
                ids = self.words[own] = self._letters(head)
            return ids + self.marks[tail]
        return self._letters(head)

    def _letters(self, head: str) -> bytes:
        if not head.isascii():
            head = head.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(head)]).tobytes()

    def add(self, words: list[bytes]) -> None:
        """Make sure that the cache holds these words."""
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        known = self.words
        for word in set(words):
            if word not in known:
                known[word] = self._word(word)

    def ids(self, text: str) -> bytes:
        """Ids of the text, as the tokenizer itself gives them."""
        raw = text.encode("utf-8")
        if _MARKUP in raw:
            return self._encoded(text)
        words = raw.translate(LOWER).split()
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            self.add(words)
            return b"".join(map(self.words.__getitem__, words))


class ByteWords:
    """Ids of lower-cased words by a byte-level vocabulary, each word with a blank before it."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.coder = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.size = max(ranks.values()) + 1
        self.begins_word = np.zeros(self.size, dtype=bool)
        self.begins_word[[i for token, i in ranks.items() if token[:1] == b" "]] = True

    def ids(self, words: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in turn, each followed by a blank, and how many each word has."""
        text = words[:-1].decode("utf-8")
        if _ODD_SPACE.search(text):
            plain = text.split(" ")
            if any(len(w.split()) != 1 for w in plain if not w.isascii()):
                # white space beyond ASCII inside a word: words one by one
                parts = [self.coder.encode_ordinary(" " + w) for w in plain]
                return np.array([i for p in parts for i in p], dtype=np.int64), np.array([len(p) for p in parts], np.int64)
        found = np.array(self.coder.encode_ordinary(" " + text) if text else [], dtype=np.int64)
        first = np.flatnonzero(self.begins_word[found])
        return found, np.diff(np.append(first, len(found)))
