"""Token ids of whole texts by a tokenizer whose words do not depend on their neighbours.

Each distinct word of a task is encoded once. Blanks must carry no meaning for the tokenizer: it
drops white space, so ids(text) are the ids of its words, one after another.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from lakemart.llm.common import LOWER

# Signs that end a word of letters are a word of their own for the tokenizer.
TAIL = re.compile(rb"(?<=[a-z])([!-/:-@\[-`{-~]+)(?![^\x20\x09-\x0D])")
SPECIAL = b"<|"  # begins the names of special ids; texts that have it are taken as they are
CACHED_WORDS = 400_000
WORD_END = "</w>"
# Below this character no letter is changed by composition, and case is simple.
AFTER_LATIN = "\u0250"


class Numbered(dict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        return self.setdefault(word, len(self))


class WordEncoder:
    """Encodes texts as arrays of ids; remembers up to CACHED_WORDS words at a time.

    Lower-case words of Latin letters are what normalizing leaves as it is, so they skip that step.
    """

    def __init__(self, tokenizer_json: str):
        # A task has one core; threads of the library would only hold memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.plain = Tokenizer.from_str(tokenizer_json)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.clear()

    def clear(self) -> None:
        self.index = Numbered()
        self.flat = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def learn(self, words: list[bytes]) -> None:
        """Encode words that follow those encoded before."""
        lowered = [w.decode().lower() for w in words]
        is_plain = np.array([t.isalpha() and max(t) < AFTER_LATIN for t in lowered], bool)
        texts = [t for t, p in zip(lowered, is_plain, strict=True) if p]
        # Words of letters are encoded many at a time; the last piece of each has the end mark.
        lines = [" ".join(texts[i : i + 200]) for i in range(0, len(texts), 200)]
        encoded = self.plain.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter((i for x in encoded for i in x.ids), np.uint32)
        bounds = np.flatnonzero(self.ends[ids]) + 1
        if len(bounds) != len(texts):
            raise ValueError("the tokenizer does not mark the ends of words")
        encoded = self.tokenizer.encode_batch_fast(
            [w.decode() for w, p in zip(words, is_plain, strict=True) if not p],
            add_special_tokens=False,
        )
        rest = [x.ids for x in encoded]
        ids = np.concatenate((ids, np.fromiter((i for x in rest for i in x), np.uint32)))
        size = np.empty(len(words), np.int64)
        size[is_plain] = np.diff(bounds, prepend=0)
        size[~is_plain] = np.fromiter(map(len, rest), np.int64, len(rest))
        start = np.empty(len(words), np.int64)
        order = np.argsort(~is_plain, kind="stable")
        start[order] = np.cumsum(size[order]) - size[order]
        self.start = np.concatenate((self.start, len(self.flat) + start))
        self.size = np.concatenate((self.size, size))
        self.flat = np.concatenate((self.flat, ids))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text."""
        split = [
            (x if SPECIAL in x else TAIL.sub(rb" \1", x.translate(LOWER))).split() for x in texts
        ]
        if len(self.index) > CACHED_WORDS:
            self.clear()
        number = self.index.__getitem__
        words = np.fromiter(map(number, chain.from_iterable(split)), np.int64)
        if self.index.new:
            self.learn(self.index.new)
            self.index.new = []
        size = self.size[words]
        ends = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.start[words] - ends[:-1], size)]
        counts = np.cumsum([0, *map(len, split)])
        return ids, np.diff(ends[counts])


class SharedEncoder:
    """Sent to the workers by broadcast: a worker process builds one encoder and keeps it for all
    its tasks."""

    def __init__(self, tokenizer_json: str):
        self.tokenizer_json = tokenizer_json
        self.built: WordEncoder | None = None

    def __getstate__(self) -> dict:
        return {"tokenizer_json": self.tokenizer_json, "built": None}

    def get(self) -> WordEncoder:
        if self.built is None:
            self.built = WordEncoder(self.tokenizer_json)
        return self.built
