"""Encoding with a public tokenizer, words remembered per worker.

A tokenizer cuts a text into words before it merges bytes, and never merges
across a single space between two other characters. So a text is cut at such
spaces, each distinct word is encoded once per worker, and the ids are gathered
with numpy. The memory of words is bounded; when full it starts anew.
"""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np

SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
MOST_WORDS = 200_000
CHARACTERS = 1_000_000
AT_ONCE = 512  # words encoded in one call: an encoding holds far more than its ids
ARROW_ROWS = 500


class WordEncoder:
    """Gives the ids that the tokenizer gives for whole texts.

    ``lead`` is what a word after a space starts with: the space for byte-level
    vocabularies, nothing for those that drop white space. A text's first word
    is remembered apart, under a space and itself. ``plain`` takes the strings
    of special tokens in a text as ordinary text; else they get the special ids,
    as the library gives them. They hold no white space, so no cut parts them.
    """

    def __init__(self, path: str, lead: str, plain: bool = False):
        # Workers already run side by side; threads of each would only add memory and contention.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.lead = lead
        normalizer = self.tokenizer.normalizer
        self.normalize = normalizer.normalize_str if normalizer else str
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)), re.IGNORECASE) if special else None
        # In a byte-level vocabulary a character stands for a byte, but for the sign of a word's end.
        end = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, at in vocabulary.items():
            self.width[at] = len(token.removesuffix(end))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.loose = np.zeros(1 << 16, bool)  # cut at a space beside white space, which is no safe place
        self.ids, self.used = np.zeros(1 << 18, np.uint32), 0

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found: list[list[int]] = []
        for k in range(0, len(words), AT_ONCE):
            part = [w[1:] if w[:1] == " " else self.lead + w for w in words[k : k + AT_ONCE]]
            found += [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())), size

    def _in_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Words in one text, a space before each; the bytes that the ids stand for tell the words apart.

        None where the ids do not stand for just the bytes of the words.
        """
        text = " " + " ".join(words)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        shown = self.normalize(text).split(" ")[1:]
        if len(shown) != len(words):
            return None
        ends = np.cumsum(np.fromiter((len(w.encode()) for w in shown), np.int64, len(shown)) + len(self.lead))
        reached = np.cumsum(self.width[ids])
        last = np.minimum(np.searchsorted(reached, ends), len(reached) - 1)
        if reached[-1] != ends[-1] or not np.array_equal(reached[last], ends):
            return None
        return ids, np.diff(last + 1, prepend=0)

    def _learn(self, words: list[str]) -> None:
        plain, other = [], []
        for w in words:
            usual = w.isprintable() and w and " " not in w and not (self.special and self.special.search(w))
            (plain if usual else other).append(w)
        parts = []
        for k in range(0, len(plain), AT_ONCE):
            some = plain[k : k + AT_ONCE]
            parts.append(self._in_one(some) or self._one_by_one(some))
        if other:
            parts.append(self._one_by_one(other))
        words = plain + other
        size = np.concatenate([p[1] for p in parts])
        first, total = len(self.known), int(size.sum())
        while first + len(words) > len(self.start):
            self.start, self.size, self.loose = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.size, self.loose))
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + total] = np.concatenate([p[0] for p in parts])
        self.start[first : first + len(words)] = self.used + np.cumsum(size) - size
        self.size[first : first + len(words)] = size
        self.used += total
        for k, w in enumerate(other, first + len(plain)):
            bare = w[1:] if w[:1] == " " else w
            self.loose[k] = not bare or bare[0].isspace() or bare[-1].isspace()
        self.known.update(zip(words, range(first, first + len(words))))

    def _look_up(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            absent = [words[i] for i in missing]
            self._learn(list(dict.fromkeys(absent)))
            at[missing] = list(map(self.known.__getitem__, absent))
        return at

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the number of ids of each."""
        if len(self.known) > MOST_WORDS:
            self.forget()
        cuts = [text.split(" ") if text else [] for text in texts]
        at = self._look_up(self._words(cuts))
        counts = np.fromiter(map(len, cuts), np.int64, len(cuts))
        if self.loose[at].any():
            loose = np.concatenate([[0], np.cumsum(self.loose[at])])
            ends = np.cumsum(counts)
            for i in np.flatnonzero(loose[ends] > loose[ends - counts]):
                cuts[i] = SAFE_SPACE.split(texts[i])
            counts = np.fromiter(map(len, cuts), np.int64, len(cuts))
            at = self._look_up(self._words(cuts))
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.start[at] - (ends - size), size) + np.arange(total)]
        edges = np.concatenate([[0], np.cumsum(counts)])
        run = np.concatenate([[0], ends])
        return ids, run[edges[1:]] - run[edges[:-1]]

    @staticmethod
    def _words(cuts: list[list[str]]) -> list[str]:
        words: list[str] = []
        for cut in cuts:
            if cut:
                words.append(" " + cut[0])
                words += cut[1:]
        return words


_ENCODERS: dict[tuple[str, str, bool], WordEncoder] = {}


def encoder(path: str, lead: str, plain: bool = False) -> WordEncoder:
    """One encoder per worker process, tokenizer and treatment of special tokens."""
    if (path, lead, plain) not in _ENCODERS:
        _ENCODERS[path, lead, plain] = WordEncoder(path, lead, plain)
    return _ENCODERS[path, lead, plain]


def groups(texts: list[str | None]):
    """Slices of a batch of about ``CHARACTERS`` characters; a longer text stands alone."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > first and held + n > CHARACTERS:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(texts):
        yield first, len(texts)
