"""Subword ids of whole texts, through a public tokenizer and a bounded store of known words.

The tokenizers read here never merge across white space, so a text's ids are
those of its white-space-separated parts in order; each distinct part is
tokenized once while the store lasts.
"""

from __future__ import annotations

import base64
import os
from array import array

import numpy as np

# Distinct words that a task's process keeps ids for; the store starts anew beyond.
# Ranks are quick to apply and keep fewer.
KEPT_WORDS, KEPT_WORDS_OF_RANKS = 800_000, 200_000

# Words of letters that are tokenized at once.
TOGETHER = 4096

# Marks that form a part of their own between an ASCII letter and the end of a word.
_MARKS = b".,!?;:$%&#*"


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def default_vocabulary() -> str:
    return vocabulary()


class Subwords:
    """Turns words into ids, kept as little-endian bytes of ``dtype``.

    A ``.tiktoken`` file is a list of ranks, of which a word is read with a blank
    before it; any other file is a tokenizer of its own.
    """

    def __init__(self, path: str):
        if path.endswith(".tiktoken"):
            import tiktoken
            from public_tokenizers import PATTERN

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.size = max(ranks.values()) + 1
            self.kept = KEPT_WORDS_OF_RANKS
            self._encode = lambda texts: [coder.encode_ordinary(f" {t}") for t in texts]
            self._ends = None
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            self.size = tokenizer.get_vocab_size()
            self.kept = KEPT_WORDS
            self._encode = lambda texts: [
                x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ]
            # Ids that end a word; none where the vocabulary does not mark them.
            self._ends = np.zeros(max(tokenizer.get_vocab().values()) + 1, dtype=bool)
            self._ends[[k for t, k in tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.dtype, self._code = np.dtype("<u2" if self.size <= 1 << 16 else "<u4"), "H"
        if self.dtype.itemsize == 4:
            self._code = "I"
        self.clear()

    def clear(self) -> None:
        """Forget all words."""
        # Each word's number; by number, where its ids begin among all ids, and how many they are.
        self.known: dict[bytes, int] = {}
        self._first, self._count, self._ids = array("q"), array("q"), array(self._code)

    def _keep(self, words: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        """Give the store words with their ids, one word's after the other's."""
        begin = len(self._first)
        self.known.update(zip(words, range(begin, begin + len(words))))
        ends = len(self._ids) + np.cumsum(counts)
        self._first.frombytes((ends - counts).astype(np.int64).tobytes())
        self._count.frombytes(counts.astype(np.int64).tobytes())
        self._ids.frombytes(ids.astype(self.dtype).tobytes())

    def _tokenize(self, words: list[bytes]) -> None:
        """Words that are one part each, through the tokenizer.

        Those of letters alone go many at a time: each is one word to the tokenizer, and
        its last id says that it ends there.  Should the ends not be as many as the
        words, they go one by one, as all others do.
        """
        apart, together = [], []
        for word in words:
            text = word.decode("utf-8", "replace")
            (together if self._ends is not None and text.isalpha() else apart).append((word, text))
        for k in range(0, len(together), TOGETHER):
            part = together[k : k + TOGETHER]
            ids = np.array(self._encode([" ".join([t for _, t in part])])[0], dtype=np.int64)
            ends = np.flatnonzero(self._ends[ids])
            if len(ends) == len(part):
                self._keep([w for w, _ in part], ids, np.diff(ends, prepend=-1))
            else:
                apart += part
        found = self._encode([t for _, t in apart])
        counts = np.array([len(x) for x in found], dtype=np.int64)
        ids = np.array([i for x in found for i in x], dtype=np.int64)
        self._keep([w for w, _ in apart], ids, counts)

    def _learn(self, words: set[bytes]) -> None:
        """Give the store ``words``, which it does not have.

        Words are lowered by the tokenizer, and marks after a letter are a part of
        their own to it; so most words are put together from parts known already.
        A special token's string must stay as it is.
        """
        # Lower-case letters alone are parts as they are.
        plain = {w for w in words if w.isalpha() and w.islower()}
        made, parts = [], plain.copy()
        for word in words - plain:
            low = word.lower()
            if b"<|" in low:
                low = word
            stem = low.rstrip(_MARKS)
            if len(stem) < len(low) and stem and 97 <= stem[-1] <= 122:
                made.append((word, stem, low[len(stem) :]))
            else:
                parts.add(low)
                if low != word:
                    made.append((word, low, None))
        parts.update([m[1] for m in made])
        parts.update([m[2] for m in made if m[2]])
        self._tokenize(list(parts.difference(self.known)))
        # A stem or a mark that is itself a word met here is kept already.
        made = [m for m in made if m[0] not in self.known]
        sizes = [2 if m[2] else 1 for m in made]
        numbers = [self.known[part] for m in made for part in m[1:] if part]
        if made:
            ids, counts = self.ids_of(np.array(numbers, dtype=np.int64))
            sizes = np.array(sizes, dtype=np.int64)
            counts = np.add.reduceat(counts, np.cumsum(sizes) - sizes)
            self._keep([word for word, _, _ in made], ids, counts)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The store's number of each word, new ones included; good until the next call."""
        if len(self.known) > self.kept:
            self.clear()
        found = list(map(self.known.get, words))
        missing = {w for w, k in zip(words, found) if k is None}
        if missing:
            self._learn(missing)
            found = list(map(self.known.__getitem__, words))
        return np.array(found, dtype=np.int64)

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words by their numbers, one after the other, and how many each has."""
        # What is taken out are copies; a view that lasted would keep the arrays from growing.
        first, count = (np.frombuffer(x, np.int64)[numbers] for x in (self._first, self._count))
        ends = np.cumsum(count)
        place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - count), count)
        return np.frombuffer(self._ids, self.dtype)[place], count


def forget() -> None:
    """Give back the memory of the stores, for tasks that need no more ids."""
    for coder in _open.values():
        coder.clear()


_open: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    """One tokenizer and store for each process and file."""
    if path not in _open:
        _open[path] = Subwords(path)
    return _open[path]
