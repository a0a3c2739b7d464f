"""Token ids of whole texts by a tokenizer file, with the ids of words kept between texts."""

from __future__ import annotations

import functools
import itertools
import os
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Ends that a word may be parted from: punctuation that always is a token run of its own after a letter. Apostrophes may belong
#: to a contraction, and the bracket of a special token to that.
ENDS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


def all_letters(word: str) -> bool:
    """One run of letters, in lower case too (a capital I with a dot becomes a letter and a mark)."""
    return word.isalpha() and (word.isascii() or word.lower().isalpha())


def can_lower(text: str) -> bool:
    """Whether Python's lower case is the library's: a sigma may differ, a special token is told by its case."""
    return text.isascii() and "<|" not in text or not any(x in text for x in ("<|", "Σ", "İ"))


def strings(column: pa.Array) -> list[str]:
    """``to_pylist`` without a scalar object for each value."""
    return column.to_numpy(zero_copy_only=False).tolist()


def bounds_of(lengths: Sequence[int] | np.ndarray) -> np.ndarray:
    """Where runs of these lengths begin and end, one after another."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])


def runs(ids: np.ndarray, bounds: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` between ``bounds`` that ``take`` numbers, one after another, and the bounds of those."""
    lengths = np.diff(bounds)[take]
    made = bounds_of(lengths)
    return ids[np.arange(made[-1]) + np.repeat(bounds[take] - made[:-1], lengths)], made


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, the same as the library gives for the whole text.

    A tokenizer that drops white space cannot join what a space or line feed parts, so words are encoded once and
    looked up afterwards; a tokenizer for which that does not hold encodes whole texts. Arrow parts texts and tells distinct words, so
    Python meets a word once per call. Two generations of at most ``limit``
    words are kept: words that are not used while a generation fills are forgotten.
    """

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.limit = limit
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        ids = lambda t: self.library.encode(t, add_special_tokens=False).ids
        probe = ["ab", "cd.", ",x", "12", "é"]
        self.by_word = ids(" \n".join(probe) + " ") == [i for p in probe for i in ids(p)] and all(ids("a" + x) == ids("a") + ids(x) for x in [*ENDS, ENDS])
        self.lower = self.by_word and ids("ABC ÉDe") == ids("abc éde")
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        self.ends = None  # is this id the last of a word?
        if suffix:
            vocabulary = self.library.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True

    def _library(self, texts: Sequence[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Plain words go as one text and are told apart by their last ids, others one by one."""
        plain = [w for w in words if all_letters(w)] if self.ends is not None else []
        found: dict[str, bytes] = {}
        for at in range(0, len(plain), 20_000):
            part = plain[at:at + 20_000]
            ids = np.array(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) == len(part):
                raw = ids.astype("<u4").tobytes()
                found.update(zip(part, (raw[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)), strict=True))
        rest = [w for w in words if w not in found]
        if rest:
            found.update(zip(rest, self._library(rest), strict=True))
        return found

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        if not self.by_word:
            return self._library(texts)
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        lowered = [(t.lower() if self.lower and can_lower(t) else t).replace("\n", " ") for t in texts]
        split = pc.split_pattern(pa.array(lowered, pa.large_string()), " ")
        words = split.values.dictionary_encode()
        ids, bounds = self._distinct(words.dictionary)
        ids, bounds = runs(ids, bounds, words.indices.to_numpy())
        stops = (bounds[split.offsets.to_numpy()] * 4).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in itertools.pairwise(stops)]

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and their bounds. A word that ends in a letter and then in ``ENDS`` is looked up in two parts."""
        stems = pc.utf8_rtrim(words, ENDS)
        last = pc.utf8_slice_codeunits(stems, -1).dictionary_encode()
        letter = np.array([all_letters(c) for c in strings(last.dictionary)], bool)[last.indices.to_numpy()]
        over = pc.subtract(pc.binary_length(words), pc.binary_length(stems)).to_numpy()  # all of one byte each
        at = np.flatnonzero(letter & (over > 0))
        ends = [w[-n:] for w, n in zip(strings(words.take(pa.array(at))), over[at].tolist(), strict=True)]
        number = {e: k for k, e in enumerate(dict.fromkeys(ends), 1)}
        keys = pc.if_else(pa.array(letter), stems, words).dictionary_encode()
        parts = np.zeros((len(words), 2), np.int64)
        parts[:, 0] = keys.indices.to_numpy()
        parts[:, 1] = len(keys.dictionary)  # no end
        parts[at, 1] += np.array([number[e] for e in ends], np.int64)
        found = self._look_up([*strings(keys.dictionary), "", *number])
        ids, bounds = runs(np.frombuffer(b"".join(found), "<u4"), bounds_of([len(f) // 4 for f in found]), parts.ravel())
        return ids, bounds[::2]

    def _look_up(self, words: list[str]) -> list[bytes]:
        found = list(map(self.known.get, words))
        open_ = [k for k, ids in enumerate(found) if ids is None]
        if open_:
            made = {w: self.older.get(w) for w in map(words.__getitem__, open_)}
            made |= self._words([w for w, ids in made.items() if ids is None])
            self.known |= made
            for k in open_:
                found[k] = made[words[k]]
        return found


WORDS = 400_000  # kept by a worker, twice


@functools.lru_cache(maxsize=2)
def encoder(path: str, limit: int = WORDS) -> Encoder:
    """One encoder for each file and Python worker, kept between tasks."""
    return Encoder(path, limit)


def batches_by_size(batch: pd.DataFrame, text: str, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Parts of a batch with about so many characters each."""
    group = batch[text].str.len().fillna(0).cumsum() // chars
    for _, part in batch.groupby(group, sort=True):
        yield part


def token_ids(docs: DataFrame, path: str, end_id: int, text: str = "text", into: str = "ids") -> DataFrame:
    """Replace the text by its ids and one end id: a binary column of unsigned 32-bit integers; null text counts as empty."""
    kept = [c for c in docs.columns if c not in (text, into)]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + [f"`{into}` binary"])
    end = array("I", [end_id]).tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in batches_by_size(batch, text):
                ids = encoder(path).encode(["" if t is None else t for t in part[text]])
                yield part[kept].assign(**{into: [i + end for i in ids]})

    return docs.mapInPandas(encode, schema)
