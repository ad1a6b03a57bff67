"""A public tokenizer applied through a cache of whole pre-tokens.

The tokenizer files of this kind drop white space, lower letters, and then split into runs
of letters, single digits and runs of other characters.  The ids of a text are therefore
the ids of its pre-tokens in order, where a pre-token is a run of bytes without ASCII white
space, cut further between letters, digits and marks if it holds nothing but ASCII (without
``'`` and ``<``, which begin contractions and special strings) and Latin-1 letters.  Those
are lowered too.  Any other run stays whole, whatever special strings it holds.

All pre-tokens of a slice are looked up at once by their 64-bit hash; those that are
missing go to the library, each once, and are then remembered.  A worker's cache has a
fixed number of slots: a new pre-token takes over the slot of its hash.
"""

from __future__ import annotations

import json
import os

import numpy as np
from pyspark.sql import SparkSession

from .textarrays import PRETOKENS, U64, Words

SLOT_BITS = 20
#: ids kept of a pre-token; one with more is encoded anew each time
WIDTH = 10
# Fixed value: how the tokenizer files of this kind split a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: pre-tokens handed to the library in one text
TOGETHER = 256

_LOADED: dict = {}


def shared_vocabulary(spark: SparkSession, path: str):
    """The tokenizer file as a broadcast: executors need no copy of their own (a few MB)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


_BREAK, _LETTER, _DIGIT, _MARK, _OTHER = range(5)


def _classes() -> np.ndarray:
    t = np.full(256, _OTHER, dtype=np.uint8)
    t[33:127] = _MARK
    t[48:58] = _DIGIT
    t[65:91] = t[97:123] = _LETTER
    t[[39, 60]] = _OTHER  # ' and <
    t[[9, 10, 11, 12, 13, 32]] = _BREAK
    t[0xC3] = _LETTER  # first byte of the Latin-1 letters
    return t


_CLASS = _classes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class PreTokens(Words):
    """The pre-tokens of a slice, as ``Words``."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        if not len(raw):
            super().__init__(raw, offsets, PRETOKENS)
            return
        kind = _CLASS[raw]
        second = np.zeros(len(raw), dtype=bool)  # second byte of a Latin-1 letter
        second[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] < 0xC0) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        kind[second] = _LETTER
        inside = kind != _BREAK
        first = np.zeros(len(raw) + 1, dtype=bool)
        first[offsets] = True
        first = first[:-1]
        starts = np.flatnonzero(inside & (first | ~np.concatenate([[False], inside[:-1]])))
        self.bytes = np.where(second & (raw < 0x9F), raw + np.uint8(32), _LOWER[raw])
        if len(starts):
            # runs with anything else stay whole and as they are
            lengths = np.add.reduceat(inside, starts, dtype=np.int64)
            whole = np.repeat(np.add.reduceat(kind == _OTHER, starts, dtype=np.int64) > 0, lengths)
            at = np.flatnonzero(inside)[whole]
            kind[at] = _OTHER
            self.bytes[at] = raw[at]
        change = first.copy()
        change[0] = True
        change[1:] |= kind[1:] != kind[:-1]
        self.start = np.flatnonzero(inside & change)
        ends = np.append(change[1:], True)
        self.end = np.flatnonzero(inside & ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self._hashes()


class Encoder:
    """Token ids of pre-tokens by the library."""

    def __init__(self, spec: bytes):
        made = json.loads(spec)
        split = [p.get("pattern") for p in (made.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        if {"Regex": PATTERN} not in split or {"type": "Lowercase"} not in (made.get("normalizer") or {}).get("normalizers", []):
            raise ValueError("the tokenizer file does not lower letters and split at white space in the expected way")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec.decode("utf-8"))
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids beyond 65,535 do not fit the cache")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def ids(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each pre-token; many are encoded as one text and told apart by their place in it."""
        out = []
        for at in range(0, len(words), TOGETHER):
            texts = [w.decode("utf-8", "replace") for w in words[at:at + TOGETHER]]
            made = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(made.ids, dtype=np.uint32)
            place = np.array([a for a, _ in made.offsets], dtype=np.int64)
            starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
            cut = np.searchsorted(place, starts).tolist()
            out += [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]
        return out


class Slots:
    """Remembered pre-tokens: hash, number of ids and, if ``width``, the ids themselves."""

    def __init__(self, width: int, bits: int = SLOT_BITS):
        self.shift, self.width = U64(64 - bits), width
        self.hash = np.zeros(1 << bits, dtype=U64)
        self.count = np.zeros(1 << bits, dtype=np.uint16)
        self.ids = np.zeros((1 << bits, width), dtype=np.uint16)  # ids below 65,536

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each hash, and whether it is the one remembered there."""
        slot = (hashes >> self.shift).astype(np.int64)
        return slot, self.hash[slot] == hashes

    def put(self, hashes: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        slot = (hashes >> self.shift).astype(np.int64)
        fits = counts <= (self.width or 65_535)
        self.hash[slot[fits]], self.count[slot[fits]] = hashes[fits], counts[fits]
        if self.width:
            self.ids[slot[fits]] = ids[fits]


def slots(spec: bytes, use: str, width: int = 0) -> tuple[Encoder, Slots]:
    """This worker's encoder for a vocabulary and its cache for one use."""
    key = use, hash(spec)
    if key not in _LOADED:
        _LOADED[key] = Encoder(spec), Slots(width)
    return _LOADED[key]


def missing_words(w: Words, missing: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Distinct hashes of the missing words, each word's place among them, and their bytes."""
    hashes, first, at = np.unique(w.hash[missing], return_index=True, return_inverse=True)
    where = missing[first]
    return hashes, at, [w.bytes[s:e].tobytes() for s, e in zip(w.start[where].tolist(), w.end[where].tolist())]


def encode(w: Words, encoder: Encoder, cache: Slots) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words of a slice in order, and each word's number of ids."""
    slot, known = cache.find(w.hash)
    counts = np.zeros(len(slot), dtype=np.int64)
    counts[known] = cache.count[slot[known]]
    rows = cache.ids[slot]  # those of unknown words are replaced below
    missing, long = np.flatnonzero(~known), {}
    if len(missing):
        hashes, at, words = missing_words(w, missing)
        made = encoder.ids(words)
        n = np.array([len(i) for i in made], dtype=np.int64)
        table = np.zeros((len(made), cache.width), dtype=np.uint16)
        short = n <= cache.width
        filled = np.arange(cache.width)[None, :] < np.where(short, n, 0)[:, None]
        table[filled] = np.concatenate([np.zeros(0, np.uint32), *(m for m, s in zip(made, short.tolist()) if s)])
        cache.put(hashes, n, table)
        counts[missing], rows[missing] = n[at], table[at]
        long = {int(k): made[a] for k, a in zip(missing, at) if not short[a]}
    short = np.where(counts > cache.width, 0, counts) if long else counts
    out = rows[np.arange(cache.width)[None, :] < short[:, None]]
    if long:
        places = np.cumsum(short)
        where = sorted(long)
        out = np.insert(out.astype(np.uint32), np.repeat(places[where], counts[where]), np.concatenate([long[k] for k in where]))
    return out, counts


def count(w: Words, encoder: Encoder, cache: Slots, table: Slots) -> np.ndarray:
    """Number of ids of each word of a slice: from the frequent table, the cache, or the library."""
    slot, known = table.find(w.hash)
    counts = np.where(known, table.count[slot], 0).astype(np.int64)
    rest = np.flatnonzero(~known)
    slot, kept = cache.find(w.hash[rest])
    counts[rest[kept]] = cache.count[slot[kept]]
    missing = rest[~kept]
    if len(missing):
        hashes, at, words = missing_words(w, missing)
        n = np.array([len(i) for i in encoder.ids(words)], dtype=np.int64)
        cache.put(hashes, n, None)
        counts[missing] = n[at]
    return counts
