"""Encoding of whole texts with the tokenizers library, at block speed.

The byte-level BPE of ``byte_bpe_50k.json`` splits a text before it merges, and
some splits are certain from two neighbouring characters: between a letter,
digit or ASCII mark and a following space or newline, and between a Latin letter
and a following ASCII mark (not the apostrophe, which starts contractions).  A
text's ids are therefore its units' ids in a row, and a unit occurs many times:
each distinct unit is encoded by the library once and its ids are gathered by
numpy.  Units are told apart by 128 hash bits.

Where the table of a tokenizer has added tokens and a text holds one of their
strings, that block is encoded by the library directly (``plain``: their strings are
ordinary text).  Tokenizers with word ends that drop white space (``word_bpe_49k.json``)
split at the same places, so their units are cached likewise; only the encoding of new
units together in one string needs tokens whose bytes make up the text.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pandas as pd

LETTER, SPACE, MARK, DIGIT = 1, 2, 3, 4


def _classes() -> np.ndarray:
    kind = np.zeros(256, dtype=np.uint8)
    for lo, hi, k in ((0x21, 0x2F, MARK), (0x3A, 0x40, MARK), (0x5B, 0x60, MARK), (0x7B, 0x7E, MARK),
                      (0x30, 0x39, DIGIT), (0x41, 0x5A, LETTER), (0x61, 0x7A, LETTER)):
        kind[lo:hi + 1] = k
    kind[[0x20, 0x0A]] = SPACE
    kind[0x27] = 0
    return kind


KIND = _classes()
_rng = np.random.default_rng(20_240_229)
BYTE_A = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BYTE_B = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
STEP_A, STEP_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers (rounded up to a power of two) of both hash steps."""
    size = 1 << max(6, int(n - 1).bit_length())
    out = []
    for step in (STEP_A, STEP_B):
        p = np.full(size, step, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, two: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the byte runs [start, end); runs are disjoint, in order and not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    length = ends - starts
    first = np.concatenate(([0], np.cumsum(length)[:-1]))
    at = np.arange(int(length.sum())) - np.repeat(first, length)
    if starts[0] == 0 and len(at) == ends[-1]:  # the runs cover all bytes
        run = data[:len(at)]
    else:
        run = data[at + np.repeat(starts, length)]
    pa_, pb_ = powers(int(length.max()))
    a = np.add.reduceat(BYTE_A[run] * pa_[at], first)
    b = np.add.reduceat(BYTE_B[run] * pb_[at], first) if two else a
    return spread(a ^ length.astype(np.uint64)), spread(b)


def spread(h: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def unit_starts(data: np.ndarray, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the units of a block start, and the class of each byte's character."""
    kind = KIND[data]
    if len(data) > 1:  # two-byte Latin letters count by their last byte; U+00D7 and U+00F7 are no letters
        latin = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        kind[1:][latin] = LETTER
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 1:
        before, after = kind[:-1], kind[1:]
        cut[1:-1] = ((after == SPACE) & (before != SPACE) & (before != 0)) | ((after == MARK) & (before == LETTER))
    cut[doc_at] = True
    cut[len(data)] = False
    return np.flatnonzero(cut), kind


class BlockTokenizer:
    """Ids of whole texts; keeps the ids of up to ``most`` distinct units between blocks."""

    def __init__(self, path: str, most: int = 2_000_000, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain
        self.most = most
        self.whole_bytes = not json.loads(self.tok.to_str())["model"].get("end_of_word_suffix")
        names = [self.tok.id_to_token(i) or "" for i in range(self.tok.get_vocab_size(with_added_tokens=True))]
        self.n_bytes = np.array([len(x) for x in names], dtype=np.int64)
        self.added = [] if plain else [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self._forget()

    def units(self, data: np.ndarray, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return unit_starts(data, doc_at)

    def _forget(self) -> None:
        # known units, sorted by key: a large part, and a small one that new units are merged into
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.parts = [empty, empty]  # each: key, check, place of the first id, number of ids
        self.ids = np.zeros(0, np.uint32)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(known, check, at, count) of sorted keys."""
        known = np.zeros(len(keys), dtype=bool)
        out = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for part in self.parts:
            if len(part[0]):
                place = np.minimum(np.searchsorted(part[0], keys), len(part[0]) - 1)
                here = part[0][place] == keys
                known |= here
                for to, column in zip(out, part[1:]):
                    to[here] = column[place[here]]
        return known, *out

    def encode(self, data: np.ndarray, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block in a row, and the offsets of its documents in them."""
        raw = data.tobytes()
        if any(x in raw for x in self.added):
            return self._direct(raw, doc_at)
        starts, kind = self.units(data, doc_at)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(doc_at), np.int64)
        ends = np.append(starts[1:], len(data))
        a, b = run_hashes(data, starts, ends)
        which, keys = pd.factorize(a)
        by = np.argsort(keys)  # sorted keys are looked up faster
        back = np.empty_like(by)
        back[by] = np.arange(len(by))
        which, keys = back[which], keys[by]
        first = np.full(len(keys), len(a), dtype=np.int64)
        first[which[::-1]] = np.arange(len(a) - 1, -1, -1)
        check = b[first]
        if not np.array_equal(check[which], b):
            return self._direct(raw, doc_at)
        if sum(len(part[0]) for part in self.parts) + len(keys) > self.most:
            self._forget()
        known, its_check, at, count = self._find(keys)
        if not np.array_equal(its_check[known], check[known]):
            return self._direct(raw, doc_at)
        if not known.all():
            new = np.flatnonzero(~known)
            self._learn(raw, kind, starts[first[new]], ends[first[new]], keys[new], check[new])
            _, _, at, count = self._find(keys)
        at, count = at[which], count[which]
        upto = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.repeat(at - upto[:-1], count) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(starts, doc_at)]

    def _direct(self, raw: bytes, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [raw[i:j].decode() for i, j in zip(doc_at[:-1], doc_at[1:])]
        parts = [x.ids for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        at = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)
        return np.fromiter((i for x in parts for i in x), dtype=np.uint32, count=int(at[-1])), at

    def _learn(self, raw: bytes, kind: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               keys: np.ndarray, check: np.ndarray) -> None:
        units = [raw[i:j] for i, j in zip(starts.tolist(), ends.tolist())]
        # units that begin with a space or newline and end in a certain character can stand in one string
        lead, last = kind[starts], kind[ends - 1]
        row = (lead == SPACE) & (last != SPACE) & (last != 0) & self.whole_bytes
        together, alone = np.flatnonzero(row), np.flatnonzero(~row)
        ids, count, order = [], [], []
        for k in range(0, len(together), 2000):
            part = together[k:k + 2000]
            got = np.array(self.tok.encode(b"".join([units[i] for i in part]).decode(), add_special_tokens=False).ids, dtype=np.uint32)
            byte_end = np.cumsum(self.n_bytes[got])
            unit_end = np.cumsum([len(units[i]) for i in part])
            upto = np.searchsorted(byte_end, unit_end)
            if len(got) and np.array_equal(byte_end[upto], unit_end):
                ids.append(got)
                count.append(np.diff(np.concatenate(([0], upto + 1))))
                order.append(part)
            else:  # a split that was not certain after all
                alone = np.concatenate((alone, part))
        for k in range(0, len(alone), 20_000):
            part = alone[k:k + 20_000]
            got = self._each([units[i] for i in part])
            ids.append(np.array([i for x in got for i in x], dtype=np.uint32))
            count.append(np.array([len(x) for x in got], dtype=np.int64))
            order.append(part)
        order, count = np.concatenate(order), np.concatenate(count).astype(np.int64)
        at = len(self.ids) + np.concatenate(([0], np.cumsum(count)[:-1]))
        self.ids = np.concatenate([self.ids, *ids])
        self.parts[1] = self._merged(self.parts[1], (keys[order], check[order], at, count))
        if len(self.parts[1][0]) > max(50_000, len(self.parts[0][0]) // 8):
            self.parts = [self._merged(*self.parts), tuple(c[:0] for c in self.parts[1])]

    def _each(self, units: list[bytes]) -> list[list[int]]:
        return [x.ids for x in self.tok.encode_batch_fast([u.decode() for u in units], add_special_tokens=False)]

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        columns = [np.concatenate(c) for c in zip(a, b)]
        by = np.argsort(columns[0], kind="stable")
        return tuple(c[by] for c in columns)


_KEPT: dict[str, BlockTokenizer] = {}


def tokenizer(path: str, plain: bool = False) -> BlockTokenizer:
    """One per Python worker."""
    key = f"plain {path}" if plain else path
    if key not in _KEPT:
        _KEPT[key] = BlockTokenizer(path, plain=plain)
    return _KEPT[key]
