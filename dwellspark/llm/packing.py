"""Best-fit packing of token pieces into sequences, by swap-based local search.

A document's ids are cut only if they exceed a sequence: into full pieces, the
first one taking the rest.  Full pieces are sequences of their own.  The other
pieces are dealt to shards by a hash (about ``shard_pieces`` each), and a shard is
packed in one task: best-fit decreasing first, then local search empties bins.
One or two pieces of the emptiest bin move to a bin with room, or are exchanged for
one or two of a fuller bin that are shorter; each step fills a fuller bin further,
so the sum of squared fills grows, and the search ends when no step is left.  A bin
that has lost its pieces is gone.

Defined results: a null text has only the end id; rows that agree in doc_id are
packed each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.common import cut_lineage, text_blocks, utf8, whole_text
from dwellspark.llm.huffman import with_end
from dwellspark.llm.tokens import tokenizer

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def token_pieces(docs: DataFrame, *, tokenizer_path: str, end_id: int = 0, room: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian 32-bit) of every document."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_blocks(batch):
                ids, at = with_end(*tokenizer(tokenizer_path).encode(*utf8(part.column("text"))), end_id)
                n = np.diff(at)
                pieces = -(-n // room)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = n - (pieces - 1) * room
                length = np.where(piece == 0, first[doc], room)
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * room)
                to = np.concatenate(([0], np.cumsum(length)))
                whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [
                    None, pa.py_buffer((to * 4).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                    pa.array(start), pa.array(length), whole], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select("doc_id", whole_text("text").alias("text")).mapInArrow(cut, PIECES)


class Bins:
    """Bins of one shard: lists of piece lengths by free room, with a mask of the rooms in use."""

    def __init__(self, room: int):
        self.room = room
        self.items: list[list[tuple[int, int]]] = []  # (length, piece)
        self.free: list[int] = []
        self.by_free: list[set[int]] = [set() for _ in range(room + 1)]
        self.mask = 0

    def place(self, bin_: int, free: int) -> None:
        old = self.free[bin_]
        self.by_free[old].discard(bin_)
        if not self.by_free[old]:
            self.mask &= ~(1 << old)
        self.free[bin_] = free
        self.by_free[free].add(bin_)
        self.mask |= 1 << free

    def best(self, length: int) -> int:
        """A bin with the least room for ``length``, or -1."""
        some = self.mask >> length
        if not some:
            return -1
        return next(iter(self.by_free[length + (some & -some).bit_length() - 1]))

    def add(self, bin_: int, item: tuple[int, int]) -> None:
        if bin_ < 0:
            bin_ = len(self.items)
            self.items.append([])
            self.free.append(self.room)
            self.by_free[self.room].add(bin_)
        self.items[bin_].append(item)
        self.place(bin_, self.free[bin_] - item[0])

    def remove(self, bin_: int, item: tuple[int, int]) -> None:
        self.items[bin_].remove(item)
        self.place(bin_, self.free[bin_] + item[0])

    def drop(self, bin_: int) -> None:
        """Take an empty bin out."""
        free = self.free[bin_]
        self.by_free[free].discard(bin_)
        if not self.by_free[free]:
            self.mask &= ~(1 << free)


def decreasing_best_fit(lengths: list[int], room: int) -> Bins:
    bins = Bins(room)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bins.add(bins.best(lengths[i]), (lengths[i], i))
    return bins


def _sums(items: list[tuple[int, int]]) -> int:
    """The lengths of one piece and of two, as the bits of an integer."""
    one = two = 0
    for n, _ in items:
        two |= one << n
        one |= 1 << n
    return one | two


def _of(items: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The piece, or two pieces, of this length; none for 0."""
    before: dict[int, tuple[int, int]] = {}
    both = []
    for item in items if length else []:
        if item[0] == length:
            return [item]
        if not both and length - item[0] in before:
            both = [before[length - item[0]], item]
        before[item[0]] = item
    return both


class Partners:
    """The underfull bins by free room, with the lengths that an exchange can take from them.

    A set of lengths is an integer with a bit per length; a bin gives 0 (a mere move),
    a piece or two.  ``index`` has, per free room f, what its bins give and what can
    come instead, 1 to f longer.  A bin that leaves may stay in there until a lookup
    finds no bin; then that room's sets are made anew.
    """

    def __init__(self, bins: Bins):
        self.bins = bins
        self.gives: dict[int, int] = {}
        self.kinds: dict[int, dict[int, set[int]]] = {}  # by free room and gives
        self.index: dict[int, tuple[int, int]] = {}
        self.clock = 0
        self.came: dict[int, int] = {}  # when a bin last came to a free room

    def put(self, bin_: int) -> None:
        free = self.bins.free[bin_]
        if free and self.bins.items[bin_]:
            gives = self.gives[bin_] = 1 | _sums(self.bins.items[bin_])
            self.kinds.setdefault(free, {}).setdefault(gives, set()).add(bin_)
            held, fits = self.index.get(free, (0, 0))
            if gives & ~held:
                self.index[free] = held | gives, fits | _longer(gives, free)
            self.clock += 1
            self.came[free] = self.clock

    def cut(self, bin_: int) -> None:
        free = self.bins.free[bin_]
        kinds, gives = self.kinds[free], self.gives[bin_]
        kinds[gives].discard(bin_)
        if not kinds[gives]:
            del kinds[gives]
        if not kinds:
            del self.kinds[free], self.index[free]

    def find(self, out: int, since: int) -> tuple[int, int, int] | None:
        """A bin as full as ``out`` or fuller, the length it gets and the shorter one it gives.

        The bins with most room come first, and there the largest difference.  Rooms
        that no bin has come to after ``since`` are left out.
        """
        mine = _sums(self.bins.items[out])
        for free in sorted(self.kinds, reverse=True):
            if free > self.bins.free[out] or self.came[free] <= since:
                continue
            fresh = False
            while mine & self.index[free][1]:
                held, more = self.index[free][0], free
                while not mine & held << more:
                    more -= 1
                gets = (mine & held << more).bit_length() - 1
                for gives, some in self.kinds[free].items():
                    if gives >> gets - more & 1:
                        return next(iter(some)), gets, gets - more
                assert not fresh
                held, fresh = 0, True
                for gives in self.kinds[free]:
                    held |= gives
                self.index[free] = held, _longer(held, free)
        return None


def _longer(lengths: int, most: int) -> int:
    """The lengths that are 1 to ``most`` above one of these."""
    out, done = lengths << 1, 1
    while done < most:
        more = min(done, most - done)
        out |= out << more
        done += more
    return out


def local_search(bins: Bins) -> None:
    """Exchange pieces between underfull bins, the emptiest first, until no exchange is left or no bin can go.

    Every step moves fill from one bin to one that is at least as full, so the sum
    of squared fills grows and the search ends.  A bin that was stuck and has not
    changed is held against the bins that have changed since.
    """
    left = sum(f for b, f in enumerate(bins.free) if bins.items[b])
    partners = Partners(bins)
    for b in range(len(bins.items)):
        partners.put(b)
    stuck: dict[int, int] = {}  # since when
    moved = True
    while moved:
        moved = False
        for out in sorted((b for b, f in enumerate(bins.free) if f and bins.items[b]), key=lambda b: -bins.free[b]):
            if left < bins.room:  # no bin can go
                return
            if not bins.free[out]:  # filled meanwhile
                continue
            partners.cut(out)
            while bins.items[out] and (found := partners.find(out, stuck.get(out, 0))):
                b, gets, gives = found
                partners.cut(b)
                _exchange(bins, out, b, _of(bins.items[out], gets), _of(bins.items[b], gives))
                partners.put(b)
                stuck.pop(out, None)
                stuck.pop(b, None)
                moved = True
            if bins.items[out]:
                partners.put(out)
                stuck[out] = partners.clock
            else:
                bins.drop(out)
                left -= bins.room


def _exchange(bins: Bins, out: int, b: int, mine: list, theirs: list) -> None:
    for x in mine:
        bins.remove(out, x)
    for y in theirs:
        bins.remove(b, y)
    for x in mine:
        bins.add(b, x)
    for y in theirs:
        bins.add(out, y)


def pack_lengths(lengths: list[int], room: int) -> tuple[list[int], list[int]]:
    """The bin (from 0) and the offset of each piece; full pieces are bins of their own."""
    where, offset = [0] * len(lengths), [0] * len(lengths)
    part = [i for i, n in enumerate(lengths) if n < room]
    bins = decreasing_best_fit([lengths[i] for i in part], room)
    local_search(bins)
    k = 0
    for items in bins.items:
        at = 0
        for n, i in sorted(items, key=lambda x: x[1]):
            where[part[i]], offset[part[i]] = k, at
            at += n
        k += bool(items)
    for i, n in enumerate(lengths):
        if n >= room:
            where[i] = k
            k += 1
    return where, offset


def pack(pieces: DataFrame, *, room: int = 2048, shard_pieces: int = 20_000) -> DataFrame:
    """``pieces`` (with doc_id, piece, start, length; short columns only) plus sequence_id and offset."""
    pieces = cut_lineage(pieces)
    shards = max(1, pieces.where(F.col("length") < room).count() // shard_pieces)
    cols = pieces.columns
    salt = F.xxhash64("doc_id", "piece", F.monotonically_increasing_id())
    dealt = pieces.withColumn("shard", F.pmod(salt, F.lit(shards)).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def shard(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "length"], kind="stable", ignore_index=True)
        where, offset = pack_lengths(pdf["length"].tolist(), room)
        pdf = pdf[cols].copy()
        pdf["sequence_id"] = (int(key[0]) << 32) + np.array(where, dtype=np.int64)
        pdf["offset"] = np.array(offset, dtype=np.int64)
        return pdf

    return dealt.groupBy("shard").applyInPandas(shard, f"{schema}, sequence_id bigint, offset bigint")


def sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves (for distinct doc_ids)."""
    parts = pieces.select("doc_id", "piece", "ids").join(packed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    rows = parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))  # at most `room` pieces
    return rows.select("sequence_id", F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "")).alias("ids"))
