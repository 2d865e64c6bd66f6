"""Packing with a controlled mixture: deficit round-robin over one queue per source.

A window is a sequence of ``room`` tokens.  Every window is filled from the queues of
the sources in their target proportions, which are the sources' shares of all tokens, as
every token is packed once.  A queue's deficit grows by its share of each window and
falls by what it serves; what is not served is carried to the next window.

The windows are dealt to parts of ``part_windows`` windows each, packed in one task per
part.  Where a part's tokens lie in a queue follows from the totals alone (``Shares``):
cumulative shares are rounded down, so a part starts with deficits below one token, which
are those that the part before it ends with.  Inside a part, queues are visited in turn.
A queue serves whole documents while its deficit allows, and cuts one only for a serving
of at least ``least`` tokens or where the window ends; else its deficit waits.  A window
that has room when all queues have been visited takes it from the largest deficits.

All windows but the last are full.  The tokens left over at the end (fewer than a window)
form sequences of falling powers of two, which need no padding.

Queues are read in a seeded order.  Sources with fewer tokens than there are parts share
a queue, and join the largest one where even that is too short.

Defined results: a null text has only the end id; a null source is a source; rows that
agree in doc_id are packed each; an empty table gives no rows; further columns of the
input are not read.  Bounded by the number of sources (one row each): the shares, which
are collected and sent to the tasks.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.common import text_blocks, utf8, whole_bytes, whole_text, written
from dwellspark.llm.huffman import with_end
from dwellspark.llm.tokens import tokenizer
from dwellspark.operators.ordered import running_sums

TOKENS = "doc_id bigint, source string, doc_tokens bigint, ids binary"
TURNS = "part bigint, queue int, place bigint, row bigint, start bigint, length bigint"
PACKED = ("doc_id bigint, source string, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")
PIECES = "row bigint, start bigint, length bigint, sequence_id bigint, offset bigint"


def token_rows(docs: DataFrame, *, tokenizer_path: str, end_id: int, id_bytes: int = 4) -> DataFrame:
    """doc_id, source, doc_tokens, ids (with the end id; little-endian, ``id_bytes`` each, 2 or 4)."""
    kind = np.dtype(f"<u{id_bytes}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_blocks(batch):
                ids, at = with_end(*tokenizer(tokenizer_path).encode(*utf8(part.column("text"))), end_id)
                if len(ids) and int(ids.max()) >> 8 * id_bytes:
                    raise ValueError(f"an id does not fit in {id_bytes} bytes")
                whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [
                    None, pa.py_buffer((at * id_bytes).astype(np.int64)), pa.py_buffer(ids.astype(kind))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), pa.array(np.diff(at)), whole],
                                                 ["doc_id", "source", "doc_tokens", "ids"])

    return docs.select("doc_id", "source", whole_text("text").alias("text")).mapInArrow(encode, TOKENS)


class Shares:
    """Which tokens of each queue belong to which part; exact integers."""

    def __init__(self, tokens: list[int], part_tokens: int):
        self.tokens, self.part_tokens = tokens, part_tokens
        self.total = sum(tokens)
        self.parts = -(-self.total // part_tokens)
        self.upto = [0]
        for n in tokens:
            self.upto.append(self.upto[-1] + n)

    def served(self, queue: int, part: int) -> int:
        """Tokens of the queue in all parts before this one: cumulative shares, rounded down."""
        done = min(part * self.part_tokens, self.total)
        return done * self.upto[queue + 1] // self.total - done * self.upto[queue] // self.total

    def split(self, queue: int, place: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(part, tokens served before in it, length) of a run of the queue's tokens."""
        part = min(place * self.total // (self.tokens[queue] * self.part_tokens), self.parts - 1)
        while part and self.served(queue, part) > place:
            part -= 1
        while length:
            upto = self.served(queue, part + 1)
            if upto > place:
                some = min(length, upto - place)
                yield part, place - self.served(queue, part), some
                place, length = place + some, length - some
            part += 1


def queues_of(sources: list[tuple[str | None, int]], part_tokens: int) -> tuple[list[list[str | None]], list[int]]:
    """The sources of each queue and its tokens."""
    order = sorted(sources, key=lambda s: (-s[1], s[0] is not None, s[0] or ""))
    parts = -(-sum(n for _, n in order) // part_tokens)
    queues = [([s], n) for s, n in order if n >= parts]
    small = [(s, n) for s, n in order if n < parts]
    if small:
        names, n = [s for s, _ in small], sum(n for _, n in small)
        if n >= parts or not queues:
            queues.append((names, n))
        else:
            queues[0] = (queues[0][0] + names, queues[0][1] + n)
    return [q for q, _ in queues], [n for _, n in queues]


def deficit_round_robin(queues: list[list[tuple[int, int, int]]], room: int, least: int) -> list[tuple[int, int, int, int, int]]:
    """(row, start, length, window, offset) of the pieces of one part.

    ``queues``: per queue its documents' (row, start, length) in order.  The shares are
    those of the queues' tokens, so all run dry with the last window.
    """
    tokens = [sum(n for _, _, n in q) for q in queues]
    total = sum(tokens)
    heads = [[list(d) for d in reversed(q)] for q in queues]  # the last one is next
    left = list(tokens)
    deficit = [0] * len(queues)  # times total / room, so that a window adds the queue's tokens
    out: list[list[int]] = []
    window = size = free = 0

    def serve(queue: int, most: int) -> None:
        nonlocal free
        while most:
            head = heads[queue][-1]
            some = min(most, head[2])
            if out and out[-1][0] == head[0] and out[-1][3] == window and out[-1][1] + out[-1][2] == head[1]:
                out[-1][2] += some
            else:
                out.append([head[0], head[1], some, window, size - free])
            head[1] += some
            head[2] -= some
            if not head[2]:
                heads[queue].pop()
            most -= some
            free -= some
            left[queue] -= some
            deficit[queue] -= some * total

    def allowed(queue: int) -> int:
        """Tokens of whole documents within the deficit, or a cut of at least ``least``."""
        most = min(deficit[queue] // total, free, left[queue])
        if most <= 0:
            return 0
        whole = 0
        for head in reversed(heads[queue]):
            if whole + head[2] > most:
                break
            whole += head[2]
            if whole == most:
                break
        return most if most - whole >= least else whole

    while any(left):
        size = free = min(room, sum(left))
        for queue, n in enumerate(tokens):
            deficit[queue] += n * free
        for turn in range(len(queues)):
            queue = (window + turn) % len(queues)
            if free and left[queue]:
                serve(queue, allowed(queue))
        while free:
            queue = max((q for q in range(len(queues)) if left[q]), key=lambda q: (deficit[q], left[q]))
            # the queue's own claim first, or else a head document, and no cut for less than `least`
            claim = max(deficit[queue] // total, min(heads[queue][-1][2], least))
            serve(queue, min(claim, free, left[queue]))
        window += 1
    return [tuple(x) for x in out]


def power_sequences(total: int, room: int) -> list[int]:
    """Where the sequences start in the tokens of the last, short window: falling powers of two."""
    starts, at = [], 0
    while at < total:
        starts.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    return starts


def pack(tokens: DataFrame, *, room: int = 4096, part_windows: int = 256, least: int = 64, seed: int = 0,
         id_bytes: int = 4) -> DataFrame:
    """Pieces of the documents: the columns of ``PACKED``, with 32-bit little-endian ids.

    ``tokens`` has the columns of ``TOKENS`` (``id_bytes`` a token); it is written once, as
    several steps read it.
    """
    part_tokens = room * part_windows
    tokens = written(tokens.withColumn("row", F.monotonically_increasing_id()), "mixture-tokens")
    sizes = tokens.groupBy("source").agg(F.sum("doc_tokens").alias("n")).collect()  # one row per source
    names, counts = queues_of([(r["source"], r["n"]) for r in sizes], part_tokens)
    shares = Shares(counts, part_tokens)
    spark = tokens.sparkSession
    if not counts:
        return spark.createDataFrame([], PACKED)
    of_source = spark.createDataFrame([(s, k) for k, some in enumerate(names) for s in some], "s string, queue int")
    queued = tokens.select("row", "source", "doc_tokens").join(F.broadcast(of_source), F.col("source").eqNullSafe(F.col("s"))).select(
        "queue", F.xxhash64("row", F.lit(seed)).alias("shuffled"), "row", "doc_tokens")
    placed = running_sums(queued, ["queue", "shuffled", "row"], {"upto": "doc_tokens"})

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for queue, row, upto, n in zip(*(batch.column(c).to_pylist() for c in ("queue", "row", "upto", "doc_tokens"))):
                place, start = upto - n - shares.upto[queue], 0
                for part, at, length in shares.split(queue, place, n):
                    found.append((part, queue, at, row, start, length))
                    start += length
            columns = list(zip(*found)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(columns)],
                                             ["part", "queue", "place", "row", "start", "length"])

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        table = table.sort_by([("queue", "ascending"), ("place", "ascending")])
        queues: dict[int, list[tuple[int, int, int]]] = {}
        for queue, *document in zip(*(table[c].to_pylist() for c in ("queue", "row", "start", "length"))):
            queues.setdefault(queue, []).append(tuple(document))
        pieces = deficit_round_robin(list(queues.values()), room, least)
        first = part * part_windows
        used = min(part_tokens, shares.total - part * part_tokens)
        full, rest = divmod(used, room)
        starts = power_sequences(rest, room)
        rows = []
        for row, start, length, window, offset in pieces:
            if window < full:
                rows.append((row, start, length, first + window, offset))
                continue
            while length:  # the short window at the very end
                k = bisect_right(starts, offset) - 1
                upto = starts[k + 1] if k + 1 < len(starts) else rest
                some = min(length, upto - offset)
                rows.append((row, start, some, first + full + k, offset - starts[k]))
                start, length, offset = start + some, length - some, offset + some
        return pa.table([pa.array(c, pa.int64()) for c in zip(*rows)], ["row", "start", "length", "sequence_id", "offset"])

    pieces = (placed.select("queue", "row", "upto", "doc_tokens").mapInArrow(turns, TURNS)
              .groupBy("part").applyInArrow(fill, PIECES))
    ids = F.substring("ids", (F.col("start") * id_bytes + 1).cast("int"), (F.col("length") * id_bytes).cast("int"))
    whole = pieces.join(tokens, "row").select("doc_id", "source", "start", "length", ids.alias("ids"), "doc_tokens", "sequence_id", "offset")
    return whole if id_bytes == 4 else whole.mapInArrow(lambda b: _widened(b, id_bytes), PACKED)


def _widened(batches: Iterator[pa.RecordBatch], id_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_blocks(batch, column="ids"):
            data, at = whole_bytes(part.column("ids"))
            wide = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [
                None, pa.py_buffer((at * (4 // id_bytes)).astype(np.int64)), pa.py_buffer(data.view(f"<u{id_bytes}").astype("<u4"))])
            yield part.set_column(part.schema.get_field_index("ids"), "ids", wide.cast(pa.binary()))
