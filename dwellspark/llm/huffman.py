"""Token ids in a binary file format: canonical length-limited Huffman codes.

The texts are tokenised once: their ids are written down, with the counts of each
block, which Spark adds up.  The code lengths come from package-merge over the
vocabulary, at most ``limit`` bits, and the codes are the canonical ones, so the file
needs the lengths only.  Then the ids are dealt by ranges of doc_id, sorted, encoded
and written in blocks.

A file set is a folder with two tables, written by Spark's own committers:

* ``code``: id, length.
* ``blocks``: shard, block, ids_before (of the shard's earlier blocks), doc_ids and
  n_tokens (arrays, ascending doc_id), n_ids, payload (big-endian bit stream of all ids of the block), checkpoints (the bit
  offset of every ``STRIDE``-th id as little-endian 32-bit integers).

A block holds whole documents with about ``block_ids`` ids and is decoded without
any other; all its checkpoints are decoded side by side by table lookups.

Defined results: a null text is empty (the end id only); rows that agree in doc_id
stay side by side in the order of their text's hash; rows without a doc_id stand first
(in one range, like all rows of one doc_id); an empty table gives empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dwellspark.llm.common import text_blocks, utf8, whole_bytes, whole_text, written
from dwellspark.llm.tokens import tokenizer

STRIDE = 256
BLOCKS = ("shard int, block int, ids_before bigint, doc_ids array<bigint>, n_tokens array<int>, n_ids bigint, "
          "payload binary, checkpoints binary")


def with_end(ids: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append the end id to every document."""
    return np.insert(ids, at[1:], end_id).astype(np.uint32), at + np.arange(len(at))


TOKENS = "doc_id bigint, tie bigint, ids binary, used array<int>, times array<bigint>"


def token_ids(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """One row per document: doc_id, tie (a hash of its text), ids (little-endian, 16-bit where
    the vocabulary allows, else 32-bit).

    The first row of each block of texts also has the block's counts: ids ``used`` and
    how many ``times``.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_blocks(batch):
                tok = tokenizer(path)
                ids, at = with_end(*tok.encode(*utf8(part.column("text"))), end_id)
                kind = id_kind(len(tok.n_bytes), end_id)
                total = np.bincount(ids)
                used = np.flatnonzero(total)
                once = pa.array(np.concatenate(([0], np.full(part.num_rows, len(used)))).astype(np.int32))
                whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [
                    None, pa.py_buffer((at * kind.itemsize).astype(np.int64)), pa.py_buffer(ids.astype(kind))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("tie"), whole, pa.ListArray.from_arrays(once, pa.array(used.astype(np.int32))),
                    pa.ListArray.from_arrays(once, pa.array(total[used]))], ["doc_id", "tie", "ids", "used", "times"])

    text = whole_text("text")
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie")).mapInArrow(encode, TOKENS)


def id_kind(vocabulary: int, end_id: int) -> np.dtype:
    return np.dtype("<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4")


def count_ids(tokens: DataFrame) -> DataFrame:
    """id, n over all documents."""
    pair = F.explode(F.arrays_zip("used", "times")).alias("p")
    return tokens.where(F.size("used") > 0).select(pair).groupBy(F.col("p.used").alias("id")).agg(F.sum("p.times").alias("n"))


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); counts are positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need more than {limit} bits")
    order = np.argsort(counts, kind="stable")
    weight = counts[order].astype(np.float64)
    merged, taken = weight, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):  # pairs of the last list join the leaves, sorted by weight
        pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((weight, pairs))
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        taken.append(rank < n)
    length = np.zeros(n, dtype=np.int64)
    need = 2 * n - 2
    for leaf in reversed(taken):  # the first `need` entries: leaves cost a bit, pairs pass two on
        leaves = int(leaf[:need].sum())
        length[:leaves] += 1
        need = 2 * (need - leaves)
    out = np.empty(n, dtype=np.int64)
    out[order] = length
    return out


class Code:
    """Canonical code of ids: by length, then by id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        by = np.lexsort((ids, lengths))
        ids, lengths = ids[by], lengths[by]
        self.bits = int(lengths.max()) if len(lengths) else 1
        share = np.left_shift(1, self.bits - lengths)
        value = np.concatenate(([0], np.cumsum(share)[:-1])) if len(ids) else np.zeros(0, np.int64)
        size = int(ids.max()) + 1 if len(ids) else 1
        self.code = np.zeros(size, dtype=np.uint64)
        self.length = np.zeros(size, dtype=np.int64)
        self.code[ids] = (value >> (self.bits - lengths)).astype(np.uint64)
        self.length[ids] = lengths
        self.symbol = np.zeros(1 << self.bits, dtype=np.uint32)
        self.step = np.ones(1 << self.bits, dtype=np.int64)
        if len(ids):
            filled = int(share.sum())
            self.symbol[:filled] = np.repeat(ids, share).astype(np.uint32)
            self.step[:filled] = np.repeat(lengths, share)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """The bit stream, and its checkpoints."""
        length = self.length[ids]
        to = np.cumsum(length)
        at = to - length
        word, shift = at >> 5, 64 - (at & 31) - length
        value = self.code[ids] << shift.astype(np.uint64)  # over two 32-bit words
        n_words = (int(to[-1]) + 31 >> 5) + 1 if len(ids) else 0
        # codes share no bits, so sums (exact in doubles up to 2**53) put them together
        high = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), minlength=n_words)
        low = np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n_words)
        stream = (high + low)[:n_words].astype(np.uint32).astype(">u4").tobytes()
        return stream, at[::STRIDE].astype("<u4").tobytes()

    def decode(self, streams: list[bytes], checkpoints: list[bytes], n_ids: np.ndarray) -> np.ndarray:
        """The ids of some blocks in a row."""
        if not int(n_ids.sum()):
            return np.zeros(0, np.uint32)
        words = np.frombuffer(b"".join(streams) + bytes(8), dtype=">u4").astype(np.uint64)
        from_bit = np.concatenate(([0], np.cumsum([len(s) * 8 for s in streams])[:-1])).astype(np.int64)
        marks = [np.frombuffer(c, dtype="<u4").astype(np.int64) for c in checkpoints]
        bit = np.concatenate([m + f for m, f in zip(marks, from_bit)])
        lanes = np.array([len(m) for m in marks])
        left = np.concatenate([np.minimum(STRIDE, n - np.arange(k) * STRIDE) for n, k in zip(n_ids.tolist(), lanes.tolist())])
        out = np.empty(int(n_ids.sum()), dtype=np.uint32)
        place = np.concatenate(([0], np.cumsum(left)[:-1]))
        by = np.argsort(-left, kind="stable")  # lanes that end early stand last
        bit, place, left = bit[by], place[by], left[by]
        shift, mask = np.uint64(64 - self.bits), np.uint64((1 << self.bits) - 1)
        ends = np.searchsorted(-left, -np.arange(int(left[0])), side="left")
        for k in range(int(left[0])):
            n = int(ends[k])
            b = bit[:n]
            w = b >> 5
            pair = (words[w] << np.uint64(32)) | words[w + 1]
            look = ((pair << (b & 31).astype(np.uint64)) >> shift) & mask
            out[place[:n] + k] = self.symbol[look]
            b += self.step[look]
        return out


def write_ids(docs: DataFrame, folder: str, *, tokenizer_path: str, end_id: int = 0, limit: int = 18,
              block_ids: int = 1 << 16) -> None:
    """Encode every text and write the file set below ``folder``."""
    spark = docs.sparkSession
    tokens = written(token_ids(docs, tokenizer_path, end_id), "token-ids")
    counted = count_ids(tokens).toPandas()  # a row per id of the vocabulary at most
    ids, n = counted["id"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)
    lengths = code_lengths(n, limit)
    spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist())), "id bigint, length bigint").coalesce(1).write.parquet(f"{folder}/code")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, shard, block = Code(ids, lengths), TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        size = before = 0

        def put() -> pa.RecordBatch:
            nonlocal held, size, block, before
            run = np.concatenate([h[0] for h in held])
            payload, marks = code.encode(run)
            row = {"shard": [shard], "block": [block], "ids_before": [before], "doc_ids": [[d for h in held for d in h[2].to_pylist()]],
                   "n_tokens": [np.concatenate([h[1] for h in held]).tolist()], "n_ids": [len(run)],
                   "payload": [payload], "checkpoints": [marks]}
            held, size, block, before = [], 0, block + 1, before + len(run)
            return pa.RecordBatch.from_pydict(row, schema=BLOCK_SCHEMA)

        kind = id_kind(len(tokenizer(tokenizer_path).n_bytes), end_id)
        for batch in batches:
            for part in text_blocks(batch, column="ids"):
                data, at = whole_bytes(part.column("ids"))
                run, at = data.view(kind), at // kind.itemsize
                row = 0
                while row < part.num_rows:
                    upto = int(np.searchsorted(at, at[row] + block_ids - size))
                    upto = min(max(upto, row + 1), part.num_rows)
                    held.append((run[at[row]:at[upto]], np.diff(at[row:upto + 1]), part.column("doc_id").slice(row, upto - row)))
                    size += int(at[upto] - at[row])
                    row = upto
                    if size >= block_ids:
                        yield put()
        if held:
            yield put()

    ordered = (tokens.select("doc_id", "tie", "ids").repartitionByRange("doc_id")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "ids")
               .mapInArrow(blocks, BLOCKS))
    ordered.write.parquet(f"{folder}/blocks", compression="none")


BLOCK_SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("ids_before", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                          ("n_tokens", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("payload", pa.binary()),
                          ("checkpoints", pa.binary())])


def read_code(spark: SparkSession, folder: str) -> tuple[np.ndarray, np.ndarray]:
    pairs = spark.read.schema("id bigint, length bigint").parquet(f"{folder}/code").toPandas()  # at most the vocabulary
    return pairs["id"].to_numpy(np.int64), pairs["length"].to_numpy(np.int64)


def read_ids(spark: SparkSession, folder: str, at_once: int = 1 << 21) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian 32-bit) of every document of a file set.

    ``start`` is the number of ids before the document: of the earlier shards, the
    shard's earlier blocks, and inside the block.  The shards' starts are one row
    for each task that wrote, so they are broadcast.
    """
    ids, lengths = read_code(spark, folder)
    rows = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (rows.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(ids, lengths)
        for batch in batches:
            sizes = batch.column("n_ids").to_numpy()
            row = 0
            while row < batch.num_rows:
                upto = min(max(row + 1, row + int(np.searchsorted(np.cumsum(sizes[row:]), at_once))), batch.num_rows)
                some = batch.slice(row, upto - row)
                run = code.decode(some.column("payload").to_pylist(), some.column("checkpoints").to_pylist(), sizes[row:upto])
                n = some.column("n_tokens").flatten().to_numpy()
                per = np.diff(some.column("n_tokens").offsets.to_numpy())
                to = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
                first = np.repeat(np.concatenate(([0], np.cumsum(per)[:-1])), per)
                whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [
                    None, pa.py_buffer((to * 4).astype(np.int64)), pa.py_buffer(run.astype("<u4"))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(some.column("shard").to_numpy(), per)), some.column("doc_ids").flatten(),
                    pa.array(to[:-1] - to[first] + np.repeat(some.column("ids_before").to_numpy(), per)),
                    pa.array(n.astype(np.int64)), whole], ["shard", "doc_id", "inner", "n_tokens", "ids"])
                row = upto

    docs = rows.mapInArrow(decode, "shard int, doc_id bigint, inner bigint, n_tokens bigint, ids binary")
    return docs.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("inner")).alias("start"), "n_tokens", "ids")
