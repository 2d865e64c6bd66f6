"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Tokenizer A is a byte-level BPE of the tokenizers library and encodes a space and the
text; tokenizer B is a sentencepiece model, which adds that space itself.  Both cut the
same bytes, so their tokens' end offsets decide everything:

* the ids of a block of documents are list columns; ``list_flatten`` and
  ``list_parent_indices`` make them token tables, and a cumulative sum of the tokens'
  byte lengths, taken anew for each document, gives their ends;
* a full outer Acero hash join of both tables on (document, end) has one row per
  distinct end.  A row stands for the bytes up to its end: exactly one link of an A and
  a B token (the next ones where one side has no end there).  Rows with both ends close
  a group;
* ``Table.group_by`` counts the pairs of a document and of a block.  Spark adds the
  blocks' counts up, finds the highest one per B id, and hands each block the counts of
  its own pairs; no table of all pairs is sent to every task.

Defined results: a null or empty text, or one whose bytes either tokenizer changes, has
no tokens: zeros and empty lists.  Rows that agree in doc_id are aligned each; an empty
table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.common import text_blocks, utf8, whole_text
from dwellspark.llm.tokens import SPACE, BlockTokenizer, tokenizer

ALIGNED = ("block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
           "pairs array<int>, pair_links array<int>, block_a array<int>, block_b array<int>, block_links array<bigint>")


class PieceTokenizer(BlockTokenizer):
    """A sentencepiece BPE over blocks in which every document has its leading space.

    No piece has a space after another character, so merges never cross a space that
    follows one: such units are encoded once each.  The library puts a space before what
    it encodes, so a unit goes without its first space.
    """

    def __init__(self, path: str, most: int = 2_000_000):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.most, self.added, self.whole_bytes = most, [], False
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece crosses a space")
        self.blank = self.model.piece_to_id("▁")
        self.bytes_of = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                         for i, p in enumerate(pieces)]
        self._forget()

    def units(self, data: np.ndarray, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        blank = data == 0x20
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:-1] = blank[1:] & ~blank[:-1]
        cut[doc_at] = True
        cut[len(data)] = False
        return np.flatnonzero(cut), np.where(blank, SPACE, 0)

    def _each(self, units: list[bytes]) -> list[list[int]]:
        ids = self.model.encode([u[1:].decode() for u in units], num_threads=1)
        return [[self.blank] if u == b" " else x for u, x in zip(units, ids)]

    def _direct(self, raw: bytes, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = self._each([raw[i:j] for i, j in zip(doc_at[:-1], doc_at[1:])])
        at = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)
        return np.fromiter((i for x in parts for i in x), dtype=np.uint32, count=int(at[-1])), at


_byte = {}


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves, the other bytes, in order, for the
    characters from U+0100 on.
    """
    if not _byte:
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in own]
        _byte.update({chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)})
    return _byte


class Entries:
    """The bytes of a tokenizer's ids."""

    def __init__(self, names: list[bytes]):
        self.length = np.array([len(x) for x in names], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.length)[:-1]))
        self.data = np.frombuffer(b"".join(names), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        upto = np.cumsum(n)
        return self.data[np.arange(int(n.sum())) + np.repeat(self.first[ids] - (upto - n), n)]


_kept: dict[tuple[str, str], tuple] = {}


def both(path_a: str, path_b: str) -> tuple[BlockTokenizer, Entries, PieceTokenizer, Entries]:
    """The two tokenizers of a Python worker, with their ids' bytes."""
    if (path_a, path_b) not in _kept:
        a, b = tokenizer(path_a, plain=True), PieceTokenizer(path_b)
        size = a.tok.get_vocab_size(with_added_tokens=True)
        byte = byte_of_char()
        names = [bytes(byte[c] for c in x) if all(c in byte for c in x) else x.encode()
                 for x in (a.tok.id_to_token(i) or "" for i in range(size))]
        _kept[path_a, path_b] = a, Entries(names), b, Entries(b.bytes_of)
    return _kept[path_a, path_b]


def same_bytes(ids: np.ndarray, at: np.ndarray, entries: Entries, data: np.ndarray, doc_at: np.ndarray) -> np.ndarray:
    """Which documents' tokens make up their bytes."""
    upto = np.concatenate(([0], np.cumsum(entries.length[ids])))[at]
    ok = np.diff(upto) == np.diff(doc_at)
    mine, its = np.repeat(ok, np.diff(upto)), np.repeat(ok, np.diff(doc_at))
    differ = entries.joined(ids)[mine] != data[its]
    if differ.any():
        doc = np.repeat(np.arange(len(ok)), np.where(ok, np.diff(doc_at), 0))
        ok[np.unique(doc[differ])] = False
    return ok


def token_table(ids: np.ndarray, at: np.ndarray, entries: Entries, keep: pa.Array, name: str) -> pa.Table:
    """doc, end, and the token's place in the block, for the documents in ``keep``."""
    lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))).filter(keep)
    token, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    run = pc.cumulative_sum(pa.array(entries.length).take(token))
    before = np.concatenate(([0], run.to_numpy()))[np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))[:-1]]
    end = pc.subtract(run, pa.array(before).take(doc))
    return pa.table({"doc": doc.cast(pa.int64()), "end": end, f"i_{name}": pa.array(np.arange(len(token))), f"id_{name}": token})


MARKS = pa.array([",", "|", ";", ""])


def group_texts(a: pa.Table, b: pa.Table, cut_a: np.ndarray, cut_b: np.ndarray, n_docs: int) -> pa.Array:
    """``a1,a2|b1;a3|b2`` of each document; cut_a, cut_b: the last token of each group."""
    na, nb = len(a), len(b)
    group_a = np.searchsorted(cut_a, np.arange(na))
    group_b = np.searchsorted(cut_b, np.arange(nb))
    place_a = np.arange(na) + np.concatenate(([0], cut_b + 1))[group_a]
    place_b = np.arange(nb) + (cut_a + 1)[group_b]
    doc_a, doc_b = a["doc"].to_numpy(), b["doc"].to_numpy()
    mark = np.zeros(na + nb, dtype=np.int8)  # places in MARKS
    mark[place_a[cut_a]] = 1
    mark[place_b[cut_b]] = 2
    doc = np.empty(na + nb, dtype=np.int64)
    doc[place_a], doc[place_b] = doc_a, doc_b
    last = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) if len(doc) else np.zeros(0, np.int64)
    mark[last] = 3
    order = np.empty(na + nb, dtype=np.int64)
    order[place_a], order[place_b] = np.arange(na), na + np.arange(nb)
    ids = pa.concat_arrays([a["id_a"].combine_chunks(), b["id_b"].combine_chunks()]).take(pa.array(order))
    text = pc.binary_join_element_wise(ids.cast(pa.string()), MARKS.take(pa.array(mark)), "")
    at = np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(at), text), "")


def links_of(a: pa.Table, b: pa.Table) -> pa.Table:
    """A row per link, in order: doc, end, i_a, i_b, both tokens' ids; ``closes``: the group ends there."""
    rows = a.join(b, ["doc", "end"], join_type="full outer", use_threads=False).sort_by([("doc", "ascending"), ("end", "ascending")])
    closes = pc.and_(rows["i_a"].is_valid(), rows["i_b"].is_valid())
    columns = {c: pc.fill_null_backward(rows[c].combine_chunks()) for c in ("i_a", "i_b", "id_a", "id_b")}
    return pa.table({"doc": rows["doc"], "end": rows["end"], **columns, "closes": closes})


def align(docs: DataFrame, *, path_a: str, path_b: str, block_bytes: int = 1 << 19) -> DataFrame:
    """One row per document (see ``ALIGNED``).

    ``groups`` is the alignment as text.  ``pairs`` are the distinct (A id, B id) pairs
    that the document links, as places in its block's list, with their numbers of links
    in ``pair_links``.  The block's list stands in the first row of the block
    (``block_a``, ``block_b``, ``block_links``), empty elsewhere.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok_a, entries_a, tok_b, entries_b = both(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text_blocks(batch, block_bytes):
                yield aligned(part, block, tok_a, entries_a, tok_b, entries_b)
                block += 1

    return docs.select("doc_id", whole_text("text").alias("text")).mapInArrow(blocks, ALIGNED)


def aligned(part: pa.RecordBatch, block: int, tok_a, entries_a: Entries, tok_b, entries_b: Entries) -> pa.RecordBatch:
    data, at = utf8(part.column("text"))
    n_docs = part.num_rows
    filled = np.diff(at) > 0
    data = np.insert(data, at[:-1], 0x20)
    at = at + np.arange(len(at))
    ids_a, at_a = tok_a.encode(data, at)
    ids_b, at_b = tok_b.encode(data, at)
    ok = filled & same_bytes(ids_a, at_a, entries_a, data, at) & same_bytes(ids_b, at_b, entries_b, data, at)
    keep = pa.array(ok)
    a, b = token_table(ids_a, at_a, entries_a, keep, "a"), token_table(ids_b, at_b, entries_b, keep, "b")
    links = links_of(a, b)
    n_kept = int(ok.sum())

    def per_doc(doc: np.ndarray) -> np.ndarray:
        out = np.zeros(n_docs, dtype=np.int64)
        out[ok] = np.bincount(doc, minlength=n_kept)
        return out

    cuts = links.filter(links["closes"])
    texts = group_texts(a, b, cuts["i_a"].to_numpy(), cuts["i_b"].to_numpy(), n_kept)
    texts = texts.take(pa.array(np.cumsum(ok) - 1, mask=~ok)).fill_null("")
    width = len(entries_b.length)
    pair = pc.add(pc.multiply(links["id_a"].cast(pa.int64()), width), links["id_b"].cast(pa.int64()))
    mine = pa.table({"doc": links["doc"], "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    mine = mine.sort_by([("doc", "ascending"), ("pair", "ascending")])
    whole = mine.group_by("pair", use_threads=False).aggregate([("count_all", "sum")]).sort_by("pair")
    codes = whole["pair"].to_numpy()
    first = np.zeros(n_docs, dtype=np.int64)
    first[:1] = len(codes)
    from_to = lambda n: pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
    once, by_doc = from_to(first), from_to(per_doc(mine["doc"].to_numpy()))
    lists = lambda at_, values, kind: pa.ListArray.from_arrays(at_, pa.array(values, kind))
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n_docs, block)), part.column("doc_id"), pa.array(per_doc(a["doc"].to_numpy())),
        pa.array(per_doc(b["doc"].to_numpy())), pa.array(per_doc(cuts["doc"].to_numpy())),
        pa.array(per_doc(links["doc"].to_numpy())), texts,
        lists(by_doc, np.searchsorted(codes, mine["pair"].to_numpy()).astype(np.int32), pa.int32()),
        lists(by_doc, mine["count_all"].to_numpy().astype(np.int32), pa.int32()),
        lists(once, (codes // width).astype(np.int32), pa.int32()), lists(once, (codes % width).astype(np.int32), pa.int32()),
        lists(once, whole["count_all_sum"].to_numpy().astype(np.int64), pa.int64())],
        [c.split()[0] for c in ALIGNED.split(", ")])


def block_pairs(alignment: DataFrame) -> DataFrame:
    """block, place, id_a, id_b, links: the distinct pairs of each block."""
    pair = F.posexplode(F.arrays_zip(F.col("block_a").alias("a"), F.col("block_b").alias("b"), F.col("block_links").alias("n")))
    return alignment.where(F.size("block_a") > 0).select("block", pair.alias("place", "p")).select(
        "block", "place", F.col("p.a").alias("id_a"), F.col("p.b").alias("id_b"), F.col("p.n").alias("links"))


def pair_counts(alignment: DataFrame) -> DataFrame:
    """id_a, id_b, count over all documents, is_best: no other pair of this B id has more."""
    total = block_pairs(alignment).groupBy("id_a", "id_b").agg(F.sum("links").alias("count"))
    most = total.groupBy("id_b").agg(F.max("count").alias("most"))
    return total.join(most, "id_b").select("id_a", "id_b", "count", (F.col("count") == F.col("most")).alias("is_best"))


SCORED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint"


def scored(alignment: DataFrame, carried: str = "") -> DataFrame:
    """Per document the numbers of ``SCORED``, and the columns of the DDL ``carried``.

    The alignment is read twice, so it should be a written table.  A group is one block:
    its documents (at most ``block_bytes`` of text, or one document) and its pairs.
    """
    counts = block_pairs(alignment).join(pair_counts(alignment), ["id_a", "id_b"]).select(
        F.col("block").alias("of"), "place", "count", "is_best")
    more = [c.split()[0] for c in carried.split(", ") if c]
    rows = alignment.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "pairs", "pair_links", *more)

    def add(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        count = np.zeros(len(pairs), dtype=np.int64)
        best = np.zeros(len(pairs), dtype=np.int64)
        place = pairs["place"].to_numpy()
        count[place], best[place] = pairs["count"].to_numpy(), pairs["is_best"].to_numpy().astype(np.int64)
        docs = docs.combine_chunks()
        lists = docs["pairs"].combine_chunks()
        which, n = pc.list_flatten(lists).to_numpy(), pc.list_flatten(docs["pair_links"].combine_chunks()).to_numpy()
        doc = pc.list_parent_indices(lists).to_numpy()
        sums = []
        for value in (best, count):
            run = np.concatenate(([0], np.cumsum(value[which] * n)))
            sums.append(run[np.searchsorted(doc, np.arange(1, len(docs) + 1))] - run[np.searchsorted(doc, np.arange(len(docs)))])
        out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        out = out.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))
        for c in more:
            out = out.append_column(c, docs[c])
        return out

    return rows.groupBy("block").cogroup(counts.groupBy("of")).applyInArrow(add, SCORED + (f", {carried}" if carried else ""))
