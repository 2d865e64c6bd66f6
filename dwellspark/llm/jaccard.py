"""N-gram Jaccard join that skips by set relations.

Documents are sets of word shingles; two link when their Jaccard similarity is at
least ``num / den``.  Answers are not computed pair by pair:

1. Equal sets are one class (128 hash bits and the size); only its smallest
   document goes on.
2. Similar sets share a leader (found by shared minima, checked exactly): the one
   with the fewest rare shingles among them, so that a group's centre leads it.  A
   member's distance to its leader is kept.  Members of one leader need no
   comparison.  A leader's members of like size and distance form a block.  Jaccard
   distance is a metric, so the leaders' answers give the blocks': with leaders at
   distance d and members within r and s of them, no members link if
   d > limit + r + s, and all of them meet in one component if d <= limit.  Only
   blocks in between are compared member by member.
3. Candidate blocks come from an index of prefixes: of its shingles in one global
   order (frequent ones last, then by hash) a set keeps the first n - ceil(t n) + 1,
   since linked sets share one of those.  An index list (one shingle) is cut into
   blocks of like set sizes, and a list longer than ``LIST`` further by owner.  An
   entry knows its position as the number of shingles left from there on; it goes to
   the block of the next larger sizes only if so many are left as the least link to
   a set of that block needs, and is skipped there otherwise.  Inside a block a pair
   of entries counts only if both have enough left for a link of their sizes, and a
   pair of sets stays only if as many entries count as its link needs.
4. What remains is verified on the sets themselves, hot leaders in salted groups.

The order needs document frequencies of all shingles: each block of texts sends its
shingles as packed 24-bit numbers to buckets, which count them.  The frequent ones
are broadcast, at most ``MOST_FREQUENT`` of them (the least frequency rises until
they fit); any order is right, a better one only makes shorter lists.

Defined results: null or wordless texts have an empty set and link with nothing;
texts of fewer words than a shingle are one shingle; rows that share a doc_id, or
have none, but differ in their sets are told apart by a hash of doc_id and text; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.llm.common import cut_lineage, text_blocks, utf8, whole_text
from dwellspark.llm.graph import components
from dwellspark.llm.tokens import run_hashes, spread

MOST_FREQUENT = 2_000_000
SMALL = 1_000_000  # rows of (id, id) that may be broadcast: 16 MB
GROUP = 256
LIST = 8192  # a longer index list is cut into several
RARE = 8  # a shingle of fewer sets than this is rare

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False
ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def word_hashes(data: np.ndarray, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a block (A-Z lowered), and the offsets of the documents in them."""
    word = IS_WORD[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[doc_at] = True
    before = np.concatenate(([False], word[:-1])) if len(word) else word
    after = np.concatenate((word[1:], [False])) if len(word) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return run_hashes(LOWER[data], starts, ends, two=False)[0], np.searchsorted(starts, doc_at)


def shingle_sets(data: np.ndarray, doc_at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct shingle hashes in ascending order, and the documents' offsets in them."""
    words, at = word_hashes(data, doc_at)
    m = np.diff(at)
    per = np.where(m >= n, m - n + 1, np.minimum(m, 1))
    doc = np.repeat(np.arange(len(m)), per)
    if not len(doc):
        return np.zeros(0, np.uint64), np.zeros(len(m) + 1, np.int64)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per) + at[:-1][doc]
    length = np.minimum(m, n)[doc]
    h = ODD[-1] * length.astype(np.uint64)
    padded = np.append(words, np.zeros(n, np.uint64))
    factor = 1
    for k in range(n):
        factor = (factor * int(ODD[k % 7]) + 2 * k | 1) & 0xFFFFFFFFFFFFFFFF
        h += np.where(k < length, padded[first + k] * np.uint64(factor), np.uint64(0))
        h ^= h >> np.uint64(29)
    h = spread(h)
    by = np.argsort(h)
    by = by[np.argsort(doc[by].astype(np.uint16) if len(m) < 65_536 else doc[by], kind="stable")]
    h, doc = h[by], doc[by]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[keep], doc[keep]
    return h, np.searchsorted(doc, np.arange(len(m) + 1))


def _per_block(docs: DataFrame, columns: list[str], make, schema: str) -> DataFrame:
    """``make(part, sets, offsets)`` for each block of texts, giving record batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_blocks(batch):
                yield from make(part, *utf8(part.column("text")))
    return docs.select(*columns, "text").mapInArrow(run, schema)


def set_keys(texts: DataFrame, n: int) -> DataFrame:
    """doc_id, id, n_shingles and two digest words of every text's set."""
    def make(part, data, doc_at):
        sets, at = shingle_sets(data, doc_at, n)
        size = np.diff(at)
        full = np.flatnonzero(size)
        cols = [np.zeros(len(size), np.uint64) for _ in range(2)]
        if len(full):
            cols[0][full] = np.add.reduceat(spread(sets * ODD[1]), at[:-1][full])
            cols[1][full] = np.add.reduceat(spread(sets ^ ODD[2]), at[:-1][full])
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("id"), pa.array(size.astype(np.int64)),
                                          *(pa.array(c.view(np.int64)) for c in cols)], ["doc_id", "id", "n_shingles", "d1", "d2"])
    return _per_block(texts, ["doc_id", "id"], make, "doc_id bigint, id bigint, n_shingles bigint, d1 bigint, d2 bigint")


class Order:
    """The global order of shingles: frequent ones last, by frequency, then by hash."""

    def __init__(self, spark: SparkSession, bits: int, numbers: np.ndarray, df: np.ndarray):
        self.bits, self.shared = bits, spark.sparkContext.broadcast((numbers, df))

    def rank(self, sets: np.ndarray) -> np.ndarray:
        """The frequency of each shingle if it is among the frequent ones, else 0."""
        numbers, df = self.shared.value
        if not len(numbers):
            return np.zeros(len(sets), dtype=np.int64)
        top = sets >> np.uint64(64 - self.bits)
        place = np.minimum(np.searchsorted(numbers, top), len(numbers) - 1)
        return np.where(numbers[place] == top, df[place], 0)


def group_keys(texts: DataFrame, order: Order, n: int) -> DataFrame:
    """id, m1 and m2 (minima over frequent shingles, null without), m3 (minimum over all), rare shingles."""
    def make(part, data, doc_at):
        sets, at = shingle_sets(data, doc_at, n)
        usual = order.rank(sets) > 0
        full = np.flatnonzero(np.diff(at))
        some = np.zeros(len(at) - 1, np.int64)
        cols = [np.zeros(len(at) - 1, np.uint64) for _ in range(3)]
        if len(full):
            from_ = at[:-1][full]
            most = np.uint64(0xFFFFFFFFFFFFFFFF)
            some[full] = np.add.reduceat(usual.astype(np.int64), from_)
            for c, v in zip(cols, (np.where(usual, sets * ODD[3], most), np.where(usual, sets * ODD[4], most), sets)):
                c[full] = np.minimum.reduceat(v, from_)
        none = some == 0
        yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c.view(np.int64), mask=none) for c in cols[:2]),
                                          pa.array(cols[2].view(np.int64)), pa.array(np.diff(at) - some)], ["id", "m1", "m2", "m3", "rare"])
    return _per_block(texts, ["id"], make, "id bigint, m1 bigint, m2 bigint, m3 bigint, rare bigint")


def identified(docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(texts, keys): doc_id, id and text; the keys of the sets.

    The id is the doc_id, unless rows of different sets share one or have none:
    then it is a hash of doc_id and text.
    """
    texts = docs.select("doc_id", F.col("doc_id").alias("id"), whole_text("text").alias("text"))
    keys = cut_lineage(set_keys(texts, n))
    sets = F.struct("n_shingles", "d1", "d2")
    mixed = keys.groupBy("doc_id").agg(F.min(sets).alias("x"), F.max(sets).alias("y")).where("doc_id IS NULL OR x <> y")
    if mixed.isEmpty():
        return texts, keys
    texts = texts.withColumn("id", F.xxhash64("doc_id", "text"))
    return texts, cut_lineage(set_keys(texts, n))


def with_small(left: DataFrame, right: DataFrame, on: str, how: str = "inner", size: int | None = None) -> DataFrame:
    """Join; the right side is broadcast if it has at most ``SMALL`` rows (``size``: no fewer than it has)."""
    size = right.count() if size is None else size
    return left.join(F.broadcast(right) if size <= SMALL else right, on, how)


def similarity(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(a, b, common, size_a, size_b) of the sets of ``pairs`` (a, b), exactly.

    A pair is compared where its ``a`` is: the sets of its ``b`` come there in
    groups of up to about ``GROUP``, each with a copy of a's set.
    """
    pairs = cut_lineage(pairs)
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("long").alias("salts"))
    to_b = pairs.join(many, "a").select(
        F.col("b").alias("id"), F.struct("a", F.pmod(F.xxhash64("b"), "salts").alias("salt"), F.lit(False).alias("own")).alias("to"))
    to_a = many.select(F.col("a").alias("id"), F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("salts") - 1), lambda s: F.struct(F.col("a"), s.alias("salt"), F.lit(True).alias("own")))).alias("to"))
    goals = cut_lineage(to_a.unionByName(to_b))
    n_goals = goals.count()
    needed = goals.select("id").distinct()

    def make(part, data, doc_at):
        sets, at = shingle_sets(data, doc_at, n)
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer((at * 8).astype(np.int64)), pa.py_buffer(sets)])
        yield pa.RecordBatch.from_arrays([part.column("id"), raw.cast(pa.binary())], ["id", "set"])

    sets = _per_block(with_small(texts, needed, "id", "left_semi", n_goals), ["id"], make, "id bigint, set binary")
    rows = with_small(sets, goals, "id", size=n_goals).select("to.a", "to.salt", "to.own", F.col("id").alias("b"), "set")
    buckets = max(1, -(-n_goals // (4 * GROUP)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("a", "salt"), F.lit(buckets)))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (a, _), part in pdf.groupby(["a", "salt"], sort=False).indices.items():
            is_own = pdf["own"].to_numpy()[part]
            own = np.frombuffer(pdf["set"].iat[part[is_own][0]], dtype=np.uint64)
            rest = part[~is_own]
            others = [np.frombuffer(pdf["set"].iat[i], dtype=np.uint64) for i in rest]
            sizes = np.array([len(s) for s in others], dtype=np.int64)
            every = np.concatenate(others) if others else np.zeros(0, np.uint64)
            place = np.minimum(np.searchsorted(own, every), max(len(own) - 1, 0))
            hit = (own[place] == every) if len(own) else np.zeros(len(every), bool)
            total = np.concatenate(([0], np.cumsum(hit)))
            to = np.concatenate(([0], np.cumsum(sizes)))
            out.append((np.full(len(rest), a), pdf["b"].to_numpy()[rest], total[to[1:]] - total[to[:-1]], np.full(len(rest), len(own)), sizes))
        cols = [np.concatenate(c).astype(np.int64) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
        return pd.DataFrame(dict(zip(["a", "b", "common", "size_a", "size_b"], cols)))

    return rows.groupBy("bucket").applyInPandas(compare, "a bigint, b bigint, common bigint, size_a bigint, size_b bigint")


def frequent(texts: DataFrame, total: int, n: int) -> Order:
    """The order by document frequency; shingles are counted by their first hash bits."""
    bucket_bits = max(3, int(total >> 20).bit_length())
    bits = bucket_bits + 24

    def make(part, data, doc_at):
        sets, _ = shingle_sets(data, doc_at, n)
        top = np.sort(sets >> np.uint64(64 - bits))
        at = np.searchsorted(top, np.arange((1 << bucket_bits) + 1, dtype=np.uint64) << np.uint64(24))
        low = (top & np.uint64(0xFFFFFF)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].copy().reshape(-1)
        some = np.flatnonzero(np.diff(at))
        raw = [low[3 * at[i]:3 * at[i + 1]].tobytes() for i in some]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw, pa.binary())], ["bucket", "packed"])

    def count(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        raw = np.frombuffer(b"".join(pdf["packed"]), dtype=np.uint8).reshape(-1, 3).astype(np.int64)
        df = np.bincount(raw[:, 0] | (raw[:, 1] << 8) | (raw[:, 2] << 16), minlength=1 << 24)
        number = np.flatnonzero(df >= RARE)
        return pd.DataFrame({"number": (int(key[0]) << 24) + number, "df": df[number]})

    packed = _per_block(texts, ["id"], make, "bucket bigint, packed binary")
    counted = cut_lineage(packed.groupBy("bucket").applyInPandas(count, "number bigint, df bigint"))
    least, step = RARE, counted
    while step.count() > MOST_FREQUENT:
        least *= 2
        step = counted.where(F.col("df") >= least)
    rows = step.toPandas().sort_values("number")  # MOST_FREQUENT rows at most
    return Order(texts.sparkSession, bits, rows["number"].to_numpy(np.uint64), rows["df"].to_numpy(np.int64))


def prefixes(sets: np.ndarray, at: np.ndarray, order: Order, num: int, den: int) -> tuple[np.ndarray, ...]:
    """The prefix shingles of a block's sets, the set each belongs to, the number left from it on in its set, its rank."""
    size = np.diff(at)
    doc = np.repeat(np.arange(len(size)), size)
    rank = order.rank(sets)
    if rank.any():
        by = np.lexsort((rank, doc))  # stable: equal ranks stay in hash order
        sets, rank = sets[by], rank[by]
    left = at[1:][doc] - np.arange(len(sets))
    inside = left >= -(-size * num // den)[doc]
    return sets[inside], doc[inside], left[inside], rank[inside]


BOTH, HOME, LIKE, LESS = range(4)
"""Roles of an entry in a block: at home there and compared with those at home; at home
only; of like size but at home in another part of the list; from the block of smaller sizes."""


def prefix_index(sets_of: DataFrame, order: Order, n: int, num: int, den: int) -> DataFrame:
    """(t, block, role, owner, span, left): the prefix shingles of every owner's sets, in the blocks of lists they can reach.

    ``span`` packs the owner's least and most set size.  Sizes of a class differ by
    less than linked sizes may (and 1.06, as an owner's sizes differ by 1.05), so
    links only lead to the same class or the next.
    """
    ratio = 1.06 * den / num

    def make(part, data, doc_at):
        t, doc, left, df = prefixes(*shingle_sets(data, doc_at, n), order, num, den)
        owner, span = (part.column(c).to_numpy()[doc] for c in ("owner", "span"))
        by = np.lexsort((-left, owner, t))
        t, owner, span, left, df = t[by], owner[by], span[by], left[by], df[by]
        new = np.ones(len(t), dtype=bool)
        new[1:] = (t[1:] != t[:-1]) | (owner[1:] != owner[:-1])
        t, owner, span, left, df = t[new], owner[new], span[new], left[new], df[new]
        low, high = span >> 32, span & 0xFFFFFFFF
        size_class = np.floor(np.log(low) / np.log(ratio)).astype(np.int64)
        next_size = ratio ** (size_class + 1) * (1 - 1e-9)
        least_left = np.minimum((low + next_size) * num / (num + den), next_size * num / den) - 1e-6
        up = (left >= least_left) & (high * den >= next_size * num - 1e-6)
        cuts = 1 + df // LIST
        own_cut = (spread(owner.view(np.uint64)) % cuts.astype(np.uint64)).astype(np.int64)
        every = np.arange(len(t))
        takes = [(every, own_cut, size_class, np.where(cuts > 1, HOME, BOTH))]
        for which, step, role in ((cuts > 1, 0, LIKE), (up, 1, LESS)):
            at = np.repeat(every[which], cuts[which])
            cut = np.arange(len(at)) - np.repeat(np.cumsum(cuts[which]) - cuts[which], cuts[which])
            takes.append((at, cut, size_class[at] + step, np.full(len(at), role)))
        at, cut, size_class, role = (np.concatenate(x) for x in zip(*takes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(t[at].view(np.int64)), pa.array((cut * 1024 + size_class).astype(np.int32)), pa.array(role.astype(np.int8)),
             pa.array(owner[at]), pa.array(span[at]), pa.array(left[at].astype(np.int32))], ["t", "block", "role", "owner", "span", "left"])

    return _per_block(sets_of, ["owner", "span"], make, "t bigint, block int, role tinyint, owner bigint, span bigint, left int")


def prefix_sets(sets_of: DataFrame, order: Order, n: int, num: int, den: int) -> DataFrame:
    """(id, prefix): the prefix shingles of every set."""
    def make(part, data, doc_at):
        t, doc, _, _ = prefixes(*shingle_sets(data, doc_at, n), order, num, den)
        to = np.searchsorted(doc, np.arange(len(doc_at))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(to), pa.array(t.view(np.int64)))], ["id", "prefix"])

    return _per_block(sets_of, ["id"], make, "id bigint, prefix array<bigint>")


def overlap_needed(x: Column, y: Column, num: int, den: int) -> Column:
    """The least intersection of linked sets of sizes x and y."""
    return F.ceil((x + y) * F.lit(num) / F.lit(num + den) - F.lit(1e-9))


def after_prefix(size: Column, num: int, den: int) -> Column:
    return F.ceil(size * num / den - F.lit(1e-9)) - 1


def candidates(index: DataFrame, leaders: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of blocks of different leaders whose sets may link, with both leaders."""
    index = index.repartition("t", "block").groupBy("t", "block", "role", "owner", "span").agg(F.max("left").alias("left"))
    left, right = index.alias("l"), index.alias("r")
    low, high = (lambda c: F.shiftright(c, 32)), (lambda c: c.bitwiseAND(0xFFFFFFFF))
    sa, sb = F.col("l.span"), F.col("r.span")
    size = (high(sa) * den >= low(sb) * num) & (high(sb) * den >= low(sa) * num)
    # both roles in one expression: a filter of one side would be pushed down, and the index be made twice
    roles = F.col("l.role") * 4 + F.col("r.role")
    meet = roles.isin([4 * LESS + BOTH, 4 * LESS + HOME]) | (
        roles.isin([4 * x + y for x in (BOTH, LIKE) for y in (BOTH, HOME)]) & (F.col("l.owner") < F.col("r.owner")))
    needed = lambda x, y: overlap_needed(low(x), low(y), num, den)
    rest = lambda x, y: after_prefix(F.greatest(high(x), high(y)), num, den)
    enough = F.least("l.left", "r.left") >= F.least(needed(sa, sb), rest(sa, sb) + 1)
    some = (left.join(right, (F.col("l.t") == F.col("r.t")) & (F.col("l.block") == F.col("r.block")) & meet & size & enough)
            .groupBy(F.col("l.owner").alias("a"), F.col("r.owner").alias("b"), sa.alias("sa"), sb.alias("sb"))
            .agg(F.count("*").alias("shared")).where(F.col("shared") + rest(F.col("sa"), F.col("sb")) >= needed(F.col("sa"), F.col("sb"))))
    x = leaders.select(F.col("owner").alias("a"), F.col("leader").alias("la"))
    y = leaders.select(F.col("owner").alias("b"), F.col("leader").alias("lb"))
    return some.join(x, "a").join(y, "b").where(F.col("la") != F.col("lb")).select("a", "b", "la", "lb")


def choose_leaders(sets: DataFrame, texts_of: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(id, leader, apart, common, size_a, size_b) of the sets that have a leader within the limit.

    ``sets``: class_id, n_shingles, rare and the minima m1 to m3.  In a group of one
    minimum the set with the fewest rare shingles leads (of these the least id).  All
    groups' pairs are verified together.  A set that has a leader leads none, and of
    several leaders a set has the nearest.
    """
    lead = F.min(F.struct("rare", F.col("class_id").alias("leader"), F.col("n_shingles").alias("n_l")))
    minima = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(m).alias("m")) for k, m in enumerate(("m1", "m2", "m3"))]))
    free = sets.select("class_id", "n_shingles", "rare", minima.alias("x")).select("class_id", "n_shingles", "rare", "x.*").where("m IS NOT NULL")
    low = free.groupBy("k", "m").agg(lead.alias("l"), F.count("*").alias("size")).where("size > 1").select(
        "k", "m", "l.leader", "l.n_l", F.col("l.rare").alias("rare_l"))
    pairs = free.join(low, ["k", "m"]).where("class_id <> leader")
    # frequent shingles can only be shared with frequent ones, rare with rare
    most = (F.least(F.col("n_shingles") - F.col("rare"), F.col("n_l") - F.col("rare_l")) + F.least("rare", "rare_l"))
    pairs = pairs.where(most >= overlap_needed(F.col("n_shingles"), F.col("n_l"), num, den))
    near = similarity(pairs.select(F.col("leader").alias("a"), F.col("class_id").alias("b")).distinct(), texts_of, n)
    near = cut_lineage(near.where(linked(num, den)).withColumn("apart", distance()))
    led = near.join(near.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
    nearest = F.min(F.struct("apart", F.col("a").alias("leader"), "common", "size_a", "size_b"))
    return cut_lineage(led.groupBy(F.col("b").alias("id")).agg(nearest.alias("l")).select(
        "id", "l.leader", "l.apart", "l.common", "l.size_a", "l.size_b"))


def distance() -> Column:
    return 1 - F.col("common") / (F.col("size_a") + F.col("size_b") - F.col("common"))


def linked(num: int, den: int) -> Column:
    return F.col("common") * den >= (F.col("size_a") + F.col("size_b") - F.col("common")) * num


def jaccard_join(docs: DataFrame, *, shingle: int = 5, num: int = 75, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """(members, links).

    members: doc_id, n_shingles, class_id (smallest id with an equal set),
    leader_id, component_id (smallest doc_id reachable by links).
    links: (a, b, common, size_a, size_b), verified links between classes that
    connect all of a component; further pairs of linked clusters are implied.
    """
    limit = 1 - num / den
    texts, keys = identified(docs, shingle)
    same = ["n_shingles", "d1", "d2"]
    full = keys.where("n_shingles > 0")
    classes = cut_lineage(full.groupBy(*same).agg(F.min("id").alias("class_id")))
    total, n_classes = classes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count("*")).first()
    texts_of = with_small(texts.select("id", "text"), classes.select(F.col("class_id").alias("id")), "id", "left_semi", n_classes)
    order = frequent(texts_of, total, shingle)
    sets = cut_lineage(group_keys(texts_of, order, shingle).withColumnRenamed("id", "class_id").dropDuplicates(["class_id"])
                       .join(classes.select("class_id", "n_shingles"), "class_id"))
    assigned = choose_leaders(sets, texts_of, shingle, num, den)

    # blocks: a leader's members of like size and distance
    owners = sets.select("class_id", "n_shingles").join(assigned.select(F.col("id").alias("class_id"), "leader", "apart"), "class_id", "left")
    owners = owners.select("class_id", "n_shingles", F.coalesce("leader", "class_id").alias("leader"), F.coalesce("apart", F.lit(0.0)).alias("apart"))
    like = ["leader", F.floor(F.log("n_shingles") / F.log(F.lit(1.05))).alias("size_like"), F.ceil(F.col("apart") * 20).alias("apart_like")]
    owners = owners.select("class_id", "n_shingles", "apart", *like)
    like = ["leader", "size_like", "apart_like"]
    bounds = cut_lineage(owners.groupBy(*like).agg(F.min("class_id").alias("owner"), F.min("n_shingles").alias("low"),
                                                   F.max("n_shingles").alias("high"), F.max("apart").alias("radius")))
    owners = cut_lineage(owners.join(bounds.select(*like, "owner"), like).select("class_id", "n_shingles", "leader", "apart", "owner"))
    span = (F.shiftleft(F.col("low"), 32) + F.col("high")).alias("span")
    spans = owners.select(F.col("class_id").alias("id"), "owner").join(bounds.select("owner", span), "owner")
    mapped = with_small(texts_of, spans.select("id", "owner", "span"), "id", size=n_classes)
    maybe = cut_lineage(candidates(prefix_index(mapped, order, shingle, num, den), bounds.select("owner", "leader"), num, den))
    heads = maybe.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()
    judged = cut_lineage(similarity(heads, texts_of, shingle))
    link = ["a", "b", "common", "size_a", "size_b"]
    links = cut_lineage(judged.where(linked(num, den)).select(*link).unionByName(
        assigned.select(F.col("leader").alias("a"), F.col("id").alias("b"), "common", "size_a", "size_b")))
    of = components(links.select("a", "b"))

    # blocks that the leaders' distance neither joins nor parts, and that nothing else joins
    apart = judged.where(~linked(num, den)).select(F.col("a").alias("l1"), F.col("b").alias("l2"), distance().alias("heads_apart"))
    radius = bounds.select("owner", "radius")
    open_ = (maybe.join(apart, (F.least("la", "lb") == F.col("l1")) & (F.greatest("la", "lb") == F.col("l2")))
             .join(radius.select(F.col("owner").alias("a"), F.col("radius").alias("ra")), "a")
             .join(radius.select(F.col("owner").alias("b"), F.col("radius").alias("rb")), "b")
             .where("ra + rb > 0").where(F.col("heads_apart") <= F.col("ra") + F.col("rb") + limit + 1e-9)
             .join(of.select(F.col("id").alias("la"), F.col("component").alias("ca")), "la", "left")
             .join(of.select(F.col("id").alias("lb"), F.col("component").alias("cb")), "lb", "left")
             .where(F.coalesce("ca", "la") != F.coalesce("cb", "lb")).select("a", "b", "heads_apart"))
    open_ = cut_lineage(open_)
    if not open_.isEmpty():
        links = cut_lineage(links.unionByName(_member_links(open_, owners, texts_of, order, shingle, num, den)))
        of = components(links.select("a", "b"))
    order.shared.destroy()  # what is left reads checkpoints only

    of = of.withColumnRenamed("id", "class_id")
    members = (classes.join(owners.select("class_id", F.col("leader").alias("leader_id")), "class_id").join(of, "class_id", "left"))
    members = full.select("doc_id", *same).join(members, same).withColumn("component", F.coalesce("component", "class_id"))
    names = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    members = members.join(names, "component").select("doc_id", "n_shingles", "class_id", "leader_id", "component_id")
    empty = keys.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("id").alias("class_id"), F.col("id").alias("leader_id"), F.col("doc_id").alias("component_id"))
    return members.unionByName(empty), links


def _member_links(open_: DataFrame, owners: DataFrame, texts_of: DataFrame, order: Order,
                  n: int, num: int, den: int) -> DataFrame:
    """Links between members of the block pairs ``open_`` (a, b, heads_apart).

    The members of the smaller block go to those of the larger one with their
    prefixes; a pair leaves that join only if it passes all bounds.
    """
    limit = 1 - num / den
    both = open_.select("a").unionByName(open_.select(F.col("b").alias("a"))).distinct().withColumnRenamed("a", "owner")
    some = cut_lineage(owners.select(F.col("class_id").alias("id"), "owner", "apart", "n_shingles").join(both, "owner", "left_semi"))
    texts = with_small(texts_of, some.select("id"), "id", "left_semi")
    some = cut_lineage(prefix_sets(texts, order, n, num, den).dropDuplicates(["id"]).join(some, "id"))
    count = some.groupBy("owner").agg(F.count("*").alias("k"))
    sized = (open_.join(count.select(F.col("owner").alias("a"), F.col("k").alias("ka")), "a")
             .join(count.select(F.col("owner").alias("b"), F.col("k").alias("kb")), "b"))
    first = F.col("ka") <= F.col("kb")
    sized = sized.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("few"),
                         F.when(first, F.col("b")).otherwise(F.col("a")).alias("many"), "heads_apart")
    x = some.select(F.col("owner").alias("few"), F.col("id").alias("x"), F.col("prefix").alias("qx"), F.col("apart").alias("px"), F.col("n_shingles").alias("nx"))
    y = some.select(F.col("owner").alias("many"), F.col("id").alias("y"), F.col("prefix").alias("qy"), F.col("apart").alias("py"), F.col("n_shingles").alias("ny"))
    x = sized.join(x, "few")
    rest = after_prefix(F.greatest("nx", "ny"), num, den)
    near = ((x["many"] == y["many"]) & (F.col("heads_apart") <= F.col("px") + F.col("py") + limit + 1e-9)
            & (F.col("nx") * den >= F.col("ny") * num) & (F.col("ny") * den >= F.col("nx") * num)
            & (F.size(F.array_intersect("qx", "qy")) + rest >= overlap_needed(F.col("nx"), F.col("ny"), num, den)))
    pairs = x.join(y, near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    judged = similarity(pairs, texts_of, n)
    return judged.where(linked(num, den)).select("a", "b", "common", "size_a", "size_b")
