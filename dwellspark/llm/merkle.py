"""Merkle manifest of a dataset by bitmap ranks.

A row's leaf is a hash of its fields.  Inside a group (``lang``) the leaves stand by
ascending doc_id, every ``FAN`` consecutive nodes have a parent until one is left, and
the groups' roots form a tree of the same kind.

Where a leaf stands is found without sorting the rows:

* the doc_ids of a group are a bitmap of 64-bit words, of which only words with a bit are
  kept (one ``bit_or`` with partial aggregation);
* a directory of popcounts over the words, a radix tree of fan-out ``RADIX``: each level
  sums the level below and numbers the children of one parent, so no window holds more
  than ``RADIX`` rows.  It gives each word the number of rows before it in its group;
* a row's rank is its word's number and the popcount of the lower bits of its word.

Rows with a rank go to slot arrays, keyed by (group, rank div ``FAN ** depth``).  An array
gives ``depth`` levels of its tree at once, and its top node goes to the next level's
array, so a few rounds do for any table.  Proofs come back down the
same way: a leaf's siblings are those in its array and those of its array's top node.

Defined results: rows that agree in group and doc_id (or lack a doc_id, which stands
first) are ordered by their leaves; they alone are sorted, by ranges.  Nulls are leaves
like others, a null group is a group and stands first.  Empty texts are fields of zero
bytes.  An empty table has no rows.  Columns that are not named are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.llm.common import utf8, written
from dwellspark.operators.ordered import running_sums
from dwellspark.session import cut_lineage

FAN = 8
RADIX_BITS = 12
Batches = Iterator[pa.RecordBatch]
NODES = "g string, rank bigint, n_level bigint, hash binary"
LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))
LEAVES = "doc_id bigint, lang string, leaf binary, altered binary"


def digest(*parts: bytes) -> bytes:
    """SHA-256 as lowercase hex text."""
    return sha256(b"".join(parts)).hexdigest().encode()


def third_of_ids(doc_id: int | None) -> bool:
    """Where 3 divides the crc32 of the decimal doc_id; never without a doc_id."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def leaves(docs: DataFrame, tampered: Callable[[int | None], bool] = third_of_ids) -> DataFrame:
    """doc_id, lang, leaf, and the leaf of the row with its text lower-cased where ``tampered``.

    Digests are 32 bytes.  ``altered`` is null where the row is as it was.
    """
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column("text"))
            data = data.tobytes()
            fields = [batch.column(c).to_pylist() for c in ("doc_id", "source", "lang", "n_chars")]
            missing = batch.column("text").is_null().to_pylist()
            leaf, altered = [], []
            for k, row in enumerate(zip(*fields)):
                head = b"".join(b"-" if v is None else b"%d:%b" % (len(x := str(v).encode()), x) for v in row)
                text = data[at[k]:at[k + 1]]
                size = b"-" if missing[k] else b"%d:" % len(text)
                leaf.append(sha256(head + size + text).digest())
                altered.append(sha256(head + size + text.translate(LOWER)).digest() if tampered(row[0]) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("lang"), pa.array(leaf, pa.binary()), pa.array(altered, pa.binary())],
                ["doc_id", "lang", "leaf", "altered"])

    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    kinds = ["long", "string", "string", "long", "string"]
    return docs.select(*[F.col(c).cast(k) for c, k in zip(columns, kinds)]).mapInArrow(hashed, LEAVES)


def _word(ids: Column) -> Column:
    return F.shiftright(ids, 6)


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def word_directory(rows: DataFrame) -> DataFrame:
    """g, w, bits, n_rows, before (rows of the group in lower words), n_group: one row per non-empty word.

    ``g`` is the group, ``w`` the word of a doc_id (null: no doc_id).
    """
    bit = F.expr("shiftleft(1L, cast(doc_id & 63 AS int))")
    words = cut_lineage(rows.groupBy(F.col("lang").alias("g"), _word(F.col("doc_id")).alias("w")).agg(
        F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n_rows")))
    span = words.agg(F.min("w").alias("lo"), F.max("w").alias("hi")).first()
    lo, hi = (0, 0) if span["lo"] is None else (span["lo"], span["hi"])
    # the null word takes place 0, before all others
    level = words.withColumn("key", F.coalesce(F.col("w") - F.lit(lo) + 1, F.lit(0)))
    levels, spread = [level], hi - lo + 1
    while spread:
        spread >>= RADIX_BITS
        level = level.groupBy("g", F.shiftright("key", RADIX_BITS).alias("key")).agg(F.sum("n_rows").alias("n_rows"))
        levels.append(level)
    top = levels.pop().select(F.col("g").alias("pg"), F.col("key").alias("pkey"), F.lit(0).cast("long").alias("start"),
                              F.col("n_rows").alias("n_group"))
    while levels:
        level = levels.pop().withColumn("parent", F.shiftright("key", RADIX_BITS))
        earlier = Window.partitionBy("g", "parent").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("inner", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)))
        joined = level.join(top, _same("g", "pg") & (F.col("parent") == F.col("pkey")))
        down = joined.withColumn("before", F.col("start") + F.col("inner"))
        top = down.select(F.col("g").alias("pg"), F.col("key").alias("pkey"), F.col("before").alias("start"), "n_group")
    return down.select("g", "w", "bits", "n_rows", "before", "n_group")


def ranked(rows: DataFrame) -> DataFrame:
    """The rows of a written table with ``rank`` in their group (from 0) and ``n_group``, its size."""
    directory = cut_lineage(word_directory(rows))
    found = rows.withColumn("word", _word(F.col("doc_id"))).join(directory, _same("lang", "g") & _same("word", "w"))
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(doc_id & 63 AS int)))")
    alone = F.coalesce(F.bit_count("bits"), F.lit(0)) == F.col("n_rows")
    carried = ["doc_id", "lang", "leaf", "altered", "n_group"]
    single = found.where(alone).select(*carried, (F.col("before") + below).alias("rank"))
    if directory.where(~alone).isEmpty():
        return single
    # words with repeated or missing doc_ids: a running count by ranges of (group, doc_id, leaf)
    several = found.where(~alone).select(*carried, "word", "before", F.xxhash64("leaf", F.monotonically_increasing_id()).alias("tie"),
                                         F.col("lang").isNotNull().alias("named"), F.col("doc_id").isNotNull().alias("has_id"),
                                         F.lit(1).alias("one"))
    # a null takes the place of "" or 0 in the order, behind its own flag
    several = several.withColumns({"o_lang": F.coalesce("lang", F.lit("")), "o_id": F.coalesce("doc_id", F.lit(0))})
    counted = cut_lineage(running_sums(several, ["named", "o_lang", "has_id", "o_id", "leaf", "tie"], {"nth": "one"}))
    first = counted.groupBy(F.col("lang").alias("fl"), F.col("word").alias("fw")).agg(F.min("nth").alias("first"))
    numbered = counted.join(first, _same("lang", "fl") & _same("word", "fw"))
    return single.unionByName(numbered.select(*carried, (F.col("before") + F.col("nth") - F.col("first")).alias("rank")))


def levels_of(nodes: list[bytes], n_level: int, depth: int) -> list[list[bytes]]:
    """The nodes of one slot array and the levels above them; ``n_level``: nodes of its whole level."""
    out = [nodes]
    while n_level > 1 and len(out) <= depth:
        last = out[-1]
        out.append([digest(*last[k:k + FAN]) for k in range(0, len(last), FAN)])
        n_level = -(-n_level // FAN)
    return out


def siblings(levels: list[list[bytes]], k: int) -> list[tuple[bytes, bytes]]:
    """Per level (those to the left, those to the right) of a slot's path."""
    path = []
    for nodes in levels[:-1]:
        run = k - k % FAN
        path.append((b"".join(nodes[run:k]), b"".join(nodes[k + 1:run + FAN])))
        k //= FAN
    return path


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for left, right in path:
        leaf = digest(left, leaf, right)
    return leaf


def _split(slots: bytes) -> list[bytes]:
    return [slots[k:k + 64] for k in range(0, len(slots), 64)]


PATH = "array<struct<left: binary, right: binary>>"


def reduced(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """Slot arrays of all levels: g, key, n_level, slots (hex digests in a row).

    ``nodes`` has g, rank, n_level and hash (64 bytes of hex).  The arrays of one level
    give the nodes of the next; a written table each.
    """
    arrays, n = [], 1
    while True:
        slot = F.array_sort(F.collect_list(F.struct("rank", "hash")))
        joined = F.concat_ws("", F.transform(slot, lambda s: s["hash"].cast("string"))).cast("binary")
        level = written(nodes.groupBy("g", _key(depth)).agg(
            F.max("n_level").alias("n_level"), joined.alias("slots")), "merkle-level")
        arrays.append(level)
        n = level.agg(F.max("n_level")).first()[0] or 0
        if n <= FAN ** depth:
            return arrays
        nodes = level.mapInArrow(lambda b: _tops(b, depth), NODES)


def _key(depth: int) -> Column:
    return F.expr(f"rank div {FAN ** depth}").alias("key")


def _tops(batches: Batches, depth: int) -> Batches:
    """The top node of each slot array, as a node of the next level."""
    for batch in batches:
        out = []
        for g, key, n, slots in zip(*(batch.column(c).to_pylist() for c in ("g", "key", "n_level", "slots"))):
            above = n
            for _ in range(depth):
                above = -(-above // FAN)
            out.append((g, key, above, levels_of(_split(slots), n, depth)[-1][0]))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(
            (pa.string(), pa.int64(), pa.int64(), pa.binary()))], ["g", "rank", "n_level", "hash"])


def _as_path(path: list[tuple[bytes, bytes]]) -> list[dict]:
    return [{"left": a, "right": b} for a, b in path]


def _from_path(path: list[dict] | None) -> list[tuple[bytes, bytes]]:
    return [(p["left"], p["right"]) for p in path or ()]


NODE_PATHS = f"g string, rank bigint, top binary, path {PATH}"
_PATH_TYPE = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))


def _paths(batches: Batches, depth: int) -> Batches:
    """Per slot of an array with the path above it: its own path to the top."""
    for batch in batches:
        for k in range(batch.num_rows):
            g, key, n, slots, above, top = (batch.column(c)[k].as_py() for c in ("g", "key", "n_level", "slots", "above", "top"))
            tree = levels_of(_split(slots), n, depth)
            top = top if top is not None else tree[-1][0]
            rest = _from_path(above)
            rows = [(g, key * FAN ** depth + i, top, _as_path(siblings(tree, i) + rest)) for i in range(len(tree[0]))]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.binary(), _PATH_TYPE))], ["g", "rank", "top", "path"])


def paths_above(arrays: list[DataFrame], depth: int) -> DataFrame:
    """The lowest level's arrays with ``above`` (siblings of the top node) and ``top`` (the group's root).

    Both are null where the array is its group's only one.
    """
    upper = None
    for level in reversed(arrays):
        if upper is None:
            found = level.select("*", F.lit(None).cast(PATH).alias("above"), F.lit(None).cast("binary").alias("top"))
        else:
            up = upper.select(F.col("g").alias("ug"), F.col("rank").alias("ukey"), F.col("path").alias("above"), "top")
            found = level.join(up, _same("g", "ug") & (F.col("key") == F.col("ukey")), "left").drop("ug", "ukey")
        if level is arrays[0]:
            return found
        upper = found.mapInArrow(lambda b: _paths(b, depth), NODE_PATHS)


def manifest(docs: DataFrame, tampered: Callable[[int | None], bool] = third_of_ids, depth: int = 2) -> DataFrame:
    """doc_id, lang, rank, leaf, altered, subroot, root, path: hex digests (binary), and a leaf's
    siblings level by level up to the root as (left, right) runs of hex digests.

    A slot array holds ``FAN ** depth`` nodes.
    """
    rows = written(leaves(docs, tampered), "merkle-leaves")
    placed = written(ranked(rows), "merkle-ranks")
    nodes = placed.select(F.col("lang").alias("g"), "rank", F.col("n_group").alias("n_level"),
                          F.lower(F.hex("leaf")).cast("binary").alias("hash"))
    arrays = reduced(nodes, depth)
    tops = arrays[-1].mapInArrow(lambda b: _tops(b, depth), NODES)  # the groups' roots
    order = tops.select("g", "hash", F.col("g").isNotNull().alias("named"), F.coalesce("g", F.lit("")).alias("name"), F.lit(1).alias("one"))
    groups = cut_lineage(running_sums(order, ["named", "name"], {"nth": "one"}))
    n_groups = groups.count()
    top_nodes = groups.select(F.lit(None).cast("string").alias("g"), (F.col("nth") - 1).alias("rank"),
                              F.lit(n_groups).cast("long").alias("n_level"), "hash")
    top_paths = paths_above(reduced(top_nodes, depth), depth).mapInArrow(lambda b: _paths(b, depth), NODE_PATHS)
    of_group = groups.select("g", (F.col("nth") - 1).alias("k"), F.col("hash").alias("subroot")).join(
        top_paths.select(F.col("rank").alias("k"), F.col("top").alias("root"), F.col("path").alias("group_path")), "k").drop("k")
    of_group = cut_lineage(of_group).withColumnRenamed("g", "of")
    lowest = paths_above(arrays, depth).join(of_group, _same("g", "of")).select(
        F.col("g").alias("ag"), F.col("key").alias("akey"), "n_level", "slots", "above", "subroot", "root", "group_path")
    slotted = placed.groupBy("lang", _key(depth)).agg(
        F.array_sort(F.collect_list(F.struct("rank", "doc_id", "altered"))).alias("members"))
    whole = slotted.join(lowest, _same("lang", "ag") & (F.col("key") == F.col("akey")))
    return whole.mapInArrow(lambda b: _proofs(b, depth), PROOFS)


PROOFS = f"doc_id bigint, lang string, rank bigint, leaf binary, altered binary, subroot binary, root binary, path {PATH}"


def _proofs(batches: Batches, depth: int) -> Batches:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            tree = levels_of(_split(row["slots"]), row["n_level"], depth)
            rest = _from_path(row["above"]) + _from_path(row["group_path"])
            members = row["members"]
            n = len(members)
            altered = [m["altered"].hex().encode() if m["altered"] is not None else None for m in members]
            yield pa.RecordBatch.from_arrays([
                pa.array([m["doc_id"] for m in members], pa.int64()), pa.array([row["lang"]] * n, pa.string()),
                pa.array([m["rank"] for m in members], pa.int64()), pa.array(tree[0], pa.binary()), pa.array(altered, pa.binary()),
                pa.array([row["subroot"]] * n, pa.binary()), pa.array([row["root"]] * n, pa.binary()),
                pa.array([_as_path(siblings(tree, i) + rest) for i in range(n)], _PATH_TYPE)],
                ["doc_id", "lang", "rank", "leaf", "altered", "subroot", "root", "path"])


VERIFIED = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def verify(proofs: DataFrame) -> DataFrame:
    """Fold each row's leaf (the altered one, if any) with its siblings and compare with the root."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, altered, root = (batch.column(c).to_pylist() for c in ("leaf", "altered", "root"))
            shown, folded = [], []
            path = batch.column("path")
            for k in range(batch.num_rows):
                steps = _from_path(path[k].as_py())
                shown.append(digest(*[x for s in steps for x in s]).decode())
                folded.append(fold(altered[k] if altered[k] is not None else leaf[k], steps).decode())
            text = [[x.decode() for x in batch.column(c).to_pylist()] for c in ("leaf", "subroot", "root")]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), *[pa.array(t, pa.string()) for t in text], pa.array(shown, pa.string()),
                pa.array(folded, pa.string()), pa.array([f == r for f, r in zip(folded, text[2])], pa.bool_())],
                [c.split()[0] for c in VERIFIED.split(", ")])

    return proofs.select("doc_id", "leaf", "altered", "subroot", "root", "path").mapInArrow(check, VERIFIED)


def oracle_sql(levels: int = 6, top_levels: int = 3) -> str:
    """The verified manifest in DuckDB's SQL, for at most 8**levels rows per group and 8**top_levels groups."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def climb(name: str, start: str, steps: int) -> list[str]:
        out, level = [], start
        for k in range(steps):
            run = f"OVER (PARTITION BY g, i // {FAN} ORDER BY i ROWS BETWEEN"
            out.append(f"""{name}s{k} AS (SELECT g, i, n,
                coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {level})""")
            out.append(f"""{name}{k + 1} AS (SELECT g, i // {FAN} AS i, (n + {FAN - 1}) // {FAN} AS n,
                CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
                FROM {level} GROUP BY g, i // {FAN}, n)""")
            level = f"{name}{k + 1}"
        return out

    def follow(name: str, start: str, group: str, steps: int) -> list[str]:
        out, before = [], start
        for k in range(steps):
            out.append(f"""{name}f{k} AS (SELECT b.* EXCLUDE (f, p), b.p || s.l || s.r AS p,
                CASE WHEN s.n > 1 THEN sha256(s.l || b.f || s.r) ELSE b.f END AS f
                FROM {before} b JOIN {name}s{k} s ON s.g = b.{group} AND s.i = b.{name}i // {FAN ** k})""")
            before = f"{name}f{k}"
        return out

    parts = [
        f"""tab AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
            lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)""",
        f"""hashed AS (SELECT doc_id, coalesce('x' || lang, '') AS g, sha256({head} || {field('text')}) AS leaf,
            sha256({head} || {field(f"translate(text, '{upper}', '{lower}')")}) AS low,
            xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc
            FROM documents, tab)""",
        f"""placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS ai,
            count(*) OVER (PARTITION BY g) AS n FROM hashed)""",
        "a0 AS (SELECT g, ai AS i, n, leaf AS h FROM placed)", *climb("a", "a0", levels),
        f"""b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, h, g AS lang FROM a{levels})""",
        *climb("b", "b0", top_levels),
        f"""open AS (SELECT p.doc_id, p.leaf, p.g, p.ai, b.i AS bi, 0 AS one, b.h AS subroot, r.h AS root, '' AS p,
            CASE WHEN p.crc % 3 = 0 THEN p.low ELSE p.leaf END AS f
            FROM placed p JOIN b0 b ON b.lang = p.g CROSS JOIN b{top_levels} r)""",
        *follow("a", "open", "g", levels), *follow("b", f"af{levels - 1}", "one", top_levels)]
    return "WITH " + ",\n".join(parts) + f"""
        SELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, f AS folded_root, f = root AS verified FROM bf{top_levels - 1}"""
