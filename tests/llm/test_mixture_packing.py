"""Mixture packing against the tokenizers library and exact proportions."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from dwellspark.llm import mixture_packing as mp
from dwellspark.llm.queries import vocabulary
from dwellspark.llm.tokens import BlockTokenizer

WORDS = ["the", "Fox", "é", "naïve", "it's", "5", "12", "%", "!!", "<|endoftext|>", "Ω", "中", "\n", "  ", "a.b", "ΑΣ", "x̸", "\t"]


def test_word_units_equal_the_library():
    tok = BlockTokenizer(vocabulary("word_bpe_49k.json"))
    rng = random.Random(1)
    texts = ["".join(rng.choice(WORDS) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for some in (texts, [t.replace("<|endoftext|>", "") for t in texts]):
        raw = [t.encode() for t in some]
        at = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
        ids, doc = tok.encode(np.frombuffer(b"".join(raw), np.uint8), at)
        want = [x.ids for x in tok.tok.encode_batch_fast(some, add_special_tokens=False)]
        assert [list(ids[a:b]) for a, b in zip(doc, doc[1:])] == want


def rows_of(rng):
    rows = []
    for k in range(400):
        source = rng.choice(["hot"] * 6 + ["mid"] * 3 + ["low", None])
        rows.append((k, " ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 5, 40, 300]))), source, 9))
    return rows + [(None, "no id", "hot", 9), (3, None, "mid", 9), (3, "", "mid", 9), (3, "same", "mid", 9), (3, "same", "mid", 9),
                   (9999, "long text, " * 20_000, "low", 9)] + [(7000 + k, "rare", f"rare-{k}", 9) for k in range(30)]


@pytest.mark.parametrize("room,windows,least,id_bytes", [(256, 4, 16, 2), (64, 50, 8, 4), (4096, 256, 64, 2)])
def test_pack(spark, room, windows, least, id_bytes):
    rows = rows_of(random.Random(room))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, offset int").repartition(6)
    path = vocabulary("word_bpe_49k.json")
    pieces = mp.pack(mp.token_rows(docs, tokenizer_path=path, end_id=2, id_bytes=id_bytes), room=room, part_windows=windows, least=least,
                     id_bytes=id_bytes).collect()
    tok = Tokenizer.from_file(path)
    want = Counter((d, tuple(tok.encode(t or "", add_special_tokens=False).ids + [2])) for d, t, _, _ in rows)
    # each document comes back whole, each of its ids once
    by_doc = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p["ids"]), "<u4")
        assert len(ids) == p["length"] > 0
        by_doc[p["doc_id"], p["source"]].append((p["start"], ids, p["doc_tokens"]))
    got = Counter()
    for (d, _), some in by_doc.items():
        if sum(n for n in Counter(x[2] for x in some if x[0] == 0).values()) == 1:
            some.sort(key=lambda x: x[0])
            got[d, tuple(np.concatenate([x[1] for x in some]).tolist())] += 1
            assert all(a[0] + len(a[1]) == b[0] for a, b in zip(some, some[1:]))
    several = {3, None}
    assert {k: v for k, v in got.items() if k[0] not in several} == {k: v for k, v in want.items() if k[0] not in several}
    total = sum(len(k[1]) * v for k, v in want.items())
    assert sum(p["length"] for p in pieces) == total
    # sequences are gapless; full but for powers of two at the end
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
    short = []
    for some in seqs.values():
        some.sort()
        assert some[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(some, some[1:]))
        fill = some[-1][0] + some[-1][1]
        if fill != room:
            short.append(fill)
    assert all(n & (n - 1) == 0 for n in short) and sum(short) == total % room and len(set(short)) == len(short)
    # the tokens of each source follow its share in every run of windows from a part's start
    shares = Counter()
    for p in pieces:
        shares[p["source"]] += p["length"]
    full = total // room
    got = defaultdict(lambda: np.zeros(full, dtype=np.int64))
    for p in pieces:
        if p["sequence_id"] < full:
            got[p["source"]][p["sequence_id"]] += p["length"]
    for source, n in shares.items():
        if n >= total / room * 4 and not (source or "").startswith("rare"):
            drift = np.cumsum(got[source]) - n / total * room * np.arange(1, full + 1)
            assert np.abs(drift).max() <= room, (source, np.abs(drift).max())


def test_shares_are_exact():
    rng = random.Random(3)
    for _ in range(50):
        tokens = [rng.randint(40, 5000) for _ in range(rng.randint(1, 9))]
        shares = mp.Shares(tokens, 97)
        if min(tokens) < shares.parts:
            continue
        for q, n in enumerate(tokens):
            served = [shares.served(q, k) for k in range(shares.parts + 1)]
            assert served[0] == 0 and served[-1] == n and sorted(served) == served
            place = rng.randrange(n)
            runs = list(shares.split(q, place, n - place))
            assert sum(x[2] for x in runs) == n - place
            assert all(served[p] + at + m <= served[p + 1] for p, at, m in runs)
        for k in range(shares.parts):
            assert sum(shares.served(q, k + 1) - shares.served(q, k) for q in range(len(tokens))) == min(97, shares.total - 97 * k)


def test_empty_and_null_tables(spark):
    path = vocabulary("word_bpe_49k.json")
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mp.pack(mp.token_rows(empty, tokenizer_path=path, end_id=2)).count() == 0
    one = spark.createDataFrame([(None, None, None)], "doc_id long, text string, source string")
    got = mp.pack(mp.token_rows(one, tokenizer_path=path, end_id=2)).collect()
    assert [(r["doc_id"], r["length"], r["sequence_id"], r["offset"]) for r in got] == [(None, 1, 0, 0)]
