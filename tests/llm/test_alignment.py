"""Alignment of two tokenizers against plain code on each document."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from dwellspark.llm import alignment
from dwellspark.llm.queries import byte_bpe, vocabulary

ALPHABET = ["a", "B", "é", "ñ", " ", "  ", "\n", "\t", "'s", "'re", "5", "²", "%", "!!", "_", "…", "　", "中", "<|endoftext|>", "<s>",
            "<0x41>", "-", "\r", "👍", "İ", "word", " the", " and", "ing", "tion", "\x00"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(byte_bpe())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))


def plain(texts, libraries):
    """Per text (n_a, n_b, groups text, links) by walking both token lists."""
    a, b = libraries
    byte = alignment.byte_of_char()
    out = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            out.append((0, 0, "", []))
            continue
        links, groups, i, j, end_a, end_b = [], [([], [])], 0, 0, len(bytes_a[0]), len(bytes_b[0])
        groups[0][0].append(ids_a[0])
        groups[0][1].append(ids_b[0])
        while True:
            links.append((ids_a[i], ids_b[j]))
            if end_a == end_b:
                i, j = i + 1, j + 1
                if i == len(ids_a):
                    break
                groups.append(([ids_a[i]], [ids_b[j]]))
                end_a, end_b = end_a + len(bytes_a[i]), end_b + len(bytes_b[j])
            elif end_a < end_b:
                i += 1
                groups[-1][0].append(ids_a[i])
                end_a += len(bytes_a[i])
            else:
                j += 1
                groups[-1][1].append(ids_b[j])
                end_b += len(bytes_b[j])
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((len(ids_a), len(ids_b), shown, links))
    return out


def rows_of(rng, n):
    rows = [(k, "".join(rng.choice(ALPHABET) for _ in range(rng.choice([0, 1, 3, 40, 200]))), 7) for k in range(n)]
    return rows + [(5, None, 7), (None, "no id", 7), (None, None, 7), (5, "same text", 7), (5, "same text", 7), (9000, "a▁b", 7),
                   (9001, " " * 5000 + "x", 7), (9002, "long text, of many words and " * 4000, 7), (9003, "x" * 3000, 7)]


@pytest.mark.parametrize("block_bytes", [300, 1 << 21])
def test_against_plain_code(spark, libraries, block_bytes):
    rows = rows_of(random.Random(block_bytes), 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int").repartition(3)
    got = alignment.align(docs, path_a=byte_bpe(), path_b=vocabulary("piece_bpe_32k.model"), block_bytes=block_bytes).checkpoint()
    want = plain([t for _, t, _ in rows], libraries)
    count = Counter(x for w in want for x in w[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    expected = sorted(str((d, na, nb, shown.count("|"), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), shown))
                      for (d, _, _), (na, nb, shown, links) in zip(rows, want))
    scored = alignment.scored(got, "groups string")
    assert sorted(str(tuple(r)) for r in scored.collect()) == expected
    assert {(r["id_a"], r["id_b"]): r["count"] for r in alignment.pair_counts(got).collect()} == count


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    rows = alignment.align(docs, path_a=byte_bpe(), path_b=vocabulary("piece_bpe_32k.model"))
    assert alignment.scored(rows).count() == 0


def test_query_digest(spark, libraries, tmp_path):
    from dwellspark.llm import queries
    rows = [(1, "Hello wörld", "x"), (2, None, "x"), (3, "", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op11_alignment(spark, str(tmp_path)).collect()}
    shown = plain([rows[0][1]], libraries)[0][2]
    assert got[1]["groups_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
    assert got[2]["groups_sha256"] == got[3]["groups_sha256"] == "" and got[2]["n_links"] == 0
