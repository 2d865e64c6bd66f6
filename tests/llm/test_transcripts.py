"""Roles of transcripts: round trip over the conversations table, odd transcripts."""

import itertools

from pyspark.sql import functions as F

from dwellspark.llm import transcripts
from dwellspark.llm.common import table


def test_conversations_come_back(spark):
    conversations = table(spark, "/root/testdata/sf0.01", "conversations")
    want, got = {}, {}
    for r in sorted(conversations.collect(), key=lambda r: (r["conv_id"], r["turn"])):
        want.setdefault(r["conv_id"], []).append((r["role"], (r["text"] or "").strip()))
    parsed = transcripts.parse(transcripts.raw_transcripts(conversations)).collect()
    for r in sorted(parsed, key=lambda r: (r["conv_id"], r["turn"])):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert r["rendered"] == f"<|{r['role']}|>\n{r['text']}\n<|end|>\n"
    # by style: marked ones all come back, those of which every third turn has no marker nearly all
    style = {r[0]: r[1] for r in conversations.select("conv_id", F.pmod(F.xxhash64("conv_id"), F.lit(6))).distinct().collect()}
    for k in range(6):
        these = [c for c in want if style[c] == k]
        assert sum(got.get(c) == want[c] for c in these) >= (0.95 if k == 5 else 1) * len(these), k


def test_viterbi_is_the_best_of_all_paths():
    model = transcripts.plain_model()
    for text in ("User: a?\n\nb\nAI: c", "one\n\ntwo", "Ann: x\nBob: y\nAnn: z\n", "system: s\nq\n\nA: r"):
        lines, _ = transcripts.line_features(text)

        def worth(path):
            seen = sum(model[n][s, v] for s, line in zip(path, lines) for n, v in transcripts.values_of(line))
            return model["first"][path[0]] + sum(model["move"][a, b] for a, b in zip(path, path[1:])) + seen

        best = max(worth(p) for p in itertools.product(range(6), repeat=len(lines)))
        assert abs(worth(transcripts.viterbi(lines, model, {})) - best) < 1e-9


def test_paragraphs_inside_a_turn_stay(spark):
    """Where blank lines stand inside turns, the same model keeps them there."""
    rows = [(i, f"User: tell me {i}\nAssistant: first part of it\n\nsecond part of it\nUser: go on\nAssistant: more\n\nand more") for i in range(200)]
    got = transcripts.parse(spark.createDataFrame(rows, "conv_id long, text string")).groupBy("conv_id").agg(F.count("*").alias("n"))
    assert {r["n"] for r in got.collect()} == {4}


def test_unmarked_and_odd_transcripts(spark):
    rows = [(1, "User: hi there?\nAssistant: hello\nmore of it\n\nUser: and this?", "x"), (2, None, "x"), (3, " \n \n", "x"), (4, "", "x"),
            (5, "Ann: what is it?\nBob: a thing\nAnn: thanks\nBob: sure", "x"), (6, "SYSTEM: be brief\nQ: why?\nA: because\nNote: not a speaker", "x"),
            (7, "### Instruction:\nDo it\n### Response:\ndone", "x"), (8, "only one line", "x"), (8, "only one line", "x"),
            (9, "User: " + "long " * 30_000 + "\nAssistant: ok", "x"), (None, "Human: a\nAI: b", "x")]
    got = transcripts.parse(spark.createDataFrame(rows, "conv_id long, text string, role string")).collect()
    roles = {}
    for r in sorted(got, key=lambda r: (str(r["conv_id"]), r["turn"])):
        roles.setdefault(r["conv_id"], []).append((r["role"][0], r["text"]))
    assert roles[1] == [("u", "hi there?"), ("a", "hello\nmore of it"), ("u", "and this?")]
    assert not {2, 3, 4} & set(roles) and len(roles[8]) == 2
    assert [r for r, _ in roles[5]] == list("uaua") and roles[6] == [("s", "be brief"), ("u", "why?"), ("a", "because\nNote: not a speaker")]
    assert roles[7] == [("u", "Do it"), ("a", "done")] and [r for r, _ in roles[9]] == ["u", "a"] and roles[None] == [("u", "a"), ("a", "b")]
    empty = spark.createDataFrame([], "conv_id long, text string")
    assert transcripts.parse(empty).count() == 0


def test_raw_transcripts_with_nulls(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (None, 0, "assistant", "y"), (1, None, "user", "z")]
    assert transcripts.raw_transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).count() == 2
