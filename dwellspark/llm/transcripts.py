"""Chat formatting: roles of a raw transcript's lines by a hidden Markov model.

A transcript is one text.  Its lines are the observations, as a few features each:
the kind of speaker marker they begin with (a known word such as "User:", or one of
the transcript's recurring names), blank or not, for lines without a marker whether a
blank line stands before them (a turn without a marker nearly always has one, a marked
one need not), length, whether a question ends them.  States are the roles, each with a first line and further
lines.  Viterbi finds the likeliest states, so unmarked turns, markers inside prose
and missing speakers are decided by their surroundings.  Turns are then rendered
in one canonical form.

The model starts from plain parameters; each round decodes all transcripts, counts
states, features and moves over all of them in Spark (a table of fixed size) and
estimates anew.

Defined results: a null, empty or blank transcript has no turns; lines before any
marker belong to the likeliest role; blank lines at a turn's ends are dropped;
repeated conversation ids are parsed each; an empty table gives no rows.  In
``raw_transcripts`` the rows without a ``conv_id`` are one conversation, and equal or
null ``turn`` numbers stand in the order of their texts, nulls first.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
STATES = [(r, first) for r in ROLES for first in (True, False)]
WORDS = {
    "system": "system context instructions".split(),
    "user": "user human question q customer prompt instruction input client student".split(),
    "assistant": "assistant ai bot answer a response output model agent chatbot".split(),
}
ROLE_OF = {w: r for r, some in WORDS.items() for w in some}
KNOWN = "|".join(sorted(ROLE_OF, key=len, reverse=True))
MARKER = re.compile(rf"\s*(?:[#*\-]+\s*)?(?:<\|?({KNOWN})\|?>|\[({KNOWN})\]:?|\**({KNOWN})\**\s*[:>]\**|(?<=# )({KNOWN})\s*$)[ \t]*", re.I)
HEADED = re.compile(rf"\s*#+\s*({KNOWN})\s*:?\s*$", re.I)
NAME = re.compile(r"([A-Z][\w.\-]{0,19}(?: [A-Z][\w.\-]{0,19})?):\s+")
FEATURES = {"marker": ("none", "system", "user", "assistant", "name1", "name2", "name"), "blank": (False, True),
            "gap": (False, True), "long": (False, True), "asks": (False, True)}


def line_features(text: str) -> tuple[list[tuple], list[str]]:
    """Features and text (without its marker) of every line."""
    lines = text.split("\n")
    names = Counter(m[1] for m in map(NAME.match, lines) if m and m[1].lower() not in ROLE_OF)
    # a name that stands once counts where names open the transcript and no speaker has a known marker
    known = {ROLE_OF[next(g for g in m.groups() if g).lower()] for m in map(MARKER.match, lines) if m}
    head = text.lstrip()
    least = 1 if not known - {"system"} and (NAME.match(head) or MARKER.match(head)) else 2
    order = {n: k for k, n in enumerate(n for n, c in names.items() if c >= least)}
    features, rest = [], []
    gap = True
    for line in lines:
        kind, body = "none", line
        if m := HEADED.match(line) or MARKER.match(line):
            kind, body = ROLE_OF[next(g for g in m.groups() if g).lower()], line[m.end():]
        elif (m := NAME.match(line)) and m[1] in order:
            kind, body = ("name1", "name2", "name")[min(order[m[1]], 2)], line[m.end():]
        blank = kind == "none" and not body.strip()
        features.append((kind, blank, gap if kind == "none" else None, len(body) > 120, body.rstrip().endswith("?")))
        rest.append(body)
        gap = blank
    return features, rest


def plain_model() -> dict[str, np.ndarray]:
    """Log probabilities to start from: first states, moves between states, and each feature's values by state."""
    first = np.array([0.25, 0, 0.6, 0, 0.15, 0]) + 1e-6
    move = np.full((6, 6), 1e-6)
    after = {"system": {"user": 0.9, "assistant": 0.1}, "user": {"assistant": 0.97, "system": 0.01, "user": 0.02},
             "assistant": {"user": 0.97, "system": 0.01, "assistant": 0.02}}
    for i, (role, _) in enumerate(STATES):
        move[i, 2 * ROLES.index(role) + 1] += 0.6
        for other, p in after[role].items():
            move[i, 2 * ROLES.index(other)] += 0.4 * p
    model = {"first": first, "move": move}
    for name, values in FEATURES.items():
        table = np.full((6, len(values)), 0.5)
        for i, (role, start) in enumerate(STATES):
            if name == "marker":
                table[i] = 0.002
                table[i, 0] = 0.1 if start else 0.97
                if start:
                    table[i, 1 + ROLES.index(role)] = 0.6
                    table[i, 4] = {"user": 0.2, "assistant": 0.04, "system": 0.01}[role]
                    table[i, 5] = {"user": 0.04, "assistant": 0.2, "system": 0.01}[role]
                    table[i, 6] = 0.06
            elif name == "blank":
                table[i] = (0.999, 0.001) if start else (0.8, 0.2)
            elif name == "gap":
                table[i] = (0.1, 0.9) if start else (0.9, 0.1)
            elif name == "long":
                table[i] = (0.5, 0.5) if role == "assistant" else (0.7, 0.3)
            elif name == "asks":
                table[i] = (0.7, 0.3) if role == "user" else (0.95, 0.05)
        model[name] = table
    return {k: np.log(v / v.sum(axis=-1, keepdims=True)) for k, v in model.items()}


def values_of(line: tuple) -> list[tuple[str, int]]:
    """(feature, number of its value) of a line; features that do not apply to it are left out."""
    return [(n, FEATURES[n].index(v)) for n, v in zip(FEATURES, line) if v is not None]


def viterbi(features: list[tuple], model: dict[str, np.ndarray], emitted: dict[tuple, np.ndarray]) -> list[int]:
    """The likeliest states; ``emitted`` keeps the sums of features that occurred."""
    score, back = None, []
    for f in features:
        if f not in emitted:
            emitted[f] = sum(model[n][:, v] for n, v in values_of(f))
        if score is None:
            score = model["first"] + emitted[f]
            continue
        move = score[:, None] + model["move"]
        best = move.argmax(axis=0)
        back.append(best)
        score = move[best, range(6)] + emitted[f]
    states = [int(score.argmax())]
    for best in reversed(back):
        states.append(int(best[states[-1]]))
    return states[::-1]


def count_states(transcripts: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """table, state, value, n: what the decoded lines show; its size is that of the model."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        emitted: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if not (text or "").strip():
                    continue
                features, _ = line_features(text)
                states = viterbi(features, model, emitted)
                seen["first", states[0], 0] += 1
                seen.update(("move", a, b) for a, b in zip(states, states[1:]))
                for f, s in zip(features, states):
                    seen.update((n, s, v) for n, v in values_of(f))
        keys = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                                          pa.array([k[2] for k in keys], pa.int64()), pa.array([seen[k] for k in keys], pa.int64())],
                                         ["table", "state", "value", "n"])

    counts = transcripts.select("text").mapInArrow(count, "table string, state bigint, value bigint, n bigint")
    return counts.groupBy("table", "state", "value").agg(F.sum("n").alias("n"))


def estimate(transcripts: DataFrame, rounds: int, weight: float = 50.0) -> dict[str, np.ndarray]:
    """Parameters by Viterbi training; the plain ones count like ``weight`` lines."""
    plain = plain_model()
    model = plain
    for _ in range(rounds):
        new = {k: weight * np.exp(v) for k, v in plain.items()}
        for row in count_states(transcripts, model).collect():  # a row per parameter
            if row["table"] == "first":
                new["first"][row["state"]] += row["n"]
            else:
                new[row["table"]][row["state"], row["value"]] += row["n"]
        model = {k: np.log(v / v.sum(axis=-1, keepdims=True)) for k, v in new.items()}
    return model


def turns_of(features: list[tuple], lines: list[str], states: list[int]) -> list[tuple[str, str]]:
    """(role, text) of every turn."""
    turns: list[tuple[str, list[str]]] = []
    for line, s in zip(lines, states):
        role, first = STATES[s]
        if first or not turns or turns[-1][0] != role:
            turns.append((role, []))
        turns[-1][1].append(line)
    out = []
    for role, some in turns:
        text = "\n".join(some).strip()
        if text:
            out.append((role, text))
    return out


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n<|end|>\n"


def parse(transcripts: DataFrame, *, rounds: int = 2, model: dict[str, np.ndarray] | None = None) -> DataFrame:
    """conv_id, turn (from 0), role, text, rendered: the turns of every transcript (conv_id, text)."""
    model = estimate(transcripts, rounds) if model is None else model
    id_type = transcripts.schema["conv_id"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emitted: dict[tuple, np.ndarray] = {}
        for batch in batches:
            row, number, roles, texts = [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                if not (text or "").strip():
                    continue
                features, lines = line_features(text)
                for n, (role, body) in enumerate(turns_of(features, lines, viterbi(features, model, emitted))):
                    row.append(k)
                    number.append(n)
                    roles.append(role)
                    texts.append(body)
            yield pa.RecordBatch.from_arrays([
                batch.column("conv_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(roles, pa.string()),
                pa.array(texts, pa.string()), pa.array([render(r, t) for r, t in zip(roles, texts)], pa.string())],
                ["conv_id", "turn", "role", "text", "rendered"])

    return transcripts.select("conv_id", "text").mapInArrow(decode, f"conv_id {id_type}, turn int, role string, text string, rendered string")


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """conv_id, text: conversations written down the way they are found, one marker style per conversation.

    Styles by a hash of the id: "User:", "Human:" / "AI:", "Q:" / "A:", headings, names,
    and turns of which every third has no marker but a blank line before it.  A null
    role has no marker, a null text is empty.
    """
    role = F.col("role")
    styles = [("User: ", "Assistant: ", "System: "), ("Human: ", "AI: ", "System: "), ("Q: ", "A: ", "Context: "),
              ("### Instruction:\n", "### Response:\n", "### System:\n"), ("Ann: ", "Bob: ", "System: "), ("[user] ", "[assistant] ", "[system] ")]
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(styles)))
    marker = F.lit("")
    for k, (user, assistant, system) in enumerate(styles):
        marker = F.when(style == k, F.when(role == "user", user).when(role == "assistant", assistant).when(role == "system", system).otherwise("")).otherwise(marker)
    bare = (style == len(styles) - 1) & (F.pmod(F.col("turn"), F.lit(3)) == 2)
    piece = F.when(bare, F.concat(F.lit("\n"), F.coalesce("text", F.lit("")))).otherwise(F.concat(marker, F.coalesce("text", F.lit(""))))
    rows = conversations.select("conv_id", "turn", piece.alias("piece"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "piece"))).alias("p"))
    return whole.select("conv_id", F.array_join(F.transform("p", lambda x: x["piece"]), "\n").alias("text"))
