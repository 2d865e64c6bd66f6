"""Quality rules as weak supervision (DataFrame functions only).

Each rule looks at one count of a document and votes good (1), bad (-1) or
abstains (0).  How far a rule can be trusted is not set by hand:
expectation-maximisation estimates, from the votes of all documents, how often
good and bad documents get each vote of each rule, and how many documents are bad.
A document's quality is then the posterior probability of being good, and it is
kept from ``least`` on, whatever single rules said.

The votes of all documents are one count per vote pattern (at most 3 ** rules
rows); a round of EM is one aggregate over those.  All counts come from the whole
text by array functions in one pass; repeated windows are found by sorting a
document's window hashes.

Defined results: a null text has no words; a document without words gets only
abstentions and is judged by them; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.common import cut_lineage, whole_text

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words(text: Column) -> Column:
    """The words as an array; of a wordless text the array holds one empty string."""
    return F.split(F.btrim(text, F.lit(SPACES)), r"[\x20\x09-\x0D]+")


def repeated_words(hashes: Column, n: int = 3) -> Column:
    """Words in windows of ``n`` words that occur twice or more, from the words' hashes."""
    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)]))

    def covered(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def of(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                             | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(*[x["i"] + k for k in range(n)])))))
        return let(ordered, of)

    def count(h: Column) -> Column:
        found = let(windows(h), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))
        return F.when(F.size(h) < n, F.lit(0)).otherwise(found)

    return let(hashes, count).cast("long")


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and counts of the whole text."""
    t = F.col("t")
    base = docs.select("doc_id", whole_text("text").alias("t"))
    has_word = lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))
    lines = let(F.split(t, "\n"), lambda s: let(F.filter(s, has_word), lambda k: F.struct(
        F.size(k).alias("n"), (F.size(k) - F.size(F.array_distinct(k))).alias("dup"))))
    shape = let(words(t), lambda w: F.struct(
        F.when((F.size(w) == 1) & (F.get(w, F.lit(0)) == ""), F.lit(0)).otherwise(F.size(w)).cast("long").alias("n_words"),
        repeated_words(F.transform(w, lambda x: F.xxhash64(x))).alias("repeat")))
    out = base.select(
        "doc_id", F.length(without(t, SPACES)).cast("long").alias("word_chars"),
        (F.octet_length(t) - F.octet_length(without(t, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.octet_length(t) - F.octet_length(without(t, "!"))).cast("long").alias("n_marks"),
        F.regexp_count(t, F.lit("[A-Z]{2}")).cast("long").alias("n_capitals"),
        lines.alias("lines"), shape.alias("shape"))
    return out.select("doc_id", F.col("shape.n_words").alias("n_words"), "word_chars", "n_symbols",
                      F.col("lines.dup").cast("long").alias("n_dup_lines"), F.col("shape.repeat").alias("n_repeat_words"),
                      "n_marks", "n_capitals", F.col("lines.n").cast("long").alias("n_lines"))


def rules() -> dict[str, Column]:
    """The rules' votes, from the columns of ``text_counts``.

    Junk shows in one way at a time, so a rule that sees none abstains; only the
    last rule votes good, for a text that is calm in all respects.
    """
    n = F.greatest(F.col("n_words"), F.lit(1))
    length = F.col("word_chars") / n
    share = {
        "symbols": (F.col("n_symbols") / n, 0.1, 0.08),
        "repeats": (F.col("n_repeat_words") / F.greatest("n_words", F.lit(60)), 0.35, 0.33),
        "lines": (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(10)), 0.4, 0.35),
        "marks": (F.col("n_marks") / n, 0.2, 0.05),
        "capitals": (F.col("n_capitals") / n, 0.5, 0.2),
    }
    some = {k: F.when(v >= bad_from, -1).otherwise(0) for k, (v, bad_from, _) in share.items()}
    some["word_length"] = F.when((length < 2) | (length > 12), -1).otherwise(0)
    calm = (length >= 3) & (length <= 9)
    for v, _, calm_to in share.values():
        calm = calm & (v <= calm_to)
    some["prose"] = F.when(calm, 1).otherwise(0)
    return {k: F.when(F.col("n_words") == 0, 0).otherwise(v).cast("int") for k, v in some.items()}


def estimate(votes: DataFrame, names: list[str], rounds: int, smooth: float = 1.0) -> tuple[float, dict]:
    """(share of bad documents, {rule: {class: {vote: probability}}}) by EM over vote patterns."""
    patterns = cut_lineage(votes.groupBy(*names).agg(F.count("*").alias("n")))
    bad = 0.1
    table = {r: {"good": {-1: 0.02, 0: 0.28, 1: 0.7}, "bad": {-1: 0.3, 0: 0.6, 1: 0.1}} for r in names}
    for _ in range(rounds):
        p = F.col("p")
        sums = [F.sum(F.col("n") * p).alias("bad"), F.sum("n").alias("n")]
        for r in names:
            for v in (-1, 0, 1):
                here = F.when(F.col(r) == v, F.col("n")).otherwise(0)
                sums += [F.sum(here * p).alias(f"bad_{r}_{v}"), F.sum(here * (1 - p)).alias(f"good_{r}_{v}")]
        row = patterns.withColumn("p", 1 - good_probability(names, bad, table)).agg(*sums).first()
        if not row["n"]:
            break
        old, bad = bad, (row["bad"] + smooth) / (row["n"] + 2 * smooth)
        for r in names:
            for c in ("good", "bad"):
                got = {v: row[f"{c}_{r}_{v}"] + smooth for v in (-1, 0, 1)}
                table[r][c] = {v: x / sum(got.values()) for v, x in got.items()}
        if abs(old - bad) < 1e-9:
            break
    return bad, table


def good_probability(names: list[str], bad: float, table: dict) -> Column:
    odds = F.lit(math.log((1 - bad) / bad))
    for r in names:
        weight = {v: math.log(table[r]["good"][v] / table[r]["bad"][v]) for v in (-1, 0, 1)}
        odds = odds + F.when(F.col(r) == -1, weight[-1]).when(F.col(r) == 1, weight[1]).otherwise(weight[0])
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, *, rounds: int = 12, least: float = 0.5) -> DataFrame:
    """One row per document: doc_id, the counts, a vote per rule, quality, accepted."""
    votes = rules()
    names = list(votes)
    counted = cut_lineage(text_counts(docs).withColumns(votes))
    bad, table = estimate(counted, names, rounds)
    return counted.withColumn("quality", good_probability(names, bad, table)).withColumn("accepted", F.col("quality") >= least)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


__all__ = ["judge", "text_counts", "estimate", "good_probability", "base_failed"]
