"""Quality classifier: hierarchical empirical Bayes over documents, hosts and paths.

1. A logistic regression on counts of the whole text, fitted by Spark on at most
   ``sample`` labelled documents (those with the smallest hash of their doc_id),
   gives each document's evidence: the odds by its text alone, over the odds of the
   sample.
2. Hosts and paths: all documents' probabilities are summed per (host, path), those
   per host, and those overall.  A host's rate is its mean, shrunk towards the global
   rate by as many pseudo-documents as the spread between hosts calls for (method of
   moments); a path's rate is shrunk towards its host's in the same way.  A sparse
   site is close to its parent, a large one speaks for itself.
3. A document's quality combines the odds of its path with its own evidence.

A document's host and path are those of its page's url where ``pages`` has one (the
path up to its last part, which names the document; see ``url_filter.document_of``),
else columns of its own (source and lang).

Defined results: a null text is empty; of several pages of a document the first url in
code point order counts, one without a host does not; a null host or path is a host or path of its
own; labels without a document, or without a quality, are left out; without both
kinds of labels every document has the neutral evidence 1 and is accepted; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.common import cut_lineage, text_blocks, utf8, whole_text, written
from dwellspark.llm.jaccard import shingle_sets, word_hashes
from dwellspark.llm.url_filter import document_of, host_of, path_of

FEATURES = ["symbols", "marks", "capitals", "bars", "same_next", "twice", "long_words", "short_words", "digits", "length"]


def _kinds() -> np.ndarray:
    kind = np.zeros((4, 256), dtype=bool)
    kind[0, [ord(c) for c in "#*$%&<>"]] = True
    kind[1, ord("!")] = True
    kind[2, ord("|")] = True
    kind[3, 48:58] = True
    return kind


KINDS = _kinds()


def block_features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each document of a block."""
    def per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)

    words, word_at = word_hashes(data, at)
    n = np.diff(word_at)
    some = np.maximum(n, 1)
    capital = (data >= 65) & (data <= 90)
    pair = np.zeros(len(data), dtype=bool)
    pair[1:] = capital[1:] & capital[:-1]
    same = np.zeros(len(words), dtype=bool)
    if len(words) > 1:
        same[1:] = words[1:] == words[:-1]
    same[word_at[:-1][word_at[:-1] < len(words)]] = False
    _, set_at = shingle_sets(data, at, 3)
    windows = np.where(n >= 3, n - 2, np.minimum(n, 1))
    repeated = 1 - np.diff(set_at) / np.maximum(windows, 1)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    letters = per_doc(~blank & ((data & 0xC0) != 0x80), at) / some
    columns = [per_doc(KINDS[0][data], at) / some, per_doc(KINDS[1][data], at) / some, per_doc(pair, at) / some,
               per_doc(KINDS[2][data], at) / some, per_doc(same, word_at) / some, np.where(n >= 20, repeated, 0.0),
               np.maximum(letters - 7, 0), np.where(n > 0, np.maximum(4 - letters, 0), 0), per_doc(KINDS[3][data], at) / some,
               np.minimum(np.log1p(n), 6) / 6]
    # a small share already tells: compress what lies above it
    for k in (0, 1, 2, 3, 4, 5):
        columns[k] = np.minimum(columns[k] * 10, 1) + np.minimum(columns[k], 1)
    return np.stack(columns, axis=1) if len(n) else np.zeros((0, len(FEATURES)))


def text_features(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, host, path, text_hash and the features of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_blocks(batch):
                rows = block_features(*utf8(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "host", "path", "text_hash")] + [pa.array(rows[:, k].copy()) for k in range(len(FEATURES))],
                    ["doc_id", "host", "path", "text_hash", *FEATURES])

    text = whole_text("text")
    cols = docs.select("doc_id", host.cast("string").alias("host"), path.cast("string").alias("path"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return cols.mapInArrow(run, "doc_id bigint, host string, path string, text_hash bigint, " + ", ".join(f"{f} double" for f in FEATURES))


def page_sites(pages: DataFrame) -> DataFrame:
    """doc_id, site_host, site_path of the documents that have a page: one row each."""
    url = F.col("url")
    found = pages.select(document_of(url).alias("doc_id"), url).where(F.col("doc_id").isNotNull() & (host_of(url) != ""))
    one = found.groupBy("doc_id").agg(F.min("url").alias("url"))
    return one.select("doc_id", host_of(url).alias("site_host"), F.regexp_extract(path_of(url), r"^(.*/)[^/]+/?$", 1).alias("site_path"))


def fit(features: DataFrame, labels: DataFrame, sample: int) -> tuple[list[float], float, float] | None:
    """(weights, intercept, share of good) of the text classifier; None without both kinds of labels."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = cut_lineage(features.join(known, "doc_id").select("label", *FEATURES))
    seen = rows.agg(F.count("*").alias("n"), F.sum("label").alias("good")).first()
    if not seen["n"] or seen["good"] in (0, seen["n"]):
        return None
    model = LogisticRegression(regParam=1e-4, maxIter=60).fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("label", "features"))
    return [float(x) for x in model.coefficients], float(model.intercept), seen["good"] / seen["n"]


def shrunk(groups: DataFrame, parent: Column, most: float = 1e6) -> float:
    """Pseudo-documents of the prior: method of moments over ``groups`` (n, good) around ``parent``.

    The rates' spread beyond what n documents each explain is the spread between
    groups; without any, the prior outweighs every group.
    """
    n, rate = F.col("n").cast("double"), F.col("good") / F.col("n")
    row = groups.where("n > 0").select(n.alias("n"), ((rate - parent) * (rate - parent)).alias("d"), (parent * (1 - parent)).alias("v")).agg(
        F.sum(F.col("n") * F.col("d")).alias("d"), F.sum("v").alias("v"), F.sum(F.col("n") * F.col("v")).alias("nv"),
        F.sum("n").alias("n")).first()
    if not row["n"] or not row["nv"]:
        return most
    # E[sum n d] = sum v (1 + (n - 1) / (m + 1)), so 1 / (m + 1) is
    inside = (row["d"] - row["v"]) / max(row["nv"] - row["v"], 1e-9)
    return most if inside <= 1 / most else max(1 / inside - 1, 1.0)


def classify(docs: DataFrame, labels: DataFrame, *, host: Column | None = None, path: Column | None = None,
             sites: DataFrame | None = None, sample: int = 20_000, least: float = 0.5) -> DataFrame:
    """doc_id, host, path, evidence, host_rate, path_rate, quality, accepted, text_hash, own_host, own_path: one row per document.

    ``sites`` (doc_id, site_host, site_path; one row per doc_id) goes before the
    document's ``own`` host and path. It is joined to the features, never to the texts.
    """
    host, path = F.col("source") if host is None else host, F.col("lang") if path is None else path
    features = text_features(docs, host, path).withColumnsRenamed({"host": "own_host", "path": "own_path"})
    if sites is None:
        features = features.select("*", F.col("own_host").alias("host"), F.col("own_path").alias("path"))
    else:
        known = F.col("site_host").isNotNull()
        features = features.join(sites, "doc_id", "left").select(
            *features.columns, F.when(known, F.col("site_host")).otherwise(F.col("own_host")).alias("host"),
            F.when(known, F.col("site_path")).otherwise(F.col("own_path")).alias("path"))
    features = cut_lineage(features)
    model = fit(features, labels, sample)
    if model is None:
        score = F.lit(0.0)
        prior = 0.5
    else:
        weights, intercept, prior = model
        score = F.lit(intercept) + sum((F.col(f) * w for f, w in zip(FEATURES, weights)), F.lit(0.0))
    base = math.log(prior / (1 - prior))
    scored = features.select("doc_id", "host", "path", "text_hash", "own_host", "own_path", F.greatest(F.lit(-30.0), F.least(F.lit(30.0), score - base)).alias("evidence"))
    p = 1 / (1 + F.exp(-(F.col("evidence") + base)))
    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    every = paths.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0.0)).alias("good")).first()
    top = (every["good"] + prior) / (every["n"] + 1)
    m = shrunk(hosts, F.lit(top))
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("good") + m * top) / (F.col("n") + m)).alias("host_rate"))
    rates = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    m = shrunk(rates, F.col("host_rate"))
    rates = written(rates.select(F.col("host").alias("h"), F.col("path").alias("p"), "host_rate",
                                 ((F.col("good") + m * F.col("host_rate")) / (F.col("n") + m)).alias("path_rate")), "rates")
    out = scored.join(rates, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    rate = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("path_rate")))
    quality = 1 / (1 + F.exp(-(F.col("evidence") + F.log(rate / (1 - rate)))))
    accepted = F.lit(True) if model is None else quality >= least
    return out.select("doc_id", "host", "path", "evidence", "host_rate", "path_rate", quality.alias("quality"),
                      accepted.alias("accepted"), "text_hash", "own_host", "own_path")


def keep_accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are accepted, with all their columns."""
    good = classify(docs, labels, **options).where("accepted").select(F.col("doc_id").alias("k"), F.col("text_hash").alias("s"),
                                                                      F.col("own_host").alias("h"), F.col("own_path").alias("p")).distinct()
    host, path = options.get("host"), options.get("path")
    host, path = F.col("source") if host is None else host, F.col("lang") if path is None else path
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("doc_k"),
                       F.xxhash64(whole_text("text")).alias("doc_s"), host.cast("string").alias("doc_h"), path.cast("string").alias("doc_p"))
    same = (F.col("doc_k").eqNullSafe(F.col("k")) & (F.col("doc_s") == F.col("s"))
            & F.col("doc_h").eqNullSafe(F.col("h")) & F.col("doc_p").eqNullSafe(F.col("p")))
    return rows.join(good, same, "left_semi").select("row.*")
