"""Toxicity scores by non-negative positive-unlabelled (nnPU) learning.

A linear classifier is trained in numpy from confirmed toxic examples and
unlabelled text.  With the class prior pi, the risk is

    pi * E_P[l(f)] + max(0, E_U[l(-f)] - pi * E_P[l(-f)])

for the logistic loss l: what toxic texts add to the unlabelled risk is taken
out again, and where that estimate turns negative the step goes the other way,
so the model cannot fit the unlabelled sample by calling all of it clean.

Features are the presence of words and of word beginnings (hashed), chosen
where they are over-represented among the examples; a group of near copies
counts as one example.  Their unlabelled frequencies are counted over all
documents of the training folds; the risk is minimised on samples of bounded
size; every whole text is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.arrays import IS_SPACE, distinct_pairs, text_slices, word_beginnings
from lakemart.llm.jaccard_join import near_groups
from lakemart.llm.memory import light
from lakemart.llm.packed import saved

#: Bounds of the training samples, in documents: labelled examples, and unlabelled
#: texts for the risk's gradient.  Features are chosen by counts over all documents.
EXAMPLES, UNLABELLED = 4096, 8192
#: Lengths in bytes of the word beginnings used beside whole words.
BEGINNINGS = (4, 5, 6)
#: A feature is chosen if it stands in so many examples at least, and its frequency
#: among them is so many standard errors and times above the unlabelled one.
LEAST_DOCS, LEAST_SIGMA, LEAST_RATIO = 4, 4.0, 3.0

#: What does not belong to words: ASCII control characters, spaces and signs.
NO_WORD = IS_SPACE.copy()
NO_WORD[:48] = NO_WORD[58:65] = NO_WORD[91:97] = NO_WORD[123:128] = True


def document_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature hash) of every word and word beginning."""
    return word_beginnings(data, off, BEGINNINGS, NO_WORD)


class Model:
    """Weights of the chosen features (sorted hashes) and a bias."""

    def __init__(self, features: np.ndarray):
        order = np.argsort(features)
        self.features, self.weights, self.bias = features[order], np.zeros(len(features)), -4.0

    def present(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, feature index) pairs of the chosen features."""
        if not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        doc, h = document_features(data, off)
        at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
        on = self.features[at] == h
        key = np.unique(doc[on] * len(self.features) + at[on])
        return key // len(self.features), key % len(self.features)

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        doc, at = self.present(data, off)
        z = np.bincount(doc, self.weights[at], minlength=len(off) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def train(self, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
              steps: int = 600, rate: float = 0.1) -> None:
        """nnPU by Adam over both samples; each document is its array of feature indexes."""
        p, u = self._rows(positive), self._rows(unlabelled)
        decay = min(1e-3, 0.3 / max(1, len(positive)))  # the fewer the examples, the smaller the weights
        n = len(self.features)
        theta = np.append(self.weights, self.bias)
        m, v = np.zeros(n + 1), np.zeros(n + 1)

        def slope(rows, sign):
            """Gradient and value of E[l(sign * f)]."""
            owner, at, size = rows
            z = sign * (np.bincount(owner, theta[at], minlength=size) + theta[n])
            g = -sign / (1 + np.exp(np.clip(z, -40, 40))) / size
            return np.append(np.bincount(at, g[owner], minlength=n), g.sum()), np.logaddexp(0, -z).mean()

        for t in range(1, steps + 1):
            up, _ = slope(p, 1.0)
            down, p_neg = slope(p, -1.0)
            rest, u_neg = slope(u, -1.0)
            clean = u_neg - prior * p_neg
            g = prior * up + (rest - prior * down if clean >= 0 else prior * down - rest)
            g[:n] += decay * theta[:n]
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        self.weights, self.bias = theta[:n], float(theta[n])

    @staticmethod
    def _rows(docs: list[np.ndarray]):
        size = np.array([len(x) for x in docs])
        return np.repeat(np.arange(len(docs)), size), np.concatenate([*docs, np.zeros(0, np.int64)]).astype(np.int64), len(docs)


def fold_of(id_col: Column) -> Column:
    """crc32 of the id's text, modulo 3."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 1, prior: float | None = None) -> Model:
    """Train on documents (doc_id, text) and labels (doc_id, toxic) outside the
    held-out fold.

    The prior, unless given, is the share of toxic rows among the labels used.
    Rows with null ids or labels are not used; of rows equal in id and text one
    enters the samples, and rows of one id and different texts are different
    documents.  Without toxic examples the
    model has no features and scores all texts alike, near 0.
    """
    spark = docs.sparkSession
    used = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold_of(F.col("doc_id")) != held_out))
    marks = used.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = marks.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    if not share:
        return Model(np.zeros(0, np.uint64))
    prior = share if prior is None else prior
    fold = docs.where(F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) != held_out)).select("doc_id", F.xxhash64("text").alias("h"), "text")

    def first(rows: DataFrame, n: int, name: str) -> DataFrame:
        """``n`` different (doc_id, text) of the rows, chosen by a hash."""
        return rows.select("doc_id", "h").distinct().orderBy(F.xxhash64("doc_id", "h"), "doc_id", "h").limit(n).withColumn(name, F.lit(1))

    examples = first(fold.join(marks.where("toxic = 1").select("doc_id"), "doc_id", "left_semi"), EXAMPLES, "p")
    chosen = examples.join(first(fold, UNLABELLED, "u"), ["doc_id", "h"], "full")
    # at most EXAMPLES + UNLABELLED keys; equal rows of the table count as one
    sample = saved(fold.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]), spark)
    # copies of an example bring words that only they have: a group of copies is one example
    numbered = saved(sample.withColumn("doc", F.monotonically_increasing_id()), spark)
    copies = near_groups(numbered.where("p = 1").select("doc", "text"), id_col="doc", words=5, percent=80).select("doc", F.col("component_id").alias("example"))
    sample = saved(numbered.join(F.broadcast(copies), "doc", "left").select("text", "example", "u"), spark)
    n_p = sample.agg(F.count_distinct("example")).first()[0]

    def frequencies(batches):
        for b in batches:
            example = b.column(1)
            for row, past, data, off in text_slices(b.column(0)):
                doc, h = distinct_pairs(*document_features(data, off))
                yield pa.record_batch([pa.array(h.view(np.int64)), example.take(pa.array(doc + row))], names=["f", "example"])

    held = sample.where("example IS NOT NULL").select("text", "example").mapInArrow(light(frequencies), "f long, example long").distinct()
    often = held.groupBy("f").agg(F.count("*").alias("p")).where(F.col("p") >= LEAST_DOCS)
    # features of at most EXAMPLES texts
    candidates = {r["f"]: r["p"] for r in often.collect()}
    if not candidates:
        return Model(np.zeros(0, np.uint64))
    shared = spark.sparkContext.broadcast(np.sort(np.array([*candidates], np.int64).view(np.uint64)))

    def everywhere(batches):
        """Documents of the fold that have each candidate; the sum of a task."""
        known = shared.value
        total, docs_seen = np.zeros(len(known), np.int64), 0
        for b in batches:
            docs_seen += b.num_rows
            for _, _, data, off in text_slices(b.column(0)):
                doc, h = document_features(data, off)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                on = known[at] == h
                key = np.unique(doc[on] * len(known) + at[on])
                total += np.bincount(key % len(known), minlength=len(known))
        on = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(known[on].view(np.int64), 0)), pa.array(np.append(total[on], docs_seen)),
                               pa.array([True] * len(on) + [False])], names=["f", "u", "feature"])

    seen = saved(fold.select("text").mapInArrow(light(everywhere), "f long, u long, feature boolean").groupBy("feature", "f").agg(F.sum("u").alias("u")), spark)
    n_u = seen.where("NOT feature").agg(F.sum("u")).first()[0]
    counts = often.join(seen.where("feature").select("f", "u"), "f")
    rate_p, rate_u = F.col("p") / F.lit(max(n_p, 1)), (F.col("u") + 1) / F.lit(n_u + 1)
    error = F.sqrt(rate_u * (1 - rate_u) / F.lit(max(n_p, 1)))
    best = (counts.where((F.col("p") >= LEAST_DOCS) & (rate_p >= LEAST_RATIO * rate_u) & (rate_p - rate_u >= LEAST_SIGMA * error))
            .select("f").collect())
    model = Model(np.array([r["f"] for r in best], dtype=np.int64).view(np.uint64))
    if not best:
        return model

    def presence(batches):
        for b in batches:
            for row, past, data, off in text_slices(b.column(0)):
                doc, at = model.present(data, off)
                ends = np.searchsorted(doc, np.arange(past - row + 1))
                got = [at[ends[k]: ends[k + 1]] for k in range(past - row)]
                yield pa.record_batch([pa.array(got, pa.list_(pa.int64())), b.column(1).slice(row, past - row),
                                       b.column(2).slice(row, past - row)], names=["at", "example", "u"])

    rows = sample.mapInArrow(light(presence), "at array<long>, example long, u int").collect()  # a row of indexes for each sampled text
    rows.sort(key=lambda r: (r["at"], r["u"] or 0))  # the same sums in any order of arrival
    examples: dict[int, list[int]] = {}
    for r in rows:
        if r["example"] is not None:
            examples.setdefault(r["example"], []).extend(r["at"])
    model.train([np.unique(np.array(examples[k], np.int64)) for k in sorted(examples)],
                [np.array(r["at"], np.int64) for r in rows if r["u"]], prior)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), out: str = "score") -> DataFrame:
    """The columns ``keep`` of every row and ``out``: the probability that its text is toxic.

    Nothing but the text enters a score.  Null and empty texts get the score of
    a text without features.  Null ids and repeated rows stay as they are.
    ``out`` must not be one of ``keep``.
    """
    def run(batches):
        for b in batches:
            got = [model.score(data, off) for _, _, data, off in text_slices(b.column(b.num_columns - 1))]
            yield pa.record_batch([*b.columns[:-1], pa.array(np.concatenate([*got, np.zeros(0)]))], names=[*keep, out])

    src = docs.select(*keep, F.col(text_col).alias("__text"))
    return src.mapInArrow(light(run), ", ".join(f"`{c}` {t}" for c, t in src.dtypes[:-1]) + f", `{out}` double")
