"""Toxicity by a classifier chain.

Each category has a linear model.  They are applied in a fixed order, and each
sees the probabilities of the categories before it beside the words of the
text.  In training, those probabilities are out-of-fold: every row is scored by
models that have not seen it, so that later models learn how far earlier ones
can be trusted.

Features are the lower-cased words of a text and the beginnings of longer words,
present or absent.  The models are fitted on the driver on at most ``SAMPLE``
labelled documents, those with the smallest hash of their id, and all features
that depart from the share of a category by Fisher's exact test, at a false
discovery rate of ``LEVEL`` (Benjamini and Hochberg), so that the number of
labels sets no limit of its own; every document is scored, over its whole text.

Defined cases: a null or empty text has no features and gets the models'
intercepts; labels that are null, or of documents not there, are left out, a null
one for its own category only; if an id has several labels, the largest counts, and each of its texts is a row; with one class only, a
category has the constant probability of that class, kept from 0 and 1; without
labels nothing is rejected (probability 0); an empty table gives an empty
result; other columns are ignored by ``scores``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import small_frame, written

SAMPLE = 10_000
FOLDS = 5
STEPS = 400
PENALTY = 1e-4
#: The share of chance finds among the features kept for a category.
LEVEL = 0.05
PREFIXES = (4, 5)
THRESHOLD = 0.5
_WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str | None) -> set[str]:
    words = set(_WORD.findall((text or "").lower()))
    starts = {f"{w[:n]}*" for n in PREFIXES for w in words if len(w) > n}
    return words | starts


@dataclass
class Rows:
    """Which features rows have, and their probabilities of earlier categories."""

    count: int
    width: int
    row: np.ndarray
    column: np.ndarray
    earlier: np.ndarray

    @classmethod
    def of(cls, found: list[list[int]], width: int) -> Rows:
        row = np.repeat(np.arange(len(found)), [len(f) for f in found])
        column = np.fromiter((c for f in found for c in f), np.int64, len(row))
        return cls(len(found), width, row, column, np.zeros((len(found), 0)))

    def taken(self, mask: np.ndarray) -> Rows:
        kept = mask[self.row]
        row = (np.cumsum(mask) - 1)[self.row[kept]]
        return Rows(int(mask.sum()), self.width, row, self.column[kept], self.earlier[mask])

    def beside(self, probability: np.ndarray) -> Rows:
        earlier = np.concatenate([self.earlier, probability[:, None]], axis=1)
        return Rows(self.count, self.width, self.row, self.column, earlier)

    def times(self, weights: np.ndarray) -> np.ndarray:
        own = np.bincount(self.row, weights[self.column], self.count)
        return own + self.earlier @ weights[self.width :]

    def back(self, rows: np.ndarray) -> np.ndarray:
        own = np.bincount(self.column, rows[self.row], self.width)
        return np.concatenate([own, self.earlier.T @ rows])


@dataclass
class Linear:
    """Logistic regression with an L2 penalty, by accelerated gradient descent."""

    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, x: Rows, y: np.ndarray) -> Linear:
        columns = x.width + x.earlier.shape[1]
        if not len(y) or y.min() == y.max():
            share = (y.sum() + 0.5) / (len(y) + 1)
            return cls(np.zeros(columns), float(np.log(share / (1 - share))))
        curvature = 0.25 * (_largest(x, columns) + 1) + PENALTY
        w = ahead = np.zeros(columns)
        b = b_ahead = 0.0
        t = 1.0
        for _ in range(STEPS):
            wrong = (_probability(x.times(ahead) + b_ahead) - y) / len(y)
            w_next = ahead - (x.back(wrong) + PENALTY * ahead) / curvature
            b_next = b_ahead - float(wrong.sum()) / curvature
            t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
            ahead = w_next + (t - 1) / t_next * (w_next - w)
            b_ahead = b_next + (t - 1) / t_next * (b_next - b)
            w, b, t = w_next, b_next, t_next
        return cls(w, b)

    def probability(self, x: Rows) -> np.ndarray:
        return _probability(x.times(self.weights) + self.bias)


def _largest(x: Rows, columns: int) -> float:
    """The largest eigenvalue of the mean Gram matrix, by power iteration."""
    v, size = np.ones(columns), 1.0
    for _ in range(12):
        v = x.back(x.times(v)) / x.count
        size = float(np.linalg.norm(v)) or 1.0
        v /= size
    return 1.2 * size


def _probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _chance(total: int, positive: int, n: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Two-sided p-values of ``k`` positive among ``n`` rows, if features and category are independent."""
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, total + 1)))])

    def choose(a: np.ndarray | int, b: np.ndarray) -> np.ndarray:
        return logs[a] - logs[b] - logs[a - b]

    def tail(step: int) -> np.ndarray:
        out, at, live = np.zeros(len(n)), k.copy(), np.arange(len(n))
        while len(live):
            x, of = at[live], n[live]
            live = live[(x <= np.minimum(of, positive)) & (x >= np.maximum(0, of - (total - positive)))]
            x, of = at[live], n[live]
            term = np.exp(choose(positive, x) + choose(total - positive, of - x) - choose(total, of))
            out[live] += term
            at[live] += step
            # terms rise up to the expected count and fall behind it
            live = live[(term > 1e-9 * out[live]) | (step * (x - of * positive / total) < 0)]
        return out

    return np.minimum(1.0, 2 * np.minimum(tail(1), tail(-1)))


def _discovered(p: np.ndarray, times: np.ndarray, level: float) -> np.ndarray:
    """Which p-values, each of so many features, pass at the false discovery rate."""
    order = np.argsort(p, kind="stable")
    rank = np.cumsum(times[order])
    passing = np.flatnonzero(p[order] <= level * rank / max(1, times.sum()))
    return p <= (p[order][passing[-1]] if len(passing) else -1.0)


@dataclass
class Chain:
    """Models of the categories in order, and the features they share."""

    categories: list[str]
    vocabulary: dict[str, int]
    models: list[Linear] = field(default_factory=list)

    def rows(self, texts: list[str | None]) -> Rows:
        return Rows.of([self.columns(t) for t in texts], len(self.vocabulary))

    def columns(self, text: str | None) -> list[int]:
        known = self.vocabulary.keys() & features_of(text)
        return [self.vocabulary[f] for f in known]

    def fit(self, x: Rows, labels: np.ndarray, folds: np.ndarray) -> Chain:
        """``labels`` are 0 or 1, or not a number where a row has none for a category."""
        for k in range(len(self.categories)):
            y = labels[:, k]
            known = ~np.isnan(y)
            held_out = np.zeros(len(y))
            for fold in range(FOLDS):
                rest = folds != fold
                model = Linear.fit(x.taken(rest & known), y[rest & known])
                held_out[~rest] = model.probability(x.taken(~rest))
            self.models.append(Linear.fit(x.taken(known), y[known]))
            x = x.beside(held_out)
        return self

    def probabilities(self, x: Rows) -> np.ndarray:
        out = []
        for model in self.models:
            out.append(model.probability(x))
            x = x.beside(out[-1])
        return np.stack(out, axis=1)


def fit_chain(
    documents: DataFrame, labels: DataFrame, categories: dict[str, Column],
    sample: int = SAMPLE, level: float = LEVEL, doc_id: str = "doc_id", text: str = "text",
) -> Chain:
    """A chain for ``categories``: conditions on the columns of ``labels`` and on ``text``.

    The sample's ids are broadcast, ``sample`` at most, so documents are not shuffled.
    """
    names = list(categories)
    label_columns = [F.col(f"`{c}`") for c in labels.columns if c != "doc_id"]
    chosen = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(*[F.max(c).alias(n) for c, n in zip(label_columns, (c for c in labels.columns if c != "doc_id"), strict=True)])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "text", *[condition.cast("int").alias(n) for n, condition in categories.items()]
    )
    rows = rows.dropna("all", subset=names)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [list(features_of(t)) for t in batch.column("text").to_pylist()]
            kept = [batch.column(n) for n in ("doc_id", *names)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sets, pa.list_(pa.string()))], names=["doc_id", *names, "features"])

    schema = "doc_id long, " + ", ".join(f"`{n}` int" for n in names) + ", features array<string>"
    sampled = written(rows.mapInArrow(found, schema), "sample")
    known = [F.count(n).alias(f"n{k}") for k, n in enumerate(names)]
    positive = [F.coalesce(F.sum(n), F.lit(0)).alias(f"p{k}") for k, n in enumerate(names)]
    sizes = sampled.agg(F.count(F.lit(1)).alias("rows"), *known, *positive).first()
    if not sizes["rows"]:
        return Chain(names, {})
    counts = sampled.select(*names, F.explode("features").alias("feature")).groupBy("feature").agg(*known, *positive)
    counts = written(counts, "counts")
    # a feature passes by its counts alone, so the driver gets the different counts and the features that pass
    chosen: set[str] = set()
    for k in range(len(names)):
        kinds = counts.groupBy(f"n{k}", f"p{k}").agg(F.count(F.lit(1)).alias("times")).toArrow()
        n, p, times = (c.to_numpy().astype(np.int64) for c in kinds.columns)
        passing = _discovered(_chance(sizes[f"n{k}"], sizes[f"p{k}"], n, p), times, level)
        pairs = small_frame(documents.sparkSession, {f"n{k}": pa.array(n[passing]), f"p{k}": pa.array(p[passing])})
        chosen |= {r[0] for r in counts.join(F.broadcast(pairs), [f"n{k}", f"p{k}"]).select("feature").collect()}
    vocabulary = {f: k for k, f in enumerate(sorted(chosen))}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[vocabulary[f] for f in of if f in vocabulary] for of in batch.column("features").to_pylist()]
            kept = [batch.column(n) for n in ("doc_id", *names)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(columns, pa.list_(pa.int32()))], names=["doc_id", *names, "columns"])

    data = sampled.mapInArrow(numbered, schema.replace("features array<string>", "columns array<int>")).orderBy("doc_id").collect()
    chain = Chain(names, vocabulary)
    x = Rows.of([r["columns"] for r in data], len(vocabulary))
    y = np.array([[np.nan if r[n] is None else r[n] for n in names] for r in data], np.float64).reshape(len(data), len(names))
    folds = np.array([r["doc_id"] * 2654435761 % (1 << 32) * FOLDS >> 32 for r in data])
    return chain.fit(x, y, folds)


def scores(documents: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the probability of each category, a double named as it is."""
    names = chain.categories

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = chain.rows(part.column(1).to_pylist())
                p = chain.probabilities(x) if chain.models else np.zeros((x.count, len(names)))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.float64()) for c in p.astype(np.float64).T]], names=["doc_id", *names])

    schema = "doc_id long, " + ", ".join(f"`{n}` double" for n in names)
    rows = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(scored, schema)


def kept_documents(
    documents: DataFrame, chain: Chain, category: str, threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """The rows of ``documents`` below the threshold, with all their columns; one pass, no shuffle.

    A null text is empty; every row is judged by itself, so repeated rows fare alike.
    """
    position = chain.categories.index(category)
    names = documents.columns
    # numbered columns, as a name may hold a dot
    numbered = documents.toDF(*[f"c{n}" for n in range(len(names))])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = chain.rows(part.column(names.index(text)).to_pylist())
                if chain.models:
                    part = part.filter(pa.array(chain.probabilities(x)[:, position] < threshold))
                yield part

    return numbered.mapInArrow(keep, numbered.schema).toDF(*names)
