"""Severity of toxic language by cumulative-link ordinal regression on sparse features.

P(grade > k) = sigmoid(w . x - theta_k) for k = 0, 1, 2: one weight vector for all ordered
thresholds. The expected severity is the sum of these, between 0 and 3.

Features are the words of a text and their leading four and six bytes, which carry the
stems of inflected languages, hashed to 2^18 columns; a column's value is the root of its
share of the text's words, so that long and short texts compare. Labels say toxic or not:
grade 0 is not toxic, and toxic texts are graded 1 to 3 by terciles of the share of words
that the training half ties to toxic texts (by chi-square; only such columns get a weight).

The model is fitted on the driver on at most ``max_toxic`` and ``max_clean`` labelled
documents, chosen by hash of the id; these bounds are parameters and do not depend on the
input's size. Half of each is held out to set the severity from which a document is
rejected: no more than ``clean_loss`` of the held-out clean ones may reach it. Scoring is
a projection over whole texts, without a shuffle.

Defined cases: a text that is null or without words has severity 0 and is kept; a label
that is null or not 0 or 1, or whose document is missing, is left out; a doc_id labelled
twice counts as toxic if one label says so; without labels of both kinds nothing is
rejected and all severities are 0; equal texts have equal severities; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstar.llm.text_hash import WHITE, Words, in_chunks, small

BITS = 18
COLUMNS = 1 << BITS
LEADING = (None, 4, 6)
GRADES = 3
# Least distance of the rejection severity from that of the held-out clean texts.
MARGIN = 0.05
# Every byte that is not a letter, a digit or part of a longer character separates words.
SEPARATORS = WHITE.copy()
SEPARATORS[[*range(0, 48), *range(58, 65), *range(91, 97), *range(123, 128)]] = True


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Columns and values of each text."""
    for run in in_chunks(texts):
        words = Words(run, SEPARATORS)
        columns = np.stack([(words.leading(n) >> np.uint64(64 - BITS)).astype(np.int32)
                            for n in LEADING], axis=1)
        for a, b in zip(words.offsets[:-1], words.offsets[1:]):
            found, counts = np.unique(columns[a:b], return_counts=True)
            yield found, np.sqrt(counts / max(1, b - a)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(COLUMNS, np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES, np.inf))
    cut: float = np.inf

    def exceed(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each text and k."""
        return sigmoid(scores[:, None] - self.thresholds[None, :])

    def score(self, texts: list[str | None]) -> np.ndarray:
        return np.array([float(self.weights[c] @ v) for c, v in features(texts)], np.float64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Sparse:
    """Rows of (columns, values) with products by a dense vector."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.n = len(rows)
        self.columns = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int32)
        self.values = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.float32)
        self.row = np.repeat(np.arange(self.n), [len(r[0]) for r in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * w[self.columns], self.n)

    def gather(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, self.values * r[self.row], COLUMNS)


def fit_ordinal(x: Sparse, grades: np.ndarray, steps: int = 300, rate: float = 0.3,
                ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the mean negative log likelihood.

    The thresholds are the first one and positive gaps, so they stay in order. The two
    classes weigh alike, whatever the sample's shares.
    """
    weight = np.where(grades > 0, 0.5 / max(1, (grades > 0).sum()), 0.5 / max(1, (grades == 0).sum()))
    p = np.zeros(COLUMNS + GRADES)
    m, v = np.zeros_like(p), np.zeros_like(p)
    edges = np.arange(GRADES)
    for step in range(1, steps + 1):
        w, first, gaps = p[:COLUMNS], p[COLUMNS], np.exp(p[COLUMNS + 1:])
        theta = first + np.concatenate(([0.0], np.cumsum(gaps)))
        above = sigmoid(x.dot(w)[:, None] - theta[None, :])
        upper = np.concatenate([np.ones((x.n, 1)), above], axis=1)
        lower = np.concatenate([above, np.zeros((x.n, 1))], axis=1)
        at = np.arange(x.n)
        likely = np.maximum(upper[at, grades] - lower[at, grades], 1e-12)
        slope = above * (1 - above)
        # the grade's own probability is upper - lower; each depends on one threshold
        d = np.zeros((x.n, GRADES))
        has_upper, has_lower = grades > 0, grades < GRADES
        d[at[has_upper], grades[has_upper] - 1] -= (slope[has_upper, grades[has_upper] - 1]
                                                    / likely[has_upper])
        d[at[has_lower], grades[has_lower]] += (slope[has_lower, grades[has_lower]]
                                                / likely[has_lower])
        d *= weight[:, None]
        by_theta = -d.sum(axis=0)
        gradient = np.concatenate([
            x.gather(d.sum(axis=1)) + ridge * w, [by_theta.sum()],
            [gaps[k - 1] * by_theta[edges >= k].sum() for k in range(1, GRADES)]])
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient ** 2
        p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return p[:COLUMNS].astype(np.float32), p[COLUMNS] + np.concatenate(
        ([0.0], np.cumsum(np.exp(p[COLUMNS + 1:]))))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_toxic: int, max_clean: int
                    ) -> DataFrame:
    """(doc_id, toxic, text) of at most so many documents of each kind.

    The bounded list of ids is broadcast, so the texts are not shuffled.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = known.where("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(
        known.where("toxic = 0").orderBy(*order).limit(max_clean))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def as_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        found = list(features(batch.column(1).to_pylist()))
        yield pa.record_batch(
            [batch.column(0), batch.column(2),
             pa.array([f[0] for f in found], pa.list_(pa.int32())),
             pa.array([f[1] for f in found], pa.list_(pa.float32()))],
            names=["doc_id", "toxic", "columns", "values"])


def telling(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int, least: float
            ) -> np.ndarray:
    """The columns that occur in more toxic than clean texts with a chi-square of ``least``.

    Rare columns that fall into toxic texts by chance would let the model learn its
    training texts by heart.
    """
    n, both = n_clean + n_toxic, clean + toxic
    cross = toxic * float(n_clean) - clean * float(n_toxic)
    spread = both * (n - both) * float(n_clean) * float(n_toxic)
    chi = n * cross ** 2 / np.maximum(spread, 1e-9)
    return (cross > 0) & (chi >= least)


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = 2500, max_clean: int = 3500,
        clean_loss: float = 0.002, least_evidence: float = 20.0) -> Model:
    """The model of a bounded sample of the labelled documents."""
    sample = labelled_sample(docs, labels, max_toxic, max_clean)
    table = sample.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        as_features, "doc_id bigint, toxic int, columns array<int>, values array<float>"
    ).toArrow().sort_by("doc_id")
    toxic = table["toxic"].to_numpy().astype(bool)
    rows = [(np.asarray(c.values, np.int32), np.asarray(v.values, np.float32))
            for c, v in zip(table["columns"], table["values"])]
    place = np.zeros(len(toxic), np.int64)
    for kind in (False, True):
        place[toxic == kind] = np.arange((toxic == kind).sum())
    train = place % 2 == 0
    if not (toxic & train).any() or not (~toxic & train).any():
        return Model()

    in_texts = [np.bincount(np.concatenate([rows[i][0] for i in np.flatnonzero(train & (toxic == k))]),
                            minlength=COLUMNS) for k in (False, True)]
    kept = telling(in_texts[0], in_texts[1], (~toxic & train).sum(), (toxic & train).sum(),
                   least_evidence)
    density = np.array([(v[kept[c]] ** 2).sum() for c, v in rows])
    grades = np.zeros(len(toxic), np.int64)
    terciles = np.quantile(density[toxic & train], [1 / 3, 2 / 3])
    grades[toxic] = 1 + np.searchsorted(terciles, density[toxic], side="right")

    chosen = [(c[kept[c]], v[kept[c]]) for c, v in rows]
    weights, thresholds = fit_ordinal(Sparse([chosen[i] for i in np.flatnonzero(train)]),
                                      grades[train])
    model = Model(weights, thresholds)
    held = np.flatnonzero(~train)
    severity = model.exceed(Sparse([rows[i] for i in held]).dot(weights)).sum(axis=1)
    clean = np.sort(severity[~toxic[held]]) if (~toxic[held]).any() else np.zeros(1)
    highest = clean[max(0, len(clean) - 1 - int(clean_loss * len(clean)))]
    # half-way to the next severity above, but not next to the clean ones
    higher = severity[severity > highest + MARGIN]
    next_one = higher.min() if len(higher) else float(GRADES)
    return Model(weights, thresholds, float(max(highest + MARGIN, (highest + next_one) / 2)))


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, p_above_0..2, severity, grade, rejected) of each document."""
    schema = pa.schema([("doc_id", pa.int64()), *[(f"p_above_{k}", pa.float64())
                                                  for k in range(GRADES)],
                        ("severity", pa.float64()), ("grade", pa.int32()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = batch.column(1).to_pylist()
            above = model.exceed(model.score(texts)) if texts else np.zeros((0, GRADES))
            above[[not t or not t.strip() for t in texts]] = 0
            severity = above.sum(axis=1)
            yield pa.record_batch(
                [batch.column(0), *[pa.array(above[:, k]) for k in range(GRADES)],
                 pa.array(severity), pa.array((above > 0.5).sum(axis=1), pa.int32()),
                 pa.array(severity >= model.cut)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, p_above_0 double, p_above_1 double, p_above_2 double, "
             "severity double, grade int, rejected boolean")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they were."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            severity = model.exceed(model.score(texts)).sum(axis=1) if texts else np.zeros(0)
            blank = np.array([not t or not t.strip() for t in texts], bool)
            yield batch.filter(pa.array(blank | (severity < model.cut)))

    return docs.mapInArrow(run, docs.schema)
