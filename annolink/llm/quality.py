"""Quality classifier by co-training of two views.

The *content* view sees figures of the text (shares of characters, words, lines), the
*metadata* view sees language, source and stated length. Both are logistic models over
quantile bins. In each round, each view gives the documents without a label of which it is
sure, in both classes, as pseudo-labels to the other view: of all such documents the surest tenth,
by a threshold counted over all of them. How sure it is, is measured: the
scores are calibrated on labelled rows kept apart. The calibrated views are then combined by
a logistic model on these rows, and all documents are scored.

Labels come from a bounded sample, ``labelled_rows`` documents by order of a hash of their id, one
row of each. The documents without a label all take part: their figures are written once, the rounds
so far (two small models and four thresholds each) tell in every task which of them have a pseudo-label, and a
model is fitted by sums over them, of a size that the bins fix. All documents are scored, by their whole texts.

Cases: very long texts are read whole, and further columns do not matter. Languages and sources that no
labelled row has share one bin. A null text is an empty text; null language, source and length are values of their
own. Labels that are null, or of unknown documents, are left out; of contradicting labels of
one document the larger counts. Without labels of both classes every document scores 0.5 and
is kept. Rows that share an id are scored each. An empty table gives an empty result.
"""

from __future__ import annotations

import copy
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import remainder, shared, without
from annolink.staging import stage

LABELLED_ROWS = 20_000
ROUNDS = 3
SURE = 0.95
SHARE_TAKEN = 0.1
# What a pseudo-label counts, and the change of a coefficient at which a fit is done.
GIVEN_WEIGHT, CLOSE = 0.5, 1e-3
BINS = 16
# Steps of a certainty, per unit of its logit, by which documents are counted.
STEPS = 256
# Rows that are worked on together, and sums of tasks that are added in one place.
ROWS, ADDED = 4_000, 64

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_MARKS = b".,;:'\"()-"
_LOUD = b"!?"
_ODD = b"#$%&*+/<=>@[\\]^_`{|}~"
_HIGH = bytes(range(128, 256))
N_CONTENT = 14


def content_figures(text: bytes) -> list[float]:
    size = len(text)
    if not size:
        return [0.0] * N_CONTENT
    shares = [(size - len(text.translate(None, part))) / size for part in (_UPPER, _LOWER, _DIGITS, _MARKS, _LOUD, _ODD, _HIGH)]
    words, lines = text.split(), text.split(b"\n")
    distinct = len(set(words))
    n = max(1, len(words))
    return [
        *shares,
        np.log1p(size),
        np.log1p(len(words)),
        size / n,
        distinct / n,
        len(set(lines)) / len(lines),
        n / len(lines),
        text.count(b"http") / n,
    ]


def metadata_figures(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    def number(value):
        return -1.0 if value is None else float(xxhash.xxh64_intdigest(value) >> 11)

    return [number(lang), number(source), -1.0 if n_chars is None else float(np.log1p(max(0, n_chars)))]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class View:
    """Logistic model over one-hot bins of some figures, with calibrated output."""

    def __init__(self, nominal: tuple = ()):
        self.nominal = nominal

    def bins(self, x):
        """Fix the bins by the labelled rows: a value each, and one for all others, or equal shares of the rows."""
        self.edges = [
            np.unique(x[:, j]) if j in self.nominal else np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))
            for j in range(x.shape[1])
        ]
        sizes = [len(e) + 1 for e in self.edges]
        self.offsets, self.width = np.r_[0, np.cumsum(sizes)[:-1]], sum(sizes) + 1
        self.coef, self.scale = np.zeros(self.width), (1.0, 0.0)
        return self

    def _hot(self, x):
        columns = []
        for j, edges in enumerate(self.edges):
            if j in self.nominal:
                at = np.searchsorted(edges, x[:, j])
                known = (at < len(edges)) & (edges[np.minimum(at, len(edges) - 1)] == x[:, j])
                columns.append(np.where(known, at, len(edges)))
            else:
                columns.append(np.searchsorted(edges, x[:, j], "right"))
        return np.column_stack(columns) + self.offsets

    def sums(self, x, y, weight: float):
        """Gradient and curvature of the loss over some rows."""
        gradient, curve = np.zeros(self.width), np.zeros((self.width, self.width))
        for start in range(0, len(x), ROWS):
            hot = self._hot(x[start : start + ROWS])
            design = np.zeros((len(hot), self.width))
            design[np.arange(len(hot))[:, None], hot] = 1
            design[:, -1] = 1
            p = _sigmoid(design @ self.coef)
            gradient += design.T @ (weight * (p - y[start : start + ROWS]))
            curve += (design * (weight * p * (1 - p))[:, None]).T @ design
        return gradient, curve

    def step(self, gradient, curve) -> float:
        """One step of Newton's method; its greatest change."""
        ridge = np.r_[np.full(self.width - 1, 1.0), 1e-6]
        change = np.linalg.solve(curve + np.diag(ridge), gradient + ridge * self.coef)
        self.coef = self.coef - change
        return float(np.abs(change).max())

    def raw(self, x):
        return self.coef[self._hot(x)].sum(axis=1) + self.coef[-1]

    def calibrate(self, x, y):
        self.scale = _line(self.raw(x)[:, None], y)
        return self

    def logit(self, x):
        *slope, base = self.scale
        return self.raw(x) * slope[0] + base


def _line(x, y):
    """Logistic regression on few columns, slopes not negative: slopes and base."""
    columns = list(range(x.shape[1]))
    while True:
        design = np.column_stack([x[:, columns], np.ones(len(x))])
        coef = np.zeros(design.shape[1])
        for _ in range(50):
            p = _sigmoid(design @ coef)
            curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(len(coef))
            coef -= np.linalg.solve(curve, design.T @ (p - y) + 1e-3 * coef)
        if (coef[:-1] >= 0).all():
            result = np.zeros(x.shape[1] + 1)
            result[columns], result[-1] = coef[:-1], coef[-1]
            return tuple(result)
        columns = [c for c, value in zip(columns, coef, strict=False) if value >= 0]


class History:
    """What each round gave: both views as they were, and the least level for (view, label)."""

    def __init__(self):
        self.rounds: list[tuple[list[View], dict]] = []

    def given(self, x) -> list[np.ndarray]:
        """The pseudo-labels that rows, by the figures of both views, have for each view: -1 for none."""
        given = [np.full(len(x[0]), -1) for _ in x]
        for views, least in self.rounds:
            for k, view in enumerate(views):
                logit = view.logit(x[k])
                for label in (1, 0):
                    sure = levels(logit, label) >= least[k, label]
                    given[1 - k][sure & (given[1 - k] < 0)] = label
        return given


def levels(logit: np.ndarray, label: int) -> np.ndarray:
    """How sure a label is, in steps of its logit."""
    return np.floor(np.clip(logit if label else -logit, -30, 30) * STEPS).astype(np.int64)


def _both(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.flatten().to_numpy().reshape(len(c), -1) for c in batch.columns[:2]]


def _open_counts(pool: DataFrame, history: History, views: list[View], sure: int) -> list:
    """(view, label, level, n): rows without a pseudo-label by how sure a view is of one, from ``sure`` on."""
    held = shared(pool.sparkSession, (history, views))

    def task(batches):
        history, views = held()
        for batch in batches:
            if not batch.num_rows:
                continue
            x, rows = _both(batch), []
            given = history.given(x)
            for k, view in enumerate(views):
                logit = view.logit(x[k])
                for label in (1, 0):
                    level = levels(logit, label)
                    found, n = np.unique(level[(given[1 - k] < 0) & (level >= sure)], return_counts=True)
                    rows += [(k, label, int(v), int(c)) for v, c in zip(found, n, strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k", "label", "level", "n"])

    counts = pool.mapInArrow(task, "k long, label long, level long, n long")
    # At most a row per level, label and view.
    return counts.groupBy("k", "label", "level").agg(F.sum("n").alias("n")).collect()


def _pool_sums(pool: DataFrame, history: History, views: list[View]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Gradient and curvature of each view's loss over the rows that have a pseudo-label for it."""
    held = shared(pool.sparkSession, (history, views))

    def task(batches):
        history, views = held()
        totals = [[np.zeros(v.width), np.zeros((v.width, v.width))] for v in views]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _both(batch)
            for k, given in enumerate(history.given(x)):
                has = given >= 0
                for total, part in zip(totals[k], views[k].sums(x[k][has], given[has], GIVEN_WEIGHT), strict=True):
                    total += part
        values = np.concatenate([np.r_[gradient, curve[np.triu_indices(len(curve))]] for gradient, curve in totals])
        yield pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary())], ["sums"])

    # One row per task, of a size that the bins fix.
    values, out = _added_up(pool.mapInArrow(task, "sums binary"), pool.rdd.getNumPartitions()), []
    for view in views:
        n, half = view.width, view.width * (view.width + 1) // 2
        curve = np.zeros((n, n))
        curve[np.triu_indices(n)] = values[n : n + half]
        out.append((values[:n], curve + np.triu(curve, 1).T))
        values = values[n + half :]
    return out


def _added_up(parts: DataFrame, n: int) -> np.ndarray:
    """The sum of ``n`` rows of numbers, ``ADDED`` in a task; the driver gets no more than these."""

    def total(rows) -> np.ndarray:
        return sum(np.frombuffer(row, np.float64) for row in rows)

    def task(batches):
        parts = [total(batch.column(0).to_pylist()) for batch in batches if batch.num_rows]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([sum(parts).tobytes()], pa.binary())], ["sums"])

    while n > ADDED:
        n = math.ceil(n / ADDED)
        parts = parts.repartition(n).mapInArrow(task, "sums binary")
    return total(row.sums for row in parts.collect())


class CoTrained:
    """Both views and their combination."""

    def __init__(self, content, metadata, labels, apart, pool: DataFrame, rounds=ROUNDS, sure=SURE):
        views = [View(), View(nominal=(0, 1))]
        x, fit, check = [content, metadata], ~apart, apart
        for view, figures in zip(views, x, strict=True):
            view.bins(figures[fit])
        history, n_pool = History(), pool.count()
        least_sure = int(math.ceil(math.log(sure / (1 - sure)) * STEPS))
        quota = max(1, int(SHARE_TAKEN * n_pool))
        self.n_given = [0, 0]
        for number in range(rounds + 1):
            for _ in range(25):
                more = _pool_sums(pool, history, views) if history.rounds else [(0.0, 0.0)] * 2
                changes = []
                for view, figures, (gradient, curve) in zip(views, x, more, strict=True):
                    own_gradient, own_curve = view.sums(figures[fit], labels[fit], 1.0)
                    changes.append(view.step(own_gradient + gradient, own_curve + curve))
                if max(changes) < CLOSE:
                    break
            for view, figures in zip(views, x, strict=True):
                view.calibrate(figures[check], labels[check])
            if number == rounds or not n_pool:
                break
            counts = _open_counts(pool, history, views, least_sure)
            least = {}
            for k in range(2):
                for label in (1, 0):
                    taken, least[k, label] = 0, least_sure
                    for level, n in sorted(((r.level, r.n) for r in counts if (r.k, r.label) == (k, label)), reverse=True):
                        if taken >= quota:
                            break
                        taken, least[k, label] = taken + n, level
                    self.n_given[1 - k] += taken
            # Steps make new arrays of coefficients, so these copies stay as they are.
            history.rounds.append(([copy.copy(view) for view in views], least))
        self.views = views
        self.blend = _line(np.column_stack([v.logit(f[check]) for v, f in zip(views, x, strict=True)]), labels[check])

    def scores(self, content, metadata):
        """Content, metadata and combined probability of good quality."""
        a, b = self.views[0].logit(content), self.views[1].logit(metadata)
        return _sigmoid(a), _sigmoid(b), _sigmoid(a * self.blend[0] + b * self.blend[1] + self.blend[2])


def _figures(docs: DataFrame, prepare, schema: str) -> DataFrame:
    """Run ``prepare()(content, metadata) -> columns`` over all documents, by batches."""
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        F.col("lang").cast("string"),
        F.col("source").cast("string"),
        F.col("n_chars").cast("long"),
    )

    def task(batches):
        work = prepare()
        for batch in batches:
            if not batch.num_rows:
                continue
            content = np.array([content_figures(t.as_py()) for t in batch.column(1)])
            metadata = np.array([metadata_figures(*v) for v in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)])
            columns = [batch.column(0), *work(content, metadata)]
            names = [part.split()[0] for part in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return rows.mapInArrow(task, schema)


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, **options) -> CoTrained | None:
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").cast("int").alias("label"))
    # At most labelled_rows rows of two numbers.
    sample = stage(known.orderBy(F.xxhash64("_id"), "_id").limit(labelled_rows).coalesce(1))
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    columns = "doc_id long, content array<double>, metadata array<double>"
    figures = stage(_figures(plain, lambda: lambda c, m: [pa.array(list(c)), pa.array(list(m))], columns))
    mine = figures.join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).groupBy("doc_id", "label")
    # One row of each id of the sample.
    held = mine.agg(F.min(F.struct("content", "metadata")).alias("of"), remainder(F.col("doc_id"), 5).alias("fold"))
    held = held.select("label", "fold", "of.content", "of.metadata").orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    label, fold = held["label"].to_numpy(), held["fold"].to_numpy()
    content = np.array(held["content"].to_pylist(), float).reshape(len(label), N_CONTENT)
    metadata = np.array(held["metadata"].to_pylist(), float).reshape(len(label), 3)
    apart = fold == 0
    if any(len(set(label[part])) < 2 for part in (apart, ~apart)):
        return None
    pool = stage(figures.join(known, F.col("doc_id") == F.col("_id"), "left_anti").select("content", "metadata"))
    return CoTrained(content, metadata, label, apart, pool, **options)


def score(docs: DataFrame, model: CoTrained | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, content_score, metadata_score, score, kept for every row."""
    held = shared(docs.sparkSession, model)

    def prepare():
        model = held()
        return model.scores if model else lambda content, metadata: [np.full(len(content), 0.5)] * 3

    rows = _figures(docs, prepare, "doc_id long, content_score double, metadata_score double, score double")
    return rows.withColumn("kept", F.col("score") >= threshold)


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` whose document is not rejected, with all their columns."""
    model = train(docs, labels, **options)
    return without(docs, lambda rows: score(rows, model, threshold).where(~F.col("kept")).select("doc_id"))
