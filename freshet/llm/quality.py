"""Quality classifier: a regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialise, select_id_text, utf8

#: A score from this value on predicts class 1.
THRESHOLD = 0.3
#: Weight of the pooled covariance in each class's, and of the pooled variances in that.
SHRINK, SHRINK_DIAGONAL = 0.1, 0.1
#: Values beyond so many pooled standard deviations count as this many.
CLIP = 8.0

_CLASSES = np.zeros((256, 6), np.int64)  # letters lower, upper, digits, stops, other ASCII marks, white space
for _b in range(128):
    _c = chr(_b)
    _CLASSES[_b, 0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c in ".,;:'\"-()?" else 5 if _c.isspace() else 4] = 1

FEATURES = (
    "log_words", "log_lines", "log_words_a_line", "word_length", "log_upper", "log_digits", "log_stops", "log_marks", "log_wide",
    "log_type_token", "log_repeated_next", "log_top_word", "log_repeated_lines", "worst_line_marks", "worst_line_upper", "log_junk_words", "entropy",
)


def _share(part: float, whole: float) -> float:
    """Log of a share, kept finite at both ends."""
    return float(np.log((part + 0.5) / (whole + 1.0)))


def statistics(text: str) -> list[float]:
    """The features of one whole text, in the order of FEATURES; finite for every text, empty ones too."""
    raw = utf8(text)
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lower, upper, digits, stops, marks, _ = (histogram @ _CLASSES).tolist()
    wide = int(histogram[128:].sum())
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, letters = len(words), lower + upper + wide
    seen = Counter(words)
    again = sum(map(bytes.__eq__, words, words[1:]))
    worst_marks = worst_upper = 0.0
    junk = 0
    for line in lines:
        counts = np.bincount(np.frombuffer(line, np.uint8), minlength=256) @ _CLASSES
        own = int(counts[0] + counts[1])
        worst_marks = max(worst_marks, (int(counts[4]) + 0.1) / (len(line) + 5))
        worst_upper = max(worst_upper, (int(counts[1]) + 0.1) / (own + 10))
        if counts[4] * 8 > own or counts[1] * 3 > own:
            junk += len(line.split())
    share = histogram[histogram > 0] / max(1, len(raw))
    return [
        float(np.log1p(n)), float(np.log1p(len(lines))), float(np.log1p(n / max(1, len(lines)))), len(raw) / (n + 1.0), _share(upper, letters), _share(digits, len(raw)), _share(stops, len(raw)), _share(marks, len(raw)), _share(wide, letters),
        _share(len(seen), n), _share(again, n), _share(max(seen.values(), default=0), n), _share(len(lines) - len(set(lines)), len(lines)), float(np.log(worst_marks + 0.01)), float(np.log(worst_upper + 0.01)), _share(junk, n), float(-(share * np.log(share)).sum()),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x array<double>`` of every whole text; null texts count as empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in id_and_text(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))], ["doc_id", "x"])

    return select_id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors, log determinants and log priors of classes 0 and 1; slope and offset of the score."""

    means: np.ndarray
    whiten: np.ndarray
    logdet: np.ndarray
    prior: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, with priors: differences of Mahalanobis distances."""
        z = np.clip((x - self.centre) / self.spread, -CLIP, CLIP)
        density = [self.prior[k] - 0.5 * self.logdet[k] - 0.5 * (((z - self.means[k]) @ self.whiten[k].T) ** 2).sum(axis=1) for k in (0, 1)]
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.log_odds(x) + self.offset, -30, 30)))


def is_held_out(column: str = "doc_id"):
    """Whether a document's labels are kept from the fit: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def _partial(transform):
    """A row for each task and entry of the classes' moments."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.array(batch.column(1).to_pylist(), float).reshape(len(y), -1)
            for k in np.unique(y):
                m = transform(x[y == k], int(k))
                total[int(k)] = total.get(int(k), 0) + m
        at = [(k, i, float(v)) for k, m in total.items() for i, v in enumerate(m)]
        yield pa.RecordBatch.from_arrays([pa.array([a[j] for a in at], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.float64()))], ["k", "i", "v"])

    return run


def _sums(rows: DataFrame, transform) -> dict[int, np.ndarray]:
    """Sums of transform(x, class) over all rows by class; the driver gets as many numbers as there are features squared."""
    out: dict[int, dict[int, float]] = {}
    for r in rows.mapInArrow(_partial(transform), "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r.k, {})[r.i] = r.v
    return {k: np.array([v[i] for i in range(len(v))]) for k, v in out.items()}


def fit(described: DataFrame, labels: DataFrame, label_col: str = "quality") -> Discriminant | None:
    """The discriminant of all labelled rows that aren't held out; None without rows of both classes.

    ``described`` is what :func:`features` returns. Labels other than 0 and 1, null labels and null ids don't count; a
    row that repeats counts again. Means and covariances are sums over all rows that Spark adds up; two more passes over
    the labelled rows fit slope and offset of the score.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)").where(~is_held_out())
    rows = materialise(described.join(known, "doc_id").select("y", "x"))
    d = len(FEATURES)
    moments = _sums(rows, lambda x, k: np.concatenate([[len(x)], x.sum(axis=0), (x**2).sum(axis=0)]))
    if set(moments) != {0, 1}:
        return None
    both = moments[0] + moments[1]
    centre = both[1 : d + 1] / both[0]
    spread = np.sqrt(np.maximum(both[d + 1 :] / both[0] - centre**2, 1e-6))

    def second(x: np.ndarray, k: int) -> np.ndarray:
        z = np.clip((x - centre) / spread, -CLIP, CLIP)
        return np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])

    seconds = _sums(rows, second)
    n = np.array([seconds[k][0] for k in (0, 1)])
    means = np.array([seconds[k][1 : d + 1] / n[k] for k in (0, 1)])
    covariance = np.array([seconds[k][d + 1 :].reshape(d, d) / n[k] - np.outer(means[k], means[k]) for k in (0, 1)])
    pooled = np.tensordot(n / n.sum(), covariance, 1)
    pooled = (1 - SHRINK_DIAGONAL) * pooled + SHRINK_DIAGONAL * np.diag(np.diag(pooled)) + 1e-4 * np.eye(d)
    factors = np.linalg.cholesky((1 - SHRINK) * covariance + SHRINK * pooled)
    model = Discriminant(means, np.linalg.inv(factors), 2 * np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1), np.log(n / n.sum()), centre, spread)

    for _ in range(6):  # Newton steps of a logistic fit in slope and offset on the log odds

        def step(x: np.ndarray, k: int) -> np.ndarray:
            f = np.clip(model.log_odds(x), -40, 40)
            p = 1 / (1 + np.exp(-np.clip(model.slope * f + model.offset, -30, 30)))
            w = p * (1 - p)
            return np.array([((k - p) * f).sum(), (k - p).sum(), (w * f * f).sum(), (w * f).sum(), w.sum()])

        s = sum(_sums(rows, step).values())
        hessian = np.array([[s[2], s[3]], [s[3], s[4]]]) + 1e-3 * n.sum() * np.eye(2)
        move = np.linalg.solve(hessian, s[:2])
        model.slope = max(0.02, model.slope + float(np.clip(move[0], -0.3, 0.3)))
        model.offset += float(np.clip(move[1], -2, 2))
    return model


def score(described: DataFrame, model: Discriminant | None) -> DataFrame:
    """``doc_id, score, predicted``; without a model every score is 0.5."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, -1)
            values = np.full(len(x), 0.5) if model is None else model.score(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), pa.array((values >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    return described.mapInArrow(run, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; a null doc_id isn't held out, repeated rows stay."""
    described = materialise(features(docs))
    return score(described, fit(described, labels)).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject; columns as they were. A row without doc_id stays."""
    gone = classify(docs, labels).where("predicted = 0").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
