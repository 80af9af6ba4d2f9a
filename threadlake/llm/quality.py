"""Quality scores by co-training: a text view and a metadata view teach each other.

One logistic classifier sees the text only, the other the page's metadata only. In each
round each labels the unlabelled documents it is surest of, and the other learns from them.
The two are then calibrated on labelled documents kept aside and combined, and the
combined model scores every document.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import map_columns, text_or_empty, written

META_BUCKETS = 64
_CLASSES = 16


def _class_of(byte: int) -> int:
    char = chr(byte)
    if byte > 127:
        return 1
    if char.islower():
        return 2
    if char.isupper():
        return 3
    if char.isdigit():
        return 4
    if char == " ":
        return 0
    if char in "\n\r":
        return 5
    return {".": 6, ",": 7, "!": 8, "?": 9, "|": 10, "#": 11, "$": 12, "%": 13, "&": 14}.get(char, 15)


CLASS = bytes(_class_of(byte) for byte in range(256))


def text_features(text: str) -> np.ndarray:
    """What the text view sees: pairs of character classes, repetition, and shape of words."""
    raw = text.encode("utf-8", "surrogatepass")
    classes = np.frombuffer(raw.translate(CLASS), np.uint8).astype(np.int64)
    pairs = np.bincount(classes[:-1] * _CLASSES + classes[1:], minlength=_CLASSES**2) if len(raw) > 1 else np.zeros(_CLASSES**2)
    single = np.bincount(classes, minlength=_CLASSES)
    words = raw.split()
    n = max(1, len(words))
    lines = [line for line in raw.split(b"\n") if line]
    following = sum(map(bytes.__eq__, words, words[1:]))
    shape = np.array(
        [
            len(set(words)) / n,
            following / n,
            sum(map(len, words)) / n,
            max(map(len, words), default=0) / 100,
            len(set(lines)) / max(1, len(lines)),
            np.log1p(len(words)),
            float(not words),
        ]
    )
    size = max(1, len(raw))
    # Square roots spread out the rare pairs, which tell most.
    return np.concatenate([np.sqrt(pairs / size), np.sqrt(single / size), shape]).astype(np.float32)


def meta_features(lang, source, chars) -> np.ndarray:
    """What the metadata view sees; a null is a value of its own."""
    out = np.zeros(2 * META_BUCKETS + 3, np.float32)
    out[zlib.crc32(repr(lang).encode()) % META_BUCKETS] = 1
    out[META_BUCKETS + zlib.crc32(repr(source).encode()) % META_BUCKETS] = 1
    size = np.log1p(max(0, chars or 0))
    out[-3:] = size, size * size / 10, chars is None
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Logistic(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> Logistic:
    """Newton steps on standardised features with a ridge penalty."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-6, scale, 1.0)
    z = np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))].astype(np.float64)
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(z @ w)
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(penalty)
        change = np.linalg.solve(hessian, gradient)
        w -= change
        if np.abs(change).max() < 1e-4:
            break
    return Logistic(mean, scale, w)


class Model(NamedTuple):
    text: Logistic
    meta: Logistic
    text_scale: Logistic
    meta_scale: Logistic
    mix: Logistic

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of good quality: text view, metadata view, both."""
        views = [self.text_scale.logit(self.text.logit(text)[:, None]), self.meta_scale.logit(self.meta.logit(meta)[:, None])]
        return (*map(_sigmoid, views), _sigmoid(self.mix.logit(np.stack(views, axis=1))))


def _newton(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over rows of the gradient and the Hessian of the logistic loss."""
    p = _sigmoid(z @ w)
    return z.T @ (p - y), (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))].astype(np.float64)


class Handed(NamedTuple):
    """What a view hands over in a round: rows of a certainty above ``bin``, and the ``share`` of that bin."""

    model: Logistic
    bin: int
    share: float


_BINS, _WIDEST = 4096, 64.0


def _bins(logits: np.ndarray) -> np.ndarray:
    return np.minimum(np.abs(logits) * (_BINS / _WIDEST), _BINS - 1).astype(np.int64)


def _lessons(views: Views, luck: np.ndarray, history: list[tuple[Handed, Handed]]) -> list[np.ndarray]:
    """Pseudo-labels each view has got from the other in all rounds so far, -1 where none."""
    lessons = [np.full(len(luck), -1), np.full(len(luck), -1)]
    for pair in history:
        for view, handed in enumerate(pair):
            logits, other = handed.model.logit(views[view]), lessons[1 - view]
            bins = _bins(logits)
            given = (other < 0) & ((bins > handed.bin) | ((bins == handed.bin) & (luck < handed.share)))
            other[given] = logits[given] >= 0
    return lessons


Views = tuple[np.ndarray, np.ndarray]
# Sums a function of (views, luck) over all unlabelled rows.
Total = Callable[[Callable[[Views, np.ndarray], np.ndarray]], np.ndarray]


def _fit_views(own: Views, y: np.ndarray, history: list, total: Total | None, ridge: float = 1.0, steps: int = 12) -> list[Logistic]:
    """Both views fitted on the labelled rows and all pseudo-labels, by sums over all rows."""
    if not history or total is None:
        return [fit_logistic(x, y) for x in own]
    sizes = [x.shape[1] for x in own]

    def moments_of(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    def moments(views: Views, luck: np.ndarray) -> np.ndarray:
        return np.concatenate([moments_of(x[lesson >= 0]) for x, lesson in zip(views, _lessons(views, luck, history))])

    sums = total(moments) + np.concatenate([moments_of(x) for x in own])
    scaled = []
    for part, n in zip(np.split(sums, [2 * sizes[0] + 1]), sizes):
        mean = part[1 : n + 1] / part[0]
        scale = np.sqrt(np.maximum(part[n + 1 :] / part[0] - mean * mean, 0))
        scaled.append((mean, np.where(scale > 1e-6, scale, 1.0)))
    weights = [np.zeros(n + 1) for n in sizes]
    for _ in range(steps):
        now = list(weights)

        def slopes(views: Views, luck: np.ndarray) -> np.ndarray:
            parts = []
            for x, lesson, at, w in zip(views, _lessons(views, luck, history), scaled, now):
                rows = lesson >= 0
                gradient, hessian = _newton(_standard(x[rows], *at), lesson[rows], w)
                parts += [gradient, hessian.ravel()]
            return np.concatenate(parts)

        sums, place, largest = total(slopes), 0, 0.0
        for view, (x, at, n) in enumerate(zip(own, scaled, sizes)):
            w, m = weights[view], n + 1
            gradient, hessian = _newton(_standard(x, *at), y, w)
            gradient = gradient + sums[place : place + m]
            hessian = hessian + sums[place + m : place + m + m * m].reshape(m, m)
            place += m + m * m
            penalty = np.full(m, ridge)
            penalty[-1] = 1e-6
            change = np.linalg.solve(hessian + np.diag(penalty), gradient + penalty * w)
            weights[view] = w - change
            largest = max(largest, np.abs(change).max())
        if largest < 1e-3:
            break
    return [Logistic(*at, w) for at, w in zip(scaled, weights)]


def co_train(
    text: np.ndarray,
    meta: np.ndarray,
    labels: np.ndarray,
    rounds: int = 4,
    sure: float = 0.98,
    share: float = 0.2,
    seed: int = 7,
    total: Total | None = None,
) -> Model | None:
    """``labels``: 1, 0, or -1 where there is none. None without both kinds of labels.

    A third of the labelled rows is kept aside to calibrate and to mix the views.
    In a round a view hands over at most ``share`` of the pool, its surest rows, and none
    it is less than ``sure`` of. ``total`` sums over the pool where it lies elsewhere; else the
    pool is the rows without a label. A pseudo-label follows from the models of the rounds so
    far, so the pool's rows are read in each pass and never gathered.
    """
    order = np.random.default_rng(seed).permutation(len(labels))
    known, pool = order[labels[order] >= 0], order[labels[order] < 0]
    aside, own = known[: len(known) // 3], known[len(known) // 3 :]
    if any(len(set(labels[rows].tolist())) < 2 for rows in (own, aside)):
        return None
    if total is None:
        here = (text[pool], meta[pool]), (np.arange(len(pool)) + 0.5) / max(1, len(pool))
        total = lambda function: function(*here)
    mine, y = (text[own], meta[own]), labels[own].astype(float)
    history: list[tuple[Handed, Handed]] = []
    models = _fit_views(mine, y, history, total)
    least = int(np.ceil(np.log(sure / (1 - sure)) * _BINS / _WIDEST))
    for _ in range(rounds):
        fitted = list(models)

        def certainty(views: Views, luck: np.ndarray) -> np.ndarray:
            lessons, counts = _lessons(views, luck, history), [[len(luck)]]
            for view, model in enumerate(fitted):
                logits = model.logit(views[view][lessons[1 - view] < 0])
                counts.append(np.bincount(_bins(logits), minlength=_BINS))
            return np.concatenate(counts).astype(np.float64)

        counts = total(certainty)
        handed, any_ = [], False
        for model, bins in zip(fitted, np.split(counts[1:], 2)):
            above = np.r_[np.cumsum(bins[::-1])[::-1], 0]
            # The surest bins that fit as a whole, and a part of the next one.
            whole = max(least, int(np.argmax(above <= share * counts[0])))
            part = (share * counts[0] - above[whole]) / bins[whole - 1] if whole > least and bins[whole - 1] else 0.0
            handed.append(Handed(model, whole - 1, float(part)))
            any_ |= above[whole] > 0 or part > 0
        if not any_:
            break
        history = [*history, tuple(handed)]
        models = _fit_views(mine, y, history, total)
    views = (text, meta)
    y = labels[aside].astype(float)
    scales = [fit_logistic(m.logit(v[aside])[:, None], y) for m, v in zip(models, views)]
    both = np.stack([s.logit(m.logit(v[aside])[:, None]) for s, m, v in zip(scales, models, views)], axis=1)
    return Model(*models, *scales, fit_logistic(both, y))


def _total_over(pool: DataFrame, width: int) -> Total:
    """Sums over the rows of ``pool`` (text features and metadata), added up in two steps."""

    def total(function: Callable[[Views, np.ndarray], np.ndarray]) -> np.ndarray:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for batch in batches:
                for at in range(0, batch.num_rows, 2000):
                    part = batch.slice(at, 2000)
                    blobs = part.column(0).to_pylist()
                    text = np.stack([np.frombuffer(b, np.float32) for b in blobs])
                    rest = (part.column(i).to_pylist() for i in (1, 2, 3))
                    meta = np.stack([meta_features(*row) for row in zip(*rest)])
                    luck = np.array([zlib.crc32(b) / 2**32 for b in blobs])
                    more = function((text, meta), luck)
                    found = more if found is None else found + more
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["sums"])

        def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for batch in batches:
                for blob in batch.column(0):
                    more = np.frombuffer(blob.as_py(), np.float64)
                    found = more if found is None else found + more
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["sums"])

        parts = pool.mapInArrow(each, "sums binary").repartition(8).mapInArrow(together, "sums binary").collect()
        if not parts:
            nothing = tuple(np.zeros((0, n), np.float32) for n in (width, 2 * META_BUCKETS + 3))
            return function(nothing, np.zeros(0))
        return np.sum([np.frombuffer(row[0], np.float64) for row in parts], axis=0)

    return total


def _features(df: DataFrame, id_column: str, columns: tuple[str, str, str, str]) -> DataFrame:
    """Text and metadata of rows, cast and without nulls in the text."""
    text, lang, source, chars = columns
    return df.select(
        F.col(id_column).alias("doc_id"),
        text_or_empty(text).alias("text"),
        F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"),
        F.col(chars).cast("long").alias("n_chars"),
    )


def _matrices(batch: pa.RecordBatch, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Both views of a batch whose columns from ``start`` on are text, lang, source, n_chars."""
    text = np.stack([text_features(t.as_py()) for t in batch.column(start)])
    rest = (batch.column(start + i).to_pylist() for i in (1, 2, 3))
    return text, np.stack([meta_features(*row) for row in zip(*rest)])


COLUMNS = ("text", "lang", "source", "n_chars")


def fit_quality(
    df: DataFrame,
    labels: DataFrame,
    fit_rows: int = 9000,
    id_column: str = "doc_id",
    label_column: str = "quality",
    columns: tuple[str, str, str, str] = COLUMNS,
) -> Model | None:
    """The model, fitted on at most ``fit_rows`` labelled and all unlabelled documents.

    The labelled sample is taken by a hash of the id. A document with labels of both kinds or
    none is unlabelled; labels without a document are not used.
    """
    marks = (
        labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).cast("int").alias("y"))
        .where("doc_id IS NOT NULL AND y IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("y").alias("low"), F.max("y").alias("high"))
        .where("low = high")
        .select("doc_id", F.col("low").alias("y"))
    )
    marks = written(marks, "marks")
    order = F.xxhash64(F.col("doc_id"), F.lit(11))
    known = df.select(F.col(id_column).alias("doc_id")).join(marks, "doc_id").distinct()
    sample = written(known.orderBy(order, "doc_id").limit(fit_rows), "sample")
    kind = df.schema[id_column].dataType.simpleString()

    def body():
        def one(batch: pa.RecordBatch) -> list:
            text = [text_features(t.as_py()).tobytes() for t in batch.column(1)]
            return [batch.column(0), pa.array(text, pa.binary()), *batch.columns[2:5]]

        return one

    schema = f"doc_id {kind}, text binary, lang string, source string, n_chars long"
    features = map_columns(_features(df, id_column, columns), schema, body)
    pool = written(features.join(marks, "doc_id", "left_anti").drop("doc_id"), "pool")
    taken = features.join(sample, "doc_id").orderBy(order, "doc_id", "text").limit(fit_rows)
    # A repeated document gives as many rows as the sample's bound allows, whatever its id.
    found = written(taken, "features").collect()
    if not found:
        return None
    found.sort(key=lambda r: (str(r["doc_id"]), bytes(r["text"])))
    text = np.stack([np.frombuffer(r["text"], np.float32) for r in found])
    meta = np.stack([meta_features(r["lang"], r["source"], r["n_chars"]) for r in found])
    return co_train(text, meta, np.array([r["y"] for r in found]), total=_total_over(pool, text.shape[1]))


def score_documents(
    df: DataFrame,
    model: Model | None,
    threshold: float = 0.5,
    id_column: str = "doc_id",
    columns: tuple[str, str, str, str] = COLUMNS,
) -> DataFrame:
    """``doc_id, text_score, meta_score, score, keep`` of every row's whole text.

    Null texts are empty, other nulls are values of their own; repeated rows are scored
    each; without a model (no labels of both kinds) every score is 1.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[id_column].dataType.simpleString()

    def body():
        def one(batch: pa.RecordBatch) -> list:
            scores = _scores(shared.value, batch, 1)
            return [batch.column(0), *map(pa.array, scores), pa.array(scores[2] >= threshold)]

        return one

    schema = f"doc_id {kind}, text_score double, meta_score double, score double, keep boolean"
    return map_columns(_features(df, id_column, columns), schema, body)


def _scores(model: Model | None, batch: pa.RecordBatch, start: int) -> tuple[np.ndarray, ...]:
    if model is None:
        return (np.ones(batch.num_rows),) * 3
    parts = []
    for at in range(0, batch.num_rows, 1000):
        parts.append(model.scores(*_matrices(batch.slice(at, 1000), start)))
    return tuple(np.concatenate(x).astype(np.float64) for x in zip(*parts))


def keep_good(
    df: DataFrame, model: Model | None, threshold: float = 0.5, columns: tuple[str, str, str, str] = COLUMNS
) -> DataFrame:
    """The rows of ``df``, with all their columns, that the model does not reject."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    extra = [f"_view_{c}" for c in COLUMNS]
    n = len(df.columns)
    text, lang, source, chars = columns
    rows = df.select(
        "*",
        text_or_empty(text).alias(extra[0]),
        F.col(lang).cast("string").alias(extra[1]),
        F.col(source).cast("string").alias(extra[2]),
        F.col(chars).cast("long").alias(extra[3]),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = pa.array(_scores(shared.value, batch, n)[2] >= threshold)
                yield batch.select(list(range(n))).filter(good)

    return rows.mapInArrow(run, df.schema)
