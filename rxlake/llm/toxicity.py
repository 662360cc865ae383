"""Toxicity by cumulative-link ordinal regression.

The probability of a grade above j is a logistic of ``w . x - t_j``: all grades share the weights and
differ in ascending thresholds. The expected severity is the sum of these probabilities. Inputs are
log counts of words and word beginnings in a vocabulary, which is taken from the training rows.

Labels only tell toxic from not. Severity of the toxic training rows is graded by the number of marked
entries in them, those far more frequent in toxic rows than in others: the grades 1 to 3 are thirds
of these rows by the sum of log counts. Grade 0 is not toxic.

Model and vocabulary are fitted on at most ``max_rows`` labelled rows of together at most ``max_bytes``
of text, in one task whose memory these bounds limit. Scoring covers every row of a table in Arrow batches.

Defined results: a NULL or empty text has no words and gets the severity that the thresholds alone
give. Without labelled rows every severity is 0. Rows without a label or an id are not used for
fitting, and of rows with one id only the least text is. Repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.quality_fm import training_rows
from rxlake.llm.words import LETTERS, chunks


@dataclass(frozen=True)
class Settings:
    max_rows: int = 12_000
    max_bytes: int = 1 << 27
    vocabulary: int = 4_000
    least_lift: float = 1.0  # natural log of its odds in toxic rows over those in others
    least_telling: float = 4.5  # standard errors that its frequency in toxic rows is off
    least_rows: int = 4  # that an entry of the vocabulary occurs in
    marked_lift: float = 2.0  # natural log of the odds that make a word a marked one
    epochs: int = 60
    batch: int = 64
    rate: float = 0.03
    decay: float = 1e-5
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """Sorted word hashes, their weights and the thresholds; bounded by the settings."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


PREFIXES = (4, 5, 6, 7, 8)  # bytes


def _features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per chunk: its first row, its rows, and (row, hash) of every word and word beginning."""
    for chunk in chunks(column, LETTERS):
        rows, hashes = [chunk.word_row], [chunk.hashes()]
        length = chunk.ends - chunk.starts
        for size in PREFIXES:
            longer = length > size
            starts = chunk.starts[longer]
            rows.append(chunk.word_row[longer])
            hashes.append(~chunk.span_hashes(starts, starts + size))  # apart from whole words
        yield chunk.first, chunk.rows, np.concatenate(rows), np.concatenate(hashes)


def _counted(row: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, item) pairs and how often each occurs."""
    order = np.lexsort((item, row))
    row, item = row[order], item[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    at = np.flatnonzero(new)
    return row[at], item[at], np.diff(np.append(at, len(row)))


def fit_arrays(column: pa.Array, toxic: np.ndarray, settings: Settings = Settings()) -> Model:
    counted = [_counted(row + first, hashes) for first, _, row, hashes in _features(column)]
    row, word, count = (np.concatenate(x) for x in zip(*counted))
    n, rate = len(toxic), toxic.mean()
    words, inverse, rows_with = np.unique(word, return_inverse=True, return_counts=True)
    in_toxic = np.bincount(inverse, toxic[row], len(words))
    # Those that tell toxic rows apart best; ties by hash.
    a, b = in_toxic + 0.5, rows_with - in_toxic + 0.5
    lift = np.log(a / (toxic.sum() + 1)) - np.log(b / (n - toxic.sum() + 1))
    telling = (in_toxic - rate * rows_with) / np.sqrt(rate * rows_with + 1)
    telling[(rows_with < settings.least_rows) | (lift < settings.least_lift)] = -1
    best = np.lexsort((words, -telling))[: settings.vocabulary]
    chosen = np.sort(best[telling[best] >= settings.least_telling])
    place = np.full(len(words), -1)
    place[chosen] = np.arange(len(chosen))
    index, known = place[inverse], place[inverse] >= 0

    marked = (lift > settings.marked_lift) & (rows_with >= settings.least_rows)
    many = np.bincount(row, np.log1p(count) * marked[inverse], n)
    grade = np.zeros(n, int)
    if toxic.any():
        cuts = np.quantile(many[toxic == 1], [1 / 3, 2 / 3])
        grade = np.where(toxic == 1, 1 + np.searchsorted(cuts, many, "left"), 0)

    row, index, value = row[known], index[known], np.log1p(count[known])
    bounds = np.searchsorted(row, np.arange(n + 1))
    share = np.array([(grade > j).mean() for j in range(3)])
    theta = np.log((1 - share + 1e-3) / (share + 1e-3)) + np.arange(3) * 1e-3
    v = len(chosen)
    x0 = np.concatenate([np.zeros(v), theta])  # weights, then thresholds
    mean, square, step = np.zeros(v + 3), np.zeros(v + 3), 0
    rng = np.random.default_rng(settings.seed)
    for _ in range(settings.epochs):
        order = rng.permutation(n)
        for at in range(0, n, settings.batch):
            some = order[at : at + settings.batch]
            size = np.diff(bounds)[some]
            take = np.repeat(bounds[some] - np.cumsum(size) + size, size) + np.arange(size.sum())
            r, i, x = np.repeat(np.arange(len(some)), size), index[take], value[take]
            s = np.bincount(r, x0[i] * x, len(some))
            edges = np.concatenate([[-40.0], x0[v:], [40.0]])
            y = grade[some]
            upper, lower = _sigmoid(edges[y + 1] - s), _sigmoid(edges[y] - s)
            p = np.maximum(upper - lower, 1e-9)
            fu, fl = upper * (1 - upper), lower * (1 - lower)
            slope = np.bincount(i, ((fu - fl) / p)[r] * x, v) / len(some) + settings.decay * x0[:v]
            shift = [((y == j + 1) * fl / p).sum() - ((y == j) * fu / p).sum() for j in range(3)]
            slope = np.concatenate([slope, np.array(shift) / len(some)])
            step += 1
            mean = 0.9 * mean + 0.1 * slope
            square = 0.999 * square + 0.001 * slope * slope
            x0 = x0 - settings.rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            x0[v:] = np.maximum.accumulate(x0[v:])
    w, theta = x0[:v], x0[v:]
    return Model(words[chosen], w, theta)


def severity_column(model: Model, column: pa.Array) -> np.ndarray:
    """The probability of a grade above 0, 1 and 2 for every text."""
    out = np.zeros((len(column), 3))
    if np.isinf(model.thresholds).all():  # fitted on nothing
        return out
    maybe = np.zeros(1 << 20, bool)  # most features are not in the vocabulary and end here
    maybe[(model.words >> np.uint64(44)).astype(np.int64)] = True
    for first, rows, row, hashes in _features(column):
        near = np.flatnonzero(maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(model.words, hashes[near]), max(len(model.words) - 1, 0))
        known = model.words[at] == hashes[near] if len(model.words) else np.zeros(0, bool)
        r, i, count = _counted(row[near[known]], at[known])
        s = np.bincount(r, model.weights[i] * np.log1p(count), rows)
        out[first : first + rows] = _sigmoid(s[:, None] - model.thresholds[None, :])
    return out


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of labelled rows, in one task on an executor."""
    schema = pa.schema([("doc_id", pa.string()), ("text", pa.large_string()), ("label", pa.int32())])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b.cast(schema) for b in batches], schema)
        table = table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")]))
        if len(table):
            m = fit_arrays(table["text"], table["label"].to_numpy().astype(float), settings)
            columns = [m.words.tobytes(), m.weights.astype("<f8").tobytes(), m.thresholds.astype("<f8").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], ["w", "v", "t"])

    rows = training_rows(docs, labels, "toxic", settings.max_rows, settings.max_bytes)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = rows.repartition(1).mapInArrow(train, "w binary, v binary, t binary").collect()
    if not found:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(3, np.inf))
    return Model(*(np.frombuffer(c, k) for c, k in zip(found[0], ("<u8", "<f8", "<f8"))))


def grade(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add severity (0 to 3), the likeliest grade, and toxic_probability; they replace columns of those names."""
    made = ["severity", "grade", "toxic_probability"]
    keep = [c for c in df.columns if c not in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = severity_column(model, batch.column(keep.index(text)))
            steps = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], 1)
            likeliest = np.argmax(steps[:, :-1] - steps[:, 1:], 1).astype(np.int32)
            columns = [pa.array(above.sum(1)), pa.array(likeliest), pa.array(above[:, 0])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*keep, *made])

    schema = df.select(*keep).schema.add("severity", "double").add("grade", "integer")
    schema = schema.add("toxic_probability", "double")
    return df.select(*keep).mapInArrow(run, schema)
