"""Quality classifier: a factorisation machine over hashed words and structure statistics.

The score is a logistic of ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``. The pairwise sum is
taken in linear time as half the difference between squared sums and sums of squares, factor by
factor. Inputs are hashed words (length-normalised log counts), structure statistics of the text and
its size; never a label, language, source or identifier.

The model is fitted on at most ``max_rows`` labelled rows of together at most ``max_bytes`` of text,
picked by a hash of their ids, in one task whose memory these bounds limit. Scoring covers every row of
a table in Arrow batches.

Defined results: a NULL or empty text is scored on the constant term and its zero statistics; rows
without a label or an id are not used for fitting; without any labelled row every score is 0.5;
repeated rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlake.llm.words import ROWS_BYTES, Chunk, chunks, give_back

STATISTICS = [
    "log_words", "log_bytes", "word_length", "long_word_share", "symbol_share", "bar_share",
    "capital_share", "digit_share", "stop_share", "mark_share", "line_length", "repeated_line_share",
    "distinct_word_share", "non_ascii_share", "doubled_word_share",
]


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 15
    factors: int = 8
    epochs: int = 6
    batch: int = 128
    least_steps: int = 500  # of all epochs together, so small samples are gone through more often
    rate: float = 0.08
    decay: float = 1e-5
    max_rows: int = 12_000
    max_bytes: int = 1 << 27
    seed: int = 17


@dataclass(frozen=True)
class Model:
    """Plain arrays; their size depends on the settings alone."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def _byte_share(chunk: Chunk, which: str) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(which.encode())] = 1
    return _row_sums(table[chunk.data], chunk.offsets)


def _row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct_per_row(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    order = np.lexsort((hashes, row))
    r, h = row[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return np.bincount(r[new], minlength=rows)


def _line_statistics(chunk: Chunk, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word per row, and how many of them repeat an earlier one."""
    breaks = np.concatenate([[0], np.cumsum(chunk.data == 10)])
    line = breaks[chunk.starts]  # within the chunk
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (chunk.word_row[1:] != chunk.word_row[:-1])
    first = np.flatnonzero(new)
    place = np.arange(len(line)) - np.repeat(first, np.diff(np.append(first, len(line))))
    keyed = hashes * (place.astype(np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))
    sums = np.add.reduceat(keyed, first) if len(first) else keyed
    row = chunk.word_row[first]
    lines = np.bincount(row, minlength=chunk.rows)
    return lines, lines - _distinct_per_row(row, sums, chunk.rows)


def statistics(chunk: Chunk, hashes: np.ndarray) -> np.ndarray:
    """The structure statistics of each row, in the order of ``STATISTICS``."""
    words = np.diff(chunk.word_offsets)
    size = np.diff(chunk.offsets)
    n, b = np.maximum(words, 1), np.maximum(size, 1)
    length = chunk.ends - chunk.starts
    lines, repeated = _line_statistics(chunk, hashes)
    doubled = np.zeros(len(hashes), bool)
    doubled[1:] = (hashes[1:] == hashes[:-1]) & (chunk.word_row[1:] == chunk.word_row[:-1])
    columns = [
        np.log1p(words),
        np.log1p(size),
        np.bincount(chunk.word_row, length, chunk.rows) / n,
        np.bincount(chunk.word_row, length > 15, chunk.rows) / n,
        _byte_share(chunk, "#*$%&<>~^_=+\\/{}[]@") / b,
        _byte_share(chunk, "|") / b,
        _byte_share(chunk, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") / b,
        _byte_share(chunk, "0123456789") / b,
        _byte_share(chunk, ".,;:?") / n,
        _byte_share(chunk, "!") / n,
        np.log1p(size / np.maximum(lines, 1)),
        repeated / np.maximum(lines, 1),
        _distinct_per_row(chunk.word_row, hashes, chunk.rows) / n,
        _row_sums((chunk.data > 127).astype(np.int64), chunk.offsets) / b,
        np.bincount(chunk.word_row, doubled, chunk.rows) / n,
    ]
    return np.stack(columns, 1)


def word_features(
    chunk: Chunk, hashes: np.ndarray, buckets: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of every hashed word; the values of a row have length one."""
    key = chunk.word_row * buckets + (hashes % np.uint64(buckets)).astype(np.int64)
    key, counts = np.unique(key, return_counts=True)
    row, value = key // buckets, np.log1p(counts)
    norm = np.sqrt(np.bincount(row, value * value, chunk.rows))
    return row, key % buckets, value / norm[row]


def _shape(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((stats - mean) / scale, -4, 4)


def _raw(model: Model, rows: int, row: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The machine's output per row, for entries sorted by row."""
    linear = np.bincount(row, model.weights[index] * value, rows)
    pairs = np.zeros(rows)
    for f in range(model.factors.shape[1]):
        vx = model.factors[index, f] * value
        pairs += np.bincount(row, vx, rows) ** 2 - np.bincount(row, vx * vx, rows)
    return model.bias + linear + 0.5 * pairs


def _entries(model: Model, chunk: Chunk, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes = chunk.hashes()
    row, index, value = word_features(chunk, hashes, buckets)
    dense = _shape(statistics(chunk, hashes), model.mean, model.scale)
    k = dense.shape[1]
    return (
        np.concatenate([row, np.repeat(np.arange(chunk.rows), k)]),
        np.concatenate([index, np.tile(np.arange(k) + buckets, chunk.rows)]),
        np.concatenate([value, dense.ravel()]),
    )


def score_column(model: Model, column: pa.Array, buckets: int) -> np.ndarray:
    """The score of every text of a column, from 0 to 1."""
    out = np.empty(len(column))
    for chunk in chunks(column, size=ROWS_BYTES):
        raw = _raw(model, chunk.rows, *_entries(model, chunk, buckets))
        out[chunk.first : chunk.first + chunk.rows] = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
    return out


def fit_arrays(column: pa.Array, label: np.ndarray, settings: Settings) -> Model:
    """Fit by adaptive gradient steps on mini-batches, in a fixed order."""
    n, buckets = len(label), settings.buckets
    parts, stats = [], []
    for chunk in chunks(column):
        hashes = chunk.hashes()
        row, index, value = word_features(chunk, hashes, buckets)
        parts.append((row + chunk.first, index, value))
        stats.append(statistics(chunk, hashes))
    stats = np.concatenate(stats)
    mean, scale = stats.mean(0), stats.std(0) + 1e-6
    dense, k = _shape(stats, mean, scale), stats.shape[1]
    row, index, value = (np.concatenate(x) for x in zip(*parts))
    bounds = np.searchsorted(row, np.arange(n + 1))
    rng = np.random.default_rng(settings.seed)
    w = np.zeros(buckets + k)
    v = rng.normal(0, 0.03, (buckets + k, settings.factors))
    bias = float(np.log((label.sum() + 1) / (n - label.sum() + 1)))
    gw, gv, gb = np.full(len(w), 1e-2), np.full(v.shape, 1e-2), 1e-2
    for _ in range(max(settings.epochs, -(-settings.least_steps * settings.batch // n))):
        order = rng.permutation(n)
        for at in range(0, n, settings.batch):
            some = order[at : at + settings.batch]
            count = np.diff(bounds)[some]
            take = np.repeat(bounds[some], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            r = np.concatenate([np.repeat(np.arange(len(some)), count), np.repeat(np.arange(len(some)), k)])
            i = np.concatenate([index[take], np.tile(np.arange(k) + buckets, len(some))])
            x = np.concatenate([value[take], dense[some].ravel()])
            vx = v[i] * x[:, None]
            sums = np.stack([np.bincount(r, vx[:, f], len(some)) for f in range(v.shape[1])], 1)
            squares = np.bincount(r, (vx * vx).sum(1), len(some))
            raw = bias + np.bincount(r, w[i] * x, len(some)) + 0.5 * ((sums**2).sum(1) - squares)
            slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[some]) / len(some)
            used, inverse = np.unique(i, return_inverse=True)
            dx = slope[r] * x
            dw = np.bincount(inverse, dx, len(used)) + settings.decay * w[used]
            dv = dx[:, None] * (sums[r] - vx)
            dv = np.stack([np.bincount(inverse, dv[:, f], len(used)) for f in range(v.shape[1])], 1)
            dv += settings.decay * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= settings.rate * dw / np.sqrt(gw[used])
            v[used] -= settings.rate * dv / np.sqrt(gv[used])
            db = slope.sum()
            gb += db * db
            bias -= settings.rate * db / np.sqrt(gb)
    return Model(bias, w.astype(np.float32), v.astype(np.float32), mean, scale)


def held_out(doc_id: Column) -> Column:
    """The fifth of all ids that no model learns from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, target: str, max_rows: int, max_bytes: int) -> DataFrame:
    """At most ``max_rows`` labelled texts outside the held-out fifth, as (doc_id, text, label).

    Rows of one id give one row, with the least of their texts. Together the texts have at most
    ``max_bytes`` bytes, taken in order of a hash of the ids; one of more than an eighth of that is not used.
    """
    known = (
        labels.select("doc_id", F.col(target).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    # Never more rows than the bound, so this side is safe to broadcast.
    rows = (
        docs.select("doc_id", "text")
        .filter(size <= max_bytes // 8)
        .join(F.broadcast(known), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
    so_far = F.sum(size).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    bounded = rows.withColumn("_bytes", so_far).filter(F.col("_bytes") <= max_bytes)
    return bounded.select("doc_id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), target: str = "quality") -> Model:
    """Fit the machine on a bounded sample of labelled rows, in one task on an executor."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b.cast(schema) for b in batches], schema)
        order = pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")])
        table = table.take(order)
        label = table["label"].to_numpy().astype(float)
        if len(label):
            model = fit_arrays(table["text"], label, settings)
            parts = [np.array([model.bias]), model.weights, model.factors.ravel(), model.mean, model.scale]
            whole = np.concatenate([x.astype("<f8") for x in parts]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], ["model"])
        give_back()

    schema = pa.schema([("doc_id", pa.string()), ("text", pa.large_string()), ("label", pa.int32())])
    rows = training_rows(docs, labels, target, settings.max_rows, settings.max_bytes)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))

    found = rows.repartition(1).mapInArrow(train, "model binary").collect()
    k, d, f = len(STATISTICS), settings.buckets + len(STATISTICS), settings.factors
    if not found:
        zero = np.zeros(d, np.float32)
        return Model(0.0, zero, np.zeros((d, f), np.float32), np.zeros(k), np.ones(k))
    flat = np.frombuffer(found[0][0], "<f8")
    cuts = np.cumsum([1, d, d * f, k])
    bias, weights, factors, mean, scale = np.split(flat, cuts)
    return Model(
        float(bias[0]), weights.astype(np.float32), factors.astype(np.float32).reshape(d, f), mean, scale
    )


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score", buckets: int = Settings.buckets) -> DataFrame:
    """Add the score of every row; a column of that name is replaced."""
    keep = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = score_column(model, batch.column(batch.schema.get_field_index(text)), buckets)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            whole = pa.RecordBatch.from_arrays([*columns, pa.array(got, pa.float64())], [*keep, out])
            for at in range(0, whole.num_rows, 500):  # the JVM holds one such part beside the batch it sends
                yield whole.slice(at, 500)
        give_back()

    fields = df.select(*keep).schema.add(out, "double")
    return df.select(*keep).mapInArrow(run, fields)
