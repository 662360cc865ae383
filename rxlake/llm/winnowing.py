"""Document fingerprints by winnowing.

Every run of ``gram`` code points has a hash; of every ``window`` consecutive hashes the smallest is
chosen, the rightmost of equal ones, and kept with its position. Any passage of at least
``gram + window - 1`` code points that two texts share is found through a common chosen hash.

Defined results: a NULL text counts as empty and has an empty fingerprint. A text shorter than a gram
is one gram of its whole length, one with fewer grams than a window is one window. Equal texts have
equal fingerprints. Texts are taken whole, a million code points at a time. An empty table gives no
rows; extra columns of ``fingerprints`` stay unless a result has their name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxlake.llm.words import mix

SEGMENT = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Winnowing:
    gram: int = 24
    window: int = 25


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """The hash of the gram at every position."""
    n = len(points)
    if n < gram:
        gram = n
    if not n:
        return np.zeros(0, np.uint64)
    out = np.empty(n - gram + 1, np.uint64)
    for at in range(0, len(out), SEGMENT):
        value = mix(points[at : at + SEGMENT + gram - 1].astype(np.uint64) + np.uint64(1))
        width, total = 1, value  # total: hash of `width` points from each position on
        bits = bin(gram)[3:]
        for bit in bits:  # double the width, then add one point where the gram's digits say so
            total = total[: len(total) - width] * _power(width) + total[width:]
            width *= 2
            if bit == "1":
                total = total[:-1] * _BASE + value[width : width + len(total) - 1]
                width += 1
        out[at : at + SEGMENT] = mix(total)
    return out


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def choose(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash of every window, the rightmost of equal ones."""
    best = np.arange(len(hashes))
    window, width = min(window, len(hashes)), 1
    while width < window:
        step = min(width, window - width)
        left, right = best[:-step], best[step:]
        best = np.where(hashes[right] <= hashes[left], right, left)
        width += step
    new = np.ones(len(best), bool)
    new[1:] = best[1:] != best[:-1]
    return best[new]


def winnow(text: str | None, settings: Winnowing = Winnowing()) -> tuple[np.ndarray, np.ndarray]:
    """The chosen hashes of a text and their positions."""
    return _winnow(code_points(text), settings)


def _winnow(points: np.ndarray, settings: Winnowing) -> tuple[np.ndarray, np.ndarray]:
    hashes = gram_hashes(points, settings.gram)
    at = choose(hashes, settings.window)
    return hashes[at], at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Common share of two fingerprints' distinct hashes; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    """A fingerprint, hashes and positions, as one short text."""
    both = np.stack([hashes.astype("<u8"), positions.astype("<u8")], 1)
    return hashlib.sha256(both.tobytes()).hexdigest()


def fingerprints(df: DataFrame, text: str = "text", settings: Winnowing = Winnowing()) -> DataFrame:
    """Add ``fp_hashes`` and ``fp_positions``, the whole fingerprint of each row's text."""
    made = ["fp_hashes", "fp_positions"]
    keep = [c for c in df.columns if c not in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, max(whole.num_rows, 1), 256):
                batch = whole.slice(at, 256)
                got = [winnow(t, settings) for t in batch.column(keep.index(text)).to_pylist()]
                hashes = pa.array([h.view(np.int64) for h, _ in got], pa.list_(pa.int64()))
                places = pa.array([p for _, p in got], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, hashes, places], [*keep, *made])

    schema = df.select(*keep).schema.add("fp_hashes", T.ArrayType(T.LongType()))
    schema = schema.add("fp_positions", T.ArrayType(T.LongType()))
    return df.select(*keep).mapInArrow(run, schema)


def _bounds(found: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending (id, hash) bounds from quantiles of ids: one found r times is cut into r shares of hashes."""
    ids, times = np.unique(np.array(found, np.int64), return_counts=True)
    hashes = [-(1 << 63) + j * (1 << 64) // r for r in times.tolist() for j in range(r)]
    return np.repeat(ids, times), np.array(hashes, np.int64)


def _slices(bounds: tuple[np.ndarray, np.ndarray], ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How many bounds each (id, hash) has reached."""
    low, high = (np.searchsorted(bounds[0], ids, side) for side in ("left", "right"))
    for start in np.unique(low[high > low]):
        rows = np.flatnonzero((low == start) & (high > low))
        shares = bounds[1][start : high[rows[0]]]
        low[rows] = start + np.searchsorted(shares, hashes[rows], "right")
    return low.astype(np.int32)


def _in_order(df: DataFrame, spread: int) -> DataFrame:
    """Rows in slices of ascending ids and hashes of texts, each followed by the first row of the next slice.

    Only slice bounds and first rows' ids and hashes, ``spread`` at most of each, pass through the driver.
    A slice's guest is the row after its last one; the last slice's guest is the first row of all. Each
    slice is a partition of its own.
    """
    # NULL ids count as the least one.
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    df = df.select("doc_id", key.alias("id"), F.xxhash64("text").alias("hash"), "text")
    shares = [i / spread for i in range(1, spread)]
    found = df.agg(F.percentile_approx("id", shares, 10_000).alias("b")).first()["b"] if shares else None
    bounds = _bounds(found or [])

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple[int, int]] = {}
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy() for i in (0, 1))
            order = np.lexsort((hashes, ids))
            ids, hashes = ids[order], hashes[order]
            for s, at in zip(*np.unique(_slices(bounds, ids, hashes), return_index=True)):
                here = (int(ids[at]), int(hashes[at]))
                least[int(s)] = min(least.get(int(s), here), here)
        columns = [list(least), [x for x, _ in least.values()], [x for _, x in least.values()]]
        types = [pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["slice", "id", "hash"])

    rows = df.select("id", "hash").mapInArrow(firsts, "slice int, id long, hash long")
    first = F.min(F.struct("id", "hash")).alias("first")
    heads = sorted((r["slice"], tuple(r["first"])) for r in rows.groupBy("slice").agg(first).collect())
    guest_of = {first: heads[i - 1][0] for i, (_, first) in enumerate(heads)}  # of slice before
    names = ["slice", "guest", "id", "hash", "doc_id", "text"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opening = np.array([x for x, _ in guest_of], np.int64)
        sent: set[tuple[int, int]] = set()  # equal rows of a task are one guest
        for batch in batches:
            doc, ids, hashes, text = batch.columns
            of, parity = ids.to_numpy(), hashes.to_numpy()
            own = pa.array(_slices(bounds, of, parity))
            none = pa.array(np.zeros(len(of), bool))
            yield pa.RecordBatch.from_arrays([own, none, ids, hashes, doc, text], names)
            also = []
            for i in np.flatnonzero(np.isin(of, opening)).tolist():
                here = (int(of[i]), int(parity[i]))
                if here in guest_of and here not in sent:
                    sent.add(here)
                    also.append(i)
            if also:
                doc, ids, hashes, text = batch.take(pa.array(also)).columns
                to = pa.array([guest_of[int(of[i]), int(parity[i])] for i in also], pa.int32())
                yes = pa.array([True] * len(also))
                yield pa.RecordBatch.from_arrays([to, yes, ids, hashes, doc, text], names)

    placed = df.mapInArrow(place, "slice int, guest boolean, id long, hash long, doc_id long, text string")
    placed = placed.repartitionById(spread, "slice").sortWithinPartitions("slice", "guest", "id", "hash", "text")
    return placed.select("slice", "guest", "doc_id", "text")


def compare_neighbours(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", settings: Winnowing = Winnowing()
) -> DataFrame:
    """Fingerprint each text and its edited form, and compare both and the next text's.

    The edited text has its last quarter replaced by as many first code points of the next document
    in ascending id order, NULL ids first, equal ids by a hash of their text; after the last comes the first.
    """
    spread = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def finish(one: tuple, following: tuple) -> tuple:
        doc, points, hashes, places = one
        cut = len(points) // 4
        edited = np.concatenate([points[: len(points) - cut], following[1][:cut]])
        changed, changed_at = _winnow(edited, settings)
        body = edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        return (
            doc,
            len(points),
            hashlib.sha256(body).hexdigest(),
            digest(hashes, places),
            digest(changed, changed_at),
            likeness(hashes, changed),
            likeness(hashes, following[2]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_slice, served = None, None, False
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                out = []
                columns = whole.slice(at, 512).to_pydict()
                for part, guest, doc, body in zip(*(columns[c] for c in ("slice", "guest", "doc_id", "text"))):
                    if guest and part == last_slice and served:
                        continue  # a row equal in id to the guest
                    points = code_points(body)
                    here = (doc, points, *_winnow(points, settings))
                    if last is not None:
                        out.append(finish(last, here))
                    last, last_slice, served = (None if guest else here), part, guest
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)], names)

    return _in_order(rows, spread).mapInArrow(run, schema)
