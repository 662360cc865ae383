"""Removing repeated passages by sliding spans of sentences.

Every run of ``run`` consecutive sentences, or of more if these have fewer than ``least_words`` words,
has a hash: from each sentence the shortest such run after it, and the shortest before it. Runs that occur again anywhere, in another
document or later in the same one, are repeats; the first occurrence, by document id and position, is
kept and all sentences that any other occurrence covers are removed.

A sentence ends at a line end or at ``.``, ``!`` or ``?`` before white space. A sentence of more than
``long`` words is cut after the word of the least hash of every ``cut`` consecutive words, the rightmost
of equal ones. So equal passages are cut alike wherever they stand but for at most ``cut`` words at
either end, or ``long`` where a short sentence is broken off there, and no piece is longer than
``long``: any passage of 51 words holds three whole pieces of 15 words and more. Sentences are compared
by their words, case and spacing aside.

Repeats within a block of a task are marked there and leave one row per run for the shuffle, so a
passage that very many documents share does not make a hot key.

Defined results: a NULL text stays NULL and has no sentences; a text with fewer sentences than a run
is never changed. Rows equal in id and text count as one document and are treated alike. A NULL id
comes last. An empty table gives no rows. Extra columns stay unless a result has their name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxlake.llm.words import LOWER, Chunk, chunks, mix, powers

_LAST = (1 << 63) - 1
PLACE = 1024  # a run has fewer sentences, as each has a word


@dataclass(frozen=True)
class Spans:
    run: int = 3
    least_words: int = 15
    long: int = 12  # words of a sentence that is not cut
    cut: int = 8  # one of so many consecutive words at least ends a piece of a longer one
    block: int = 1_000_000  # spans whose repeats are marked before the shuffle


def _ends_by_mark(chunk: Chunk) -> np.ndarray:
    """Which words end a sentence: a stop at their end, a line end behind them, or the text's end."""
    last = chunk.data[chunk.ends - 1]
    stop = (last == 46) | (last == 33) | (last == 63)
    lines = np.concatenate([[0], np.cumsum(chunk.data == 10)])
    stop[:-1] |= lines[chunk.starts[1:]] > lines[chunk.ends[:-1]]
    stop[chunk.word_offsets[1:][np.diff(chunk.word_offsets) > 0] - 1] = True
    return stop


def _least(h: np.ndarray, start: np.ndarray, to: np.ndarray, window: int) -> np.ndarray:
    """Which words have the least hash of a window inside their sentence, the rightmost of equal ones."""
    chosen = np.zeros(len(h), bool)
    best, width = np.arange(len(h)), 1
    while width < min(window, len(h)):
        step = min(width, window - width, len(best) - 1)
        left, right = best[:-step], best[step:]
        best = np.where(h[right] <= h[left], right, left)
        width += step
    inside = np.repeat(to, to - start)[: len(best)] - np.arange(len(best)) >= window
    chosen[best[inside]] = True
    return chosen


def sentences(column: pa.Array, spans: Spans) -> Iterator[tuple[Chunk, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: the number of its first and behind its last word, and the hash, of each sentence."""
    for chunk in chunks(column, LOWER):
        h = chunk.hashes()
        if not len(h):
            yield chunk, np.zeros(0, int), np.zeros(0, int), h
            continue
        stop = _ends_by_mark(chunk)
        to = np.flatnonzero(stop) + 1
        start = np.concatenate([[0], to[:-1]])
        in_long = np.repeat(to - start > spans.long, to - start)
        to = np.flatnonzero(stop | (in_long & _least(h, start, to, spans.cut))) + 1
        start = np.concatenate([[0], to[:-1]])
        place = (np.arange(len(h)) - np.repeat(start, to - start)).astype(np.uint64)
        keyed = mix(h ^ mix(place + np.uint64(1)))
        yield chunk, start, to, mix(np.add.reduceat(keyed, start))


def _runs(chunk: Chunk, start: np.ndarray, to: np.ndarray, h: np.ndarray, spans: Spans) -> tuple[np.ndarray, ...]:
    """(row, place, hash) of every run; a place is the run's first sentence and their number."""
    row = chunk.word_row[start]
    n = len(start)
    words = np.concatenate([[0], to])  # words before each sentence, as sentences leave none out
    first = np.searchsorted(row, np.arange(chunk.rows), "left")
    last = np.searchsorted(row, np.arange(chunk.rows), "right")
    i = np.arange(n)
    end = np.maximum(i + spans.run, np.searchsorted(words, words[:-1] + spans.least_words))
    fits = end <= last[row]
    forward = np.stack([i[fits], end[fits]])
    j = i + 1
    begin = np.minimum(j - spans.run, np.searchsorted(words, words[1:] - spans.least_words, "right") - 1)
    fits = begin >= first[row]
    both = np.unique(np.concatenate([forward, np.stack([begin[fits], j[fits]])], 1), axis=1)
    begin, end = both
    power, inverse = powers(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:n], dtype=np.uint64)])
    total = mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    where = row[begin]
    return where, (begin - first[where]) * PLACE + end - begin, total


def repeats(docs: DataFrame, spans: Spans = Spans()) -> DataFrame:
    """(doc_id, text_hash, at): the place of every run that is not the first of its kind."""
    rows = docs.filter("text IS NOT NULL").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )
    names = ["hash", "doc_id", "text_hash", "at", "again"]
    types = [pa.int64()] * 4 + [pa.bool_()]

    def marked(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        """The runs of a block, repeats within it marked and put out of the way of their key."""
        h, doc, text, at = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((at, text, doc, h))
        h, doc, text, at = (c[order] for c in (h, doc, text, at))
        fresh = np.ones(len(h), bool)  # rows equal in all are the same occurrence
        fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1])
        h, doc, text, at = (c[fresh] for c in (h, doc, text, at))
        again = np.zeros(len(h), bool)
        again[1:] = h[1:] == h[:-1]
        key = np.where(again, mix((text + at).view(np.uint64)).view(np.int64), h)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((key, doc, text, at, again), types)], names)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for whole in batches:
            doc, text = (whole.column(i).to_numpy() for i in (0, 1))
            for chunk, start, to, h in sentences(whole.column(2), spans):
                if not len(h):
                    continue
                row, at, run_hash = _runs(chunk, start, to, h, spans)
                if len(row):
                    row = row + chunk.first
                    held.append((run_hash.view(np.int64), doc[row], text[row], at.astype(np.int64)))
                    total += len(row)
                if total >= spans.block:
                    yield marked(held)
                    held, total = [], 0
        if held:
            yield marked(held)

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All marked runs, and of equal ones all but the first."""
        last, first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, doc, text, at, again = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            free = np.flatnonzero(~again)
            out = again.copy()
            if len(free):
                new = np.ones(len(free), bool)
                new[1:] = h[free][1:] != h[free][:-1]
                new[0] = last is None or h[free[0]] != last
                # The occurrence that each run of this list must differ from.
                group = np.cumsum(new) - 1
                heads = [(doc[i], text[i], at[i]) for i in free[new]]
                if not new[0]:
                    heads, group = [first, *heads], group + 1
                d, t, a = (np.array(c)[group] for c in zip(*heads))
                out[free] = (doc[free] != d) | (text[free] != t) | (at[free] != a)
                last, first = h[free[-1]], heads[-1]
            if out.any():
                columns = [pa.array(c[out]) for c in (doc, text, at)]
                yield pa.RecordBatch.from_arrays(columns, names[1:4])

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.mapInArrow(runs, "hash long, doc_id long, text_hash long, at long, again boolean")
    placed = found.repartition(tasks, "hash").sortWithinPartitions("hash", "doc_id", "text_hash", "at")
    return placed.mapInArrow(later, "doc_id long, text_hash long, at long")


def remove_repeats(df: DataFrame, spans: Spans = Spans(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each row with its text less all repeated passages.

    Adds ``n_sentences``, ``n_removed`` and ``removed``, the removed parts as start and end, in code
    points of the old text.
    """
    made = ["n_sentences", "n_removed", "removed"]
    keep = [c for c in df.columns if c not in made]
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = repeats(source, spans).groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("_at"))
    found = found.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = (F.coalesce(df[doc_id].cast("long"), F.lit(_LAST)) == F.col("_id")) & (F.xxhash64(df[text]) == F.col("_hash"))
    rows = df.join(found, same, "left").select(*keep, "_at")
    where = keep.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                old, marks = batch.column(where).to_pylist(), batch.column(len(keep)).to_pylist()
                texts, counts, gone, lists = list(old), [0] * len(old), [0] * len(old), [[] for _ in old]
                for chunk, start, to, _ in sentences(batch.column(where), spans):
                    row = chunk.word_row[start]
                    bounds = np.searchsorted(row, np.arange(chunk.rows + 1))
                    for r in range(chunk.rows):
                        i, (a, b) = chunk.first + r, bounds[r : r + 2]
                        counts[i] = int(b - a)
                        if not marks[i]:
                            continue
                        covered = np.zeros(b - a, bool)
                        for at in marks[i]:
                            covered[at // PLACE : at // PLACE + at % PLACE] = True
                        # A sentence reaches to the next one, or to the text's ends.
                        offset = chunk.offsets[r]
                        edges = np.append(chunk.starts[start[a:b]] - offset, chunk.offsets[r + 1] - offset)
                        edges[0] = 0
                        body, out, spots, points = old[i].encode(), [], [], 0
                        for k in range(b - a):
                            piece = body[edges[k] : edges[k + 1]]
                            size = len(piece.decode())
                            if not covered[k]:
                                out.append(piece)
                            elif spots and spots[-1]["end"] == points:
                                spots[-1]["end"] = points + size
                            else:
                                spots.append({"start": points, "end": points + size})
                            points += size
                        texts[i], gone[i], lists[i] = b"".join(out).decode(), int(covered.sum()), spots
                columns = [c if j != where else pa.array(texts, pa.string()) for j, c in enumerate(batch.columns[: len(keep)])]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                columns += [pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(lists, kind)]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *made])

    schema = df.select(*keep).schema.add("n_sentences", "long").add("n_removed", "long")
    spots = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
    return rows.mapInArrow(clean, schema.add("removed", spots))
