"""Audit of how document filters overlap, with exact copies found by radix tries of whole texts.

Filters are bits of a mask: A few words, B few distinct words, C many capitals, D symbols, E a copy of a
document with a smaller id. The first four look at one text. For the fifth

1. the texts of a task, some tens of megabytes at a time, go into a compressed trie whose terminals hold
   the least id; any other document there is a copy, and its text goes no further;
2. what is left is dealt out by ranges of text. The range borders are adaptive prefixes: each chunk of
   texts proposes, at even distances of bytes, the shortest prefix that tells a text from the one
   before, so texts that begin alike are cut deeper;
3. each range is a trie again, and traversing its terminals tells copies from first documents.

So a text that a third of all documents have is sent once per chunk of texts. Documents then are rows of id,
part and mask; masks are counted per part, and all orders of the filters are read off the at most 32 counts.

Defined results: a NULL text is empty; empty texts are copies of each other. A NULL id is neither a copy
nor the first document of others. Rows with the same id and text are not copies of each other, and each
counts as a document. Repeated labels of a document count as one that has every mark set. A NULL part is
the empty string. An empty table has no parts. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxlake.llm.words import give_back
from rxlake.sources.scratch import stored

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
_CAPITALS = bytes(range(65, 91))
_CONTINUATION = bytes(range(128, 192))  # of UTF-8, so the rest are as many as code points


@dataclass(frozen=True)
class Rules:
    least_words: int = 200
    distinct_percent: int = 50
    capital_percent: int = 3
    symbols: str = "#$%&*|"


@dataclass(frozen=True)
class Ranges:
    chunk_bytes: int = 32 << 20  # texts in a trie of the first step
    range_bytes: int = 32 << 20  # texts in a range, unless that makes too many ranges
    most_ranges: int = 1 << 18
    proposals: int = 64  # of a chunk
    per_range: int = 32  # proposals used to place one border
    prefix_bytes: int = 1 << 14  # longest border; texts that share more are one range


def mask_of(text: bytes, rules: Rules = Rules()) -> int:
    """Which of the filters A to D a text fails."""
    words = text.split()  # at space and 0x09-0x0D, as these are bytes
    points = len(text.translate(None, _CONTINUATION))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    symbols = len(text) - len(text.translate(None, rules.symbols.encode()))
    failed = (
        len(words) < rules.least_words,
        100 * len(set(words)) < rules.distinct_percent * len(words),
        100 * capitals > rules.capital_percent * points,
        symbols > 0,
    )
    return sum(1 << i for i, f in enumerate(failed) if f)


class _Node:
    """The end of a label, which is a slice of a text; at a terminal the documents of the least id."""

    __slots__ = ("text", "start", "end", "children", "held")

    def __init__(self, text: bytes, start: int, end: int):
        self.text, self.start, self.end = text, start, end
        self.children: dict[int, _Node] = {}
        self.held: list[tuple] | None = None


def shared_length(a: bytes, at_a: int, b: bytes, at_b: int, most: int) -> int:
    """How many bytes two slices share at their beginning, by halving."""
    if a[at_a : at_a + most] == b[at_b : at_b + most]:
        return most
    low = 0  # this many are equal
    while most - low > 1:
        half = (low + most) // 2
        if a[at_a + low : at_a + half] == b[at_b + low : at_b + half]:
            low = half
        else:
            most = half
    return low


class RadixTrie:
    """A compressed trie of texts; a document is a tuple that begins with its id."""

    def __init__(self):
        self.root = _Node(b"", 0, 0)

    def _end(self, text: bytes) -> _Node:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = _Node(text, at, len(text))
                return child
            size = child.end - child.start
            same = shared_length(child.text, child.start, text, at, min(size, len(text) - at))
            if same < size:
                upper = _Node(child.text, child.start, child.start + same)
                child.start += same
                upper.children[child.text[child.start]] = child
                node.children[text[at]] = child = upper
            node, at = child, at + same
        return node

    def insert(self, text: bytes, document: tuple) -> list[tuple]:
        """Add a document; returns those that turn out to be copies by this."""
        node = self._end(text)
        if node.held is None or document[0] < node.held[0][0]:
            copies, node.held = node.held or [], [document]
            return copies
        if document[0] == node.held[0][0]:
            node.held.append(document)
            return []
        return [document]

    def first(self) -> Iterator[tuple]:
        """The documents of the least id at every terminal."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            yield from node.held or ()
            stack.extend(node.children.values())


def _tables(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Consecutive rows of about the given bytes."""
    held, size = [], 0
    for batch in batches:
        rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            size += held[-1].nbytes
            if size >= most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _bytes(column: pa.ChunkedArray) -> list[bytes]:
    return column.cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"").to_pylist()


def _borders(texts: DataFrame, partitions: int, ranges: Ranges) -> list[bytes]:
    """Ascending prefixes that cut all texts into ranges of similar bytes."""

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for table in _tables(batches, ranges.chunk_bytes):
            found = sorted(set(_bytes(table.column(0))))
            ends = np.cumsum([len(t) + 1 for t in found])
            step = ends[-1] / ranges.proposals
            wanted = np.arange(rng.random() * step, ends[-1], step)
            prefixes = []
            for at in np.searchsorted(ends, wanted):
                text, before = found[at], found[at - 1] if at else b""
                same = shared_length(before, 0, text, 0, min(len(before), len(text)))
                prefixes.append(text[: min(same + 1, ranges.prefix_bytes)])
            weights = pa.array(np.full(len(prefixes), step))
            yield pa.RecordBatch.from_arrays([pa.array(prefixes, pa.binary()), weights], ["prefix", "weight"])
        give_back()

    found = stored(texts.mapInArrow(propose, "prefix binary, weight double"), "prefixes")
    rows, size = found.agg(F.count("*"), F.sum("weight")).first()
    many = min(ranges.most_ranges, max(partitions, -(-int(size or 0) // ranges.range_bytes)))
    # Some proposals for each border, whatever the size of the table.
    share = ranges.per_range * many / max(rows, 1)
    if share < 1:
        place = F.pmod(F.xxhash64("prefix", F.monotonically_increasing_id()), F.lit(1 << 30))
        found = found.filter(place < int(share * (1 << 30)))
    kept = sorted((bytes(p), w) for p, w in found.collect())
    level = np.cumsum([w for _, w in kept])
    if not kept:
        return []
    cuts = np.searchsorted(level, level[-1] * np.arange(1, many) / many)
    return sorted({kept[c][0] for c in cuts} - {b""})


def masks(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
    rules: Rules = Rules(), ranges: Ranges = Ranges(),
) -> DataFrame:
    """One row per document: doc_id, part and the mask of the filters it fails."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = df.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).alias("text"),
    )
    borders = _borders(source.select("text"), partitions, ranges)
    id_type = source.schema["doc_id"].dataType
    shape = T.StructType([T.StructField("doc_id", id_type), T.StructField("part", T.StringType())])
    shape.add("mask", T.IntegerType())
    names = shape.names

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for table in _tables(batches, ranges.chunk_bytes):
            ids, texts = table.column(0).to_pylist(), _bytes(table.column(2))
            failed = np.array([mask_of(t, rules) for t in texts], np.int32)
            open_rows = np.zeros(len(ids), bool)
            trie = RadixTrie()
            for row, (i, t) in enumerate(zip(ids, texts)):
                if i is not None:
                    for _, copy in trie.insert(t, (i, row)):
                        failed[copy] |= COPY
            open_rows[[row for _, row in trie.first()]] = True
            found = [bisect_right(borders, t) if o else -1 for t, o in zip(texts, open_rows)]
            span = np.array(found, np.int64)
            spread = (np.arange(len(ids)) + turn) % partitions
            to = np.where(open_rows, span * partitions // (len(borders) + 1), spread)
            yield pa.RecordBatch.from_arrays(
                [
                    *(table.column(i).combine_chunks() for i in range(2)),
                    pa.array(failed),
                    pc.if_else(pa.array(open_rows), table.column(2).fill_null("").combine_chunks(), None),
                    pa.array(span.astype(np.int32)),
                    pa.array(to.astype(np.int32)),
                ],
                [*names, "text", "span", "to"],
            )
        give_back()

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow_id, trie, at = None, RadixTrie(), None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (arrow_id, pa.string(), pa.int32())
            columns = zip(*rows) if rows else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            arrow_id = batch.column(0).type
            alone = pc.less(batch.column(4), 0)
            yield batch.filter(alone).select(names)
            for piece in _tables(iter([batch.filter(pc.invert(alone))]), ranges.chunk_bytes):
                rows = []
                columns = [piece.column(i).to_pylist() for i in range(3)]
                for document, t, span in zip(zip(*columns), _bytes(piece.column(3)), piece.column(4).to_pylist()):
                    if span != at:  # rows come range by range
                        rows.extend(trie.first())
                        trie, at = RadixTrie(), span
                    rows.extend((i, p, m | COPY) for i, p, m in trie.insert(t, document))
                yield batch_of(rows)
        if arrow_id is not None:
            yield batch_of(list(trie.first()))
        give_back()

    wide = T.StructType([*shape.fields])
    wide.add("text", T.StringType()).add("span", T.IntegerType()).add("to", T.IntegerType())
    dealt = source.mapInArrow(near, wide).repartitionById(partitions, "to").sortWithinPartitions("span")
    return dealt.mapInArrow(far, shape)


def plans() -> pd.DataFrame:
    """For every order, step and mask what becomes of a document: a fixed table of 19,200 rows."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            own = 1 << FILTERS.index(name)
            for mask in range(1 << len(FILTERS)):
                fails, gone = bool(mask & own), bool(mask & before)
                # In how many orders its filter is the one that removes the document.
                first_in = 120 // mask.bit_count() if fails else 0
                rows.append(
                    ("".join(order), step, mask, not (fails or gone), fails and not gone, fails and gone, mask == own, first_in)
                )
            before |= own
    columns = ["filter_order", "step", "mask", "_kept", "_removed", "_redundant", "_unique", "_shapley"]
    return pd.DataFrame(rows, columns=columns).astype({c: "int64" for c in columns[3:]})


def audit(df: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Counts per part, order of the filters and step; ``labels`` has doc_id, quality and toxic."""
    spark = df.sparkSession
    failed = masks(df, **options).groupBy("doc_id", "part", "mask").agg(F.count("*").alias("_n"))
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("_good"),
        F.max((F.col("toxic") == 1).cast("long")).alias("_toxic"),
    )
    marked = failed.join(marks, F.col("doc_id") == F.col("_id"), "left")
    counts = stored(
        marked.groupBy("part", "mask").agg(
            F.sum("_n").alias("_n"),
            F.sum(F.col("_n") * F.coalesce("_good", F.lit(0))).alias("_good"),
            F.sum(F.col("_n") * F.coalesce("_toxic", F.lit(0))).alias("_toxic"),
        ),
        "masks",
    )
    n = F.col("_n")
    read = counts.join(F.broadcast(spark.createDataFrame(plans())), "mask")
    return read.groupBy("part", "filter_order", F.col("step").cast("int").alias("step")).agg(
        F.sum(n * F.col("_kept")).alias("kept"),
        F.sum(n * F.col("_removed")).alias("removed"),
        F.sum(n * F.col("_redundant")).alias("redundant"),
        F.sum(n * F.col("_unique")).alias("unique_fails"),
        F.sum(F.col("_good") * F.col("_removed")).alias("good_lost"),
        F.sum(F.col("_toxic") * F.col("_removed")).alias("toxic_lost"),
        F.sum(n * F.col("_shapley")).alias("shapley"),
    )
