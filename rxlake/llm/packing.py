"""Packing documents into training sequences of balanced attention cost.

A piece of n tokens costs ``linear * n + quadratic * n * n``, as attention stays inside a piece. Each
task reads its documents in blocks. A document gives as many full sequences as it can; the rests of a
block, longest first, go to the sequence of lowest cost that still has room. What fits nowhere whole
is cut over the room that is left, and what is over after that opens the next block, so every
sequence is full but those at the end of a task: these get power-of-two lengths and no padding either.

Nothing is shuffled and a task holds one block of ids at a time. Sequence numbers are made of the
partition number and a counter.

Defined results: a NULL or empty text is the end token alone; equal rows are packed as often as they
occur; a text longer than a sequence is cut; NULL ids pass through; an empty table gives no pieces.
Columns beyond id and text are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rxlake.llm.words import give_back

_TAIL = r"^(?P<core>.*[\p{Ll}\p{Nd}])(?P<tail>[.,;:!?]+)$"  # lower-casing turns some other letters into letter and mark


def _gather(flat: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``which`` of ``flat`` one after another, and their n + 1 offsets."""
    length = (ends[1:] - ends[:-1])[which]
    total = np.zeros(len(which) + 1, np.int64)
    np.cumsum(length, out=total[1:])
    return flat[np.repeat(ends[which] - total[:-1], length) + np.arange(total[-1])], total


class WordTokenizer:
    """Token ids of whole Arrow columns for a tokenizer that works word by word.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its
    blank-separated runs in order. Each distinct run is encoded once per batch, and words in use are
    remembered per worker. A run is looked up in lower case and without closing marks, which are
    words of their own after a letter or digit; a run that may hold a special token is left as it is.

    New words of letters only are encoded many at a time as one text. Each ends in the one token with
    a word end, where the ids are cut again; if the numbers of words and word ends differ, word by word.
    """

    def __init__(self, path: str, remembered: int = 300_000, together: int = 100):
        # A task has one core; the tokenizer's own threads would each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered, self.together = remembered, together
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.word_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # Remembered words as one array, as a Python dictionary of them takes many times the memory.
        self.words = pa.array([], pa.large_string())
        self.flat, self.ends, self.uses = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0)

    def _encode_each(self, words: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _encode_together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        texts = [" ".join(words[at : at + self.together]) for at in range(0, len(words), self.together)]
        flat = np.concatenate(self._encode_each(texts))
        ends = np.flatnonzero(self.word_end[flat]) + 1
        if len(ends) != len(words) or ends[-1] != len(flat):
            return None
        return flat, np.concatenate([[0], ends])

    def _encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, in their order, and n + 1 offsets."""
        letters = np.asarray(pc.match_substring_regex(words, r"^\p{Ll}+$"))
        flats, lengths = [], np.zeros(len(words), np.int64)
        order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        plain, at = int(letters.sum()), 0
        while at < len(order):
            some = order[at : min(at + 2_000, plain if at < plain else len(order))]
            texts = words.take(pa.array(some)).to_pylist()
            found = self._encode_together(texts) if at < plain else None
            if found is None:
                each = self._encode_each(texts)
                found = np.concatenate(each), np.cumsum([0, *map(len, each)])
            flats.append(found[0])
            lengths[some] = np.diff(found[1])
            at += len(some)
        if not flats:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return _gather(np.concatenate(flats), np.concatenate([[0], np.cumsum(lengths[order])]), back)

    def _look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of remembered words with their ends, and the place of each of the given words."""
        self._forget()
        place = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        fresh = words.take(pa.array(new))
        flat, ends = self._encode(fresh)
        place[new] = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, fresh])
        self.ends = np.concatenate([self.ends, len(self.flat) + ends[1:]])
        self.flat = np.concatenate([self.flat, flat])
        self.uses = np.concatenate([self.uses, np.zeros(len(new))])
        self.uses[place] += 1
        return self.flat, self.ends, place

    def _forget(self) -> None:
        """Beyond the limit the half that was used in fewest batches goes, older uses counting less."""
        if len(self.words) > self.remembered:
            stay = np.sort(np.argsort(-self.uses, kind="stable")[: self.remembered // 2])
            self.flat, self.ends = _gather(self.flat, self.ends, stay)
            self.words, self.uses = self.words.take(pa.array(stay)), self.uses[stay] / 2

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column and the n + 1 offsets of its rows."""
        runs = pc.ascii_split_whitespace(column.cast(pa.large_string()).fill_null(""))
        bounds = runs.offsets.to_numpy()
        coded = runs.flatten().dictionary_encode()
        # Splitting an empty or blank text gives empty runs, which have no ids.
        forms = coded.dictionary
        plain = pc.if_else(pc.match_substring(forms, "<|"), forms, pc.ascii_lower(forms))
        cut = pc.extract_regex(plain, _TAIL)
        core = pc.coalesce(pc.struct_field(cut, "core"), plain).dictionary_encode()
        tail = pc.coalesce(pc.struct_field(cut, "tail"), pa.scalar("", plain.type)).dictionary_encode()
        words = pa.concat_arrays([core.dictionary, tail.dictionary]).dictionary_encode()
        flat, ends, place = self._look_up(words.dictionary)
        place = place[words.indices.to_numpy()]
        many = len(core.dictionary)
        pair = np.stack([place[core.indices.to_numpy()], place[many + tail.indices.to_numpy()]], 1).ravel()
        flat, ends = _gather(flat, ends, pair)  # of distinct runs
        flat, total = _gather(flat, ends[::2], coded.indices.to_numpy())
        return flat, total[bounds - bounds[0]]


@dataclass(frozen=True)
class Packing:
    capacity: int = 4096
    end_id: int = 2
    linear: float = 1.0
    quadratic: float = 1 / 4096
    block_tokens: int = 1 << 20
    slice_bytes: int = 2 << 20  # texts encoded at a time


def assign(lengths: np.ndarray, bins: int, settings: Packing) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """Place rests into sequences.

    Returns pieces as (item, start within it, length, bin), and what found no room as (item, start).
    """
    room = np.full(bins, settings.capacity)
    cost = np.zeros(bins)
    pieces, cut, over = [], [], []

    def put(item: int, start: int, n: int, b: int) -> None:
        pieces.append((item, start, n, b))
        room[b] -= n
        cost[b] += settings.linear * n + settings.quadratic * n * n

    for item in np.argsort(-lengths, kind="stable"):
        n = int(lengths[item])
        b = int(np.argmin(np.where(room >= n, cost, np.inf))) if bins else 0
        if bins and room[b] >= n:
            put(int(item), 0, n, b)
        else:
            cut.append((int(item), n))
    for item, n in cut:
        start = 0
        while start < n and room.any():
            b = int(np.argmin(np.where(room > 0, cost, np.inf)))
            take = min(n - start, int(room[b]))
            put(item, start, take, b)
            start += take
        if start < n:
            over.append((item, start))
    return pieces, over


class _Block:
    """The rests of one block, and the pieces made so far."""

    def __init__(self, settings: Packing, first_sequence: int):
        self.settings, self.sequence = settings, first_sequence
        self.rests: list[tuple] = []  # (document, its tokens, start, ids)
        self.tokens = 0
        self.rows: list[tuple] = []  # (document, start, ids, its tokens, sequence, offset, sequence length)

    def add(self, doc: object, ids: np.ndarray) -> None:
        size, cap = len(ids), self.settings.capacity
        for start in range(0, size - cap + 1, cap):
            self.rows.append((doc, start, ids[start : start + cap], size, self.sequence, 0, cap))
            self.sequence += 1
        if size % cap:
            start = size - size % cap
            self.rests.append((doc, size, start, ids[start:]))
            self.tokens += size - start

    def _emit(self, taken: list[tuple[int, int, int, int]], rests: list[tuple]) -> None:
        used = {}
        for _, _, n, b in taken:
            used[b] = used.get(b, 0) + n
        at: dict[int, int] = {}
        for item, begin, n, b in taken:
            doc, size, start, ids = rests[item]
            row = (doc, start + begin, ids[begin : begin + n], size, self.sequence + b, at.get(b, 0), used[b])
            self.rows.append(row)
            at[b] = at.get(b, 0) + n
        self.sequence += 1 + max(used, default=-1)

    def flush(self, last: bool) -> None:
        rests, cap = self.rests, self.settings.capacity
        lengths = np.array([len(r[3]) for r in rests], np.int64)
        pieces, over = assign(lengths, self.tokens // cap, self.settings)
        self._emit(pieces, rests)
        self.rests = [(d, size, start + cut, ids[cut:]) for (d, size, start, ids), cut in ((rests[i], c) for i, c in over)]
        self.tokens = sum(len(r[3]) for r in self.rests)
        if last and self.tokens:
            # The binary digits of what is left are the lengths of the last sequences.
            sizes = [1 << k for k in range(self.tokens.bit_length() - 1, -1, -1) if self.tokens >> k & 1]
            taken, b, room = [], 0, sizes[0]
            for item, (_, _, _, ids) in enumerate(self.rests):
                begin = 0
                while begin < len(ids):
                    if not room:
                        b, room = b + 1, sizes[b + 1]
                    n = min(room, len(ids) - begin)
                    taken.append((item, begin, n, b))
                    begin, room = begin + n, room - n
            self._emit(taken, self.rests)
            self.rests, self.tokens = [], 0


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pack(
    df: DataFrame,
    tokenizer: Callable[[], str],
    doc_id: str = "doc_id",
    text: str = "text",
    settings: Packing = Packing(),
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece; ``tokenizer`` gives the vocabulary file's path on the executor."""
    source = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType)])
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"):
        schema.add(name, "long")
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))

    def rows_of(block: _Block, id_type: pa.DataType) -> pa.RecordBatch:
        doc, start, ids, size, sequence, offset, used = zip(*block.rows)
        block.rows = []
        columns = [
            pa.array(doc, id_type),
            *(
                pa.array(x, pa.int64())
                for x in (start, map(len, ids), (zlib.crc32(i.tobytes()) for i in ids), size, sequence, offset, used)
            ),
        ]
        if with_ids:
            columns.append(pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(tokenizer())
        block = _Block(settings, TaskContext.get().partitionId() << 33)
        for whole in batches:
            id_type = whole.column(0).type
            rows = max(1, int(whole.num_rows * settings.slice_bytes / max(whole.nbytes, 1)))
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                ids, ends = words.ids(batch.column(1))
                for row, doc in enumerate(batch.column(0).to_pylist()):
                    own = ids[ends[row] : ends[row + 1]]
                    block.add(doc, np.append(own, np.uint32(settings.end_id)).astype("<u4"))
                    if block.tokens >= settings.block_tokens:
                        block.flush(False)
                if block.rows:
                    yield rows_of(block, id_type)
                give_back()
        block.flush(True)
        if block.rows:
            yield rows_of(block, id_type)
        give_back()

    return source.mapInArrow(run, schema)
