"""A log-bilinear language model of the corpus, trained by noise-contrastive estimation.

Tokens are words with A-Z in lower case, and an end after each text. From the training documents come

1. exact counts of all words, as a table keyed by 64-bit hashes. The most frequent ones, a bounded number,
   go to every task as a lookup; the counts of all others are joined.
2. the neural model over *classes*: the end, the most frequent words, and one class for the rest, within
   which a word has its smoothed share. The vectors of the two words before, each weighted by its
   place, add up to a prediction; its product with a class vector plus a bias, over the frequency of the
   class, is the class's score.

Training learns to tell each token from noise drawn by frequency, shared within a minibatch, so it needs
matrix products only and no normaliser. Every training document is learned from: in a round each task
improves the model on its own documents, in one pass at any size of the table, and the tasks' models are averaged by their tokens, some rows of
the parameters at a time. Scoring does normalise: one matrix product per distinct pair of words before
gives the sum over all classes.

Defined results: a NULL or empty text is its end alone. A NULL id is in the training part, as its checksum
is not 0 mod 10. Repeated rows count and are scored each. Without training tokens every word is unseen and
the model is its starting point. An empty table gives no rows. Other columns are ignored. The sizes of the model
and of the lookup are parameters; a task holds one block of tokens, or its longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxlake.llm import words
from rxlake.sources.scratch import stored

END = 1  # in place of a word's hash
SMOOTHING = 0.1


@dataclass(frozen=True)
class Settings:
    classes: int = 1024  # the end and the most frequent words; one more for the rest
    lookup: int = 1 << 17  # words whose counts every task has, at most
    dimensions: int = 24
    context: int = 2
    noise: int = 64  # samples of a minibatch
    batch: int = 1_024
    rate: float = 0.1
    rounds: int = 2
    block_tokens: int = 1 << 18
    task_tokens: int = 1 << 20  # without effect: a round is one pass, whatever a task's size
    slices: int = 16  # of the parameters, averaged apart
    seed: int = 11


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))


# --- counts -----------------------------------------------------------------------------------


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(inverse, np.concatenate(counts), len(key)).astype(np.int64)


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of a one-column table of texts; the word is its hash, the end is ``END``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, rows = [], [], 0, 0
        fields = ["word", "n"]

        def out() -> pa.RecordBatch:
            key, n = _summed(keys, counts)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], fields)

        for batch in batches:
            rows += batch.num_rows
            for chunk in words.chunks(batch.column(0), words.LOWER):
                key, n = np.unique(chunk.hashes(), return_counts=True)
                keys.append(key)
                counts.append(n)
                held += len(key)
                if held > 1 << 22:
                    if len(keys) > 1:
                        keys, counts = ([x] for x in _summed(keys, counts))
                    held = len(keys[0])
                    if held > 1 << 21:
                        yield out()
                        keys, counts, held = [], [], 0
        keys.append(np.array([END], np.uint64))
        counts.append(np.array([rows], np.int64))
        yield out()
        words.give_back()

    found = texts.mapInArrow(run, "word long, n long")
    return stored(found.groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0"), "counts")


@dataclass(frozen=True)
class Vocabulary:
    """The bounded part of the counts that every task has."""

    key: np.ndarray  # hashes in order
    rank: np.ndarray  # by key: 0 is the end, then words by falling count
    count: np.ndarray  # by rank
    tokens: int
    types: int
    classes: int  # ranks below this are classes; the class of this number is the rest

    @property
    def base(self) -> float:
        return float(np.log10(self.tokens + SMOOTHING * (self.types + 1)))

    @property
    def rest(self) -> float:
        """As ``base``, for the words that are no classes."""
        own = self.count[: self.classes]
        left = self.tokens - int(own.sum())
        return float(np.log10(left + SMOOTHING * (self.types - int((own > 0).sum()) + 1)))


def vocabulary(counts: DataFrame, settings: Settings = Settings()) -> Vocabulary:
    """The words above the least count that leaves no more of them than the lookup holds."""
    types, tokens = counts.agg(F.count("*"), F.sum("n")).first()
    least = 0
    if types > settings.lookup:
        by_count = stored(counts.groupBy("n").agg(F.count("*").alias("types")), "by_count")  # few distinct counts
        level, above = by_count.orderBy(F.desc("n")).limit(settings.lookup).toLocalIterator(), 0
        for row in level:
            above += row.types
            if above > settings.lookup:
                least = row.n
                break
    found = counts.filter((F.col("n") > least) | (F.col("word") == END)).toPandas()
    found["end"] = found["word"] != END
    found = found.sort_values(["end", "n", "word"], ascending=[True, False, True])
    key, count = found["word"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    if not len(key) or key[0] != END:
        key, count = np.concatenate([[np.uint64(END)], key]), np.concatenate([[0], count])
    order = np.argsort(key)
    return Vocabulary(key[order], order, count, int(tokens or 0), types, min(settings.classes, len(key)))


# --- documents as classes ---------------------------------------------------------------------


def encode(df: DataFrame, known: Vocabulary) -> DataFrame:
    """Documents (doc_id, text, held_out) as classes, with sums over the words of the lookup.

    ``rare`` has the hashes of all other words, ``uid`` tells rows apart.
    """
    shape = T.StructType([T.StructField("uid", T.LongType()), df.schema["doc_id"], T.StructField("held_out", T.BooleanType())])
    for name in ("n_tokens", "n_known", "n_rest"):
        shape.add(name, T.LongType())
    shape.add("base_sum", T.DoubleType()).add("rest_sum", T.DoubleType()).add("classes", T.BinaryType())
    shape.add("rare", T.ArrayType(T.LongType()))
    logs = np.log10(known.count + SMOOTHING)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for chunk in words.chunks(batch.column(1), words.LOWER):
                n, row = chunk.rows, chunk.word_row
                h = chunk.hashes()
                at = np.minimum(np.searchsorted(known.key, h), len(known.key) - 1)
                found = known.key[at] == h
                rank = np.where(found, known.rank[at], len(known.key))
                rest = rank >= known.classes
                log = np.append(logs, 0.0)[rank]
                classes = np.zeros(len(h) + n, np.uint16)  # an end is class 0
                classes[np.arange(len(h)) + row] = np.minimum(rank, known.classes)
                bounds = (chunk.word_offsets + np.arange(n + 1)) * 2
                size = np.diff(chunk.word_offsets)
                rare = np.flatnonzero(~found)
                columns = [
                    pa.array(uid + np.arange(n)),
                    batch.column(0).slice(chunk.first, n),
                    batch.column(2).slice(chunk.first, n),
                    pa.array(size + 1),
                    pa.array(np.bincount(row, found, n).astype(np.int64) + int(known.count[0] > 0)),
                    pa.array(np.bincount(row, rest, n).astype(np.int64)),
                    pa.array(np.bincount(row, log, n) + logs[0]),
                    pa.array(np.bincount(row, log * rest, n)),
                    pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(classes)]).cast(pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(row[rare], np.arange(n + 1)), pa.int32()), pa.array(h[rare].view(np.int64))
                    ),
                ]
                uid += n
                yield pa.RecordBatch.from_arrays(columns, shape.names)
        words.give_back()

    return stored(df.select("doc_id", "text", "held_out").mapInArrow(run, shape), "classes")


def _blocks(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All classes of a column of encoded documents, and the n + 1 offsets of its rows."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return body.view(np.uint16).astype(np.int64), (offsets - offsets[0]) // 2


def contexts(classes: np.ndarray, offsets: np.ndarray, many: int, begin: int) -> np.ndarray:
    """The ``many`` classes before each token, the nearest first; ``begin`` before a document's first."""
    out = np.full((len(classes), many), begin, np.int64)
    place = np.arange(len(classes)) - np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(1, many + 1):
        inside = np.flatnonzero(place >= k)
        out[inside, k - 1] = classes[inside - k]
    return out


# --- the model --------------------------------------------------------------------------------


def _distinct(key: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of each distinct key below ``many``, and which of them each row has; without sorting if there is room."""
    if many > 1 << 22:
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        return first, inverse
    row = np.arange(len(key), dtype=np.int32)
    of = np.empty(many, np.int32)
    of[key] = row  # one of a key's rows
    chosen = of.take(key)
    first = np.flatnonzero(chosen == row)
    of[key.take(first)] = np.arange(len(first), dtype=np.int32)
    return first, of.take(key)


@dataclass
class Model:
    """``words`` are vectors of classes before a token, ``places`` their weights by distance."""

    words: np.ndarray
    places: np.ndarray
    classes: np.ndarray
    bias: np.ndarray
    frequency: np.ndarray  # log share of each class, fixed

    def predict(self, before: np.ndarray) -> np.ndarray:
        return sum(self.words[before[:, k]] * self.places[k] for k in range(before.shape[1]))

    def scores(self, predicted: np.ndarray) -> np.ndarray:
        return predicted @ self.classes.T + (self.bias + self.frequency)

    def log_probabilities(self, before: np.ndarray, token: np.ndarray, rows: int = 256) -> np.ndarray:
        """Natural logarithms, normalised over all classes; equal contexts are worked out once."""
        key = before[:, 0]
        for k in range(1, before.shape[1]):
            key = key * len(self.words) + before[:, k]
        first, inverse = _distinct(key, len(self.words) ** before.shape[1])
        predicted = self.predict(before[first])
        total = np.empty(len(first), np.float64)
        for at in range(0, len(first), rows):
            scores = self.scores(predicted[at : at + rows])
            top = scores.max(1, keepdims=True)
            scores -= top
            np.exp(scores, out=scores)
            total[at : at + rows] = np.log(scores.sum(1).astype(np.float64)) + top[:, 0]
        out = np.empty(len(token), np.float64)
        for at in range(0, len(token), 1 << 16):
            own, t = inverse[at : at + (1 << 16)], token[at : at + (1 << 16)]
            score = np.einsum("ij,ij->i", predicted[own], self.classes[t])
            out[at : at + (1 << 16)] = score + self.bias[t] + self.frequency[t] - total[own]
        return out

    def parameters(self) -> list[np.ndarray]:
        return [self.words, self.places, self.classes, self.bias]


def start(known: Vocabulary, settings: Settings = Settings()) -> Model:
    rng = np.random.default_rng(settings.seed)
    many = known.classes + 1
    count = np.append(known.count[: known.classes], max(known.tokens - known.count[: known.classes].sum(), 0)) + 1.0
    return Model(
        rng.normal(0, 0.1, (many + 1, settings.dimensions)).astype(np.float32),
        np.ones((settings.context, settings.dimensions), np.float32),
        rng.normal(0, 0.1, (many, settings.dimensions)).astype(np.float32),
        np.zeros(many, np.float32),
        np.log(count / count.sum()).astype(np.float32),
    )


def _row_sums(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that occur, in order, and the sums of their rows."""
    order = np.argsort(at.astype(np.uint16), kind="stable")  # classes are few; short integers sort by radix
    sorted_at = at[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_at[1:] != sorted_at[:-1]]))
    return sorted_at[first], np.add.reduceat(rows.take(order, 0), first, axis=0)


def _odds(model: Model, predicted: np.ndarray, token: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of being data rather than noise, of the tokens and of every noise sample in their place.

    They are the scores, without the frequency that noise is drawn by, over the number of samples.
    """
    many = np.float32(np.log(len(noise)))
    true = np.einsum("ij,ij->i", predicted, model.classes[token]) + model.bias[token] - many
    return true, predicted @ model.classes[noise].T + (model.bias[noise] - many)


def likelihood(model: Model, before: np.ndarray, token: np.ndarray, noise: np.ndarray) -> float:
    """The noise-contrastive log likelihood of a minibatch."""
    true, false = _odds(model, model.predict(before), token, noise)
    return -float(np.logaddexp(0, -true).sum() + np.logaddexp(0, false).sum())


def _slopes(model: Model, before: np.ndarray, token: np.ndarray, noise: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The gradients of the likelihood, as rows of each parameter that are not all 0 and their values."""
    predicted = model.predict(before)
    true, g_false = _odds(model, predicted, token, noise)
    # 1 / (1 + exp(x)) is (1 - tanh(x / 2)) / 2, which needs no bounds.
    g_true = (1 - np.tanh(true / 2)) / 2
    np.tanh(np.multiply(g_false, 0.5, out=g_false), out=g_false)
    g_false += 1
    g_false *= -0.5
    # The bias is one more column of a class's row, so tokens and noise are sorted and added up once.
    many = len(token)
    own = np.empty((many + len(noise), predicted.shape[1] + 1), predicted.dtype)
    np.multiply(g_true[:, None], predicted, out=own[:many, :-1])
    np.matmul(g_false.T, predicted, out=own[many:, :-1])
    own[:many, -1], own[many:, -1] = g_true, g_false.sum(0)
    classes, d_classes = _row_sums(np.concatenate([token, noise]), own)
    back = g_true[:, None] * model.classes.take(token, 0) + g_false @ model.classes[noise]
    distances = before.shape[1]
    d_places = np.empty_like(model.places)
    ahead = np.empty((distances, *back.shape), back.dtype)
    for k in range(distances):
        d_places[k] = np.einsum("ij,ij->j", back, model.words.take(before[:, k], 0))
        np.multiply(back, model.places[k], out=ahead[k])
    words_, d_words = _row_sums(before.T.ravel(), ahead.reshape(-1, back.shape[1]))
    return [(words_, d_words), (np.arange(distances), d_places), (classes, d_classes[:, :-1]), (classes, d_classes[:, -1])]


def gradients(model: Model, before: np.ndarray, token: np.ndarray, noise: np.ndarray) -> list[np.ndarray]:
    """The gradients of the likelihood."""
    whole = [np.zeros_like(p) for p in model.parameters()]
    for gradient, (rows, values) in zip(whole, _slopes(model, before, token, noise)):
        gradient[rows] = values
    return whole


def improve(model: Model, before: np.ndarray, token: np.ndarray, sums: list[np.ndarray], rng: np.random.Generator, settings: Settings) -> None:
    """One pass over the tokens in random order; steps shrink with the squared gradients so far.

    Only rows that a minibatch touches move, so only these are worked on.
    """
    share = np.cumsum(np.exp(model.frequency, dtype=np.float64))
    order = rng.permutation(len(token))
    for at in range(0, len(order), settings.batch):
        some = order[at : at + settings.batch]
        drawn = np.searchsorted(share, rng.random(settings.noise) * share[-1], "right")
        noise = np.minimum(drawn, len(share) - 1)
        steps = _slopes(model, before.take(some, 0), token.take(some), noise)
        for parameter, (rows, step), squares in zip(model.parameters(), steps, sums):
            step = step / np.float32(len(some))
            seen = squares.take(rows, 0) + step * step
            squares[rows] = seen
            parameter[rows] += settings.rate * step / np.sqrt(seen + 1e-10)


def train(encoded: DataFrame, known: Vocabulary, settings: Settings = Settings()) -> Model:
    """Rounds of local training and averaging over all training documents."""
    model = start(known, settings)
    texts = encoded.filter("NOT held_out").select("classes")

    def learn(round_: int, model: Model):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng([settings.seed, round_, TaskContext.get().partitionId()])
            sums = [np.zeros_like(p) for p in model.parameters()]
            held, waiting, tokens = [], 0, 0

            def block() -> tuple[np.ndarray, np.ndarray]:
                classes, offsets = _blocks(pa.chunked_array(held).combine_chunks())
                return contexts(classes, offsets, settings.context, known.classes + 1), classes

            for batch in batches:
                column = batch.column(0)
                for at in range(0, len(column), 256):
                    held.append(column.slice(at, 256))
                    waiting += held[-1].nbytes // 2
                    if waiting >= settings.block_tokens:
                        before, token = block()
                        improve(model, before, token, sums, rng, settings)
                        tokens += len(token)
                        held, waiting = [], 0
            if held:
                before, token = block()
                improve(model, before, token, sums, rng, settings)
                tokens += len(token)
            if tokens:
                flat = np.concatenate([p.ravel() for p in model.parameters()])
                parts = np.array_split(flat, settings.slices)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(settings.slices, dtype=np.int32)),
                        pa.array(np.full(settings.slices, float(tokens))),
                        pa.array([p.astype(np.float32).tobytes() for p in parts], pa.binary()),
                    ],
                    ["slice", "tokens", "part"],
                )
            words.give_back()

        return run

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        weight: dict[int, float] = {}
        for batch in batches:
            for k, tokens, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                sums[k] = sums.get(k, 0) + tokens * np.frombuffer(part, np.float32).astype(np.float64)
                weight[k] = weight.get(k, 0) + tokens
        parts = [(sums[k] / weight[k]).astype(np.float32).tobytes() for k in sums]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(parts, pa.binary())], ["slice", "part"])

    shape = "slice int, tokens double, part binary"
    for round_ in range(settings.rounds):
        # Sorted, so the sums do not depend on which task is done first.
        learned = texts.mapInArrow(learn(round_, model), shape).repartition(settings.slices, "slice")
        learned = learned.sortWithinPartitions("slice", "tokens", "part")
        averaged = stored(learned.mapInArrow(average, "slice int, part binary"), "model").orderBy("slice").collect()
        if not averaged:
            break
        flat = np.concatenate([np.frombuffer(r.part, np.float32) for r in averaged])
        ends = np.cumsum([p.size for p in model.parameters()])[:-1]
        shaped = [x.reshape(p.shape).copy() for x, p in zip(np.split(flat, ends), model.parameters())]
        model = Model(*shaped, model.frequency)
    return model


# --- scores -----------------------------------------------------------------------------------


def _model_sums(encoded: DataFrame, model: Model, settings: Settings) -> DataFrame:
    """Add ``model_sum``, the log10 probability of a document's classes."""
    kept = [c for c in encoded.columns if c not in ("classes", "rare")]
    shape = T.StructType([*encoded.select(*kept).schema.fields]).add("model_sum", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, offsets = _blocks(batch.column("classes"))
            sums = np.zeros(batch.num_rows)
            row = 0
            while row < batch.num_rows:  # some documents of a block's tokens, or a long one in parts
                to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + settings.block_tokens, "right")) - 1)
                own = offsets[row : to + 1] - offsets[row]
                token = classes[offsets[row] : offsets[to]]
                before = contexts(token, own, settings.context, len(model.words) - 1)
                doc = np.repeat(np.arange(to - row), np.diff(own))
                for at in range(0, len(token), settings.block_tokens):
                    cut = slice(at, at + settings.block_tokens)
                    log = model.log_probabilities(before[cut], token[cut])
                    sums[row:to] += np.bincount(doc[cut], log, to - row)
                row = to
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums / np.log(10))], shape.names)
        words.give_back()

    return encoded.select(*kept, "classes").mapInArrow(run, shape)


def score(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """Base score and model score of every document, in log10."""
    docs = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"), held_out(df[doc_id]).alias("held_out"))
    counts = count_words(docs.filter("NOT held_out").select("text"))
    known = vocabulary(counts, settings)
    encoded = encode(docs, known)
    model = train(encoded, known, settings)
    rare = encoded.select(F.col("uid").alias("_uid"), F.explode("rare").alias("_word"))
    joined = rare.join(counts.select("word", "n"), F.col("_word") == F.col("word"), "left")
    rare_sums = joined.groupBy("_uid").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)).alias("_log"), F.count("n").alias("_known")
    )
    whole = _model_sums(encoded, model, settings).join(rare_sums, F.col("uid") == F.col("_uid"), "left")
    log = F.coalesce("_log", F.lit(0.0))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base_sum") + log - F.col("n_tokens") * known.base).alias("base_score"),
        (F.col("model_sum") + F.col("rest_sum") + log - F.col("n_rest") * known.rest).alias("score"),
    )
