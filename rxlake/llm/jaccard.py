"""Groups of near-duplicate documents by a size-aware join of their word n-gram sets.

Two documents are linked when the common part of their sets is at least three quarters of the union.
Sets are told apart by size, with the boundary where the estimated cost of both ways is least:

* Light sets list all subsets of the size that a link requires, once per partner size. Two light
  sets are linked exactly if a subset meets, so no further check is needed.
* Heavy sets are found by scanning inverted lists of their prefix. With n-grams in one global order,
  linked sets share an n-gram within the first quarter, and at least k of them if the prefix is k - 1
  longer; k grows with the size, so sets that meet by chance are passed over by counting alone. The
  order is by hash, with the most frequent n-grams last, so passages that many documents share do not
  make long lists. Any order gives all links; the list of frequent n-grams is bounded and only saves
  work.

Only connections count, so pairs inside a group are not enumerated. Each set is first compared with
the heads of the lists it shares most n-grams with; a list's head is the set with most frequent
n-grams, as the least edited copy of a text is the one most others are linked with. What is linked
becomes one component. Then all pairs in a list that lie in different components are checked: first
by parity sketches, which bound the difference of two sets from below, then in full, the most promising
partners of each set before the others, so that the rest need not be compared if these are linked. Long lists
are cut into blocks, and pairs of blocks are tasks of their own.

Documents with equal sets are one set from the start. N-grams and sets are told apart by 64-bit
hashes.

Defined results: A-Z count as a-z. A document of fewer words than an n-gram is one n-gram as a whole.
Without words, or with a NULL text, a document has an empty set and is linked with nothing, nor with
others like it. Repeated rows are linked with each other. A document with a NULL id belongs to its
component but cannot name it; a component of such documents has a NULL name. An empty table gives no
rows. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxlake.llm.components import components
from rxlake.llm.words import LOWER, ROWS_BYTES, chunks, give_back, mix
from rxlake.sources.scratch import stored


@dataclass(frozen=True)
class Join:
    words: int = 5
    percent: int = 75
    most_light: int = 12  # sizes considered for subset enumeration
    check_cost: float = 6.0  # of an inverted-list entry and its checks, in enumerated subsets
    frequent: int = 1 << 17  # n-grams put last in the order, at most
    count_block: int = 2_000_000  # n-grams counted at a time
    count_least: int = 8
    filter_bits: int = 1 << 24  # of the filter of candidates, at least
    most_filter_bits: int = 1 << 28  # a fuller filter lets more texts by, but none less
    together: int = 64  # partners of one set that a task compares it with
    more: int = 24  # a linked pair shares one more prefix n-gram for as many n-grams of its sets
    heads: int = 2
    head_share: float = 0.3  # of the prefix that is worth comparing a set with a list's head
    block: int = 2048  # rows of a list that are paired at a time
    sketch_bits: int = 2048  # of the largest sketch; a set too large for it has none
    partners_first: int = 2  # of a set that are compared before all others

    def overlap(self, a: int, b: int) -> int:
        """The smallest common part of linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def linked(self, common: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return (100 + self.percent) * common >= self.percent * sizes

    def partners(self, n: int) -> range:
        """Sizes that a set of n can be linked with."""
        return range(-(-self.percent * n // 100), 100 * n // self.percent + 1)

    def least_shared(self, n: int) -> int:
        """Prefix n-grams that linked sets share at least, if neither is smaller than n."""
        return 1 + n // self.more

    def bits(self, n: int) -> int:
        """Bits of a set's sketch: a power of two, so the larger of two folds onto the smaller."""
        bits = max(256, 1 << (3 * n // 2 - 1).bit_length())
        # On average half the bits differ at most, so larger sets cannot be told apart.
        useful = (100 - self.percent) * 2 * n < (100 + self.percent) * self.sketch_bits // 2
        return min(bits, self.sketch_bits) if useful else 0

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + self.least_shared(n)

    def enumerated(self, n: int, boundary: int) -> int:
        return sum(comb(n, self.overlap(n, m)) for m in self.partners(n) if m <= boundary)


_MOST = (1 << 31) - 1


def row_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row with its sorted distinct n-gram hashes."""
    factors = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    for chunk in chunks(column, LOWER, ROWS_BYTES):
        h = chunk.hashes()
        count = max(len(h) - words + 1, 0)
        grams = np.zeros(count, np.uint64)
        for j in range(words):
            grams += h[j : j + count] * factors[j]
        grams = mix(grams)
        at = chunk.word_offsets
        for row in range(chunk.rows):
            first, last = at[row], at[row + 1]
            n = last - first
            if n >= words:
                yield chunk.first + row, np.unique(grams[first : last - words + 1])
            elif n:
                whole = (h[first:last] * factors[:n]).sum(dtype=np.uint64) + np.uint64(n)
                yield chunk.first + row, mix(np.array([whole], np.uint64) ^ np.uint64(0x5BD1E995))
            else:
                yield chunk.first + row, np.zeros(0, np.uint64)


def _set_id(grams: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64))


def _batch(columns: list, types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _sets(docs: DataFrame, join: Join) -> DataFrame:
    """A row (doc_id, n, set_id, sketch) per document, and (gram, times) rows of often seen n-grams.

    A sketch has the parity of the n-grams that fall on each of its bits.
    """
    names = ["doc_id", "n", "set_id", "gram", "times", "sketch"]
    schema = docs.select("doc_id").schema
    for name in names[1:5]:
        schema = schema.add(name, "long")
    schema = schema.add("sketch", "binary")

    def sketch(grams: np.ndarray) -> bytes | None:
        bits = join.bits(len(grams))
        if not bits:
            return None
        place = (grams % np.uint64(bits)).astype(np.int64)
        return np.packbits(np.bincount(place, minlength=bits).astype(np.uint8) & 1).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, total, id_type = [], 0, pa.int64()

        def often() -> pa.RecordBatch:
            grams, times = np.unique(np.concatenate(held), return_counts=True)
            grams, times = grams[times >= join.count_least], times[times >= join.count_least]
            n = len(grams)
            columns = [pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
            columns += [pa.array(grams.view(np.int64)), pa.array(times.astype(np.int64)), pa.nulls(n, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            id_type = batch.column(0).type
            sizes, ids, sketches = [], [], []
            for _, grams in row_sets(batch.column(1), join.words):
                sizes.append(len(grams))
                ids.append(_set_id(grams) if len(grams) else None)
                sketches.append(sketch(grams) if len(grams) else None)
                if len(grams) and ids[-1] not in seen:
                    seen.add(ids[-1])
                    held.append(grams)
                    total += len(grams)
                    if total >= join.count_block:
                        yield often()
                        held, total = [], 0
            none = pa.nulls(batch.num_rows, pa.int64())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), none, none]
            columns.append(pa.array(sketches, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)
        if held:
            yield often()
        held = []
        give_back()

    return stored(docs.mapInArrow(run, schema), "sets")


def _boundary(sets: DataFrame, join: Join) -> int:
    """The largest light size, where the cost summed over all sets is least."""
    small = sets.filter(F.col("n").between(1, join.most_light)).groupBy("n").agg(F.count("*").alias("k"))
    times = {row["n"]: row["k"] for row in small.collect()}

    def cost(boundary: int) -> float:
        light = sum(k * join.enumerated(n, boundary) for n, k in times.items() if n <= boundary)
        heavy = sum(k * join.prefix(n) for n, k in times.items() if n in _listed(boundary, join))
        return light + join.check_cost * heavy

    return min(range(join.most_light + 1), key=cost)


def _listed(boundary: int, join: Join) -> range:
    """Sizes that stand in inverted lists: heavy ones and light ones that a heavy one can match."""
    return range(join.partners(boundary + 1).start, 1 << 62)


def _entries(docs: DataFrame, join: Join, boundary: int, frequent: np.ndarray) -> DataFrame:
    """List entries (light, gram, set_id, ranked) of every set: subsets or prefix n-grams.

    ``ranked`` is the size, below a number that is smaller the more frequent n-grams the set has. A subset's key is made with both sizes of the pair it is for; its last bit tells if they are equal.
    """
    names, types = ["light", "gram", "set_id", "ranked"], [pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
    listed = _listed(boundary, join)

    def subsets(grams: np.ndarray) -> list[int]:
        n = len(grams)
        keys = []
        for m in join.partners(n):
            if m <= boundary:
                many = np.array(list(combinations(grams.tolist(), join.overlap(n, m))), np.uint64)
                key = np.full(len(many), np.uint64(min(n, m) * 64 + max(n, m)))
                for column in many.T:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
                keys.append(key & ~np.uint64(1) | np.uint64(n == m))
        return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)

    def prefix(grams: np.ndarray) -> tuple[np.ndarray, int]:
        at = np.searchsorted(frequent, grams)
        common = np.zeros(len(grams), bool)
        if len(frequent):
            common = frequent[np.minimum(at, len(frequent) - 1)] == grams
        first = np.concatenate([grams[~common], grams[common]])[: join.prefix(len(grams))]
        return first, int(common.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                parts = []
                for _, grams in row_sets(whole.column(0).slice(start, 500), join.words):
                    n = len(grams)
                    key = _set_id(grams) if n else None
                    if key is None or key in seen:
                        continue
                    seen.add(key)
                    if n <= boundary:
                        parts.append((True, subsets(grams), key, n))
                    if n in listed:
                        first, common = prefix(grams)
                        parts.append((False, first, key, _MOST - common << 32 | n))
                if parts:
                    sizes = [len(p[1]) for p in parts]
                    columns = [np.repeat([p[i] for p in parts], sizes) for i in (0, 2, 3)]
                    grams = np.concatenate([p[1] for p in parts]).view(np.int64)
                    yield _batch([columns[0], grams, columns[1], columns[2]], types, names)
        give_back()

    return docs.select("text").mapInArrow(run, "light boolean, gram long, set_id long, ranked long")


def _lists(entries: DataFrame, tasks: int) -> DataFrame:
    """Entries of lists with at least two sets, each with the list's first set as ``head``."""
    names = ["light", "gram", "set_id", "n", "head"]
    types = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    columns = ("light", "gram", "set_id", "ranked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row seen, its list's head, and whether it has been given out.
        last, head, given = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            light, gram, ids, n = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in columns)
            if last is not None:
                light, gram = np.append(last[0], light), np.append(last[1], gram)
                ids, n = np.append(last[2], ids), np.append(last[3], n)
            new_list = np.ones(len(ids), bool)
            new_list[1:] = (gram[1:] != gram[:-1]) | (light[1:] != light[:-1])
            fresh = new_list.copy()
            fresh[1:] |= ids[1:] != ids[:-1]
            light, gram, ids, n, new_list = (x[fresh] for x in (light, gram, ids, n, new_list))
            heads = ids[new_list][np.cumsum(new_list) - 1]
            if last is not None:
                heads[np.cumsum(new_list) == 1] = head
            ends = np.append(new_list[1:], True)
            out = ~(new_list & ends)  # not alone in its list, as far as seen
            if last is not None:
                out[0] = (out[0] or head != ids[0]) and not given
            was_given = given if last is not None else False
            last = (light[-1], gram[-1], ids[-1], n[-1])
            head = heads[-1]
            given = bool(out[-1]) or (len(ids) == 1 and was_given)
            if out.any():
                n = n & 0xFFFFFFFF
                yield _batch([x[out] for x in (light, gram, ids, n, heads)], types, names)

    placed = entries.repartition(tasks, "gram").sortWithinPartitions("gram", "light", "ranked", "set_id")
    return stored(placed.mapInArrow(run, "light boolean, gram long, set_id long, n long, head long"), "lists")


def _sure(light: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the light sets of every list.

    Where a list is for two different sizes, only sets of different sizes are linked: each is joined
    to the first set of the other size, if there is one.
    """
    same = F.col("gram").bitwiseAND(F.lit(1)) == 1
    alike = light.filter(same & (F.col("set_id") != F.col("head"))).select(F.col("set_id").alias("a"), F.col("head").alias("b"))
    mixed = light.filter(~same)
    ends = mixed.groupBy("gram").agg(
        F.min(F.struct("n", "set_id")).alias("lo"), F.min(F.struct(-F.col("n"), "set_id")).alias("hi")
    )
    ends = ends.filter(F.col("lo.n") < -F.col("hi.col1"))
    other = F.when(F.col("n") == F.col("lo.n"), F.col("hi.set_id")).otherwise(F.col("lo.set_id"))
    return alike.unionByName(mixed.join(ends, "gram").select(F.col("set_id").alias("a"), other.alias("b")))


def _bit_filter(ids: DataFrame, bits: int) -> np.ndarray:
    """A bit for the remainder of every id: ``bits`` / 8 bytes, whatever the number of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) % np.uint64(bits)
            np.bitwise_or.at(mask, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(mask)
        yield _batch([used, mask[used].view(np.int64)], [pa.int64(), pa.int64()], ["place", "mask"])

    rows = ids.mapInArrow(run, "place long, mask long").groupBy("place").agg(F.bit_or("mask").alias("mask"))
    out = np.zeros(bits // 64, np.uint64)
    found = rows.toPandas()
    out[found["place"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return out


def _filter_size(ids: int, join: Join) -> int:
    """Bits for so many ids: a power of two, eight for each id within the limits."""
    return min(max(join.filter_bits, 1 << (8 * ids - 1).bit_length()), join.most_filter_bits)


def _bodies(docs: DataFrame, ids: DataFrame, most: int, join: Join) -> DataFrame:
    """One compressed text for each of the sets ``ids``, ``most`` at most (and for some others, which the filter lets by)."""
    wanted = _bit_filter(ids, _filter_size(most, join))
    names, types = ["set_id", "body"], [pa.int64(), pa.binary()]
    bits = np.uint64(len(wanted) * 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer, seen = zstandard.ZstdCompressor(level=1), set()
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                column, rows = whole.column(0).slice(start, 1000), []
                for row, grams in row_sets(column, join.words):
                    if not len(grams):
                        continue
                    key = _set_id(grams)
                    at = np.array([key]).view(np.uint64)[0] % bits
                    if key in seen or not wanted[int(at) >> 6] >> np.uint64(int(at) & 63) & np.uint64(1):
                        continue
                    seen.add(key)
                    rows.append((key, packer.compress(column[row].as_py().encode())))
                if rows:
                    yield _batch(list(zip(*rows)), types, names)
        give_back()

    found = docs.select("text").mapInArrow(run, "set_id long, body binary")
    return stored(found.dropDuplicates(["set_id"]), "bodies")


def _salted(pairs: DataFrame, join: Join) -> DataFrame:
    """Pairs (a, b) with a salt: a set with many partners has a salt for every ``together`` of them."""
    many = pairs.groupBy("a").agg(F.count("*").alias("k")).filter(F.col("k") > join.together)
    salts = F.coalesce(F.ceil(F.col("k") / join.together), F.lit(1))
    return pairs.join(many, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), salts).alias("salt"))


def _verified(pairs: DataFrame, docs: DataFrame, join: Join, tasks: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked, each found from whole texts.

    The text of ``a`` is sent once per salt, ahead of those of its partners.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    bodies = _bodies(docs, ends, 2 * pairs.count(), join)
    salted = _salted(pairs.select("a", "b"), join)
    partner = salted.join(bodies.select(F.col("set_id").alias("b"), "body"), "b").select("a", "salt", "b", "body")
    own = salted.select("a", "salt").distinct().join(bodies.select(F.col("set_id").alias("a"), "body"), "a")
    rows = own.select("a", "salt", F.lit(None).cast("long").alias("b"), "body").unionByName(partner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker = zstandard.ZstdDecompressor()
        current, base = None, np.zeros(0, np.uint64)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch, found = whole.slice(start, 500), []
                texts = [unpacker.decompress(x.as_py()).decode() for x in batch.column(3)]
                columns = (batch.column(i).to_pylist() for i in (0, 1, 2))
                for a, salt, b, (_, grams) in zip(*columns, row_sets(pa.array(texts, pa.large_string()), join.words)):
                    if b is None:
                        current, base = (a, salt), grams
                        continue
                    if (a, salt) != current:
                        raise ValueError("a partner came without its own text")
                    common = len(np.intersect1d(base, grams, assume_unique=True))
                    if join.linked(common, len(base) + len(grams)):
                        found.append((a, b))
                if found:
                    yield _batch(list(zip(*found)), [pa.int64(), pa.int64()], ["a", "b"])
        give_back()

    placed = rows.repartition(tasks, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return placed.mapInArrow(run, "a long, b long")


def _sketches(found: list[bytes | None], most: int) -> list[np.ndarray]:
    """Words per sketch, all sketches as rows of ``most`` words, and all folded to half their size."""
    words = np.array([len(x or b"") // 8 for x in found], np.int64)
    whole, folded = np.zeros((2, len(found), most), np.uint64)
    for size in np.unique(words[words > 0]):
        at = np.flatnonzero(words == size)
        rows = np.frombuffer(b"".join(found[i] for i in at), np.uint64).reshape(len(at), size)
        whole[at, :size] = rows
        if size > 1:
            folded[at, : size // 2] = rows[:, : size // 2] ^ rows[:, size // 2 :]
    return [words, whole, folded]


def _across(lists: DataFrame, label: DataFrame, sets: DataFrame, join: Join, tasks: int) -> DataFrame:
    """Pairs (a, b) in different components that neither shared lists nor sketches rule out.

    ``apart`` is the least difference of their sets that the sketches allow.
    """
    sketches = sets.select("set_id", "sketch").dropDuplicates(["set_id"])
    entries = lists.filter("NOT light")
    # A set that stands in too few lists is linked with none, whatever its partner's size.
    open_sets = entries.groupBy("set_id").agg(F.count("*").alias("k"), F.first("n").alias("n"))
    smallest = F.ceil(join.percent * F.col("n") / 100)
    open_sets = open_sets.filter(F.col("k") >= 1 + F.floor(smallest / join.more)).select("set_id")
    open_sets = open_sets.join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
    open_sets = open_sets.withColumn("component", F.coalesce("component", "set_id"))
    rows = stored(entries.join(open_sets, "set_id").select("gram", "set_id", "n", "component"), "open")
    mixed = (
        rows.groupBy("gram")
        .agg(F.count("*").alias("k"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter("lo <> hi")
        .select("gram", F.ceil(F.col("k") / join.block).alias("blocks"))
    )
    rows = rows.join(mixed, "gram").withColumn("mine", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
    # A row meets every block of its list, in the task of that pair of blocks.
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(
        "gram",
        F.least("mine", "other").alias("p"),
        F.greatest("mine", "other").alias("q"),
        "n", "set_id", "mine", "component",
    )
    rows = rows.join(sketches, "set_id").select("gram", "p", "q", "n", "set_id", "mine", "component", "sketch")
    names, types = ["a", "b", "apart", "need"], [pa.int64()] * 4

    def pairs(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """All pairs of whole lists: each row with the next, then with the one after, and so on."""
        gram, p, q, n, ids, mine, component, words, sketch, folded = columns
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
        first = np.flatnonzero(new)
        end = np.repeat(np.append(first[1:], len(gram)), np.diff(np.append(first, len(gram))))
        row, apart = np.arange(len(gram)), 1
        while True:
            row = row[row + apart < end[row]]
            row = row[100 * n[row] >= join.percent * n[row + apart]]  # sizes ascend, so it stays so
            if not len(row):
                return
            to = row + apart
            meet = (component[row] != component[to]) & ((p[row] == q[row]) | (mine[row] != mine[to]))
            if meet.any():
                x, y = row[meet], to[meet]
                least = np.zeros(len(x), np.int64)  # known of their difference
                for a, b, which in (
                    (sketch, sketch, words[x] == words[y]),
                    (folded, sketch, words[x] == 2 * words[y]),
                    (sketch, folded, 2 * words[x] == words[y]),
                ):
                    at = np.flatnonzero(which & (words[x] > 0) & (words[y] > 0))
                    least[at] = np.bitwise_count(a[x[at]] ^ b[y[at]]).sum(1, dtype=np.int64)
                near = join.linked((n[x] + n[y] - least) / 2, n[x] + n[y])
                if near.any():
                    need = 1 + np.minimum(n[x[near]], n[y[near]]) // join.more
                    x, y, least = ids[x[near]], ids[y[near]], least[near]
                    yield _batch([np.minimum(x, y), np.maximum(x, y), least, need], types, names)
            apart += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # rows of the list that is still open, of one block pair
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy() for i in range(7)]
            columns += _sketches(batch.column(7).to_pylist(), join.sketch_bits // 64)
            start = len(columns[0])
            while start and all(columns[i][start - 1] == columns[i][-1] for i in range(3)):
                start -= 1
            if start:
                held.append([c[:start] for c in columns])
                yield from pairs([np.concatenate(c) for c in zip(*held)])
                held = []
            elif held and any(held[-1][i][-1] != columns[i][0] for i in range(3)):
                yield from pairs([np.concatenate(c) for c in zip(*held)])
                held = []
            held.append([c[start:] for c in columns])
        if held:
            yield from pairs([np.concatenate(c) for c in zip(*held)])
        held = []
        give_back()

    placed = rows.repartition(tasks, "gram", "p", "q").sortWithinPartitions("gram", "p", "q", "n", "set_id")
    shared = placed.mapInArrow(run, "a long, b long, apart long, need long").groupBy("a", "b")
    shared = shared.agg(
        F.first("apart").alias("apart"), F.first("need").alias("need"), F.count("*").alias("k")
    )
    return shared.filter("k >= need").select("a", "b", "apart")


def near_duplicates(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", join: Join = Join()
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id of its component)."""
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    both = _sets(docs, join)
    sets = both.filter("gram IS NULL").select("doc_id", "n", "set_id", "sketch")
    # At most ``frequent`` n-grams come to the driver and go out with the tasks.
    often = both.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("times").alias("times"))
    often = often.orderBy(F.desc("times"), "gram").limit(join.frequent).select("gram").toPandas()
    frequent = np.sort(often["gram"].to_numpy(np.int64).view(np.uint64))
    boundary = _boundary(sets, join)
    lists = _lists(_entries(docs, join, boundary, frequent), tasks)
    sure = _sure(lists.filter("light"))
    enough = join.head_share * (1 - join.percent / 100)
    shared = (
        lists.filter("NOT light AND set_id <> head")
        .groupBy(F.col("set_id").alias("b"), F.col("head").alias("a"))
        .agg(F.count("*").alias("k"), F.first("n").alias("n"))
        .filter(F.col("k") >= enough * F.col("n"))
    )
    best = shared.groupBy("b").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("k", "a")), asc=False), 1, join.heads).alias("heads")
    )
    stars = stored(best.select("b", F.explode("heads").alias("h")).select(F.col("h.a").alias("a"), "b"), "heads")
    edges = stored(_verified(stars, docs, join, tasks).unionByName(sure), "stars")
    label = components(edges)

    across = stored(_across(lists, label, sets, join, tasks), "across")
    if not across.isEmpty():
        # The nearest partners of every set, then whatever still lies in different components.
        ends = across.select("a", "b", "apart", F.explode(F.array("a", "b")).alias("own"))
        place = F.row_number().over(Window.partitionBy("own").orderBy("apart", "a", "b"))
        near = ends.withColumn("place", place).filter(F.col("place") <= join.partners_first)
        near = stored(near.select("a", "b").distinct(), "near")
        edges = stored(edges.unionByName(_verified(near, docs, join, tasks)), "edges")
        label = components(edges)
        rest = across.select("a", "b").join(near, ["a", "b"], "left_anti")
        for end in ("a", "b"):
            of = label.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
            rest = rest.join(of, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
        rest = stored(rest.filter("_a <> _b").select("a", "b"), "rest")
        if not rest.isEmpty():
            label = components(edges.unionByName(_verified(rest, docs, join, tasks)))

    first = sets.filter("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("k")
    )
    named = first.join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
    alone = named.filter("component IS NULL AND k > 1").select("set_id", F.col("first").alias("root"))
    joined = named.filter("component IS NOT NULL")
    roots = joined.groupBy("component").agg(F.min("first").alias("root"))
    names = joined.join(roots, "component").select("set_id", "root").unionByName(alone)
    # A set that very many documents have is spread over several tasks.
    salts = 16
    names = names.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = sets.drop("sketch").withColumn("_salt", F.pmod(F.hash("doc_id"), F.lit(salts)))
    return rows.join(names, ["set_id", "_salt"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("root", "doc_id").alias("component_id"),
    )
