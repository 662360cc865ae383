"""The prefix trie of conversations, built as z-fast tries of bounded size under a small crown.

Conversations share beginnings: of every twenty (by id), each may begin with the first turns of the first
one. A node of the trie is a distinct sequence of first turns. Turns are hashed to 128 bits before
anything is grouped, and a prefix is the xor of its turns' hashes mixed with their places, so a
conversation is one short array and texts are not shuffled.

* **Z-fast trie.** A compacted node stands for a run of depths that no conversation leaves or ends in.
  It is kept in a hash table under its handle, the prefix at the two-fattest depth of its run. A
  conversation finds the node it exits from by fat binary search, with a logarithmic number of lookups.
  A batch looks up all its exits first and is then inserted from there; runs are split where
  conversations part or end. At the end runs are expanded into one row per depth.
* **Cutting.** A trie holds the conversations that agree on their first 1, 2, 4, ... turns, where the
  smallest of these depths is taken at which no more than a bounded number of turns is left. So a first
  turn that a third of all conversations have is cut deeper.
* **Crown.** The nodes above the cuts are sums over tries, and over groups of equal conversations that end
  there. What sharing saves below a node needs no walk over the tree: a conversation owns the nodes
  where its id is the least, from some depth on, and saves the words of the turns above that.

Defined results: rows without conv_id belong to no conversation. A NULL role or text is empty. Turns of
equal number (NULL first) follow their role, then a hash of their text. The shared turns of a negative
conv_id come from ``conv_id - conv_id % 20`` with the remainder of its sign. Conversations left without turns
are members of the root. An empty table has no nodes. Other columns are ignored. A task holds the hashes
of its longest conversation, 24 bytes a turn, and a trie of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.llm.words import give_back, mix
from rxlake.sources.scratch import stored

SPACE = r"\x20\x09-\x0D"
NO_ENDS = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Settings:
    group: int = 20  # conversations that may share first turns
    shared: int = 4  # a conversation shares fewer turns than this
    trie_turns: int = 1 << 17  # turns in a trie at most
    least_turns: int = 1_000  # tries are not made smaller than this
    batch: int = 4_096  # conversations inserted at a time


# --- conversations as arrays of prefix hashes -------------------------------------------------


def rebuilt(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per conv_id with its turns in order, the first ones taken from the group's first id.

    Columns: conv_id, length, p1 and p2 (prefix hashes), words.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    words = F.size(F.filter(F.split(text, f"[{SPACE}]+", -1), lambda w: w != "")).cast("long")
    conv = F.col("conv_id").cast("long")
    hashed = df.filter(F.col("conv_id").isNotNull()).select(
        (conv - conv % settings.group).alias("base"),
        conv.alias("conv_id"),
        F.struct(
            F.col("turn"), role.alias("role"), F.xxhash64(role, text).alias("h1"),
            F.xxhash64(F.lit(20240501), role, text).alias("h2"), words.alias("words"),
        ).alias("turn"),
    )
    plain = F.transform(F.sort_array("turns"), lambda t: t.dropFields("turn", "role"))  # NULL first
    own = hashed.repartition("base").groupBy("base", "conv_id").agg(F.collect_list("turn").alias("turns"))
    own = own.select("base", "conv_id", plain.alias("turns"))
    heads = own.filter("conv_id = base").select(
        F.col("base").alias("_base"), F.slice("turns", 1, max(settings.shared - 1, 1)).alias("_head")
    )
    many = (F.crc32(F.col("conv_id").cast("string")) % settings.shared).cast("int")
    none = F.slice("turns", 1, 0)
    joined = own.join(heads, F.col("base") == F.col("_base"), "left")
    turns = F.concat(
        F.slice(F.coalesce("_head", none), F.lit(1), many),
        F.slice("turns", many + 1, F.greatest(F.size("turns"), F.lit(1))),
    )
    whole = joined.select("conv_id", turns.alias("turns"))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            flat, size = lists.flatten(), np.diff(offsets)
            starts = offsets[:-1] - offsets[0]
            depth = np.arange(len(flat)) - np.repeat(starts, size) + 1
            place = mix(depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            out = []
            for k in range(2):
                turn = np.asarray(flat.field(k)).view(np.uint64)
                upto = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(mix(turn ^ place))])
                out.append(pa.array((upto[1:] ^ np.repeat(upto[starts], size)).view(np.int64)))
            out.append(flat.field(2))
            lengths = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            columns = [pa.ListArray.from_arrays(lengths, x) for x in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size.astype(np.int32)), *columns], ["conv_id", "length", "p1", "p2", "words"]
            )
        give_back()

    schema = "conv_id long, length int, p1 array<long>, p2 array<long>, words array<long>"
    return stored(whole.mapInArrow(prefixes, schema), "conversations")


# --- the z-fast trie --------------------------------------------------------------------------


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the largest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class _Node:
    """Depths ``low + 1`` to ``extent`` of a path."""

    __slots__ = ("low", "extent", "path", "words", "children", "ends")

    def __init__(self, low: int, extent: int, path: list, words: list):
        self.low, self.extent, self.path, self.words = low, extent, path, words
        self.children: dict[tuple, _Node] = {}
        self.ends: list[int] = []


class ZFastTrie:
    """Conversations that share their prefix of depth ``base``.

    A conversation is (id, keys, words): ``keys[d]`` identifies its first d turns and ``words[d - 1]``
    belongs to turn d.
    """

    def __init__(self, base: int = 0):
        self.root = _Node(base, base, [], [])
        self.handles: dict[tuple, _Node] = {}

    def _handle(self, node: _Node) -> tuple:
        return node.path[two_fattest(node.low, node.extent)]

    def locate(self, keys: list) -> _Node:
        """The deepest node that the conversation passes whole, by fat binary search."""
        node, low, high = self.root, self.root.extent, len(keys) - 1
        while low < high:
            depth = two_fattest(low, high)
            found = self.handles.get(keys[depth])
            if found is None:
                high = depth - 1
            elif found.extent < len(keys) and found.path[found.extent] == keys[found.extent]:
                node, low = found, found.extent
            else:
                break  # it leaves or ends within this run
        return node

    def insert_batch(self, conversations: list[tuple]) -> None:
        places = [self.locate(keys) for _, keys, _ in conversations]
        for (conv, keys, words), node in zip(conversations, places):
            self._insert(node, conv, keys, words)

    def _insert(self, node: _Node, conv: int, keys: list, words: list) -> None:
        """From a node it passes whole, down through nodes that this batch has made meanwhile."""
        last = len(keys) - 1
        while node.extent < last:
            child = node.children.get(keys[node.extent + 1])
            if child is None:
                leaf = _Node(node.extent, last, keys, words)
                node.children[keys[node.extent + 1]] = leaf
                self.handles[self._handle(leaf)] = leaf
                leaf.ends.append(conv)
                return
            low, high = child.low + 1, min(child.extent, last)
            while low < high:  # how far the run is shared
                half = (low + high + 1) // 2
                if child.path[half] == keys[half]:
                    low = half
                else:
                    high = half - 1
            node = self._split(node, child, low) if low < child.extent else child
        node.ends.append(conv)

    def _split(self, parent: _Node, child: _Node, depth: int) -> _Node:
        del self.handles[self._handle(child)]
        upper = _Node(child.low, depth, child.path, child.words)
        parent.children[child.path[child.low + 1]] = upper
        child.low = depth
        upper.children[child.path[depth + 1]] = child
        for node in (upper, child):
            self.handles[self._handle(node)] = node
        return upper

    def expand(self) -> Iterator[tuple]:
        """Runs of nodes, children first: (node, least id, members, leaves, saved at each depth, parent)."""
        order, stack = [], [(n, self.root) for n in self.root.children.values()]
        while stack:
            node, parent = stack.pop()
            order.append((node, parent))
            stack.extend((c, node) for c in node.children.values())
        known: dict[int, tuple] = {}
        for node, _ in reversed(order):
            below = [known[id(c)] for c in node.children.values()]
            least = min([*node.ends, *(b[0] for b in below)])
            members = len(node.ends) + sum(b[1] for b in below)
            own = (members - 1) * np.array(node.words[node.low : node.extent][::-1], np.int64)
            saved = (sum(int(b[3][0]) for b in below) + np.cumsum(own))[::-1]
            known[id(node)] = (least, members, sum(b[2] for b in below) or 1, saved)
        for node, parent in order:
            yield node, *known[id(node)], known[id(parent)][0] if parent is not self.root else None


def ends_hash(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest() if ids else NO_ENDS


ROW = (
    "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_ABOVE = "above1 array<long>, above2 array<long>, above_words array<long>"


def _grow(settings: Settings):
    """Rows of (conv_id, cut, p1, p2, words), trie by trie, to rows of nodes."""

    def rows_of(trie: ZFastTrie, cut: int, first: tuple) -> Iterator[tuple]:
        _, keys, words = first
        for node, least, members, leaves, saved, parent in trie.expand():
            for at, depth in enumerate(range(node.low + 1, node.extent + 1)):
                last, top = depth == node.extent, depth == cut
                above = keys[:cut] if top else None
                yield (
                    least, depth, None if top else parent if at == 0 else least, members,
                    len(node.children) if last else 1, leaves, int(saved[at]),
                    ends_hash(node.ends) if last else NO_ENDS,
                    [k[0] for k in above] if top else None, [k[1] for k in above] if top else None,
                    words[: cut - 1] if top else None,
                )

    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), *[pa.list_(pa.int64())] * 3]
    names = [c.split()[0] for c in f"{ROW}, {_ABOVE}".split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, at, first, waiting, out = None, None, None, [], []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for conv, cut, p1, p2, words in zip(*columns):
                keys = [(0, 0), *zip(p1, p2)]
                if (cut, keys[cut]) != at:
                    if trie is not None:
                        trie.insert_batch(waiting)
                        out.extend(rows_of(trie, at[0], first))
                    trie, at, waiting = ZFastTrie(cut - 1), (cut, keys[cut]), []
                    first = (conv, keys, words)
                waiting.append((conv, keys, words))
                if len(waiting) >= settings.batch:
                    trie.insert_batch(waiting)
                    waiting = []
                while len(out) >= 10_000:
                    yield batch_of(out[:10_000])
                    out = out[10_000:]
        if trie is not None:
            trie.insert_batch(waiting)
            out.extend(rows_of(trie, at[0], first))
        for start in range(0, len(out), 10_000):
            yield batch_of(out[start : start + 10_000])
        give_back()

    return run


# --- cutting, and the crown above the cuts ----------------------------------------------------


def _cut(convs: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Conversations with the depth that puts them into a trie, and those that end above any cut."""
    tries, ended, active, depth = [], [], convs, 1
    while True:
        ended.append(active.filter(F.col("length") < depth))
        active = active.filter(F.col("length") >= depth)
        key = [F.element_at("p1", depth), F.element_at("p2", depth)]
        sums = active.groupBy(key[0].alias("_k1"), key[1].alias("_k2")).agg(F.sum("length").alias("_turns"))
        hot = stored(sums.filter(F.col("_turns") > limit).select("_k1", "_k2"), "hot")
        if hot.isEmpty():
            tries.append(active.withColumn("cut", F.lit(depth)))
            break
        same = (key[0] == F.col("_k1")) & (key[1] == F.col("_k2"))
        tries.append(active.join(hot, same, "left_anti").withColumn("cut", F.lit(depth)))
        active = stored(active.join(hot, same, "left_semi"), "active")
        depth *= 2
    for parts in (tries, ended):
        while len(parts) > 1:
            parts.append(parts.pop().unionByName(parts.pop()))
    return tries[0], ended[0]


def _hashes_of_ends(ended: DataFrame, partitions: int) -> DataFrame:
    """(k1, k2, ends_sha256): ids are joined in parallel, range by range, and hashed as a stream."""
    ids = ended.select("k1", "k2", "conv_id")
    order = ["k1", "k2", "conv_id"]
    ids = ids.repartitionByRange(partitions, *order).sortWithinPartitions(*order)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, conv = (np.asarray(batch.column(i)) for i in range(3))
            new = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])) if len(k1) else []
            texts = batch.column(2).cast(pa.string())
            lists = pa.LargeListArray.from_arrays(pa.array([*new, len(k1)], pa.int64()), texts)
            joined = pc.binary_join(lists, ",")
            columns = [pa.array(x[new] if len(k1) else x) for x in (k1, k2, conv)]
            yield pa.RecordBatch.from_arrays([*columns, joined.cast(pa.string())], ["k1", "k2", "first", "joined"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k1, k2, joined in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (k1, k2) != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256(joined.encode())
                else:
                    state.update(b"," + joined.encode())
            yield from rows(done)
        yield from rows([(*key, state.hexdigest())] if key is not None else [])

    def rows(done: list[tuple]) -> Iterator[pa.RecordBatch]:
        if done:
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], ["k1", "k2", "_ends"])

    chunks = ids.mapInArrow(join, "k1 long, k2 long, first long, joined string")
    dealt = chunks.repartition(partitions, "k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return dealt.mapInArrow(digest, "k1 long, k2 long, _ends string")


def _crown(tops: DataFrame, ended: DataFrame, partitions: int) -> DataFrame:
    """Nodes above the cuts, with keys k1 and k2.

    Items are the tries and the groups of equal conversations that end above any cut. ``keys`` and
    ``weights`` of an item have an entry per crown node on its path, from the root; ``inner`` is the depth
    of the last.
    """
    root = F.array(F.struct(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2")))

    def keys(p1: str, p2: str) -> Column:
        return F.arrays_zip(F.col(p1).alias("k1"), F.col(p2).alias("k2"))

    zero = F.array(F.lit(0).cast("long"))
    last = F.element_at("keys", -1)
    trie_items = tops.select(
        F.col("conv_id").alias("m"), F.col("n_convs").alias("n"), F.col("n_leaves").alias("leaves"),
        F.col("saved_tokens").alias("saved"), keys("above1", "above2").alias("keys"),
        F.concat(zero, "above_words").alias("weights"), F.lit(False).alias("ends"),
    )
    path = F.concat(root, F.arrays_zip(F.col("p1").alias("k1"), F.col("p2").alias("k2")))
    ends = ended.withColumns({"keys": path, "weights": F.concat(zero, "words")})
    ends = stored(ends.select("conv_id", "keys", "weights", last["k1"].alias("k1"), last["k2"].alias("k2")), "ends")
    groups = ends.groupBy("k1", "k2").agg(
        F.min("conv_id").alias("m"), F.count("*").alias("n"), F.any_value("keys").alias("keys"), F.any_value("weights").alias("weights")
    )
    end_items = groups.select(
        "m", "n", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), "keys", "weights", F.lit(True).alias("ends")
    )
    items = stored(trie_items.unionByName(end_items), "items")
    at = F.posexplode("keys").alias("depth", "key")
    walk = items.select("m", "n", "keys", "weights", at)
    up = F.when(F.col("depth") > 0, F.get("keys", F.col("depth") - 1))
    walk = walk.select(
        "depth", "key.k1", "key.k2", "m", "n", up["k1"].alias("up1"), up["k2"].alias("up2")
    )
    nodes = walk.groupBy("depth", "k1", "k2").agg(
        F.min("m").alias("conv_id"), F.sum("n").alias("n_convs"), F.any_value("up1").alias("up1"), F.any_value("up2").alias("up2")
    )
    nodes = stored(nodes, "crown")
    # A trie hangs below the last node of its path, as one child.
    below = nodes.filter("depth > 0").select(F.col("up1").alias("_k1"), F.col("up2").alias("_k2"))
    below = below.unionByName(items.filter("NOT ends").select(last["k1"].alias("_k1"), last["k2"].alias("_k2")))
    children = below.groupBy("_k1", "_k2").agg(F.count("*").alias("n_children"))
    own = nodes.groupBy(F.col("conv_id").alias("_m")).agg(F.min("depth").alias("_owned"))
    items = items.withColumns({"k1": last["k1"], "k2": last["k2"]}).join(own, F.col("m") == F.col("_m"), "left")
    items = items.join(children, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & F.col("ends"), "left")
    childless = F.col("ends") & F.col("n_children").isNull()
    items = items.select(
        "n", "saved", "keys", "weights", F.coalesce("_owned", F.size("keys")).alias("_owned"),
        F.when(childless, 1).otherwise(F.col("leaves")).alias("leaves"),
    )

    def words(until: Column) -> Column:
        """Of the path's turns from this depth to before another."""
        part = F.slice("weights", F.col("depth") + 1, F.greatest(until - F.col("depth"), F.lit(0)))
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, b: a + b)

    spread = items.select("n", "saved", "leaves", "weights", "_owned", F.size("keys").alias("_size"), at)
    sums = spread.select(
        F.col("key.k1").alias("_k1"), F.col("key.k2").alias("_k2"), "leaves",
        (F.col("saved") + (F.col("n") - 1) * words(F.col("_size")) + words(F.col("_owned"))).alias("saved"),
    ).groupBy("_k1", "_k2").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    def with_(left: DataFrame, right: DataFrame) -> DataFrame:
        same = (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))
        return left.join(right, same, "left").drop("_k1", "_k2")

    hashes = _hashes_of_ends(ends, partitions).withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
    parents = nodes.select(F.col("k1").alias("_u1"), F.col("k2").alias("_u2"), F.col("conv_id").alias("parent_conv_id"))
    whole = with_(with_(with_(nodes, children), sums), hashes)
    whole = whole.join(parents, (F.col("up1") == F.col("_u1")) & (F.col("up2") == F.col("_u2")), "left")
    return stored(
        whole.select(
            "k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("_ends", F.lit(NO_ENDS)).alias("ends_sha256"),
        ),
        "crown",
    )


def prefix_trie(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per node; ``df`` has conv_id, turn, role and text."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    convs = rebuilt(df, settings)
    turns = convs.agg(F.sum("length")).first()[0] or 0
    limit = max(settings.least_turns, min(settings.trie_turns, turns // (4 * partitions)))
    tries, ended = _cut(convs, limit)
    key = [F.element_at("p1", F.col("cut")), F.element_at("p2", F.col("cut"))]
    dealt = tries.select("conv_id", "cut", "p1", "p2", "words", key[0].alias("b1"), key[1].alias("b2"))
    dealt = dealt.repartition(partitions, "b1", "b2").sortWithinPartitions("b1", "b2")
    grown = stored(dealt.select("conv_id", "cut", "p1", "p2", "words").mapInArrow(_grow(settings), f"{ROW}, {_ABOVE}"), "grown")
    columns = [c.split()[0] for c in ROW.split(", ")]
    tops = grown.filter(F.col("above1").isNotNull())
    crown = _crown(tops, ended, partitions)
    parents = crown.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("conv_id").alias("_parent"))
    up1, up2 = F.element_at("above1", -1), F.element_at("above2", -1)
    placed = tops.join(parents, (up1 == F.col("_k1")) & (up2 == F.col("_k2")))
    placed = placed.withColumn("parent_conv_id", F.col("_parent")).select(*columns)
    inner = grown.filter(F.col("above1").isNull()).select(*columns)
    out = inner.unionByName(placed).unionByName(crown.select(*columns))
    return out.withColumn("depth", F.col("depth").cast("long"))
