"""The conversation trie against a plain version that holds every prefix as a tuple."""

import hashlib
import random
import re
import zlib

import pytest

from rxlake.llm import conversation_trie
from rxlake.llm.conversation_trie import Settings, ZFastTrie

CONVERSATIONS = "conv_id long, turn long, role string, text string, p1 string"
TINY = Settings(trie_turns=6, least_turns=1, batch=3)


def plain(rows):
    turns = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    full = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = (*own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h], *ts[h:])
    members = {}
    for c, path in full.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = {}
    for path, own_members in members.items():
        below = [p for p in members if p[: len(path)] == path]
        parents = {p[:-1] for p in members if p}
        ends = ",".join(map(str, sorted(c for c in own_members if len(full[c]) == len(path))))
        out[min(own_members), len(path)] = (
            min(members[path[:-1]]) if path else None,
            len(own_members),
            sum(p[:-1] == path for p in members if p),
            sum(p not in parents for p in below),
            sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p),
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return out


def found(df):
    got = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(out) == len(got)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = []
    for c in range(0, 130):
        if c == 60:
            continue  # a group without its first conversation
        many = rng.choice([1, 1, 2, 3, 4, 5, 9])
        turns = [("user", "hot  first\x1f turn")] if c % 3 else [("user", f"start {rng.randrange(3)}")]
        turns += [(rng.choice(["user", "bot", None]), rng.choice(["a", "b c", None, " ", "d\x0be"])) for _ in range(many)]
        if 90 <= c < 110:
            turns = [("user", f"copied {i}") for i in range(12)]  # equal but for the ids
        made += [(c, i, r, t, "x") for i, (r, t) in enumerate(turns)]
    made += [(200, i, "u", f"long {i % 5}", "x") for i in range(300)] + [(201, i, "u", f"long {i % 5}", "x") for i in range(257)]
    made += [(3001, None, "u", "no turn number", "x"), (3001, 0, "u", "after", "x"), (None, 1, "u", "nobody", "x")]
    made += [(-7, 1, "u", "below zero", "x"), (-20, 1, "u", "its first", "x"), (400, 5, "u", "same", "x"), (400, 5, "u", "same", "x")]
    rng.shuffle(made)
    return made


@pytest.mark.parametrize("settings", [Settings(), TINY, Settings(trie_turns=60, least_turns=1, batch=7)])
def test_nodes_as_a_plain_version(spark, rows, settings):
    df = spark.createDataFrame(rows, CONVERSATIONS)
    assert found(conversation_trie.prefix_trie(df, settings)) == plain(rows)


def test_any_partitioning_and_an_empty_table(spark, rows, partitions):
    df = spark.createDataFrame(rows, CONVERSATIONS)
    one, three, _ = partitions(lambda n: found(conversation_trie.prefix_trie(df.repartition(n), TINY)))
    assert one == three
    assert conversation_trie.prefix_trie(spark.createDataFrame([], CONVERSATIONS)).count() == 0


def test_locate_finds_the_deepest_whole_node():
    rng = random.Random(8)
    paths = [tuple(rng.choice("ab") for _ in range(rng.randrange(0, 70))) for _ in range(300)]
    paths += [p + q for p, q in zip(paths[:100], paths[100:200])]
    trie = ZFastTrie()
    conversations = [(i, [p[:d] for d in range(len(p) + 1)], [1] * len(p)) for i, p in enumerate(paths)]
    for at in range(0, len(paths), 37):
        trie.insert_batch(conversations[at : at + 37])
    seen = set(paths)
    inner = {p[:d] for p in paths for d in range(len(p) + 1)}
    ends = {tuple(n.path[n.extent]) if n.path else () for n in [trie.root, *trie.handles.values()]}
    wanted = {p for p in inner if p in seen or sum(p + (x,) in inner for x in "ab") == 2} | {()}
    assert ends == wanted
    for node in trie.handles.values():
        depth = conversation_trie.two_fattest(node.low, node.extent)
        assert node.low < depth <= node.extent and trie.handles[node.path[depth]] is node
    for _, keys, _ in conversations:
        deepest = max((k for k in keys if k in ends), key=len)
        node = trie.locate(keys)
        assert (tuple(node.path[node.extent]) if node.path else ()) in (deepest, *[k for k in keys if k in ends])
    reached = sum((trie.locate(k).path or [()])[trie.locate(k).extent if trie.locate(k).path else 0] == max((x for x in k if x in ends), key=len) for _, k, _ in conversations)
    assert reached > 0.9 * len(conversations)  # else the last step is one look at the children


def test_ids_of_a_large_group_are_hashed_in_order(spark):
    rows = [(i * 20, 0, "u", "the same", "x") for i in range(3_000)]
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(5)
    got = found(conversation_trie.prefix_trie(df, Settings(trie_turns=10, least_turns=1)))
    ids = ",".join(str(20 * i) for i in range(3_000))
    assert got[0, 1] == (0, 3_000, 0, 1, 2_999 * 2, hashlib.sha256(ids.encode()).hexdigest())
