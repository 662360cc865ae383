"""The filter audit against a plain version that looks at every document in every order."""

import itertools
import random
import re

import pytest

from rxlake.llm import filter_audit

DOCS = "doc_id long, text string, lang string, source string, mask string"
LABELS = "doc_id long, quality int, toxic int"
SMALL = filter_audit.Ranges(chunk_bytes=3_000, range_bytes=1_000)


def plain(rows, labels):
    first, marks = {}, {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, quality, toxic in labels:
        good, bad = marks.get(i, (False, False))
        marks[i] = (good or quality == 1, bad or toxic == 1)
    out = {}
    for i, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and first[text] < i,
        }
        good, bad = marks.get(i, (False, False)) if i is not None else (False, False)
        orders = list(itertools.permutations("ABCDE"))
        removed_by = {f: 0 for f in "ABCDE"}
        for order in orders:
            for f in order:
                if fails[f]:
                    removed_by[f] += 1
                    break
        for order in orders:
            gone = False
            for step, f in enumerate(order, 1):
                row = out.setdefault((lang or "", "".join(order), step), [0] * 7)
                hit = fails[f] and not gone
                row[2] += fails[f] and gone
                gone = gone or fails[f]
                row[0] += not gone
                row[1] += hit
                row[3] += fails[f] and sum(fails.values()) == 1
                row[4] += hit and good
                row[5] += hit and bad
                row[6] += removed_by[f]
    return out


def found(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma", "é", "😀", "delta#", "EPS", "zeta", "eta"] + [f"w{i}" for i in range(300)]
    long = " ".join(rng.choice(vocabulary) for _ in range(30_000))
    head = " ".join(rng.choice(vocabulary) for _ in range(400))
    texts = [None, "", " ", "a", "a", "ab", "abc", long, long, long + "x", long[:-1], "\x0b\x1f", "\x85\xa0 "]
    texts += [head + f" tail {i % 7}" for i in range(40)] + ["one hot text"] * 60
    texts += [" ".join(rng.choice(vocabulary[9:]) for _ in range(rng.randrange(150, 260))) for _ in range(20)]
    rng.shuffle(texts)
    made = [(i, t, rng.choice(["en", "fr", None]), "s", "extra") for i, t in enumerate(texts)]
    made += [(None, "one hot text", "en", "s", "x"), (None, "nobody's", "en", "s", "x"), (5, "twice", "en", "s", "x"), (5, "twice", "fr", "s", "x")]
    rng.shuffle(made)
    return made


def test_all_orders_as_a_plain_version(spark, rows, partitions):
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 100, 3)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9, None, None)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    marks = spark.createDataFrame(labels, LABELS)
    expected = plain(rows, labels)

    def run(n):
        df = spark.createDataFrame(rows, DOCS).repartition(n)
        return found(filter_audit.audit(df, marks, ranges=SMALL))

    for result in partitions(run):
        assert result == expected


def test_text_ids_and_empty_table(spark, rows):
    keyed = spark.createDataFrame([(f"k{r[0]:03}" if r[0] is not None else None, *r[1:]) for r in rows], DOCS.replace("doc_id long", "doc_id string"))
    assert {r.doc_id for r in filter_audit.masks(keyed, ranges=SMALL).filter("mask >= 16").collect()} == {
        f"k{r.doc_id:03}" for r in filter_audit.masks(spark.createDataFrame(rows, DOCS)).filter("mask >= 16").collect()
    }
    none = spark.createDataFrame([], DOCS)
    assert filter_audit.audit(none, spark.createDataFrame([], LABELS)).count() == 0


def test_trie_splits_labels_inside_characters():
    trie = filter_audit.RadixTrie()
    assert trie.insert("é1".encode(), (4, "a")) == []
    assert trie.insert("è".encode(), (3, "b")) == []
    assert trie.insert("é1".encode(), (2, "c")) == [(4, "a")]
    assert trie.insert("é1".encode(), (2, "d")) == []
    assert trie.insert("é1".encode(), (7, "e")) == [(7, "e")]
    assert trie.insert("é".encode(), (9, "f")) == trie.insert(b"", (1, "g")) == []
    assert sorted(trie.first()) == [(1, "g"), (2, "c"), (2, "d"), (3, "b"), (9, "f")]


def test_hot_text_is_sent_once_per_chunk_and_deep_prefixes_part(spark):
    head = "the same first page " * 300
    rows = [(i, "hot" if i % 3 == 0 else f"{head}{i}", "en", "s", "") for i in range(600)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    borders = filter_audit._borders(df.select("text"), 4, filter_audit.Ranges(range_bytes=100_000))
    assert len(borders) > 10 and max(map(len, borders)) > len(head)
    copies = filter_audit.masks(df).filter("mask >= 16").count()
    assert copies == 199
