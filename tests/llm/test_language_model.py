"""The language model against plain counts, a plain softmax and finite differences."""

import math
import random
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from rxlake.llm import language_model
from rxlake.llm.language_model import Settings

DOCS = "doc_id long, text string, lang string, n_tokens string"
SMALL = Settings(classes=40, lookup=60, dimensions=6, noise=12, batch=64, block_tokens=500, task_tokens=4_000)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower(text)), None]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(150)] + ["É", "é", "Ab", "aB", "😀"]
    texts = [None, "", " \x0b\n", "A a", "unseen-elsewhere", "\x85 \x1f"]
    for _ in range(120):  # words follow each other by a rule, as in a language
        at, text = rng.randrange(len(vocabulary)), []
        for _ in range(rng.randrange(1, 120)):
            at = (at * 7 + 3) % len(vocabulary) if rng.random() < 0.8 else min(int(rng.expovariate(0.05)), 154)
            text.append(vocabulary[at])
        texts.append(" ".join(text))
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(5_000)))
    made = [(i, t, "en", "x") for i, t in enumerate(texts)]
    return made + [(7, texts[7], "en", "x"), (7, "another of its id", "en", "x"), (None, "no id", "en", "x")]


def plain_base(rows):
    count = Counter(t for i, text, *_ in rows if not is_held_out(i) for t in tokens_of(text))
    n, v = sum(count.values()), len(count)
    out = []
    for i, text, *_ in rows:
        tokens = tokens_of(text)
        base = sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((i, is_held_out(i), len(tokens), sum(count[t] > 0 for t in tokens), n, round(base, 6)))
    return sorted(out, key=str)


def test_base_scores_as_plain_counts(spark, rows, partitions):
    def run(n):
        df = spark.createDataFrame(rows, DOCS).repartition(n)
        got = language_model.score(df, settings=SMALL).collect()
        assert all(r.score < 0 for r in got)
        return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str)

    for result in partitions(run, (1, 5)):
        assert result == plain_base(rows)


def test_scores_as_a_plain_softmax_and_better_than_the_base(spark, rows):
    df = spark.createDataFrame(rows, DOCS)
    docs = df.select("doc_id", "text", language_model.held_out(df.doc_id).alias("held_out"))
    known = language_model.vocabulary(language_model.count_words(docs.filter("NOT held_out").select("text")), SMALL)
    assert known.classes == 40 and 40 < len(known.key) <= 60
    model = language_model.train(language_model.encode(docs, known), known, SMALL)
    count = Counter(t for i, text, *_ in rows if not is_held_out(i) for t in tokens_of(text))
    # Classes by falling count; which of equal ones is first is up to their hash, so read it off the encoding.
    word_class = {None: 0}
    for r in language_model.encode(df.selectExpr("doc_id", "text", "false AS held_out"), known).collect():
        text = next(t for i, t, *_ in rows if (i, len(tokens_of(t))) == (r.doc_id, r.n_tokens))
        for t, c in zip(tokens_of(text), np.frombuffer(bytes(r.classes), np.uint16)):
            assert word_class.setdefault(t, int(c)) == c
    assert sorted(c for c in word_class.values() if c < 40) == list(range(40))
    top = {t for t, c in word_class.items() if c < 40}
    rest = sum(n for t, n in count.items() if t not in top) + 0.1 * (len(count) - len(top) + 1)
    expected, base = {}, {}
    for i, text, *_ in rows:
        before, total = [41, 41], 0.0
        for t in tokens_of(text):
            c = word_class[t]
            vector = model.words[before[0]] * model.places[0] + model.words[before[1]] * model.places[1]
            score = (model.classes @ vector + model.bias + model.frequency).astype(float)
            p = np.exp(score - score.max())
            total += math.log10(p[c] / p.sum())
            if c == 40:
                total += math.log10((count[t] + 0.1) / rest)
            before = [c, before[0]]
        expected.setdefault(i, []).append(total)
    got = {}
    for r in language_model.score(df, settings=SMALL).collect():
        got.setdefault(r.doc_id, []).append(r.score)
        base.setdefault(r.held_out, []).append((r.base_score, r.score, r.n_tokens))
    for i, scores in expected.items():
        assert sorted(got[i]) == pytest.approx(sorted(scores), rel=1e-4)
    held = np.array(base[True])
    assert held[:, 1].sum() > held[:, 0].sum() + 0.05 * held[:, 2].sum()


def _random_model(seed=1):
    rng = np.random.default_rng(seed)
    known = language_model.Vocabulary(np.arange(9, dtype=np.uint64), np.arange(9), rng.integers(1, 50, 9), 400, 9, 8)
    return language_model.start(known, Settings(dimensions=5)), rng


def test_probabilities_add_up_to_one():
    model, rng = _random_model()
    before = rng.integers(0, 10, (30, 2))
    whole = sum(np.exp(model.log_probabilities(before, np.full(30, c), rows=7)) for c in range(9))
    assert whole == pytest.approx(np.ones(30), abs=1e-5)


def test_gradients_as_finite_differences():
    model, rng = _random_model()
    for p in ("words", "places", "classes", "bias"):
        setattr(model, p, getattr(model, p).astype(np.float64) + rng.normal(0, 0.3, getattr(model, p).shape))
    before, token, noise = rng.integers(0, 10, (6, 2)), rng.integers(0, 9, 6), rng.integers(0, 9, 4)
    steps = language_model.gradients(model, before, token, noise)
    for parameter, step in zip(model.parameters(), steps):
        for at in list(np.ndindex(parameter.shape))[::3]:
            old = parameter[at]
            parameter[at] = old + 1e-5
            high = language_model.likelihood(model, before, token, noise)
            parameter[at] = old - 1e-5
            low = language_model.likelihood(model, before, token, noise)
            parameter[at] = old
            assert step[at] == pytest.approx((high - low) / 2e-5, rel=1e-3, abs=1e-4)


def test_empty_table_and_nothing_to_learn_from(spark):
    assert language_model.score(spark.createDataFrame([], DOCS), settings=SMALL).count() == 0
    ids = [i for i in range(200) if is_held_out(i)][:3]
    got = language_model.score(spark.createDataFrame([(i, "never seen", "en", "x") for i in ids], DOCS), settings=SMALL).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(True, 3, 0, 0)] * 3
    assert all(r.base_score == pytest.approx(0.0) and r.score < 0 for r in got)


def test_learning_does_not_depend_on_the_size_of_a_task(spark, rows):
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    docs = df.select("doc_id", "text", language_model.held_out(df.doc_id).alias("held_out"))
    known = language_model.vocabulary(language_model.count_words(docs.filter("NOT held_out").select("text")), SMALL)
    encoded = language_model.encode(docs, known)
    few, many = (language_model.train(encoded, known, replace(SMALL, task_tokens=n)) for n in (4_000, 1 << 20))
    for a, b in zip(few.parameters(), many.parameters()):
        assert np.array_equal(a, b)


def test_distinct_keys_with_and_without_room():
    key = np.random.default_rng(4).integers(0, 300, 1_000)
    for many in (300, 1 << 40):
        first, which = language_model._distinct(key, many)
        assert len(first) == len(set(key)) and np.array_equal(key[first][which], key)
