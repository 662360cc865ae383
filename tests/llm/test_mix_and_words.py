"""The mixing stage on repeated rows, and the word tokenizer's memory."""

import random
from collections import Counter

import pyarrow as pa

import corpus_pipeline
from rxlake.llm import mixing, packing
from rxlake.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_mix_keeps_all_copies_of_equal_rows(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(1, 60), "en", rng.choice("abc"), 1) for i in range(300)]
    rows += [(None, None, "en", "a", 0)] * 1_500 + [(9_000, "", "fr", None, 0)] * 40 + [(None, "x y", "en", "b", 3)] * 7
    df = spark.createDataFrame(rows, DOCS).repartition(6)
    got = corpus_pipeline.mix(spark, df, "").collect()
    wanted = mixing.mix_sources(df, keep=["doc_id", "text", "source"]).filter("copies > 0").collect()
    many = Counter()
    for r in wanted:
        many[r.doc_id, r.text, r.source] += r.copies
    assert Counter((r.doc_id, r.text, r.source) for r in got) == many
    assert {c for r in got for c in [(r.doc_id, r.text, r.lang, r.source, r.n_chars)]} <= set(rows)
    assert corpus_pipeline.mix(spark, spark.createDataFrame([], DOCS), "").count() == 0


def test_words_are_forgotten_by_use_and_ids_stay_right():
    rng = random.Random(6)
    odd = ["it's", "İstanbul", "ßẞ", "ǆungla", "éa", "́a", "ﬁne", "x1y", "a,b.", "日本語", "ой!", "<|endoftext|>", "a<|b", "\x85nel", "ªº", "ⓐ"]
    words = [*odd, *("".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 9))) for _ in range(400))]
    tokens = packing.WordTokenizer(tokenizer_path(), remembered=60, together=7)
    for _ in range(12):
        texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 80))) for _ in range(9)] + [None, "", " "]
        ids, ends = tokens.ids(pa.array(texts))
        for at, text in enumerate(texts):
            assert ids[ends[at] : ends[at + 1]].tolist() == tokens.tokenizer.encode(text or "", add_special_tokens=False).ids
        frequent = tokens.ids(pa.array(["the of and"] * 2))
        assert len(frequent[0]) == 6
    kept = tokens.words.to_pylist()
    assert "the" in kept and len(kept) == len(set(kept)) < 60 + 400
    assert len(kept) == len(tokens.ends) - 1 == len(tokens.uses) and tokens.ends[-1] == len(tokens.flat)
