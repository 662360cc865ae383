"""Classifiers, packing, archives, mixing, similarity join and the pipeline against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rxlake.llm import jaccard, mixing, packing, quality_fm, toxicity, warc
from rxlake.llm.components import components
from rxlake.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], DOCS)


# --- classifiers -------------------------------------------------------------------------


def test_pairs_in_linear_time_equal_all_pairs():
    rng = np.random.default_rng(1)
    model = quality_fm.Model(0.3, rng.normal(size=20), rng.normal(size=(20, 3)), np.zeros(1), np.ones(1))
    index, value = np.arange(0, 20, 3), rng.normal(size=7)
    got = quality_fm._raw(model, 1, np.zeros(7, int), index, value)[0]
    want = 0.3 + (model.weights[index] * value).sum()
    for a in range(7):
        for b in range(a):
            want += model.factors[index[a]] @ model.factors[index[b]] * value[a] * value[b]
    assert got == pytest.approx(want)


def labelled(spark, n=400):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        text = prose(rnd, rnd.randint(20, 120))
        toxic = i % 5 == 0
        if toxic:
            text += " " + " ".join(rnd.choice(["vile", "rotten", "awful"]) for _ in range(rnd.randint(2, 9)))
        rows.append((i, text if good else " ".join(w + "###" for w in text.split()), "en", "s", None))
        labels.append((i, int(good), int(toxic)))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "s", 0), (n + 1, "", "en", "s", 0)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(
        labels + [(n, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"
    )


def test_quality_of_held_out_rows(spark):
    df, labels = labelled(spark)
    model = quality_fm.fit(df, labels)
    rows = quality_fm.score(df.selectExpr("*", "'x' AS score"), model).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum((r.score >= 0.3) == (r.doc_id % 4 > 0) for r in held) > 0.95 * len(held)
    assert len({r.score for r in rows if r.doc_id >= 400}) == 1
    assert quality_fm.score(df.limit(0), model).count() == 0


def test_quality_without_labels(spark):
    df, labels = labelled(spark, 20)
    model = quality_fm.fit(df, labels.limit(0))
    assert {r.score for r in quality_fm.score(df, model).collect()} == {0.5}


def test_the_sample_is_bounded(spark):
    df, labels = labelled(spark, 60)
    assert quality_fm.training_rows(df, labels, "quality", 10, 1 << 20).count() == 10


def test_the_sample_is_bounded_for_repeated_ids_and_long_texts(spark):
    df, labels = labelled(spark, 60)
    plain = quality_fm.training_rows(df, labels, "quality", 100, 1 << 20).collect()
    copies = df.crossJoin(spark.range(40)).selectExpr("doc_id", "IF(id = 7, text, concat('~', text)) AS text")
    once = quality_fm.training_rows(copies, labels, "quality", 100, 1 << 20).collect()
    assert sorted(once) == sorted(plain)

    sizes = [len(r.text.encode()) for r in plain]
    few = quality_fm.training_rows(df, labels, "quality", 100, 8 * max(sizes)).collect()
    assert 0 < len(few) < len(plain)
    assert sum(len(r.text.encode()) for r in few) <= 8 * max(sizes)

    long = df.selectExpr("doc_id", "IF(doc_id % 2 = 0, repeat('x', 200000), text) AS text")
    rest = quality_fm.training_rows(long, labels, "quality", 100, 1 << 20).collect()
    assert {r.doc_id for r in rest} == {r.doc_id for r in plain if r.doc_id % 2}
    nulls = df.selectExpr("doc_id", "CAST(NULL AS STRING) AS text")
    assert quality_fm.training_rows(nulls, labels, "quality", 100, 1 << 20).count() == len(plain)


def test_severity_follows_the_number_of_marks(spark):
    df, labels = labelled(spark)
    model = toxicity.fit(df, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    rows = {r.doc_id: r for r in toxicity.grade(df.selectExpr("*", "1 AS grade"), model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((rows[i].toxic_probability >= 0.3) == (i % 5 == 0) for i in held) > 0.95 * len(held)
    for r in rows.values():
        assert 0 <= r.severity <= 3 and 0 <= r.grade <= 3
    some, many = toxicity.severity_column(model, pa.array(["vile rotten", "vile rotten awful " * 9])).sum(1)
    assert many > some
    none = toxicity.fit(df, labels.limit(0))
    assert {r.severity for r in toxicity.grade(df, none).collect()} == {0.0}


# --- packing -----------------------------------------------------------------------------

ODD = [
    None, "", " ", "A <|ENDOFTEXT|> b<|endoftext|>. x<|endoftext|>!!",
    "it's IT'S. don't, (foo).. é. É! Ǻ.  x y. 12,5. ... ?! σΣ. ΑΣ. İ. ǅ.", "\x1c a\x1fb.\u0085c.",
    "a" * 5000 + ".", "́.a", "x ́y. ½. ²!",
]


def test_ids_equal_the_tokenizer_on_whole_texts():
    rnd = random.Random(3)
    tokens = packing.WordTokenizer(tokenizer_path())
    texts = ODD + ["".join(rnd.choice("aBé .,!?'1\n<|>") for _ in range(90)) for _ in range(300)]
    for column in (pa.array(texts), pa.array(["x", *texts]).slice(1)):
        ids, ends = tokens.ids(column)
        for row, text in enumerate(texts):
            want = tokens.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert ids[ends[row] : ends[row + 1]].tolist() == want, text


def test_pieces_cover_documents_and_fill_sequences(spark, partitions):
    rnd = random.Random(4)
    texts = ODD + [prose(rnd, rnd.randint(1, 700)) for _ in range(60)] + [prose(rnd, 3000)]
    df = docs(spark, texts).selectExpr("*", "1 AS start", "2 AS length")
    settings = packing.Packing(capacity=256, block_tokens=2000)
    tokens = packing.WordTokenizer(tokenizer_path())
    for got in partitions(lambda n: packing.pack(df.repartition(n), tokenizer_path, settings=settings, with_ids=True).collect(), (1, 3)):
        by_doc, by_sequence = defaultdict(list), defaultdict(list)
        for r in got:
            by_doc[r.doc_id].append((r.start, r))
            by_sequence[r.sequence_id].append((r.offset, r.length, r.sequence_tokens))
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) > 0
        for i, t in enumerate(texts):
            pieces = [r for _, r in sorted(by_doc[i])]
            whole = [x for r in pieces for x in r.ids]
            assert whole == [*tokens.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
            assert all(r.doc_tokens == len(whole) for r in pieces)
            assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])
        for places in by_sequence.values():
            at = 0
            for offset, n, total in sorted(places):
                assert offset == at
                at += n
            assert at == total <= 256 and at & (at - 1) == 0
    assert packing.pack(df.limit(0), tokenizer_path).count() == 0


def test_costs_are_balanced():
    settings = packing.Packing(capacity=100)
    rnd = random.Random(5)
    lengths = np.array([rnd.randint(1, 60) for _ in range(200)])
    bins = int(lengths.sum()) // 100
    pieces, over = packing.assign(lengths, bins, settings)
    used = Counter()
    for _, _, n, b in pieces:
        used[b] += n
    assert all(used[b] == 100 for b in range(bins))
    assert sum(n for _, _, n, _ in pieces) + sum(lengths[i] - s for i, s in over) == lengths.sum()


# --- archives ----------------------------------------------------------------------------


def test_archives_round_trip(spark, tmp_path):
    big, page = "<p>" + "x" * 300_000, "<html>é" + "y" * 200
    rows = [(5, "u5", page), (3, "u3", page), (9, None, page), (1, "u\r\n1", "short"), (2, "u2", "short"), (4, "u4", None), (6, "u6", ""), (7, "u7", big), (8, "u8", big), (3, "u3", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload")
    settings = warc.Bundling(frame_bytes=1000, bundle_bytes=5000)
    index = warc.archive(spark, pages, str(tmp_path / "out"), settings)
    found = warc.read_bundles(index).collect()
    assert len(found) == len(rows)
    html = {}
    for p, _, h in rows:
        html[p] = (h or "").encode()
    for r in found:
        want = html[r.page_id]
        assert r.payload_bytes == len(want)
        first = min(p for p, h in html.items() if h == want)
        revisit = len(want) >= 100 and first != r.page_id
        assert (r.record_type, r.refers_to) == (("revisit", first) if revisit else ("response", None))
        assert r.payload == (None if revisit else want) or bytes(r.payload) == want
    # By seeking, and as plain Zstandard files.
    by_seek = {r.page_id: r for r in warc.fetch(index).collect()}
    assert bytes(by_seek[7].payload) == big.encode() and by_seek[8].refers_to == 7
    import zstandard

    for path in {r.bundle for r in index.collect()}:
        with open(path.removeprefix("file:"), "rb") as f:
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert whole.startswith(b"WARC/1.1\r\n")
    assert warc.archive(spark, pages.limit(0), str(tmp_path / "none")).count() == 0


def test_archives_are_read_by_as_many_tasks_as_there_are_bundles(spark, tmp_path):
    pages = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "repeat(md5(string(id)), 10) AS html")
    index = warc.archive(spark, pages, str(tmp_path / "many"), warc.Bundling(frame_bytes=1000, bundle_bytes=2000))
    bundles = index.select("bundle").distinct().count()
    read = warc.read_bundles(index)
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-bundles // warc.BUNDLES_PER_TASK))
    tasks = [r.n for r in read.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert bundles > 40 and len(tasks) == min(bundles, wanted)
    assert sum(tasks) == 400
    empty = warc.archive(spark, pages.limit(0), str(tmp_path / "empty"))
    assert warc.read_bundles(empty).count() == 0


def test_chances_next_to_one_are_settled_before_the_landing():
    chance = np.array([1 - 2**-53] * 100 + [2**-60] * 100 + [0.5] * 4)
    size = np.arange(1.0, 205)
    end = mixing.land(mixing.fly(chance, size, np.random.default_rng(0)), size)
    assert set(end) <= {0.0, 1.0} and end[:100].all() and not end[100:200].any()


def test_a_damaged_payload_is_noticed():
    row = {"page_id": 1, "url": "u", "payload_bytes": 3, "payload_digest": "0" * 64, "record_type": "response", "refers_to": None, "payload": b"abc"}
    with pytest.raises(ValueError, match="digest"):
        warc.decode_record(warc.encode_record(row), 0)


# --- mixing ------------------------------------------------------------------------------


def plain_targets(sizes, most=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), list(names)
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if share * weight[s] >= most * sizes[s]]
        if not over:
            return target | {s: share * weight[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def test_targets_and_totals(spark, partitions):
    rnd = random.Random(6)
    rows = []
    for source, n in (("a", 30), ("b", 260), ("ä", 80), (None, 60), ("tiny", 2), ("blank", 3)):
        for _ in range(n):
            text = " \n" if source == "blank" else prose(rnd, rnd.randint(1, 60))
            rows.append((len(rows), text, "en", source, None))
    rows += [(len(rows), None, "en", "a", None), (None, "x y", "en", "a", None), (None, "x y", "en", "a", None)]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS size", "2 AS taken")
    mix = mixing.Mix(block=50)

    def run(n):
        return mixing.mix_sources(df.repartition(n, "doc_id"), mix).collect()

    results = partitions(run, (1, 4))
    assert sorted(map(tuple, results[0]), key=str) == sorted(map(tuple, results[1]), key=str)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = plain_targets(sizes)
    taken, got = Counter(), results[0]
    assert len(got) == len(rows)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60
    assert mixing.mix_sources(df.limit(0)).count() == 0
    blank = mixing.mix_sources(docs(spark, ["", None])).collect()
    assert [(r.taken, r.target) for r in blank] == [(0, 0.0)] * 2


def test_equal_rows_do_not_share_one_block(spark, partitions, monkeypatch):
    rnd = random.Random(12)
    rows = [(7, "one two three four", "en", "a" if i % 2 else None, i % 2) for i in range(1600)]
    rows += [(i, prose(rnd, rnd.randint(1, 40)), "en", rnd.choice(["a", None, "b"]), None) for i in range(10, 2410)]
    df = spark.createDataFrame(rows, DOCS)
    flight = mixing._flight

    def small(*settings):
        run = flight(*settings)

        def checked(block):
            assert len(block) <= 200
            return run(block)

        return checked

    monkeypatch.setattr(mixing, "_flight", small)
    mix = mixing.Mix(block=100)
    results = partitions(lambda n: mixing.mix_sources(df.repartition(n), mix).collect(), (1, 4))
    assert sorted(map(tuple, results[0]), key=str) == sorted(map(tuple, results[1]), key=str)
    assert len(results[0]) == len(rows)
    for s in ("a", "b", None):
        own = [r for r in results[0] if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 40


def test_a_flight_keeps_both_totals():
    rng = np.random.default_rng(7)
    size, chance = rng.integers(1, 100, 500).astype(float), rng.random(500)
    end = mixing.fly(chance, size, rng)
    assert ((end > 0) & (end < 1)).sum() <= 2
    assert end.sum() == pytest.approx(chance.sum()) and end @ size == pytest.approx(chance @ size)
    picks = np.mean([mixing.fly(np.full(9, 1 / 3), np.arange(1.0, 10), np.random.default_rng(i)) for i in range(3000)], 0)
    assert np.abs(picks - 1 / 3).max() < 0.04


# --- similarity join ---------------------------------------------------------------------


def plain_components(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        grams = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        sets.append(grams or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))}


def edited(rnd, text, n):
    w = text.split()
    for _ in range(n):
        w[rnd.randrange(len(w))] = "z%d" % rnd.randint(0, 10**6)
    return " ".join(w)


def similar_texts(rnd):
    texts = ["", None, "one", "one", "One TWO", "one two three four"]
    base = [prose(rnd, n) for n in (7, 9, 12, 16, 30, 60, 150, 400)]
    for b in base:  # chains of ever more edits, and copies
        texts += [b, b.upper().lower(), *[edited(rnd, b, k) for k in range(1, 6) for _ in range(4)]]
        texts += [" ".join(b.split()[k:]) for k in range(1, 4)]
    passage = prose(rnd, 55)
    texts += [prose(rnd, 20) + " " + passage + " " + prose(rnd, 20) for _ in range(40)]
    texts += [" ".join(rnd.choice("ab") for _ in range(rnd.randint(5, 11))) for _ in range(80)]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("join", [jaccard.Join(), jaccard.Join(most_light=0, block=4, partners_first=1, count_least=2, more=10)])
def test_groups_against_all_pairs(spark, join):
    rnd = random.Random(8)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(similar_texts(rnd))]
    want = plain_components(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_shingles", "2 AS set_id")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df.repartition(4), join=join).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(rows) - 60


def test_partners_of_a_head_are_dealt_by_their_number(spark):
    pairs = spark.range(10_000).selectExpr("IF(id < 9000, 1, id) AS a", "id AS b")
    salted = jaccard._salted(pairs, jaccard.Join())
    per_task = salted.groupBy("a", "salt").agg(F.count("*").alias("n"))
    assert salted.count() == 10_000 and salted.filter("a <> 1 AND salt <> 0").count() == 0
    assert per_task.agg(F.max("n")).first()[0] < 3 * 64 and per_task.filter("a = 1").count() == -(-9000 // 64)


def test_filter_follows_the_number_of_candidates(spark):
    join = jaccard.Join()
    assert [jaccard._filter_size(n, join) for n in (0, 10, 1 << 21, 1 << 22, 1 << 40)] == [
        1 << 24, 1 << 24, 1 << 24, 1 << 25, 1 << 28,
    ]


def test_groups_of_odd_rows(spark):
    schema = "doc_id long, text string"
    assert jaccard.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (2, None), (1, " "), (9, "A B C D E F")]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(
        [(None, 4), (4, 4), (4, 4), (2, 2), (1, 1), (9, 4)], key=str
    )


def test_components_against_a_search(spark):
    rnd = random.Random(9)
    edges = [(rnd.randint(-90, 90), rnd.randint(-90, 90)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        if len(seen) > 1:
            assert got[start] == min(seen)


# --- pipeline ----------------------------------------------------------------------------


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    df, labels = labelled(spark, 120)
    copy = df.filter("doc_id = 1").selectExpr("1000L AS doc_id", "concat(text, ' mail a@b.cd') AS text", "lang", "source", "n_chars")
    df = df.unionByName(copy).unionByName(df.filter("doc_id IN (2, 3)"))
    df = df.withColumn("text", df.text)
    folder = str(tmp_path)
    df.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "pii", "mixing", "packing"]
    data = spark.read.parquet(f"{folder}/documents.parquet")
    good = stages["quality"](spark, data, folder)
    assert good.columns == corpus_pipeline.COLUMNS
    kept = {r.doc_id for r in good.collect()}
    assert {i for i in range(120) if i % 4} <= kept and len([i for i in range(120) if i % 4 == 0 and i in kept]) <= 2
    once = stages["near_duplicates"](spark, data, folder)
    ids = Counter(r.doc_id for r in once.collect())
    assert 1000 not in ids and ids[1] == 1 and ids[2] == 1 and len(ids) == 122
    clean = stages["pii"](spark, data, folder).filter("doc_id = 1000").first()
    assert clean.text.endswith("[EMAIL]") and clean.n_chars == len(clean.text)
    mixed = stages["mixing"](spark, data, folder)
    assert mixed.columns == corpus_pipeline.COLUMNS and mixed.count() > 0
    packed = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "start", "length", "sequence_id"} <= set(packed.columns) and packed.count() > 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, data.limit(0), folder).count() == 0, name


def test_near_duplicates_are_told_by_id_and_text(spark):
    rnd = random.Random(13)
    a, b, c, d = (prose(rnd, 80) for _ in range(4))
    rows = [
        (1, a), (5, a + " end"), (5, b), (5, b), (3, c), (3, c + " end"), (None, d), (None, d + " end"), (None, d),
        (None, a + " tail"), (8, None), (8, None), (None, " "), (None, " "),
    ]
    passage = prose(rnd, 9)  # frequent n-grams, in documents that are no copies
    rows += [(i, f"{prose(rnd, 60)} {passage}") for i in range(100, 200)]
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)
    got = [(r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df.repartition(3), "").collect()]
    assert sum((i or 0) >= 100 for i, _ in got) == 100
    got = [(i, t) for i, t in got if (i or 0) < 100]
    third = [t for i, t in got if i == 3]
    last = [t for i, t in got if i is None and t.strip()]
    assert len(third) == 1 and third[0].startswith(c) and len(last) == 1 and last[0].startswith(d)
    rest = [(i, t) for i, t in got if i != 3 and not (i is None and t.strip())]
    assert sorted(rest, key=str) == sorted([(1, a), (5, b), (8, None), (None, " "), (None, " ")], key=str)
