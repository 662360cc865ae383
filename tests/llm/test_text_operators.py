"""Personal data, fingerprints, sentence spans and quality counts against plain versions."""

import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rxlake.llm import pii, quality_rules, span_dedup, winnowing, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, **more):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def test_words_and_hashes_of_any_text():
    texts = ["a b\tc\n\n d", None, "", " \x0b ", "é😀 x" * 50, "w" * 3_000_000 + " end", "a b\tc\n\n d"]
    by_word = {}
    for chunk in words.chunks(pa.array(texts)):
        hashes = chunk.hashes()
        for row in range(chunk.rows):
            a, b = chunk.word_offsets[row : row + 2]
            found = [bytes(chunk.data[s:e]).decode() for s, e in zip(chunk.starts[a:b], chunk.ends[a:b])]
            assert found == re.findall(r"[^\x20\x09-\x0D]+", texts[chunk.first + row] or "")
            for w, h in zip(found, hashes[a:b]):
                assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


# --- personal data -----------------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m)

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) < 256 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    found = [
        (m.start(), k, f"{name}:{m.start()}:{m.end()}")
        for k, (name, pattern, ok) in enumerate(kinds)
        for m in re.finditer(pattern, text or "")
        if ok(m.group())
    ]
    return ",".join(x[2] for x in sorted(found))


def test_base_spans_equal_the_plain_patterns(spark):
    rnd = random.Random(1)
    texts = [None, "", "a@b.c%d@e.f g@h@i.j.k", "1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.4", "😀 4539 1488 0343 6467 x"]
    texts += ["".join(rnd.choice("a1@.+- 0é😀()9\n%25") for _ in range(rnd.randint(0, 80))) for _ in range(1500)]
    found = {r.doc_id: r for r in pii.digest(pii.find_pii(docs(spark, texts))).collect()}
    for i, t in enumerate(texts):
        spans = plain_spans(t)
        assert found[i].base_sha256 == hashlib.sha256(spans.encode()).hexdigest(), (t, found[i])
        assert found[i].n_email == spans.count("email:")


def test_long_runs_stay_linear_and_do_not_overflow(spark):
    texts = ["a" * 200_000 + "@", "1 2" * 50_000, "b@" + "c." * 50_000 + "d", "+1" + "(" * 100_000]
    found = pii.digest(pii.find_pii(docs(spark, texts))).orderBy("doc_id").collect()
    assert [r.n_email for r in found] == [0, 0, 1, 0]


def test_checksums_and_context_decide(spark):
    texts = [
        "IBAN DE89370400440532013000", "DE89370400440532013001", "my ssn is 123-45-6789", "part 123-45-6789",
        "social security 000-45-6789",
    ]
    found = pii.digest(pii.find_pii(docs(spark, texts))).orderBy("doc_id").collect()
    assert [r.spans for r in found] == ["iban:5:27", "", "ssn:10:21", "", ""]


def test_account_numbers_end_before_what_follows(spark):
    gb, de = "GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00"
    cases = [
        (f"{gb} 2024", [gb]), (f"{gb} I", [gb]), (f"é {gb} BY 2024 OK.", [gb]), (f"{gb} {de}", [gb, de]),
        (f"AB13 {gb} {de} X 9", [gb, de]), (f"{gb}", [gb]), (f"{gb}, {de}7", [gb]), ("GB82 WEST 1234 5698 7654 33 2024", []),
        (f"{gb.replace(' ', '')} 12 {de.replace(' ', '')} A1", [gb.replace(" ", ""), de.replace(" ", "")]), (None, []),
    ]
    found = {r.doc_id: r.pii_spans for r in pii.find_pii(docs(spark, [t for t, _ in cases])).collect()}
    for i, (text, want) in enumerate(cases):
        assert [text[s.start : s.end] for s in found[i] if s.kind == "iban"] == want
    clean = pii.redact(docs(spark, [f"to {gb} 2024 from {de} I"])).first()
    assert clean.text == "to [IBAN] 2024 from [IBAN] I"


def test_redaction_keeps_the_rest_and_clashing_columns_go(spark):
    df = docs(spark, ["é a@b.cd x", None, "clean"]).selectExpr("*", "1 AS pii_spans")
    assert [r.text for r in pii.redact(df).orderBy("doc_id").collect()] == ["é [EMAIL] x", None, "clean"]
    assert dict(pii.find_pii(df).dtypes)["pii_spans"].startswith("array")
    assert pii.digest(pii.find_pii(df.limit(0))).count() == 0


def test_spans_over_many_batches_equal_the_plain_patterns(spark):
    rnd = random.Random(7)
    bits = ["a@b.cd", "1.2.3.4", "1.2.3.400", "+1 (555) 123-4567", "4539 1488 0343 6467", "my ssn is 123-45-6789", "é😀 " * 300, "x\n"]
    text = " , ".join(rnd.choice(bits) for _ in range(4 * pii.SCAN_BATCH))
    df = docs(spark, [text, "a@b.cd", text[: pii.CHUNK_CHARS], None])
    found = {r.doc_id: r for r in pii.find_pii(df).collect()}
    digest = {r.doc_id: r.base_sha256 for r in pii.digest(pii.find_pii(df)).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    for i, t in enumerate([text, "a@b.cd", text[: pii.CHUNK_CHARS], None]):
        assert digest[i] == hashlib.sha256(plain_spans(t).encode()).hexdigest()
        at, want = 0, []
        for s in found[i].pii_spans:
            if s.start >= at:
                want += [t[at : s.start], f"[{s.kind.upper()}]"]
            at = max(at, s.end)
        assert clean[i] == (None if t is None else "".join(want) + t[at:])
    assert sum(s.kind == "ssn" for s in found[0].pii_spans) == text.count("123-45-6789")


def test_a_hundred_thousand_spans_in_one_text(spark):
    text = "login 10.0.0.1 ssn 123-45-6789 é " * 50_000
    df = docs(spark, [text])
    began = time.monotonic()
    row = pii.digest(pii.find_pii(df)).first()
    clean = pii.redact(df).first().text
    assert row.n_ip == 50_000 and row.spans.count("ssn:") == 50_000
    assert clean == "login [IP] ssn [SSN] é " * 50_000
    assert time.monotonic() - began < 60


# --- fingerprints ------------------------------------------------------------------------


def test_choice_is_the_rightmost_least_of_each_window():
    rnd = random.Random(2)
    for _ in range(300):
        hashes = np.array([rnd.randint(0, 6) for _ in range(rnd.randint(0, 40))], np.uint64)
        window = rnd.randint(1, 12)
        w = min(window, len(hashes))
        want = set()
        for i in range(len(hashes) - w + 1 if w else 0):
            part = hashes[i : i + w]
            want.add(i + max(j for j in range(w) if part[j] == part.min()))
        assert sorted(want) == winnowing.choose(hashes, window).tolist()


def test_a_shared_passage_is_always_found():
    rnd = random.Random(3)
    s = winnowing.Winnowing()
    for _ in range(50):
        passage = "".join(rnd.choice("abc ") for _ in range(s.gram + s.window - 1))
        a = "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 90))) + passage + "tail" * 9
        b = "q" * rnd.randint(0, 90) + passage
        assert set(winnowing.winnow(a)[0].tolist()) & set(winnowing.winnow(b)[0].tolist())


def test_neighbours_against_plain_python(spark, partitions):
    rnd = random.Random(4)
    texts = [None, "", "ab", "é😀" * 40] + ["".join(rnd.choice("abcd é") for _ in range(rnd.randint(0, 300))) for _ in range(60)]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for got in partitions(lambda n: winnowing.compare_neighbours(df).collect(), (1, 5)):
        found = {r.doc_id: r for r in got}
        assert len(got) == len(rows)
        for k, (i, t) in enumerate(rows):
            t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
            cut = len(t) // 4
            edited = t[: len(t) - cut] + following[:cut]
            fp, other, after = (winnowing.winnow(x) for x in (t, edited, following))
            r = found[i]
            assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.fingerprint == winnowing.digest(*fp) and r.edited_fingerprint == winnowing.digest(*other)
            assert r.near_edited == winnowing.likeness(fp[0], other[0])
            assert r.near_next == winnowing.likeness(fp[0], after[0])


def test_neighbours_of_odd_ids(spark):
    schema = "doc_id long, text string"
    assert winnowing.compare_neighbours(spark.createDataFrame([], schema)).count() == 0
    one = winnowing.compare_neighbours(spark.createDataFrame([(5, "x" * 100)], schema)).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(5, 1.0)]
    same = [(None, "a" * 50), (None, "b" * 50), (7, "c" * 50), (7, "c" * 50), (9, None)]
    assert winnowing.compare_neighbours(spark.createDataFrame(same, schema)).count() == 5


def test_rows_of_one_id_fall_in_many_slices(spark):
    rows = [(7 if i % 4 else i, f"text {i} " + "z" * (i % 50)) for i in range(4000)] + [(7, "same")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    placed = winnowing._in_order(df, 16).withColumn("task", F.spark_partition_id())
    per_task = [r["n"] for r in placed.groupBy("task").agg(F.count("*").alias("n")).collect()]
    assert len(per_task) == 16 and max(per_task) < 3 * len(rows) / 16  # two shares may meet
    assert sum(per_task) <= len(rows) + 3 * 16


def test_equal_ids_follow_one_another_by_hash(spark, partitions):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, 7, 7, 9, i]), "".join(rnd.choice("abcd ") for _ in range(rnd.randint(0, 90)))) for i in range(60)]
    rows += [(7, "the same text")] * 5 + [(9, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = df.withColumn("h", F.xxhash64("text")).collect()
    order = sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    want = []
    for r, after in zip(order, order[1:] + order[:1]):
        text, following = r.text or "", after.text or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        near = winnowing.likeness(winnowing.winnow(text)[0], winnowing.winnow(following)[0])
        want.append((str(r.doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(), near))

    for found in partitions(lambda n: winnowing.compare_neighbours(df.repartition(n)).collect()):
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.near_next) for r in found) == sorted(want)


def test_fingerprint_columns(spark):
    df = docs(spark, ["x" * 100, None]).selectExpr("*", "'old' AS fp_hashes")
    rows = winnowing.fingerprints(df).orderBy("doc_id").collect()
    assert rows[0].fp_positions and rows[1].fp_hashes == []


# --- sentence spans ----------------------------------------------------------------------


def plain_removed(texts, spans):
    """Removed sentences per document, by the definition; texts have no long sentences."""
    cut = [[s for s in re.findall(r"[^.\n]*[.\n]?", t or "") if s.split()] for t in texts]
    seen, gone = {}, [set() for _ in texts]
    for d, sentences in enumerate(cut):
        counts = [len(s.split()) for s in sentences]
        runs = set()
        for i in range(len(sentences)):
            ends = [e for e in range(i + spans.run, len(sentences) + 1) if sum(counts[i:e]) >= spans.least_words]
            starts = [b for b in range(i + 2 - spans.run) if sum(counts[b : i + 1]) >= spans.least_words]
            if ends:
                runs.add((i, ends[0]))
            if starts:
                runs.add((starts[-1], i + 1))
        for a, b in runs:
            key = tuple(tuple(s.lower().split()) for s in sentences[a:b])
            seen.setdefault(key, []).append((d, a, b))
    for places in seen.values():
        for d, a, b in sorted(places)[1:]:
            gone[d] |= set(range(a, b))
    return cut, gone


def test_spans_against_plain_python(spark, partitions):
    rnd = random.Random(5)
    pool = [" ".join(rnd.choice("ab cd ef gh ij".split()) for _ in range(rnd.randint(1, 9))) + "." for _ in range(4)]
    texts = [" ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14))) for _ in range(60)] + [None, ""]
    spans = span_dedup.Spans()
    cut, gone = plain_removed(texts, spans)
    for got in partitions(lambda n: span_dedup.remove_repeats(docs(spark, texts), spans).collect(), (1, 4)):
        for r in got:
            want = [s.split() for k, s in enumerate(cut[r.doc_id]) if k not in gone[r.doc_id]]
            assert r.n_removed == len(gone[r.doc_id]) and r.n_sentences == len(cut[r.doc_id])
            assert (r.text or "").split() == [w for s in want for w in s]
        assert sum(r.n_removed for r in got) > 20


@pytest.mark.parametrize("stop", [". ", " "])
def test_long_passages_go_wherever_they_stand(spark, stop):
    rnd = random.Random(6)

    def prose(n):
        return stop.join(" ".join("w%05d" % rnd.randint(0, 99999) for _ in range(9)) for _ in range(n))

    passage = prose(9)
    texts = [prose(8) + ". " + passage + ". " + prose(8), prose(5) + " " + passage + " " + prose(6), prose(12), None]
    rows = {r.doc_id: r for r in span_dedup.remove_repeats(docs(spark, texts)).collect()}
    assert rows[0].text == texts[0] and rows[2].text == texts[2] and rows[3].text is None
    left = set(rows[1].text.split()) & set(passage.split())
    assert len(left) < 0.4 * len(passage.split())
    for s in rows[1].removed:
        assert texts[1][s.start : s.end] not in rows[1].text


@pytest.mark.parametrize("stops", [0, 1, 4])
@pytest.mark.parametrize("distinct", [1, 2, 5, 60])
def test_any_passage_of_51_words_is_found(spark, stops, distinct):
    rnd = random.Random(100 * stops + distinct)
    count = iter(range(10**6))

    def other():
        return " ".join(f"u{next(count)}" for _ in range(rnd.randint(0, 30)))

    texts, shared = [], []
    for k in range(25):
        pool = [f"p{k}x{i}" for i in range(distinct)]
        passage = [rnd.choice(pool) for _ in range(51)]
        for at in rnd.sample(range(51), stops):
            passage[at] += "."
        shared.append(set(passage))
        texts += [" ".join([other(), *passage, other()]) for _ in range(2)]
    rows = {r.doc_id: r for r in span_dedup.remove_repeats(docs(spark, texts)).collect()}
    for k, words_of in enumerate(shared):
        first, again = rows[2 * k], rows[2 * k + 1]
        if distinct == 60:  # no repeats inside a passage
            assert first.text == texts[2 * k]
        gone = [w for s in again.removed for w in texts[2 * k + 1][s.start : s.end].split()]
        assert sum(w in words_of for w in gone) >= 27 and len(gone) < 51 + 12


def test_no_piece_is_longer_than_a_window():
    rnd = random.Random(11)
    spans = span_dedup.Spans()
    for distinct in (1, 2, 3, 50, 10_000):
        texts = [" ".join(f"v{rnd.randrange(distinct)}" for _ in range(n)) for n in (13, 14, 40, 3000)] + ["a b"] + [None]
        for chunk, start, to, _ in span_dedup.sentences(pa.array(texts), spans):
            long = np.diff(chunk.word_offsets)[chunk.word_row[start]] > spans.long
            assert (to - start)[long].max() <= spans.cut and (to - start).sum() == len(chunk.starts)
            # Every cut is the rightmost least of a window, and every window has its cut.
            h, ends = chunk.hashes(), set((to - 1).tolist())
            for a, b in zip(chunk.word_offsets[:-1], chunk.word_offsets[1:]):
                if b - a <= spans.long:
                    continue
                want = {i + max(j for j in range(8) if h[i + j] == h[i : i + 8].min()) for i in range(a, b - 7)}
                assert want | {b - 1} == {e for e in ends if a <= e < b}


def test_spans_of_copies_ties_and_empty_tables(spark):
    text = ". ".join(f"one two three four five six {i}" for i in range(6)) + "."
    rows = [(4, text), (2, text), (2, text), (None, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS removed", "2 AS n_removed")
    got = [(r.doc_id, r.n_removed) for r in span_dedup.remove_repeats(df).collect()]
    assert sorted(got, key=str) == [(2, 0), (2, 0), (4, 6), (None, 6)]
    assert span_dedup.remove_repeats(df.limit(0)).count() == 0


# --- quality counts ----------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i : i + 3]), []).append(i)
    again = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_counts_equal_the_definitions(spark):
    rnd = random.Random(7)
    texts = [None, "", " \t", "a b", "a b c a b c a b c", "#é|\n#é|\n\n \nx"]
    texts += ["".join(rnd.choice(["a ", "b ", "c#", "é\n", "  ", "\x0b"]) for _ in range(rnd.randint(0, 120))) for _ in range(300)]
    for r in quality_rules.with_counts(docs(spark, texts)).collect():
        assert tuple(r[c] for c in quality_rules.COUNTS) == plain_counts(texts[r.doc_id]), texts[r.doc_id]


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def test_outliers_go_and_plain_documents_stay(spark, partitions):
    rnd = random.Random(8)
    rows = [(i, prose(rnd, rnd.randint(60, 600)), "en", None if i % 3 else "s", None) for i in range(300)]
    junk = " ".join(w + "###$$$" for w in prose(rnd, 200).split())
    rows += [(300, junk, "en", "s", None), (301, junk, "en", None, None), (302, "few words", "en", "s", None)]
    rows += [(303, "same again and " * 100, "en", "s", None), (304, None, None, None, None)]
    rows += [(305, prose(rnd, 100), "xx", "alone", None), (306, junk, "xx", "alone", None)]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "true AS kept", "5 AS n_words")
    results = partitions(lambda n: {r.doc_id: (r.base_failed, r.kept, r.distance) for r in quality_rules.judge(df).collect()}, (1, 4))
    assert results[0] == results[1]
    found = results[0]
    assert all(found[i][1] for i in [*range(300), 305])
    assert not any(found[i][1] for i in range(300, 305)) and not found[306][1]
    assert [found[i][0] for i in (300, 302, 303, 304)] == [False, True, True, True]
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_few_rows_are_judged_by_the_limits_alone(spark):
    rnd = random.Random(9)
    df = docs(spark, [prose(rnd, 80), "short", " ".join(w + "####" for w in prose(rnd, 80).split())])
    assert [r.kept for r in quality_rules.judge(df).orderBy("doc_id").collect()] == [True, False, True]
