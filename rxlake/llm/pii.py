"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Only built-in column functions, so the whole search runs inside the JVM. Positions are code points.

Defined results: a NULL text counts as empty and has no spans. Texts are searched whole, whatever
their length: no pattern backtracks over more than the match at hand. Equal rows give equal results,
an empty table gives none. Existing columns stay; the added one replaces a column of that name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A run that could be the local part is entered at its first character or where the last match
# ended, which finds the same matches as trying every character, in linear time.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Looks ahead for the longest proposal and takes up only its head, so that another may begin inside it.
IBAN = r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9]))[A-Z]{2}[0-9]{2}"
IBAN_HEAD = 4
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,score:double>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_valid(text: Column) -> Column:
    """Whether the digits of a match pass the Luhn check."""
    reverse = F.reverse(_digits(text))

    def step(total: Column, place: Column) -> Column:
        digit = F.substring(reverse, place, F.lit(1)).cast("int")
        twice = digit * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(reverse)), F.lit(0), step) % 10 == 0


def mod97_valid(text: Column) -> Column:
    """Whether an account number's remainder by 97 is 1, letters counting from 10."""
    bare = F.regexp_replace(text, r"\x20", "")
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))

    def step(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(turned, place, F.lit(1)))
        return F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _iban_width(text: Column) -> Column:
    """The length of the longest valid account number that a proposal begins with, ending at a blank."""
    words = F.split(text, r"\x20", -1)
    starts = F.transform(
        F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " ")
    )
    long_enough = F.filter(starts, lambda s: F.length(F.regexp_replace(s, r"\x20", "")) >= 15)
    return F.length(F.get(F.filter(long_enough, mod97_valid), 0))


def _ip_valid(text: Column) -> Column:
    # Leading zeros count for nothing, so at most three digits are left of a part up to 255.
    def fits(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) < 4) & (F.concat(F.lit("0"), F.substring(bare, 1, 3)).cast("int") <= 255)

    return F.forall(F.split(text, r"\."), fits)


def _digit_count_between(low: int, high: int):
    return lambda text: F.length(_digits(text)).between(low, high)


def _card_valid(text: Column) -> Column:
    return F.when(_digit_count_between(14, 19)(text), luhn_valid(text)).otherwise(False)


def _ssn_valid(text: Column) -> Column:
    return ~text.rlike("^(?:000|666|9)") & ~text.rlike("-00-|-0000$")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: ``hint`` is a cheap test that any text with a match passes."""

    name: str
    pattern: str
    hint: str
    valid: object
    score: float
    context: str
    bonus: float = 0.3
    always: bool = False
    width: object = None  # of a confirmed part, where a match is only the head of a proposal looked ahead for


# Kinds in the order in which spans of one start are listed. The first four stay at any score.
KINDS = [
    Kind("email", EMAIL, "@", lambda t: F.lit(True), 0.7, "e-?mail|contact|write|address", always=True),
    Kind("ip", IP, ".", _ip_valid, 0.5, "ip|host|server|address|login", always=True),
    Kind("card", CARD, "", _card_valid, 0.7, "card|visa|credit|payment|account", always=True),
    Kind("phone", PHONE, "+", _digit_count_between(10, 15), 0.5, "phone|call|tel|mobile|fax", always=True),
    Kind("iban", IBAN, "", None, 0.8, "iban|bank|account|transfer", width=_iban_width),
    Kind("ssn", SSN, "-", _ssn_valid, 0.3, "ssn|social|security|taxpayer"),
]
CONTEXT_CHARS = 40
SCAN_BATCH = 256
CHUNK_CHARS = 1024


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _scan(items: Column, start: dict[str, Column], step, none_yet: Column) -> Column:
    """What ``step`` adds to the list ``out`` of its state, over all items in order.

    A list is copied whenever something is added to it. Lists here end after ``SCAN_BATCH`` items and
    are joined once, so the time grows with the items and not with their square.
    """
    batches = _let(
        items,
        lambda all_items: F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(all_items), F.lit(1)), F.lit(SCAN_BATCH)),
            lambda at: F.slice(all_items, at, F.lit(SCAN_BATCH)),
        ),
    )

    def state(seen, out: Column) -> Column:
        return F.struct(*[seen[name].alias(name) for name in start], out.alias("out"))

    def batch(seen: Column, some: Column) -> Column:
        ended = F.aggregate(some, state(seen, none_yet), step)
        return _let(ended, lambda end: state(end, F.concat(seen["out"], F.array(end["out"]))))

    first = state(start, F.slice(F.array(none_yet), 1, 0))
    return F.aggregate(batches, first, batch, lambda seen: F.flatten(seen["out"]))


def _chunks(text: Column) -> Column:
    """The text in pieces of ``CHUNK_CHARS`` code points, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK_CHARS}}}"), F.lit(0))


def _cut(chunks: Column, begin: Column, end: Column) -> Column:
    """Code points from ``begin`` up to ``end``, without a walk from the start of the text."""
    first = F.floor(begin / CHUNK_CHARS).cast("int")
    many = F.ceil(end / CHUNK_CHARS).cast("int") - first
    near = F.array_join(F.slice(chunks, first + 1, F.greatest(many, F.lit(0))), "")
    return F.substring(near, begin % CHUNK_CHARS + 1, end - begin)


def _proposals(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind, none of which overlap.

    Splitting at a pattern gives the gaps between the very matches that extraction gives, so
    running sums of both lengths are the matches' positions.
    """
    maybe = text.contains(kind.hint) if kind.hint else text.rlike(kind.pattern)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0 if kind.width is None else 1))

    def piece(gap: Column, hit: Column) -> Column:
        if kind.width is None:
            taken = width = F.length(hit)
            valid = F.coalesce(kind.valid(hit), F.lit(False))
        else:
            taken, width = F.lit(IBAN_HEAD), kind.width(hit)
            valid = width.isNotNull()
        return F.struct(
            F.length(gap).alias("gap"), taken.alias("taken"), F.coalesce(width, F.lit(0)).alias("width"), valid.alias("valid")
        )

    def step(seen: Column, piece: Column) -> Column:
        begin = seen["at"] + piece["gap"]
        end = begin + piece["width"]
        span = F.struct(begin.alias("start"), end.alias("end"))
        kept = piece["valid"] & (begin >= seen["last"])
        return F.struct(
            (begin + piece["taken"]).alias("at"),
            F.when(kept, end).otherwise(seen["last"]).alias("last"),
            F.when(kept, F.concat(seen["out"], F.array(span))).otherwise(seen["out"]).alias("out"),
        )

    def placed(hits: Column) -> Column:
        gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(hits))
        none_yet = F.array().cast("array<struct<start:int,end:int>>")
        spans = _scan(F.zip_with(gaps, hits, piece), {"at": F.lit(0), "last": F.lit(0)}, step, none_yet)
        return F.when(F.size(hits) > 0, spans)

    return F.when(maybe, _let(found, placed))


def find_pii(
    df: DataFrame, text: str = "text", out: str = "pii_spans", min_score: float = 0.6
) -> DataFrame:
    """Add an array of (start, kind_no, end, kind, score), by start and then by kind.

    Spans of a base kind always stay; others need ``min_score``, which depends on their checksum
    and on context words in the 40 code points before them.
    """
    body = "_pii_text"
    work = df.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    names = [f"_pii_{k.name}" for k in KINDS]
    work = work.withColumns({n: _proposals(F.col(body), k) for n, k in zip(names, KINDS)})
    chunks = "_pii_chunks"
    any_found = F.coalesce(*[F.col(n) for n in names]).isNotNull()
    work = work.withColumn(chunks, F.when(any_found, _chunks(F.col(body))))

    def scored(kind: Kind, number: int, spans: Column) -> Column:
        def rate(span: Column) -> Column:
            begin = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
            before = F.lower(_cut(F.col(chunks), begin, span["start"]))
            near = before.rlike(rf"\b(?:{kind.context})\b")
            return F.struct(
                span["start"].alias("start"),
                F.lit(number).alias("kind_no"),
                span["end"].alias("end"),
                F.lit(kind.name).alias("kind"),
                F.when(near, min(1.0, kind.score + kind.bonus)).otherwise(kind.score).alias("score"),
            )

        rated = F.transform(spans, rate)
        kept = rated if kind.always else F.filter(rated, lambda s: s["score"] >= min_score)
        return F.coalesce(kept, F.array().cast(SPAN))

    every = F.concat(*[scored(k, i, F.col(n)) for i, (n, k) in enumerate(zip(names, KINDS))])
    return work.withColumn(out, F.sort_array(every)).drop(body, chunks, *names)


def redact(df: DataFrame, text: str = "text", min_score: float = 0.6) -> DataFrame:
    """Replace every span by its kind in brackets; of overlapping spans the first names the gap."""
    spans, chunks = "_pii_redact", "_pii_pieces"
    work = find_pii(df, text, spans, min_score)
    some = F.size(spans) > 0
    work = work.withColumn(chunks, F.when(some, _chunks(F.col(text))))

    def step(seen: Column, span: Column) -> Column:
        part = F.struct(seen["at"].alias("start"), span["start"].alias("end"), span["kind"].alias("kind"))
        return F.struct(
            F.greatest(span["end"], seen["at"]).alias("at"),
            F.when(span["start"] < seen["at"], seen["out"])
            .otherwise(F.concat(seen["out"], F.array(part)))
            .alias("out"),
        )

    def labelled(part: Column) -> Column:
        gap = _cut(F.col(chunks), part["start"], part["end"])
        return F.concat(gap, F.lit("["), F.upper(part["kind"]), F.lit("]"))

    none_yet = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    parts = _scan(F.col(spans), {"at": F.lit(0)}, step, none_yet)
    last_end = F.array_max(F.transform(spans, lambda s: s["end"]))
    rest = _cut(F.col(chunks), last_end, F.length(text))
    clean = F.array_join(F.concat(F.transform(parts, labelled), F.array(rest)), "")
    return work.withColumn(text, F.when(some, clean).otherwise(F.col(text))).drop(spans, chunks)


def digest(df: DataFrame, spans: str = "pii_spans") -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans as text."""

    def listed(which: Column) -> Column:
        return F.array_join(
            F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("long")

    base = [k.name for k in KINDS if k.always]
    counts = [count(name).alias(f"n_{name}") for name in base]
    basic = F.filter(spans, lambda s: s["kind_no"] < len(base))
    return df.select(
        "doc_id",
        *counts,
        F.sha2(listed(basic).cast("binary"), 256).alias("base_sha256"),
        listed(F.col(spans)).alias("spans"),
        F.array_max(F.transform(spans, lambda s: s["score"])).alias("max_score"),
    )
