"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

Everything is DataFrame functions. A pattern's spans are found by splitting the text at its matches: the
lengths of the gaps and of the matches add up to code point offsets, chunk by chunk, in one pass.

The patterns match what the plain ones beside them match. Possessive repetition and a look behind keep
them from trying every start inside a long run of digits or letters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

LOCAL = "A-Za-z0-9._%+-"

#: Kind -> pattern; the order is that of the result.
BASE: dict[str, str] = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Kinds that the method adds to the base.
ADDED: dict[str, str] = {"iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"}

#: A character without which a text holds no span of the kind.
NEEDS = {"email": "@", "phone": "+"}

#: Words within CONTEXT code points before a span that raise its score.
CONTEXT = 40
CONTEXT_WORDS = {
    "email": ["mail", "contact", "write"],
    "ip": ["ip", "host", "server", "address"],
    "card": ["card", "visa", "credit", "pay"],
    "phone": ["phone", "call", "tel", "mobile"],
    "iban": ["iban", "account", "bank"],
}

#: Score of a confirmed span, and what a context word adds.
CONFIRMED, NEARBY = 0.7, 0.3


#: Spans are gathered in chunks of so many, so that the work grows with a text's spans and not with their square.
CHUNK = 128

SPANS = "array<struct<from:int,before:string,body:string>>"


def _once(value: Column, use) -> Column:
    """use(value), with the value worked out once however often it is used, inside lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spans(text: Column, pattern: str) -> Column:
    """SPANS of a pattern's matches: offset in code points, the CONTEXT code points before it, and the match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = _once(found, lambda f: F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(f)).alias("gap"), f.alias("body")))
    end = lambda s: F.right(s, F.lit(CONTEXT))

    def chunk(p: Column, k: Column) -> Column:
        """struct<length, out> of a chunk, offsets from its begin. What precedes it is in the CONTEXT pairs before it at most."""
        first = k * CHUNK
        ahead = F.slice(p, F.greatest(first - CONTEXT, F.lit(0)) + 1, F.least(first, F.lit(CONTEXT)))
        tail = end(F.array_join(F.transform(ahead, lambda x: F.concat(x["gap"], x["body"])), ""))
        start = F.struct(F.lit(0).alias("at"), tail.alias("tail"), F.array().cast(SPANS).alias("out"))

        def add(acc: Column, x: Column) -> Column:
            here, before = acc["at"] + F.char_length(x["gap"]), end(F.concat(acc["tail"], x["gap"]))
            one = F.struct(here.alias("from"), before.alias("before"), x["body"].alias("body"))
            return F.struct((here + F.char_length(x["body"])).alias("at"), end(F.concat(before, x["body"])).alias("tail"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(F.slice(p, first + 1, F.lit(CHUNK)), start, add, lambda acc: F.struct(acc["at"].alias("length"), acc["out"].alias("out")))

    def joined(chunks: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        begins = F.aggregate(chunks, zero, lambda a, c: F.struct((a["at"] + c["length"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        moved = lambda c, at: F.transform(c["out"], lambda s: F.struct((s["from"] + at).alias("from"), s["before"].alias("before"), s["body"].alias("body")))
        return F.flatten(F.zip_with(chunks, begins, moved))

    def whole(p: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.greatest(F.size(p), F.lit(1)) - 1) / CHUNK).cast("int"))
        return _once(F.transform(numbers, lambda k: chunk(p, k)), joined)

    return _once(pairs, whole)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.split(F.reverse(digits), "")
    value = F.transform(
        each,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.pmod(d.cast("int") * 2, F.lit(10)) + F.when(d.cast("int") > 4, 1).otherwise(0)),
    )
    return F.aggregate(value, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number's letters and digits leave 1 modulo 97."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    code = lambda c: F.ascii(c)
    return (
        F.aggregate(
            F.split(turned, ""),
            F.lit(0),
            lambda a, c: F.when(code(c) <= 57, (a * 10 + code(c) - 48) % 97).otherwise((a * 100 + code(c) - 55) % 97),
        )
        == 1
    )


def _confirmed(kind: str, body: Column) -> Column:
    digits = F.regexp_replace(body, "[^0-9]", "")
    if kind == "ip":
        return body.rlike(r"^(?:0*+(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])?(?:\.|$)){4}$")
    if kind == "card":
        return F.char_length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.char_length(digits).between(8, 15)
    if kind == "iban":
        return mod97(body)
    return F.lit(True)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents' columns and `pii`: array of (kind, start, end, body, score), by kind as listed, then start.

    A null or empty text has no spans. Texts are taken whole. Rows are treated one by one, so repeated rows get
    the same spans. An existing column named pii is replaced.
    """
    kinds = BASE | ADDED
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "pii"]
    body = text_of(text)
    empty = F.array().cast(SPANS)

    def spans(kind: str) -> Column:
        found = _spans(body, kinds[kind])
        needed = F.contains(body, F.lit(NEEDS[kind])) if kind in NEEDS else body.rlike("[0-9]")
        return F.when(needed, found).otherwise(empty)

    found = docs.select(*columns, *[spans(k).alias(f"__pii_{k}") for k in kinds])

    def scored(kind: str) -> Column:
        words = "|".join(CONTEXT_WORDS[kind])

        def one(s: Column) -> Column:
            near = F.lower(s["before"]).rlike(rf"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)")
            return F.struct(
                F.lit(kind).alias("kind"),
                s["from"].alias("start"),
                (s["from"] + F.char_length(s["body"])).alias("end"),
                s["body"].alias("body"),
                F.when(near, CONFIRMED + NEARBY).otherwise(CONFIRMED).alias("score"),
            )

        return F.transform(F.filter(F.col(f"__pii_{kind}"), lambda s: _confirmed(kind, s["body"])), one)

    return found.select(*columns, F.concat(*[scored(k) for k in kinds]).alias("pii"))


def masked(docs: DataFrame, text: str = "text", least: float = 0.0) -> DataFrame:
    """The documents with every span of at least that score replaced by its kind in angle brackets; overlaps go once."""
    found = find_pii(docs, text)
    spans = F.array_sort(F.transform(F.filter("pii", lambda s: s["score"] >= least), lambda s: F.struct(s["start"], s["end"], s["kind"])))
    body = text_of(text)
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate(
        spans,
        first,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(a["out"], F.substr(body, a["at"] + 1, s["start"] - a["at"]), F.lit("<"), s["kind"], F.lit(">")).alias("out"),
            ),
        ).otherwise(a),
        lambda a: F.concat(a["out"], F.substr(body, a["at"] + 1)),
    )
    return found.withColumn(text, new)
