"""Personal data with SQL functions only.

A regular expression proposes spans, a checksum or length test confirms them, and
context words just before a span raise its score. Splitting a text by the same
expression gives the gaps between its matches, so positions are running sums of
gap and match lengths in code points.

Base kinds: email, ip, card (Luhn), phone. Added kinds: iban (mod 97) and ssn
(scored by context). Base spans always stay; an added span stays from
``least`` on. Null and empty texts have no spans; an empty table gives no rows; rows are judged
one by one, so repeated rows repeat and a null id keeps its row; spans of different kinds with one start
are ordered as the kinds are listed; extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each run of characters is taken possessively and, unless a match ended there, from
# its first character: later starts in a run end at the same place and fail alike.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A card is a whole run of digits with single signs between them; runs of another length never match, so only those of 14 to 19 digits are proposed.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
CONTEXT = {"email": "mail|contact", "ip": "ip|host|server|address", "card": "card|visa|credit|payment", "phone": "phone|call|tel|mobile",
           "iban": "iban|account|bank", "ssn": "ssn|social|security"}
BEFORE = 40
PIECE = 256
ONE_SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string,context:boolean>>"


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right is doubled."""
    value = lambda i: F.substring(F.reverse(d), i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda a, i: a + F.when(i % 2 == 1, value(i)).otherwise(
        F.when(value(i) > 4, value(i) * 2 - 9).otherwise(value(i) * 2)))
    return total % 10 == 0


def mod97(c: Column) -> Column:
    """Whether an account number passes: country and check digits last, letters as 10 to 35."""
    s = F.regexp_replace(c, " ", "")
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))
    def step(a: Column, i: Column) -> Column:
        v = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(v >= 65, (a * 100 + v - 55) % 97).otherwise((a * 10 + v - 48) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def confirmed(kind: str, v: Column) -> Column:
    d = digits(v)
    if kind == "ip":
        return v.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    if kind == "card":
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(d).between(10, 15)
    if kind == "iban":
        return mod97(v)
    return F.lit(True)


def passes(kind: str, x: Column) -> Column:
    return confirmed(kind, x["value"])


def is_kind(kind: str, x: Column) -> Column:
    return x["kind"] == kind


def proposals(text: Column, kind: str, pattern: str) -> Column:
    """All matches of a kind in order, with positions and whether context words precede them.

    Positions are summed up inside pieces of ``PIECE`` matches, and then over the pieces: adding to an
    array copies it, so one list of all matches would cost the square of their number.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(matches.alias("value"), F.slice(F.split(text, pattern, -1), 1, F.size(matches)).alias("gap"))
    empty = F.array().cast(ONE_SPAN)
    word = rf"(?i)\b({CONTEXT[kind]})"

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["value"])
        one = F.struct(F.lit(kind).alias("kind"), start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), x["value"].alias("value"),
                       F.right(x["gap"], F.lit(BEFORE)).rlike(word).alias("context"))
        return F.struct(end.cast("bigint").alias("at"), F.concat(a["out"], F.array(one)).cast(ONE_SPAN).alias("out"))

    def piece(p: Column) -> Column:
        return F.aggregate(p, F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("out")), step)

    def moved(x: Column, by: Column) -> Column:
        return F.struct(x["kind"].alias("kind"), (x["start"] + by).alias("start"), (x["end"] + by).alias("end"), x["value"].alias("value"), x["context"].alias("context"))

    def chain(a: Column, p: Column) -> Column:
        here = F.transform(p["out"], lambda x: moved(x, a["at"]))
        return F.struct((a["at"] + p["at"]).alias("at"), F.concat(a["out"], F.array(here)).cast(f"array<{ONE_SPAN}>").alias("out"))

    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{ONE_SPAN}>").alias("out"))

    def spans(p: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(p), F.lit(1)), F.lit(PIECE))
        pieces = F.transform(F.transform(starts, lambda i: F.slice(p, i, F.lit(PIECE))), piece)
        return F.aggregate(pieces, none, chain, lambda a: F.flatten(a["out"]))

    # As a lambda's argument the matches are found once, not once per piece.
    return F.when(text.rlike(pattern), F.get(F.transform(F.array(parts), spans), 0)).otherwise(empty)


def score(x: Column) -> Column:
    """Checksummed kinds start high, shape-only ones low; context adds."""
    base = F.when(x["kind"].isin("card", "iban"), 0.8).when(x["kind"] == "email", 0.9).when(x["kind"] == "ip", 0.6).when(x["kind"] == "phone", 0.5).otherwise(0.3)
    return F.least(F.lit(1.0), base + F.when(x["context"], 0.3).otherwise(0.0))


def find(docs: DataFrame, *, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """Per row: doc_id and ``found``, the confirmed spans with kind, start, end, value and score."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select("doc_id", *[proposals(text, k, p).alias(k) for k, p in zip(KINDS, (EMAIL, IP, CARD, PHONE, IBAN, SSN))])
    ok = [F.filter(F.col(k), partial(passes, k)) for k in KINDS]
    spans = F.transform(F.concat(*ok), lambda x: F.struct(
        x["start"].alias("start"), F.array_position(F.lit(KINDS).cast("array<string>"), x["kind"]).alias("rank"), x["end"].alias("end"),
        x["kind"].alias("kind"), x["value"].alias("value"), score(x).alias("score")))
    kept = F.filter(spans, lambda x: (x["rank"] <= 4) | (x["score"] >= least))
    return rows.select("doc_id", F.array_sort(kept).alias("found"))


def report(found: DataFrame) -> DataFrame:
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    counts = [F.size(F.filter("found", partial(is_kind, k))).cast("bigint").alias(f"n_{k}") for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(joined(F.filter("found", lambda x: x["rank"] <= 4)), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
