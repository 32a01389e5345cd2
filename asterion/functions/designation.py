"""Packed and unpacked designations as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .common import col
from .tables import BASE62


def base62_value(text) -> Column:
    """Value of up to four base-62 digits; NULL if a character is not a digit."""
    t = F.lpad(col(text), 4, F.lit("0"))
    total = F.lit(0)
    for k in range(1, 5):
        digit = F.nullif(F.instr(F.lit(BASE62), F.substring(t, k, 1)), F.lit(0)) - 1
        total = total * 62 + digit
    return total


def base62(number, width: int = 4) -> Column:
    """Base-62 text of a non-negative number, zero padded to a width."""
    n = col(number).cast("bigint")
    digits = []
    for k in range(width - 1, -1, -1):
        at = F.pmod(F.floor(n / F.lit(62 ** k)).cast("bigint"), F.lit(62))
        digits.append(F.lit(BASE62).substr(at.cast("int") + 1, F.lit(1)))
    return F.concat(*digits)


def pack_number(number) -> Column:
    """Minor-planet number to five characters: digits, letter and digits, or tilde form."""
    n = col(number).try_cast("bigint")
    high = F.floor(n / F.lit(10000)).cast("int")
    return (F.when(n < 100000, F.lpad(n.cast("string"), 5, F.lit("0")))
            .when(n < 620000, F.concat(F.lit(BASE62).substr(high + 1, F.lit(1)),
                                       F.lpad(F.pmod(n, F.lit(10000)).cast("string"), 4, F.lit("0"))))
            .when(n.isNotNull(), F.concat(F.lit("~"), base62(n - 620000))))


def unpack_designation(packed, tilde: bool = True) -> Column:
    """Readable form of a packed number or provisional designation.

    Anything not recognised passes through trimmed. ``tilde=False`` gives the
    narrower database form, which leaves tilde numbers packed.
    """
    s = F.trim(col(packed))
    letter = F.nullif(F.instr(F.lit(BASE62), F.substring(s, 1, 1)), F.lit(0)) - 1
    century = (F.when(F.substring(s, 1, 1) == "I", F.lit("18"))
               .when(F.substring(s, 1, 1) == "J", F.lit("19"))
               .when(F.substring(s, 1, 1) == "K", F.lit("20")))
    high = F.instr(F.lit(BASE62), F.substring(s, 5, 1)) - 1
    low = F.substring(s, 6, 1).try_cast("int")
    cycle = high * 10 + low
    provisional = F.concat(
        century, F.substring(s, 2, 2), F.lit(" "), F.substring(s, 4, 1), F.substring(s, 7, 1),
        F.when(cycle == 0, F.lit("")).otherwise(cycle.cast("string")))
    out = (F.when(s.rlike("^[0-9]{1,5}$"), F.ltrim(s, F.lit("0")))
           .when(s.rlike("^[A-Za-z][0-9]{4}$"),
                 (letter * 10000 + F.substring(s, 2, 4).try_cast("int")).cast("string")))
    if tilde:
        out = out.when(s.rlike("^~[0-9A-Za-z]{4}$"),
                       (base62_value(F.substring(s, 2, 4)) + 620000).cast("string"))
    return out.when((F.length(s) >= 7) & century.isNotNull() & provisional.isNotNull(),
                    provisional).otherwise(s)


def pack_designation(unpacked) -> Column:
    """Packed form of a number, a provisional or a survey designation.

    Anything not recognised passes through trimmed.
    """
    s = F.trim(col(unpacked))
    prov = "^(18|19|20)([0-9]{2}) ([A-HJ-Y])([A-Z])([0-9]*)$"
    century = (F.when(F.substring(s, 1, 2) == "18", F.lit("I"))
               .when(F.substring(s, 1, 2) == "19", F.lit("J")).otherwise(F.lit("K")))
    cycle = F.coalesce(F.nullif(F.regexp_extract(s, prov, 5), F.lit("")), F.lit("0")).try_cast("int")
    high = F.floor(cycle / F.lit(10)).cast("int")
    cycle_text = F.concat(F.lit(BASE62).substr(high + 1, F.lit(1)),
                          F.pmod(cycle, F.lit(10)).cast("string"))
    packed = F.concat(century, F.regexp_extract(s, prov, 2), F.regexp_extract(s, prov, 3),
                      cycle_text, F.regexp_extract(s, prov, 4))
    survey = "^([0-9]{4}) (P-L|T-[123])$"
    survey_packed = F.concat(
        F.when(s.endswith("P-L"), F.lit("PLS"))
        .otherwise(F.concat(F.lit("T"), F.substring(s, -1, 1), F.lit("S"))),
        F.regexp_extract(s, survey, 1))
    return (F.when(s.rlike("^[0-9]+$"), pack_number(s))
            .when(s.rlike(prov) & (cycle < 620), packed)
            .when(s.rlike(survey), survey_packed)
            .otherwise(s))


def designation_kind(text) -> Column:
    """What a designation names: numbered, provisional, survey, comet, a minor
    planet on a cometary orbit (A/), an interstellar object (I), a satellite."""
    s = F.trim(col(text))
    return (F.when(s.rlike("^[0-9]+$|^[A-Za-z~][0-9A-Za-z]{4}$"), F.lit("numbered"))
            .when(s.rlike("^S/[0-9]{4} [JSUNMV] [0-9]+"), F.lit("satellite"))
            .when(s.rlike("^[0-9]*[CPDX]/|^[0-9]+[PD]$"), F.lit("comet"))
            .when(s.rlike("^A/"), F.lit("asteroid_cometary"))
            .when(s.rlike("^[0-9]+I(/|$)|^I/"), F.lit("interstellar"))
            .when(s.rlike("^[0-9]{4} (P-L|T-[123])$|^(PLS|T[123]S)[0-9]{4}$"), F.lit("survey"))
            .when(s.rlike("^(18|19|20)[0-9]{2} [A-HJ-Y][A-Z][0-9]*$"
                          "|^[IJK][0-9]{2}[A-HJ-Y][0-9A-Za-z][0-9][A-Z]$"), F.lit("provisional")))


def is_comet(text) -> Column:
    """C/, P/ and D/ objects; A/ and I/ objects carry comet syntax but are not comets."""
    return F.coalesce(designation_kind(text) == "comet", F.lit(False))


def numbered_packed(packed) -> Column:
    """Whether a packed designation names a numbered object."""
    s = F.rtrim(col(packed))
    return s.rlike("^[0-9]+$|^[A-Za-z][0-9]+$|^~")


def key_kind(text) -> Column:
    """Which identifier a bare key is: a permanent one has no space in it."""
    return F.when(F.instr(col(text), " ") == 0, F.lit("permid")).otherwise(F.lit("provid"))


def spaced_designation(text) -> Column:
    """Insert the blank that compact lists leave out after the leading digits."""
    s = col(text)
    return F.when(s.rlike("^[0-9]+$"), s).otherwise(
        F.regexp_replace(s, "^([0-9]+)([A-Za-z].*)$", "$1 $2"))
