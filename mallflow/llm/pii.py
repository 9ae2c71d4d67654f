"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust their score.

Everything is built from Spark's own functions. All matches of a kind are marked in one pass over the text with a control character
before and after each, the marked text is split at the marks, and the places follow from the lengths of the pieces. Control
characters that a text holds already are first replaced by another one, which no expression matches either. The expressions are
written so that each character is tried a bounded number of times: a run of characters is only entered at its first one, and
possessive repeats never give back. An account number is proposed at every word that begins with a country of :data:`IBAN_LENGTHS`
and two digits, in that country's length, if it ends at a word edge; proposals may overlap, and the first confirmed one counts.

Kinds, in this order: ``email``; ``ip``, every part at most 255; ``card``, 14 to 19 digits that pass Luhn; ``phone``, 10 to 15 digits;
``iban``, right length and 97-remainder 1. The first four are always reported; an ``iban`` only with a score of at least
:data:`LEAST_SCORE`. The score of a span is what its kind and checksum are worth, raised when one of the kind's words stands within
:data:`NEARBY` characters of it and lowered when a word for sample data does: an account number among such words, without one of its
own, is not reported.

Places are code points, end exclusive. Defined results: a null text counts as empty; repeated rows are read each on its own; spans of
different kinds may overlap, spans of one kind never do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mallflow.llm.frames import fresh, let

NEARBY = 48
LEAST_SCORE = 0.5
RAISED, LOWERED = 0.25, 0.3
# Places are added up, and texts looked into, block by block, so that the work grows with the text and not with its square.
_BLOCK, _BLOCK_CHARACTERS = 128, 1024

_OPEN, _SHUT, _STAND_IN = "\x01", "\x02", "\x03"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_SAMPLE = "(?i)\\b(?:example|sample|dummy|fake|placeholder|test)\\b"


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds the spans, ``hint`` is an expression that every text with a span holds, ``worth`` the score without context. An
    ``overlapping`` kind's pattern is empty at the start of a span and holds the span as its first group."""

    name: str
    pattern: str
    hint: str
    worth: float
    context: str
    overlapping: bool = False


def _entered(run: str) -> str:
    # The first character of a run, or the first one after the match before.
    return f"(?:(?<!{run})|\\G)"


#: Characters of an account number by country, without blanks (IBAN registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(f"(?:{'|'.join(c.split())})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())

KINDS = [
    Kind(
        "email",
        _entered("[A-Za-z0-9._%+-]") + "[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
        "@",
        0.75,
        "(?i)\\b(?:e-?mail|mail|contact|write|correo|courriel|kontakt)\\b",
    ),
    Kind(
        "ip",
        _entered("[0-9]") + "[0-9]++(?:\\.[0-9]++){3}",
        "[0-9]\\.[0-9]",
        0.6,
        "(?i)\\b(?:ip|host|server|address|adresse|login|from)\\b",
    ),
    Kind(
        "card",
        "[0-9](?:[\\x20-]?[0-9])++",
        "[0-9][\\x20-]?[0-9]",
        0.7,
        "(?i)\\b(?:card|credit|visa|mastercard|payment|karte|tarjeta|carte)\\b",
    ),
    Kind(
        "phone",
        "\\+[0-9][\\x20().0-9-]+[0-9]",
        "\\+[0-9]",
        0.6,
        "(?i)\\b(?:phone|tel|call|mobile|fax|telefon|telefono|appel)\\b",
    ),
    Kind(
        "iban",
        f"(?<![A-Za-z0-9])(?=((?:{_IBAN})(?![A-Za-z0-9])))",
        "[A-Z]{2}[0-9]{2}",
        0.75,
        "(?i)\\b(?:iban|account|bank|konto|cuenta|compte)\\b",
        overlapping=True,
    ),
]
BASE = ("email", "ip", "card", "phone")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn: from the right, every second one is doubled and its own digits are added."""
    place = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def worth(i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i, F.lit(1)).try_cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.transform(place, worth), F.lit(0), lambda a, b: a + b)
    return (F.length(digits) > 0) & (total % 10 == 0)


def _mod_97(iban: Column) -> Column:
    """Whether the account number, its first four characters moved to the end and letters read as 10 to 35, leaves 1 over 97."""
    bare = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return (rest * F.when(value > 9, F.lit(100)).otherwise(F.lit(10)) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(f"^{_BYTE}(?:\\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(14, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return F.length(F.replace(match, F.lit(" "), F.lit(""))).between(15, 34) & _mod_97(match)
    return F.lit(True)


def _proposed(kind: Kind, text: Column) -> Column:
    """Array of (start, end, match) of the kind's matches in the text."""
    marked = F.regexp_replace(text, kind.pattern, f"{_OPEN}${1 if kind.overlapping else 0}{_SHUT}")

    def found(pieces: Column) -> Column:
        # Every piece but the first begins with a match; each holds one mark that the text does not.
        last = (F.size(pieces) - 2).cast("int")
        numbers = F.sequence(F.lit(0), F.greatest(F.floor(last / _BLOCK).cast("int"), F.lit(0)))
        blocks = F.transform(numbers, lambda i: F.slice(pieces, i * _BLOCK + 2, F.lit(_BLOCK)))
        return let(blocks, lambda blocks: let(_starts(F.length(F.get(pieces, F.lit(0))), blocks), lambda at: _placed(blocks, at)))

    def own(piece: Column) -> Column:
        """How many characters of the text a piece holds: the span of an overlapping kind stands before it, as a copy."""
        return F.length(F.substring_index(piece, _SHUT, -1)) if kind.overlapping else F.length(piece) - 1

    def _starts(first: Column, blocks: Column) -> Column:
        """The place of each block, and the end of the text."""
        sizes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda total, piece: total + own(piece)))
        return F.aggregate(sizes, F.array(first), lambda at, size: F.concat(at, F.array(F.element_at(at, -1) + size)))

    def _placed(blocks: Column, at: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda block, i: _in_block(block, F.get(at, i))))

    def _in_block(block: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("found"))

        def step(state: Column, piece: Column) -> Column:
            match = F.substring_index(piece, _SHUT, 1)
            span = F.struct(state["at"].alias("s"), (state["at"] + F.length(match)).alias("e"), match.alias("m"))
            return F.struct((state["at"] + own(piece)).alias("at"), F.concat(state["found"], F.array(span)).alias("found"))

        return F.aggregate(block, state, step)["found"]

    return let(F.split(marked, _OPEN), found)


def _apart(spans: Column) -> Column:
    """Spans in order of place without those that begin before the end of one that is kept."""
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    return F.aggregate(
        spans,
        none,
        lambda kept, x: F.when(
            (F.size(kept) == 0) | (x["s"] >= F.get(kept, F.size(kept) - 1)["e"]), F.concat(kept, F.array(x))
        ).otherwise(kept),
    )


def _scored(kind: Kind, blocks: Column, found: Column) -> Column:
    """Confirmed spans as (s, order, e, kind, score). ``blocks`` is the text in blocks of :data:`_BLOCK_CHARACTERS`."""
    order = [k.name for k in KINDS].index(kind.name)

    def cut(place: Column, size: Column) -> Column:
        block = F.floor(place / _BLOCK_CHARACTERS).cast("int")
        return F.substr(F.array_join(F.slice(blocks, block + 1, F.lit(2)), ""), place - block * _BLOCK_CHARACTERS + 1, size)

    def span(x: Column) -> Column:
        low = F.greatest(x["s"] - NEARBY, F.lit(0))
        near = F.concat_ws(" ", cut(low, x["s"] - low), cut(x["e"], F.lit(NEARBY)))
        score = (
            F.lit(kind.worth)
            + F.when(near.rlike(kind.context), F.lit(RAISED)).otherwise(F.lit(0.0))
            - F.when(near.rlike(_SAMPLE), F.lit(LOWERED)).otherwise(F.lit(0.0))
        )
        return F.struct(x["s"].alias("s"), F.lit(order).alias("o"), x["e"].alias("e"), F.lit(kind.name).alias("kind"), score.alias("score"))

    confirmed = F.filter(found, lambda x: _confirmed(kind.name, x["m"]))
    spans = F.transform(_apart(confirmed) if kind.overlapping else confirmed, span)
    return spans if kind.name in BASE else F.filter(spans, lambda x: x["score"] >= LEAST_SCORE)


def find_pii(docs: DataFrame, into: str = "pii") -> DataFrame:
    """``docs`` with an array ``into`` of the confirmed spans in order of place and kind: (start, end, kind, score)."""
    safe = fresh(docs.columns, "safe")
    found = {kind.name: fresh([*docs.columns, safe], f"found_{kind.name}") for kind in KINDS}
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    frame = docs.withColumn(safe, F.translate(F.coalesce("text", F.lit("")), _OPEN + _SHUT, _STAND_IN * 2))
    text = F.col(safe)
    for kind in KINDS:
        frame = frame.withColumn(found[kind.name], F.when(text.rlike(kind.hint), _proposed(kind, text)).otherwise(none))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK_CHARACTERS}}}"), F.lit(0))
    every = let(blocks, lambda blocks: F.array_sort(F.concat(*[_scored(kind, blocks, F.col(found[kind.name])) for kind in KINDS])))
    shown = F.transform(
        every, lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), x["kind"].alias("kind"), x["score"].alias("score"))
    )
    return frame.withColumn(into, shown).select(*[F.col(f"`{c}`") for c in docs.columns], into)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(found: DataFrame, into: str = "pii", id_column: str = "doc_id") -> DataFrame:
    """Counts and digests of the spans of each row of :func:`find_pii`."""
    spans = F.col(into)

    def of(*kinds: str) -> Column:
        return F.filter(spans, lambda x: x["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        id_column,
        *counts,
        F.sha2(_listed(of(*BASE)).cast("binary"), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda x: F.format_number(x["score"], 2)), ",").alias("scores"),
    )
