"""Operator 8: personal data by patterns, checksums and context, all in Spark expressions.

A pattern proposes matches: they are fenced by a control character, the text
is split at the fences, and every second part is a match, whose place is the
sum of the lengths before it.  Validators then confirm: Luhn for card numbers,
mod 97 for account numbers, digit counts, and part values.  Words just before a
match raise its score.  No Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import whole_text

_FENCE, _STAND_IN = "\u0001", "\u0002"
_CHUNK = 128
_CONTEXT_CHARS = 40

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban")


@dataclass(frozen=True)
class Rule:
    """A kind of personal data.

    ``guard`` is a cheap condition every text with a match meets; ``pattern``
    proposes; ``valid`` confirms; ``score`` is raised by ``context`` words.
    """

    kind: str
    guard: Callable[[Column], Column]
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once although used several times inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_valid(digits: Column) -> Column:
    """Luhn's sum over a string of digits is a multiple of ten."""

    def total(d: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            digit = F.substring(d, i, F.lit(1)).cast("int")
            doubled = F.pmod(digit * 2, F.lit(10)) + (digit >= 5).cast("int")
            return acc + F.when(F.pmod(i, F.lit(2)) == 0, doubled).otherwise(digit)

        return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add)

    return F.when(F.length(digits) > 0, let(F.reverse(digits), lambda d: F.pmod(total(d), F.lit(10)) == 0)).otherwise(False)


def mod97_valid(account: Column) -> Column:
    """The account number, its first four characters moved last, is 1 modulo 97."""

    def rest(s: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            code = F.ascii(F.substring(s, i, F.lit(1)))
            return F.when(code < 65, F.pmod(acc * 10 + code - 48, F.lit(97))).otherwise(
                F.pmod(acc * 100 + code - 55, F.lit(97))
            )

        return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), step)

    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, F.lit(1), F.lit(4)))
    return let(turned, lambda s: rest(s) == 1)


#: Length of account numbers by country; in print they stand in groups of four.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _grouped() -> str:
    """The printed form: of known countries so long as it must be, so that words behind it stay out."""
    forms = []
    for length, countries in _IBAN_LENGTHS.items():
        fours, rest = divmod(length - 4, 4)
        last = f" [A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{fours}}}{last}")
    known = "|".join(" ".join(_IBAN_LENGTHS.values()).split())
    forms.append(f"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?")
    return "|".join(forms)


def _between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda m: F.length(digits_of(m)).between(low, high)


# The character classes, digit counts and limits of the base kinds.
# Look-behinds and possessive loops only say where a leftmost match can begin, so
# that a long run of one class is read once; \G is the end of the match before.
RULES = (
    Rule(
        "email",
        lambda t: t.contains("@"),
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        0.8,
        r"(?i)(?:mail|contact|reach|write|from|to)\W*$",
    ),
    Rule(
        "ip",
        lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
        r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(r"\A(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)(?:\.|\z)){4}\z"),
        0.5,
        r"(?i)(?:ip|host|server|address|client)\W*$",
    ),
    Rule(
        "card",
        lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){13}"),
        r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
        lambda m: luhn_valid(digits_of(m)),
        0.7,
        r"(?i)(?:card|visa|credit|debit|payment|number|no)\W*$",
    ),
    Rule(
        "phone",
        lambda t: t.contains("+"),
        r"\+[0-9][ ().0-9-]+[0-9]",
        _between(10, 15),
        0.6,
        r"(?i)(?:phone|tel|call|mobile|fax|at)\W*$",
    ),
    Rule(
        "iban",
        lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11}| [A-Z0-9]{4} [A-Z0-9]{4} [A-Z0-9]{3})"),
        rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}|{_grouped()})(?![A-Za-z0-9])",
        lambda m: mod97_valid(F.translate(m, " ", "")),
        0.8,
        r"(?i)(?:iban|account|bank|transfer)\W*$",
    ),
)


def running(values: Column, step: Callable[[Column, Column], Column], first: Column) -> Column:
    """For each whole number ``step`` over ``first`` and all numbers before it.

    It runs inside chunks and over chunks, so that the arrays that grow stay
    short for texts with very many matches.
    """
    none = F.expr("cast(array() as array<int>)")

    def scan(numbers: Column, start: Column) -> Column:
        state = F.aggregate(
            numbers,
            F.struct(start.alias("at"), none.alias("seen")),
            lambda s, n: F.struct(step(s["at"], n).alias("at"), F.concat(s["seen"], F.array(s["at"])).alias("seen")),
        )
        return state["seen"]

    def by_chunk(ns: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(ns) - 1) / _CHUNK).cast("int")),
            lambda c: F.slice(ns, c * _CHUNK + 1, F.lit(_CHUNK)),
        )
        folded = lambda cs: F.transform(cs, lambda c: F.aggregate(c, first, step))
        return let(
            chunks,
            lambda cs: let(scan(folded(cs), first), lambda firsts: F.flatten(F.zip_with(cs, firsts, lambda c, f: scan(c, f)))),
        )

    return let(values, by_chunk)


def running_starts(lengths: Column) -> Column:
    """For each length the sum of those before it."""
    return running(lengths, lambda a, n: a + n, F.lit(0))


_SPAN = "struct<start: int, kind_no: int, end: int, kind: string, score: double>"


def spans_of(rule: Rule, text: Column) -> Column:
    """Confirmed matches of one rule, in order, as an array of spans."""
    fenced = F.regexp_replace(F.translate(text, _FENCE, _STAND_IN), rule.pattern, f"{_FENCE}$0{_FENCE}")

    def confirmed(parts: Column) -> Column:
        def spans(starts: Column) -> Column:
            def span(i: Column) -> Column:
                match, before = F.get(parts, i), F.get(parts, i - 1)
                near = F.right(before, F.lit(_CONTEXT_CHARS)).rlike(rule.context)
                score = F.round(F.lit(rule.score) + F.when(near, F.lit(0.2)).otherwise(F.lit(0.0)), 2)
                start = F.get(starts, i)
                return F.struct(
                    start.alias("start"),
                    F.lit(KINDS.index(rule.kind)).alias("kind_no"),
                    (start + F.length(match)).alias("end"),
                    F.lit(rule.kind).alias("kind"),
                    score.alias("score"),
                    rule.valid(match).alias("valid"),
                )

            found = F.transform(F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)), span)
            return F.transform(
                F.filter(found, lambda s: s["valid"]),
                lambda s: F.struct(s["start"], s["kind_no"], s["end"], s["kind"], s["score"]),
            )

        some = F.size(parts) >= 3
        return F.when(some, let(running_starts(F.transform(parts, F.length)), spans))

    return F.when(rule.guard(text), let(F.split(fenced, _FENCE), confirmed))


def find_personal(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a column ``_spans``: all confirmed spans by start, then kind.

    Starts and ends count code points, ends exclusive.  A null text has none.
    All rows and columns are kept; an existing column ``_spans`` is replaced.
    """
    found = docs.withColumn("_whole", whole_text())
    names = []
    for rule in rules:
        name = f"_spans_{rule.kind}"
        found = found.withColumn(name, spans_of(rule, F.col("_whole")))
        names.append(name)
    none = F.expr(f"cast(array() as array<{_SPAN}>)")
    every = F.concat(*[F.coalesce(F.col(n), none) for n in names])
    return found.withColumn("_spans", F.sort_array(every)).drop("_whole", *names)


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_digests(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts, digest of the base spans, all spans and their scores as text."""
    found = find_personal(docs.select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("_spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("_spans")).alias("spans"),
        F.array_join(F.transform("_spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def mask_personal(docs: DataFrame, least_score: float = 0.0) -> DataFrame:
    """``docs`` with every confirmed span of ``text`` replaced by its kind in brackets.

    Spans that overlap are replaced together, under the kind of the first.  A
    null text stays null; all other columns stay as they are, but for one named
    ``_spans`` or ``_hits``.  Repeated rows stay.
    """
    spans = F.filter("_spans", lambda s: s["score"] >= least_score)

    def areas(found: Column) -> Column:
        """Spans that overlap as one, from the first start to the last end."""

        def joined(before: Column) -> Column:
            def upto(i: Column) -> Column:
                return F.greatest(F.get(before, i), F.get(found, i)["end"])

            firsts = F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.get(found, i)["start"] >= F.get(before, i))

            def area(i: Column, no: Column, starts: Column) -> Column:
                last = F.coalesce(F.get(starts, no + 1), F.size(found)) - 1
                span = F.get(found, i)
                return F.struct(span["start"].alias("start"), upto(last).alias("end"), span["kind"].alias("kind"))

            return let(firsts, lambda starts: F.transform(starts, lambda i, no: area(i, no, starts)))

        return let(running(F.transform(found, lambda s: s["end"]), lambda a, e: F.greatest(a, e), F.lit(0)), joined)

    def end_before(found: Column, i: Column) -> Column:
        return F.when(i > 0, F.get(found, i - 1)["end"]).otherwise(F.lit(0))

    def masked_block(part: Column, found: Column, first: Column) -> Column:
        """Areas from ``first`` on, whose text is ``part``; it begins where the area before them ends."""
        base = end_before(found, first)

        def piece(i: Column) -> Column:
            area, begin = F.get(found, i), end_before(found, i)
            kept = F.substring(part, begin - base + 1, area["start"] - begin)
            return F.concat(kept, F.lit("["), F.upper(area["kind"]), F.lit("]"))

        last = F.least(first + _CHUNK, F.size(found)) - 1
        return F.array_join(F.transform(F.sequence(first, last), piece), "")

    def cut(text: Column, found: Column) -> Column:
        """Blocks of areas are cut out of the text first, and areas out of their block, as a cut reads all before it."""

        def block(first: Column) -> Column:
            begin, end = end_before(found, first), F.get(found, F.least(first + _CHUNK, F.size(found)) - 1)["end"]
            return let(F.substring(text, begin + 1, end - begin), lambda part: masked_block(part, found, first))

        blocks = F.transform(F.sequence(F.lit(0), F.size(found) - 1, F.lit(_CHUNK)), block)
        last = F.element_at(found, -1)["end"]
        return F.concat(F.array_join(blocks, ""), F.substring(text, last + 1, F.length(text)))

    found = find_personal(docs).withColumn("_hits", spans)
    masked = F.when(F.size("_hits") > 0, let(areas(F.col("_hits")), lambda a: cut(F.col("text"), a))).otherwise(F.col("text"))
    return found.withColumn("text", masked).select(*[F.col(f"`{c}`") for c in docs.columns])
