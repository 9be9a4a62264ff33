"""Secrets in texts, with DataFrame expressions only: no shuffle, each row by itself.

Three kinds are found by their form (assignments, access keys, runs of hexadecimal digits). Others are found by how
evenly their characters are spread: a candidate is a run of characters of one class, and a window slides over it. The
window's entropy follows from sum(c * log2(c)) over its characters' counts c, which one step changes by two counts: that of
the character that leaves and that of the one that comes. Windows of high entropy that touch are one span.
Candidates on the allow-list have no spans, nor have those that lie within a span found by form.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonalyze.llm.contamination import computed

#: Counted in 2^-20 bits, so that every engine adds them alike.
UNIT = 1 << 20
#: Spans are placed by running sums of lengths, so many at a time.
GROUP = 256


def either(word: str) -> str:
    """A pattern of a word in either case, ASCII letters alone."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The forms of secrets, and the least length of what they must hold.
ASSIGN = rf"""({"|".join(map(either, ("password", "passwd", "secret", "token", "api_?key")))})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
FORMS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX))
#: What a text holds that has any match of the kind: found faster than the form itself.
HINTS = {"assign": " OR ".join(f"contains(lower(t), '{w}')" for w in ("password", "passwd", "secret", "token", "api")), "access": "contains(t, 'AKIA')", "hex": "long"}


@dataclass(frozen=True)
class CharClass:
    """Runs of `chars` (of letters, digits and +/=_- ) that match all of `holds`; windows of `window` characters count from `bits` bits a character on."""

    name: str
    chars: str
    window: int
    bits: float
    holds: tuple[str, ...] = ()

    @property
    def most(self) -> int:
        """The greatest sum of c * log2(c) of a window that counts."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * UNIT)

    @property
    def steps(self) -> list[int]:
        """By how much the c-th of equal characters raises the sum."""
        value = [round(c * math.log2(c) * UNIT) if c else 0 for c in range(self.window + 1)]
        return [b - a for a, b in zip(value, value[1:])]


CLASSES = (
    CharClass("entropy_hex", "[0-9A-Fa-f]", 20, 3.0, ("[0-9]", "[A-Fa-f]")),
    CharClass("entropy_base64", "[0-9A-Za-z+/=_-]", 20, 3.8, ("[0-9]", "[a-z]", "[A-Z]")),
)
#: Documentation keys, alphabets, and digests that lock files print.
ALLOWED = ("EXAMPLE", "(?:0123456789|abcdefghijklm|ABCDEFGHIJKLM)", "^sha(?:1|256|384|512)-")


def text_literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(value: str, name: str, body: str) -> str:
    """body with a name for a value, which is computed once, however often lambdas in body read it."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def running(lengths: str) -> str:
    """Where each of the pieces begins whose lengths are given: sums within groups, then of the groups, so that a
    text with very many spans costs no square."""
    groups = f"transform(sequence(0, (size(sizes) - 1) div {GROUP}), g -> slice(sizes, g * {GROUP} + 1, {GROUP}))"
    sums = "aggregate({}, struct(0L AS at, CAST(array() AS ARRAY<BIGINT>) AS out), (s, n) -> struct(s.at + n AS at, concat(s.out, array(s.at)) AS out), s -> s.out)"
    inner = f"transform(parts, g -> {sums.format('g')})"
    outer = sums.format("transform(parts, g -> aggregate(g, 0L, (a, n) -> a + n))")
    return named(lengths, "sizes", named(groups, "parts", f"flatten(zip_with({inner}, {outer}, (g, at) -> transform(g, x -> x + at)))"))


def found(text: str, pattern: str, may: str = "true") -> str:
    """(start, match) of all matches: what lies between them tells where they are. may: a cheap condition that all
    texts with a match meet."""
    p = text_literal(pattern)
    none = "CAST(array() AS ARRAY<STRUCT<start: BIGINT, match: STRING>>)"
    # each match begins where the piece before it ends
    starts = running("zip_with(gaps, hits, (a, m) -> CAST(length(a) + coalesce(length(m), 0) AS BIGINT))")
    placed = f"zip_with(slice(gaps, 1, size(hits)), zip_with({starts}, hits, (at, m) -> struct(at, m)), (a, x) -> struct(length(a) + x.at AS start, x.m AS match))"
    all_of = named(f"split({text}, {p}, -1)", "gaps", named(f"regexp_extract_all({text}, {p}, 0)", "hits", f"slice({placed}, 1, size(hits))"))
    return f"CASE WHEN {may} AND {text} RLIKE {p} THEN {all_of} ELSE {none} END"


def high_windows(c: CharClass) -> str:
    """The runs (a, b) of x in which each character lies in a window of high entropy; chars: its characters."""
    w = c.window
    steps = f"array({', '.join(f'{v}L' for v in c.steps)})"
    kept = f"slice(chars, greatest(i - {w - 2}, 1), least(i, {w - 1}))"  # the window without the one that comes and the one that leaves
    alike = lambda at: f"size(filter(kept, y -> y = chars[{at}]))"
    total = f"s.total + {steps}[{alike('i')}] - IF(i >= {w}, {steps}[{alike(f'i - {w}')}], 0L)"
    start = "struct(0L AS total, -1 AS a, -1 AS b, CAST(array() AS ARRAY<STRUCT<a: INT, b: INT>>) AS out)"
    high = f"i >= {w - 1} AND t <= {c.most}"
    step = f"""IF(NOT ({high}), struct(t AS total, s.a AS a, s.b AS b, s.out AS out),
        IF(s.b >= i - {w - 1}, struct(t AS total, s.a AS a, i + 1 AS b, s.out AS out),
        struct(t AS total, i - {w - 1} AS a, i + 1 AS b, IF(s.b < 0, s.out, concat(s.out, array(struct(s.a AS a, s.b AS b)))) AS out)))"""
    body = named(kept, "kept", named(total, "t", step))
    runs = f"aggregate(sequence(0, size(chars) - 1), {start}, (s, i) -> {body}, s -> IF(s.b < 0, s.out, concat(s.out, array(struct(s.a AS a, s.b AS b)))))"
    return named("split(x.match, '')", "chars", runs)


def added(text: str, c: CharClass, allowed: tuple[str, ...], may: str) -> str:
    """Spans (start, end) of one class by entropy."""
    fits = " AND ".join([f"x.match RLIKE {text_literal(p)}" for p in c.holds] + [f"NOT x.match RLIKE {text_literal(p)}" for p in allowed] or ["true"])
    spans = f"transform({high_windows(c)}, r -> struct(x.start + r.a AS start, x.start + r.b AS end))"
    return f"flatten(transform(filter({found(text, c.chars + '{' + str(c.window) + ',}', may)}, x -> {fits}), x -> {spans}))"


def find_secrets(docs: DataFrame, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id, base, added: arrays of (kind, start, end, secret), by start and then in the order of the kinds. base: by form;
    added: by entropy, which lie in none of these. start and end count code points, end exclusive.

    docs has doc_id and text; other columns are not read. Null and empty texts have none. Rows that share a doc_id, or have
    none, are texts of their own: each row of docs gives one row. Spans of different kinds may overlap.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    shortest = min([int(re.search(r"\d+,", HEX)[0][:-1]), *(c.window for c in classes)])
    texts = computed(texts, "long", F.expr(f"t RLIKE '[0-9A-Za-z+/=_-]{{{shortest}}}'"))
    end = "x.start + length(x.match)"
    parts = []
    for k, (name, pattern) in enumerate(FORMS):
        keep = f"length(regexp_extract(x.match, {text_literal(pattern)}, 2)) >= {ASSIGN_VALUE}" if name == "assign" else "true"
        parts.append(f"transform(filter({found('t', pattern, '(' + HINTS[name] + ')')}, x -> {keep}), x -> struct(x.start AS start, {k} AS k, {end} AS end, x.match AS secret))")
    by_form = computed(texts, "base", F.expr(f"array_sort(concat({', '.join(parts)}))"))
    more = [f"transform({added('t', c, allowed, 'long')}, x -> struct(x.start AS start, {len(FORMS) + k} AS k, x.end AS end, substring(t, CAST(x.start + 1 AS INT), CAST(x.end - x.start AS INT)) AS secret))" for k, c in enumerate(classes)]
    none = "CAST(array() AS ARRAY<STRUCT<start: BIGINT, k: INT, end: BIGINT, secret: STRING>>)"
    own = f"filter({'concat(' + ', '.join(more) + ')' if more else none}, x -> NOT exists(base, b -> b.start <= x.start AND x.end <= b.end))"
    names = "array(" + ", ".join(f"'{n}'" for n in [*(n for n, _ in FORMS), *(c.name for c in classes)]) + ")"
    shown = lambda spans: f"transform({spans}, x -> struct({names}[x.k] AS kind, x.start AS start, x.end AS end, x.secret AS secret))"
    both = computed(by_form, "more", F.expr(f"array_sort({own})"))
    return both.select("doc_id", F.expr(shown("base")).alias("base"), F.expr(shown("more")).alias("added"))


def listed(spans: Column | str) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def in_order(base: str, added: str, classes: tuple[CharClass, ...] = CLASSES) -> Column:
    """Both arrays of spans as one, by start and then in the order of the kinds."""
    kinds = "array(" + ", ".join(f"'{n}'" for n in [*(n for n, _ in FORMS), *(c.name for c in classes)]) + ")"
    keyed = f"transform(concat({base}, {added}), x -> struct(x.start AS start, array_position({kinds}, x.kind) AS k, x AS span))"
    return F.expr(f"transform(array_sort({keyed}), y -> y.span)")
