"""Personal data: patterns propose spans, checksums confirm them, nearby
words adjust the score. Built-in column functions only.

Each kind is searched over the whole text, leftmost and non-overlapping.
The text is split at the matches; since pieces and matches alternate, their
lengths give the positions (code points), and the ends of the neighbouring
pieces are a match's context. Patterns are written without backtracking
into repeated groups (possessive quantifiers, and a look-behind that keeps
a search from starting again inside a run that has failed), so they take
linear time and no stack on very long runs; they match what the plain
patterns of the contract match.

Kinds ``email``, ``ip``, ``card`` (Luhn) and ``phone`` are kept whenever
their check passes. Kinds ``iban`` (mod 97), ``national_id`` and ``secret``
are added where checksum and context bring the score to ``THRESHOLD``.

Everything is row-local: no shuffle, no Python, one row at a time in memory.

Defined cases: a null text is empty and has no spans; null and repeated ids
are passed through; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from copse.llm.expressions import let, total

THRESHOLD = 0.7
#: Code points before and after a match that count as near.
NEAR_BEFORE, NEAR_AFTER = 40, 20
BLOCK = 256

_MAIL = "A-Za-z0-9._%+-"


@dataclass(frozen=True)
class Kind:
    name: str
    #: A cheap necessary condition, as a pattern for ``rlike``.
    hint: str
    pattern: str
    check: Callable[[Column], Column] | None
    #: Score without and with a context word.
    score: float
    with_context: float
    words: str
    base: bool


def running_sums(steps: Column) -> Column:
    """Inclusive sums of an array of longs; blocks keep the copying linear."""
    n_blocks = F.ceil(F.size(steps) / BLOCK).cast("int")
    zero = F.array(F.lit(0).cast("long"))
    grow = lambda xs: F.aggregate(xs, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    blocks = F.transform(F.sequence(F.lit(0), n_blocks - 1),
                         lambda b: grow(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
    return let(blocks, lambda inner: let(
        grow(F.transform(inner, lambda s: F.element_at(s, -1))),
        lambda outer: F.flatten(F.transform(
            inner, lambda s, b: F.transform(F.slice(s, F.lit(2), F.size(s)), lambda x: x + F.get(outer, b))))))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def numbers(text: Column, codes: Callable[[Column], Column]) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: codes(F.substring(text, i, F.lit(1))))


def luhn(number: Column) -> Column:
    """Doubling every second digit from the right makes a multiple of ten."""
    values = numbers(F.reverse(number), lambda c: c.cast("int"))
    weighed = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return total(weighed, F.lit(0)) % 10 == 0


def mod97(number: Column) -> Column:
    """First four characters moved to the end, letters as 10 to 35: rest 1."""
    moved = F.concat(F.substring(number, F.lit(5), F.length(number)), F.substring(number, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(numbers(moved, value), F.lit(0), lambda acc, d:
                       (acc * F.when(d > 9, 100).otherwise(10) + d) % 97)
    return rest == 1


def is_card(value: Column) -> Column:
    return let(digits(value), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))


def is_ip(value: Column) -> Column:
    part = lambda p: let(F.regexp_replace(p, "^0+", ""), lambda s:
                         F.when(F.length(s) <= 3, F.coalesce(s.try_cast("int"), F.lit(0)) <= 255).otherwise(False))
    return F.forall(F.split(value, "[.]"), part)


def is_phone(value: Column) -> Column:
    return F.length(digits(value)).between(9, 15)


def is_iban(value: Column) -> Column:
    return let(F.replace(value, F.lit(" "), F.lit("")), lambda d:
               F.when(F.length(d).between(15, 34), mod97(d)).otherwise(False))


KINDS = (
    Kind("email", "@", rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         None, 0.8, 1.0, "mail|contact|write|an:|from", True),
    Kind("ip", r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         is_ip, 0.7, 1.0, r"\bip\b|host|server|address|adresse|login", True),
    Kind("card", "[0-9][ -]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++",
         is_card, 0.8, 1.0, "card|visa|credit|karte|carte|tarjeta", True),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]",
         is_phone, 0.8, 1.0, "phone|tel|call|mobil|fax", True),
    Kind("iban", "[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
         is_iban, 0.8, 1.0, "iban|account|konto|compte|cuenta|bank", False),
    Kind("national_id", "[0-9]-[0-9]{2}-[0-9]", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         None, 0.4, 0.9, "ssn|social|security|tax|insurance", False),
    Kind("secret", "[0-9a-f]{32}", r"(?<![0-9A-Za-z])[0-9a-f]{32,128}+(?![0-9A-Za-z])",
         None, 0.4, 0.9, "token|secret|passw|api.?key|credential", False),
)
BASE = tuple(k.name for k in KINDS if k.base)


def spans_of(text: Column, kind: Kind) -> Column:
    """Array of (kind, start, end, score) in order; ``text`` must not be null."""
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")

    def place(found: Column) -> Column:
        return let(F.split(text, kind.pattern, -1), lambda pieces: let(
            running_sums(F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, v:
                                    (F.length(p) + F.length(v)).cast("long"))),
            lambda ends: F.transform(found, lambda v, i: F.struct(
                F.lit(kind.name).alias("kind"), (F.get(ends, i) - F.length(v)).alias("start"),
                F.get(ends, i).alias("end"), score(v, F.get(pieces, i), F.get(pieces, i + 1)).alias("score")))))

    def score(value: Column, before: Column, after: Column) -> Column:
        context = F.lower(F.concat_ws(" ", F.substring(before, -NEAR_BEFORE, NEAR_BEFORE),
                                      F.substring(after, 1, NEAR_AFTER)))
        found = F.when(context.rlike(kind.words), kind.with_context).otherwise(kind.score)
        return found if kind.check is None else F.when(kind.check(value), found).otherwise(0.0)

    least = 0.0 if kind.base else THRESHOLD
    scored = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda found:
                 F.when(F.size(found) > 0, place(found)).otherwise(empty))
    passed = F.filter(scored, lambda s: (s.score > 0) & (s.score >= least))
    return F.when(text.rlike(kind.hint), passed).otherwise(empty)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id and, for each kind, an array of its spans."""
    body = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    return body.select("doc_id", *[spans_of(F.col("text"), k).alias(k.name) for k in KINDS])


def listed(*kinds: str) -> Column:
    """``kind:start:end`` of the spans, by kind as given, then start."""
    return F.array_join(F.transform(F.concat(*kinds), lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; overlapping
    spans become one, named by the first. Other columns stay as they are; a
    null text stays null."""
    body = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"),
                       F.coalesce(docs[text], F.lit("")).alias("_text"))
    found = body.select("_doc", "_text", F.array_sort(F.concat(*[spans_of(F.col("_text"), k) for k in KINDS]),
                                                      _by_start).alias("_spans"))
    clean = F.when(F.size("_spans") == 0, F.col("_doc")[text]).otherwise(_masked(F.col("_text"), F.col("_spans")))
    return found.select(*[clean.alias(c) if c == text else F.col("_doc").getField(c).alias(c) for c in docs.columns])


def _by_start(a: Column, b: Column) -> Column:
    return F.when(a.start != b.start, F.signum(a.start - b.start).cast("int")) \
        .otherwise(F.signum(b.end - a.end).cast("int"))


def _masked(text: Column, spans: Column) -> Column:
    """Each span adds the text since the farthest end before it, and a tag
    where it does not overlap what came before."""
    farthest = F.aggregate(spans, F.array(F.lit(0).cast("long")), lambda acc, s: F.concat(
        acc, F.array(F.greatest(F.element_at(acc, -1), s.end))))
    return let(farthest, lambda far: F.concat(
        F.array_join(F.transform(spans, lambda s, i: F.when(
            (s.start >= F.get(far, i)),
            F.concat(F.substring(text, (F.get(far, i) + 1).cast("int"), (s.start - F.get(far, i)).cast("int")),
                     F.lit("["), s.kind, F.lit("]"))).otherwise("")), ""),
        F.substring(text, (F.element_at(far, -1) + 1).cast("int"), F.length(text))))
