"""Personal data by candidate gradient boosting, in DataFrame functions only.

Four base patterns (email, ip, card, phone) with their checks always count.
Beside them, generators of high recall propose spans that may overlap: spelled
out or spaced addresses, octets with commas, digit groups with other
separators, numbers without a country code in any national grouping. Boosted
trees score a proposal by its format and the words before it. They are fitted on
proposals of all documents: one that a base span of its kind overlaps is a
positive; a decoy is a negative, which is one that fails a check of its kind
(Luhn, octets, the number of digits, a domain of letters), stands in a date or a
span of another kind, or behind words such as "order" or "isbn". The others are
neither, however many there are, so a source full of unconfirmed data does not
turn the trees against it. Decoys are never accepted. The features leave out what the base patterns insist on (the at sign, the plus), so
proposals that look like the confirmed ones in everything else score alike.
Features are yes or no, so Spark counts proposals by feature pattern, at most
``2 ** len(FEATURES)`` rows whatever the input, and the trees are fitted on
these counts. The threshold of each kind is the least score from which on the
positives' share, in score order, stays at ``precision`` or above.

Patterns have no nested repetition that backtracks: inner repetitions are
possessive, and a run of characters is entered at its start only, so a long run
is read once.

Defined cases: null and empty texts hold nothing; a table without proposals
has no trees and only base spans; repeated rows get a row each; null ids stay
null; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")

#: The base patterns, with possessive repetition where no shorter
#: repetition can match, and a look at the character before.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Generators of proposals.
PROPOSED = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.,])[0-9]{1,3}(?:[.,] ?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ ._-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:(?:\+|00)[0-9]{1,3}[ .-]?)?"
    r"(?:\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}|(?:\([0-9]{1,5}\)[ ./-]?|[0-9]{2,5}[ ./-])[0-9]{2,8}(?:[ ./-][0-9]{2,8}){1,3})(?![0-9])",
}
#: What a text must hold for a pattern of the kind to be tried.
NEEDED = {"email": r"@|\(at\)|\[at\]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}

CONTEXT_CHARS = 24
_HINT = r"(?i)mail|contact|tel|phone|fon|fax|call|mobil|card|visa|credit|karte|carte|tarjeta|addr|host|server|\bip\b"


def digits(column: Column) -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the sum of digits, every second from the right doubled, is a
    multiple of ten."""
    each = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1))),
        lambda i: F.coalesce(F.try_to_number(F.substring(number, i, F.lit(1)), F.lit("9")).cast("int"), F.lit(0))
        * F.when((F.length(number) - i) % 2 == 1, 2).otherwise(1),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0


def octets(match: Column, separator: str) -> Column:
    """All parts at most 255, however long; leading zeros do not count."""
    parts = F.split(match, separator)
    return F.forall(parts, lambda p: F.regexp_replace(p, "^ ?0*", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _digit_count(match: Column, low: int, high: int) -> Column:
    return F.length(digits(match)).between(low, high)


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: octets(m, r"\."),
    "card": lambda m: _digit_count(m, 14, 19) & luhn(digits(m)),
    "phone": lambda m: _digit_count(m, 10, 15),
}

_NAMED = r"(?i)\b(?:order|invoice|ref|isbn|issn|version|build|sku|item|page|tracking|serial|article)\b(?:[^A-Za-z0-9]*(?:no|nr|number|id|code)\b)?[^A-Za-z0-9]*$"
_DATED = r"^(?:(?:19|20)[0-9]{2}[./ -][01]?[0-9][./ -]|[0-3]?[0-9][./-][01]?[0-9][./-](?:19|20)[0-9]{2})"

#: What a proposal of the kind is not (its match, the text before it).
DECOYS: dict[str, Callable[[Column, Column], Column]] = {
    "email": lambda m, before: ~m.rlike("[A-Za-z]{2,}$"),
    "ip": lambda m, before: ~octets(m, "[.,]"),
    "card": lambda m, before: ~(_digit_count(m, 14, 19) & luhn(digits(m))),
    "phone": lambda m, before: ~_digit_count(m, 10, 15) | before.rlike("[A-Za-z0-9.,]$") | m.rlike(_DATED),
}

#: Yes or no features of a proposal (its match, the text before it).
FEATURES: dict[str, Callable[[Column, Column, str], Column]] = {
    "email": lambda m, before, kind: F.lit(kind == "email"),
    "ip": lambda m, before, kind: F.lit(kind == "ip"),
    "card": lambda m, before, kind: F.lit(kind == "card"),
    "hint": lambda m, before, kind: before.rlike(_HINT),
    "glued": lambda m, before, kind: before.rlike("[A-Za-z0-9]$"),
    "luhn": lambda m, before, kind: luhn(digits(m)),
    "number": lambda m, before, kind: _digit_count(m, 10, 15),
    "long": lambda m, before, kind: _digit_count(m, 14, 19),
    "octets": lambda m, before, kind: octets(m, "[.,]"),
    "grouped": lambda m, before, kind: m.rlike("[0-9][ .)_-]+[0-9]"),
    "domain": lambda m, before, kind: m.rlike("[A-Za-z]{2,}$"),
}


def matches(text: Column, kind: str, pattern: str) -> Column:
    """Leftmost matches that do not overlap, as an array of (start, kind, end,
    match, before); places in code points, ``kind`` its place in KINDS."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.aggregate(
        F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct(b.alias("b"), m.alias("m"))),
        F.struct(
            F.lit(0).alias("at"),
            F.array().cast("array<struct<start:int,kind:int,end:int,match:string,before:string>>").alias("spans"),
        ),
        lambda acc, x: F.struct(
            (acc.at + F.length(x.b) + F.length(x.m)).alias("at"),
            F.concat(
                acc.spans,
                F.array(
                    F.struct(
                        (acc.at + F.length(x.b)).alias("start"),
                        F.lit(KINDS.index(kind)).alias("kind"),
                        (acc.at + F.length(x.b) + F.length(x.m)).alias("end"),
                        x.m.alias("match"),
                        F.right(x.b, F.lit(CONTEXT_CHARS)).alias("before"),
                    )
                ),
            ).alias("spans"),
        ),
        lambda acc: acc.spans,
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int,match:string,before:string>>")
    return F.when(text.rlike(NEEDED[kind]), start).otherwise(none)


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end")))


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end), by start, then kind."""
    def checked(kind: str) -> Column:
        return F.filter(matches(text, kind, BASE[kind]), lambda s: CHECKS[kind](s.match))

    each = [checked(kind) for kind in KINDS]
    return F.array_sort(_plain(F.concat(*each)))


def proposals(text: Column, base: str) -> Column:
    """Array of (start, kind, end, code, known, decoy): the features as bits,
    whether a base span of the kind overlaps, and whether it is a decoy."""

    def proposed(number: int, kind: str) -> Column:
        def described(s: Column) -> Column:
            bits = [
                F.when(feature(s.match, s.before, kind), 1 << i).otherwise(0)
                for i, feature in enumerate(FEATURES.values())
            ]
            overlaps = F.exists(F.col(base), lambda b: (b.kind == number) & (b.start < s.end) & (b.end > s.start))
            taken = F.exists(F.col(base), lambda b: (b.kind != number) & (b.start < s.end) & (b.end > s.start))
            decoy = DECOYS[kind](s.match, s.before) | s.before.rlike(_NAMED) | taken
            return F.struct(
                s.start.alias("start"),
                s.kind.alias("kind"),
                s.end.alias("end"),
                sum(bits, F.lit(0)).alias("code"),
                overlaps.alias("known"),
                decoy.alias("decoy"),
            )

        return F.transform(matches(text, kind, PROPOSED[kind]), described)

    each = [proposed(number, kind) for number, kind in enumerate(KINDS)]
    return F.concat(*each)


def spans_found(docs: DataFrame, base: str = "base_spans", proposed: str = "proposals") -> DataFrame:
    """``docs`` with two columns more, which must not be theirs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn(base, base_spans(text)).withColumn(proposed, proposals(text, base))


def _unused(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


@dataclass
class Trees:
    """Boosted trees of depth two over feature bits; a tree is (bit, (bit,
    no, yes), (bit, no, yes)). ``thresholds`` by kind: None accepts nothing."""

    start: float
    trees: list[tuple]
    thresholds: list[float | None]

    def margin(self, code: int) -> float:
        out = self.start
        for bit, no, yes in self.trees:
            b, low, high = yes if code >> bit & 1 else no
            out += high if code >> b & 1 else low
        return out

    def margin_column(self, code: Column) -> Column:
        has = lambda bit: code.bitwiseAND(F.lit(1 << bit)) != 0
        out = F.lit(self.start)
        for bit, no, yes in self.trees:
            leaf = lambda side: F.when(has(side[0]), side[2]).otherwise(side[1])
            out = out + F.when(has(bit), leaf(yes)).otherwise(leaf(no))
        return out

    def accepts(self, kind: Column, code: Column) -> Column:
        least = F.array(*[F.lit(t).cast("double") for t in self.thresholds])
        return F.coalesce(self.margin_column(code) >= F.get(least, kind), F.lit(False))


def fit(
    counts: list[tuple[int, int, int, int]], *, rounds: int = 20, rate: float = 0.4, precision: float = 0.9
) -> Trees:
    """Fit on (kind, code, proposals, positives) by Newton steps of the
    logistic loss; thresholds by kind from the counts' score order."""
    n, yes = sum(c[2] for c in counts), sum(c[3] for c in counts)
    start = math.log((yes + 1) / (n - yes + 1)) if n else 0.0
    model = Trees(start, [], [None] * len(KINDS))
    bits = range(len(FEATURES))
    margins = [start] * len(counts)

    def gain(rows: list[int], g: list[float], h: list[float]) -> float:
        return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + 1)

    def best(rows: list[int], g: list[float], h: list[float]) -> int:
        parts = {b: ([i for i in rows if not counts[i][1] >> b & 1], [i for i in rows if counts[i][1] >> b & 1]) for b in bits}
        return max(bits, key=lambda b: (gain(parts[b][0], g, h) + gain(parts[b][1], g, h), -b))

    for _ in range(rounds if n else 0):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g = [c[3] - c[2] * q for c, q in zip(counts, p, strict=True)]
        h = [c[2] * q * (1 - q) for c, q in zip(counts, p, strict=True)]
        everything = list(range(len(counts)))
        root = best(everything, g, h)
        sides = []
        for want in (0, 1):
            rows = [i for i in everything if counts[i][1] >> root & 1 == want]
            bit = best(rows, g, h) if rows else root
            leaves = []
            for value in (0, 1):
                part = [i for i in rows if counts[i][1] >> bit & 1 == value]
                leaves.append(rate * sum(g[i] for i in part) / (sum(h[i] for i in part) + 1))
            sides.append((bit, *leaves))
        model.trees.append((root, *sides))
        margins = [model.margin(c[1]) for c in counts]
    for kind in range(len(KINDS)):
        total = good = 0
        for m, c in sorted(((m, c) for m, c in zip(margins, counts, strict=True) if c[0] == kind), reverse=True):
            total, good = total + c[2], good + c[3]
            if good >= precision * total:
                model.thresholds[kind] = m - 1e-9
            else:
                break
    return model


def fit_trees(found: DataFrame, proposed: str = "proposals", **how) -> Trees:
    """Count the confirmed proposals and the decoys of ``found`` by kind and
    feature pattern and fit."""
    counts = (
        found.select(F.explode(proposed).alias("p"))
        .where("p.known OR p.decoy")
        .groupBy("p.kind", "p.code")
        .agg(F.count("*").alias("n"), F.sum(F.col("p.known").cast("long")).alias("known"))
        .orderBy("kind", "code")
        .collect()  # at most kinds * 2 ** features
    )
    return fit([tuple(r) for r in counts], **how)


def all_spans(trees: Trees, base: str = "base_spans", proposed: str = "proposals") -> Column:
    """Base spans and the accepted proposals that no base span of their kind
    overlaps, each once, by start, then kind."""
    added = F.filter(proposed, lambda s: ~s.known & ~s.decoy & trees.accepts(s.kind, s.code))
    return F.array_sort(F.array_distinct(F.concat(F.col(base), _plain(added))))


def digest(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))),
        ",",
    )


def find(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """(doc_id, n_<kind> of base spans, base_sha256, spans) of every text."""
    found = spans_found(docs.select(F.col("doc_id").cast("long"), "text")).drop("text")
    found = materialize(spark, found, "pii-spans")  # spans only: small beside the texts
    trees = fit_trees(found, **how)
    def count(i: int) -> Column:
        return F.size(F.filter("base_spans", lambda s: s.kind == i)).cast("long").alias(f"n_{KINDS[i]}")

    return found.select(
        "doc_id",
        *[count(i) for i in range(len(KINDS))],
        F.sha2(digest(F.col("base_spans")), 256).alias("base_sha256"),
        digest(all_spans(trees)).alias("spans"),
    )


def redact(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with every span of a text replaced by its kind in brackets;
    spans that overlap become one. All columns stay as they are otherwise."""
    base, proposed = _unused(docs, "base_spans"), _unused(docs, "proposals")
    return _replaced(spans_found(docs, base, proposed), docs.columns, trees, base, proposed)


def redacted(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """``redact`` with trees fitted on the documents themselves; their spans are
    looked for once and written beside them."""
    base, proposed = _unused(docs, "base_spans"), _unused(docs, "proposals")
    found = materialize(spark, spans_found(docs, base, proposed), "pii-found")
    return _replaced(found, docs.columns, fit_trees(found, proposed, **how), base, proposed)


def _replaced(found: DataFrame, columns: list[str], trees: Trees, base: str, proposed: str) -> DataFrame:
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    spans = _unused(found, "spans")
    found = found.withColumn(spans, all_spans(trees, base, proposed))
    text = F.col("text")
    done = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            s.start >= acc.at,
            F.struct(
                s.end.alias("at"),
                F.concat(acc.out, F.substring(text, acc.at + 1, s.start - acc.at), F.get(names, s.kind)).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(s.end, acc.at).alias("at"), acc.out.alias("out"))),
        lambda acc: F.concat(acc.out, F.substring(text, acc.at + 1, F.length(text))),
    )
    replaced = F.when(F.size(spans) > 0, done).otherwise(text)
    return found.withColumn("text", replaced).select(*["`" + c.replace("`", "``") + "`" for c in columns])
