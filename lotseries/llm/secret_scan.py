"""Secret scan with DataFrame functions only: rules, and sliding-window entropy per character class.

Rules find assignments, access keys and hex digests. Beside them, runs of one character class
(hex, base64) are candidates; a window of fixed length slides over a candidate and keeps
``sum(c * log2 c)`` of its character counts up to date as one character leaves and one enters, so
the entropy of every window costs the same. A candidate whose best window reaches the threshold
of its class is reported, unless the allow-list names it or a rule has reported a part of it.

Defined results: null and empty texts have no spans and the digest of the empty string; repeated
rows are scanned one by one; null ids are kept. All offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules, with the group that is measured and its least length.
RULES = [
    (
        "assign",
        "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]


@dataclass(frozen=True)
class CharacterClass:
    kind: str
    pattern: str  # maximal runs of the class
    window: int
    least_bits: float
    must: tuple[str, ...]  # a candidate holds a match of each


CLASSES = [
    CharacterClass(
        "entropy_hex", r"(?<![0-9A-Za-z])[0-9A-Za-z]{20,}+", 20, 2.9, ("^[0-9A-Fa-f]+$", "[0-9]", "[A-Fa-f]")
    ),
    CharacterClass(
        "entropy_base64",
        r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+",
        20,
        3.85,
        ("[0-9]", "[a-z]", "[A-Z]"),
    ),
]

# Candidates that hold one of these are no secrets: placeholders, alphabets, unique ids.
ALLOWED = [
    r"(?i)example|placeholder|changeme|your[-_]",
    r"(?i)0123456789|abcdefgh",
    r"(?i)(^|[^0-9a-f])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}([^0-9a-f]|$)",
]

# Matches whose starts are summed up in one go; a text may hold any number of them.
BLOCK = 256


def _last(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


MATCH = "struct<start:int,end:int,value:string,measured:string>"


def _fold(items: Column, at: Column, step, kind: str) -> Column:
    """Rows that a fold over ``items`` leaves behind: ``step(at, item)`` gives the next ``at`` and an array of rows.

    Rows are gathered block by block, so the work stays near linear in the items. ``items`` is computed once.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(state: Column, item: Column) -> Column:
        after, rows = step(state["at"], item)
        return F.struct(after.alias("at"), F.concat(state["out"], rows).alias("out"))

    def folded(held: Column) -> Column:
        def block(state: Column, b: Column) -> Column:
            inner = F.aggregate(
                F.slice(held, b * BLOCK + 1, F.lit(BLOCK)), F.struct(state["at"].alias("at"), none.alias("out")), one
            )
            return _last(
                inner,
                lambda x: F.struct(x["at"].alias("at"), F.concat(state["out"], F.array(x["out"])).alias("out")),
            )

        blocks = F.sequence(F.lit(0), ((F.size(held) - 1) / BLOCK).cast("int"))
        start = F.struct(at.alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.when(F.size(held) > 0, F.flatten(F.aggregate(blocks, start, block)["out"])).otherwise(none)

    return _last(items, folded)


def _places(text: Column, pattern: str, group: int) -> Column:
    """Array of ``(start, end, value, measured)`` of the leftmost non-overlapping matches.

    What lies between the matches and the matches themselves alternate, so starts are running
    sums of their lengths.
    """
    regex = F.lit(pattern)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    part = F.regexp_extract_all(text, regex, F.lit(group)) if group else whole
    steps = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x)).alias("gap"),
        whole.alias("value"),
        part.alias("measured"),
    )
    # behind the last gap there is no match
    found = _last(steps, lambda x: F.slice(x, 1, F.size(x) - 1))

    def step(at: Column, item: Column) -> tuple[Column, Column]:
        start = at + item["gap"]
        end = start + F.char_length(item["value"])
        row = F.struct(
            start.alias("start"), end.alias("end"), item["value"].alias("value"), item["measured"].alias("measured")
        )
        return end, F.array(row)

    return _fold(found, F.lit(0), step, MATCH)


def _apart(matches: Column, base: Column) -> Column:
    """The matches that overlap none of the ``base`` spans.

    Spans by their start and matches by their end are put in one order; a match is free if no
    span that starts before its end ends behind its start.
    """
    spans = F.transform(
        base,
        lambda b: F.struct(
            b["start"].alias("key"), F.lit(1).alias("turn"), b["end"].alias("until"), F.lit(None).cast(MATCH).alias("match")
        ),
    )
    asked = F.transform(
        matches,
        lambda m: F.struct(m["end"].alias("key"), F.lit(0).alias("turn"), m["start"].alias("until"), m.alias("match")),
    )

    def step(at: Column, item: Column) -> tuple[Column, Column]:
        free = (item["turn"] == 0) & (at <= item["until"])
        rows = F.when(free, F.array(item["match"])).otherwise(F.array().cast(f"array<{MATCH}>"))
        return F.when(item["turn"] == 1, F.greatest(at, item["until"])).otherwise(at), rows

    ordered = F.array_sort(F.concat(spans, asked))
    return F.when((F.size(base) == 0) | (F.size(matches) == 0), matches).otherwise(_fold(ordered, F.lit(0), step, MATCH))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """As ``_places``; texts without a match, nearly all, are searched once."""
    none = F.array().cast(f"array<{MATCH}>")
    return F.when(text.rlike(pattern), _places(text, pattern, group)).otherwise(none)


def _bits(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def best_window_bits(value: Column, window: int) -> Column:
    """Largest Shannon entropy, in bits a character, of the windows of ``value``.

    ``value`` has at least ``window`` characters. The state is ``sum(c * log2 c)`` over the counts
    of the window; a step looks only at the counts of the character that leaves and of the one that enters.
    """
    return _last(F.split(value, ""), lambda chars: _best_window_bits(chars, window))


def _best_window_bits(chars: Column, window: int) -> Column:
    def step(state: Column, i: Column) -> Column:
        kept = F.slice(chars, F.greatest(i - window + 1, F.lit(1)), F.least(i - 1, F.lit(window - 1)))
        count = lambda c: F.size(F.filter(kept, lambda x: x == c))
        enters, leaves = count(F.element_at(chars, i)), count(F.element_at(chars, F.greatest(i - window, F.lit(1))))
        gone = F.when(i > window, _bits(leaves + 1) - _bits(leaves)).otherwise(F.lit(0.0))
        total = state["total"] - gone + _bits(enters + 1) - _bits(enters)
        return _last(
            total,
            lambda t: F.struct(
                t.alias("total"), F.when(i >= window, F.least(state["least"], t)).otherwise(state["least"]).alias("least")
            ),
        )

    # A window is full of entropy where the sum is least.
    start = F.struct(F.lit(0.0).alias("total"), F.lit(math.inf).alias("least"))
    folded = F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step)
    return F.lit(math.log2(window)) - folded["least"] / window


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``extra``: arrays of ``(start, rank, end, kind)``, sorted.

    ``base`` has what the rules find, ``extra`` what the entropy windows add. Columns of ``docs``
    of these names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("base", "extra")]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kinds = [rule[0] for rule in RULES] + [c.kind for c in CLASSES]

    def span(x: Column, kind: str) -> Column:
        return F.struct(
            x["start"].alias("start"),
            F.lit(kinds.index(kind)).alias("rank"),
            x["end"].alias("end"),
            F.lit(kind).alias("kind"),
        )

    def rule(kind: str, pattern: str, group: int, least: int) -> Column:
        matches = _matches(F.col("__body"), pattern, group)
        return F.transform(F.filter(matches, lambda x: F.char_length(x["measured"]) >= least), lambda x: span(x, kind))

    found = docs.select(*[F.col(f"`{c}`") for c in kept], body.alias("__body"))
    for kind, pattern, group, least in RULES:
        found = found.withColumn(f"__{kind}", rule(kind, pattern, group, least))
    found = found.withColumn("base", F.array_sort(F.concat(*[F.col(f"__{rule[0]}") for rule in RULES])))

    def good(c: CharacterClass):
        def check_all(x: Column) -> Column:
            value = x["value"]
            result = F.lit(True)
            for check in [value.rlike(m) for m in c.must] + [~value.rlike(a) for a in ALLOWED]:
                result = result & check
            return F.when(result, best_window_bits(value, c.window) >= c.least_bits).otherwise(False)

        return check_all

    def added(c: CharacterClass) -> Column:
        apart = _last(_matches(F.col("__body"), c.pattern), lambda m: _apart(m, F.col("base")))
        return F.transform(F.filter(apart, good(c)), lambda x: span(x, c.kind))

    found = found.withColumn("extra", F.array_sort(F.concat(*map(added, CLASSES))))
    return found.select(*[F.col(f"`{c}`") for c in kept], "base", "extra")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint")
