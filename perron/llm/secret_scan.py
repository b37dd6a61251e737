"""Secret scans: patterns and sliding-window entropy of candidate strings, in DataFrame functions only.

Candidate strings are maximal runs of a character class. A window of fixed length slides
over each; its character counts, and with them c * log2(c) summed over characters, change by
the one that enters and the one that leaves. Sums are integers (2**-20 bit), so a
verdict does not depend on rounding. Candidates on the allow-list are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 1 << 20
# Windows (and matches) that are handled together; work per row grows with their number, not its square.
BLOCK = 256


def either_case(word: str) -> str:
    """A pattern for ``word`` in which ASCII letters match in either case, and nothing else does."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Pattern:
    """Leftmost matches that do not overlap, kept if ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int
    group: int = 0


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``letters``; windows with at least ``bits`` of entropy per character are reported.

    Upper case counts as lower case if ``fold``.
    """

    kind: str
    letters: str
    alphabet: str
    window: int
    bits: float
    fold: bool = False

    def candidates(self) -> str:
        return f"[{self.letters}]{{{self.window},}}"

    def gains(self) -> list[int]:
        """c * log2(c) for every count."""
        return [round(c * math.log2(c) * UNIT) if c else 0 for c in range(self.window + 1)]

    def limit(self) -> int:
        """A window of w characters has entropy log2(w) - sum / w; at most this sum is enough."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * UNIT)


ASSIGN = "(" + "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = (
    Pattern("assign", ASSIGN, 12, 2),
    # as + with a length afterwards: a run's first AKIA has the most characters behind it
    Pattern("access", "AKIA[A-Z0-9]{14,}", 18),
    Pattern("hex", "[0-9a-f]{16,}", 16),
)
HEX = "0123456789abcdef"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharacterClass("digits16", "0-9A-Fa-f", HEX, 32, 3.0, fold=True),
    CharacterClass("digits64", r"A-Za-z0-9+/_-", LETTERS + "0123456789+/_-", 24, 3.9),
)
#: Candidates that hold one of these are no secrets: identifiers of public things, words, placeholders, alphabets.
ALLOWED = (
    "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    # every part begins with what cannot end the one before it, so there is one way to match
    "^[A-Z]?[a-z]+(?:[_/+-][A-Z]?[a-z]+|[A-Z][a-z]+)*$",
    either_case("example"),
    either_case("placeholder"),
    "0123456789",
    "abcdefghij",
    "ABCDEFGHIJ",
)


def running_starts(lengths: Column) -> Column:
    """The sum of all elements before each one; in blocks, so that the work is not quadratic."""
    blocks = F.ceil(F.size(lengths) / BLOCK).cast("int")

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda s, x: s + x)

    def block(b: Column) -> Column:
        own = F.slice(lengths, b * BLOCK + 1, BLOCK)
        return F.struct(own.alias("own"), total(own).alias("sum"))

    def starts(one: Column, b: Column, all_blocks: Column) -> Column:
        before = total(F.transform(F.slice(all_blocks, 1, b), lambda x: x["sum"]))
        within = F.aggregate(one["own"], F.array(before), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)))
        return F.slice(within, 1, F.size(one["own"]))

    numbers = F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>"))
    # a one-element array binds the blocks, so that they are made once
    return F.flatten(F.flatten(F.transform(F.array(F.transform(numbers, block)), lambda bs: F.transform(bs, lambda one, b: starts(one, b, bs)))))


def _with_matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds ``<name>_found`` (array of matched strings) and ``<name>_at`` (their starts, in code points)."""
    found, pieces, at = f"{name}_found", f"{name}_pieces", f"{name}_at"
    df = df.withColumn(found, F.regexp_extract_all("scan_text", F.lit(pattern), F.lit(0)))
    # what lies before, between and behind the matches; only texts with matches are split
    df = df.withColumn(pieces, F.when(F.size(found) > 0, F.split("scan_text", pattern, -1)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(pieces, F.transform(found, lambda m, i: F.struct(F.length(F.get(pieces, i)).cast("long").alias("gap"), F.length(m).cast("long").alias("own"))))
    sums = running_starts(F.transform(F.col(pieces), lambda x: x["gap"] + x["own"]))
    # a match starts behind all earlier pieces and matches, and its own piece
    return df.withColumn(at, sums).withColumn(at, F.zip_with(at, pieces, lambda s, x: s + x["gap"])).drop(pieces)


def _span(order: int, start: Column, end: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(order).alias("kind"), end.cast("long").alias("end"))


def _pattern_spans(rule: Pattern, order: int, name: str) -> Column:
    def span(m: Column, at: Column) -> Column:
        size = F.length(F.regexp_extract(m, rule.pattern, rule.group)) if rule.group else F.length(m)
        return F.when(size >= rule.least, _span(order, at, at + F.length(m)))

    return F.filter(F.zip_with(f"{name}_found", f"{name}_at", span), lambda s: s.isNotNull())


def _set(counts: Column, k: Column, value: Column) -> Column:
    """``counts`` with ``value`` at index ``k``."""
    return F.concat(F.slice(counts, 1, k), F.array(value), F.slice(counts, k + 2, F.size(counts)))


def high_windows(run: Column, kind: CharacterClass) -> Column:
    """Starts (from 0, ascending) of the windows of ``run`` whose entropy is at least ``kind.bits``."""
    w, gains, zeros = kind.window, F.array(*map(F.lit, kind.gains())), F.array(*[F.lit(0)] * len(kind.alphabet))

    def block(b: Column) -> Column:
        part = F.substring(run, b * BLOCK + 1, F.lit(BLOCK + w - 1))
        letters = F.split(F.lower(part) if kind.fold else part, "")
        codes = F.transform(letters, lambda c: F.instr(F.lit(kind.alphabet), c) - 1)

        def slide(both: Column) -> Column:
            # both["codes"] are bound once
            codes = both["codes"]

            def step(state: Column, i: Column) -> Column:
                enters = F.get(codes, i)
                c = F.get(state["counts"], enters)
                counts = _set(state["counts"], enters, c + 1)
                total = state["total"] + F.get(gains, c + 1) - F.get(gains, c)
                full = i >= w - 1
                high = F.when(full & (total <= kind.limit()), F.concat(state["high"], F.array(b * BLOCK + i - (w - 1)))).otherwise(state["high"])
                # the window's first letter leaves once the window was judged
                out = F.when(full, F.get(codes, i - (w - 1)))
                left = F.get(counts, out)
                return F.struct(
                    F.when(full, _set(counts, out, left - 1)).otherwise(counts).alias("counts"),
                    (total + F.coalesce(F.get(gains, left - 1) - F.get(gains, left), F.lit(0))).alias("total"),
                    high.alias("high"),
                )

            start = F.struct(zeros.alias("counts"), F.lit(0).alias("total"), F.array().cast("array<int>").alias("high"))
            return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, lambda s: s["high"])

        return F.flatten(F.transform(F.array(F.struct(codes.alias("codes"))), slide))

    blocks = F.ceil((F.length(run) - (w - 1)) / BLOCK).cast("int")
    return F.flatten(F.transform(F.sequence(F.lit(0), blocks - 1), block))


def _entropy_spans(kind: CharacterClass, order: int, name: str, allowed: tuple[str, ...]) -> Column:
    """Stretches covered by windows of high entropy, of candidates that are not allowed."""

    def stretches(run: Column, at: Column) -> Column:
        def cut(starts: Column) -> Column:
            first = F.filter(starts, lambda s, i: F.coalesce(s - F.get(starts, i - 1) > kind.window, F.lit(True)))
            last = F.filter(starts, lambda s, i: F.coalesce(F.get(starts, i + 1) - s > kind.window, F.lit(True)))
            return F.zip_with(first, last, lambda a, b: _span(order, at + a, at + b + kind.window))

        fine = run.rlike("|".join(f"(?:{p})" for p in allowed)) if allowed else F.lit(False)
        none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
        return F.when(fine, none).otherwise(F.flatten(F.transform(F.array(high_windows(run, kind)), cut)))

    return F.flatten(F.zip_with(f"{name}_found", f"{name}_at", stretches))


def find_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    patterns: tuple[Pattern, ...] = PATTERNS,
    classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """One row per row of ``docs``: the key and ``spans``, an array of (kind, start, end) by start, then kind as listed.

    Positions are code points of the whole text, ends exclusive. Pattern spans are whole
    matches and come first among kinds; allowed candidates lose their entropy spans only, and an
    entropy span may overlap a pattern's. Null texts are empty and have no spans. Repeated rows
    come out as often as they go in; other columns are ignored; no rows give no rows.
    """
    kinds = [p.kind for p in patterns] + [c.kind for c in classes]
    df = docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("scan_text"))
    for p in patterns:
        df = _with_matches(df, p.kind, p.pattern)
    for c in classes:
        df = _with_matches(df, c.kind, c.candidates())
    spans = [_pattern_spans(p, i, p.kind) for i, p in enumerate(patterns)]
    spans += [_entropy_spans(c, len(patterns) + i, c.kind, allowed) for i, c in enumerate(classes)]
    names = F.array(*map(F.lit, kinds))
    found = F.transform(F.sort_array(F.concat(*spans)), lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return df.select(key, found.alias("spans"))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
