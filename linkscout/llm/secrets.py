"""Secrets in text: fixed patterns, and windows of high Shannon entropy in long strings."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscout.llm.common import let

# The patterns of the base kinds, in the order of their kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_VALUE = 6

KINDS = ("assign", "access", "hex", "entropy")
#: Strings whose windows are measured.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20


def changing(letters: str, others: str, times: int) -> str:
    """Strings of ``letters``, digits and ``others`` in which a letter meets a digit behind it in so many places."""
    run = f"[^{letters}]*+[{letters}]++"
    return f"^(?:(?:{run}(?![0-9]))*+{run}[0-9]){{{times}}}[{letters}0-9{others}]*+$"


def with_digits(letters: str) -> tuple[tuple[str, float], ...]:
    """Classes of keys with letters of one case. Words with numbers have few changes between both, so those need more bits."""
    both, joined = f"^(?=.*[0-9])(?=.*[{letters}])[{letters}0-9", "+/_=-"
    plain, mixed = f"{both}]+$", f"{both}{joined}]+$"
    return (
        (f"(?={plain}){changing(letters, '', 3)}", 3.4), (plain, 4.05), (f"(?={mixed}){changing(letters, joined, 4)}", 3.6), (mixed, 4.2),
    )


#: Character class of a candidate, by the first pattern it fits, and the entropy in bits from which a window is a secret.
#: Letters or digits alone, and words joined by dashes, fit none.
CLASSES = (
    (r"^(?=.*[0-9])(?=.*[a-fA-F])[0-9a-fA-F]+$", 3.0),
    (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", 3.6),
    (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_=-]+$", 3.8),
    *with_digits("a-z"),
    *with_digits("A-Z"),
)
#: Strings that are no secrets: identifiers in the form of a UUID, dates and versions, alphabets, placeholders.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"^[0-9-]+T[0-9-]+Z?$", r"(?i)0123456789abcdef", r"(?i)abcdefghijklm",
    r"(?i)example|placeholder|xxxxxx",
)
#: Lengths are added up in runs of this many matches.
RUN = 256


def running_totals(lengths: Column) -> Column:
    """Running totals of an array, summed run by run so that a text with very many matches stays cheap."""
    zero = F.lit(0).cast("long")

    def total(a: Column) -> Column:
        return F.aggregate(a, zero, lambda n, x: n + x)

    def joined(runs: Column) -> Column:
        def within(run: Column, k: Column, sums: Column) -> Column:
            return let(
                total(F.slice(sums, F.lit(1), k)),
                lambda base: F.transform(run, lambda x, i: base + total(F.slice(run, F.lit(1), i + 1))),
            )

        return F.flatten(let(F.transform(runs, total), lambda sums: F.transform(runs, lambda run, k: within(run, k, sums))))

    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / RUN).cast("int")), lambda c: F.slice(lengths, c * RUN + 1, F.lit(RUN)))
    return let(runs, joined)


SPANS = "array<struct<start:bigint,kind:int,stop:bigint,found:string>>"


def matches(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches as ``(start, kind, stop, found)``, in code points, ``stop`` exclusive.

    The text between the matches and the matches themselves make up the whole text, so their lengths give the places.
    """

    def placed(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        lengths = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, m: (F.length(b) + F.length(m)).cast("long"))
        return let(running_totals(lengths), lambda stops: F.zip_with(found, stops, lambda m, stop: F.struct(
            (stop - F.length(m)).alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), m.alias("found"))))

    none = F.array().cast(SPANS)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), let(found, placed).cast(SPANS)).otherwise(none)


def assignments(text: Column) -> Column:
    """Matches of ASSIGN whose value has at least MIN_VALUE characters."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    marked = let(values, lambda v: F.filter(
        F.transform(matches(text, ASSIGN, 0), lambda m, i: F.when(F.length(F.get(v, i)) >= MIN_VALUE, m)), lambda m: m.isNotNull()))
    return F.when(text.rlike(ASSIGN), marked).otherwise(F.array().cast(SPANS))


def top_entropy(text: Column, window: int) -> Column:
    """Highest Shannon entropy, in bits, of the character counts of any ``window`` neighbouring characters.

    ``sum(c log c)`` over the counts is carried from window to window: only the counts of the character that leaves and of
    the one that enters change.
    """
    table = F.array(*[F.lit(0.0 if k == 0 else k * math.log2(k)) for k in range(window + 1)])

    def count(part: Column, character: Column) -> Column:
        return F.length(part) - F.length(F.replace(part, character, F.lit("")))

    def step(state: Column, i: Column) -> Column:
        """Enter character ``i`` (from 1); the window before holds at most ``window`` characters ahead of it."""
        begin = F.greatest(i - window, F.lit(1))
        before = F.substr(text, begin, i - begin)
        full = i > window
        leaving, entering = F.substr(text, begin, F.lit(1)), F.substr(text, i, F.lit(1))
        kept = F.when(full, F.substr(text, begin + 1, F.lit(window - 1))).otherwise(before)
        out, into = count(before, leaving), count(kept, entering)
        drop = F.when(full, F.get(table, out) - F.get(table, out - 1)).otherwise(0.0)
        total = state.getField("total") - drop + F.get(table, into + 1) - F.get(table, into)
        entropy = F.when(i >= window, F.lit(math.log2(window)) - total / window).otherwise(0.0)
        return F.struct(total.alias("total"), F.greatest(state.getField("top"), entropy).alias("top"))

    zero = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("top"))
    return F.aggregate(F.sequence(F.lit(1), F.length(text)), zero, step, lambda s: s.getField("top"))


def high_entropy(
    text: Column, classes: Sequence[tuple[str, float]] = CLASSES, allowed: Sequence[str] = ALLOWED, window: int = WINDOW
) -> Column:
    """Candidate strings of a known character class, not allowed, with a window at or above the entropy of the class."""

    def suspect(m: Column) -> Column:
        limit = F.lit(None).cast("double")
        for pattern, bits in reversed(classes):
            limit = F.when(m.rlike(pattern), F.lit(bits)).otherwise(limit)
        known = F.lit(False)
        for pattern in allowed:
            known = known | m.rlike(pattern)
        return F.when(limit.isNull() | known, F.lit(False)).otherwise(top_entropy(m, window) >= limit)

    return F.filter(matches(text, CANDIDATE, 3), lambda m: suspect(m.getField("found")))


def scan(
    docs: DataFrame, text_col: str = "text", classes: Sequence[tuple[str, float]] = CLASSES,
    allowed: Sequence[str] = ALLOWED, window: int = WINDOW,
) -> DataFrame:
    """Every row and column of ``docs`` with ``base`` and ``added``, arrays of ``(start, kind, stop, found)`` by place.

    ``base`` holds the matches of the fixed patterns, ``added`` strings of high entropy that overlap none of them. ``kind``
    is the place in KINDS. Null and empty texts have no spans. Columns of ``docs`` named like the new ones are replaced.
    """
    text = F.coalesce(F.col("_text"), F.lit(""))
    base = F.sort_array(F.concat(assignments(text), matches(text, ACCESS, 1), matches(text, HEX, 2)))
    whole = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text")).withColumn("base", base)

    def apart(m: Column) -> Column:
        return ~F.exists("base", lambda b: (b.getField("start") < m.getField("stop")) & (m.getField("start") < b.getField("stop")))

    found = whole.withColumn("added", F.filter(high_entropy(text, classes, allowed, window), apart))
    return found.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("base", "added")], "base", "added")


def spelled(spans: Column) -> Column:
    """``kind:start:stop`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(
        ":", F.get(names, m.getField("kind")), m.getField("start").cast("string"), m.getField("stop").cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""

    def step(state: Column, m: Column) -> Column:
        stop, start = state.getField("stop"), m.getField("start")
        gap = F.substr(text, (stop + 1).cast("int"), F.greatest(start - stop, F.lit(0)).cast("int"))
        return F.struct(
            F.greatest(stop, m.getField("stop")).alias("stop"),
            F.concat(state.getField("out"), gap, F.when(start >= stop, mark).otherwise("")).alias("out"),
        )

    def closed(state: Column) -> Column:
        return F.concat(state.getField("out"), F.substr(text, (state.getField("stop") + 1).cast("int")))

    zero = F.struct(F.lit(0).cast("long").alias("stop"), F.lit("").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(F.sort_array(spans), zero, step, closed)).otherwise(text)
