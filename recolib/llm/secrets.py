"""Secret scans (operator 4), in built-in column functions only.

Pattern spans: a text is split at a kind's matches, and the lengths of the pieces and matches give code point
positions. Entropy spans: pattern spans and allow-listed substrings are blanked, and nothing else is; in every run of
``WINDOW`` or more token characters that is left a window slides along. Its character counts are updated by the
entering and the leaving character, and with them the sum of n*log2(n), so Shannon entropy is known at each step. A
run is judged against its character class's threshold; the span reaches from the first to the last window at or
above it. So a key beside a pattern span or an allow-listed word in one run is still found.

Everything is one expression per row: no shuffle, and a text never leaves its row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recolib.llm.common import let, text_or_empty


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Fixed patterns, leftmost and non-overlapping. A run of 16 or more hex digits is a match of [0-9a-f]+ of that length,
# likewise AKIA with 14 or more; an assignment's value is measured after matching.
ASSIGN = ("(" + "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
          + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
MIN_VALUE = 12
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = "[A-Za-z0-9+/_=-]{%d,}" % WINDOW
# class of a run -> least entropy (bits) of a window. Letters alone are mostly joined words, whose windows repeat letters
# more than random ones of both cases do; digits alone are never secrets (no window of 20 reaches 5 bits).
THRESHOLDS = (("^[^A-Za-z]+$", 5.0), ("^[^0-9A-Z]+$|^[^0-9a-z]+$", 4.2), ("^[^0-9]+$", 4.0),
              ("^[0-9a-f]+$|^[0-9A-F]+$", 3.0), ("^[^A-Z]+$|^[^a-z]+$", 3.5), ("", 3.7))
# substrings that are no part of a secret
ALLOWED = (r"(?i)example|sample|dummy|placeholder|changeme|x{6,}|0123456789|1234567890|abcdefgh"
           r"|(?<![a-z0-9])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![a-z0-9])")

SPAN = "array<struct<start:long,kind:int,stop:long,value:string>>"


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0) -> Column:
    """Spans of a pattern's matches with the value of a group. Pieces between matches give the positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    empty = F.array().cast(SPAN)
    items = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("match"),
                         (found if not value_group else F.regexp_extract_all(text, F.lit(pattern), value_group))
                         .alias("value"))

    def step(acc: Column, item: Column) -> Column:
        start = acc["at"] + F.length(item["gap"])
        stop = start + F.length(item["match"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), item["value"].alias("value"))
        return F.struct(F.coalesce(stop, start).cast("long").alias("at"),
                        F.when(item["match"].isNull(), acc["spans"])  # the piece after the last match
                        .otherwise(F.concat(acc["spans"], F.array(span).cast(SPAN))).alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))
    return F.when(F.size(found) == 0, empty).otherwise(F.aggregate(items, start, step, lambda acc: acc["spans"]))


def hot_windows(run: Column, threshold: Column) -> Column:
    """Struct (first, last) of the 0-based starts of a run's first and last window at or above the threshold; both
    null when there is none. The window's counts and sum of n*log2(n) move with it."""
    nlogn = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 1)])
    most = F.lit(math.log2(WINDOW) + 1e-9) - threshold  # the sum may reach WINDOW times this

    def scan(codes: Column) -> Column:
        def count_in(codes: Column) -> Column:
            first = F.slice(codes, 1, WINDOW)
            return F.transform(F.sequence(F.lit(1), F.lit(len(ALPHABET))),
                               lambda k: F.size(F.filter(first, lambda c: c == k)))

        def hit(total: Column, at: Column, first: Column, last: Column) -> list[Column]:
            hot = total <= most * WINDOW
            return [total.alias("total"), F.when(hot, F.coalesce(first, at)).otherwise(first).alias("first"),
                    F.when(hot, at).otherwise(last).alias("last")]

        def step(acc: Column, i: Column) -> Column:  # window i starts at code i + 1 and takes in code i + WINDOW
            out, new = F.element_at(codes, i), F.element_at(codes, i + WINDOW)
            n_out, n_new = F.element_at(acc["counts"], out), F.element_at(acc["counts"], new)
            change = (F.element_at(nlogn, n_out) - F.element_at(nlogn, n_out + 1)
                      + F.element_at(nlogn, n_new + 2) - F.element_at(nlogn, n_new + 1))
            total = acc["total"] + F.when(out == new, 0.0).otherwise(change)
            counts = F.when(out == new, acc["counts"]).otherwise(F.transform(
                acc["counts"], lambda c, k: c + (k + 1 == new).cast("int") - (k + 1 == out).cast("int")))
            return F.struct(counts.alias("counts"), *hit(total, i, acc["first"], acc["last"]))

        def begin(counts: Column) -> Column:
            total = F.aggregate(counts, F.lit(0.0), lambda s, n: s + F.element_at(nlogn, n + 1))
            null = F.lit(None).cast("int")
            return F.struct(counts.alias("counts"), *hit(total, F.lit(0), null, null))

        moves = F.when(F.size(codes) > WINDOW, F.sequence(F.lit(1), F.size(codes) - WINDOW)).otherwise(
            F.array().cast("array<int>"))
        done = F.aggregate(moves, let(count_in(codes), begin), step)
        return let(done, lambda d: F.struct(d["first"].alias("first"), d["last"].alias("last")))

    letters = F.filter(F.split(run, ""), lambda c: c != "")
    return let(F.transform(letters, lambda c: F.instr(F.lit(ALPHABET), c)), scan)


def _rebuilt(text: Column, spans: Column, put: Callable[[Column, Column], Column]) -> Column:
    """The text with ``put(n, fresh)`` in place of each span's ``n`` characters that no earlier span covers; ``fresh``
    tells whether the span starts outside of all earlier ones."""
    def cut(spans: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            start = F.greatest(s["start"], acc["at"])
            plain = F.substr(text, (acc["at"] + 1).cast("int"), (start - acc["at"]).cast("int"))
            longer = F.concat(acc["out"], plain, put(s["stop"] - start, s["start"] >= acc["at"]))
            return F.struct(F.when(s["stop"] <= acc["at"], acc["out"]).otherwise(longer).alias("out"),
                            F.greatest(acc["at"], s["stop"]).alias("at"))

        return F.aggregate(F.array_sort(spans), F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), step,
                           lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))))

    return let(spans, lambda s: F.when(F.size(s) == 0, text).otherwise(cut(s)))


def _blanked(text: Column, spans: Column) -> Column:
    return _rebuilt(text, spans, lambda n, fresh: F.repeat(F.lit(" "), n.cast("int")))


def _entropy_spans(text: Column, base: Column) -> Column:
    def judged(r: Column) -> Column:
        least = F.lit(THRESHOLDS[-1][1])
        for pattern, bits in reversed(THRESHOLDS[:-1]):
            least = F.when(r["value"].rlike(pattern), F.lit(bits)).otherwise(least)
        return let(hot_windows(r["value"], least), lambda h: F.struct(
            (r["start"] + h["first"]).alias("start"), r["kind"].alias("kind"),
            (r["start"] + h["last"] + WINDOW).alias("stop"), r["value"].alias("value")))

    def runs(plain: Column) -> Column:
        return F.transform(_spans(plain, RUN, len(KINDS) - 1), judged)

    def without_allowed(plain: Column) -> Column:
        return let(_blanked(plain, _spans(plain, ALLOWED, 0)), runs)

    found = let(_blanked(text, base), lambda plain: F.when(plain.rlike(RUN), without_allowed(plain)).otherwise(
        F.array().cast(SPAN)))
    return F.filter(found, lambda s: s["start"].isNotNull()).cast(SPAN)


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan(text: Column) -> tuple[Column, Callable[[Column], Column]]:
    """The pattern spans of a text column, and a function from those spans to the entropy spans."""
    assign = F.filter(_spans(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= MIN_VALUE)
    return F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2)), lambda base: _entropy_spans(text, base)


def found_secrets(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy.

    A null or empty text has no spans (empty string, digest of it); repeated rows each give a row; an empty table
    gives none. Positions are code points, ends exclusive. Other columns are ignored."""
    d = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
    base, added = scan(F.col("text"))
    d = d.withColumn("base", base).withColumn("added", added(F.col("base")))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return d.select("doc_id", count(0), count(1), count(2), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                    _joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_entropy"))


def redacted(text: Column, mark: str = "[secret]") -> Column:
    """The text with every span (pattern or entropy) replaced by ``mark``; overlapping spans become one mark.
    A null text stays null."""
    base, added = scan(text)
    spans = let(base, lambda b: F.concat(b, added(b)))
    marked = _rebuilt(text, spans, lambda n, fresh: F.when(fresh, F.lit(mark)).otherwise(F.lit("")))
    return F.when(text.isNull(), text).otherwise(marked)
