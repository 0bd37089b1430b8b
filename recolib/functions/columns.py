"""Column functions. All are native Spark expressions (codegen, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recolib import config as C

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ (floor for post-1970 values),
    independent of the session time zone."""
    return F.expr(f"timestampdiff(SECOND, {_EPOCH_NTZ}, {ts})") if isinstance(ts, str) \
        else F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), ts)


def year_month(epoch_s) -> Column:
    """Epoch seconds -> 'yyyyMM' in UTC, whatever the session zone is."""
    ntz = F.timestamp_add("SECOND", _col(epoch_s), F.expr(_EPOCH_NTZ))
    return F.date_format(ntz, "yyyyMM")


def tag_words(tags) -> Column:
    """P3: 'a|b|c' -> 'a b c' (the text the tokenizer sees). Separators at the end
    are dropped with the empty tags between them; inner and leading ones stay."""
    return F.array_join(F.split(F.regexp_replace(_col(tags), r"\|+$", ""), r"\|"), " ")


def tokenize(text) -> Column:
    """M1: lower-case, split on single whitespace characters; empty tokens stay,
    except at the end. A text of white space only has no token, an empty one has
    the empty token."""
    low = F.lower(_col(text))
    words = F.split(F.regexp_replace(low, r"\s+$", ""), r"\s")
    return F.when(low.rlike(r"^\s+$"), F.array().cast("array<string>")).otherwise(words)


def contains_prefix(line, prefix: str = C.LOG_PREFIX) -> Column:
    """P5: keep a log line that contains the rating prefix."""
    return F.instr(_col(line), prefix) > 0


def after_prefix(line, prefix: str = C.LOG_PREFIX) -> Column:
    """The piece after the first prefix (up to a second one), trimmed."""
    return F.trim(F.try_element_at(F.split(_col(line), prefix), F.lit(2)))


def parse_rating_message(msg, sep: str = C.MESSAGE_SEP) -> dict[str, Column]:
    """P7: 'user|item|score|ts' -> typed columns; bad fields become null."""
    parts = F.split(_col(msg), "\\" + sep)
    field = lambda i: F.trim(F.try_element_at(parts, F.lit(i)))
    return {
        "userId": field(1).try_cast("bigint"),
        "productId": field(2).try_cast("bigint"),
        "score": field(3).try_cast("double"),
        "timestamp": field(4).try_cast("bigint"),
    }


def format_rating_message(user, item, score, ts) -> Column:
    """S14 payload: 'user|item|score|ts' (score printed like a Java double)."""
    return F.concat_ws(C.MESSAGE_SEP, _col(user).cast("string"), _col(item).cast("string"),
                       _col(score).cast("string"), _col(ts).cast("string"))


def format_rating_log(user, item, score, ts) -> Column:
    """The log payload with its prefix."""
    return F.concat(F.lit(C.LOG_PREFIX), format_rating_message(user, item, score, ts))


def normalise_score(raw) -> Column:
    """UI score 1..10 -> 0.5..5, rounded half-up to 2 places."""
    return F.round(_col(raw) / 2.0, 2)


def redecode(text) -> Column:
    """Undo a decode of UTF-8 bytes as ISO-8859-1.

    Total: a character without an ISO-8859-1 byte becomes ``?`` and each malformed
    part of the bytes becomes U+FFFD, so ordinary text passes through without an
    error."""
    known = F.regexp_replace(_col(text), r"[^\x00-\xFF]", "?")
    return F.make_valid_utf8(F.encode(known, "ISO-8859-1").cast("string"))


def misdecode(text, wrong: str = "ISO-8859-1", right: str = "UTF-8") -> Column:
    """The mojibake a servlet container produces from UTF-8 bytes."""
    return F.decode(F.encode(_col(text), right), wrong)


def java_string_hash(s) -> Column:
    """32-bit String.hashCode (h = 31*h + c, wrapping) over UTF-16 units: a
    character above 0xFFFF counts as its two surrogates."""
    def units(ch: Column) -> Column:
        c = F.ascii(ch).cast("bigint")
        high = F.shiftright(c - 0x10000, 10) + 0xD800
        return F.when(c > 0xFFFF, F.array(high, (c - 0x10000).bitwiseAND(0x3FF) + 0xDC00)).otherwise(F.array(c))

    codes = F.flatten(F.transform(F.filter(F.split(_col(s), ""), lambda ch: ch != ""), units))
    h = F.aggregate(codes, F.lit(0).cast("bigint"),
                    lambda acc, x: F.pmod(acc * 31 + x, F.lit(4294967296)))
    return F.when(h >= 2147483648, h - 4294967296).otherwise(h).cast("int")


def ms_to_seconds(ms) -> Column:
    """A millisecond event time (as the web tier stores it) -> epoch seconds."""
    return F.floor(_col(ms) / 1000).cast("bigint")


def parse_recent_item(item) -> dict[str, Column]:
    """P23: 'productId:score' -> (productId, score)."""
    parts = F.split(_col(item), C.RECENT_ITEM_SEP)
    return {
        "productId": F.trim(F.try_element_at(parts, F.lit(1))).try_cast("bigint"),
        "score": F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double"),
    }


def log10_count(n) -> Column:
    """log10 of a count, 0 when the count is 0 (the reference defaults to 1)."""
    return F.log10(F.greatest(F.lit(1), _col(n)).cast("double"))


def score_key(score) -> Column:
    """Tie-stable ordering key for a similarity score: rounded to 9 places so two
    engines that differ in the last bit rank alike."""
    return F.round(_col(score), 9)


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "Column", "F", "C")]
