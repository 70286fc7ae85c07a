"""Scalar text and number formats."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# How the log store spots a trace id in a line.
TRACE_ID = r'"trace_id":"(\w+)"'


def iso_timestamp(ts: Column | str) -> Column:
    """ISO-8601 with offset; the fraction is printed only when it is not zero."""
    micros = F.date_format(ts, "SSSSSS")
    fraction = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def minute_label(ts: Column | str) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm"), F.lit(" UTC"))


def one_decimal(pct: Column) -> Column:
    """Percent text, half-even on the decimal value.

    C-style ``%.1f`` rounds the binary value instead; the two can differ when
    the second decimal is 5 (0.35 prints as 0.4 here, 0.3 there).
    """
    return F.format_string("%.1f", F.bround(pct, 1))


def bar_width(pct: Column) -> Column:
    return F.bround(pct, 0).cast("int")


def round_duration(seconds: Column | str) -> Column:
    return F.bround(seconds, 4)


def html_escape(text: Column | str) -> Column:
    escaped = F.col(text) if isinstance(text, str) else text
    # The HTML entities, the ampersand first.
    for char, entity in (
        ("&", "&amp;"),
        ("<", "&lt;"),
        (">", "&gt;"),
        ('"', "&#34;"),
        ("'", "&#39;"),
    ):
        escaped = F.replace(escaped, F.lit(char), F.lit(entity))
    return escaped


def log_line(time: Column, level: Column, name: Column, message: Column, **extra: Column) -> Column:
    """One structured log line as JSON; null extra fields are left out."""
    fields = {
        "time": F.concat_ws(
            ",", F.date_format(time, "yyyy-MM-dd HH:mm:ss"), F.date_format(time, "SSS")
        ),
        "level": level,
        "name": name,
        "message": message,
        **extra,
    }
    return F.to_json(F.struct(*[value.alias(key) for key, value in fields.items()]))


def trace_id(line: Column | str) -> Column:
    """The trace id in a line, or null."""
    return F.nullif(F.regexp_extract(line, TRACE_ID, 1), F.lit(""))


def map_get(mapping: Column | str, key: str, default: str) -> Column:
    return F.coalesce(F.try_element_at(mapping, F.lit(key)), F.lit(default))


def matches_whole(value: Column | str, pattern: str) -> Column:
    """Label matcher: the pattern must cover the whole value."""
    column = F.col(value) if isinstance(value, str) else value
    return column.rlike(f"^(?:{pattern})$")


def topic_regex(pattern: str) -> str:
    """Regex of a topic pattern: ``*`` is one word, ``#`` is zero or more words."""
    words = pattern.split(".")
    if set(words) == {"#"}:
        return "^.*$"
    regex, dot = "", ""
    for word in words:
        if word == "#":
            regex += r"(?:\.[^.]+)*" if dot else r"(?:[^.]+\.)*"
        else:
            regex += dot + ("[^.]+" if word == "*" else re.escape(word))
            dot = r"\."
    return f"^{regex}$"


def _four_digits(value: Column) -> Column:
    """Up to four significant digits for values of at least 1, without padding."""
    scaled = (
        F.when(F.abs(value) >= 1000, F.round(value, 0))
        .when(F.abs(value) >= 100, F.round(value, 1))
        .when(F.abs(value) >= 10, F.round(value, 2))
        .otherwise(F.round(value, 3))
    )
    return F.regexp_replace(F.format_string("%.3f", scaled), r"\.?0+$", "")


def percent_text(ratio: Column) -> Column:
    return F.concat(_four_digits(ratio * 100), F.lit("%"))


def duration_text(seconds: Column) -> Column:
    """``1h 2m 3s`` from a minute up, ``2.5s`` and ``120ms`` below."""
    whole = F.floor(seconds)
    parts = [
        (whole >= 86400, F.concat(F.floor(whole / 86400).cast("string"), F.lit("d "))),
        (whole >= 3600, F.concat((F.floor(whole / 3600) % 24).cast("string"), F.lit("h "))),
        (whole >= 60, F.concat((F.floor(whole / 60) % 60).cast("string"), F.lit("m "))),
    ]
    long_form = F.concat(
        *[F.when(shown, text).otherwise("") for shown, text in parts],
        (whole % 60).cast("string"),
        F.lit("s"),
    )
    return (
        F.when(seconds >= 60, long_form)
        .when(seconds >= 1, F.concat(_four_digits(seconds), F.lit("s")))
        .otherwise(F.concat(_four_digits(seconds * 1000), F.lit("ms")))
    )
