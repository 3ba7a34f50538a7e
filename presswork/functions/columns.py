"""Small column expressions used across the plans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that str.isspace() accepts.
SPACES = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def is_filled(column: Column) -> Column:
    """True when the text is neither NULL nor empty."""
    return F.coalesce(F.length(column) > 0, F.lit(False))


def strip(column: Column) -> Column:
    """Remove leading and trailing Unicode whitespace; only the ends of the text are read."""
    return F.btrim(column, F.lit(SPACES))


def quote(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lookup(key: str, table: Mapping[str, str]) -> str:
    """SQL of an exact-match dictionary lookup; a miss, or a NULL key, gives NULL."""
    cases = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in table.items())
    return f"CASE {key} {cases} END"


def one_of(values: Iterable[str]) -> str:
    """SQL list of string literals for IN."""
    return "(" + ", ".join(quote(v) for v in values) + ")"


def stripped(text: str) -> str:
    """SQL of :func:`strip`."""
    return f"btrim({text}, {quote(SPACES)})"


def label_key(label: Column) -> Column:
    """Label with NULL spelled ``null``, so that it can serve as a grouping key."""
    return F.coalesce(label, F.lit("null"))


def content_key(content: str = "content") -> Column:
    """SHA-256 of the stripped, lower-cased content; NULL counts as empty text."""
    text = f"coalesce({content}, '')"
    return F.expr(f"sha2(lower({stripped(text)}), 256)")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, or zero when ``whole`` is not positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def stable_uuid(source: str, key: str) -> str:
    """SQL of a UUID-shaped digest; the same record keeps its id on every run."""
    digest = f"sha2(concat({quote(source + ':')}, {key}), 256)"
    parts = r"^(.{8})(.{4})(.{4})(.{4})(.{12}).*"
    return f"regexp_replace({digest}, {quote(parts)}, '$1-$2-$3-$4-$5')"
