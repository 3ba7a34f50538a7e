"""Text sanitation with a built-in path for the rows that need no HTML parser."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.functions.columns import quote
from presswork.functions.markup import simple_markup_pattern, visible_text_udf

# An ampersand inside an attribute is harmless unless unescaping it could yield a quote or bracket.
_SIMPLE_MARKUP = simple_markup_pattern("&(?!#|lt|gt|quot|apos|nv)")

# Characters beyond ASCII that NFKC leaves alone in any order: the letters and stable signs of
# Latin-1, and common dashes, quotes, bullet and euro sign.
_STABLE_CLASS = r"\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\xbf-\xff–—‘’“”•€"
# An intersection, so that one range test settles every ASCII character.
_UNSTABLE = rf"[\x80-\x{{10ffff}}&&[^{_STABLE_CLASS}]]"

# Whitespace that can occur in a text without unstable characters.
_SPACE_RUN = r"[\t-\r\x1c- ]+"


# --- Fixed values: character references resolved by built-in functions ------------------------
# Each stands for a character that is neither markup nor changed by NFKC (a no-break space, which
# NFKC turns into a space, aside). The ampersand comes last: what it uncovers is not resolved again.
REFERENCES = {
    "&nbsp;": " ",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&#039;": "'",
    "&lsquo;": "‘",
    "&rsquo;": "’",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&ndash;": "–",
    "&mdash;": "—",
    "&middot;": "·",
    "&copy;": "©",
    "&amp;": "&",
}
# ----------------------------------------------------------------------------------------------


def _stages(name: str, raw: str) -> list[str]:
    """SQL columns from the raw text to the finished text ``_plain`` or, where only Python gives
    the exact result, the raw text ``_hard``; each refers to the ones before it."""
    c = {k: f"_{k}_{name}" for k in ("raw", "untagged", "bare", "plain", "hard")}
    resolved = c["untagged"]
    for reference, character in REFERENCES.items():
        resolved = f"replace({resolved}, {quote(reference)}, {quote(character)})"
    untagged = f"regexp_replace({c['raw']}, {quote(_SIMPLE_MARKUP)}, ' ')"
    easy = (
        f"NOT contains({c['bare']}, '<') AND NOT rlike({c['bare']}, {quote(_UNSTABLE)}) AND "
        f"NOT (contains({c['bare']}, '&') AND rlike({c['bare']}, '&[a-zA-Z#]'))"
    )
    collapsed = f"trim(regexp_replace({c['bare']}, {quote(_SPACE_RUN)}, ' '))"
    return [
        f"{raw} AS {c['raw']}",
        f"CASE WHEN contains({c['raw']}, '<') THEN {untagged} ELSE {c['raw']} END AS {c['untagged']}",
        f"CASE WHEN contains({c['raw']}, '&') THEN {resolved} ELSE {c['untagged']} END AS {c['bare']}",
        f"CASE WHEN {easy} THEN {collapsed} END AS {c['plain']}",
        f"CASE WHEN {c['plain']} IS NULL THEN {c['raw']} END AS {c['hard']}",
    ]


def with_clean_text(df: DataFrame, **texts: str) -> DataFrame:
    """Add one sanitised text column per keyword, given as the SQL of the raw text.

    Entities are unescaped, markup is dropped with a space between text nodes, the text is
    NFKC-normalised, whitespace collapses and NULL becomes empty. Plain text, simple markup and
    common references are handled by built-in expressions. The Python function receives only the
    other values; for the rest its input is NULL, so nothing is copied out of the JVM for them.
    """
    keep = [f"`{c}`" for c in df.columns if c not in texts]
    stages = [column for name, raw in texts.items() for column in _stages(name, raw)]
    carried = [f"_{k}_{name}" for name in texts for k in ("plain", "hard")]
    staged = df.selectExpr("*", *stages).select(*keep, *carried)
    udf = visible_text_udf()
    return staged.select(
        *keep,
        *[F.coalesce(f"_plain_{n}", udf(f"_hard_{n}"), F.lit("")).alias(n) for n in texts],
    )
