"""Text clean-up as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a control character, and the markdown rewrites in the order they apply.
CONTROL = r"[\x00-\x1f\x7f-\x9f\x{200b}-\x{200f}\x{2028}\x{2029}\x{feff}]"
MARKDOWN = (
    (r"`{3,}[A-Za-z0-9_+.-]*", " "),
    (r"(?m)^[ \t]{0,3}(?:#{1,6}[ \t]+|>[ \t]?|[-*+][ \t]+|\d{1,3}[.)][ \t]+)", ""),
    (r"!\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"`+([^`]*)`+", "$1"),
    (r"(?s)~~(.+?)~~", "$1"),
    (r"(?s)\*{1,3}(\S(?:.*?\S)?)\*{1,3}", "$1"),
    (r"(?<![A-Za-z0-9_])_{1,3}([^_]+?)_{1,3}(?![A-Za-z0-9_])", "$1"),
)
SUMMARY_CHARS, SLUG_CHARS = 160, 32


def one_line(text: Column) -> Column:
    """Control characters become spaces, runs of white space one space, and the ends are trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, CONTROL, " "), r"(?U)\s+", " "))


def collapse(text: Column, limit: int) -> Column:
    return F.rtrim(F.substring(one_line(text), 1, max(limit, 0)))


def clean(text: Column, limit: int) -> Column:
    """Like collapse, but control characters other than white space go without a trace."""
    dropped = F.regexp_replace(F.regexp_replace(text, r"[\x09-\x0d]", " "), CONTROL, "")
    return F.rtrim(F.substring(F.trim(F.regexp_replace(dropped, r"(?U)\s+", " ")), 1, limit))


def slugify(text: Column) -> Column:
    """A slug of at most 32 of [a-z0-9_], or null where nothing is left."""
    gaps = F.regexp_replace(F.lower(one_line(text)), "[^a-z0-9_]+", "_")
    trimmed = F.regexp_replace(F.regexp_replace(gaps, "_{2,}", "_"), "^_+|_+$", "")
    return F.nullif(F.regexp_replace(F.substring(trimmed, 1, SLUG_CHARS), "_+$", ""), F.lit(""))


def flatten_markdown(text: Column) -> Column:
    for pattern, to in MARKDOWN:
        text = F.regexp_replace(text, pattern, to)
    return text


def summarize(text: Column) -> Column:
    """One line of at most 160 characters, cut at a word and closed with an ellipsis."""
    flat = collapse(flatten_markdown(text), SUMMARY_CHARS * 8)
    head = F.substring(flat, 1, SUMMARY_CHARS - 1)
    at_word = F.when(F.instr(F.reverse(head), " ") > 0, F.regexp_extract(head, r"^(.+) [^ ]*$", 1)).otherwise(head)
    at_word = F.when(at_word == "", head).otherwise(at_word)
    return F.when(F.length(flat) <= SUMMARY_CHARS, flat).otherwise(F.concat(F.regexp_replace(F.rtrim(at_word), "[,;:]+$", ""), F.lit("…")))


def title_words(text: Column, limit: int = 40) -> Column:
    """Words in lower case get a capital; a word that has capitals keeps them."""
    words = F.split(collapse(text, limit), " ")
    titled = F.transform(words, lambda w: F.when((w == F.lower(w)) & (w != F.upper(w)), F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1000))).otherwise(w))
    return F.substring(F.array_join(titled, " "), 1, limit)


def relative_path(text: Column, limit: int) -> Column:
    """A relative path without empty or dot segments; empty if it climbs or is too long."""
    plain = F.regexp_replace(F.regexp_replace(collapse(text, limit + 1), r"\\", "/"), "^/+|/+$", "")
    parts = F.filter(F.split(plain, "/"), lambda s: (s != "") & (s != "."))
    bad = (F.length(plain) > limit) | F.exists(parts, lambda s: s == "..")
    return F.when(bad, F.lit("")).otherwise(F.array_join(parts, "/"))


def first_rule(text: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The first rule of which a keyword occurs as a whole word; text is expected in lower case."""
    out = None
    for name, words in rules:
        found = text.rlike(r"\b(?:" + "|".join(words) + r")\b")
        out = F.when(found, name) if out is None else out.when(found, name)
    return out.otherwise(default)
