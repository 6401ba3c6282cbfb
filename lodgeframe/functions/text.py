"""Text columns: normalising, keyword flags, categories, lists printed as text, words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgeframe.functions.clean import is_true

# Stopwords of the review word count.
REVIEW_STOPWORDS = (
    "the", "a", "an", "and", "is", "in", "it", "of", "for", "with", "to", "was", "were", "very",
)


def clean_text(c: Column) -> Column:
    """Lower case, tags and symbols to blanks, single blanks, trimmed; null gives ''.

    Letters and digits of any script are kept, so the classes are spelt out instead of ``\\w``.
    """
    text = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    text = F.regexp_replace(text, r"[^\p{L}\p{N}_]+", " ")
    return F.trim(text)


def keyword_flag(c: Column, pattern: str, whole_word: bool = False) -> Column:
    """1 where the pattern occurs in any letter case, else 0; null gives 0."""
    regex = rf"(?iU)\b({pattern})\b" if whole_word else f"(?iU){pattern}"
    return is_true(c.cast("string").rlike(regex)).cast("int")


def categorize_text(
    c: Column, rules: Sequence[tuple[Sequence[str], str]], default: str, missing: str | None = None
) -> Column:
    """First rule with one of its substrings in the lower-cased text decides the label."""
    text = F.lower(c.cast("string"))
    chain = F.when(text.isNull(), F.lit(default if missing is None else missing))
    for needles, label in rules:
        hit = F.lit(False)
        for needle in needles:
            hit = hit | text.contains(needle)
        chain = chain.when(hit, F.lit(label))
    return chain.otherwise(F.lit(default))


def text_length(c: Column) -> Column:
    """Code points; null gives 0."""
    return F.coalesce(F.length(c), F.lit(0))


def lower_text(c: Column) -> Column:
    return F.lower(c.cast("string"))


def parse_list(c: Column, compat: bool = False) -> Column:
    """JSON list text to array; null and broken text give an empty array.

    Single-quoted lists are accepted too. ``compat`` swaps quotes before the first try, which
    loses lists whose items hold apostrophes.
    """
    swapped = F.from_json(F.replace(c, F.lit("'"), F.lit('"')), "array<string>")
    empty = F.array().cast("array<string>")
    if compat:
        return F.coalesce(swapped, empty)
    return F.coalesce(F.from_json(c, "array<string>"), swapped, empty)


def list_size(c: Column) -> Column:
    return F.size(c)


def comma_count(c: Column) -> Column:
    """Number of comma-separated parts; null gives 0."""
    return F.coalesce(F.size(F.split(c, ",")), F.lit(0))


def printed_list(c: Column) -> Column:
    """A list printed as text to its distinct non-empty tokens."""
    bare = F.trim(F.regexp_replace(c.cast("string"), r"[\[\]']", ""))
    tokens = F.filter(F.split(bare, ", "), lambda t: t != F.lit(""))
    return F.array_distinct(F.coalesce(tokens, F.array().cast("array<string>")))


def words(c: Column) -> Column:
    """Array of the a-z words of the whole text (symbols inside a word are dropped)."""
    letters = F.regexp_replace(F.lower(c.cast("string")), r"[^a-z\s\p{Z}]+", "")
    return F.split(letters, r"[\s\p{Z}]+")


def content_word(
    w: Column, stopwords: Sequence[str] = REVIEW_STOPWORDS, longer_than: int = 2
) -> Column:
    """Whether a word is long enough and not a stopword."""
    return (F.length(w) > longer_than) & ~w.isin(*stopwords)
