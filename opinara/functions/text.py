"""Text cleaning and tokens, built-ins only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions.scalars import col_of

TOKEN = r"[\p{L}\p{N}_]{2,}"

# The characters and tags that cleaning removes.
WHITESPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
TAG = r"<[^>]+>"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
CONTROL_AND_LATIN1 = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{ff}]"

# English words ignored by the term features; a list of our own choice.
STOP_WORDS = (
    "a about above after again against all also am an and any are as at be because been before "
    "being below between both but by can could did do does doing down during each few for from "
    "further had has have having he her here hers herself him himself his how if in into is it "
    "its itself just may me might more most must my myself no nor not now of off on once only or "
    "other our ours ourselves out over own same she should so some such than that the their "
    "theirs them themselves then there these they this those through to too under until up upon "
    "us very was we were what when where which while who whom why will with would you your yours "
    "yourself yourselves"
).split()


def clean_text(text: Column | str, strip_latin1: bool = False) -> Column:
    """NULL to '', runs of whitespace to one space, tags and control characters out, trimmed.

    Whitespace collapses before tags go, so two spaces may meet again around a
    removed tag. `strip_latin1` also drops U+0080-U+00FF, accented letters included.
    """
    flat = F.trim(F.regexp_replace(F.coalesce(col_of(text), F.lit("")), WHITESPACE, " "))
    bare = F.regexp_replace(flat, TAG, "")
    return F.trim(F.regexp_replace(bare, CONTROL_AND_LATIN1 if strip_latin1 else CONTROL, ""))


def tokens(text: Column | str) -> Column:
    """Lower-case runs of two or more letters, digits or underscores, in text order."""
    return F.regexp_extract_all(F.lower(col_of(text)), F.lit(TOKEN), F.lit(0))


# Word endings, taken off in this order: (what is kept, the ending, what takes its place).
STEM_RULES = (
    ("..+", "ies", "y"),
    ("..+(?:s|x|z|ch|sh)", "es", ""),
    (".+[^aiosu]", "s", ""),
    ("..+o", "s", ""),
    (".*[aeiouy].*[^aeiou]", "ing", ""),
    (".*[aeiouy].*[^aeiou]", "ed", ""),
    ("...+", "ly", ""),
    ("...+", "ness", ""),
    *((f"..*[aeiouy]{c}", c, "") for c in "bdgmnprt"),  # stopped, planning
    ("...+", "e", ""),
    ("..+[^aeiou]", "y", "i"),
)


def stem(word: Column) -> Column:
    """A lower-case English word without its regular endings.

    Beside what is taken off only the last letter can change, so a word begins with its
    stem but for the stem's last letter.
    """
    for kept, ending, other in STEM_RULES:
        word = F.regexp_replace(word, f"^({kept}){ending}$", f"$1{other}")
    return word


def without_stop_words(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.isin(*STOP_WORDS))


def bigrams(words: Column) -> Column:
    """Neighbouring pairs of an array of words, joined by a space."""
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<string>"))


def title_and_description(title: Column | str, description: Column | str, sep: str = " ") -> Column:
    return F.concat(F.coalesce(col_of(title), F.lit("")), F.lit(sep), F.coalesce(col_of(description), F.lit("")))
