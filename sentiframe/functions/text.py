"""Text scalar functions: Column -> Column, built-in expressions only.

No Python UDF; batch and streaming DataFrames alike.  ``filter``, ``transform``
and ``zip_with`` are evaluated by interpreted expressions within the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ANALYSIS_PUNCTUATION, ASCII_PUNCTUATION, STOPWORDS
from .regex import LETTERS_ONLY, NON_WS, WORD, WS, WS_RUN

# FIXED VALUES: what counts as a URL and as a mention.
URL_PATTERN = f"http{NON_WS}+|www{NON_WS}+"
PUNCTUATION_PATTERN = "[" + "".join(f"\\{p}" for p in ASCII_PUNCTUATION) + "]+"
MENTION_PATTERN = f"@{WORD}+"
ANALYSIS_MENTION_PATTERN = f"{WS}@{NON_WS}+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squash_whitespace(c) -> Column:
    """Collapse every run of Unicode whitespace to one space and strip."""
    return F.trim(F.regexp_replace(_col(c), WS_RUN, " "))


def is_blank(c) -> Column:
    """True when the string is empty or only Unicode whitespace."""
    return _col(c).rlike(f"\\A{WS}*\\z")


def _strip_social(c) -> Column:
    s = F.lower(_col(c))
    s = F.regexp_replace(s, URL_PATTERN, "")
    return F.regexp_replace(s, MENTION_PATTERN, "")


def clean_text(c) -> Column:
    """Aggressive cleaning for TF-IDF models.

    lower -> drop URLs -> drop @mentions -> drop '#' and the ASCII punctuation
    -> collapse whitespace -> drop stopwords and tokens that are not all
    letters -> join with single spaces.
    """
    s = F.regexp_replace(_strip_social(c), PUNCTUATION_PATTERN, "")
    tokens = F.split(squash_whitespace(s), " ")
    kept = F.filter(tokens, lambda t: t.rlike(f"\\A{LETTERS_ONLY}\\z") & ~t.isin(STOPWORDS))
    return F.array_join(kept, " ")


def light_clean_text(c) -> Column:
    """Light cleaning that keeps sentence structure."""
    s = F.replace(_strip_social(c), F.lit("#"), F.lit(""))
    return squash_whitespace(s)


def strip_analysis_urls(s: Column) -> Column:
    """A text without its runs of non-space characters that hold '.com' or 'www'
    and without the rest of a run from 'http' on; whitespace left is a space.
    Texts with none of these, most of them, are only searched for them; in the
    others a run is looked at as a whole, in linear time."""
    cut = F.transform(F.split(s, f"{WS}+"), lambda t: F.when(
        t.contains(".com") | t.contains("www"), F.lit("")).otherwise(F.substring_index(t, "http", 1)))
    found = s.contains(".com") | s.contains("www") | s.contains("http")
    return F.when(found, F.array_join(cut, " ")).otherwise(s)


def analysis_tokens(c) -> Column:
    """Tokens for word statistics (T3): array<string> of words longer than 2.

    Null text gives an empty array.  URLs (incl. anything around '.com' or
    'www'), mentions preceded by whitespace and punctuation (except '#') are
    replaced by spaces.
    """
    s = F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    s = strip_analysis_urls(s)
    s = F.regexp_replace(s, ANALYSIS_MENTION_PATTERN, " ")
    s = F.translate(s, ANALYSIS_PUNCTUATION, " " * len(ANALYSIS_PUNCTUATION))
    return F.filter(F.split(squash_whitespace(s), " "), lambda t: F.length(t) > 2)


def word_tokens(c) -> Column:
    """Tokens of two or more word characters (T5) of an already cleaned text.

    After ``clean_text`` a text is letters separated by single spaces, so the
    token pattern ``\\b\\w\\w+\\b`` reduces to "space-separated, length >= 2".
    """
    return F.filter(F.split(_col(c), " "), lambda t: F.length(t) >= 2)


def word_ngrams(tokens, n_min: int = 1, n_max: int = 1) -> Column:
    """Contiguous n-grams of a token array joined by single spaces.

    Built by zipping shifted slices, so the token array is evaluated once
    per row (a lambda that indexes the array would recompute it per gram)."""
    toks = _col(tokens)
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(toks)
            continue
        count = F.greatest(F.size(toks) - (n - 1), F.lit(0))
        grams = F.slice(toks, 1, count)
        for k in range(1, n):
            grams = F.zip_with(grams, F.slice(toks, k + 1, count), lambda a, b: F.concat(a, F.lit(" "), b))
        parts.append(F.when(count > 0, grams).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_wb_ngrams(word, n_min: int = 3, n_max: int = 5) -> Column:
    """Character n-grams inside word boundaries for ONE word.

    The word is padded with a space on each side; for n = n_min.. all
    substrings of length n are produced, stopping after the first n that
    reaches the padded length (a short word yields its padded form once).
    """
    padded = F.concat(F.lit(" "), _col(word), F.lit(" "))
    # a character at a time, each with the n from it on; compiled, unlike lambdas
    grams = F.concat(*[F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1)) for n in range(n_min, n_max + 1)])
    return F.when(padded.isNull() | (F.length(padded) < n_min), F.array(padded)).otherwise(grams)


def text_char_wb_ngrams(tokens, n_min: int = 3, n_max: int = 5) -> Column:
    """char_wb n-grams of every word of a token array, flattened."""
    return F.flatten(F.transform(_col(tokens), lambda w: char_wb_ngrams(w, n_min, n_max)))
