"""Scalar text functions as native Spark column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from prioritext.constants import HIGH_QUANTILE, LOW_QUANTILE  # noqa: F401  (re-exported defaults)

# Token rule of the text model: runs of two or more word characters.
TOKEN_PATTERN = r"(?U)\b\w\w+\b"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def escape_term(term: str) -> str:
    """Escape one literal term for a Java / RE2 regex (punctuation only)."""
    return "".join(ch if ch.isalnum() or ch == "_" or ch == " " else "\\" + ch for ch in term)


def term_alternation(terms: Sequence[str]) -> str:
    """``a|b|c`` over escaped terms, in listed order (leftmost alternative wins)."""
    if not terms:
        raise ValueError("a lexicon needs at least one term")
    return "|".join(escape_term(t) for t in terms)


def lexicon_pattern(terms: Sequence[str]) -> str:
    """Whole-word, case-insensitive (Unicode case folding) alternation.

    A lookahead on the set of first letters lets the matcher reject most
    word starts before trying every alternative (about 30 % faster); under
    Unicode case folding a class folds like the literals, so matches are
    unchanged.
    """
    firsts = sorted({t[0].lower() for t in terms})
    cls = "".join(c if c.isalnum() else "\\" + c for c in firsts)
    return rf"(?iuU)\b(?=[{cls}])(?:{term_alternation(terms)})\b"


def lexicon_hits(text: str | Column, terms: Sequence[str]) -> Column:
    """Number of non-overlapping whole-word lexicon hits in ``text`` (INT)."""
    return F.regexp_count(_col(text), F.lit(lexicon_pattern(terms)))


def urgency_score(
    text: str | Column,
    prior: str | Column | float,
    raising_terms: Sequence[str],
    lowering_terms: Sequence[str],
) -> Column:
    """``double(raising hits - lowering hits) + prior``; an unknown prior counts 0.0.

    The subtraction is done on integers and cast once, then the prior is
    added: the same operation order as the original, so doubles are equal
    bit for bit.
    """
    prior_col = F.lit(float(prior)) if isinstance(prior, (int, float)) else _col(prior)
    diff = lexicon_hits(text, raising_terms) - lexicon_hits(text, lowering_terms)
    return diff.cast("double") + F.coalesce(prior_col.cast("double"), F.lit(0.0))


def map_band(
    score: str | Column,
    low: str | Column | float,
    high: str | Column | float,
    labels: Sequence[str] = ("normal", "atencao", "urgente"),
) -> Column:
    """Three bands: ``score < low`` -> labels[0], ``[low, high)`` -> labels[1], else labels[2].

    A null or NaN score has no band (null).
    """
    s = _col(score)
    lo = F.lit(low) if isinstance(low, (int, float)) else _col(low)
    hi = F.lit(high) if isinstance(high, (int, float)) else _col(high)
    return F.when(s < lo, labels[0]).when(s < hi, labels[1]).when(s.isNotNull() & ~F.isnan(s.cast("double")), labels[2])


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(from, to) strings for ``translate``: accented Latin letters -> base letter.

    Built by rule, not by hand: every code point of the Latin-1 supplement,
    Latin extended-A/B and Latin extended additional blocks whose compatibility decomposition, with
    combining marks dropped, is a single different character.  Letters with
    no decomposition (``ß``, ``æ``, ``ø``) stay, as with NFKD.
    """
    src, dst = [], []
    for cp in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        ch = chr(cp)
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


# Combining marks of decomposed letters: no counterpart, so ``translate`` deletes them.
COMBINING_MARKS = "".join(map(chr, range(0x0300, 0x0370)))


def translation() -> tuple[str, str]:
    """The whole (from, to) pair of every path that normalises: accented letters, then marks to delete."""
    src, dst = accent_table()
    return src + COMBINING_MARKS, dst


def is_ascii(text: str | Column) -> Column:
    """Whether every character takes one byte; null for a null text."""
    c = _col(text)
    return F.octet_length(c) == F.char_length(c)


def normalize_text(text: str | Column) -> Column:
    """Lower-case, then strip accents of Latin letters (native ``translate``, which ASCII texts need not pass)."""
    src, dst = translation()
    lowered = F.lower(_col(text))
    return F.when(is_ascii(text), lowered).otherwise(F.translate(lowered, src, dst))


def tokens(normalized: str | Column) -> Column:
    """ARRAY<STRING> of tokens (runs of >= 2 word characters), in text order."""
    return F.regexp_extract_all(_col(normalized), F.lit(TOKEN_PATTERN), 0)


# Bigram rule over the space-joined tokens: at every token start, capture the
# token and its successor (tokens never hold a space), then go to the next
# token; matches follow each other, so no other place is looked at.
BIGRAM_PATTERN = r"(?=(\S++ \S++))\S++ "


def ngrams(toks: str | Column) -> Column:
    """Unigrams followed by bigrams (joined by one space), in text order.

    Bigrams come from one regex pass over the space-joined tokens (a native,
    codegen expression) instead of per-element lambdas; a text with fewer
    than two tokens has no bigram.
    """
    t = _col(toks)
    bigrams = F.regexp_extract_all(F.array_join(t, " "), F.lit(BIGRAM_PATTERN), 1)
    return F.concat(t, bigrams)


def non_ascii(text: str | Column) -> Column:
    """TRUE when the text holds any character outside 7-bit ASCII."""
    return _col(text).rlike(r"[^\x00-\x7F]")


def blank_text(text: str | Column) -> Column:
    """NULL or only Unicode white space (what ``str.strip() == ''`` means)."""
    c = _col(text)
    return c.isNull() | c.rlike(r"(?U)^\s*$")


def in_values(c: str | Column, values: Iterable[str]) -> Column:
    return _col(c).isin(list(values))


def presence_count(text: str | Column, terms: Sequence[str]) -> Column:
    """Number of distinct lexicon terms present (case-insensitive)."""
    found = F.regexp_extract_all(_col(text), F.lit(lexicon_pattern(terms)), 0)
    return F.size(F.array_distinct(F.transform(found, lambda x: F.lower(x))))


def presence_score(
    text: str | Column,
    prior: str | Column | float,
    raising_terms: Sequence[str],
    lowering_terms: Sequence[str],
) -> Column:
    """Binary-presence score variant: distinct raising terms - distinct lowering terms + prior."""
    prior_col = F.lit(float(prior)) if isinstance(prior, (int, float)) else _col(prior)
    diff = presence_count(text, raising_terms) - presence_count(text, lowering_terms)
    return diff.cast("double") + F.coalesce(prior_col.cast("double"), F.lit(0.0))


def word_count(text: str | Column) -> Column:
    """Words = runs of characters other than space, tab, CR, LF."""
    return F.regexp_count(_col(text), F.lit(r"[^ \t\n\r]+"))


def normalize_text_unicode(text: str | Column) -> Column:
    """Opt-in full Unicode accent stripping (NFKD, combining marks dropped)
    for scripts outside the Latin table, as an Arrow-batched pandas UDF.

    ``normalize_text`` (native ``translate``) is the default and equals this
    on Latin text; use this one only where other scripts carry accents.
    """
    return _unicode_strip_udf()(F.lower(_col(text)))


@lru_cache(maxsize=1)
def _unicode_strip_udf():
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def strip(s: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            return "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))

        return s.map(one)

    return strip
