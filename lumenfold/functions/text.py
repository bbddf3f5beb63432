"""Tokens, languages and stems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TOKEN = r"[\p{L}\p{N}]+"
TOKEN_OR_MARK = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"

# Frequent function words per language.
STOP_WORDS = {
    "de": ["aber", "als", "am", "an", "auch", "auf", "aus", "bei", "das", "dem", "den", "der", "des", "die", "ein",
           "eine", "er", "es", "für", "hat", "ich", "im", "in", "ist", "mit", "nicht", "sich", "sie", "und", "von",
           "wie", "zu"],
    "en": ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "has", "have", "in", "is", "it",
           "not", "of", "on", "or", "that", "the", "their", "they", "this", "to", "was", "were", "which", "with"],
    "es": ["a", "al", "como", "con", "de", "del", "el", "en", "es", "la", "las", "lo", "los", "más", "no", "o", "para",
           "pero", "por", "que", "se", "sin", "su", "un", "una", "y"],
    "fr": ["au", "aux", "avec", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les",
           "mais", "ne", "ou", "par", "pas", "pour", "que", "qui", "se", "sur", "un", "une"],
}


def tokens(text: str | Column, keep_punctuation: bool = False) -> Column:
    """Lower-case runs of letters and digits (and, if wanted, single marks)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_OR_MARK if keep_punctuation else TOKEN), F.lit(0))


def explode_words(df: DataFrame, words: str | Column, *keep: str, name: str = "term") -> DataFrame:
    """One row per token. The outer form keeps the optimizer from copying the token expression into a pre-filter."""
    return df.select(*keep, F.explode_outer(words).alias(name)).where(F.col(name).isNotNull())


def stop_word_array(lang: str) -> Column:
    return F.array(*[F.lit(w) for w in STOP_WORDS[lang]])


def language_hits(words: Column, lang: str) -> Column:
    """Distinct stop words of a language that occur among the tokens."""
    return F.size(F.array_intersect(words, stop_word_array(lang)))


def detect_language(words: Column, languages: tuple[str, ...] = ("en", "fr", "de", "es")) -> Column:
    """Language with the most stop-word hits; earlier languages win ties, so en wins when nothing is found."""
    hits = {lang: language_hits(words, lang) for lang in languages}
    top = F.greatest(*hits.values())
    return F.coalesce(*[F.when(h == top, F.lit(lang)) for lang, h in hits.items()])


def without_stop_words(words: Column, lang: Column) -> Column:
    """Tokens that are no stop words of the row's language."""
    def keep(code):
        return lambda t: ~t.isin(STOP_WORDS[code])
    out = words
    for code in STOP_WORDS:
        out = F.when(lang == code, F.filter(words, keep(code))).otherwise(out)
    return out


# Endings taken off by the light stemmer, per language.
ENDINGS = {
    "de": ["ungen", "ung", "ern", "em", "en", "er", "es", "e", "n", "s"],
    "en": ["ations", "ation", "ingly", "ings", "ing", "edly", "ness", "ment", "ies", "ed", "es", "ly", "s"],
    "es": ["aciones", "ación", "mente", "ando", "iendo", "ados", "adas", "ado", "ada", "os", "as", "es", "o", "a", "s"],
    "fr": ["ements", "ement", "ations", "ation", "euses", "euse", "eaux", "ées", "ée", "és", "er", "es", "é", "e", "s", "x"],
}
STEM_MIN = 3


def stem_pattern(lang: str) -> str:
    """Longest listed ending after at least STEM_MIN characters."""
    endings = sorted(ENDINGS[lang], key=len, reverse=True)
    return "^(.{%d,}?)(%s)$" % (STEM_MIN, "|".join(endings))


def stem(words: Column, lang: Column) -> Column:
    """Tokens without the ending of the row's language."""
    def cut(code):
        return lambda t: F.regexp_replace(t, stem_pattern(code), "$1")
    out = words
    for code in ENDINGS:
        out = F.when(lang == code, F.transform(words, cut(code))).otherwise(out)
    return out
