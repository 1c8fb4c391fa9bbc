"""Script-safe text expressions: cleaning, tokens, prompts, sentinels, n-grams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.names import LANGUAGES

# The 29 code points counted as whitespace. A regex shorthand
# will not do: Java's ``\s`` knows only six of them.
WS = r"[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# A run of whitespace; the lookahead passes printable ASCII quickly.
WS_RUN = rf"(?![!-~]){WS}+"

# Placeholder tokens a seq2seq generator may leak.
SENTINEL = r"<extra_id_\p{Nd}+>"

# The prompt templates, by style.
PROMPT_STYLES = ("bare", "instruction", "lang_prefix")
INSTRUCTION_LEAD = "Answer this health question in "
REFERENCE_LEAD = "\nReference: "


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{WS}+|{WS}+\z", "")


def clean_text(c: Column) -> Column:
    """Null to empty, whitespace runs to one space, ends stripped. Case is kept."""
    return F.trim(F.regexp_replace(_blank(c), WS_RUN, " "))


def has_text(c: Column) -> Column:
    """True unless ``clean_text`` would give the empty string (stops at once)."""
    return F.rlike(_blank(c), F.lit(WS.replace("[", "[^", 1)))


def clean_strip(c: Column) -> Column:
    """Null to empty, ends stripped, inner whitespace kept."""
    return strip_ws(_blank(c))


def tokenize_ws(c: Column, first: int | None = None) -> Column:
    """Words between whitespace, all or the ``first`` ones; the rest of the text is then not split."""
    # a blank start gives an empty piece, the last piece is what is left
    limit = -1 if first is None else first + 2
    words = F.array_remove(F.split(_blank(c), WS_RUN, limit), "")
    return words if first is None else F.slice(words, 1, first)


def word_count(c: Column) -> Column:
    return F.size(tokenize_ws(c)).cast("long")


def language_name(subset: Column, languages: Mapping[str, str] = LANGUAGES) -> Column:
    """Display name of a subset code; unknown prefixes give back the whole code."""
    pairs = [F.lit(x) for item in languages.items() for x in item]
    known = F.element_at(F.create_map(*pairs), F.substring_index(subset, "_", 1))
    return F.when(_blank(subset) == "", F.lit("English")).otherwise(
        F.coalesce(known, subset)
    )


def build_prompt(
    question: Column,
    subset: Column,
    style: str = "lang_prefix",
    retrieved: Column | None = None,
    languages: Mapping[str, str] = LANGUAGES,
) -> Column:
    """Generator input for a question, optionally followed by an exemplar answer."""
    if style not in PROMPT_STYLES:
        raise ValueError(f"unknown prompt style {style!r}; use one of {PROMPT_STYLES}")
    text = clean_text(question)
    lang = language_name(subset, languages)
    if style == "instruction":
        text = F.concat(F.lit(INSTRUCTION_LEAD), lang, F.lit(": "), text)
    elif style == "lang_prefix":
        text = F.concat(lang, F.lit(": "), text)
    if retrieved is None:
        return text
    return F.when(
        _blank(retrieved) != "",
        F.concat(text, F.lit(REFERENCE_LEAD), clean_text(retrieved)),
    ).otherwise(text)


def sentinel_cleanup(c: Column) -> Column:
    """Sentinels to spaces, one pass of double space to single, ends stripped."""
    spaced = F.regexp_replace(_blank(c), SENTINEL, " ")
    return strip_ws(F.replace(spaced, F.lit("  "), F.lit(" ")))


def sentinel_delete(c: Column) -> Column:
    """Sentinels removed without a trace, ends stripped."""
    return strip_ws(F.regexp_replace(_blank(c), SENTINEL, ""))


def latin_fraction(c: Column) -> Column:
    """ASCII letters over all letters; 0 when the text has no letter."""
    letters = F.length(F.regexp_replace(_blank(c), r"[^\p{L}]+", ""))
    ascii_letters = F.length(F.regexp_replace(_blank(c), r"[^A-Za-z]+", ""))
    return F.when(letters > 0, ascii_letters / letters).otherwise(F.lit(0.0))


def char_ngrams(c: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside space-padded words, with repeats, case kept."""
    padded = F.transform(
        tokenize_ws(c), lambda w: F.concat(F.lit(" "), w, F.lit(" "))
    )

    def of_length(word: Column, n: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.length(word) - n + 1),
            lambda i: F.substring(word, i, n),
        )

    def of_word(word: Column) -> Column:
        sizes = F.sequence(F.lit(low), F.least(F.lit(high), F.length(word)))
        return F.flatten(F.transform(sizes, lambda n: of_length(word, n)))

    # a padded word has at least three characters, so sizes never runs backwards
    if low > 3:
        padded = F.filter(padded, lambda w: F.length(w) >= low)
    return F.flatten(F.transform(padded, of_word))
