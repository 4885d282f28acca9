"""Deterministic text rules as column expressions: no Python runs per row.

Matches are whole, however long. Where that would make Java search a long run again and again, a pattern starts only at a
run's beginning or where the last match ended, and `PLAIN` has the form without that, which finds the same matches in engines
that search in linear time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakekit.functions.columns import col
from lakekit.values import NEGATIVE_WORDS, NO_CATEGORY, POSITIVE_WORDS

# Patterns of fields that can be read out of, or masked in, free text. Word edges keep numbers out of longer ones.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9.-]+[.][A-Za-z]{{2,}}"
PHONE = r"[+][0-9][0-9 ().-]{5,}[0-9]"
IP_ADDRESS = r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}"
CARD_NUMBER = r"\b(?:[0-9]{13,19}|(?:[0-9]{4}[ -]){3}[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})\b"
SECRET = r"\b[0-9a-f]{32,}+\b"
# The same without lookbehind and possessive repeats.
PLAIN = {EMAIL: rf"[{_LOCAL}]+@[A-Za-z0-9.-]+[.][A-Za-z]{{2,}}", SECRET: r"\b[0-9a-f]{32,}\b"}
TAX_ID = r"[0-9]{3}[.][0-9]{3}[.][0-9]{3}-[0-9]"
INVOICE_NUMBER = r"[A-Z]-[0-9]{4}-[0-9]{5}"
AMOUNT = r"(?:COP|USD|EUR) [0-9][0-9.,]*[0-9]"

# A character that every match of a pattern contains: texts without it need no search.
ANCHORS = {EMAIL: "@", PHONE: "+", TAX_ID: "-", INVOICE_NUMBER: "-"}

MASKED_ENTITIES = {
    "[SECRET]": SECRET,
    "[EMAIL]": EMAIL,
    "[PHONE]": PHONE,
    "[TAX_ID]": TAX_ID,
    "[CARD]": CARD_NUMBER,
    "[IP]": IP_ADDRESS,
}


def words(text: str | Column) -> Column:
    """Lower-case words of a text, in order, without empty ones."""
    return F.filter(F.split(F.lower(col(text)), r"[^\p{L}]+"), lambda w: w != "")


def words_among(text: str | Column, wanted: Iterable[str]) -> Column:
    """The words of a text that are in a fixed list: one pass over the text, a short array after it."""
    listed = sorted(set(wanted))
    return F.filter(F.split(F.lower(col(text)), r"[^\p{L}]+"), lambda w: w.isin(listed))


def hits(tokens: Column, wanted: Iterable[str]) -> Column:
    """Number of tokens that are in a fixed word list."""
    listed = list(wanted)
    return F.size(F.filter(tokens, lambda w: w.isin(listed)))


def best_category(
    tokens: Column, categories: Mapping[str, Sequence[str]], default: str = NO_CATEGORY
) -> Column:
    """Category whose words occur most often among the tokens; the first one listed wins a tie.

    Tokens that are in no list may be left out.
    """
    scores = [
        F.struct(
            F.coalesce(hits(tokens, wanted), F.lit(0)).alias("score"),
            F.lit(-i).alias("order"),
            F.lit(name).alias("name"),
        )
        for i, (name, wanted) in enumerate(categories.items())
    ]
    best = F.array_max(F.array(*scores))
    return F.when(best["score"] > 0, best["name"]).otherwise(F.lit(default))


def sentiment(
    tokens: Column,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> Column:
    """'positive', 'negative', 'mixed' or 'neutral' by the judging words among the tokens."""
    good, bad = hits(tokens, positive) > 0, hits(tokens, negative) > 0
    return (
        F.when(good & bad, "mixed").when(good, "positive").when(bad, "negative").otherwise("neutral")
    )


def _where_possible(text: Column, pattern: str, searched: Column, otherwise: Column) -> Column:
    """The searched value, but only for texts that can match at all."""
    anchor = ANCHORS.get(pattern)
    return F.when(F.contains(text, F.lit(anchor)), searched).otherwise(otherwise) if anchor else searched


def extract_fields(text: str | Column, fields: Mapping[str, str]) -> Column:
    """Struct with the first match of each field's pattern, NULL where there is none."""
    source = col(text)
    return F.struct(
        *[
            _where_possible(
                source, pattern, F.nullif(F.regexp_extract(source, pattern, 0), F.lit("")), F.lit(None)
            ).alias(name)
            for name, pattern in fields.items()
        ]
    )


def mask_entities(text: str | Column, entities: Mapping[str, str] = MASKED_ENTITIES) -> Column:
    """Every match of the entity patterns replaced by its label, in the order given."""
    masked = col(text)
    for label, pattern in entities.items():
        masked = _where_possible(masked, pattern, F.regexp_replace(masked, pattern, label), masked)
    return masked


def normalise_description(text: str | Column, max_words: int = 10) -> Column:
    """Blanks collapsed, every word capitalised, at most so many words."""
    squeezed = F.trim(F.regexp_replace(col(text), r"\s+", " "))
    return F.array_join(F.slice(F.split(F.initcap(squeezed), " "), 1, max_words), " ")
