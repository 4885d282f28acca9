"""Text enrichment of tables: rules, a caller's model in batches, incremental bookkeeping, summaries, documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions import text as rules
from lakekit.functions.columns import moment, not_empty
from lakekit.operators.joins import new_keys
from lakekit.values import DOCUMENT_CATEGORIES, NEGATIVE_WORDS, NO_CATEGORY, POSITIVE_WORDS


def with_category(
    df: DataFrame,
    text: str,
    name: str = "categoria",
    categories: Mapping[str, Sequence[str]] = DOCUMENT_CATEGORIES,
    default: str = NO_CATEGORY,
) -> DataFrame:
    """Texts that are not empty, with the category whose words they use most."""
    listed = [w for wanted in categories.values() for w in wanted]
    tokens = df.where(not_empty(text)).withColumn("_tokens", rules.words_among(text, listed))
    return tokens.withColumn(name, rules.best_category(F.col("_tokens"), categories, default)).drop("_tokens")


def with_sentiment(
    df: DataFrame,
    text: str,
    name: str = "sentiment",
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> DataFrame:
    tokens = df.withColumn("_tokens", rules.words_among(text, [*positive, *negative]))
    return tokens.withColumn(name, rules.sentiment(F.col("_tokens"), positive, negative)).drop("_tokens")


def enrich_with_model(
    df: DataFrame,
    text: str,
    name: str,
    load_model: Callable[[], Callable[[pd.Series], pd.Series]],
    return_type: str = "string",
) -> DataFrame:
    """Score a text column with a caller's model.

    The model is loaded once per Python worker task and then sees Arrow batches of the text column; the other
    columns do not leave the JVM row they are in.
    """

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for batch in batches:
            yield model(batch)

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(name, F.pandas_udf(score, return_type)(F.col(text)))


def enrich_incremental(
    source: DataFrame,
    enriched: DataFrame,
    keys: Sequence[str],
    text: str,
    score: Callable[[DataFrame], DataFrame],
    model_name: str,
    processed_at: datetime | None = None,
) -> DataFrame:
    """Enriched rows for the keys that have none yet, with model name and time: the rows to append."""
    todo = new_keys(source.where(F.col(text).isNotNull()), enriched, keys)
    return score(todo).withColumns(
        {
            "modelo_ia": F.lit(model_name),
            "procesado_en": moment(processed_at) if processed_at else F.localtimestamp(),
        }
    )


def summarise_extract(df: DataFrame, key: str, text: str, max_words: int = 50, name: str = "summary") -> DataFrame:
    """The sentences whose words are most frequent in their text, up to so many words, in their old order.

    Texts are shuffled once, by key; the word counts, sentence scores and ranks that follow all work within that
    partitioning and carry no text. The sentences chosen are cut out of the same shuffled texts. The best sentence
    is kept even if it alone exceeds the limit. A text without words has the summary NULL.
    """
    texts = df.select(key, text).repartition(key)
    sentences = F.split(F.col(text), r"[.!?\n]+")
    words = (
        texts.select(key, F.posexplode(sentences).alias("_pos", "_sentence"))
        .select(key, "_pos", F.explode(rules.words("_sentence")).alias("_word"))
        .withColumn("_tf", F.count(F.lit(1)).over(Window.partitionBy(key, "_word")))
    )
    scored = words.groupBy(key, "_pos").agg(
        F.count(F.lit(1)).alias("_n"), (F.sum("_tf") / F.count(F.lit(1))).alias("_score")
    )
    best = Window.partitionBy(key).orderBy(F.desc("_score"), F.asc("_pos"))
    so_far = best.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = (
        scored.withColumns({"_rank": F.row_number().over(best), "_total": F.sum("_n").over(so_far)})
        .where((F.col("_total") <= max_words) | (F.col("_rank") == 1))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list("_pos")).alias("_chosen"))
    )
    picked = F.filter(sentences, lambda _, pos: F.array_contains("_chosen", pos))
    trimmed = F.transform(picked, lambda sentence: F.trim(sentence))
    summary = F.when(F.col("_chosen").isNotNull(), F.array_join(trimmed, ". "))
    return texts.join(chosen, key, "left").select(key, summary.alias(name))


def document_text(
    elements: DataFrame, key: str, position: str, text: str, rows_per_part: int = 1000, name: str = "document_text"
) -> DataFrame:
    """Elements joined to text in order, one row per document.

    Spans of positions are joined first, each in some task; then a document's spans are joined, so what meets in the
    end is its text and no row per element.
    """
    part = F.floor(F.col(position) / rows_per_part).cast("long")
    in_order = F.array_sort(F.collect_list(F.struct(F.col(position), F.col(text).alias("_text"))))
    spans = elements.groupBy(key, part.alias("_part")).agg(
        F.array_join(F.transform(in_order, lambda e: e["_text"]), "\n").alias("_span")
    )
    parts = F.array_sort(F.collect_list(F.struct("_part", "_span")))
    return spans.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["_span"]), "\n").alias(name))


def variant_document_text(document: Column, elements: str = "$.document.elements") -> Column:
    """Text of a parsed document held as VARIANT: its elements' content, one per line."""
    contents = F.variant_get(document, elements, "array<struct<content: string>>")
    return F.array_join(F.transform(contents, lambda e: e["content"]), "\n")


def document_fields(
    documents: DataFrame,
    key: str,
    text: str,
    fields: Mapping[str, str],
    constants: Mapping[str, object],
    processed_at: datetime,
) -> DataFrame:
    """One structured row per document: extracted fields, constants and the processing time."""
    extracted = documents.select(key, rules.extract_fields(text, fields).alias("_fields"))
    return extracted.select(
        key,
        "_fields.*",
        *[F.lit(value).alias(name) for name, value in constants.items()],
        moment(processed_at).alias("_procesado_at"),
    )
