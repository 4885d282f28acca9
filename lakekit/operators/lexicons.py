"""Categories and sentiment of texts by lexicons that are tables: terms with a label and a weight, joined to the words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.functions.text import words
from lakekit.operators.joins import broadcast_if_small
from lakekit.values import NO_CATEGORY

# Words before a term among which a negator turns its sense, and how far one side must outweigh the other.
NEGATION_WINDOW = 3
CLEAR = 2


def text_words(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, word) for every word of every text; texts shuffle nowhere, only words go on."""
    return df.select(F.col(key).alias("_key"), F.posexplode(words(text)).alias("_pos", "_word"))


def found_terms(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """(key, pos, label, weight) for every word that is a term; a term may have several labels.

    A lexicon that is small by its stored size goes to the words; beyond that both are joined by word, and Spark splits the
    words that occur very often.
    """
    terms = lexicon.select(F.col("term").alias("_word"), "label", "weight")
    return text_words(df, key, text).join(broadcast_if_small(terms), "_word").select("_key", "_pos", "label", "weight")


def categorise(
    df: DataFrame, key: str, text: str, lexicon: DataFrame, name: str = "categoria", default: str = NO_CATEGORY
) -> DataFrame:
    """(key, category) of each text that is not empty: the label whose terms weigh most, the first by name among equals.

    `lexicon` is a table (term, label, weight) of lower-case words; terms may be in several categories. Weights are added up
    per text and label where the words are, before anything is shuffled. A text without terms, or whose best label weighs
    nothing, has the default. `key` names a text, rows with the same key are one.
    """
    wanted = df.where(F.col(text).isNotNull() & (F.col(text) != ""))
    scores = found_terms(wanted, key, text, lexicon).groupBy("_key", "label").agg(F.sum("weight").alias("score"))
    best = scores.groupBy("_key").agg(F.min(F.struct((-F.col("score")).alias("less"), "label")).alias("best"))
    chosen = F.when(F.col("best.less") < 0, F.col("best.label")).otherwise(F.lit(default))
    keys = wanted.select(F.col(key).alias("_key")).distinct()
    return keys.join(best, "_key", "left").select(F.col("_key").alias(key), chosen.alias(name))


def sentiment_scores(
    df: DataFrame, key: str, text: str, lexicon: DataFrame, negators: DataFrame, window: int = NEGATION_WINDOW
) -> DataFrame:
    """(key, positive, negative): the weights of a text's judging words on either side.

    `lexicon` is a table (term, weight), a negative weight being a negative judgement, `negators` a table (term). A judging
    word changes sides if a negator is among the `window` words before it. Texts without judging words have 0 and 0.
    """
    judging = lexicon.select("term", F.lit("judges").alias("label"), "weight")
    turning = negators.select("term", F.lit("turns").alias("label"), F.lit(0).cast(lexicon.schema["weight"].dataType).alias("weight"))
    found = found_terms(df, key, text, judging.unionByName(turning))
    before = Window.partitionBy("_key").orderBy("_pos").rangeBetween(-window, -1)
    turned = F.coalesce(F.count_if(F.col("label") == "turns").over(before), F.lit(0)) > 0
    signed = found.withColumn("weight", F.when(turned, -F.col("weight")).otherwise(F.col("weight"))).where("label = 'judges'")

    def side(weight: Column) -> Column:
        return F.sum(F.when(weight > 0, weight).otherwise(F.lit(0)))

    sums = signed.groupBy("_key").agg(side(F.col("weight")).alias("positive"), side(-F.col("weight")).alias("negative"))
    keys = df.select(F.col(key).alias("_key")).distinct()
    sides = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("positive", "negative")]
    return keys.join(sums, "_key", "left").select(F.col("_key").alias(key), *sides)


def sentiment_label(positive: Column, negative: Column, clear: int = CLEAR) -> Column:
    """'neutral' without judging words, 'mixed' if no side weighs `clear` times the other."""
    return (
        F.when((positive == 0) & (negative == 0), "neutral")
        .when(positive >= clear * negative, "positive")
        .when(negative >= clear * positive, "negative")
        .otherwise("mixed")
    )


def frequent_terms(df: DataFrame, key: str, text: str, label: str, n: int) -> DataFrame:
    """A lexicon from labelled texts: per label the n words that most of its texts use, weighted by how many per thousand do."""
    used = df.where(F.col(label).isNotNull()).select(F.col(key).alias("_key"), F.col(label).alias("label"), F.explode(F.array_distinct(words(text))).alias("term"))
    texts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("texts"))
    counted = used.groupBy("label", "term").agg(F.count(F.lit(1)).alias("uses"))
    first = Window.partitionBy("label").orderBy(F.desc("uses"), "term")
    best = counted.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= n).drop("_rank")
    weight = F.expr("1000 * uses div texts").cast("bigint")
    return best.join(texts, "label").select("term", "label", weight.alias("weight"))


def opposed_terms(df: DataFrame, key: str, text: str, good: Column, least: int) -> DataFrame:
    """A lexicon (term, weight) from texts judged good or not: words that one side's texts use clearly more often.

    Compared are shares of texts in whole numbers: half as often again gives a weight of 1, three times as often 2. Words in
    fewer than `least` texts, and texts without a judgement, are left out.
    """
    judged = df.withColumn("_good", good).where(F.col("_good").isNotNull())
    total = judged.agg(F.count_if("_good").alias("good_texts"), F.count_if(~F.col("_good")).alias("bad_texts"))
    used = judged.select("_good", F.explode(F.array_distinct(words(text))).alias("term"))
    counted = used.groupBy("term").agg(F.count_if("_good").alias("p"), F.count_if(~F.col("_good")).alias("q"))
    mine = F.col("p") * total.select("bad_texts").scalar()
    other = F.col("q") * total.select("good_texts").scalar()

    def strength(a: Column, b: Column) -> Column:
        return F.when(a >= 3 * b, F.lit(2)).when(2 * a >= 3 * b, F.lit(1))

    weight = F.coalesce(strength(mine, other), -strength(other, mine))
    return counted.where(F.col("p") + F.col("q") >= least).select("term", weight.cast("bigint").alias("weight")).where("weight IS NOT NULL")
