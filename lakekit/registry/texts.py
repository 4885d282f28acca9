"""Registered queries: text and document enrichment over whole texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from lakekit.functions import text as rules
from lakekit.operators import enrich, lexicons
from lakekit.operators.cleaning import value_counts
from lakekit.plans.briefs import customer_brief
from lakekit.registry import inputs
from lakekit.sources import erp
from lakekit.sources.workspace import written

# Categories of the given documents: common words of each language.
LANGUAGES = {
    "inglés": ("the", "of", "and", "to", "is", "with"),
    "francés": ("le", "la", "et", "des", "un", "les"),
    "alemán": ("der", "die", "und", "den", "von", "zu"),
    "español": ("que", "de", "el", "en", "los", "por"),
}
# Terms per language, texts that a judging word must be in, and words that turn the sense of those after them.
TERMS, LEAST_TEXTS = 500, 3
NEGATORS = ("not", "no", "never", "nicht", "kein", "keine", "sin", "nunca", "ne", "pas", "sans")
FIELDS = {
    "email": rules.EMAIL,
    "phone": rules.PHONE,
    "ip_address": rules.IP_ADDRESS,
    "card_number": rules.CARD_NUMBER,
    "secret": rules.SECRET,
}


def _documents(spark, d):
    return erp.read_table(spark, d, "documents").select("doc_id", "text")


def _size_classes(spark, d):
    """A stand-in for a caller's model: the size class of a text."""

    def load_model():
        def score(texts: pd.Series) -> pd.Series:
            return "size " + (texts.str.len().astype("Int64") // 1000).astype("string")

        return score

    return enrich.enrich_with_model(_documents(spark, d), "text", "size_class", load_model).drop("text")


def _categories(spark, d):
    return enrich.with_category(_documents(spark, d), "text", "categoria", LANGUAGES)


def _by_lexicon(spark, d):
    """Documents by language: the words that most documents of a language use are its terms."""
    documents = erp.read_table(spark, d, "documents").select("doc_id", "text", "lang")
    lexicon = written(lexicons.frequent_terms(documents, "doc_id", "text", "lang", TERMS), "lexicon")
    return lexicons.categorise(documents, "doc_id", "text", lexicon)


def _sentiment(spark, d):
    """Judgement of documents by the words that documents labelled as good or bad use more often."""
    documents, labels = _documents(spark, d), erp.read_table(spark, d, "labels").select("doc_id", "quality")
    judged = documents.join(labels, "doc_id")
    lexicon = written(lexicons.opposed_terms(judged, "doc_id", "text", F.col("quality") == 1, LEAST_TEXTS), "lexicon")
    negators = spark.createDataFrame([(w,) for w in NEGATORS], "term string")
    scores = lexicons.sentiment_scores(documents, "doc_id", "text", lexicon, negators)
    return scores.withColumn("sentiment", lexicons.sentiment_label(F.col("positive"), F.col("negative")))


def _incremental(spark, d):
    return enrich.enrich_incremental(
        _documents(spark, d),
        erp.read_table(spark, d, "labels"),
        ["doc_id"],
        "text",
        lambda todo: enrich.with_category(todo, "text", "categoria_ia", LANGUAGES).drop("text"),
        "reglas-v1",
        inputs.CLOCK,
    )


def _variant_text(spark, d):
    """Documents as parsed trees of elements, and their text read back out of the tree."""
    elements = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("content")))
    tree = F.parse_json(F.to_json(F.struct(F.struct(elements.alias("elements")).alias("document"))))
    return _documents(spark, d).select("doc_id", enrich.variant_document_text(tree).alias("document_text"))


QUERIES = {
    "enrich_with_model": _size_classes,
    "enrich_incremental": _incremental,
    "classify_keywords": lambda s, d: _categories(s, d).drop("text"),
    "category_distribution": lambda s, d: value_counts(_categories(s, d), "categoria"),
    "classify_lexicon": _by_lexicon,
    "sentiment_lexicon": _sentiment,
    "extract_fields": lambda s, d: _documents(s, d)
    .select("doc_id", rules.extract_fields("text", FIELDS).alias("f"))
    .select("doc_id", "f.*"),
    "mask_entities": lambda s, d: _documents(s, d).select("doc_id", rules.mask_entities("text").alias("masked")),
    "summarise_extract": lambda s, d: enrich.summarise_extract(_documents(s, d), "doc_id", "text", 40),
    "normalise_description": lambda s, d: erp.read_table(s, d, "part").select(
        "p_partkey", rules.normalise_description(F.concat(F.lit("  "), "p_name", F.lit("  "), "p_type"), 3).alias("name")
    ),
    "customer_brief": lambda s, d: customer_brief(erp.order_headers(s, d), erp.kna1(s, d), 5),
    "document_text": lambda s, d: enrich.document_text(
        erp.read_table(s, d, "conversations"), "conv_id", "turn", "text"
    ),
    "document_tree_text": _variant_text,
    "document_fields": lambda s, d: enrich.document_fields(
        _documents(s, d), "doc_id", "text", FIELDS, {"departamento": "Antioquia", "uso": "Industrial"}, inputs.CLOCK
    ),
}


def _tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}]+'), lambda w: w <> '')"


def _hits(wanted) -> str:
    listed = ", ".join(f"'{w}'" for w in wanted)
    return f"len(list_filter(tokens, lambda w: w IN ({listed})))"


SCORES = ", ".join(f"{_hits(words)} AS s{i}" for i, words in enumerate(LANGUAGES.values()))
BEST = "greatest(s0, s1, s2, s3)"
LABEL = (
    f"CASE WHEN {BEST} = 0 THEN 'Otro' "
    + " ".join(f"WHEN s{i} = {BEST} THEN '{name}'" for i, name in enumerate(LANGUAGES))
    + " END"
)
SCORED = f"""tok AS (SELECT doc_id, {_tokens('text')} AS tokens FROM documents WHERE text <> ''),
    scored AS (SELECT doc_id, {SCORES} FROM tok)"""
EXTRACTED = ", ".join(f"nullif(regexp_extract(text, '{rules.PLAIN.get(p, p)}'), '') AS {name}" for name, p in FIELDS.items())


def _masked() -> str:
    text = "text"
    for label, pattern in rules.MASKED_ENTITIES.items():
        text = f"regexp_replace({text}, '{rules.PLAIN.get(pattern, pattern)}', '{label}', 'g')"
    return text


ORACLES = {
    "enrich_with_model": """SELECT doc_id, 'size ' || CAST(length(text) // 1000 AS VARCHAR) AS size_class
        FROM documents""",
    "enrich_incremental": f"""WITH {SCORED} SELECT doc_id, {LABEL} AS categoria_ia, 'reglas-v1' AS modelo_ia,
        TIMESTAMP '2024-06-01 08:00:00' AS procesado_en FROM scored
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "classify_keywords": f"WITH {SCORED} SELECT doc_id, {LABEL} AS categoria FROM scored",
    "category_distribution": f"""WITH {SCORED}, c AS (SELECT {LABEL} AS categoria, count(*) AS n FROM scored GROUP BY 1)
        SELECT categoria, n AS num_rows, CAST((2 * CAST(n AS HUGEINT) * 1000 + t) // (2 * t) AS DOUBLE) / 10
            AS percent_of_total FROM (SELECT *, CAST(sum(n) OVER () AS HUGEINT) AS t FROM c)""",
    "classify_lexicon": f"""WITH tok AS (SELECT doc_id, lang, {_tokens('text')} AS tokens FROM documents),
        used AS (SELECT lang, unnest(list_distinct(tokens)) AS term FROM tok WHERE lang IS NOT NULL),
        n AS (SELECT lang, count(*) AS texts FROM documents WHERE lang IS NOT NULL GROUP BY lang),
        best AS (SELECT lang, term, count(*) AS uses FROM used GROUP BY lang, term
            QUALIFY row_number() OVER (PARTITION BY lang ORDER BY uses DESC, term) <= {TERMS}),
        lexicon AS (SELECT term, lang AS label, 1000 * uses // texts AS weight FROM best JOIN n USING (lang)),
        word AS (SELECT doc_id, unnest(tokens) AS term FROM tok WHERE doc_id IN (SELECT doc_id FROM documents WHERE text <> '')),
        score AS (SELECT doc_id, label, sum(weight) AS score FROM word JOIN lexicon USING (term) GROUP BY doc_id, label),
        top AS (SELECT doc_id, label FROM score WHERE score > 0
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) = 1)
        SELECT doc_id, coalesce(label, 'Otro') AS categoria
        FROM (SELECT DISTINCT doc_id FROM documents WHERE text <> '') LEFT JOIN top USING (doc_id)""",
    "sentiment_lexicon": f"""WITH tok AS (SELECT doc_id, {_tokens('text')} AS tokens FROM documents),
        judged AS (SELECT tokens, quality = 1 AS good FROM tok JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
        total AS (SELECT count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE NOT good) AS b FROM judged),
        used AS (SELECT good, unnest(list_distinct(tokens)) AS term FROM judged),
        counted AS (SELECT term, count(*) FILTER (WHERE good) AS p, count(*) FILTER (WHERE NOT good) AS q FROM used GROUP BY term),
        lexicon AS (SELECT term, CASE WHEN p * b >= 3 * q * g THEN 2 WHEN 2 * p * b >= 3 * q * g THEN 1
            WHEN q * g >= 3 * p * b THEN -2 WHEN 2 * q * g >= 3 * p * b THEN -1 END AS w
            FROM counted, total WHERE p + q >= {LEAST_TEXTS}),
        word AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM tok),
        turning AS (SELECT doc_id, pos FROM word WHERE term IN ({', '.join(f"'{w}'" for w in NEGATORS)})),
        hit AS (SELECT word.doc_id, word.pos, w FROM word JOIN lexicon USING (term) WHERE w IS NOT NULL),
        signed AS (SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM turning t WHERE t.doc_id = hit.doc_id
            AND t.pos BETWEEN hit.pos - 3 AND hit.pos - 1) THEN -w ELSE w END AS w FROM hit),
        sums AS (SELECT doc_id, sum(greatest(w, 0))::BIGINT AS positive, sum(greatest(-w, 0))::BIGINT AS negative
            FROM signed GROUP BY doc_id),
        every AS (SELECT doc_id, coalesce(positive, 0) AS positive, coalesce(negative, 0) AS negative
            FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN sums USING (doc_id))
        SELECT *, CASE WHEN positive = 0 AND negative = 0 THEN 'neutral' WHEN positive >= 2 * negative THEN 'positive'
            WHEN negative >= 2 * positive THEN 'negative' ELSE 'mixed' END AS sentiment FROM every""",
    "extract_fields": f"SELECT doc_id, {EXTRACTED} FROM documents",
    "mask_entities": f"SELECT doc_id, {_masked()} AS masked FROM documents",
    "summarise_extract": f"""WITH parts AS (SELECT doc_id, regexp_split_to_array(text, '[.!?\\n]+') AS a FROM documents),
        sent AS (SELECT doc_id, unnest(a) AS s, generate_subscripts(a, 1) - 1 AS pos FROM parts),
        words AS (SELECT doc_id, pos, trim(s) AS s, {_tokens('trim(s)')} AS w FROM sent),
        token AS (SELECT doc_id, pos, s, unnest(w) AS word FROM words),
        tf AS (SELECT *, count(*) OVER (PARTITION BY doc_id, word) AS tf FROM token),
        scored AS (SELECT doc_id, pos, any_value(s) AS s, count(*) AS n,
            CAST(sum(tf) AS DOUBLE) / count(*) AS score FROM tf GROUP BY doc_id, pos),
        ranked AS (SELECT *, row_number() OVER o AS r, sum(n) OVER (o ROWS UNBOUNDED PRECEDING) AS run
            FROM scored WINDOW o AS (PARTITION BY doc_id ORDER BY score DESC, pos))
        SELECT doc_id, summary FROM documents LEFT JOIN
            (SELECT doc_id, string_agg(s, '. ' ORDER BY pos) AS summary FROM ranked WHERE run <= 40 OR r = 1
            GROUP BY doc_id) USING (doc_id)""",
    "normalise_description": """SELECT p_partkey, array_to_string(list_transform(
        regexp_split_to_array(trim(p_name || '  ' || p_type), '\\s+')[1:3],
        lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name FROM part""",
    "customer_brief": """SELECT KUNNR, nombre_cliente, pais, revenue_total, total_ordenes, clasificacion_abc,
        'Cliente=' || coalesce(nombre_cliente, 'N/A') || ', País=' || coalesce(pais, 'N/A') || ', Ciudad=' ||
        coalesce(ciudad, 'N/A') || ', Revenue total=' ||
        CAST(CAST(round(revenue_total) AS BIGINT) AS VARCHAR) || ', Órdenes=' || CAST(total_ordenes AS VARCHAR) ||
        ', Clasificación=' || clasificacion_abc || ', Ticket promedio=' ||
        CAST(CAST(round(ticket_promedio) AS BIGINT) AS VARCHAR) AS resumen_ejecutivo
        FROM abc ORDER BY revenue_total DESC, KUNNR LIMIT 5""",
    "document_text": """SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS document_text
        FROM conversations GROUP BY conv_id""",
    "document_tree_text": "SELECT doc_id, text AS document_text FROM documents",
    "document_fields": f"""SELECT doc_id, {EXTRACTED}, 'Antioquia' AS departamento, 'Industrial' AS uso,
        TIMESTAMP '2024-06-01 08:00:00' AS _procesado_at FROM documents""",
}
