"""Registered queries of the text operators, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.llm import (
    decontaminate,
    fim,
    hard_negatives,
    line_rules,
    lm,
    mixing,
    near_dups,
    packing,
    pii,
    quality,
    repeats,
    toxicity,
    warc,
)
from lakekit.sources.erp import read_table
from lakekit.sources.workspace import fresh_dir


def op1_weak_supervision(spark, d):
    return pii.summarise(pii.find_spans(read_table(spark, d, "documents")))


def op2_factorization_machine(spark, d):
    return toxicity.classify(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def op3_suffix_repeats(spark, d):
    return repeats.remove_repeats(read_table(spark, d, "documents")).drop("kept")


def op4_mix_sources(spark, d):
    return mixing.mix_sources(read_table(spark, d, "documents"))


def op5_log_bilinear(spark, d):
    return lm.score_texts(read_table(spark, d, "documents"))


def op6_warc_salvage(spark, d):
    pages = read_table(spark, d, "pages")
    path = fresh_dir(spark, "archives")
    warc.write_archives(pages, path)
    key = pages.schema["page_id"].dataType
    return (
        warc.read_archives(spark, path)
        .where("kind = 'record'")
        .select(
            F.col("record_id").cast(key).alias("page_id"),
            "payload_bytes",
            "payload_digest",
            F.col("type").alias("record_type"),
            F.col("refers_to").cast(key).alias("refers_to"),
        )
    )


def op7_quality_discriminant(spark, d):
    return quality.classify(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def op8_suffix_automaton(spark, d):
    documents = read_table(spark, d, "documents").select("doc_id", "text")
    return decontaminate.hit_counts(decontaminate.match_items(documents, read_table(spark, d, "benchmark")))


def op9_line_rules(spark, d):
    return line_rules.clean_lines(read_table(spark, d, "documents")).drop("cleaned")


def line_rules_base(spark, d):
    """The statistics and base rules of op9 alone, which SQL can state."""
    return line_rules.clean_lines(read_table(spark, d, "documents")).drop("cleaned", "kept")


def op10_fast_sketching(spark, d):
    return near_dups.link_near_duplicates(read_table(spark, d, "documents"), shingle=4)


def op11_concat_cut(spark, d):
    return packing.digests(packing.pack(read_table(spark, d, "documents")))


def op12_boundary_set(spark, d):
    return fim.digests(fim.fill_in_middle(read_table(spark, d, "documents")))


def op13_anchor_tree(spark, d):
    return hard_negatives.mine_hard_negatives(hard_negatives.relabelled(read_table(spark, d, "embeddings")))


QUERIES = {
    "op1_weak_supervision": op1_weak_supervision,
    "op2_factorization_machine": op2_factorization_machine,
    "op3_suffix_repeats": op3_suffix_repeats,
    "op4_mix_sources": op4_mix_sources,
    "op5_log_bilinear": op5_log_bilinear,
    "op6_warc_salvage": op6_warc_salvage,
    "op7_quality_discriminant": op7_quality_discriminant,
    "op8_suffix_automaton": op8_suffix_automaton,
    "op9_line_rules": op9_line_rules,
    "op10_fast_sketching": op10_fast_sketching,
    "op11_concat_cut": op11_concat_cut,
    "op12_boundary_set": op12_boundary_set,
    "op13_anchor_tree": op13_anchor_tree,
    "line_rules_base": line_rules_base,
}

ORACLES = {
    "op4_mix_sources": mixing.oracle(),
    "op6_warc_salvage": warc.oracle(),
    "op8_suffix_automaton": decontaminate.oracle(),
    "op10_fast_sketching": near_dups.oracle(),
    "line_rules_base": line_rules.oracle(),
    "op12_boundary_set": fim.oracle(),
    "op13_anchor_tree": hard_negatives.oracle(),
}
