"""The operators bound to the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import (
    ann,
    html_extraction,
    jaccard,
    lexical,
    mixing,
    periodic_runs,
    pieces,
    quality_rules,
    quotes,
    repeats,
    sentencepiece_codec,
    simhash,
    token_counts,
    url_filter,
)
from stratalake.llm.common import Scratch, table
from stratalake.session import prepare

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
RULES = [
    url_filter.Rule("com/", "allow"),
    url_filter.Rule("example.com/en/", "block"),
    url_filter.Rule("www.example.com/en/", "allow"),
    url_filter.Rule("net/es/", "block"),
    url_filter.Rule("net/fr/", "block"),
]
SHINGLE, RADIUS = 4, 4
PERCENT = 85


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extraction.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(prepare(spark), sf_dir, "embeddings"), Scratch(spark, "nearest"))


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(
        table(prepare(spark), sf_dir, "documents"), Scratch(spark, "simhash"), shingle=SHINGLE, radius=RADIUS
    )
    return found.select("doc_id", "fingerprint", "component_id")


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode(table(spark, sf_dir, "documents"), pieces.load(TOKENIZER))
    return coded.select("doc_id", "pieces", "n_pieces", "round_trip")


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Columns pass through a model unpruned, so only those that are returned go in.
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), pieces.load(TOKENIZER))
    return counted.select("doc_id", "n_tokens")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.RESULT)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(prepare(spark), sf_dir, "conversations"), Scratch(spark, "quotes"))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.find_repeats(table(prepare(spark), sf_dir, "documents"), Scratch(spark, "repeats"))
    return found.select("doc_id", "begin", "end", "n_words", "n_cut")


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(prepare(spark), "lexical")
    indexed = lexical.index(table(spark, sf_dir, "documents"), scratch)
    return lexical.search(indexed, table(spark, sf_dir, "benchmark"), scratch)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), change=periodic_runs.periodic_tail)
    return found.select("doc_id", *periodic_runs.RESULT)


def similar_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return jaccard.similar_groups(docs, Scratch(spark, "similar"), shingle=SHINGLE, percent=PERCENT)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_main_text": main_text,
        "op2_nearest": nearest,
        "op3_simhash": simhash_groups,
        "op4_pieces": encoded,
        "op5_url_filter": url_verdicts,
        "op6_token_counts": token_totals,
        "op7_quality": quality,
        "op8_quotes": conversations,
        "op9_repeats": repeated_passages,
        "op10_mix": mixed,
        "op11_lexical_search": lexical_search,
        "op12_periodic_runs": runs,
        "op13_similar_sets": similar_sets,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_mix": mixing.SQL, "op11_lexical_search": lexical.SQL}
