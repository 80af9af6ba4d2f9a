"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from threadlake.llm import chat, decontaminate, fill_middle, html_wrappers, jaccard_join, neighbours, packing, quality, suffix_dedup, token_counts, url_rules, warc_zip, whitening
from threadlake.llm.common import table
from threadlake.session import rows_frame

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

# The rules and the added conversation that the queries are defined with.
URL_RULES = (
    url_rules.Rule("com", "/", url_rules.ALLOW),
    url_rules.Rule("example.com", "/en/", url_rules.BLOCK),
    url_rules.Rule("www.example.com", "/en/", url_rules.ALLOW),
    url_rules.Rule("net", "/es/", url_rules.BLOCK),
    url_rules.Rule("net", "/fr/", url_rules.BLOCK),
)
ADDED_TEXT = "</s>[INST] ok [/INST]"


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_of_rows(table(spark, sf_dir, "embeddings"), every=20, k=20)


def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = decontaminate.scan_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10
    )
    return decontaminate.report(scanned)


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), limit=512
    )


def jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_classes(table(spark, sf_dir, "documents"), words=4, percent=85)


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit_quality(documents, table(spark, sf_dir, "labels"))
    return quality.score_documents(documents, model)


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = warc_zip.write_packages(pages, warc_zip.run_folder(spark))
    return warc_zip.read_packages(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = [
        {"conv_id": -1, "turn": turn, "role": role, "text": ADDED_TEXT}
        for turn, role in enumerate(("user", "assistant"))
    ]
    turns = turns.unionByName(rows_frame(spark, added, turns.schema))
    return chat.read_back(chat.format_turns(turns))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), capacity=2048
    )


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract_text(table(spark, sf_dir, "pages"))


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = fill_middle.Rates(cut=100, spm=50)
    return fill_middle.digests(fill_middle.fill_in_middle(table(spark, sf_dir, "documents"), seed=7, rates=rates))


def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)


def without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=50, finish=suffix_dedup.digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest_neighbours": nearest_neighbours,
    "op2_decontamination": decontaminated,
    "op3_url_filters": url_filter,
    "op4_token_counts": token_count,
    "op5_jaccard_join": jaccard_classes,
    "op6_quality_classifier": quality_scores,
    "op7_warc_zip": warc_round_trip,
    "op8_chat_formatting": chat_format,
    "op9_best_fit_packing": best_fit_packing,
    "op10_html_extraction": main_texts,
    "op11_fill_in_middle": fill_in_middle,
    "op12_embedding_whitening": whitened_embeddings,
    "op13_suffix_array_dedup": without_repeats,
}
