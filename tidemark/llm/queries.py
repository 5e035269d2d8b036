"""The queries of this package over the test tables, and their SQL where there is one."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import audit, chat, exact, language, mixing, packing, periods, scoring, simhash
from tidemark.llm import token_files, tree_search, urls, warc
from tidemark.llm.tokens import vocabulary
from tidemark.session import configure

# End-of-document ids of the two token layouts.
PACK_END, FILE_END = 1, 0
# The rules for hosts and paths.
URL_RULES = (
    urls.Rule("net", "/", urls.BLOCK),
    urls.Rule("example.net", "/en/", urls.ALLOW),
    urls.Rule("example.com", "/de/", urls.BLOCK),
    urls.Rule("org", "/fr/", urls.ALLOW),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.select("conv_id", "turn", "role", "text").schema
    )
    rows = turns.select("conv_id", "turn", "role", "text").unionAll(added)
    return chat.conversation_digests(chat.format_conversations(rows, vocabulary()))


def op2_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return tree_search.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary(), PACK_END)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.fit_languages(_table(spark, sf_dir, "documents"))
    return language.page_languages(_table(spark, sf_dir, "pages"), model)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(_table(spark, sf_dir, "documents"), vocabulary(), FILE_END)
    return token_files.read_token_files(spark, files)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(_table(spark, sf_dir, "pages"), F.col("html"))
    return warc.archived_pages(spark, archives)


def op10_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.poisson_mix(_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "source", F.round("rate", 9).alias("rate"), "copies", "copy", "shuffle_key", "text"
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = audit.document_facts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return audit.filter_interactions(facts, audit.failing_ids(facts))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def repeating(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by a checksum of their id, go on with words they began with."""
    chance, rest = 1, 0
    if doc_id is not None:
        rest, chance = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if chance or not words:
        return words
    at = rest % len(words)
    left = len(words) - at
    period = 1 + left // (3 + rest % 8)
    base = words[at : at + period]
    return words[:at] + (base * (left // period + 1))[:left]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_digests(periods.periodic_runs(_table(spark, sf_dir, "documents"), edit=repeating))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_windows,
        op2_cross_entropy,
        op3_simhash,
        op4_tree_search,
        op5_packing,
        op6_exact_dedup,
        op7_language_id,
        op8_token_files,
        op9_warc,
        op10_poisson_mix,
        op11_filter_audit,
        op12_url_filter,
        op13_periodic_runs,
    )
}

SQL: dict[str, str] = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op10_poisson_mix": mixing.MIX_SQL,
    "op11_filter_audit": audit.AUDIT_SQL,
    "op12_url_filter": urls.url_sql(URL_RULES),
}
