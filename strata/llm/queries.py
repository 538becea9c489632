"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import license_scan


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.nearest import nearest

    return nearest(spark, _table(spark, sf_dir, "embeddings"), "id % 20 = 0", neighbours=20)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.source_mixing import mix_sources

    mixed = mix_sources(spark, _table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.warc import archive_pages, read_archives

    records = read_archives(archive_pages(spark, _table(spark, sf_dir, "pages")), payloads=False)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Both texts of the conversation that the contract adds.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.chat_format import digest_conversations, format_conversations

    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    return digest_conversations(format_conversations(turns.unionByName(extra)), dealt=True)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.exact_dedup import exact_dedup

    found = exact_dedup(spark, _table(spark, sf_dir, "documents"), keep="largest").assignments
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op1_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.hmm import score_texts

    return score_texts(spark, _table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.license_scan import scan_licenses

    return scan_licenses(spark, _table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.simhash import near_duplicates

    found = near_duplicates(spark, _table(spark, sf_dir, "documents"), width=3, radius=2).assignments
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from strata.llm.best_fit_packing import pack_documents

    return pack_documents(spark, _table(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import fold
    from strata.llm.toxicity import REJECT_AT, score_toxicity, train_toxicity

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(spark, docs, _table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= REJECT_AT).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hmm_scoring": op1_hmm_scoring,
    "op2_license_scan": op2_license_scan,
    "op3_simhash": op3_simhash,
    "op5_nearest": op5_nearest,
    "op6_source_mixing": op6_source_mixing,
    "op4_warc": op4_warc,
    "op7_chat_format": op7_chat_format,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_toxicity": op10_toxicity,
}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": license_scan.oracle_sql(),
    "op4_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
             g AS (SELECT b, max(page_id) AS response FROM p WHERE octet_length(b) >= 1000 GROUP BY b)
        SELECT page_id, CAST(octet_length(p.b) AS BIGINT) AS payload_bytes, sha1(p.b) AS payload_digest,
               CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN response <> page_id THEN response END AS refers_to
        FROM p LEFT JOIN g ON p.b = g.b
    """,
    "op8_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
    """,
}
