"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import (
    bpe,
    decontam,
    fixity,
    linedup,
    lineblocks,
    packing,
    quality,
    resampling,
    secret_scan,
    simhash,
    surrogates,
    urlrules,
    whitening,
)
from feedlake.llm.common import cut_lineage, documents, table

Query = Callable[[SparkSession, str], DataFrame]

SURROGATE_KEY = "training-corpus"
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def TOKENIZER() -> dict[str, str]:
    """Where the public vocabulary lies, for the packing operator."""
    import public_tokenizers as public

    return {
        "tokenizer_path": str(public.path("byte_bpe_50k.json")),
        "ranks_path": str(public.path("byte_bpe_50k.tiktoken")),
        "pattern": public.PATTERN,
    }


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), **TOKENIZER())


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.pseudonymized(documents(spark, sf_dir).select("doc_id", "text"), SURROGATE_KEY)
    return replaced.select("doc_id", "text", F.col("_n_entities").alias("n_entities"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(documents(spark, sf_dir))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[secret_scan.counted(spans, k).alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS[:3])],
        F.sha2(secret_scan.shown(secret_scan.base_only(spans)), 256).alias("base_sha256"),
        secret_scan.shown(spans).alias("spans"),
        secret_scan.counted(spans, 3).alias("n_random"),
    )


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = linedup.without_copies(documents(spark, sf_dir).select("doc_id", "text"))
    size = F.aggregate("_cuts", F.lit(0), lambda n, c: n + c["_to"] - c["_from"] + 1)
    return rest.select("doc_id", "text", F.coalesce(size, F.lit(0)).cast("long").alias("n_deleted_lines"))


def op7_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica in which the first byte of some records has changed, and some records are lost or doubled."""
    pages = table(spark, sf_dir, "pages")
    page = F.col("page_id")
    rotten = lambda record: F.when(page % 97 == 5, F.concat(F.lit("!"), F.substring(record, 2, 1 << 30))).otherwise(record)
    master = cut_lineage(fixity.archived(pages), "fixity-master")
    copy = fixity.archived(pages, stored=rotten)
    doubled = copy.filter(page % 307 == 9).withColumn("offset", F.col("offset") + 1)
    replica = cut_lineage(copy.filter(page % 211 != 7).unionByName(doubled), "fixity-replica")
    return fixity.audit(master, replica)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judged(table(spark, sf_dir, "pages"), urlrules.rule_table(spark, URL_RULES))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineblocks.extracted(table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.judged(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digested(documents(spark, sf_dir), TOKENIZER()["tokenizer_path"])


def queries() -> dict[str, Query]:
    named = [
        op1_best_fit_packing,
        op2_pii_surrogates,
        op3_secret_scan,
        op4_benchmark_decontamination,
        op5_simhash_near_dedup,
        op6_line_dedup,
        op7_merkle_audit,
        op8_url_filters,
        op9_html_extraction,
        op10_quality_rules,
        op11_importance_resampling,
        op12_embedding_whitening,
        op13_bpe_round_trip,
    ]
    return {query.__name__: query for query in named}
