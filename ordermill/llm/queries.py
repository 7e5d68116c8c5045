"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (
    content_sort,
    decontaminate,
    fill_in_middle,
    html_extract,
    lexical_search,
    license_scan,
    packing,
    permutation_index,
    quality,
    shingle_join,
    token_files,
    tokens,
    toxicity,
    url_filter,
)
from ordermill.scratch import scratch_path

URL_RULES = [
    url_filter.parse_rule("block", "net/"),
    url_filter.parse_rule("allow", "example.net/en/"),
    url_filter.parse_rule("block", "example.com/de/"),
    url_filter.parse_rule("allow", "org/fr/"),
]


#: A batch for Python. Texts are long, so less than the usual 10,000 rows.
BATCH_ROWS = 1_000
BATCH_BYTES = 8 << 20


def prepare_session(spark: SparkSession) -> None:
    """Smaller batches, and this package on the workers' path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # Workers of a driver that runs elsewhere find the package by its path; on a
    # cluster it is installed, or sent with --py-files.
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int) -> Column:
    """crc32 of the document's id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out, label="toxic")
    return quality.judged(toxicity.score(docs, model, ["doc_id"]), held_out, 0.5)


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    judged = decontaminate.judged(found)
    return judged.select("row.doc_id", *judged.columns[1:])


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(4) == 2
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out, label="quality")
    return quality.judged(quality.score(docs, model, ["doc_id"]), held_out, 0.7)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return license_scan.license_digest(scanned).drop("spans")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokens.vocabulary(), keep_ids=False)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), path, tokens.vocabulary(), end_id=2
    )
    return token_files.with_crc32(token_files.read_documents(spark, path, "tokens"))


def op11_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_groups(table(spark, sf_dir, "documents"), keep="largest")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"), salt="7")
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    digests = {
        "output_sha256": F.sha2(F.col("output").cast("binary"), 256),
        "restored_sha256": F.sha2(text.cast("binary"), 256),
    }
    return made.withColumns(digests).drop("output")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_permutation_index,
        op2_toxicity,
        op3_html_extract,
        op4_jaccard_join,
        op5_decontaminate,
        op6_url_filter,
        op7_quality,
        op8_license_scan,
        op9_packing,
        op10_token_files,
        op11_content_sort,
        op12_lexical_search,
        op13_fill_in_middle,
    )
}
