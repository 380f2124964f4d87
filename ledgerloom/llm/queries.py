"""The operators of this package as queries over the test tables, with their DuckDB SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    decontamination,
    html_extract,
    jaccard_join,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    spelling_variants,
    token_counts,
    toxicity,
    url_filters,
)
from ledgerloom.llm.common import WORD_GAP, table, text_of
from ledgerloom.session import durable
from ledgerloom.sources.storage import scratch_folder

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
#: ends each packed document
END_ID = 1
#: of the hashes of a document's words, those that this divides lose a letter
DAMAGED = 199


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "kept.n_lines", "kept.n_dropped", F.sha2("kept.text", 256).alias("kept_sha256"))


def filter_list(pages: DataFrame) -> DataFrame:
    """Dated list entries derived from all keys of the pages: hosts and parent domains, alone and with the first path part.

    The hash of a key says whether a list of its category names it, since when, and whether the entry is
    withdrawn and comes back.
    """
    keys = url_filters.lookup_keys(url_filters.host_of(F.col("url")), url_filters.first_path(F.col("url")))
    named = pages.select(F.explode(keys).alias("key")).distinct()
    digit = [F.conv(F.substring(F.md5("key"), 2 * k + 1, 2), 16, 10).cast("int") for k in range(4)]
    listed = named.select("key", *[d.alias(f"d{k}") for k, d in enumerate(digit)]).where("d0 % 4 = 0")
    start = F.date_add(F.lit("2024-01-01").cast("date"), F.col("d1"))
    dated = F.array(
        F.struct(start.alias("effective"), F.lit(url_filters.LISTED).alias("action")),
        F.struct(F.date_add(start, F.col("d2") + 1).alias("effective"), F.lit(url_filters.UNLISTED).alias("action")),
        F.struct(F.date_add(start, F.col("d2") + 31).alias("effective"), F.lit(url_filters.LISTED).alias("action")),
    )
    category = F.element_at(F.array(*map(F.lit, ("adult", "malware", "spam"))), F.col("d0") % 3 + 1)
    entries = listed.select("key", category.alias("category"), F.explode(F.slice(dated, 1, F.col("d3") % 3 + 1)).alias("e"))
    return entries.select("key", "category", "e.effective", "e.action")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.select(
        F.col("page_id").alias("capture_id"),
        "url",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int")).alias("fetched"),
    )
    found = url_filters.evaluate(captures, url_filters.intervals(filter_list(pages)))
    return found.withColumnRenamed("capture_id", "page_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with scratch_folder(spark, "token-cache") as cache:
        counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), cache)
        return durable(counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.linked_components(table(spark, sf_dir, "documents"), size=3, num=90, den=100)
    return linked.select("doc_id", "n_shingles", "component_id")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text; in a tenth of the documents the words from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n, a, p = F.floor(h / 10), F.size("w"), F.col("a"), F.col("p")
    words = F.filter(F.split(text_of(), WORD_GAP), lambda word: word != "")
    chosen = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    planted = chosen.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    planted = planted.withColumn("p", (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int"))
    copies = F.ceil((n - a) / p).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(F.slice("w", a + 1, p), copies)), 1, n - a)
    text = F.when(a.isNotNull(), F.array_join(F.concat(F.slice("w", 1, a), repeated), " "))
    return planted.select("doc_id", F.coalesce(text, "text").alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("best")
    return found.withColumn("best", F.array_min(order)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        (-best["less"]).alias("length"),
        best["period"].alias("period"),
        F.floor(-1000 * best["less"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def damaged(doc_id: int | None, word: str) -> str:
    """The word, without one letter if a hash of document and word says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % DAMAGED:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.count_words(table(spark, sf_dir, "documents"), rewrite=damaged)
    return spelling_variants.variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        op1_source_mixing,
        op2_toxicity,
        op3_decontamination,
        op4_html_extraction,
        op5_line_dedup,
        op6_url_filters,
        op7_token_counts,
        op8_quality_rules,
        op9_quality_classifier,
        op10_jaccard_join,
        op11_periodic_runs,
        op12_spelling_variants,
        op13_packing,
    )
    return {query.__name__: query for query in listed}
