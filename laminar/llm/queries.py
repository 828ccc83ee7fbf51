"""The registered queries: each operator over its whole test table, with the columns its
contract names. ``ORACLE`` has DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm import bpe, fill_middle, html_text, language_model, line_dedup, mixing, neighbours, simhash, spelling, spotsigs, successor, toxicity, url_filter, warc
from laminar.llm.common import fold, read_table
from laminar.session import fresh_dir
from laminar.sources.layers import remove_folder

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

# The rules that op3 applies, as (verdict, host/path prefix).
URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@register("op1_document_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs of every text, of its edited text, and their likeness to the next document."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    docs = docs.withColumn("tie", F.xxhash64("text"))
    docs = successor.with_next(docs, "doc_id", ["text"], "tie")
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)
    )
    sigs = (
        docs.withColumn("edited", edited)
        .withColumn("sigs", spotsigs.signatures(F.col("text")))
        .withColumn("edited_sigs", spotsigs.signatures(F.col("edited")))
        .withColumn("next_sigs", spotsigs.signatures(F.col("next_text")))
    )
    return sigs.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("sigs")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        spotsigs.jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        spotsigs.jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


@register("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; rows of fold 0 are held out from learning."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, toxicity.training_labels(labels))
    return toxicity.score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@register("op3_url_filters")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, then host reputation learnt from the labels of the documents that urls name."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = url_filter.document_outcomes(pages, read_table(spark, sf_dir, "labels"))
    return url_filter.judge(pages, outcomes, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@register("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_texts(pages).select(
        "page_id",
        "url",
        F.col("main_text").alias("text"),
        F.char_length("main_text").cast("long").alias("n_chars"),
    )


@register("op5_bpe_encoding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text and what they decode to, as digests."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "bpe.*")


@register("op6_lm_scoring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every text under a model learnt outside fold 1."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = language_model.score(docs, language_model.outside_fold(docs))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "lm.*")


@register("op7_simhash_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.components(docs).select("doc_id", "fingerprint", "component_id")


@register("op8_line_dedup", line_dedup.ORACLE_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the lines of repeated passages of 50 words or more."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_lines", line_dedup.lines_in(F.col("text")))
    out = line_dedup.dedup_lines(docs)
    return out.select(
        "doc_id", "text", "n_lines", line_dedup.removed_lines(F.col("removed_runs")).alias("removed_lines")
    )


@register("op9_nearest_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    rows = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec")
    )
    return neighbours.nearest(rows, F.col("id") % 20 == 0, 20)


@register("op10_mixing", mixing.ORACLE_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "mix.*")


@register("op12_fill_in_middle", fill_middle.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its middle last, as a digest, and what that is read back to."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_middle.fill_in_middle(docs, seed=7)
    text = fill_middle.restored(F.col("fim.output"), F.col("fim.form"))
    return made.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


@register("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word that occurs twice or more, with its common form one edit away."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_variants(docs)


@register("op13_warc", warc.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through ARC files to WARC files and back. The files go once they are read."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    root = fresh_dir(spark, "warc")
    try:
        return warc.archive_pages(pages, root)
    finally:
        remove_folder(spark, root)
