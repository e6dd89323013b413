"""The corpus operators as queries over the test tables, with production settings, and as SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from feedmart.llm import chat, decontaminate, fingerprints, html_text, language_id, mixing, near_duplicates, quality_compression, secrets, spelling, toxicity, warc, whitening
from feedmart.llm.common import settle, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op3_compression_bands(spark, sf_dir):
    return quality_compression.compression_bands(table(spark, sf_dir, "documents"))


@_query
def op5_secret_scan(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@_query
def op8_prefix_targets(spark, sf_dir):
    """All conversations and one more, whose texts hold another template's control strings."""
    said = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    return chat.read_back(chat.prefix_target_examples(rows))


@_query
def op6_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


@_query
def op9_toxicity(spark, sf_dir):
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op10_hamming_near_duplicates(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op2_temperature_mixing(spark, sf_dir):
    """Every copy that the mix takes, as a manifest. The texts are counted once."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("tokens"))
    return mixing.mix(settle(docs, "mix-tokens"), "tokens")


ORACLES["op2_temperature_mixing"] = mixing.oracle(mixing.Settings())


@_query
def op1_template_decontamination(spark, sf_dir):
    """The documents that hold a benchmark item, with the item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op4_wrapper_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@_query
def op7_warc_derivatives(spark, sf_dir):
    """Both derived records of every page, each with the page's id."""
    derived = warc.derive(warc.responses(table(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z"))
    return derived.select(
        F.col("headers")["X-Source-X-Page-ID"].cast("long").alias("page_id"), "type", "record_id", "refers_to", "target_uri", "date",
        "content_type", "content_length", "block_digest", F.to_json("headers").alias("headers"), F.decode("block", "UTF-8").alias("text"),
    )


@_query
def op11_embedding_whitening(spark, sf_dir):
    """Deviations beyond a long, with very many vectors, are null here."""
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@_query
def op12_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


ORACLES["op12_spelling_variants"] = spelling.oracle()


@_query
def op13_weighted_fingerprints(spark, sf_dir):
    """Every document, its edited text and the next document, compared by weighted samples."""
    return fingerprints.beside_edited(table(spark, sf_dir, "documents"))


@_query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
