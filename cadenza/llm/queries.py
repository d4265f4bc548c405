"""Registered queries of the subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.llm.decontam import leak_report
from cadenza.llm import html_crf
from cadenza.llm.filter_audit import audit
from cadenza.llm.line_dedup import dedup_lines
from cadenza.llm.packing import pack
from cadenza.llm.quality import quality
from cadenza.llm.resample import importance_resample
from cadenza.llm.secret_scan import KINDS, scan, span_text
from cadenza.llm.setsketch import near_duplicates
from cadenza.llm.simhash import simhash_duplicates
from cadenza.llm.token_files import read_token_files, write_token_files
from cadenza.llm.toxicity import learn, score
from cadenza.llm.warc import normalise, read_archives, write_archives
from cadenza.sources.tables import read_table


def op1_line_dedup(spark, sf_dir):
    """Cleaned texts of all documents, with line counts."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed",
        F.array_join(F.transform("removed_spans", lambda x: F.concat_ws(
            "-", x["s"].cast("string"), x["e"].cast("string"))), ",").alias("removed_spans"),
        "text")


def op2_secret_ownership(spark, sf_dir):
    """Secret spans of all documents. A document's source is its owner, and the
    source's texts in one language a repository."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    found = scan(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("token"))

    def count(test):
        return F.size(F.filter("spans", lambda s: test(s))).cast("long")

    def of(k):
        return count(lambda s: s["kind"] == k).alias(f"n_{KINDS[k]}")

    return found.select(
        "doc_id", of(0), of(1), of(2),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_copied"))


def op3_ngram_quality(spark, sf_dir):
    """Base rules and likelihood-ratio verdict of all documents."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    return quality(docs, labels)


def op4_toxicity(spark, sf_dir):
    """Toxicity scores of all documents; every fifth id (by crc32) is held out."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    model = learn(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return score(docs, model).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_bm25_decontamination(spark, sf_dir):
    """Test items found in all documents."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    # Texts are only searched, not returned: the join back carries ids.
    found = leak_report(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "contaminated", "n_retrieved",
                        F.array_join("leaked_items", ",").alias("item_ids"),
                        F.round("best_score", 6).alias("best_score"))


def op6_hilbert_packing(spark, sf_dir):
    """Pieces of all documents in sequences of at most 1024 tokens."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                             "doc_tokens", "sequence_id", "offset")


def op7_token_files(spark, sf_dir):
    """Token files of all documents, written and read back."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return read_token_files(spark, write_token_files(docs)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_html_crf(spark, sf_dir):
    """Main text of all pages."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_crf.extract(pages, html_crf.learn(pages)).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_warc(spark, sf_dir):
    """All pages through monolithic archives, the normaliser and the index."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    records = read_archives(spark, normalise(spark, write_archives(pages)), with_payload=False)
    return records.select(F.col("page").cast("long").alias("page_id"), "payload_bytes",
                          "payload_digest", "record_type", F.col("refers_to").cast("long"))


def op10_setsketch_near_dedup(spark, sf_dir):
    """Near-duplicate components of all documents on 4-word shingles."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, shingle=4, pct=80)


def op11_importance_resampling(spark, sf_dir):
    """A quarter of all documents drawn by importance weights towards the test items."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return importance_resample(docs, read_table(spark, sf_dir, "benchmark", "text"))


def op12_filter_audit(spark, sf_dir):
    """Removals of five filters in all 120 orders, by source."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return audit(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op13_simhash_near_dedup(spark, sf_dir):
    """Fingerprints and near-duplicate components of all documents on 3-word shingles."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash_duplicates(docs)


QUERIES = {"op1_line_dedup": op1_line_dedup,
           "op2_secret_ownership": op2_secret_ownership,
           "op3_ngram_quality": op3_ngram_quality,
           "op4_toxicity": op4_toxicity,
           "op5_bm25_decontamination": op5_bm25_decontamination,
           "op6_hilbert_packing": op6_hilbert_packing,
           "op7_token_files": op7_token_files,
           "op8_html_crf": op8_html_crf,
           "op9_warc": op9_warc,
           "op10_setsketch_near_dedup": op10_setsketch_near_dedup,
           "op11_importance_resampling": op11_importance_resampling,
           "op12_filter_audit": op12_filter_audit,
           "op13_simhash_near_dedup": op13_simhash_near_dedup}
