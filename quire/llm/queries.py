"""Registered queries of this subpackage and their DuckDB mirrors."""

from __future__ import annotations

from ..session import scratch_path
from . import alignment, exact_dedup, genetic_packing, imatch, langid, licenses, mixing, ngram_join, packing, pii, runs, secret_scan, token_store
from .common import documents

QUERIES = {}
ORACLE = {}


def _query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


@_query("op1_token_store")
def op1(spark, sf_dir):
    return token_store.stored_tokens(documents(spark, sf_dir), scratch_path(spark, "tokens"))


@_query("op2_secret_scan")
def op2(spark, sf_dir):
    return secret_scan.secrets(documents(spark, sf_dir))


@_query("op3_packing")
def op3(spark, sf_dir):
    return packing.packed(documents(spark, sf_dir))


@_query("op4_imatch")
def op4(spark, sf_dir):
    return imatch.fingerprints(documents(spark, sf_dir))


@_query("op5_mixing", mixing.mix_sql())
def op5(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


@_query("op6_ngram_join", ngram_join.components_sql())
def op6(spark, sf_dir):
    return ngram_join.jaccard_components(documents(spark, sf_dir))


@_query(
    "op7_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
)
def op7(spark, sf_dir):
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


@_query("op8_licenses")
def op8(spark, sf_dir):
    return licenses.licenses(documents(spark, sf_dir))


@_query("op9_langid")
def op9(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir))


@_query("op10_pii")
def op10(spark, sf_dir):
    # The supplied tables are synthetic: without a key of the session's own they are given this open one.
    return pii.pseudonymise(documents(spark, sf_dir), spark.conf.get(pii.KEY_CONF, "open key for synthetic tables"))


@_query("op11_alignment")
def op11(spark, sf_dir):
    return alignment.alignment_digests(documents(spark, sf_dir))


@_query("op12_best_fit_packing")
def op12(spark, sf_dir):
    return genetic_packing.packed_whole(documents(spark, sf_dir))


@_query("op13_periodic_runs")
def op13(spark, sf_dir):
    return runs.run_digests(runs.planted(documents(spark, sf_dir)))
