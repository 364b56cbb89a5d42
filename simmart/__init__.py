"""Similarity marts on Spark: ingest, fingerprints, Tanimoto top-k, star schema, reports."""

from simmart.functions.bits import bits_decode, bits_encode, bits_pack, bits_pack_text, bits_unpack, popcount, tanimoto
from simmart.functions.sql import register_sql_functions
from simmart.operators.bands import search_bands, write_bands
from simmart.operators.checks import TableRules, check_constraints, distinct_by_key
from simmart.operators.fingerprint import (
    char_ngrams,
    fingerprint_structures,
    fingerprint_with,
    fold_fingerprint,
    per_structure,
    sign_bits,
    text_tokens,
    token_ngrams,
)
from simmart.operators.mart import append_mart, append_mart_once, load_mart
from simmart.operators.neighborhood import fold_features, neighborhood_features
from simmart.operators.records import split_molecules
from simmart.operators.similarity import score_targets, score_top_k, split_fingerprints, top_k_similar
from simmart.operators.topstate import read_top, update_top
from simmart.plans.increments import (
    add_report_load,
    stored_avg_similarity,
    stored_categories,
    stored_property_deviation,
)
from simmart.plans.jobs import build_fingerprints, ingest, score_month
from simmart.plans.reports import (
    avg_property_deviation,
    avg_similarity_per_source,
    next_most_similar,
    register_report_views,
    row_cuts,
    similarity_categories,
)
from simmart.sources.buckets import create_buckets
from simmart.sources.paged import (
    DirectoryFetcher,
    PageError,
    RestFetcher,
    read_landed_pages,
    read_pages,
    read_streamed_pages,
    stream_pages,
)
from simmart.sources.tables import (
    append_table,
    read_pair_buckets,
    read_structures,
    refresh_table,
    scan_fingerprints,
    write_fingerprints,
    write_pair_buckets,
    write_pairs,
)
from simmart.sources.targets import read_targets
from simmart.streaming.arrivals import await_month, month_targets, stream_targets

__all__ = [name for name in dir() if not name.startswith("_")]
