"""Queries over the given tables, one per operator, and the same results in SQL.

Stand-ins for the chemistry tables, each over whole tables:

* structures: ``documents`` (id ``CHEMBL<doc_id>``, structure = text)
* targets: ``benchmark`` (id ``CHEMBLB<item_id>``); for a second month one profile per language (``CHEMBLL<lang>``),
  made of the bits that more than half of its documents have
* properties: documents that have a row in ``labels``, all benchmark items, all language profiles
* vectors: ``embeddings`` by sign; targets are the majority signs of each label
* graphs: an order is a molecule, its line numbers are the nodes, consecutive numbers are neighbours
"""

from __future__ import annotations

import datetime
import hashlib
import sys
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import simmart as sm
from simmart.functions.packing import stored_form
from simmart.functions.text import is_blank, month_of_file, month_stamp
from simmart.operators.fingerprint import fold_bits
from simmart.operators.mart import molecule_ids, new_dimension_rows
from simmart.operators.records import typed_lookups
from simmart.plans.jobs import RULES
from simmart.schemas import DICTIONARY, DIMENSION, FACT, PROPERTIES, RAW_LOOKUP, RAW_MOLECULE, STRUCTURES
from simmart.session import empty, scratch_path, stage
from simmart.sources.paged import decode_items
from simmart.sources.tables import counted, read_pairs, read_table

SOURCE, TARGET, SCORE = "source_chembl_id", "target_chembl_id", "tanimoto_similarity_score"
FLAG = "has_duplicates_of_last_largest_score"
PAGE = 100


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    df = spark.read.schema(_schemas[path]).parquet(path)
    return df.select(*columns) if columns else df


# ---------------------------------------------------------------- stand-ins


def doc_id() -> Column:
    return F.concat(F.lit("CHEMBL"), F.col("doc_id"))


def structures(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select(doc_id().alias("chembl_id"), F.col("text").alias("canonical_smiles"))


#: Into how many parts the texts of ``documents`` are dealt before they are folded: for a file of one row group.
SPREAD: int | None = None


def doc_fps(spark, sf_dir) -> DataFrame:
    return sm.build_fingerprints(structures(spark, sf_dir), spread=SPREAD)[0]


def benchmark_targets(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return items.select(F.concat(F.lit("CHEMBLB"), "item_id").alias(TARGET), F.col("text").alias("smiles"))


def target_fps(spark, sf_dir) -> DataFrame:
    fps, _ = sm.fingerprint_structures(benchmark_targets(spark, sf_dir), TARGET, "smiles")
    return fps.withColumnRenamed("chembl_id", TARGET)


def doc_fps_with_lang(spark, sf_dir) -> DataFrame:
    """The fingerprints of ``doc_fps`` with the language of the document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").filter(~is_blank(F.col("text")))
    docs = docs.repartition(SPREAD) if SPREAD else docs
    return docs.select(doc_id().alias("chembl_id"), "lang", fold_bits(sm.text_tokens(F.col("text"))).alias("on"))


def profile_fps(spark, sf_dir, fps: DataFrame | None = None) -> DataFrame:
    """Per language the bits that more than half of its documents have."""
    sizes = table(spark, sf_dir, "documents", "lang").groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    folded = doc_fps_with_lang(spark, sf_dir) if fps is None else fps
    bits = folded.select("lang", F.explode_outer("on").alias("bit")).filter("bit IS NOT NULL")
    common = bits.groupBy("lang", "bit").agg(F.count(F.lit(1)).alias("n")).join(sizes, "lang")
    kept = common.filter(F.col("n") * 2 > F.col("docs")).groupBy("lang").agg(
        F.sort_array(F.collect_list("bit")).alias("on")
    )
    return kept.select(F.concat(F.lit("CHEMBLL"), "lang").alias(TARGET), "on", F.size("on").alias("pop"))


def dictionary(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "lang")
    parts = [
        docs.select(doc_id().alias("chembl_id"), F.col("lang").alias("molecule_type")),
        table(spark, sf_dir, "benchmark", "item_id").select(
            F.concat(F.lit("CHEMBLB"), "item_id"), F.lit("benchmark")
        ),
        docs.select("lang").distinct().select(F.concat(F.lit("CHEMBLL"), "lang"), F.lit("profile")),
    ]
    return parts[0].union(parts[1]).union(parts[2])


PROPERTY_SQL = {
    "mw_freebase": "CAST(CAST(n AS DOUBLE) / 10 AS DECIMAL(9,2))",
    "alogp": "CAST(NULLIF(CAST(n % 1000 - 500 AS DOUBLE) / 100, 0) AS DECIMAL(9,2))",
    "psa": "CAST(NULLIF(n % 150, 0) AS DECIMAL(9,2))",
    "cx_logp": "CAST(CASE WHEN quality = 1 THEN CAST(n % 700 AS DOUBLE) / 100 END AS DECIMAL(9,2))",
    "molecular_species": "species",
    "full_mwt": "CAST(CAST(n AS DOUBLE) / 10 + 18.02 AS DECIMAL(9,2))",
    "aromatic_rings": "CAST(CASE WHEN toxic = 0 THEN n % 5 END AS INT)",
    "heavy_atoms": "CAST(quality * 10 + n % 7 AS INT)",
}


def properties(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "n_chars", "source").join(
        table(spark, sf_dir, "labels"), "doc_id"
    )
    base = (
        docs.select(doc_id().alias("chembl_id"), F.col("n_chars").alias("n"), "quality", "toxic", F.col("source").alias("species"))
        .union(
            table(spark, sf_dir, "benchmark").select(
                F.concat(F.lit("CHEMBLB"), "item_id"), F.length("text"), F.lit(1), F.lit(0), F.lit("benchmark")
            )
        )
        .union(
            table(spark, sf_dir, "documents", "lang")
            .groupBy("lang")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.concat(F.lit("CHEMBLL"), "lang"), "n", F.lit(1), F.lit(0), "lang")
        )
    )
    return base.select("chembl_id", *[F.expr(e).alias(c) for c, e in PROPERTY_SQL.items()])


def first_load(spark, sf_dir, fps: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mart after the first month, on an empty star: new dimension rows, new facts, rejects."""
    sources = doc_fps(spark, sf_dir) if fps is None else fps
    return sm.load_mart(
        sm.score_top_k(target_fps(spark, sf_dir), sources),
        dictionary(spark, sf_dir),
        properties(spark, sf_dir),
        empty(spark, DIMENSION),
        empty(spark, FACT),
    )


def star(spark, sf_dir, fps: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Dimension and fact table of the first month, stored."""
    dim, fact, _ = first_load(spark, sf_dir, fps)
    return dim, stage(fact, "fact")


def second_load(spark, sf_dir, fact_filter) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The next month brings both the old targets and the language profiles."""
    fps = stage(doc_fps_with_lang(spark, sf_dir), "fps")
    dim, fact = star(spark, sf_dir, fps)
    both = target_fps(spark, sf_dir).unionByName(profile_fps(spark, sf_dir, fps))
    return sm.load_mart(sm.score_top_k(both, fps), dictionary(spark, sf_dir), properties(spark, sf_dir), dim, fact, fact_filter)


def fact_out(fact: DataFrame) -> DataFrame:
    return fact.select(SOURCE, TARGET, F.col(SCORE).cast("double").alias(SCORE), FLAG)


def dim_out(dim: DataFrame) -> DataFrame:
    return dim.select(*[F.col(f.name).cast("double").alias(f.name) if "decimal" in f.dataType.simpleString() else f.name for f in DIMENSION.fields])


def raw_molecules(spark, sf_dir) -> DataFrame:
    """Documents as JSON records: properties only for labelled ones, structures only for those not marked toxic.

    ``psa`` of quality-0 documents is no number, so those records are rejected.
    """
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    n = F.col("n_chars")
    props = F.struct(
        (n / 10).cast("string").alias("mw_freebase"),
        F.when(n % 3 == 0, "0.00").when(n % 3 == 1, "").otherwise(F.concat("doc_id", F.lit(".125"))).alias("alogp"),
        F.when(F.col("quality") == 0, F.concat(F.lit("n/a "), "doc_id")).otherwise((n % 90).cast("string")).alias("psa"),
        F.lit(None).cast("string").alias("cx_logp"),
        F.col("source").alias("molecular_species"),
        (n % 1000).cast("string").alias("full_mwt"),
        (n % 4).cast("int").alias("aromatic_rings"),
        (n % 7).cast("int").alias("heavy_atoms"),
    )
    item = F.struct(
        doc_id().alias("molecule_chembl_id"),
        F.col("lang").alias("molecule_type"),
        F.when(F.col("quality").isNotNull(), props).alias("molecule_properties"),
        F.when(F.coalesce("toxic", F.lit(0)) == 0, F.struct(F.col("text").alias("canonical_smiles"))).alias("molecule_structures"),
    )
    rows = docs.select(F.col("doc_id").alias("offset"), F.to_json(item).alias("item"), F.lit(None).cast("string").alias("error"))
    return rows


def molecules(spark, sf_dir) -> DataFrame:
    return decode_items(raw_molecules(spark, sf_dir), RAW_MOLECULE)[0]


# ---------------------------------------------------------------- queries


def q_top10_embeddings(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    on = sm.sign_bits(F.col("embedding"))
    fps = vectors.select(F.col("vec_id").cast("string").alias("chembl_id"), on.alias("on"))
    sizes = vectors.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    signs = vectors.select("label", F.explode_outer(on).alias("bit")).filter("bit IS NOT NULL").groupBy("label", "bit").agg(F.count(F.lit(1)).alias("n"))
    majority = (
        signs.join(sizes, "label").filter(F.col("n") * 2 > F.col("members"))
        .groupBy(F.concat(F.lit("label"), "label").alias(TARGET)).agg(F.sort_array(F.collect_list("bit")).alias("on"))
    )
    return sm.score_top_k(majority, fps, n_bits=64)


def q_fingerprint_fold(spark, sf_dir):
    return doc_fps(spark, sf_dir).select("chembl_id", F.array_join("on", ",").alias("on_bits"), "pop")


def q_token_ngrams(spark, sf_dir):
    fps = sm.fold_fingerprint(
        structures(spark, sf_dir), "chembl_id", sm.token_ngrams(F.col("canonical_smiles"), 2)
    )
    return fps.select("chembl_id", F.array_join("on", ",").alias("on_bits"), "pop")


def q_char_ngrams(spark, sf_dir):
    names = table(spark, sf_dir, "part", "p_partkey", "p_name")
    fps = sm.fold_fingerprint(names, "p_partkey", sm.char_ngrams(F.col("p_name"), 3))
    return fps.select("chembl_id", F.array_join("on", ",").alias("on_bits"), "pop")


def q_fingerprint_with(spark, sf_dir):
    def toolkit(structures: pa.Array) -> pa.Array:
        """Each distinct token of a batch is hashed once."""
        tokens = pc.split_pattern(structures, " ")
        words = tokens.flatten().dictionary_encode()
        hashes = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in words.dictionary.to_pylist()]
        filled = pc.not_equal(words.dictionary, "").take(words.indices)
        per_row = np.bincount(pc.list_parent_indices(tokens).filter(filled), minlength=len(tokens))
        offsets = np.concatenate([[0], per_row.cumsum()]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes, pa.int64()).take(words.indices.filter(filled)))

    fps, _ = sm.build_fingerprints(structures(spark, sf_dir), fn=toolkit)
    return fps.select("chembl_id", F.array_join("on", ",").alias("on_bits"), "pop")


def q_bits_roundtrip(spark, sf_dir):
    bits = doc_fps(spark, sf_dir).select("chembl_id", sm.bits_encode(F.col("on")).alias("bits"))
    return bits.select(
        "chembl_id", F.md5("bits").alias("bits_md5"), F.array_join(sm.bits_decode(F.col("bits")), ",").alias("on_bits")
    )


def q_bits_pack_popcount(spark, sf_dir):
    packed = doc_fps(spark, sf_dir).select("chembl_id", sm.bits_pack(F.col("on")).alias("fp"))
    return packed.select(
        "chembl_id",
        F.array_join("fp", ",").alias("words"),
        sm.popcount(F.col("fp")).cast("int").alias("pop"),
        F.md5(F.array_join(sm.bits_unpack(F.col("fp")), ",")).alias("on_md5"),
    )


def q_bits_stored_forms(spark, sf_dir):
    """Both stored forms made batch-wise; they agree with the column functions."""
    fps = doc_fps(spark, sf_dir)
    text = stored_form(fps, "text", 2048).select("chembl_id", F.md5("morgan_fingerprint").alias("bits_md5"))
    words = stored_form(fps, "words", 2048).select("chembl_id", F.array_join("words", ",").alias("words"))
    return text.join(words, "chembl_id")


def q_pair_scores(spark, sf_dir):
    return sm.score_targets(target_fps(spark, sf_dir), doc_fps(spark, sf_dir))


def q_tanimoto_native(spark, sf_dir):
    """Scores of the fact rows again, by two joins and the column function."""
    fps = stage(doc_fps(spark, sf_dir), "fps")
    targets = target_fps(spark, sf_dir)
    packed = sm.bits_pack(F.col("on"))
    left = fps.select(F.col("chembl_id").alias(SOURCE), packed.alias("a"), F.col("pop").alias("pop_a"))
    right = targets.select(TARGET, packed.alias("b"), F.col("pop").alias("pop_b"))
    top = sm.score_top_k(targets, fps)
    score = sm.tanimoto(F.col("a"), F.col("pop_a"), F.col("b"), F.col("pop_b"))
    return top.join(left, SOURCE).join(right, TARGET).select(
        SOURCE, TARGET, score.alias("native_score"), (score == F.col(SCORE)).alias("same")
    )


def q_top10_documents(spark, sf_dir):
    return sm.score_top_k(target_fps(spark, sf_dir), doc_fps(spark, sf_dir))


def q_top10_no_self(spark, sf_dir):
    """Language profiles against themselves and each other, without self-pairs."""
    profiles = stage(profile_fps(spark, sf_dir), "profiles")
    fps = profiles.withColumnRenamed(TARGET, "chembl_id")
    return sm.score_top_k(profiles, fps, include_self=False)


def q_tie_flag(spark, sf_dir):
    """Rank an existing pair table: the five best of the ten best, with ties inside the five."""
    pairs = sm.score_top_k(target_fps(spark, sf_dir), doc_fps(spark, sf_dir)).withColumnRenamed(SOURCE, "chembl_id")
    return sm.top_k_similar(pairs, k=5)


def q_tie_flag_boundary(spark, sf_dir):
    return sm.score_top_k(target_fps(spark, sf_dir), doc_fps(spark, sf_dir), tie_mode="boundary")


def q_fingerprint_files(spark, sf_dir):
    """Store fingerprints, scan the files, rank from their 0/1 text."""
    folder = scratch_path(spark, "fingerprints")
    sm.write_fingerprints(doc_fps(spark, sf_dir), folder)
    return sm.score_top_k(target_fps(spark, sf_dir), sm.scan_fingerprints(spark, folder))


def q_fingerprint_word_files(spark, sf_dir):
    """The same with packed words in the files."""
    folder = scratch_path(spark, "fingerprints")
    sm.write_fingerprints(doc_fps(spark, sf_dir), folder, layout="words")
    return sm.score_top_k(target_fps(spark, sf_dir), sm.scan_fingerprints(spark, folder))


def q_top10_in_passes(spark, sf_dir):
    """Several blocks of targets a pass and several passes over the files, with lower bounds from a part of them."""
    folder = scratch_path(spark, "fingerprints")
    sm.write_fingerprints(doc_fps(spark, sf_dir), folder, layout="words")
    files = sm.scan_fingerprints(spark, folder)
    return sm.score_top_k(target_fps(spark, sf_dir), files, max_block=4, seed=files.filter("pop <= 100"))


def q_pairs_above(spark, sf_dir):
    """Scores of at least 0.1 only; rows with too few or too many on-bits stay in the files."""
    folder = scratch_path(spark, "fingerprints")
    sm.write_fingerprints(doc_fps(spark, sf_dir), folder, layout="words")
    return sm.score_targets(target_fps(spark, sf_dir), sm.scan_fingerprints(spark, folder), min_score=0.1)


def q_pairs_postings(spark, sf_dir):
    """All documents against each other: scores of at least 0.8 by posting lists of rare bits."""
    fps = stage(doc_fps(spark, sf_dir), "fps")
    own = fps.withColumnRenamed("chembl_id", TARGET)
    return sm.score_targets(own, fps, include_self=False, min_score=0.8, strategy="postings")


def q_pairs_blocks(spark, sf_dir):
    """All scores by blocks of targets and of fingerprints that meet by shuffle."""
    return sm.score_targets(target_fps(spark, sf_dir), doc_fps(spark, sf_dir), strategy="blocks")


def q_top10_blocks(spark, sf_dir):
    """As many targets as fingerprints: the ten best of every document, none of which passes the driver."""
    fps = stage(doc_fps(spark, sf_dir), "fps")
    own = fps.withColumnRenamed("chembl_id", TARGET)
    return sm.score_top_k(own, fps, strategy="blocks", include_self=False)


def q_top10_bands(spark, sf_dir):
    """The ten best by a search that goes outward over a store cut by number of on-bits."""
    folder = scratch_path(spark, "bands")
    sm.write_bands(doc_fps(spark, sf_dir), folder, rows_per_band=100)
    return sm.search_bands(spark, target_fps(spark, sf_dir), folder)[0]


def q_top10_loads(spark, sf_dir):
    """Fingerprints arrive in three loads; half of the targets come with the second. The last load runs twice."""
    folder = scratch_path(spark, "state")
    fps = stage(doc_fps(spark, sf_dir).withColumn("load", F.pmod(F.crc32("chembl_id"), F.lit(3))), "fps")
    targets = stage(target_fps(spark, sf_dir), "targets")
    half = targets.filter(F.crc32(F.col(TARGET)) % 2 == 0)
    for load in (0, 1, 2, 2):
        own, before = (fps.filter(c).drop("load") for c in (F.col("load") == load, F.col("load") < load))
        sm.update_top(spark, targets if load else half, own, folder, load, earlier=before)
    return sm.read_top(spark, folder, tie_mode="boundary")


def q_pairs_by_target(spark, sf_dir):
    """Store one folder of scores per target, read back, rank."""
    folder = scratch_path(spark, "pairs")
    sm.write_pairs(sm.score_targets(target_fps(spark, sf_dir), doc_fps(spark, sf_dir)), folder)
    return sm.top_k_similar(read_pairs(spark, folder))


def q_pairs_by_bucket(spark, sf_dir):
    """Store scores in buckets of targets, half of them first with wrong scores, then replaced; read back, rank."""
    where = scratch_path(spark, "buckets")
    pairs = stage(sm.score_targets(target_fps(spark, sf_dir), doc_fps(spark, sf_dir)), "pairs")
    half = F.pmod(F.crc32(TARGET), F.lit(2)) == 0
    sm.write_pair_buckets(pairs.withColumn(SCORE, F.when(half, -1.0).otherwise(F.col(SCORE))), where, buckets=16)
    sm.write_pair_buckets(pairs.filter(half), where, buckets=16)
    return sm.top_k_similar(sm.read_pair_buckets(spark, where))


def q_fact_build(spark, sf_dir):
    return fact_out(first_load(spark, sf_dir)[1])


def q_dim_build(spark, sf_dir):
    return dim_out(first_load(spark, sf_dir)[0])


def q_fk_rejects(spark, sf_dir):
    rejects = first_load(spark, sf_dir)[2]
    return rejects.select(SOURCE, TARGET, F.col(SCORE).cast("double").alias(SCORE), FLAG, "reject_reason", "copies")


def q_id_union(spark, sf_dir):
    return molecule_ids(sm.score_top_k(target_fps(spark, sf_dir), doc_fps(spark, sf_dir)))


def q_dim_candidates(spark, sf_dir):
    """Every dictionary entry as a wanted molecule, on an empty dimension."""
    entries = dictionary(spark, sf_dir)
    return dim_out(
        new_dimension_rows(entries.select("chembl_id"), entries, properties(spark, sf_dir), empty(spark, DIMENSION))
    )


def q_fact_new_sources(spark, sf_dir):
    return fact_out(second_load(spark, sf_dir, "new_sources")[1])


def q_fact_new_pairs(spark, sf_dir):
    return fact_out(second_load(spark, sf_dir, "new_pairs")[1])


def q_avg_similarity_per_source(spark, sf_dir):
    return sm.avg_similarity_per_source(star(spark, sf_dir)[1])


def q_avg_property_deviation(spark, sf_dir):
    dim, fact = star(spark, sf_dir)
    return sm.avg_property_deviation(fact, dim)


def q_next_most_similar(spark, sf_dir):
    out = sm.next_most_similar(star(spark, sf_dir)[1])
    return out.withColumn(SCORE, F.col(SCORE).cast("double"))


def q_next_most_lines(spark, sf_dir):
    """Leads over all order lines: a supplier is a source, and one source holds every returned line."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_extendedprice")
    score = (F.floor("l_extendedprice") % 1_000_000).cast("double") / 1_000_000
    fact = lines.select(
        F.when(F.col("l_returnflag") == "R", "returned").otherwise(F.col("l_suppkey").cast("string")).alias(SOURCE),
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias(TARGET),
        score.cast("decimal(9,6)").alias(SCORE),
    )
    out = sm.next_most_similar(fact)
    return out.withColumn(SCORE, F.col(SCORE).cast("double"))


def q_next_most_one_score(spark, sf_dir):
    """Leads over all order lines as one source with one score: ranges of equal depth split what bands cannot."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    target = F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias(TARGET)
    fact = lines.select(F.lit("all").alias(SOURCE), target, F.lit("0.5").cast("decimal(9,6)").alias(SCORE))
    out = sm.next_most_similar(fact, cuts=sm.row_cuts(fact))
    return out.withColumn(SCORE, F.col(SCORE).cast("double"))


def q_reports_by_loads(spark, sf_dir):
    """Three reports after two months, of which the second is added twice; no fact is read again."""
    fps = stage(doc_fps_with_lang(spark, sf_dir), "fps")
    dim, fact = star(spark, sf_dir, fps)
    both = target_fps(spark, sf_dir).unionByName(profile_fps(spark, sf_dir, fps))
    new_dim, new_fact, _ = sm.load_mart(sm.score_top_k(both, fps), dictionary(spark, sf_dir), properties(spark, sf_dir), dim, fact)
    new_fact, members = stage(new_fact, "fact"), dim.unionByName(new_dim)
    where = scratch_path(spark, "reports")
    for load, rows, known in ((1, fact, dim), (2, new_fact, members), (2, new_fact, members)):
        sm.add_report_load(rows, known, where, load)
    none = F.lit(None).cast("string")
    by_source = sm.stored_avg_similarity(spark, where)
    gaps = sm.stored_property_deviation(spark, where, by=TARGET)
    groups = sm.stored_categories(spark, where, members, with_grouping_id=True)
    return (
        by_source.select(F.lit("similarity").alias("report"), F.col(SOURCE).alias("id"), none.alias("rings"), none.alias("atoms"), F.col("avg_similarity_score").alias("mean"))
        .union(gaps.select(F.lit("deviation"), TARGET, none, none, "avg_alogp_deviation"))
        .union(groups.select(F.concat(F.lit("category "), "grouping_id"), SOURCE, "aromatic_rings", "heavy_atoms", "avg_similarity_score"))
    )


def q_sql_functions(spark, sf_dir):
    """Scores and sizes of the fact rows by SQL functions, as a user of SQL alone writes them."""
    sm.register_sql_functions(spark, "sm_")
    fps = stage(doc_fps(spark, sf_dir), "fps")
    targets = target_fps(spark, sf_dir)
    text = sm.bits_encode(F.col("on")).alias("bits")
    return spark.sql(
        f"""SELECT {SOURCE}, {TARGET}, sm_tanimoto(a, b) AS score, sm_popcount(a) AS pop, sm_common_bits(a, b) AS common,
            size(sm_bits_unpack(b)) AS target_pop, sm_zero_as_null(CAST(sm_popcount(a) % 7 AS STRING)) IS NULL AS zero
        FROM {{top}} JOIN (SELECT chembl_id AS {SOURCE}, sm_bits_pack_text(bits) AS a FROM {{sources}}) USING ({SOURCE})
        JOIN (SELECT {TARGET}, sm_bits_pack_text(bits) AS b FROM {{targets}}) USING ({TARGET})""",
        top=sm.score_top_k(targets, fps).select(SOURCE, TARGET),
        sources=fps.select("chembl_id", text),
        targets=targets.select(TARGET, text),
    )


def two_months(spark, sf_dir, dim: str, fact: str, entries: DataFrame, props: DataFrame) -> DataFrame:
    """Two months on stored tables: benchmark items, then the same and the first document of each language."""
    fps = stage(doc_fps(spark, sf_dir), "fps")
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    firsts = docs.groupBy("lang").agg(F.min_by("text", "doc_id").alias("smiles"))
    items = benchmark_targets(spark, sf_dir)
    both = items.union(firsts.select(F.concat(F.lit("CHEMBLL"), "lang"), "smiles"))
    for month in (items, both):
        sm.score_month(spark, month, fps, entries, props, dim, fact)
    ids = read_table(spark, dim, DIMENSION).select("chembl_id")
    none = F.lit(None)
    return fact_out(read_table(spark, fact, FACT)).union(
        ids.select("chembl_id", none.cast("string"), none.cast("double"), none.cast("boolean"))
    )


def q_month_twice(spark, sf_dir):
    dim, fact = scratch_path(spark, "dim"), scratch_path(spark, "fact")
    return two_months(spark, sf_dir, dim, fact, dictionary(spark, sf_dir), properties(spark, sf_dir))


def q_month_twice_buckets(spark, sf_dir):
    """The same with staging, dimension and fact in buckets of their keys; both staging tables are refreshed once."""
    names = []
    for label, schema, key in (
        ("dictionary", DICTIONARY, ["chembl_id"]), ("props", PROPERTIES, ["chembl_id"]),
        ("dim", DIMENSION, ["chembl_id"]), ("fact", FACT, [SOURCE, TARGET]),
    ):
        place = scratch_path(spark, label)
        names.append(place.split("/")[-1].replace("-", "_"))
        sm.create_buckets(spark, names[-1], schema, key, buckets=8, path=place)
    sm.refresh_table(dictionary(spark, sf_dir).select(*DICTIONARY.names), names[0])
    sm.refresh_table(properties(spark, sf_dir).select(*PROPERTIES.names), names[1])
    return two_months(spark, sf_dir, names[2], names[3], spark.table(names[0]), spark.table(names[1]))


def q_top10_repeated_ids(spark, sf_dir):
    """Documents of one length are copies of one id; each id counts once with its best score."""
    docs = table(spark, sf_dir, "documents", "n_chars", "text")
    rows = docs.select(F.concat(F.lit("N"), "n_chars").alias("chembl_id"), F.col("text").alias("canonical_smiles"))
    return sm.score_top_k(target_fps(spark, sf_dir), sm.build_fingerprints(rows)[0])


def q_fingerprint_split(spark, sf_dir):
    """Stored texts of which some are too short, have a wrong character or are missing."""
    judged = table(spark, sf_dir, "labels").select(doc_id().alias("chembl_id"), "quality", "toxic")
    bits = sm.bits_encode(F.col("on"))
    stored = (
        F.when(F.col("toxic") == 1, F.translate(bits, "1", "2"))
        .when(F.col("quality") == 0, F.substring(bits, 1, 2047))
        .when(F.col("quality") == 1, bits)
    )
    rows = doc_fps(spark, sf_dir).join(judged, "chembl_id", "left").select("chembl_id", stored.alias("morgan_fingerprint"))
    good, rejects = sm.split_fingerprints(rows)
    return good.select("chembl_id", F.lit("good").alias("outcome")).union(rejects.select("chembl_id", "reject_reason"))


def q_similarity_categories(spark, sf_dir):
    dim, fact = star(spark, sf_dir)
    return sm.similarity_categories(fact, dim)


LINE_RULES = sm.TableRules(key=["l_orderkey", "l_linenumber"])


def q_pk_rejects(spark, sf_dir):
    return sm.check_constraints(table(spark, sf_dir, "lineitem"), LINE_RULES)[1]


def q_pk_first(spark, sf_dir):
    return sm.check_constraints(table(spark, sf_dir, "lineitem"), LINE_RULES)[0]


def q_length_rejects(spark, sf_dir):
    rejects = sm.check_constraints(structures(spark, sf_dir).select(*STRUCTURES.names), RULES["structures"])[1]
    return rejects.select("chembl_id", F.length("canonical_smiles").alias("n"), "reject_reason", "copies")


def q_null_rejects(spark, sf_dir):
    labelled = table(spark, sf_dir, "documents", "doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return sm.check_constraints(labelled, sm.TableRules(not_null=["doc_id", "quality", "toxic"]))[1]


def q_structure_rejects(spark, sf_dir):
    """Each document is a structure; without a line break it does not parse."""
    rows = table(spark, sf_dir, "documents", "doc_id", "text").select(
        doc_id().alias("chembl_id"), F.col("text").alias("canonical_smiles")
    )
    features = lambda s: F.when(s.contains("\n"), sm.text_tokens(s))
    return sm.build_fingerprints(rows, features=features)[1].select("chembl_id", "reject_reason")


def q_record_split_dictionary(spark, sf_dir):
    return sm.split_molecules(molecules(spark, sf_dir))["dictionary"]


def q_record_split_properties(spark, sf_dir):
    props = sm.split_molecules(molecules(spark, sf_dir))["properties"]
    return props.select(*[F.col(f.name).cast("double").alias(f.name) if "decimal" in f.dataType.simpleString() else f.name for f in props.schema])


def q_record_split_structures(spark, sf_dir):
    return sm.split_molecules(molecules(spark, sf_dir))["structures"]


def q_record_rejects(spark, sf_dir):
    rejects = sm.split_molecules(molecules(spark, sf_dir))["rejects"]
    return rejects.select(
        F.get_json_object("record", "$.molecule_chembl_id").alias("chembl_id"), "reject_reason"
    )


def q_zero_as_null(spark, sf_dir):
    kept = sm.split_molecules(molecules(spark, sf_dir), zero_as_null=False)["properties"]
    nulled = sm.split_molecules(molecules(spark, sf_dir))["properties"]
    out = kept.select("chembl_id", F.col("alogp").cast("double").alias("alogp_zero"))
    return out.join(nulled.select("chembl_id", F.col("alogp").cast("double").alias("alogp_null")), "chembl_id")


def q_ingest_staging(spark, sf_dir):
    """The ingest job with constraint checks; the good and rejected rows of every frame it returns."""
    out = sm.ingest(molecules(spark, sf_dir), lookup_items(spark, sf_dir))
    key = F.get_json_object("record", "$.molecule_chembl_id")
    parts = [
        frame.select(F.lit(name).alias("stage"), (key if name == "record_rejects" else F.col("chembl_id")).alias("chembl_id"))
        for name, frame in out.items()
        if name != "lookup_record_rejects"
    ]
    lost = F.get_json_object("record", "$.chembl_id").alias("chembl_id")
    parts.append(out["lookup_record_rejects"].select(F.lit("lookup_record_rejects").alias("stage"), lost))
    return reduce(DataFrame.union, parts)


def staging_tables(spark, sf_dir) -> dict[str, str]:
    """Locations of staging tables that the ingest job has filled twice; the second load replaces the first."""
    tables = {name: scratch_path(spark, name) for name in ("dictionary", "properties", "structures")}
    items = stage(molecules(spark, sf_dir), "items")
    for _ in range(2):
        sm.ingest(items, tables=tables)
    return tables


def q_ingest_refresh(spark, sf_dir):
    """Structures as the fingerprint job reads them from a staging table that was replaced."""
    found = sm.read_structures(spark, staging_tables(spark, sf_dir)["structures"])
    return found.select("chembl_id", F.md5("canonical_smiles").alias("structure_md5"))


def q_row_counts(spark, sf_dir):
    """Rows of each staging table, counted by the action that reads it."""
    counts = []
    for name, location in staging_tables(spark, sf_dir).items():
        df, seen = counted(read_table(spark, location), name)
        df.write.format("noop").mode("overwrite").save()
        counts.append((name, seen.get["rows"]))
    return spark.createDataFrame(counts, "stage string, n bigint")


def lookup_items(spark, sf_dir) -> DataFrame:
    item = F.struct(
        F.concat(F.lit("CHEMBL"), "page_id").alias("chembl_id"),
        F.lit("COMPOUND").alias("entity_type"),
        F.when(F.col("url").startswith("https"), "ACTIVE").otherwise("OBS").alias("status"),
        F.length("url").alias("last_active"),
        F.col("url").alias("resource_url"),
    )
    rows = table(spark, sf_dir, "pages", "page_id", "url").select(
        F.to_json(item).alias("item"), F.col("page_id").alias("offset"), F.lit(None).cast("string").alias("error")
    )
    return decode_items(rows, RAW_LOOKUP)[0]


def q_lookup_load(spark, sf_dir):
    items = lookup_items(spark, sf_dir)
    return sm.check_constraints(typed_lookups(items)["lookup"], RULES["lookup"])[0]


def landed_pages(spark, sf_dir) -> str:
    """Pages of ``PAGE`` records by their place in the order of ``doc_id``, one folder per offset."""
    rows = raw_molecules(spark, sf_dir).select("offset", "item")
    ordered = rows.repartitionByRange("offset").sortWithinPartitions("offset")
    # Stored, because places inside parts must not change.
    ordered = stage(ordered.select("item", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "ordered")
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    total = parts.agg(F.sum("n")).first()[0] or 0
    # One row per part: their number is that of the shuffle's tasks.
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("part", (before - F.col("first")).alias("shift"))
    place = F.col("at") + F.col("shift")
    offset = (F.floor(place / PAGE) * PAGE).alias("offset")
    pages = ordered.join(F.broadcast(starts), "part").groupBy(offset).agg(F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"))
    folder = scratch_path(spark, "pages")
    text = F.concat(F.lit('{"molecules":['), "items", F.lit(f'],"page_meta":{{"total_count":{total}}}}}'))
    pages.select("offset", text.alias("value")).write.partitionBy("offset").text(folder)
    return folder


def q_paged_json_scan(spark, sf_dir):
    fetch = sm.DirectoryFetcher(landed_pages(spark, sf_dir), "offset={offset}")
    items, _ = sm.read_pages(spark, fetch, "molecules", limit=PAGE, delay=0, max_requests=16)
    return items.select(
        "molecule_chembl_id", "molecule_type", F.col("molecule_properties.alogp").alias("alogp"),
        F.md5("molecule_structures.canonical_smiles").alias("structure_md5"),
    )


class Unreliable(sm.DirectoryFetcher):
    """Of three pages the second fails once in each task and the third always; at most 40 items come at once."""

    def __call__(self, offset: int, limit: int) -> dict:
        seen = self.__dict__.setdefault("seen", set())
        page = offset // PAGE * PAGE
        kind = page // PAGE % 3
        if kind == 2 or (kind == 1 and page not in seen):
            seen.add(page)
            raise OSError(f"page {page}")
        whole = super().__call__(page, PAGE)
        return whole | {"molecules": whole["molecules"][offset - page :][: min(limit, 40)]}


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def q_paged_retry_skip(spark, sf_dir):
    """The same pages from a server with failures and short pages: items of the good ones, one row per lost page."""
    fetch = Unreliable(landed_pages(spark, sf_dir), "offset={offset}")
    items, lost = sm.read_pages(spark, fetch, "molecules", limit=PAGE, delay=0, on_page_error="skip", max_requests=16)
    none = F.lit(None)
    return items.select("molecule_chembl_id", none.cast("bigint").alias("offset"), none.cast("string").alias("error")).union(
        lost.select(none.cast("string"), "offset", "error")
    )


class Growing(sm.DirectoryFetcher):
    """A collection that has only its first ``known`` items so far, in any cut of pages."""

    def __init__(self, directory: str, pattern: str, known: int):
        super().__init__(directory, pattern)
        self.known = known

    def __call__(self, offset: int, limit: int) -> dict:
        page = offset // PAGE * PAGE
        whole = super().__call__(page, PAGE)
        items = whole["molecules"][offset - page : self.known - page][:limit]
        return {"molecules": items, "page_meta": {"total_count": min(self.known, whole["page_meta"]["total_count"])}}


def q_paged_stream(spark, sf_dir):
    """Two thirds of a collection, nothing new, and all of it: each run keeps only what it has not seen."""
    folder, kept, done = landed_pages(spark, sf_dir), scratch_path(spark, "kept"), scratch_path(spark, "offsets")
    total = table(spark, sf_dir, "documents").count()
    for known in (total * 2 // 3, total * 2 // 3, total):
        fetch = Growing(folder, "offset={offset}", known)
        sm.stream_pages(spark, fetch, "molecules", kept, done, limit=PAGE, delay=0, max_requests=16).awaitTermination()
    items, _ = sm.read_streamed_pages(spark, kept, "molecules")
    late, _ = sm.read_streamed_pages(spark, kept, "molecules", after=0)
    is_late = late.select("molecule_chembl_id", F.lit(True).alias("late"))
    return items.join(is_late, "molecule_chembl_id", "left").select(
        "molecule_chembl_id", "molecule_type", F.md5("molecule_structures.canonical_smiles").alias("structure_md5"),
        F.coalesce("late", F.lit(False)).alias("late"),
    )


def q_landed_pages(spark, sf_dir):
    items = sm.read_landed_pages(spark, landed_pages(spark, sf_dir), "molecules", one_page_per_line=True)
    return items.select(
        "molecule_chembl_id", "molecule_type", F.col("molecule_properties.alogp").alias("alogp"),
        F.md5("molecule_structures.canonical_smiles").alias("structure_md5"),
    )


def target_lines(spark, sf_dir) -> DataFrame:
    """A target list with all three kinds of names: users have the prefix, assistants do not, systems have none."""
    name = F.concat("conv_id", F.lit("T"), "turn")
    return table(spark, sf_dir, "conversations").select(
        F.when(F.col("role") == "user", F.concat(F.lit("CHEMBL"), name))
        .when(F.col("role") == "assistant", F.concat(F.lit("TMP"), name))
        .alias("Molecule Name"),
        F.col("text").alias("SMILES"),
    )


def write_csv(df: DataFrame, folder: str, *by: str) -> None:
    """Whole texts with their quotes, line breaks and outer blanks."""
    writer = df.write.option("header", True).option("quoteAll", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    (writer.partitionBy(*by) if by else writer).csv(folder)


def q_target_prefix_filter(spark, sf_dir):
    folder = scratch_path(spark, "targets")
    write_csv(target_lines(spark, sf_dir), folder)
    good, _ = sm.read_targets(spark, folder, multi_line=True)
    return good.select(TARGET, F.md5("smiles").alias("smiles_md5"))


def q_csv_targets(spark, sf_dir):
    """Files with two headers, and lines with too many and too few fields: good rows and the number of each reject."""
    folder = scratch_path(spark, "targets")
    rows = target_lines(spark, sf_dir).select(
        F.coalesce("Molecule Name", F.lit("")).alias("name"),
        F.concat(F.lit('"'), F.replace(F.coalesce("SMILES", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')).alias("structure"),
        (F.length(F.coalesce("SMILES", F.lit(""))) % 5).alias("kind"),
    )
    for header, first, second in (("Molecule Name,SMILES", "name", "structure"), ("smiles,MOLECULE NAME", "structure", "name")):
        line = F.when(F.col("kind") == 0, F.concat_ws(",", first, second, F.lit('x,"y,z"'))).when(
            F.col("kind") == 1, F.col(first)
        ).otherwise(F.concat_ws(",", first, second))

        def under_header(batches: Iterator[pa.RecordBatch], header=header) -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_pydict({"value": [header]})
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"value": batch.column(0)})

        named = F.col("name") != ""
        part = rows.filter(named if first == "name" else ~named | (F.col("kind") == 2))
        part.select(line.alias("value")).mapInArrow(under_header, "value string").write.mode("append").text(folder)
    good, rejects = sm.read_targets(spark, folder, multi_line=True)
    none = F.lit(None).cast("string")
    out = good.select(F.lit("good").alias("outcome"), TARGET, F.md5("smiles").alias("smiles_md5")).union(
        rejects.select("reject_reason", none, none)
    )
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


def q_load_once(spark, sf_dir):
    """Two months by ``new_sources``, each batch twice."""
    dim, fact, ledger = (scratch_path(spark, n) for n in ("dim", "fact", "ledger"))
    fps = stage(doc_fps_with_lang(spark, sf_dir), "fps")
    first = target_fps(spark, sf_dir)
    both = first.unionByName(profile_fps(spark, sf_dir, fps))
    for batch, targets in (("01", first), ("01", first), ("02", both), ("02", both)):
        top = sm.score_top_k(targets, fps)
        sm.append_mart_once(top, dictionary(spark, sf_dir), properties(spark, sf_dir), dim, fact, ledger, batch, "new_sources")
    return fact_out(read_table(spark, fact))


def q_month_targets(spark, sf_dir):
    """Of the files of three months one is waited for; the file of another month does not come."""
    inbox = scratch_path(spark, "inbox")
    lines = table(spark, sf_dir, "benchmark").select(
        (F.col("item_id") % 3 + 1).alias("m"), F.concat(F.lit("CHEMBLB"), "item_id").alias("molecule name"), F.col("text").alias("smiles")
    )
    for m in (1, 2, 3):
        write_csv(lines.filter(F.col("m") == m).drop("m"), f"{inbox}/data_{m:02}_2024.csv")
    _, targets, _ = sm.month_targets(spark, inbox, datetime.date(2024, 2, 1), multi_line=True)
    missed, _, _ = sm.month_targets(spark, inbox, datetime.date(2024, 9, 1), timeout=0.2, poll=0.1)
    none = F.lit(None).cast("string")
    row = targets.select(TARGET, F.md5("smiles").alias("smiles_md5"), F.lit("arrived").alias("outcome"))
    return row.union(spark.range(1).select(none, none, F.lit("gave up" if missed.gave_up else "arrived")))


def q_file_stream_once(spark, sf_dir):
    """Files of three months and an empty one arrive; a second run on the same checkpoint finds nothing new."""
    inbox, kept, done = (scratch_path(spark, n) for n in ("inbox", "kept", "offsets"))
    stamp = F.format_string("data_%02d_2024", (F.col("item_id") % 3 + 1).cast("int"))
    lines = table(spark, sf_dir, "benchmark").select(
        stamp.alias("month"), F.concat(F.lit("CHEMBLB"), "item_id").alias("molecule name"),
        F.col("text").alias("smiles"),
    )
    write_csv(lines.hint("rebalance", "month"), inbox, "month")
    lines.select("smiles").limit(0).coalesce(1).write.text(f"{inbox}/month=data_04_2024")

    def keep(targets: DataFrame, rejects: DataFrame, month) -> None:
        none = F.lit(None).cast("string")
        rows = targets.select(TARGET, "smiles", none.alias("reject_reason")).union(rejects.select(none, none, "reject_reason"))
        rows.withColumn("month", F.lit(month).cast("date")).write.mode("append").parquet(kept)

    for _ in range(2):
        sm.stream_targets(spark, inbox, keep, done, pattern="part-*", multi_line=True).awaitTermination()
    return spark.read.parquet(kept).select(
        TARGET, F.md5("smiles").alias("smiles_md5"), "reject_reason", month_stamp(F.col("month")).alias("month")
    )


def q_month_stamp(spark, sf_dir):
    stamp = month_stamp(F.col("o_orderdate"))
    per_month = table(spark, sf_dir, "orders", "o_orderdate").groupBy(stamp.alias("stamp")).agg(F.count(F.lit(1)).alias("n"))
    name = F.concat(F.lit("inbox/data_"), "stamp", F.lit(".csv"))
    return per_month.select("stamp", "n", F.date_format(month_of_file(name), "yyyy-MM-dd").alias("first_day"))


def order_graph(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    returned, unbilled = F.count_if(F.col("l_returnflag") == "R"), F.count_if(F.col("l_linestatus") == "O")
    nodes = lines.groupBy(F.col("l_orderkey").alias("mol"), F.col("l_linenumber").alias("node")).agg(
        F.concat_ws("/", F.count(F.lit(1)), returned, unbilled).alias("label")
    )
    nodes = stage(nodes, "nodes")
    steps = F.create_map(F.lit("next"), F.lit(1), F.lit("prev"), F.lit(-1))
    edges = nodes.select("mol", F.col("node").alias("a"), F.explode(steps).alias("kind", "step")).select(
        "mol", "a", (F.col("a") + F.col("step")).alias("b"), "kind"
    )
    return nodes, edges


def q_neighborhood_features(spark, sf_dir):
    nodes, edges = order_graph(spark, sf_dir)
    fps = sm.fold_features(sm.neighborhood_features(nodes, edges))
    return fps.select(F.col("chembl_id").alias("mol"), F.array_join("on", ",").alias("on_bits"), "pop")


def q_neighborhood_distinct(spark, sf_dir):
    """Of the environments of an order that cover the same edges, the one of the earliest round and smallest hash."""
    nodes, edges = order_graph(spark, sf_dir)
    features = sm.neighborhood_features(nodes, edges, structural_duplicates=False)
    return features.groupBy("mol").agg(
        F.count(F.lit(1)).alias("environments"), F.array_join(F.sort_array(F.collect_list("feature")), ",").alias("features")
    )


# ---------------------------------------------------------------- the same in SQL

LINE_ORDER = """l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"""
HASH = "CAST(CAST(('0x' || substr(md5({0}),1,8)) AS BIGINT) % 2048 AS INT)"

BITS = f"""
doc_bits AS (
  SELECT DISTINCT 'CHEMBL' || doc_id AS id, {HASH.format('tok')} AS bit
  FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS tok FROM documents) WHERE tok <> ''),
doc_pop AS (SELECT id, CAST(count(*) AS INT) AS pop FROM doc_bits GROUP BY id),
bench_bits AS (
  SELECT DISTINCT 'CHEMBLB' || item_id AS id, {HASH.format('tok')} AS bit
  FROM (SELECT item_id, unnest(string_split(text, ' ')) AS tok FROM benchmark) WHERE tok <> ''),
profile_bits AS (
  SELECT 'CHEMBLL' || d.lang AS id, b.bit
  FROM doc_bits b JOIN documents d ON b.id = 'CHEMBL' || d.doc_id
  JOIN (SELECT lang, count(*) AS docs FROM documents GROUP BY lang) s ON s.lang = d.lang
  GROUP BY d.lang, b.bit, s.docs HAVING count(*) * 2 > s.docs)"""


def pairs_sql(sources: str, targets: str, name: str = "pairs") -> str:
    return f"""
{name}_s AS (SELECT id, count(*) AS pop FROM {sources} GROUP BY id),
{name}_t AS (SELECT id, count(*) AS pop FROM {targets} GROUP BY id),
{name}_c AS (SELECT s.id AS sid, t.id AS tid, count(*) AS c
  FROM {sources} s JOIN {targets} t ON s.bit = t.bit GROUP BY s.id, t.id),
{name} AS (SELECT s.id AS source_chembl_id, t.id AS target_chembl_id,
    CAST(coalesce(c, 0) AS DOUBLE) / (s.pop + t.pop - coalesce(c, 0)) AS score
  FROM {name}_s s JOIN {name}_t t ON TRUE LEFT JOIN {name}_c ON sid = s.id AND tid = t.id)"""


def top_sql(pairs: str = "pairs", name: str = "top10", k: int = 10) -> str:
    return f"""
{name} AS (SELECT source_chembl_id, target_chembl_id, score,
    count(*) OVER (PARTITION BY target_chembl_id, score) > 1 AS {FLAG}
  FROM (SELECT *, row_number() OVER (PARTITION BY target_chembl_id ORDER BY score DESC, source_chembl_id) AS place
        FROM {pairs}) WHERE place <= {k})"""


TOP_OUT = f"SELECT source_chembl_id, target_chembl_id, score AS {SCORE}, {FLAG} FROM top10"

STAGING = f"""
dictionary AS (
  SELECT 'CHEMBL' || doc_id AS chembl_id, lang AS molecule_type FROM documents
  UNION ALL SELECT 'CHEMBLB' || item_id, 'benchmark' FROM benchmark
  UNION ALL SELECT DISTINCT 'CHEMBLL' || lang, 'profile' FROM documents),
base AS (
  SELECT 'CHEMBL' || d.doc_id AS chembl_id, n_chars AS n, quality, toxic, source AS species
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  UNION ALL SELECT 'CHEMBLB' || item_id, length(text), 1, 0, 'benchmark' FROM benchmark
  UNION ALL SELECT 'CHEMBLL' || lang, count(*), 1, 0, lang FROM documents GROUP BY lang),
props AS (SELECT chembl_id, {', '.join(f'{e} AS {c}' for c, e in PROPERTY_SQL.items())} FROM base),
members AS (SELECT d.molecule_type, p.* FROM dictionary d JOIN props p ON d.chembl_id = p.chembl_id)"""

FIRST = f"""{BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql()}, {STAGING},
ids AS (SELECT source_chembl_id AS id FROM top10 UNION SELECT target_chembl_id FROM top10),
dim AS (SELECT m.* FROM members m JOIN ids ON m.chembl_id = ids.id),
fact AS (SELECT source_chembl_id, target_chembl_id, CAST(score AS DECIMAL(9,6)) AS {SCORE}, {FLAG} FROM top10
  WHERE source_chembl_id IN (SELECT chembl_id FROM dim) AND target_chembl_id IN (SELECT chembl_id FROM dim))"""

SECOND = f"""{FIRST},
both_bits AS (SELECT * FROM bench_bits UNION ALL SELECT * FROM profile_bits),
{pairs_sql('doc_bits', 'both_bits', 'pairs2')}, {top_sql('pairs2', 'top2')}"""


def fact_sql(condition: str) -> str:
    return f"""WITH {SECOND}
SELECT t.source_chembl_id, t.target_chembl_id, CAST(CAST(score AS DECIMAL(9,6)) AS DOUBLE) AS {SCORE}, t.{FLAG}
FROM top2 t WHERE {condition} AND t.source_chembl_id IN (SELECT chembl_id FROM members)
  AND t.target_chembl_id IN (SELECT chembl_id FROM members)"""


DIM_OUT = ", ".join(
    f"CAST({f.name} AS DOUBLE) AS {f.name}" if "decimal" in f.dataType.simpleString() else f.name for f in DIMENSION.fields
)

RAW = """raw AS (
  SELECT 'CHEMBL' || d.doc_id AS chembl_id, d.doc_id, lang, text, source, n_chars AS n, quality, coalesce(toxic, 0) AS toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
good AS (SELECT * FROM raw WHERE quality IS NULL OR quality <> 0)"""

ALOGP = """CASE n % 3 WHEN 0 THEN {zero} WHEN 1 THEN NULL
  ELSE CAST(CAST(CAST(doc_id || '.125' AS DECIMAL(18,3)) AS DECIMAL(9,2)) AS DOUBLE) END"""

FOLD_OUT = "SELECT id AS chembl_id, string_agg(bit, ',' ORDER BY bit) AS on_bits, CAST(count(*) AS INT) AS pop"

SCAN_SQL = f"""WITH {RAW}
SELECT chembl_id AS molecule_chembl_id, lang AS molecule_type,
  CASE WHEN quality IS NULL THEN NULL WHEN n % 3 = 0 THEN '0.00' WHEN n % 3 = 1 THEN '' ELSE doc_id || '.125' END AS alogp,
  CASE WHEN toxic = 0 THEN md5(text) END AS structure_md5 FROM raw"""

SHORT = "CAST('0x' || substr(md5({0}), 1, 15) AS BIGINT)"
NEIGHBOUR = f"""n0 AS (SELECT l_orderkey AS mol, l_linenumber AS node,
    {SHORT.format("count(*) || '/' || count_if(l_returnflag = 'R') || '/' || count_if(l_linestatus = 'O')")} AS h FROM lineitem GROUP BY 1, 2)"""


def round_sql(i: int) -> str:
    update = SHORT.format("h || ',' || coalesce(n, 0) || ',' || coalesce(high, 0) || ',' || coalesce(low, 0)")
    return f"""m{i} AS (SELECT mol, a, count(*) AS n, sum(term >> 30) AS high, sum(term & 1073741823) AS low FROM (
    SELECT mol, a, {SHORT.format("kind || ':' || h")} AS term FROM (
      SELECT mol, node - 1 AS a, 'next' AS kind, h FROM n{i} UNION ALL SELECT mol, node + 1, 'prev', h FROM n{i}))
    GROUP BY 1, 2),
n{i + 1} AS (SELECT s.mol, s.node, {update} AS h FROM n{i} s LEFT JOIN m{i} m ON s.mol = m.mol AND s.node = m.a)"""


PACKED = """words AS (SELECT id, bit // 64 AS w, sum(CAST(1 AS HUGEINT) << (63 - bit % 64)) AS v FROM doc_bits GROUP BY 1, 2),
grid AS (SELECT p.id, i, CASE WHEN v >= CAST(1 AS HUGEINT) << 63 THEN v - (CAST(1 AS HUGEINT) << 64) ELSE coalesce(v, 0) END AS v
  FROM doc_pop p JOIN range(32) r(i) ON TRUE LEFT JOIN words ON words.id = p.id AND w = i),
packed AS (SELECT id, string_agg(v, ',' ORDER BY i) AS words FROM grid GROUP BY id)"""

MONTHS = f"""WITH {FIRST},
first_bits AS (SELECT 'CHEMBLL' || d.lang AS id, b.bit FROM documents d JOIN (
    SELECT min(doc_id) AS doc_id FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY lang) f ON f.doc_id = d.doc_id
  JOIN doc_bits b ON b.id = 'CHEMBL' || d.doc_id),
both_bits AS (SELECT * FROM bench_bits UNION ALL SELECT * FROM first_bits),
{pairs_sql('doc_bits', 'both_bits', 'pairs2')}, {top_sql('pairs2', 'top2')},
loaded AS (SELECT * FROM top2 WHERE source_chembl_id IN (SELECT chembl_id FROM members)
  AND target_chembl_id IN (SELECT chembl_id FROM members))
SELECT source_chembl_id, target_chembl_id, CAST(CAST(score AS DECIMAL(9,6)) AS DOUBLE) AS {SCORE}, {FLAG} FROM loaded
UNION ALL SELECT chembl_id, NULL, NULL, NULL FROM members
  WHERE chembl_id IN (SELECT source_chembl_id FROM top2 UNION SELECT target_chembl_id FROM top2)"""

ORACLE: dict[str, str] = {
    "top10_embeddings": f"""WITH
src AS (SELECT CAST(vec_id AS VARCHAR) AS id, label, pos AS bit FROM (
  SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) WHERE x > 0),
tgt AS (SELECT 'label' || s.label AS id, bit FROM src s
  JOIN (SELECT label, count(*) AS members FROM embeddings GROUP BY label) m ON m.label = s.label
  GROUP BY s.label, bit, members HAVING count(*) * 2 > members),
{pairs_sql('src', 'tgt')}, {top_sql()} {TOP_OUT}""",
    "fingerprint_fold": f"WITH {BITS} {FOLD_OUT} FROM doc_bits GROUP BY id",
    "fingerprint_with": f"WITH {BITS} {FOLD_OUT} FROM doc_bits GROUP BY id",
    "token_ngrams": f"""WITH toks AS (
  SELECT 'CHEMBL' || doc_id AS id, list_filter(string_split(text, ' '), lambda x: x <> '') AS t FROM documents),
grams AS (SELECT id, unnest(CASE WHEN len(t) > 1
    THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE [] END) AS g FROM toks),
bits AS (SELECT DISTINCT id, {HASH.format('g')} AS bit FROM grams)
SELECT t.id AS chembl_id, coalesce(string_agg(bit, ',' ORDER BY bit), '') AS on_bits, CAST(count(bit) AS INT) AS pop
FROM toks t LEFT JOIN bits b ON t.id = b.id GROUP BY t.id""",
    "char_ngrams": f"""WITH bits AS (SELECT DISTINCT id, {HASH.format('g')} AS bit FROM (
  SELECT p_partkey AS id, substr(p_name, unnest(range(1, length(p_name) - 1)), 3) AS g FROM part))
SELECT p_partkey AS chembl_id, coalesce(string_agg(bit, ',' ORDER BY bit), '') AS on_bits, CAST(count(bit) AS INT) AS pop
FROM part LEFT JOIN bits ON id = p_partkey GROUP BY p_partkey""",
    "bits_roundtrip": f"""WITH {BITS}
SELECT p.id AS chembl_id, md5(string_agg(CASE WHEN b.bit IS NULL THEN '0' ELSE '1' END, '' ORDER BY i)) AS bits_md5,
  string_agg(b.bit, ',' ORDER BY b.bit) AS on_bits
FROM doc_pop p JOIN range(2048) r(i) ON TRUE LEFT JOIN doc_bits b ON b.id = p.id AND b.bit = i GROUP BY p.id""",
    "bits_stored_forms": f"""WITH {BITS},
{PACKED}
SELECT packed.id AS chembl_id, bits_md5, words FROM packed JOIN (
  SELECT p.id, md5(string_agg(CASE WHEN b.bit IS NULL THEN '0' ELSE '1' END, '' ORDER BY i)) AS bits_md5
  FROM doc_pop p JOIN range(2048) r(i) ON TRUE LEFT JOIN doc_bits b ON b.id = p.id AND b.bit = i GROUP BY p.id) t
ON t.id = packed.id""",
    "bits_pack_popcount": f"""WITH {BITS},
{PACKED}
SELECT packed.id AS chembl_id, words, pop, on_md5 FROM packed JOIN doc_pop ON packed.id = doc_pop.id
JOIN (SELECT id, md5(string_agg(bit, ',' ORDER BY bit)) AS on_md5 FROM doc_bits GROUP BY id) o ON o.id = packed.id""",
    "pair_scores": f"""WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}
SELECT source_chembl_id AS chembl_id, score AS {SCORE}, target_chembl_id FROM pairs""",
    "tanimoto_native": f"""WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql()}
SELECT source_chembl_id, target_chembl_id, score AS native_score, TRUE AS same FROM top10""",
    "top10_documents": f"WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql()} {TOP_OUT}",
    "top10_no_self": f"""WITH {BITS}, {pairs_sql('profile_bits', 'profile_bits', 'every')},
pairs AS (SELECT * FROM every WHERE source_chembl_id <> target_chembl_id), {top_sql()} {TOP_OUT}""",
    "tie_flag": f"WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql(k=5)} {TOP_OUT}",
    "tie_flag_boundary": f"""WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')},
placed AS (SELECT *, row_number() OVER (PARTITION BY target_chembl_id ORDER BY score DESC, source_chembl_id) AS place,
  rank() OVER (PARTITION BY target_chembl_id ORDER BY score DESC) AS r FROM pairs),
cut AS (SELECT target_chembl_id AS t, max(CASE WHEN place = 10 THEN score END) AS kth,
  count(CASE WHEN r <= 10 THEN 1 END) AS within FROM placed GROUP BY 1)
SELECT source_chembl_id, target_chembl_id, score AS {SCORE}, coalesce(within > 10 AND score = kth, FALSE) AS {FLAG}
FROM placed JOIN cut ON t = target_chembl_id WHERE place <= 10""",
    "fingerprint_files": f"WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql()} {TOP_OUT}",
    "fingerprint_word_files": f"WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql()} {TOP_OUT}",
    "top10_in_passes": f"WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql()} {TOP_OUT}",
    "pairs_above": f"""WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}
SELECT source_chembl_id AS chembl_id, score AS {SCORE}, target_chembl_id FROM pairs WHERE score >= 0.1""",
    "pairs_postings": f"""WITH {BITS}, {pairs_sql('doc_bits', 'doc_bits')}
SELECT source_chembl_id AS chembl_id, score AS {SCORE}, target_chembl_id FROM pairs
WHERE score >= 0.8 AND source_chembl_id <> target_chembl_id""",
    "pairs_blocks": f"""WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}
SELECT source_chembl_id AS chembl_id, score AS {SCORE}, target_chembl_id FROM pairs""",
    "top10_blocks": f"""WITH {BITS}, {pairs_sql('doc_bits', 'doc_bits', 'every')},
pairs AS (SELECT * FROM every WHERE source_chembl_id <> target_chembl_id), {top_sql()} {TOP_OUT}""",
    "top10_bands": f"WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql()} {TOP_OUT}",
    "top10_loads": f"""WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')},
placed AS (SELECT *, row_number() OVER (PARTITION BY target_chembl_id ORDER BY score DESC, source_chembl_id) AS place,
  rank() OVER (PARTITION BY target_chembl_id ORDER BY score DESC) AS r FROM pairs),
cut AS (SELECT target_chembl_id AS t, max(CASE WHEN place = 10 THEN score END) AS kth,
  count(CASE WHEN r <= 10 THEN 1 END) AS within FROM placed GROUP BY 1)
SELECT source_chembl_id, target_chembl_id, score AS {SCORE}, coalesce(within > 10 AND score = kth, FALSE) AS {FLAG}
FROM placed JOIN cut ON t = target_chembl_id WHERE place <= 10""",
    "pairs_by_target": f"WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql()} {TOP_OUT}",
    "pairs_by_bucket": f"WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql()} {TOP_OUT}",
    "fact_build": f"WITH {FIRST} SELECT source_chembl_id, target_chembl_id, CAST({SCORE} AS DOUBLE) AS {SCORE}, {FLAG} FROM fact",
    "dim_build": f"WITH {FIRST} SELECT {DIM_OUT} FROM dim",
    "fk_rejects": f"""WITH {FIRST}
SELECT source_chembl_id, target_chembl_id, CAST(CAST(score AS DECIMAL(9,6)) AS DOUBLE) AS {SCORE}, {FLAG},
  concat_ws(',', CASE WHEN s.chembl_id IS NULL THEN 'fk:source_chembl_id' END,
    CASE WHEN t.chembl_id IS NULL THEN 'fk:target_chembl_id' END) AS reject_reason, CAST(1 AS BIGINT) AS copies
FROM top10 LEFT JOIN dim s ON s.chembl_id = source_chembl_id LEFT JOIN dim t ON t.chembl_id = target_chembl_id
WHERE s.chembl_id IS NULL OR t.chembl_id IS NULL""",
    "id_union": f"WITH {FIRST} SELECT id AS chembl_id FROM ids",
    "dim_candidates": f"WITH {STAGING} SELECT {DIM_OUT} FROM members",
    "fact_new_sources": fact_sql("t.source_chembl_id NOT IN (SELECT chembl_id FROM dim)"),
    "fact_new_pairs": fact_sql(
        "NOT EXISTS (SELECT 1 FROM fact f WHERE f.source_chembl_id = t.source_chembl_id AND f.target_chembl_id = t.target_chembl_id)"
    ),
    "avg_similarity_per_source": f"""WITH {FIRST}
SELECT source_chembl_id, CAST(sum({SCORE}) AS DOUBLE) / nullif(count({SCORE}), 0) AS avg_similarity_score FROM fact GROUP BY 1""",
    "avg_property_deviation": f"""WITH {FIRST}
SELECT source_chembl_id, CAST(sum(abs(a.alogp - b.alogp)) AS DOUBLE) / nullif(count(abs(a.alogp - b.alogp)), 0) AS avg_alogp_deviation
FROM fact JOIN dim a ON a.chembl_id = source_chembl_id JOIN dim b ON b.chembl_id = target_chembl_id GROUP BY 1""",
    "next_most_similar": f"""WITH {FIRST}
SELECT source_chembl_id, target_chembl_id, CAST({SCORE} AS DOUBLE) AS {SCORE},
  lead(target_chembl_id, 1) OVER w AS next_most_similar, lead(target_chembl_id, 2) OVER w AS second_most_similar
FROM fact WINDOW w AS (PARTITION BY source_chembl_id ORDER BY {SCORE} DESC NULLS FIRST, target_chembl_id)""",
    "next_most_lines": f"""WITH fact AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE CAST(l_suppkey AS VARCHAR) END AS source_chembl_id,
    l_orderkey || '-' || l_linenumber AS target_chembl_id,
    CAST(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000000 AS DOUBLE) / 1000000 AS DECIMAL(9,6)) AS {SCORE} FROM lineitem)
SELECT source_chembl_id, target_chembl_id, CAST({SCORE} AS DOUBLE) AS {SCORE},
  lead(target_chembl_id, 1) OVER w AS next_most_similar, lead(target_chembl_id, 2) OVER w AS second_most_similar
FROM fact WINDOW w AS (PARTITION BY source_chembl_id ORDER BY {SCORE} DESC, target_chembl_id)""",
    "next_most_one_score": f"""SELECT 'all' AS source_chembl_id, t AS target_chembl_id, CAST(0.5 AS DOUBLE) AS {SCORE},
  lead(t, 1) OVER (ORDER BY t) AS next_most_similar, lead(t, 2) OVER (ORDER BY t) AS second_most_similar
FROM (SELECT l_orderkey || '-' || l_linenumber AS t FROM lineitem)""",
    "reports_by_loads": f"""WITH {SECOND},
ids2 AS (SELECT id FROM ids UNION SELECT source_chembl_id FROM top2 UNION SELECT target_chembl_id FROM top2),
dim2 AS (SELECT m.* FROM members m JOIN ids2 ON m.chembl_id = ids2.id),
fact2 AS (SELECT source_chembl_id, target_chembl_id, {SCORE} FROM fact
  UNION ALL SELECT t.source_chembl_id, t.target_chembl_id, CAST(score AS DECIMAL(9,6)) FROM top2 t
  WHERE t.source_chembl_id IN (SELECT chembl_id FROM members) AND t.target_chembl_id IN (SELECT chembl_id FROM members)
    AND NOT EXISTS (SELECT 1 FROM fact f WHERE f.source_chembl_id = t.source_chembl_id AND f.target_chembl_id = t.target_chembl_id))
SELECT 'similarity' AS report, source_chembl_id AS id, NULL AS rings, NULL AS atoms,
  CAST(sum({SCORE}) AS DOUBLE) / nullif(count({SCORE}), 0) AS mean FROM fact2 GROUP BY 2
UNION ALL SELECT 'deviation', target_chembl_id, NULL, NULL,
  CAST(sum(abs(a.alogp - b.alogp)) AS DOUBLE) / nullif(count(abs(a.alogp - b.alogp)), 0)
  FROM fact2 JOIN dim2 a ON a.chembl_id = source_chembl_id JOIN dim2 b ON b.chembl_id = target_chembl_id GROUP BY 2
UNION ALL SELECT 'category ' || g, CASE WHEN g = 7 THEN 'TOTAL' ELSE source_chembl_id END,
  CASE WHEN g = 7 THEN 'TOTAL' ELSE CAST(aromatic_rings AS VARCHAR) END,
  CASE WHEN g = 7 THEN 'TOTAL' ELSE CAST(heavy_atoms AS VARCHAR) END, mean
FROM (SELECT source_chembl_id, aromatic_rings, heavy_atoms, grouping(source_chembl_id, aromatic_rings, heavy_atoms) AS g,
    CAST(sum({SCORE}) AS DOUBLE) / nullif(count({SCORE}), 0) AS mean
  FROM fact2 JOIN dim2 ON chembl_id = source_chembl_id
  GROUP BY GROUPING SETS ((source_chembl_id), (aromatic_rings, heavy_atoms), (heavy_atoms), ()))""",
    "sql_functions": f"""WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits')}, {top_sql()}
SELECT t.source_chembl_id, t.target_chembl_id, t.score, s.pop, CAST(coalesce(c, 0) AS INT) AS common, CAST(b.pop AS INT) AS target_pop,
  s.pop % 7 = 0 AS zero
FROM top10 t JOIN doc_pop s ON s.id = t.source_chembl_id
JOIN pairs_t b ON b.id = t.target_chembl_id LEFT JOIN pairs_c ON sid = t.source_chembl_id AND tid = t.target_chembl_id""",
    "month_twice": MONTHS,
    "month_twice_buckets": MONTHS,
    "top10_repeated_ids": f"""WITH {BITS}, {pairs_sql('doc_bits', 'bench_bits', 'every')},
pairs AS (SELECT 'N' || n_chars AS source_chembl_id, target_chembl_id, max(score) AS score
  FROM every JOIN documents ON source_chembl_id = 'CHEMBL' || doc_id GROUP BY 1, 2), {top_sql()} {TOP_OUT}""",
    "fingerprint_split": f"""WITH {BITS}
SELECT id AS chembl_id, CASE WHEN quality IS NULL THEN 'null_fingerprint' WHEN toxic = 1 OR quality = 0 THEN 'malformed' ELSE 'good' END AS outcome
FROM doc_pop LEFT JOIN labels ON id = 'CHEMBL' || doc_id""",
    "similarity_categories": f"""WITH {FIRST}
SELECT CASE WHEN g = 7 THEN 'TOTAL' ELSE source_chembl_id END AS source_chembl_id,
  CASE WHEN g = 7 THEN 'TOTAL' ELSE CAST(aromatic_rings AS VARCHAR) END AS aromatic_rings,
  CASE WHEN g = 7 THEN 'TOTAL' ELSE CAST(heavy_atoms AS VARCHAR) END AS heavy_atoms, avg_similarity_score
FROM (SELECT source_chembl_id, aromatic_rings, heavy_atoms, grouping(source_chembl_id, aromatic_rings, heavy_atoms) AS g,
    CAST(sum({SCORE}) AS DOUBLE) / nullif(count({SCORE}), 0) AS avg_similarity_score
  FROM fact JOIN dim ON chembl_id = source_chembl_id
  GROUP BY GROUPING SETS ((source_chembl_id), (aromatic_rings, heavy_atoms), (heavy_atoms), ()))""",
    "pk_rejects": f"""WITH c AS (SELECT *, count(*) AS n FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS place FROM c)
SELECT * EXCLUDE (n, place), 'key:l_orderkey+l_linenumber' AS reject_reason,
  n - CASE WHEN place = 1 THEN 1 ELSE 0 END AS copies FROM r WHERE n > 1 OR place > 1""",
    "pk_first": f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {LINE_ORDER}) AS place FROM lineitem) WHERE place = 1""",
    "length_rejects": """SELECT 'CHEMBL' || doc_id AS chembl_id, CAST(length(text) AS INT) AS n,
  'length:canonical_smiles' AS reject_reason, CAST(1 AS BIGINT) AS copies FROM documents WHERE length(text) > 4000""",
    "null_rejects": """SELECT d.doc_id, lang, quality, toxic,
  concat_ws(',', CASE WHEN quality IS NULL THEN 'null:quality' END, CASE WHEN toxic IS NULL THEN 'null:toxic' END) AS reject_reason,
  CAST(1 AS BIGINT) AS copies
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NULL OR toxic IS NULL""",
    "structure_rejects": """WITH s AS (SELECT 'CHEMBL' || doc_id AS chembl_id, text FROM documents)
SELECT chembl_id, CASE WHEN text IS NULL OR regexp_matches(text, '^\\s*$') THEN 'empty' ELSE 'invalid' END AS reject_reason
FROM s WHERE text IS NULL OR regexp_matches(text, '^\\s*$') OR NOT contains(text, chr(10))""",
    "record_split_dictionary": f"WITH {RAW} SELECT chembl_id, lang AS molecule_type FROM good",
    "record_split_properties": f"""WITH {RAW}
SELECT chembl_id, nullif(CAST(CAST(n AS DOUBLE) / 10 AS DOUBLE), 0) AS mw_freebase, {ALOGP.format(zero='NULL')} AS alogp,
  CAST(nullif(n % 90, 0) AS DOUBLE) AS psa, CAST(NULL AS DOUBLE) AS cx_logp, source AS molecular_species,
  CAST(nullif(n % 1000, 0) AS DOUBLE) AS full_mwt, CAST(n % 4 AS INT) AS aromatic_rings, CAST(n % 7 AS INT) AS heavy_atoms
FROM good WHERE quality IS NOT NULL""",
    "record_split_structures": f"WITH {RAW} SELECT chembl_id, text AS canonical_smiles FROM good WHERE toxic = 0",
    "record_rejects": f"WITH {RAW} SELECT chembl_id, 'not_numeric:psa' AS reject_reason FROM raw WHERE quality = 0",
    "zero_as_null": f"""WITH {RAW}
SELECT chembl_id, {ALOGP.format(zero='0')} AS alogp_zero, {ALOGP.format(zero='NULL')} AS alogp_null
FROM good WHERE quality IS NOT NULL""",
    "ingest_staging": f"""WITH {RAW}
SELECT 'dictionary' AS stage, chembl_id FROM good
UNION ALL SELECT 'properties', chembl_id FROM good WHERE quality IS NOT NULL
UNION ALL SELECT CASE WHEN length(text) > 4000 THEN 'structures_rejects' ELSE 'structures' END, chembl_id FROM good WHERE toxic = 0
UNION ALL SELECT 'record_rejects', chembl_id FROM raw WHERE quality = 0
UNION ALL SELECT 'lookup', 'CHEMBL' || page_id FROM pages""",
    "ingest_refresh": f"WITH {RAW} SELECT chembl_id, md5(text) AS structure_md5 FROM good WHERE toxic = 0 AND length(text) <= 4000",
    "row_counts": f"""WITH {RAW}
SELECT 'dictionary' AS stage, count(*) AS n FROM good UNION ALL SELECT 'properties', count(*) FROM good WHERE quality IS NOT NULL
UNION ALL SELECT 'structures', count(*) FROM good WHERE toxic = 0 AND length(text) <= 4000""",
    "lookup_load": """SELECT 'CHEMBL' || page_id AS chembl_id, 'COMPOUND' AS entity_type,
  CASE WHEN url LIKE 'https%' THEN 'ACTIVE' ELSE 'OBS' END AS status, CAST(length(url) AS INT) AS last_active,
  url AS resource_url FROM pages""",
    "paged_json_scan": SCAN_SQL,
    "landed_pages": SCAN_SQL,
    "paged_stream": f"""WITH {RAW}
SELECT chembl_id AS molecule_chembl_id, lang AS molecule_type, CASE WHEN toxic = 0 THEN md5(text) END AS structure_md5,
  row_number() OVER (ORDER BY doc_id) > (SELECT count(*) FROM documents) * 2 // 3 AS late FROM raw""",
    "paged_retry_skip": f"""WITH p AS (
  SELECT 'CHEMBL' || doc_id AS id, (row_number() OVER (ORDER BY doc_id) - 1) // {PAGE} AS page FROM documents)
SELECT id AS molecule_chembl_id, CAST(NULL AS BIGINT) AS "offset", CAST(NULL AS VARCHAR) AS error FROM p WHERE page % 3 <> 2
UNION ALL SELECT DISTINCT NULL, page * {PAGE}, 'OSError: page ' || page * {PAGE} FROM p WHERE page % 3 = 2""",
    "target_prefix_filter": """SELECT DISTINCT 'CHEMBL' || conv_id || 'T' || turn AS target_chembl_id,
  md5(text) AS smiles_md5 FROM conversations WHERE role = 'user'""",
    "csv_targets": """WITH t AS (
  SELECT CASE role WHEN 'user' THEN 'CHEMBL' || conv_id || 'T' || turn WHEN 'assistant' THEN 'TMP' || conv_id || 'T' || turn END AS name,
    coalesce(text, '') AS s, length(coalesce(text, '')) % 5 AS kind FROM conversations),
lines AS (
  SELECT name, kind, CASE WHEN kind <> 1 THEN s END AS s FROM t WHERE name IS NOT NULL
  UNION ALL SELECT CASE WHEN kind <> 1 THEN name END, kind, s FROM t WHERE name IS NULL OR kind = 2),
judged AS (SELECT *, CASE WHEN kind = 0 THEN 'too_many_fields' WHEN name IS NULL THEN 'missing_name'
  WHEN name NOT LIKE 'CHEMBL%' THEN 'name_prefix' ELSE 'good' END AS outcome FROM lines)
SELECT 'good' AS outcome, name AS target_chembl_id, md5(s) AS smiles_md5, CAST(1 AS BIGINT) AS n
FROM (SELECT DISTINCT name, s FROM judged WHERE outcome = 'good')
UNION ALL SELECT outcome, NULL, NULL, count(*) FROM judged WHERE outcome <> 'good' GROUP BY 1""",
    "load_once": f"""SELECT * FROM (WITH {FIRST}
SELECT source_chembl_id, target_chembl_id, CAST({SCORE} AS DOUBLE) AS {SCORE}, {FLAG} FROM fact)
UNION ALL SELECT * FROM ({fact_sql("t.source_chembl_id NOT IN (SELECT chembl_id FROM dim)")})""",
    "month_targets": """SELECT 'CHEMBLB' || item_id AS target_chembl_id, md5(text) AS smiles_md5, 'arrived' AS outcome
FROM benchmark WHERE item_id % 3 = 1 UNION ALL SELECT NULL, NULL, 'gave up'""",
    "file_stream_once": """SELECT 'CHEMBLB' || item_id AS target_chembl_id, md5(text) AS smiles_md5,
  CAST(NULL AS VARCHAR) AS reject_reason, '0' || (item_id % 3 + 1) || '_2024' AS month FROM benchmark
UNION ALL SELECT NULL, NULL, 'empty_file', NULL""",
    "month_stamp": """SELECT strftime(o_orderdate, '%m_%Y') AS stamp, count(*) AS n,
  strftime(date_trunc('month', min(o_orderdate)), '%Y-%m-%d') AS first_day FROM orders GROUP BY 1""",
    "neighborhood_features": f"""WITH {NEIGHBOUR}, {round_sql(0)}, {round_sql(1)},
bits AS (SELECT DISTINCT mol, CAST(h % 2048 AS INT) AS bit FROM (
  SELECT mol, h FROM n0 UNION ALL SELECT mol, h FROM n1 UNION ALL SELECT mol, h FROM n2))
SELECT mol, string_agg(bit, ',' ORDER BY bit) AS on_bits, CAST(count(*) AS INT) AS pop FROM bits GROUP BY mol""",
    "neighborhood_distinct": f"""WITH {NEIGHBOUR}, {round_sql(0)}, {round_sql(1)},
bond AS (SELECT s.mol, s.node AS lo, s.node + 1 AS hi FROM n0 s SEMI JOIN n0 t ON s.mol = t.mol AND t.node = s.node + 1),
near AS (SELECT mol, node, node AS w, 1 AS r FROM n0
  UNION SELECT mol, node, node, 2 FROM n0
  UNION SELECT mol, lo, hi, 2 FROM bond UNION SELECT mol, hi, lo, 2 FROM bond),
cover AS (SELECT mol, node, r, string_agg(lo || '-' || hi, ',' ORDER BY lo, hi) AS edges
  FROM (SELECT DISTINCT b.mol, node, r, lo, hi FROM near n JOIN bond b ON b.mol = n.mol AND (w = lo OR w = hi)) GROUP BY 1, 2, 3),
environment AS (SELECT c.*, h FROM cover c JOIN (SELECT *, 1 AS r FROM n1 UNION ALL SELECT *, 2 FROM n2) f
  ON f.mol = c.mol AND f.node = c.node AND f.r = c.r),
kept AS (SELECT mol, h FROM environment QUALIFY row_number() OVER (PARTITION BY mol, edges ORDER BY r, h) = 1
  UNION ALL SELECT mol, h FROM n0)
SELECT mol, count(*) AS environments, string_agg(h, ',' ORDER BY h) AS features FROM kept GROUP BY mol""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name.removeprefix("q_"): fn for name, fn in list(globals().items()) if name.startswith("q_")
}
