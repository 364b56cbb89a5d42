"""One query for each operator of this folder over its whole table, and the same results in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from simmart.llm.binary_topk import nearest_codes, sign_code
from simmart.llm.chat_format import canonical_turns, format_chats, read_loss, read_turns
from simmart.llm.conversation_repair import damage, repair, text_digests
from simmart.llm.decontaminate import find_benchmark
from simmart.llm.jaccard_join import join_similar
from simmart.llm.language_id import fit, identify
from simmart.llm.line_dedup import dedup_lines
from simmart.llm.mixing import mix_sources
from simmart.llm.secret_scan import ALLOWED, BASE, CLASSES, KINDS, MIXED, WINDOW, most, scan_secrets, span_list, weights
from simmart.llm.substring_dedup import dedup_windows
from simmart.llm.suffix_dedup import dedup_bytes
from simmart.llm.token_count import count_tokens
from simmart.llm.vector_codes import encode_vectors, with_label_error


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", F.octet_length("text").alias("n_bytes"), "text")
    mixed = mix_sources(docs)
    return mixed.select("doc_id", "source", F.coalesce("n_bytes", F.lit(0)).cast("long").alias("n_bytes"), "mix_block", "mix_slot")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_windows(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(docs, _table(spark, sf_dir, "benchmark"))
    each = found.select("doc_id", F.explode("matches").alias("m"))
    return each.select("doc_id", F.col("m.item").alias("item_id"), "m.distance", "m.start", "m.end")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_bytes(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = canonical_turns(_table(spark, sf_dir, "conversations"))
    own = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') "
        "AS t(conv_id, turn, role, text)"
    )
    chats = format_chats(turns.unionByName(own))
    read = chats.withColumn("turns", read_turns(F.col("formatted"))).withColumn(
        "loss", F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "")
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = fit(docs.filter(~F.coalesce(held_out, F.lit(False))), "doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _table(spark, sf_dir, "embeddings").select("vec_id", sign_code(F.col("embedding")).alias("code"))
    return nearest_codes(codes, codes.filter("vec_id % 50 = 0"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair(damage(_table(spark, sf_dir, "conversations")))
    texts = text_digests(found.spans).select(F.col("conv_id").alias("owner"), F.col("sha256").alias("repaired_sha256"))
    all_of = found.conversations.join(texts, F.col("conv_id").eqNullSafe(F.col("owner")), "left")
    return all_of.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_vectors(_table(spark, sf_dir, "embeddings"))
    return with_label_error(coded.codes).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256")
    )


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(kinds) - F.size(F.array_remove(kinds, k)) for k in range(len(BASE))]
    return found.select(
        F.col("id").alias("doc_id"), *(c.cast("long").alias(f"n_{b[0]}") for c, b in zip(counts, BASE)), F.sha2(span_list(F.col("base")), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_source_mixing,
        op3_substring_dedup,
        op4_decontamination,
        op5_suffix_dedup,
        op6_chat_formatting,
        op7_language_id,
        op8_line_dedup,
        op9_exact_topk,
        op10_ngram_jaccard,
        op11_conversation_repair,
        op12_vector_codes,
        op13_secret_scan,
    )
} | {"pipeline": corpus_pipeline.run}

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _codebook_sql() -> str:
    """Six rounds and the codes, one CTE each, by distances of all parts to all entries."""
    nearest = """
        near{r} AS MATERIALIZED (
            SELECT vec_id, n, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
            FROM (SELECT vec_id, n, part, entry, list_sum(list_transform(list_zip(v, w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                  FROM cut JOIN book{r} USING (part))
            GROUP BY ALL)"""
    moved = """
        mean{r} AS (
            SELECT part, entry, pos, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
            FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS pos FROM cut JOIN near{r} USING (vec_id, n, part))
            GROUP BY ALL),
        book{next} AS MATERIALIZED (
            SELECT part, entry, coalesce(m, w) AS w
            FROM book{r} LEFT JOIN (SELECT part, entry, list(x ORDER BY pos) AS m FROM mean{r} GROUP BY ALL) USING (part, entry))"""
    steps = [nearest.format(r=r) + "," + moved.format(r=r, next=r + 1) for r in range(6)] + [nearest.format(r=6)]
    return f"""
        WITH kept AS (
            SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS n,
                   list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        cut AS MATERIALIZED (
            SELECT vec_id, n, part, v[part * (len(v) // 8) + 1:(part + 1) * (len(v) // 8)] AS v FROM kept, range(8) AS p(part)),
        book0 AS (SELECT part, n - 1 AS entry, v AS w FROM cut WHERE n <= 16),
        {",".join(steps)},
        hash AS (
            SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
            FROM (SELECT part, entry, unnest(w) AS x, unnest(range(len(w))) AS pos FROM book6)),
        coded AS (
            SELECT vec_id, n, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
            FROM near6 GROUP BY vec_id, n)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN kept USING (vec_id, n), hash"""



def _secret_sql() -> str:
    """Places by what precedes a match; entropy of every window from the counts of its characters."""
    cases = lambda p: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in p)
    keys = "|".join(map(cases, ("password", "passwd", "secret", "token", "api_?key")))
    tail = BASE[0][1].split("))", 1)[1].replace("'", "''")
    patterns = (f"({keys}){tail}", BASE[1][1], BASE[2][1])
    tests = tuple(
        f"length(regexp_extract(v, '{p}', {group})) >= {least}" if group else f"length(v) >= {least}"
        for p, (_, _, group, least) in zip(patterns, BASE)
    )

    def found(pattern: str) -> str:
        return f"""
            SELECT rn, doc_id, v, gap + list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT AS s
            FROM (SELECT rn, doc_id, g, vs, unnest(vs) AS v, unnest(range(1, len(vs) + 1)) AS i
                  FROM (SELECT rn, doc_id, regexp_split_to_array(text, '{pattern}') AS g, regexp_extract_all(text, '{pattern}', 0) AS vs FROM docs)) AS m,
                 LATERAL (SELECT coalesce(list_sum(list_transform(vs[1:i - 1], lambda x: length(x))), 0) AS gap) AS l"""

    base = " UNION ALL ".join(
        f"SELECT rn, doc_id, {k} AS kind, s, s + length(v) AS e FROM ({found(p)}) WHERE {t}" for k, (p, t) in enumerate(zip(patterns, tests))
    )
    allow = " OR ".join("regexp_matches(v, '" + a.replace("(?i:", "(?i)(") + "')" for a in ALLOWED)
    classes = ", ".join(f"('[{c.alphabet.replace('-', '')}{'-' if '-' in c.alphabet else ''}]{{{WINDOW}}}', {most(WINDOW, c.least)})" for c in CLASSES)
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    said = f"string_agg({names}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind, e)"
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text FROM documents),
        base AS ({base}),
        candidates AS (
            SELECT * FROM ({found("[A-Za-z0-9+/_-]{24,}")}) WHERE regexp_matches(v, '{MIXED}') AND NOT ({allow})),
        windows AS (
            SELECT rn, doc_id, s + w AS s, substr(v, w + 1, {WINDOW}) AS v
            FROM (SELECT *, unnest(range(length(v) - {WINDOW - 1})) AS w FROM candidates)),
        hot AS (
            SELECT DISTINCT rn, doc_id, s FROM windows, (VALUES {classes}) AS c(p, most)
            WHERE regexp_full_match(v, p)
              AND list_sum(list_transform(list_transform(list_distinct(string_split(v, '')), lambda c: length(v) - length(replace(v, c, ''))), lambda n: {weights(WINDOW)}[n + 1])) <= most),
        chained AS (
            SELECT *, sum(fresh) OVER (PARTITION BY rn ORDER BY s) AS chain
            FROM (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY rn ORDER BY s) <= {WINDOW} THEN 0 ELSE 1 END AS fresh FROM hot)),
        spans AS (SELECT rn, doc_id, {len(BASE)} AS kind, min(s) AS s, max(s) + {WINDOW} AS e FROM chained GROUP BY rn, doc_id, chain),
        every AS (
            SELECT * FROM base UNION ALL
            SELECT * FROM spans x WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rn = x.rn AND b.s < x.e AND x.s < b.e)),
        told AS (
            SELECT rn, {", ".join(f"count(*) FILTER (kind = {k}) AS n_{n}" for k, (n, *_) in enumerate(BASE))},
                   {said} FILTER (kind < {len(BASE)}) AS base, {said} AS spans
            FROM every GROUP BY rn)
        SELECT doc_id, {", ".join(f"coalesce(n_{n}, 0) AS n_{n}" for n, *_ in BASE)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN told USING (rn)"""


ORACLE = {
    "op3_substring_dedup": f"""
        WITH docs AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[' || {_SPACE} || ']+'), lambda w: w <> '') AS ws
            FROM documents),
        windows AS (
            SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS h
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM docs)),
        earlier AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
            FROM windows JOIN earlier USING (h) WHERE first_id < doc_id),
        words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM docs),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS t
            FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)""",
    "op6_chat_formatting": r"""
        WITH rows_ AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        escaped AS (
            SELECT *,
                regexp_replace(regexp_replace(replace(role, '\', '\\'), '<(\||/?s>|</?SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g') AS r,
                regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(\||/?s>|</?SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g') AS t
            FROM rows_)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(r) + length(t) + 33)::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id""",
    "op8_line_dedup": f"""
        WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p FROM docs),
        keyed AS (
            SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
        repeated AS (
            SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
            GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS t
            FROM keyed LEFT JOIN repeated USING (k) WHERE keeper IS NULL OR keeper = doc_id GROUP BY doc_id)
        SELECT doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - coalesce(n, 0))::BIGINT AS n_dropped,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)""",
    "op9_exact_topk": """
        WITH codes AS (
            SELECT vec_id,
                list_sum(list_transform(embedding[1:64], lambda x, i: CASE WHEN x > 0 THEN 1::HUGEINT << (i - 1)::HUGEINT ELSE 0::HUGEINT END))::HUGEINT AS code
            FROM embeddings),
        near AS (
            SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id, bit_count(xor(q.code, c.code))::INTEGER AS distance
            FROM codes q JOIN codes c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id))::INTEGER AS rank,
               neighbor_id, distance
        FROM near QUALIFY rank <= 10""",
    # A parse from left to right, one row a step: per state the least cost and audit so far.
    "op11_conversation_repair": f"""
        WITH RECURSIVE crc AS (
            SELECT list(list_reduce([n] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
                        ORDER BY n) AS t
            FROM range(256) AS r(n)),
        named AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
            FROM conversations),
        hashed AS (
            SELECT *, xor(4294967295, list_reduce(
                       [4294967295] || list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT),
                       lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS kind
            FROM named, crc),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM hashed WHERE kind <> 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
                   trim(text, {_SPACE}) AS bare, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE '' END AS l
            FROM damaged),
        faulty AS (
            SELECT *, CASE WHEN bare = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
                   lag(l) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM ranked),
        stats AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                   count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                   count(*) FILTER (fault = 't') AS truncated,
                   count(*) FILTER (i > 1 AND before || l NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
            FROM faulty GROUP BY conv_id),
        steps(p, l, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
        inserts(p, q, c, a, said) AS (
            VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
                (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']),
                (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])),
        edits AS (
            SELECT conv_id, i, p, q, c + CASE WHEN fault = 't' AND a <> 'D' THEN 1 ELSE 0 END AS c, a, said
            FROM (
                SELECT conv_id, i, fault, p, p AS q, 3 AS c, 'D' AS a, [] AS said FROM faulty, range(4) AS s(p)
                UNION ALL
                SELECT conv_id, i, fault, p, q, 0, 'K', [role || ':' || text] FROM faulty JOIN steps USING (l) WHERE fault NOT IN ('b', 'd')
                UNION ALL
                SELECT conv_id, i, fault, p, q, 2, 'R', [CASE s.l WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text]
                FROM faulty JOIN steps s ON s.l <> 's' AND fault NOT IN ('b', 'd'))),
        moves AS (
            SELECT conv_id, i, x.p, e.q, x.c + e.c AS c, x.a || e.a AS a, x.said || e.said AS said
            FROM inserts x JOIN edits e ON x.q = e.p
            QUALIFY row_number() OVER (PARTITION BY conv_id, i, x.p, e.q ORDER BY x.c + e.c, x.a || e.a) = 1),
        walk AS (
            SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS c, '' AS a, []::VARCHAR[] AS said FROM stats
            UNION ALL
            SELECT w.conv_id, m.i, m.q, w.c + m.c, w.a || m.a, w.said || m.said
            FROM walk w JOIN moves m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = w.i + 1 AND m.p = w.q
            QUALIFY row_number() OVER (PARTITION BY w.conv_id, m.i, m.q ORDER BY w.c + m.c, w.a || m.a) = 1),
        finished AS (
            SELECT w.conv_id, w.c + x.c AS cost, w.a || x.a AS audit, w.said || x.said AS said
            FROM walk w JOIN stats s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.i = s.n
            JOIN inserts x ON x.p = w.q AND x.q IN (0, 3)
            QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.c + x.c, w.a || x.a) = 1)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
               coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN stats s ON o.conv_id IS NOT DISTINCT FROM s.conv_id
        LEFT JOIN finished f ON o.conv_id IS NOT DISTINCT FROM f.conv_id""",
    "op12_vector_codes": _codebook_sql(),
    "op13_secret_scan": _secret_sql(),
}
