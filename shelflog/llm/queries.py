"""Registered queries of the operators for training data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflog.llm import (
    credentials,
    decontaminate,
    exact,
    filter_audit,
    jaccard,
    language,
    merkle,
    mixing,
    near,
    quality,
    substring_dedup,
    suffix_dedup,
    tokens,
)
from shelflog.llm.common import read_table
from shelflog.llm.training import remainder

Query = Callable[[SparkSession, str], DataFrame]


LANGUAGE_FOLDS, QUALITY_FOLDS = 4, 5
QUALITY_LEAST = 0.3


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, read_table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_later_repeats(read_table(spark, sf_dir, "documents")))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(read_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.scan_secrets(read_table(spark, sf_dir, "documents")))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.col("mix.epoch").alias("epoch"), F.col("mix.block").alias("block"), F.col("mix.turn").alias("turn"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_classes(read_table(spark, sf_dir, "documents")).drop("text_key")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder("doc_id", LANGUAGE_FOLDS) == 2, F.lit(True))
    model = language.fit_language(docs.where(~held_out))
    found = language.identify_language(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score")
    )


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.QualityModel:
    """Fit on the labels outside the held-out fold."""
    return quality.fit_quality(docs, labels.where(remainder("doc_id", QUALITY_FOLDS) != 0))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, quality_model(docs, read_table(spark, sf_dir, "labels")))
    held_out = F.coalesce(remainder("doc_id", QUALITY_FOLDS) == 0, F.lit(True))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted")
    )


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    manifest = tokens.write_tokens(docs, tokens.token_path(spark), tokenizer_file())
    return tokens.read_tokens(manifest)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(read_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.shingle_components(read_table(spark, sf_dir, "documents"))


def registered() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_suffix_dedup,
            op2_benchmark_decontamination,
            op3_substring_dedup,
            op4_exact_dedup,
            op5_source_mix,
            op6_secret_scan,
            op7_near_dedup,
            op8_language_id,
            op9_quality,
            op10_token_output,
            op11_merkle_manifest,
            op12_filter_audit,
            op13_jaccard_join,
        )
    }


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP2_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size,
        array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS key
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (
    SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS key
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, p.size, item_id FROM places p JOIN windows USING (size, key)),
words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM hits))
    GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS key
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) AS nth FROM places)
    WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
    SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS kept
    FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id),
removed AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _fields(text: str) -> str:
    values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return " || ".join(f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in values)


# CRC-32 bit by bit: eight steps a byte over the decimal digits.
_CRC_STEP = "list_reduce([c] || range(8), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)"
OP11_SQL = f"""
WITH RECURSIVE crc AS (
    SELECT doc_id, CAST(doc_id AS VARCHAR) AS digits, 0 AS pos, CAST(4294967295 AS BIGINT) AS c FROM documents
    UNION ALL
    SELECT doc_id, digits, pos + 1, {_CRC_STEP.replace("[c]", "[xor(c, CAST(ascii(substr(digits, pos + 1, 1)) AS BIGINT))]")}
    FROM crc WHERE pos < length(digits)),
chosen AS (SELECT DISTINCT doc_id FROM crc WHERE pos = length(digits) AND xor(c, 4294967295) % 5 = 0),
leaves AS (
    SELECT doc_id, source, sha256({_fields("text")}) AS leaf,
        CASE WHEN doc_id IN (SELECT doc_id FROM chosen) THEN sha256({_fields(_LOWER.format("text"))}) END AS tampered,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
    FROM documents),
low AS (
    SELECT source, 0 AS level, idx, n, leaf AS digest FROM leaves
    UNION ALL
    SELECT source, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM low WHERE n > 1 GROUP BY source, level, idx // 16, n),
subroots AS (
    SELECT source, digest, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
    FROM low WHERE n = 1),
high AS (
    SELECT 0 AS level, idx, n, digest FROM subroots
    UNION ALL
    SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
    FROM high WHERE n > 1 GROUP BY level, idx // 16, n),
steps AS (
    SELECT l.doc_id, l.source, low.level AS step,
        coalesce(string_agg(low.digest, '' ORDER BY low.idx) FILTER (low.idx < l.idx // (16 ** low.level)::BIGINT), '') AS lft,
        coalesce(string_agg(low.digest, '' ORDER BY low.idx) FILTER (low.idx > l.idx // (16 ** low.level)::BIGINT), '') AS rgt
    FROM leaves l JOIN low ON l.source IS NOT DISTINCT FROM low.source AND low.n > 1
        AND low.idx // 16 = l.idx // (16 ** (low.level + 1))::BIGINT
    GROUP BY l.doc_id, l.source, l.idx, low.level),
top_steps AS (
    SELECT s.source, s.height + high.level AS step,
        coalesce(string_agg(high.digest, '' ORDER BY high.idx) FILTER (high.idx < s.idx // (16 ** high.level)::BIGINT), '') AS lft,
        coalesce(string_agg(high.digest, '' ORDER BY high.idx) FILTER (high.idx > s.idx // (16 ** high.level)::BIGINT), '') AS rgt
    FROM subroots s JOIN high ON high.n > 1 AND high.idx // 16 = s.idx // (16 ** (high.level + 1))::BIGINT
    GROUP BY s.source, s.idx, s.height, high.level),
path AS (
    SELECT doc_id, step, lft, rgt FROM steps
    UNION ALL
    SELECT l.doc_id, t.step, t.lft, t.rgt FROM leaves l JOIN top_steps t ON l.source IS NOT DISTINCT FROM t.source),
proofs AS (SELECT doc_id, sha256(string_agg(lft || rgt, '' ORDER BY step)) AS proof, count(*) AS length FROM path GROUP BY doc_id),
fold AS (
    SELECT doc_id, 0 AS step, coalesce(tampered, leaf) AS digest FROM leaves
    UNION ALL
    SELECT f.doc_id, f.step + 1, sha256(p.lft || f.digest || p.rgt) FROM fold f JOIN path p ON f.doc_id = p.doc_id AND f.step = p.step),
top AS (SELECT digest AS root FROM high WHERE n = 1)
SELECT l.doc_id, l.leaf, s.digest AS subroot, root, coalesce(p.proof, sha256('')) AS proof_sha256,
    f.digest AS folded_root, f.digest = root AS verified
FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source CROSS JOIN top
    LEFT JOIN proofs p ON l.doc_id = p.doc_id
    JOIN fold f ON f.doc_id = l.doc_id AND f.step = coalesce(p.length, 0)
"""

OP12_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
fails AS (
    SELECT d.part, coalesce(l.quality = 1, FALSE) AS good, coalesce(l.toxic = 1, FALSE) AS toxic,
        [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
         regexp_matches(text, '[#$%&*|]'), doc_id > min(doc_id) OVER (PARTITION BY text)] AS f
    FROM d LEFT JOIN labels l USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS a, unnest(range(1, 6)) AS i),
orders AS (
    SELECT v.a || w.a || x.a || y.a || z.a AS filter_order, [v.i, w.i, x.i, y.i, z.i] AS o
    FROM letters v, letters w, letters x, letters y, letters z
    WHERE len(list_distinct([v.i, w.i, x.i, y.i, z.i])) = 5),
grid AS (SELECT part, filter_order, o, step FROM (SELECT DISTINCT part FROM d), orders, range(1, 6) t(step)),
played AS (
    SELECT part, good, toxic, f, filter_order, o, coalesce(list_position(list_transform(o, lambda i: f[i]), TRUE), 6) AS gone
    FROM fails, orders),
totals AS (
    SELECT g.part, g.filter_order, g.step, g.o[g.step] AS filter,
        count(*) FILTER (p.gone > g.step) AS kept,
        count(*) FILTER (p.gone = g.step) AS removed,
        count(*) FILTER (p.gone < g.step AND p.f[g.o[g.step]]) AS redundant,
        count(*) FILTER (p.f[g.o[g.step]] AND len(list_filter(p.f, lambda x: x)) = 1) AS unique_fails,
        count(*) FILTER (p.gone = g.step AND p.good) AS good_lost,
        count(*) FILTER (p.gone = g.step AND p.toxic) AS toxic_lost
    FROM grid g JOIN played p USING (part, filter_order) GROUP BY g.part, g.filter_order, g.step, g.o)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM totals
"""

OP13_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(4, len(w)) - 1), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY x, y),
links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
reached AS (
    SELECT doc_id, doc_id AS other FROM d
    UNION
    SELECT r.doc_id, l.y FROM reached r JOIN links l ON r.other = l.x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_benchmark_decontamination": OP2_SQL,
        "op3_substring_dedup": OP3_SQL,
        "op4_exact_dedup": OP4_SQL,
        "op11_merkle_manifest": OP11_SQL,
        "op12_filter_audit": OP12_SQL,
        "op13_jaccard_join": OP13_SQL,
    }
