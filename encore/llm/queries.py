"""The operators of this subpackage as queries on the test tables, whole tables each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import chosen_path
from encore.llm.centroids import cluster
from encore.llm.common import table
from encore.llm.decontaminate import matches
from encore.llm.hnsw import nearest_neighbours
from encore.llm.language import identify
from encore.llm.line_dedup import dedup_lines
from encore.llm.merkle import manifest
from encore.llm.ngram_join import near_duplicates
from encore.llm.pii import personal_data
from encore.llm.quality import score_quality
from encore.llm.source_mix import mix_sources
from encore.llm.suffixes import repeated_passages
from encore.llm.toxicity import score_toxicity


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        F.col("line_count").alias("n_lines"),
        F.col("lines_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(documents, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(documents, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def op13_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_hnsw, op2_ngram_join, op3_line_dedup, op4_source_mix, op5_suffix_array, op6_language, op7_toxicity, op8_pii, op9_quality,
        op10_decontaminate, op11_merkle, op12_centroids, op13_chosen_path,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SHINGLES = f"""
    SELECT {{id}} AS id, unnest(list_distinct(CASE
        WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
        ELSE [] END)) AS shingle
    FROM (SELECT {{id}}, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w
          FROM {{table}})"""

_LEAF = " || ".join(
    f"coalesce(strlen({v}::VARCHAR) || ':' || {v}, '-')" for v in ("doc_id", "source", "lang", "n_chars", "{text}")
)
# The remainder of each byte, bit by bit; 3988292384 is the reversed polynomial of CRC-32.
_CRC32 = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda r, bit: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)))"""


def _merkle_levels(name: str, leaves: str) -> str:
    """(level, tree, place, n, digest) from leaves of the same columns, sixteen to one."""
    return f"""{name} AS (
    SELECT 0 AS level, tree, place, n, digest FROM {leaves}
    UNION ALL
    SELECT level + 1, tree, place // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
    FROM {name} WHERE n > 1 GROUP BY level, tree, place // 16, (n + 15) // 16)"""


def _merkle_sides(name: str, levels: str) -> str:
    """(level, tree, place, left_side, right_side) of all nodes that have a parent."""
    side = "coalesce(string_agg(digest, '') OVER (PARTITION BY level, tree, place // 16 ORDER BY place ROWS BETWEEN {}), '')"
    return f"""{name} AS MATERIALIZED (
    SELECT level, tree, place, {side.format("UNBOUNDED PRECEDING AND 1 PRECEDING")} AS left_side,
           {side.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")} AS right_side
    FROM {levels} WHERE n > 1)"""


_COMPONENTS = "range(1, 65)"
_AWAY = f"list_sum(list_transform({_COMPONENTS}, lambda i: (v.vector[i] - c.middle[i]) * (v.vector[i] - c.middle[i])))::BIGINT"


def _assignment(n: int) -> str:
    """Each vector's nearest of the centroids of round ``n``."""
    return f"""own{n} AS MATERIALIZED (
    SELECT row, arg_min(cluster, (away, cluster)) AS cluster, min(away) AS distance
    FROM (SELECT v.row, c.cluster, {_AWAY} AS away FROM vec v, middle{n} c) GROUP BY row)"""


def _centroids(n: int) -> str:
    """The centroids after round ``n``; the remainder is taken so that it is never negative."""
    return f"""middle{n + 1} AS MATERIALIZED (
    SELECT m.cluster, coalesce(f.middle, m.middle) AS middle FROM middle{n} m LEFT JOIN (
        SELECT cluster, list(((total - (total % n + n) % n) // n)::BIGINT ORDER BY i) AS middle
        FROM (SELECT o.cluster, i, sum(v.vector[i]) AS total, count(*) AS n
              FROM own{n} o JOIN vec v ON v.row = o.row, unnest({_COMPONENTS}) AS u(i) GROUP BY o.cluster, i)
        GROUP BY cluster) f ON f.cluster = m.cluster)"""


def _near_duplicates(percent: int) -> str:
    """The documents with the smallest doc_id reachable by links of at least so many percent."""
    return f"""WITH RECURSIVE doc AS MATERIALIZED ({_SHINGLES.format(id="doc_id", table="documents")}),
size AS (SELECT id, count(*) AS n FROM doc GROUP BY id),
link AS MATERIALIZED (
    SELECT a.id AS one, b.id AS two FROM doc a JOIN doc b USING (shingle)
    JOIN size s ON s.id = a.id JOIN size t ON t.id = b.id
    WHERE a.id <> b.id
    GROUP BY a.id, b.id, s.n, t.n HAVING 100 * count(*) >= {percent} * (s.n + t.n - count(*))),
reach AS (
    SELECT doc_id AS id, doc_id AS to_id FROM documents
    UNION SELECT reach.id, link.two FROM reach JOIN link ON link.one = reach.to_id)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN size ON size.id = d.doc_id
JOIN (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id) r ON r.id = d.doc_id"""


def _closing(n: int) -> str:
    """The documents that would close the gaps after ``n`` more draws, best first, and what is then missed."""
    return f"""gap{n} AS (
    SELECT source, max(rest) - coalesce(sum(size) FILTER (sampled), 0) AS gap FROM drawn{n} WHERE q IS NOT NULL GROUP BY source),
closing{n} AS MATERIALIZED (
    SELECT d.doc_id, d.source, d.size, d.repeat, abs(d.size - gap) AS miss,
           row_number() OVER (PARTITION BY d.source ORDER BY abs(d.size - gap), q, d.doc_id, d.size, d.repeat) AS place
    FROM drawn{n} d JOIN gap{n} g ON g.source IS NOT DISTINCT FROM d.source
    WHERE NOT sampled AND q IS NOT NULL AND abs(d.size - gap) < gap),
miss{n} AS (
    SELECT g.source, coalesce(c.miss, g.gap) AS miss
    FROM gap{n} g LEFT JOIN closing{n} c ON c.place = 1 AND c.source IS NOT DISTINCT FROM g.source),
"""


def _refill(n: int) -> str:
    """Another draw among the documents that fit into what is left."""
    return f"""drawn{n + 1} AS MATERIALIZED (
    SELECT * EXCLUDE (sampled, left_over, fits),
           sampled OR (fits AND sum(CASE WHEN fits THEN size ELSE 0 END) OVER (
               PARTITION BY source ORDER BY q NULLS LAST, doc_id, repeat, size ROWS UNBOUNDED PRECEDING) <= left_over) AS sampled
    FROM (SELECT *, rest - coalesce(sum(size) FILTER (sampled) OVER (PARTITION BY source), 0) AS left_over,
                 q IS NOT NULL AND NOT sampled AND size <= left_over AS fits FROM drawn{n})),
"""


SQL: dict[str, str] = {
    "op12_centroids": f"""
WITH vec AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
middle0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, vector AS middle
    FROM vec ORDER BY sha256('2:' || vec_id) LIMIT 40),
{", ".join(f"{_assignment(n)}, {_centroids(n)}" for n in range(5))},
{_assignment(5)}
SELECT v.vec_id, o.cluster::INTEGER AS cluster, o.distance,
       (sum(o.distance) OVER (PARTITION BY o.cluster))::BIGINT AS cluster_inertia, (sum(o.distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.middle, ',')) AS centroid_sha256
FROM own5 o JOIN vec v ON v.row = o.row JOIN middle5 c ON c.cluster = o.cluster""",
    "op11_merkle": f"""
WITH RECURSIVE hashed AS MATERIALIZED (
    SELECT doc_id, source, sha256({_LEAF.format(text="text")}) AS leaf,
           CASE WHEN {_CRC32} % 5 = 0
                THEN sha256({_LEAF.format(text=_LOWER.format("text"))}) END AS changed
    FROM documents),
row_of AS MATERIALIZED (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY source) AS n, leaf AS digest FROM hashed),
{_merkle_levels("node", "row_of")},
top AS MATERIALIZED (
    SELECT 0 AS tree, tree AS place, count(*) OVER () AS n, digest FROM node WHERE n = 1),
{_merkle_levels("top_node", "top")},
{_merkle_sides("side", "node")},
{_merkle_sides("top_side", "top_node")},
climb AS (
    SELECT tree, place, 0 AS level, false AS at_top, place AS at, coalesce(changed, leaf) AS digest, '' AS proof FROM row_of
    UNION ALL
    SELECT c.tree, c.place, CASE WHEN s.level IS NULL AND NOT c.at_top THEN 0 ELSE c.level + 1 END,
           c.at_top OR s.level IS NULL,
           CASE WHEN s.level IS NULL AND NOT c.at_top THEN c.tree ELSE c.at // 16 END,
           CASE WHEN s.level IS NULL AND NOT c.at_top THEN c.digest
                ELSE sha256(coalesce(s.left_side, t.left_side) || c.digest || coalesce(s.right_side, t.right_side)) END,
           c.proof || coalesce(s.left_side || s.right_side, t.left_side || t.right_side, '')
    FROM climb c
    LEFT JOIN side s ON NOT c.at_top AND s.level = c.level AND s.tree = c.tree AND s.place = c.at
    LEFT JOIN top_side t ON c.at_top AND t.level = c.level AND t.place = c.at
    WHERE NOT c.at_top OR t.level IS NOT NULL),
reached AS (
    SELECT tree, place, arg_max(digest, length(proof) * 100 + level) AS folded_root,
           arg_max(proof, length(proof) * 100 + level) AS proof
    FROM climb WHERE at_top GROUP BY tree, place)
SELECT r.doc_id, r.leaf, t.digest AS subroot, last.digest AS root, sha256(reached.proof) AS proof_sha256,
       reached.folded_root, reached.folded_root = last.digest AS verified
FROM row_of r JOIN top t ON t.place = r.tree JOIN top_node last ON last.n = 1
JOIN reached ON reached.tree = r.tree AND reached.place = r.place""",
    "op2_ngram_join": _near_duplicates(75),
    "op13_chosen_path": f"SELECT *, coalesce(doc_id = component_id, true) AS kept FROM ({_near_duplicates(85)})",
    "op3_line_dedup": f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split),
keyed AS (
    SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM line),
repeated AS (
    SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
    SELECT k.*, coalesce(k.doc_id <> r.keeper, false) AS gone FROM keyed k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op4_source_mix": """
WITH doc AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) AS repeat FROM doc),
named AS (
    SELECT source, sum(size)::BIGINT AS source_size, count(*) FILTER (size > 0) AS n_docs,
           1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
    FROM doc GROUP BY source),
filling AS (
    SELECT *, 3 * source_size AS cap,
           sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
               ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
           sum(weight) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
           row_number() OVER (ORDER BY 3 * source_size / weight, source) AS turn
    FROM named),
water AS (
    SELECT arg_min(left_over::DOUBLE / open_weight, turn)
               FILTER (weight * (left_over::DOUBLE / open_weight) <= cap) AS level FROM filling),
aim AS (
    SELECT *, least(weight * level, cap::DOUBLE) AS target FROM filling, water),
plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio, floor(ratio)::BIGINT AS certain,
           target - certain * source_size AS rest, ratio - certain AS fraction FROM aim),
odds AS (
    SELECT d.*, p.source_size, p.target, p.certain, p.rest,
           (('0x' || substr(md5(concat_ws('|', '1', coalesce(d.doc_id::VARCHAR, ''), d.repeat)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
           p.fraction / (1 - p.fraction) * ((d.size * p.n_docs)::DOUBLE / nullif(p.source_size, 0)) AS inclusion,
           CASE WHEN inclusion > 0 THEN (u / (1 - u)) / inclusion END AS q
    FROM numbered d JOIN plan p ON p.source IS NOT DISTINCT FROM d.source),
drawn0 AS MATERIALIZED (
    SELECT *, q IS NOT NULL AND sum(size) FILTER (q IS NOT NULL) OVER (
        PARTITION BY source ORDER BY q NULLS LAST, doc_id, repeat, size ROWS UNBOUNDED PRECEDING) <= rest AS sampled
    FROM odds),
""" + "".join(_refill(n) for n in range(8)) + """""" + _closing(0) + _closing(8) + """best AS (
    SELECT a.source, b.miss < a.miss AS refilled FROM miss0 a JOIN miss8 b ON b.source IS NOT DISTINCT FROM a.source),
drawn AS (
    SELECT o.* EXCLUDE (sampled), CASE WHEN b.refilled THEN r.sampled ELSE o.sampled END AS sampled
    FROM drawn0 o JOIN drawn8 r ON r.doc_id IS NOT DISTINCT FROM o.doc_id AND r.source IS NOT DISTINCT FROM o.source
        AND r.size = o.size AND r.repeat = o.repeat
    LEFT JOIN best b ON b.source IS NOT DISTINCT FROM o.source),
closing AS (
    SELECT c.* FROM closing0 c JOIN best b ON b.source IS NOT DISTINCT FROM c.source WHERE NOT refilled
    UNION ALL
    SELECT c.* FROM closing8 c JOIN best b ON b.source IS NOT DISTINCT FROM c.source WHERE refilled)
SELECT d.doc_id, d.size, d.source_size, d.target,
       CASE WHEN d.size > 0 THEN (certain + (sampled OR c.place IS NOT NULL)::BIGINT) * d.size ELSE 0 END::BIGINT AS taken
FROM drawn d LEFT JOIN closing c ON c.place = 1 AND c.doc_id IS NOT DISTINCT FROM d.doc_id
    AND c.source IS NOT DISTINCT FROM d.source AND c.size = d.size AND c.repeat = d.repeat""",
    "op10_decontaminate": f"""
WITH doc AS ({_SHINGLES.format(id="doc_id", table="documents")}),
item AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
size AS (SELECT id, count(*) AS n_item FROM item GROUP BY id)
SELECT doc.id AS doc_id, item.id AS item_id, count(*) AS n_shared, n_item,
       count(*)::DOUBLE / n_item AS containment
FROM doc JOIN item USING (shingle) JOIN size ON size.id = item.id
GROUP BY doc.id, item.id, n_item HAVING 100 * count(*) >= 75 * n_item""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
