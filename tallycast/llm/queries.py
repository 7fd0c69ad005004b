"""The registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallycast.llm.common import read
from tallycast.llm.crf_extract import extract
from tallycast.llm.decontaminate import contained_items
from tallycast.llm.fingerprints import edited_fingerprints
from tallycast.llm.graph_search import neighbours
from tallycast.llm.jaccard_join import similar_groups
from tallycast.llm.lang_id import identify
from tallycast.llm.packing import pack
from tallycast.llm.pivot_codes import codes
from tallycast.llm.repeats import without_repeats
from tallycast.llm.secret_scan import report, scan
from tallycast.llm.url_filter import judge
from tallycast.llm.warc_zip import round_trip
from tallycast.llm.zone_clusters import clusters

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and of its edited text, and their likeness."""
    return edited_fingerprints(read(spark, sf_dir, "documents"))


def op2_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(read(spark, sf_dir, "pages"))


def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record in ZIP packages, read back by range."""
    return round_trip(read(spark, sf_dir, "pages")).drop("url")


def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 100-byte strings that also start earlier."""
    return without_repeats(read(spark, sf_dir, "documents")).drop("starts", "ends")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents by exact 4-word shingle likeness of 0.85 or more."""
    return similar_groups(read(spark, sf_dir, "documents"), n=4, percent=85)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by Kneser-Ney models of the training folds."""
    return identify(read(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of power-of-two length."""
    return pack(read(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judge(read(spark, sf_dir, "pages"), URL_RULES)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) of which the document holds 80 percent of the item's 5-word shingles."""
    return contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, by pattern and by randomness."""
    return report(scan(read(spark, sf_dir, "documents")))


def op11_pivot_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as four codebook entries, trained with pivot tables."""
    return codes(read(spark, sf_dir, "embeddings"))


def op12_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest embeddings to every 20th, by a graph per shard."""
    return neighbours(read(spark, sf_dir, "embeddings"))


def op13_zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty exact clusters of the embeddings, by zone maps over a Hilbert curve."""
    return clusters(read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_winnowing": op1_winnowing,
        "op2_html_crf": op2_html_crf,
        "op3_warc_zip": op3_warc_zip,
        "op4_suffix_repeats": op4_suffix_repeats,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_language_id": op6_language_id,
        "op7_packing": op7_packing,
        "op8_url_filter": op8_url_filter,
        "op9_decontamination": op9_decontamination,
        "op10_secret_scan": op10_secret_scan,
        "op11_pivot_codes": op11_pivot_codes,
        "op12_graph_search": op12_graph_search,
        "op13_zone_clusters": op13_zone_clusters,
    }


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SHINGLES = """
  {name}_words AS (SELECT {id} AS id, regexp_extract_all(translate(coalesce(text, ''), '""" + _UPPER + "', '" + _LOWER + """'), '{word}') AS w FROM {table}),
  {name} AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' ')) END) AS g FROM {name}_words)"""



_KEPT = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _codes_sql(parts: int = 4, k: int = 256, rounds: int = 4, width: int = 16) -> str:
    """Product codes by comparing every part with every entry, one table per round."""
    ctes = [f"""
  v AS MATERIALIZED (SELECT vec_id, label, (pos - 1) // {width} AS part, (pos - 1) % {width} AS pos, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings WHERE {_KEPT}) t),
  c0 AS MATERIALIZED (SELECT part, entry, pos, x FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM embeddings WHERE {_KEPT}) f USING (vec_id) WHERE entry < {k})"""]
    for r in range(rounds + 1):
        ctes.append(f"""
  d{r} AS MATERIALIZED (SELECT vec_id, part, entry, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN c{r} c USING (part, pos) GROUP BY ALL),
  a{r} AS MATERIALIZED (SELECT vec_id, part, min(entry) AS entry, min(d) AS d FROM d{r} JOIN (SELECT vec_id, part, min(d) AS d FROM d{r} GROUP BY ALL) m USING (vec_id, part, d) GROUP BY ALL)""")
        if r < rounds:
            ctes.append(f"""
  m{r} AS (SELECT part, a.entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{r} a USING (vec_id, part) GROUP BY ALL),
  c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, c.pos, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{r} c LEFT JOIN m{r} m USING (part, entry, pos))""")
    return "WITH" + ",".join(ctes) + f""",
  e AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT e.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
FROM e JOIN embeddings USING (vec_id)"""


def _clusters_sql(k: int = 40, rounds: int = 5) -> str:
    """Clusters by comparing every vector with every centroid, one table per round."""
    ctes = [f"""
  v AS MATERIALIZED (SELECT vec_id, pos, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings WHERE {_KEPT} AND len(embedding) = 64) t),
  c0 AS MATERIALIZED (SELECT entry, pos, x FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS entry FROM embeddings
    WHERE {_KEPT} AND len(embedding) = 64) f USING (vec_id) WHERE entry < {k})"""]
    for r in range(rounds + 1):
        ctes.append(f"""
  d{r} AS MATERIALIZED (SELECT vec_id, entry, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN c{r} c USING (pos) GROUP BY ALL),
  a{r} AS MATERIALIZED (SELECT vec_id, min(entry) AS entry, min(d) AS d FROM d{r} JOIN (SELECT vec_id, min(d) AS d FROM d{r} GROUP BY ALL) m USING (vec_id, d) GROUP BY ALL)""")
        if r < rounds:
            ctes.append(f"""
  m{r} AS (SELECT a.entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{r} a USING (vec_id) GROUP BY ALL),
  c{r + 1} AS MATERIALIZED (SELECT c.entry, c.pos, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{r} c LEFT JOIN m{r} m USING (entry, pos))""")
    return "WITH" + ",".join(ctes) + f"""
SELECT vec_id, CAST(entry AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY entry) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT entry, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY entry) h USING (entry)"""


def oracle_sql() -> dict[str, str]:
    spaces = r"[^\x20\x09-\x0D]+"
    alnum = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    sets = _SHINGLES.format(name="s", id="doc_id", table="documents", n=4, word=spaces)
    return {
        "op3_warc_zip": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
  d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
  f AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM f""",
        "op5_jaccard_join": f"""
WITH RECURSIVE {sets},
  sizes AS (SELECT id, count(*) AS n FROM s GROUP BY id),
  pairs AS (SELECT a.id AS u, b.id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id GROUP BY ALL),
  links AS (SELECT u, v FROM pairs JOIN sizes x ON x.id = u JOIN sizes y ON y.id = v WHERE 100 * k >= 85 * (x.n + y.n - k)),
  reach AS (SELECT id AS node, id AS seen FROM sizes UNION SELECT l.v, r.seen FROM reach r JOIN links l ON l.u = r.node WHERE r.seen < l.v)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(m, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.id = d.doc_id LEFT JOIN (SELECT node, min(seen) AS m FROM reach GROUP BY node) c ON c.node = d.doc_id""",
        "op9_decontamination": f"""
WITH {_SHINGLES.format(name="q", id="item_id", table="benchmark", n=5, word=alnum)},
  {_SHINGLES.format(name="d", id="doc_id", table="documents", n=5, word=alnum)},
  sizes AS (SELECT id, count(*) AS n FROM q GROUP BY id)
SELECT d.id AS doc_id, q.id AS item_id, any_value(n) AS item_shingles, count(*) AS shared, count(*) / any_value(n) AS containment
FROM q JOIN d ON q.g = d.g JOIN sizes ON sizes.id = q.id GROUP BY d.id, q.id HAVING 100 * count(*) >= 80 * any_value(n)""",
        "op11_pivot_codes": _codes_sql(),
        "op13_zone_clusters": _clusters_sql(),
    }
