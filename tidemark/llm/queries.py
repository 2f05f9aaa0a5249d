"""Registered queries of the corpus operators, and SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ball_kmeans, chat, content_sort, decontaminate, html_tree, jaccard, license_scan, mixing, nbsvm, pitman_yor,
               prefix_trie, token_coder, warc)

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
     f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
           FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f""")
def op1_warc_index_merge(spark: SparkSession, sf: str) -> DataFrame:
    """`pages` has no capture time: page n counts as captured n seconds after a fixed instant."""
    pages = table(spark, sf, "pages")
    index = warc.archive_and_index(pages, seconds=F.lit(1_700_000_000) + F.col("page_id"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op2_content_sort(spark: SparkSession, sf: str) -> DataFrame:
    return content_sort.content_sort(table(spark, sf, "documents"))


@query("""
WITH RECURSIVE s AS (SELECT source, sum(length(coalesce(text, ''))) AS size FROM documents GROUP BY source),
t AS (SELECT source, size, sum(size) OVER () AS all_size, sum(sqrt(size)) OVER () AS all_weight FROM s),
r AS (SELECT source, CASE WHEN size > 0 THEN
        round(sqrt(CAST(size AS DOUBLE)) / all_weight * CAST(all_size AS DOUBLE) / CAST(size AS DOUBLE), 9)
        ELSE 0.0 END AS mean FROM t),
k AS (SELECT source, mean, 0 AS j, exp(-mean) AS p, exp(-mean) AS c FROM r WHERE mean > 0
      UNION ALL SELECT source, mean, j + 1, p * mean / (j + 1), c + p * mean / (j + 1) FROM k
      WHERE j < mean + 12 * sqrt(mean) + 24),
d AS (SELECT documents.*, CAST(('0x' || substr(md5('17|' || doc_id || '|0'), 1, 13)) AS BIGINT) / 4503599627370496.0
        AS u FROM documents),
n AS (SELECT doc_id, d.source, n_chars, text, CAST(count(*) FILTER (c <= u) AS INTEGER) AS n_copies
      FROM d JOIN k ON d.source = k.source GROUP BY ALL),
e AS (SELECT *, unnest(range(1, n_copies + 1)) AS i FROM n WHERE n_copies > 0)
SELECT doc_id, source, n_chars, text, n_copies, CAST(i AS INTEGER) AS copy,
       CAST(('0x' || substr(md5('17 order|' || doc_id || '|' || i), 1, 13)) AS BIGINT) AS shuffle_key FROM e""")
def op3_poisson_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """The whole corpus brought to temperature 2 over its sources, in random order."""
    mixed = mixing.mix_to_targets(table(spark, sf, "documents"))
    return mixed.select("doc.doc_id", "doc.source", "doc.n_chars", "doc.text", "n_copies", "copy", "shuffle_key")


@query(r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(replace(replace(replace(text, '\', '\\'), '<', '\<'), '[', '\[')) AS esc,
             length(replace(replace(replace(role, '\', '\\'), '<', '\<'), '[', '\[')) AS role_esc FROM c),
s AS (SELECT *, sum(9 + role_esc + 7 + esc + 4) OVER (PARTITION BY conv_id ORDER BY turn, role, text
                                                      ROWS UNBOUNDED PRECEDING) AS so_far,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS is_last FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(so_far) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id""")
def op4_prefix_target_chat(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.prefix_examples(rows.unionByName(extra)))


@query(r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(lower(coalesce(text, '')),
        '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
        THEN [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE k * 5 >= 4 * (a.c + b.c - k)
      UNION SELECT a.doc_id, b.doc_id FROM d a JOIN d b ON a.t = b.t AND a.doc_id <> b.doc_id),
r AS (SELECT doc_id, doc_id AS z FROM d UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.z)
SELECT doc_id, (SELECT min(z) FROM r WHERE r.doc_id = d.doc_id) AS class_id,
       (SELECT count(*) FROM l WHERE l.x = d.doc_id) AS n_links,
       min(doc_id) OVER (PARTITION BY t) AS copy_id, count(*) OVER (PARTITION BY t) AS n_copies
FROM d""")
def op9_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "class_id", "n_links", "copy_id", "n_copies")


@query()
def op8_spaced_seed_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each document and benchmark item that share a passage."""
    return decontaminate.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query()
def op10_pitman_yor_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return pitman_yor.score_texts(table(spark, sf, "documents"))


@query()
def op6_nbsvm_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return nbsvm.score_quality(docs, nbsvm.train(docs, table(spark, sf, "labels")))


@query()
def op5_tree_scoring_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_tree.extract(table(spark, sf, "pages"))


@query()
def op7_context_mixing_ids(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    tokenizer = str(public_tokenizers.path("byte_bpe_50k.json"))
    return token_coder.write_and_read(table(spark, sf, "documents"), tokenizer, end_id=2)


@query()
def op11_diagonal_voting_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf, "documents"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds as one step after the other; a part's nearest entry is the least of distance * entries + index."""
    nearest = f"""SELECT x.vec_id, x.part, any_value(x.v) AS v, min(list_sum([(p[1] - p[2]) * (p[1] - p[2])
        FOR p IN list_zip(x.v, b.v)]) * {entries} + b.entry) AS best FROM x JOIN b{{0}} b ON b.part = x.part
        GROUP BY x.vec_id, x.part"""
    steps = [f"""k AS (SELECT vec_id, label, [CAST(floor(c * 4096.0) AS BIGINT) FOR c IN CAST(embedding AS DOUBLE[])] AS v,
        row_number() OVER (ORDER BY vec_id) - 1 AS place FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
             f"""x AS (SELECT vec_id, label, place, CAST(part AS BIGINT) AS part,
        v[CAST(part * len(v) // {parts} + 1 AS BIGINT):CAST((part + 1) * len(v) // {parts} AS BIGINT)] AS v
        FROM k, range({parts}) r(part))""",
             f"b0 AS (SELECT part, CAST(place AS BIGINT) AS entry, v FROM x WHERE place < {entries})"]
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({nearest.format(r)})")
        steps.append(f"""s{r} AS (SELECT part, CAST(best % {entries} AS BIGINT) AS entry, place, sum(c)::BIGINT AS total, count(*) AS n
        FROM (SELECT part, best, unnest(v) AS c, unnest(range(len(v))) AS place FROM a{r}) GROUP BY ALL)""")
        steps.append(f"""m{r} AS (SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY place) AS v FROM s{r}
        GROUP BY part, entry)""")
        steps.append(f"""b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{r} b
        LEFT JOIN m{r} m ON m.part = b.part AND m.entry = b.entry)""")
    return f"""WITH {", ".join(steps)}, z AS ({nearest.format(rounds)}),
    e AS (SELECT vec_id, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY part) AS code,
          CAST(sum(best // {entries}) AS BIGINT) AS error FROM z GROUP BY vec_id),
    h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
    SELECT e.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM e JOIN k ON k.vec_id = e.vec_id, h"""


@query(_codes_sql())
def op12_ball_kmeans_codes(spark: SparkSession, sf: str) -> DataFrame:
    return ball_kmeans.vector_codes(table(spark, sf, "embeddings"))


@query(r"""
WITH RECURSIVE t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
       FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS digits FROM t),
crc AS (SELECT c, digits, CAST(0 AS BIGINT) AS step, CAST(4294967295 AS BIGINT) AS v FROM ids
        UNION ALL
        SELECT c, digits, step + 1, CASE WHEN u % 2 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END
        FROM (SELECT c, digits, step, CASE WHEN step % 8 = 0 THEN xor(v, ascii(digits[step // 8 + 1])) ELSE v END AS u
              FROM crc WHERE step < 8 * length(digits))),
h AS (SELECT c, xor(v, 4294967295) % 4 AS h FROM crc WHERE step = 8 * length(digits)),
head AS (SELECT h.c, t.i AS d, t.role, t.text FROM h JOIN t ON t.c = h.c - h.c % 20 AND t.i <= h.h),
size AS (SELECT h.c, h.h, count(head.d) AS hp FROM h LEFT JOIN head ON head.c = h.c GROUP BY ALL),
r AS (SELECT * FROM head UNION ALL
      SELECT t.c, s.hp + t.i - s.h, t.role, t.text FROM t JOIN size s ON s.c = t.c WHERE t.i > s.h),
p AS (SELECT c, d, text, list(role || chr(1) || text || chr(2)) OVER (PARTITION BY c ORDER BY d) AS path FROM r
      UNION ALL SELECT c, 0, '', [] FROM ids),
last AS (SELECT c, max(d) AS d FROM p GROUP BY c),
n AS (SELECT p.d AS depth, path, min(p.c) AS conv_id, count(*) AS n_convs,
             len(regexp_extract_all(any_value(text), '[^ 	-]+')) AS words,
             sha256(coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (last.d = p.d), '')) AS ends_sha256
      FROM p JOIN last ON last.c = p.c GROUP BY p.d, path),
k AS (SELECT n.*, (SELECT count(*) FROM n m WHERE m.depth = n.depth + 1 AND m.path[1:n.depth] = n.path) AS n_children FROM n),
s AS (SELECT a.depth, a.path, CAST(count(*) FILTER (b.n_children = 0) AS BIGINT) AS n_leaves,
             CAST(sum((b.n_convs - 1) * b.words) AS BIGINT) AS saved_tokens
      FROM k a JOIN k b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path GROUP BY a.depth, a.path)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves,
       s.saved_tokens, k.ends_sha256
FROM k JOIN s ON s.depth = k.depth AND s.path = k.path
LEFT JOIN k u ON u.depth = k.depth - 1 AND u.path = k.path[1:u.depth]""")
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))
