"""The operators of this package over their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from fleetworks.llm import (
    bpe, centroids, chat, decontaminate, language, licenses, merkle, packing, sharding, simhash, substrings, surrogates, topk)

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_licenses(spark: SparkSession, root: str) -> DataFrame:
    """Licence phrases, labels and expressions of every whole text; odd rows as in ``licenses.scan_licenses``."""
    return licenses.scan_licenses(_table(spark, root, "documents"), keep=["doc_id"])


def op2_language(spark: SparkSession, root: str) -> DataFrame:
    """Predicted language of every whole text, learned from the rows that are not held out; odd rows as in ``language``."""
    docs = _table(spark, root, "documents")
    return language.identify(docs, language.fit(docs), keep=["doc_id"]).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op3_substrings(spark: SparkSession, root: str) -> DataFrame:
    """Words removed because they lie in a repeated window of 35; odd rows as in ``substrings.remove_repeated``."""
    return substrings.remove_repeated(_table(spark, root, "documents")).drop("kept")


def op4_sharding(spark: SparkSession, root: str) -> DataFrame:
    """Shard and slot of every document by its key; odd rows as in ``sharding.manifest``."""
    return sharding.manifest(_table(spark, root, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_surrogates(spark: SparkSession, root: str) -> DataFrame:
    """Every text with its personal data replaced; odd rows as in ``surrogates.anonymize``."""
    return surrogates.anonymize(_table(spark, root, "documents"), corpus_pipeline.SURROGATE_KEY, keep=["doc_id", "text"])


def op6_packing(spark: SparkSession, root: str) -> DataFrame:
    """Pieces of power-of-two lengths, each a sequence; odd rows as in ``packing.pack``."""
    return packing.pack(_table(spark, root, "documents"))


def op7_simhash(spark: SparkSession, root: str) -> DataFrame:
    """Fingerprint and component of every document; odd rows as in ``simhash.near_duplicates``."""
    return simhash.near_duplicates(_table(spark, root, "documents"))


def op8_top_products(spark: SparkSession, root: str) -> DataFrame:
    """Ten best vectors for every hundredth one; odd rows as in ``topk.top_products``."""
    vectors = _table(spark, root, "embeddings")
    return topk.top_products(vectors, vectors.where("vec_id % 100 = 0"))


def op9_decontamination(spark: SparkSession, root: str) -> DataFrame:
    """Words and items of the benchmark found in every document; odd rows as in ``decontaminate.mark``."""
    marked = decontaminate.mark(_table(spark, root, "documents"), _table(spark, root, "benchmark"), keep=["doc_id"])
    return marked.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op10_chat(spark: SparkSession, root: str) -> DataFrame:
    """Conversations that no longer one begins with, rendered; odd rows as in ``chat.render``."""
    return chat.render(_table(spark, root, "conversations"))


def op11_centroids(spark: SparkSession, root: str) -> DataFrame:
    """Cluster, distance and centroid digest of every vector; rules for odd rows as in ``centroids.cluster``."""
    return centroids.cluster(_table(spark, root, "embeddings"))


def op12_merkle(spark: SparkSession, root: str) -> DataFrame:
    """Leaf, roots and proof of every document, and what a copy without line ends of every second one proves.

    Nulls, ties and repeated rows as in ``merkle.manifest``. A row without doc_id is not altered.
    """
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = merkle.verified(merkle.manifest(_table(spark, root, "documents"), changed={"text": cut}), "changed_leaf")
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("siblings")).alias("proof_sha256"),
                       "folded_root", "verified")


def op13_bpe(spark: SparkSession, root: str) -> DataFrame:
    """Token count and digests of every document's ids and of the bytes decoded from them; null texts as empty ones."""
    return bpe.encode(_table(spark, root, "documents"), keep=["doc_id"])


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_licenses, op2_language, op3_substrings, op4_sharding, op5_surrogates, op6_packing, op7_simhash, op8_top_products,
    op9_decontamination, op10_chat, op11_centroids, op12_merkle, op13_bpe)}
QUERIES["pipeline"] = corpus_pipeline.run


def _clusters_sql() -> str:
    """Every round as a step of its own: assign, then move the centroids."""
    steps = ["""
        v AS MATERIALIZED (
            SELECT row_number() OVER () AS row_id, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS n, v AS c FROM v
            ORDER BY sha256('2:' || vec_id) NULLS LAST, v LIMIT 40)"""]
    for round_ in range(6):
        steps.append(f"""
        a{round_} AS MATERIALIZED (
            SELECT row_id, min(struct_pack(d := list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), n := n)) AS best
            FROM v CROSS JOIN c{round_} GROUP BY row_id)""")
        if round_ < 5:
            steps.append(f"""
        m{round_} AS MATERIALIZED (
            SELECT n, list(CAST(m AS BIGINT) ORDER BY i) AS c
            FROM (SELECT n, i, (s - ((s % k) + k) % k) // k AS m
                  FROM (SELECT best.n AS n, i, sum(x) AS s, count(*) AS k
                        FROM (SELECT row_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v) JOIN a{round_} USING (row_id)
                        GROUP BY best.n, i))
            GROUP BY n),
        c{round_ + 1} AS MATERIALIZED (SELECT n, coalesce(m{round_}.c, c{round_}.c) AS c FROM c{round_} LEFT JOIN m{round_} USING (n))""")
    return "WITH " + ",".join(steps) + """
        SELECT vec_id, CAST(best.n AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
               CAST(sum(best.d) OVER (PARTITION BY best.n) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM v JOIN a5 USING (row_id) JOIN c5 ON c5.n = best.n"""


#: What SQL can express; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op3_substrings": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        places AS (
            SELECT row_id, pos, array_to_string(list_slice(w, pos, pos + 34), ' ') AS words
            FROM (SELECT row_id, w, unnest(range(1, len(w) - 33)) AS pos FROM d WHERE len(w) >= 35)),
        repeated AS (
            SELECT row_id, pos FROM (SELECT row_id, pos, count(*) OVER (PARTITION BY words) AS n FROM places) WHERE n > 1),
        gone AS (SELECT DISTINCT row_id, unnest(range(pos, pos + 35)) AS pos FROM repeated),
        words AS (SELECT row_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
        kept AS (
            SELECT row_id, count(gone.pos) AS n_removed,
                   string_agg(CASE WHEN gone.pos IS NULL THEN word END, ' ' ORDER BY pos) AS text
            FROM words LEFT JOIN gone USING (row_id, pos) GROUP BY row_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (row_id)""",
    "op8_top_products": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
        SELECT query_id, CAST(place AS INTEGER) AS "rank", vec_id, score FROM ranked WHERE place <= 10""",
    "op9_decontamination": r"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS row_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        i AS (
            SELECT item_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, n, list_slice(w, pos, pos + n - 1) AS words
            FROM (SELECT item_id, w, least(10, len(w)) AS n,
                         unnest(range(1, len(w) - least(10, len(w)) + 2)) AS pos FROM i WHERE len(w) > 0)),
        places AS (
            SELECT row_id, pos, n, list_slice(w, pos, pos + n - 1) AS words
            FROM (SELECT row_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos
                  FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
        hits AS (
            SELECT p.row_id, p.pos, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.words = x.words),
        covered AS (
            SELECT row_id, count(DISTINCT word) AS n_hit
            FROM (SELECT row_id, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY row_id),
        named AS (
            SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY row_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
               coalesce(c.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered c USING (row_id) LEFT JOIN named n USING (row_id)""",
    "op10_chat": """
        WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        whole AS (
            SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS said,
                   list('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>'
                        ORDER BY turn, role, text) AS lines
            FROM turns GROUP BY conv_id),
        classes AS (
            SELECT min(conv_id) AS conv_id, count(*) AS n_snapshots, said, any_value(lines) AS lines FROM whole GROUP BY said),
        maximal AS (
            SELECT * FROM classes a
            WHERE NOT EXISTS (
                SELECT 1 FROM classes b
                WHERE b.said[1] IS NOT DISTINCT FROM a.said[1] AND len(b.said) > len(a.said)
                  AND list_slice(b.said, 1, len(a.said)) = a.said)),
        parts AS (SELECT *, unnest(range(0, (len(lines) - 1) // 256 + 1)) AS part FROM maximal)
        SELECT conv_id, CAST(part AS BIGINT) AS part, CAST(len(lines) AS BIGINT) AS n_turns, n_snapshots,
               array_to_string(list_slice(lines, part * 256 + 1, part * 256 + 256), chr(10)) AS rendered
        FROM parts""",
    "op11_centroids": _clusters_sql(),
    "op12_merkle": r"""
        WITH RECURSIVE crc_table AS (
            SELECT n, list_reduce(list_prepend(CAST(n AS BIGINT), CAST(range(8) AS BIGINT[])),
                                  lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
            FROM range(256) t(n)),
        crc(doc_id, raw, i, c) AS (
            SELECT doc_id, CAST(doc_id AS VARCHAR), 1, CAST(4294967295 AS BIGINT)
            FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
            UNION ALL
            SELECT doc_id, raw, i + 1, xor(t.c, crc.c // 256)
            FROM crc JOIN crc_table t ON t.n = xor(crc.c % 256, CAST(ascii(substr(raw, i, 1)) AS BIGINT)) WHERE i <= len(raw)),
        even_ids AS (SELECT doc_id FROM crc WHERE i > len(raw) AND xor(c, 4294967295) % 2 = 0),
        fields AS (
            SELECT *, row_number() OVER () AS row_id,
                   CASE WHEN doc_id IS NOT NULL THEN strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id ELSE '-' END
                   || CASE WHEN source IS NOT NULL THEN strlen(source) || ':' || source ELSE '-' END
                   || CASE WHEN lang IS NOT NULL THEN strlen(lang) || ':' || lang ELSE '-' END
                   || CASE WHEN n_chars IS NOT NULL THEN strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars ELSE '-' END AS head,
                   CASE WHEN doc_id IN (SELECT doc_id FROM even_ids) THEN replace(text, chr(10), '') ELSE text END AS given
            FROM documents),
        hashed AS (
            SELECT row_id, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(strlen(given) || ':' || given, '-')) AS given FROM fields),
        placed AS (
            SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY source) AS n
            FROM hashed),
        nodes(tree, level, pos, n, h) AS (
            SELECT tree, 0, pos, n, leaf FROM placed
            UNION ALL
            SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
            FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3, n),
        subroots AS (SELECT tree, h FROM nodes WHERE n = 1),
        tops(level, pos, n, h) AS (
            SELECT 0, tree, count(*) OVER (), h FROM subroots
            UNION ALL
            SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
            FROM tops WHERE n > 1 GROUP BY level, pos // 3, n),
        root AS (SELECT h FROM tops WHERE n = 1),
        steps AS (
            SELECT 0 AS phase, tree, level, pos, h, pos // 3 AS run FROM nodes WHERE n > 1
            UNION ALL SELECT 1, -1, level, pos, h, pos // 3 FROM tops WHERE n > 1),
        sided AS (
            SELECT phase, tree, level, pos,
                   coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM steps WINDOW w AS (PARTITION BY phase, tree, level, run ORDER BY pos)),
        path AS (
            SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY phase, level) AS step, l, r
            FROM (SELECT p.row_id, s.* FROM placed p JOIN sided s
                  ON s.phase = 0 AND s.tree = p.tree AND s.pos = p.pos // CAST(power(3, s.level) AS BIGINT)
                  UNION ALL
                  SELECT p.row_id, s.* FROM placed p JOIN sided s
                  ON s.phase = 1 AND s.pos = p.tree // CAST(power(3, s.level) AS BIGINT))),
        fold(row_id, step, h) AS (
            SELECT row_id, CAST(1 AS BIGINT), given FROM placed
            UNION ALL
            SELECT row_id, step + 1, sha256(l || h || r) FROM fold JOIN path USING (row_id, step)),
        ended AS (SELECT row_id, arg_max(h, step) AS h FROM fold GROUP BY row_id),
        proofs AS (SELECT row_id, string_agg(l || r, '' ORDER BY step) AS p FROM path GROUP BY row_id)
        SELECT doc_id, leaf, s.h AS subroot, root.h AS root, sha256(coalesce(p, '')) AS proof_sha256, e.h AS folded_root,
               e.h = root.h AS verified
        FROM placed JOIN subroots s USING (tree) JOIN ended e USING (row_id) LEFT JOIN proofs USING (row_id) CROSS JOIN root""",
}
