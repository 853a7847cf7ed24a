"""The operators' results in DuckDB SQL, where SQL can express them."""

_ORACLES = {
    "op9_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
            FROM documents),
        groups AS (
            SELECT content, arg_min(doc_id, (-chars, doc_id)) AS keep_id, count(*) AS group_size
            FROM texts GROUP BY content)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
        FROM texts JOIN groups USING (content)""",
    "op8_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
        tops AS (SELECT html, max(page_id) AS top FROM payloads WHERE payload_bytes >= 1000 GROUP BY html)
        SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN top <> page_id THEN top END AS refers_to
        FROM payloads LEFT JOIN tops USING (html)""",
    "op7_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        escaped AS (
            SELECT *, length(regexp_replace(text, '\\|</?s>|\[/?INST\]', '\0+', 'g')) AS size,
                   CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned
            FROM turns)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               sum(length(learned))::BIGINT AS loss_chars, sha256(string_agg(learned, '' ORDER BY turn)) AS loss_sha256,
               sum(length(role) + size + CASE WHEN role = 'assistant' THEN 8 ELSE 19 END)::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id""",
    "op11_hard_negatives": """
        WITH kept AS MATERIALIZED (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS MATERIALIZED (
            SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
                   list_dot_product(a.v, b.v)::BIGINT AS score
            FROM kept a JOIN kept b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        found AS (
            SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS place
            FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
             AND 100 * s.score BETWEEN 50 * positive_score AND 95 * positive_score)
        SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score
        FROM found WHERE place <= 3""",
}


def _clusters(rounds=3) -> str:
    """A step for each round: all distances, the nearest, floored means."""
    steps = ["""kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             """c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, v AS c FROM kept
            ORDER BY sha256('1:' || vec_id) LIMIT 16)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
            SELECT vec_id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance, any_value(v) AS v
            FROM (SELECT vec_id, cluster, v, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
                  FROM kept, c{i}) GROUP BY vec_id)""")
        steps.append(f"""m{i} AS (
            SELECT cluster, list(m ORDER BY d) AS c
            FROM (SELECT cluster, d, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m
                  FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS d FROM a{i}) GROUP BY cluster, d) GROUP BY cluster)""")
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))")
    return f"""
        WITH {", ".join(steps[:-2])}
        SELECT vec_id, a.cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} USING (cluster)"""


_ORACLES["op13_clusters"] = _clusters()


def all_oracles() -> dict:
    return dict(_ORACLES)
