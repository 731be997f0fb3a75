"""The text operators' results in plain SQL, where SQL can express them."""

ORACLES: dict[str, str] = {
    "op13_topk_search": """
WITH v AS (
 SELECT vec_id, list_transform(embedding, lambda x: floor(64 * cast(x AS double))) AS v
 FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
 SELECT q.vec_id AS query_id, c.vec_id, cast(list_inner_product(q.v, c.v) AS bigint) AS score
 FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
 SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS int) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
}
