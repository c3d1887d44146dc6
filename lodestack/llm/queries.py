"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .bpe import op10_bpe
from .chat import op6_chat
from .decontaminate import op7_decontaminate
from .embedding_dedup import op4_embedding_dedup
from .language import op5_language
from .near_dedup import op1_near_dedup
from .quality import op8_quality
from .secrets import op9_secrets
from .sharding import op2_sharding
from .token_store import op3_token_store

QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_sharding, op3_token_store, op4_embedding_dedup, op5_language, op6_chat, op7_decontaminate, op8_quality, op9_secrets, op10_bpe)}

WORDS = "SELECT {id}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}]+') AS w FROM {table} WHERE text IS NOT NULL"
SHINGLES = "SELECT DISTINCT {id}, array_to_string(w[i:i + 4], ' ') AS shingle FROM (SELECT {id}, w, unnest(range(1, len(w) - 3)) AS i FROM {words} WHERE len(w) >= 5)"

ORACLE_SQL = {
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))) > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), class AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a),
copies AS (SELECT embedding, count(*) AS n FROM embeddings GROUP BY embedding)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept, coalesce(k.n, 1)::BIGINT AS n_copies
FROM embeddings e JOIN class c USING (vec_id) LEFT JOIN degree d USING (vec_id) LEFT JOIN copies k ON e.embedding = k.embedding
""",
    "op7_decontaminate": f"""
WITH iw AS ({WORDS.format(id="item_id", table="benchmark")}), dw AS ({WORDS.format(id="doc_id", table="documents")}),
i AS ({SHINGLES.format(id="item_id", words="iw")}), d AS ({SHINGLES.format(id="doc_id", words="dw")}),
size AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n FROM d JOIN i USING (shingle) GROUP BY doc_id, item_id),
short AS (SELECT item_id, ' ' || array_to_string(w, ' ') || ' ' AS run FROM iw WHERE len(w) BETWEEN 1 AND 4)
SELECT doc_id, item_id, shared.n::INTEGER AS shared, size.n::INTEGER AS item_shingles, shared.n / size.n::DOUBLE AS containment
FROM shared JOIN size USING (item_id) WHERE shared.n >= 0.8 * size.n - 1e-9
UNION ALL SELECT DISTINCT doc_id, item_id, 1::INTEGER, 1::INTEGER, 1::DOUBLE FROM short JOIN dw ON contains(' ' || array_to_string(w, ' ') || ' ', run)
""",
}
