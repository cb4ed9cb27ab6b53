"""The registered queries of this package and, where SQL can say them, their DuckDB twins."""

from __future__ import annotations

from . import (decontaminate, fill_middle, html_text, language, line_dedup, mixing, near_dup, pii, resample, secrets, token_files, top_k,
               toxicity)

QUERIES = {f.__name__: f for f in (
    html_text.op1_block_tree_text,
    near_dup.op2_setsketch_near_dup,
    toxicity.op3_toxic_segments,
    top_k.op4_branch_bound_top_k,
    pii.op5_boosted_pii,
    secrets.op6_trigram_secrets,
    line_dedup.op7_line_chunk_dedup,
    mixing.op8_multinomial_mix,
    language.op9_word_backoff_language,
    decontaminate.op10_minhash_containment,
    token_files.op11_seekable_token_files,
    fill_middle.op12_capture_fill_middle,
    resample.op13_line_importance_draw,
)}

SQL = {
    "op4_branch_bound_top_k": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 10""",
    "op10_minhash_containment": r"""
WITH w AS (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    UNION ALL
    SELECT 'i', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark),
s AS (
    SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))
        ELSE [array_to_string(w, ' ')] END) AS g
    FROM w WHERE len(w) > 0),
n AS (SELECT id, count(*) AS item_shingles FROM s WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS held, any_value(item_shingles) AS item_shingles
FROM s d JOIN s i ON d.kind = 'd' AND i.kind = 'i' AND d.g = i.g JOIN n ON n.id = i.id
GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(item_shingles)""",
    "op2_setsketch_near_dup": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))
        ELSE [array_to_string(w, ' ')] END) AS g
    FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 85 * (any_value(na.n) + any_value(nb.n) - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.c)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id, d.doc_id = min(r.c) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id, n.n""",
    "op12_capture_fill_middle": r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
k AS (
    SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (
    SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p""",
}
