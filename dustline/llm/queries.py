"""Registered queries of this subpackage and their comparison SQL."""

from __future__ import annotations

from dustline.llm.decontamination import op7_decontamination
from dustline.llm.language_id import op8_language_id
from dustline.llm.language_model import op3_language_model
from dustline.llm.licences import SQL as LICENCES_SQL
from dustline.llm.licences import op4_licences
from dustline.llm.merkle import SQL as MERKLE_SQL
from dustline.llm.merkle import op13_merkle_manifest
from dustline.llm.mixing import op9_mixing
from dustline.llm.near_duplicates import op10_near_duplicates
from dustline.llm.nearest_vectors import op2_nearest_vectors
from dustline.llm.ngram_join import op11_ngram_join
from dustline.llm.pii import op1_personal_data
from dustline.llm.secret_scan import op5_secrets
from dustline.llm.term_audit import SQL as AUDIT_SQL
from dustline.llm.term_audit import op12_source_divergence
from dustline.llm.toxicity import op6_toxicity

QUERIES = {q.__name__: q for q in (op1_personal_data, op2_nearest_vectors, op3_language_model, op4_licences, op5_secrets, op6_toxicity, op7_decontamination,
                                   op8_language_id, op9_mixing, op10_near_duplicates, op11_ngram_join, op12_source_divergence, op13_merkle_manifest)}



def similar_sql(least: int, columns: str) -> str:
    """A set of shingles per document, every pair linked at ``least`` per cent through a shared shingle, then the smallest id reachable."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= {least} * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM words UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
smallest AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id{columns}
FROM words w JOIN smallest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


SQL: dict[str, str] = {"op4_licences": LICENCES_SQL, "op10_near_duplicates": similar_sql(75, ", w.doc_id = component_id AS kept"), "op11_ngram_join": similar_sql(80, ""), "op12_source_divergence": AUDIT_SQL,
                       "op13_merkle_manifest": MERKLE_SQL}
