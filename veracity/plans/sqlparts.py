"""DuckDB SQL fragments shared by the oracle queries (same formulas as the Spark side)."""

from veracity.schema import WS_CLASS_DUCKDB

WS_SQL = WS_CLASS_DUCKDB
WORD_RE = f"[^{WS_CLASS_DUCKDB}]+"

# (doc_id, word_idx, start, end, word) for every whitespace word of documents
DOC_WORDS = f"""
  SELECT doc_id, word_idx, start, start + length(word) AS "end", word FROM (
    SELECT doc_id, word_idx, word,
           CAST(sum(length(gap) + length(word)) OVER (PARTITION BY doc_id ORDER BY word_idx
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(word) AS INTEGER) AS start
    FROM (
      SELECT doc_id, CAST(i - 1 AS INTEGER) AS word_idx, ws[i] AS word, gs[i] AS gap FROM (
        SELECT doc_id, regexp_extract_all(text, '{WORD_RE}') AS ws,
               regexp_split_to_array(text, '{WORD_RE}') AS gs
        FROM documents) t, range(1, len(ws) + 1) r(i)
    )
  )
"""

# (doc_id, item_id, start, end): benchmark passages found verbatim in documents
BENCH_HITS = """
  SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(start + plen AS INTEGER) AS "end" FROM (
    SELECT doc_id, item_id, plen,
           sum(length(piece)) OVER w + (k - 1) * plen AS start, k, n
    FROM (
      SELECT d.doc_id, b.item_id, length(b.text) AS plen, p.piece, p.k,
             len(string_split(d.text, b.text)) AS n
      FROM documents d JOIN benchmark b ON instr(d.text, b.text) > 0,
           unnest(string_split(d.text, b.text)) WITH ORDINALITY AS p(piece, k)
    )
    WINDOW w AS (PARTITION BY doc_id, item_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  ) WHERE k < n
"""

LABEL_CLASS = """
  CASE WHEN toxic = 1 THEN 'satire' WHEN quality = 1 THEN 'real' ELSE 'fake' END
"""
