"""Driver queries for splits and the progress log (phase 8).

``events`` stands in for the progress log: ``user_id`` = run, ``event_type`` = stage,
order by ``ts`` = step, ``value`` = loss.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veracity.operators import progress as P
from veracity.operators import splits as S
from veracity.plans.registry import query, table

TEST, VAL, SEED = 0.15, 0.15, 42
REL_SQL = "(CAST(0.15 AS DOUBLE) / (1.0 - CAST(0.15 AS DOUBLE)))"


def labelled(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").select(
        "doc_id", "source",
        F.when(F.col("toxic") == 1, "satire").when(F.col("quality") == 1, "real").otherwise("fake").alias("label_norm"))


LABELLED_SQL = """
  SELECT d.doc_id, d.source,
         CASE WHEN l.toxic = 1 THEN 'satire' WHEN l.quality = 1 THEN 'real' ELSE 'fake' END AS label_norm
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id
"""

GROUP_SPLIT_SQL = f"""
  WITH g AS (SELECT DISTINCT source AS g FROM documents),
  n AS (SELECT count(*) AS n FROM g),
  t AS (SELECT g FROM (SELECT g, row_number() OVER (ORDER BY md5('{SEED}:' || g)) - 1 AS r FROM g), n
        WHERE r < ceil(CAST(0.15 AS DOUBLE) * n)),
  rest AS (SELECT g FROM g WHERE g NOT IN (SELECT g FROM t)),
  v AS (SELECT g FROM (SELECT g, row_number() OVER (ORDER BY md5('{SEED + 1}:' || g)) - 1 AS r FROM rest),
          (SELECT count(*) AS m FROM rest) WHERE r < ceil({REL_SQL} * m))
  SELECT d.doc_id, CASE WHEN d.source IN (SELECT g FROM t) THEN 'test'
                        WHEN d.source IN (SELECT g FROM v) THEN 'validation' ELSE 'train' END AS split
  FROM documents d
"""


@query("group_split", GROUP_SPLIT_SQL)
def q_group_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return S.group_split(d, "source", "doc_id", TEST, VAL, SEED).select("doc_id", "split")


def _strat_sql(src: str, label: str) -> str:
    """Largest-remainder stratified split of ``src`` (doc_id, label) in SQL."""
    def quotas(rows: str, frac: str, name: str) -> str:
        return f"""
    {name}_c AS (SELECT {label} AS lab, count(*) AS n FROM {rows} GROUP BY 1),
    {name}_t AS (SELECT sum(n) AS tn, ceil({frac} * sum(n)) AS k FROM {name}_c),
    {name}_x AS (SELECT lab, k * n / tn AS x, floor(k * n / tn) AS b, k FROM {name}_c, {name}_t),
    {name}_q AS (SELECT lab, b + CASE WHEN row_number() OVER (ORDER BY x - b DESC, lab)
                   <= k - (SELECT sum(b) FROM {name}_x) THEN 1 ELSE 0 END AS quota FROM {name}_x)"""
    return f"""
  WITH a AS ({src}),
  {quotas('a', 'CAST(0.15 AS DOUBLE)', 'te')},
  t AS (SELECT doc_id FROM (SELECT a.doc_id, a.{label},
          row_number() OVER (PARTITION BY a.{label} ORDER BY md5('{SEED}:' || a.doc_id)) - 1 AS r FROM a) z
        JOIN te_q ON te_q.lab = z.{label} WHERE r < quota),
  rest AS (SELECT * FROM a WHERE doc_id NOT IN (SELECT doc_id FROM t)),
  {quotas('rest', REL_SQL, 'va')},
  v AS (SELECT doc_id FROM (SELECT rest.doc_id, rest.{label},
          row_number() OVER (PARTITION BY rest.{label} ORDER BY md5('{SEED + 1}:' || rest.doc_id)) - 1 AS r FROM rest) z
        JOIN va_q ON va_q.lab = z.{label} WHERE r < quota)
  SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM t) THEN 'test'
                      WHEN doc_id IN (SELECT doc_id FROM v) THEN 'validation' ELSE 'train' END AS split
  FROM a"""


@query("stratified_split", _strat_sql(LABELLED_SQL, "label_norm"))
def q_stratified_split(spark, sf_dir):
    return S.stratified_split(labelled(spark, sf_dir), "label_norm", "doc_id", TEST, VAL, SEED).select("doc_id", "split")


@query("plain_split", _strat_sql("SELECT doc_id, 'all' AS one FROM documents", "one"))
def q_plain_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return S.plain_split(d, "doc_id", TEST, VAL, SEED).select("doc_id", "split")


@query("split_articles", f"""
WITH s AS ({GROUP_SPLIT_SQL}) SELECT doc_id, split FROM s
""")
def q_split_articles(spark, sf_dir):
    # the documents carry 20 source groups, so the group mode is chosen
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("group_id"))
    return S.split_articles(d, "doc_id", "group_id").select("doc_id", "split")


@query("split_summary", f"""
WITH s AS ({_strat_sql(LABELLED_SQL, 'label_norm')}), a AS ({LABELLED_SQL})
SELECT a.label_norm, count(*) FILTER (WHERE split = 'train') AS train,
       count(*) FILTER (WHERE split = 'validation') AS validation, count(*) FILTER (WHERE split = 'test') AS test
FROM s JOIN a ON a.doc_id = s.doc_id GROUP BY a.label_norm
""")
def q_split_summary(spark, sf_dir):
    s = S.stratified_split(labelled(spark, sf_dir), "label_norm", "doc_id", TEST, VAL, SEED)
    return S.split_summary(s)


PROGRESS_SQL = """
  SELECT event_id, user_id, event_type, value, ts,
         row_number() OVER w AS step, count(*) OVER p AS total_steps,
         avg(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_loss,
         (epoch_us(ts) - epoch_us(min(ts) OVER p)) / 1e6 AS elapsed_seconds
  FROM events
  WINDOW p AS (PARTITION BY user_id, event_type), w AS (PARTITION BY user_id, event_type ORDER BY ts)
"""


def progress(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return P.running_progress(e, ["user_id", "event_type"], "ts", "value", "ts")


@query("running_loss", f"""
SELECT event_id, step, total_steps, round(running_loss, 6) AS running_loss,
       round(100.0 * step / total_steps, 6) AS percent,
       round(elapsed_seconds / greatest(1, step) * greatest(0, total_steps - step), 3) AS eta_seconds
FROM ({PROGRESS_SQL})
""")
def q_running_loss(spark, sf_dir):
    p = progress(spark, sf_dir)
    return p.select("event_id", F.col("step").cast("bigint").alias("step"), "total_steps",
                    F.round("running_loss", 6).alias("running_loss"), F.round("percent", 6).alias("percent"),
                    F.round("eta_seconds", 3).alias("eta_seconds"))


@query("thin_log", f"""
SELECT event_id, step FROM ({PROGRESS_SQL}) WHERE step = 1 OR step = total_steps OR step % 10 = 0
""")
def q_thin_log(spark, sf_dir):
    return P.thin_log(progress(spark, sf_dir), 10).select("event_id", F.col("step").cast("bigint").alias("step"))


@query("early_stop", """
WITH RECURSIVE s AS (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS e, value AS m
  FROM events),
r AS (
  SELECT user_id, event_type, e, -m AS best, e AS best_e, 0 AS wait, CAST(NULL AS BIGINT) AS stop_e, 1 AS n
  FROM s WHERE e = 1
  UNION ALL
  SELECT s.user_id, s.event_type, s.e,
    CASE WHEN -s.m > r.best + 1e-6 THEN -s.m ELSE r.best END,
    CASE WHEN -s.m > r.best + 1e-6 THEN s.e ELSE r.best_e END,
    CASE WHEN -s.m > r.best + 1e-6 THEN 0 ELSE r.wait + 1 END,
    CASE WHEN (CASE WHEN -s.m > r.best + 1e-6 THEN 0 ELSE r.wait + 1 END) >= 2 THEN s.e END,
    r.n + 1
  FROM r JOIN s ON s.user_id = r.user_id AND s.event_type = r.event_type AND s.e = r.e + 1
  WHERE r.stop_e IS NULL),
last AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY e DESC) AS k FROM r),
ne AS (SELECT user_id, event_type, max(e) AS last_e FROM s GROUP BY ALL)
SELECT l.user_id, l.event_type, l.best_e AS best_epoch, -l.best AS best_value,
       coalesce(l.stop_e, ne.last_e) AS stop_epoch, CAST(l.n AS INTEGER) AS epochs_run
FROM last l JOIN ne ON ne.user_id = l.user_id AND ne.event_type = l.event_type WHERE k = 1
""")
def q_early_stop(spark, sf_dir):
    p = progress(spark, sf_dir)
    return P.early_stop(p, ["user_id", "event_type"], "step", "value", mode="min", patience=2)
