"""SQL fragments shared by the oracles (DuckDB dialect)."""

from __future__ import annotations


def score_table(src: str, y: str, p: str, by: list[str] | None = None) -> str:
    """Per distinct score: pos/neg counts, running sums (descending score)
    and group totals, the same quantities the Spark ``score_table`` builds."""
    by = by or []
    b = ", ".join(by)
    bsel = f"{b}, " if by else ""
    part = f"PARTITION BY {b} " if by else ""
    return f"""
SELECT {bsel}score, pos, neg,
  SUM(pos) OVER ({part}ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
  SUM(neg) OVER ({part}ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
  SUM(pos) OVER ({'PARTITION BY ' + b if by else ''}) AS tot_pos, SUM(neg) OVER ({'PARTITION BY ' + b if by else ''}) AS tot_neg
FROM (SELECT {bsel}CAST({p} AS DOUBLE) AS score,
        SUM(CASE WHEN {y} >= 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS pos,
        SUM(CASE WHEN {y} >= 1 THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END) AS neg
      FROM {src} WHERE {p} IS NOT NULL AND {y} IS NOT NULL GROUP BY {bsel}CAST({p} AS DOUBLE)) s"""


CURVE_AGGS = """
  MAX(tot_pos) AS n_pos, MAX(tot_neg) AS n_neg,
  CASE WHEN MAX(tot_pos) > 0 AND MAX(tot_neg) > 0
       THEN SUM(neg * (tp - 0.5 * pos)) / (MAX(tot_pos) * MAX(tot_neg)) END AS auc,
  CASE WHEN MAX(tot_pos) > 0 AND MAX(tot_neg) > 0 THEN MAX(tp / tot_pos - fp / tot_neg) END AS ks,
  CASE WHEN MAX(tot_pos) > 0 THEN SUM(pos / tot_pos * (tp / (tp + fp))) END AS average_precision,
  MAX(CASE WHEN den > 0 THEN (tp * tn - fp * fn) / den ELSE 0.0 END) AS max_mcc"""


def _with_counts(st: str) -> str:
    return (f"SELECT *, sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) AS den FROM "
            f"(SELECT *, cum_pos AS tp, cum_neg AS fp, tot_pos - cum_pos AS fn, tot_neg - cum_neg AS tn "
            f"FROM ({st}) a) b")


def curve_metrics(src: str, y: str, p: str, by: list[str] | None = None) -> str:
    by = by or []
    b = ", ".join(by)
    return (f"SELECT {b + ', ' if by else ''}{CURVE_AGGS}\nFROM ({_with_counts(score_table(src, y, p, by))}) st"
            + (f" GROUP BY {b}" if by else ""))


def classification_report(src: str, y: str, yhat: str) -> str:
    return f"""
SELECT label, precision, recall, f1_score, support FROM (
WITH b AS (SELECT CAST({y} AS DOUBLE) AS t, CAST({yhat} AS DOUBLE) AS p FROM {src}
           WHERE {y} IS NOT NULL AND {yhat} IS NOT NULL),
cm AS (SELECT t, p, COUNT(*) AS n FROM b GROUP BY t, p),
labels AS (SELECT t AS l FROM cm UNION SELECT p FROM cm),
per AS (SELECT l,
          COALESCE((SELECT SUM(n) FROM cm WHERE cm.t = labels.l), 0) AS support,
          COALESCE((SELECT SUM(n) FROM cm WHERE cm.p = labels.l), 0) AS predicted,
          COALESCE((SELECT SUM(n) FROM cm WHERE cm.t = labels.l AND cm.p = labels.l), 0) AS tp FROM labels),
per2 AS (SELECT l, support, tp,
           CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
           CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
per3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                   ELSE 0.0 END AS f1_score FROM per2)
SELECT CAST(l AS VARCHAR) AS label, precision, recall, f1_score, CAST(support AS BIGINT) AS support FROM per3
UNION ALL SELECT 'accuracy', NULL, NULL, SUM(tp) / SUM(support), CAST(SUM(support) AS BIGINT) FROM per3
UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1_score), CAST(SUM(support) AS BIGINT) FROM per3
UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
  SUM(f1_score * support) / SUM(support), CAST(SUM(support) AS BIGINT) FROM per3) r"""


def priority(src: str, pct: float = 10, tiebreak: str = "idsubscrip, observation_date, pubcode, churned") -> str:
    """Adds churn_priority / intent_priority (top pct % by bin_sum and by the
    intent probability, first-come ties by the tiebreak, nulls never)."""
    return f"""
SELECT *,
  CASE WHEN bin_sum IS NULL THEN false ELSE
    ROW_NUMBER() OVER (ORDER BY bin_sum DESC NULLS LAST, {tiebreak}) <= CAST(FLOOR(COUNT(*) OVER () * {float(pct)} / 100) AS BIGINT) END AS churn_priority,
  CASE WHEN churned_1_PREDICTION IS NULL THEN false ELSE
    ROW_NUMBER() OVER (ORDER BY churned_1_PREDICTION DESC NULLS LAST, {tiebreak}) <= CAST(FLOOR(COUNT(*) OVER () * {float(pct)} / 100) AS BIGINT) END AS intent_priority
FROM {src}"""
