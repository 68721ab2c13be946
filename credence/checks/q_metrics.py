"""Suite: A1 and classification metrics A10-A13 on scorecard predictions.

The prediction under test is the scorecard's own rule (``score > 50``) and
its probability ``sigmoid((score - 50) / 10)``, against the noisy label, so
every number is SQL-expressible. Model-based metrics are in q_models.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import spec
from ..fixtures import applications
from ..functions.scorecard import score
from ..operators.metrics import (binary_metrics, classification_report, confusion_matrix, roc_auc,
                                 split_summary)
from ..operators.split import stratified_split
from .oracle_sql import SCORE_SQL, with_base
from .q_prep import LEHMER_SPLIT_SQL
from .registry import register


def r6(c):
    return F.round(c, 6)


SCORED_SQL = f"""
, scored AS (SELECT application_id, loan_approved, CAST({SCORE_SQL} AS DOUBLE) AS score,
                    CAST({SCORE_SQL} > 50 AS INTEGER) AS pred,
                    1E0 / (1E0 + exp(-(CAST({SCORE_SQL} AS DOUBLE) - 50E0) / 10E0)) AS prob
             FROM applications)
"""


def scored(spark, sf, apps=None, keep=()):
    a = applications(spark, sf) if apps is None else apps
    s = score().cast("double")
    return a.select(spec.KEY, spec.TARGET, *keep, s.alias("score"), (s > 50).cast("int").alias("pred"),
                    (F.lit(1.0) / (F.lit(1.0) + F.exp(-(s - F.lit(50.0)) / F.lit(10.0)))).alias("prob"))


@register("A1_split_summary", with_base(LEHMER_SPLIT_SQL + """
SELECT split, CAST(count(*) AS BIGINT) AS rows, round(avg(loan_approved), 6) AS label_rate
FROM split GROUP BY split
"""))
def a1(spark, sf):
    s = stratified_split(applications(spark, sf), spec.TARGET, spec.KEY, spec.TEST_SIZE, spec.SEED,
                         method="lehmer")
    return split_summary(s, spec.TARGET).select("split", "rows", r6("label_rate").alias("label_rate"))


@register("A10_confusion_matrix", with_base(SCORED_SQL + """
SELECT loan_approved AS actual, pred AS predicted, CAST(count(*) AS BIGINT) AS count
FROM scored GROUP BY 1, 2
"""))
def a10(spark, sf):
    return confusion_matrix(scored(spark, sf), spec.TARGET, "pred")


@register("A11_binary_metrics", with_base(SCORED_SQL + """
, c AS (SELECT CAST(count(*) AS DOUBLE) AS n,
               CAST(sum(CASE WHEN loan_approved = pred THEN 1 ELSE 0 END) AS DOUBLE) AS correct,
               CAST(sum(CASE WHEN loan_approved = 1 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
               CAST(sum(CASE WHEN pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pp,
               CAST(sum(CASE WHEN loan_approved = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS ap FROM scored),
m AS (SELECT correct / n AS accuracy, CASE WHEN pp = 0 THEN 0E0 ELSE tp / pp END AS precision,
             CASE WHEN ap = 0 THEN 0E0 ELSE tp / ap END AS recall FROM c)
SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(CASE WHEN precision + recall = 0 THEN 0E0
                  ELSE 2E0 * precision * recall / (precision + recall) END, 6) AS f1
FROM m
"""))
def a11(spark, sf):
    m = binary_metrics(scored(spark, sf), spec.TARGET, "pred")
    return m.select(*[r6(c).alias(c) for c in m.columns])


AUC_SQL = """
, s1 AS (SELECT 'score' AS score_column, score AS v, loan_approved FROM scored
         UNION ALL SELECT 'prob', prob, loan_approved FROM scored
         UNION ALL SELECT 'pred', CAST(pred AS DOUBLE), loan_approved FROM scored),
s AS (SELECT score_column, v, sum(CASE WHEN loan_approved = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN loan_approved = 1 THEN 0 ELSE 1 END) AS neg FROM s1 GROUP BY 1, 2),
c AS (SELECT *, COALESCE(sum(neg) OVER (PARTITION BY score_column ORDER BY v
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
      FROM s)
SELECT score_column,
       round(sum(CAST(pos AS DOUBLE) * (CAST(neg_below AS DOUBLE) + 0.5E0 * CAST(neg AS DOUBLE)))
             / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS auc
FROM c GROUP BY score_column
"""


@register("A12_roc_auc", with_base(SCORED_SQL + AUC_SQL))
def a12(spark, sf):
    s = scored(spark, sf)
    auc_score = roc_auc(s, spec.TARGET, "score").select(F.lit("score").alias("score_column"),
                                                        r6("auc").alias("auc"))
    auc_prob = roc_auc(s, spec.TARGET, "prob").select(F.lit("prob").alias("score_column"),
                                                      r6("auc").alias("auc"))
    auc_pred = roc_auc(s, spec.TARGET, "pred").select(F.lit("pred").alias("score_column"),
                                                      r6("auc").alias("auc"))
    return auc_score.unionByName(auc_prob).unionByName(auc_pred)


@register("A13_classification_report", with_base(SCORED_SQL + """
, cm AS (SELECT loan_approved AS actual, pred AS predicted, count(*) AS n FROM scored GROUP BY 1, 2),
per AS (SELECT c.c, COALESCE(sum(CASE WHEN cm.actual = c.c AND cm.predicted = c.c THEN n END), 0) AS tp,
               COALESCE(sum(CASE WHEN cm.actual = c.c THEN n END), 0) AS support,
               COALESCE(sum(CASE WHEN cm.predicted = c.c THEN n END), 0) AS pp
        FROM (SELECT actual AS c FROM cm UNION SELECT predicted FROM cm) c, cm GROUP BY c.c),
pr AS (SELECT CAST(c AS VARCHAR) AS class,
              CASE WHEN pp = 0 THEN 0E0 ELSE CAST(tp AS DOUBLE) / pp END AS precision,
              CASE WHEN support = 0 THEN 0E0 ELSE CAST(tp AS DOUBLE) / support END AS recall,
              support, tp FROM per),
pf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0E0
                      ELSE 2E0 * precision * recall / (precision + recall) END AS f1_score FROM pr),
tot AS (SELECT sum(support) AS total, sum(tp) AS tp_total, avg(precision) AS mp, avg(recall) AS mr,
               avg(f1_score) AS mf, sum(precision * support) / sum(support) AS wp,
               sum(recall * support) / sum(support) AS wr, sum(f1_score * support) / sum(support) AS wf
        FROM pf)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
       CAST(support AS BIGINT) AS support FROM pf
UNION ALL SELECT 'accuracy', NULL, NULL, round(CAST(tp_total AS DOUBLE) / total, 6), CAST(total AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(total AS BIGINT) FROM tot
UNION ALL SELECT 'weighted avg', round(wp, 6), round(wr, 6), round(wf, 6), CAST(total AS BIGINT) FROM tot
"""))
def a13(spark, sf):
    r = classification_report(scored(spark, sf), spec.TARGET, "pred")
    return r.select("class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1_score").alias("f1_score"), "support")
