"""Shared SQL text for DuckDB oracles.

The oracle side re-derives every result in plain SQL, independently of the
Spark code, over the same driver tables. Doubles are rounded to 6 digits on
both sides and integer aggregates are cast to BIGINT (FIXTURES.md §2).
"""

from __future__ import annotations

from ..fixtures import RAW_APPLICATIONS_SQL

SCORE_SQL = """
  (CASE WHEN credit_score >= 750 THEN 40 WHEN credit_score >= 650 THEN 20
        WHEN credit_score >= 550 THEN 5 ELSE -20 END
 + CASE WHEN income >= 80000 THEN 25 WHEN income >= 50000 THEN 15
        WHEN income >= 30000 THEN 5 ELSE -10 END
 + CASE WHEN debt_to_income <= 0.2E0 THEN 20 WHEN debt_to_income <= 0.4E0 THEN 10
        WHEN debt_to_income <= 0.6E0 THEN -5 ELSE -20 END
 + CASE WHEN employment_length >= 5 THEN 15 WHEN employment_length >= 2 THEN 10
        WHEN employment_length >= 1 THEN 5 ELSE -5 END
 + CASE WHEN home_ownership = 'OWN' THEN 15 WHEN home_ownership = 'MORTGAGE' THEN 10 ELSE 0 END
 + CASE WHEN income = 0 AND loan_amount > 0 THEN -15
        WHEN income = 0 AND loan_amount < 0 THEN 10
        WHEN income = 0 THEN 0
        WHEN loan_amount / income <= 0.3E0 THEN 10
        WHEN loan_amount / income <= 0.5E0 THEN 5
        WHEN loan_amount / income > 1.0E0 THEN -15 ELSE 0 END)
"""

# raw -> applications (with label) -> features (P5 on unimputed columns)
BASE_CTES = f"""
raw_applications AS ({RAW_APPLICATIONS_SQL}),
applications AS (
  SELECT *, CAST({SCORE_SQL} + (application_id * 104729) % 41 - 20 > 50 AS INTEGER) AS loan_approved
  FROM raw_applications
),
features AS (
  SELECT application_id, application_ts, age, income, employment_length, credit_score,
         debt_to_income, loan_amount, home_ownership, loan_purpose, loan_approved,
         COALESCE(CASE WHEN income = 0 THEN NULL ELSE loan_amount / income END, 0E0) AS loan_to_income_ratio,
         COALESCE(CASE WHEN age = 0 THEN NULL ELSE credit_score / age END, 0E0) AS credit_score_to_age_ratio,
         CASE WHEN age < 0 THEN NULL WHEN age <= 25 THEN 'young' WHEN age <= 35 THEN 'adult'
              WHEN age <= 45 THEN 'middle_age' WHEN age <= 55 THEN 'mature' WHEN age <= 100 THEN 'senior'
              END AS age_category,
         CASE WHEN income < 0 THEN NULL WHEN income <= 30000 THEN 'low' WHEN income <= 50000 THEN 'medium'
              WHEN income <= 80000 THEN 'high' WHEN income > 80000 THEN 'very_high' END AS income_category,
         CASE WHEN credit_score < 0 THEN NULL WHEN credit_score <= 550 THEN 'poor'
              WHEN credit_score <= 650 THEN 'fair' WHEN credit_score <= 750 THEN 'good'
              WHEN credit_score > 750 THEN 'excellent' END AS credit_category,
         CASE WHEN income >= 75000 THEN 1E0 ELSE 0E0 END AS high_income,
         CASE WHEN credit_score >= 750 THEN 1E0 ELSE 0E0 END AS excellent_credit,
         CASE WHEN debt_to_income <= 0.3E0 THEN 1E0 ELSE 0E0 END AS low_debt_ratio,
         CASE WHEN employment_length >= 5 THEN 1E0 ELSE 0E0 END AS experienced_employment
  FROM applications
)
"""


def with_base(body: str) -> str:
    """Prefix a query body with the fixture CTEs; ``extra`` CTEs go first in
    ``body`` as ``, name AS (...)`` continuation when needed."""
    return f"WITH {BASE_CTES}\n{body}"


# --- preprocessing chain in SQL (F1 -> P13 -> F2 -> F3/F4) ----------------------
NUMS = ["age", "income", "employment_length", "credit_score", "debt_to_income", "loan_amount",
        "loan_to_income_ratio", "credit_score_to_age_ratio"]
CATS = ["home_ownership", "loan_purpose", "age_category", "income_category", "credit_category"]
FLAGS = ["high_income", "excellent_credit", "low_debt_ratio", "experienced_employment"]
MODEL_ORDER = ["age", "income", "employment_length", "credit_score", "debt_to_income", "loan_amount",
               "home_ownership", "loan_purpose", "loan_to_income_ratio", "credit_score_to_age_ratio",
               "age_category", "income_category", "credit_category"] + FLAGS


def prep_ctes(src: str = "features", fit_src: str | None = None) -> str:
    """CTEs med, imp, scaler, dict, enc over ``src``; scaler and dictionary
    are fitted on ``fit_src`` (default: the same rows)."""
    fit_src = fit_src or src
    med = ", ".join(f"median({c}) AS {c}" for c in NUMS)
    imp_cols = ", ".join(f"COALESCE(s.{c}, m.{c}) AS {c}" for c in NUMS)
    cat_cols = ", ".join(f"COALESCE(s.{c}, 'unknown') AS {c}" for c in CATS)
    fit_med = ", ".join(f"median({c}) AS {c}" for c in NUMS)
    fit_imp_cols = ", ".join(f"COALESCE(s.{c}, m.{c}) AS {c}" for c in NUMS)
    fit_cat_cols = ", ".join(f"COALESCE(s.{c}, 'unknown') AS {c}" for c in CATS)
    scaler = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) AS mean, "
        f"CASE WHEN stddev_pop({c}) IS NULL OR stddev_pop({c}) = 0 THEN 1E0 ELSE stddev_pop({c}) END AS scale "
        f"FROM fit_imp" for c in NUMS)
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS category FROM fit_imp" for c in CATS)
    keep = ", ".join(f"s.{c}" for c in FLAGS)
    enc = []
    joins = []
    for i, c in enumerate(CATS):
        enc.append(f"CAST(COALESCE(d{i}.code, u{i}.code, 0) AS DOUBLE) AS {c}")
        joins.append(f"LEFT JOIN dict d{i} ON d{i}.feature = '{c}' AND d{i}.category = i.{c} "
                     f"LEFT JOIN dict u{i} ON u{i}.feature = '{c}' AND u{i}.category = 'unknown'")
    std = []
    for i, c in enumerate(NUMS):
        std.append(f"(i.{c} - p{i}.mean) / p{i}.scale AS {c}")
        joins.append(f"JOIN scaler p{i} ON p{i}.feature = '{c}'")
    return f""",
med AS (SELECT {med} FROM {src}),
imp AS (SELECT s.application_id, s.application_ts, s.loan_approved, {imp_cols}, {cat_cols}, {keep}
        FROM {src} s, med m),
fit_med AS (SELECT {fit_med} FROM {fit_src}),
fit_imp AS (SELECT {fit_imp_cols}, {fit_cat_cols} FROM {fit_src} s, fit_med m),
scaler AS ({scaler}),
dseen AS (SELECT feature, category,
                 CAST(row_number() OVER (PARTITION BY feature ORDER BY category) - 1 AS BIGINT) AS code
          FROM (SELECT DISTINCT feature, category FROM ({long}) l WHERE category IS NOT NULL) x),
dict AS (SELECT * FROM dseen UNION ALL
         SELECT feature, 'unknown', CAST(count(*) AS BIGINT) FROM dseen GROUP BY feature
         HAVING sum(CASE WHEN category = 'unknown' THEN 1 ELSE 0 END) = 0),
enc AS (SELECT i.application_id, i.application_ts, i.loan_approved, {", ".join(std)}, {", ".join(enc)},
               {", ".join("i." + c for c in FLAGS)}
        FROM imp i {" ".join(joins)})
"""
