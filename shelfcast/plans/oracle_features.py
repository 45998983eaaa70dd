"""Oracle SQL: feature family (DuckDB)."""

from __future__ import annotations

from shelfcast import config as C
from shelfcast.plans.sqlbase import case_map, with_ctes


def _roll(n: int, mp: int, fn: str = "avg") -> str:
    f = f"(s ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(units_sold) OVER {f} >= {mp} THEN {fn}(units_sold) OVER {f} END"


def _cat_enc(col: str) -> str:
    return case_map(col, {c: i for i, c in enumerate(C.CATEGORY_ORDER)}, "-1")


JOINED = """
  SELECT r.*, CAST(s.lead_time_days AS DOUBLE) AS lead_time_days
  FROM retail_daily r LEFT JOIN inventory_snapshot s USING (store_id, product_id)
"""

FILLED = """
  SELECT j.* REPLACE (COALESCE(j.lead_time_days, m.med) AS lead_time_days),
         j.store_id || '_' || j.product_id AS series_id
  FROM j, (SELECT median(lead_time_days) AS med FROM j) m
"""

WEIGHTS = """
  SELECT store_id,
         LEAST(GREATEST(1e0 / GREATEST(n * 1e0 / SUM(n) OVER (), 1e-6), 0.1e0), 10e0) AS sample_weight
  FROM (SELECT store_id, COUNT(*) AS n FROM f WHERE store_id IS NOT NULL GROUP BY store_id) c
"""


def _windows(horizon: int, lags=(1, 7, 14, 28), std=True, fc=True) -> str:
    cols = [f"lag(units_sold, {k}) OVER s AS sales_lag_{k}" for k in lags]
    cols += [f"{_roll(7, 3)} AS sales_roll_mean_7", f"{_roll(14, 7)} AS sales_roll_mean_14",
             f"{_roll(28, 7)} AS sales_roll_mean_28"]
    if std:
        cols.append(f"{_roll(7, 3, 'stddev_samp')} AS sales_roll_std_7")
    if fc:
        cols.append("lag(demand_forecast, 1) OVER s AS demand_forecast_lag1")
    cols.append(f"lead(units_sold, {horizon}) OVER s AS y")
    cols.append("sum(CASE WHEN rn = 1 THEN 1e0 ELSE 2e0 / 29e0 END * units_sold * pow(29e0 / 27e0, rn)) "
                "OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
                "* pow(27e0 / 29e0, rn - 1) AS sales_ewm_28")
    return (f"SELECT *, {', '.join(cols)} FROM "
            "(SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY date) AS rn FROM f) x "
            "WINDOW s AS (PARTITION BY store_id, product_id ORDER BY date)")


def features_v2_sql(horizon: int = 1, partial: bool = False) -> str:
    base = "COALESCE(sales_lag_1, sales_lag_7)" if horizon == 1 else "sales_lag_7"
    body = f"""
SELECT date AS as_of_date, series_id, CAST({horizon} AS INTEGER) AS horizon, '2.0' AS pipeline_version,
       store_id, product_id,
       sales_lag_1, sales_lag_7, sales_lag_14, sales_lag_28,
       sales_roll_mean_7, sales_roll_mean_14, sales_roll_mean_28, sales_roll_std_7, sales_ewm_28,
       demand_forecast_lag1,
       price / CASE WHEN competitor_pricing < 0.01 THEN 0.01 ELSE competitor_pricing END AS price_vs_competitor,
       price * (1e0 - discount / 100e0) AS effective_price,
       holiday_promotion, discount, discount * holiday_promotion AS discount_x_holiday,
       CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(month(date) AS INTEGER) AS month,
       CAST(isodow(date) - 1 >= 5 AS INTEGER) AS is_weekend,
       inventory_level, CAST(COALESCE(inventory_level = 0, false) AS INTEGER) AS stockout_flag,
       CASE WHEN sales_roll_mean_7 < 0 THEN 0 ELSE sales_roll_mean_7 END * lead_time_days AS lead_time_demand,
       lead_time_days, CAST(COALESCE(units_ordered > 0, false) AS INTEGER) AS reorder_event,
       CAST({_cat_enc('category')} AS INTEGER) AS category_enc,
       CAST({case_map('region', C.REGION_CODES, '-1')} AS INTEGER) AS region_enc,
       CAST({case_map('seasonality', C.SEASON_CODES, '-1')} AS INTEGER) AS seasonality_enc,
       {base} AS y_pred_baseline,
       COALESCE(wt.sample_weight, 10e0) AS sample_weight,
       y
FROM w LEFT JOIN wt USING (store_id)
WHERE sales_lag_28 IS NOT NULL AND y IS NOT NULL
"""
    return with_ctes("retail_daily", "inventory_snapshot", partial=partial,
                     extra=[("j", JOINED), ("f", FILLED), ("wt", WEIGHTS), ("w", _windows(horizon))]) + body


def features_v1_sql(horizon: int = 1) -> str:
    base = "COALESCE(sales_lag_1, sales_lag_7)" if horizon == 1 else "sales_lag_7"
    body = f"""
SELECT date AS as_of_date, series_id, CAST({horizon} AS INTEGER) AS horizon, '1.0' AS pipeline_version,
       store_id, product_id,
       sales_lag_1, sales_lag_7, sales_lag_14,
       sales_roll_mean_7, sales_roll_mean_14, sales_roll_mean_28, sales_ewm_28,
       CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(month(date) AS INTEGER) AS month,
       price, discount, holiday_promotion, competitor_pricing, weather_condition, seasonality,
       inventory_level, units_ordered,
       {base} AS y_pred_baseline, COALESCE(wt.sample_weight, 10e0) AS sample_weight, y
FROM w LEFT JOIN wt USING (store_id)
WHERE sales_lag_14 IS NOT NULL AND y IS NOT NULL
"""
    f = "SELECT r.*, r.store_id || '_' || r.product_id AS series_id FROM retail_daily r"
    return with_ctes("retail_daily", extra=[("f", f), ("wt", WEIGHTS),
                                            ("w", _windows(horizon, (1, 7, 14), std=False, fc=False))]) + body


def feature_summary_sql() -> str:
    return ("WITH ff AS (" + features_v2_sql(1) + ")\n"
            "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT series_id) AS n_series, "
            "MIN(as_of_date) AS min_date, MAX(as_of_date) AS max_date FROM ff")
