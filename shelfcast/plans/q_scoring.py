"""Queries: online-style scoring features (all series) and cold-start defaults."""

from __future__ import annotations

from shelfcast import config as C
from shelfcast.operators import scoring as SC
from shelfcast.plans import tables as TB
from shelfcast.plans.catalog import register
from shelfcast.plans.sqlbase import case_map, with_ctes

Q = "(1e0 - 2e0 / 29e0)"


def _at(k: int, col: str = "units_sold") -> str:
    return f"max(CASE WHEN pos = n - {k - 1} THEN {col} END)"


def _tail(k: int, fn: str = "avg") -> str:
    return f"{fn}(CASE WHEN pos > n - {k} THEN CAST(units_sold AS DOUBLE) END)"


SCORING_SQL = with_ctes("retail_daily", "inventory_snapshot", extra=[
    ("h", "SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY date DESC) AS rk "
          "FROM retail_daily"),
    ("l", "SELECT *, COUNT(*) OVER (PARTITION BY store_id, product_id) AS n FROM h WHERE rk <= 30"),
    ("l2", "SELECT *, n - rk + 1 AS pos FROM l"),
    ("g", f"""SELECT store_id, product_id, first(n) AS n_rows,
   CAST({_at(1)} AS DOUBLE) AS lag1, CAST({_at(7)} AS DOUBLE) AS lag7, CAST({_at(14)} AS DOUBLE) AS lag14,
   CAST({_at(28)} AS DOUBLE) AS lag28,
   {_tail(7)} AS sales_roll_mean_7, {_tail(14)} AS sales_roll_mean_14, {_tail(28)} AS sales_roll_mean_28,
   {_tail(7, 'stddev_samp')} AS std7,
   SUM(CAST(units_sold AS DOUBLE) * pow({Q}, CAST(n - pos AS DOUBLE))) / SUM(pow({Q}, CAST(n - pos AS DOUBLE)))
     AS sales_ewm_28,
   {_at(1, 'price')} AS price, {_at(1, 'competitor_pricing')} AS competitor,
   CAST({_at(1, 'discount')} AS DOUBLE) AS discount, {_at(1, 'holiday_promotion')} AS holiday_promotion,
   {_at(1, 'demand_forecast')} AS dfl, {_at(1, 'seasonality')} AS seasonality
 FROM l2 GROUP BY store_id, product_id"""),
]) + f"""SELECT g.store_id, g.product_id,
  lag1 AS sales_lag_1, CASE WHEN n_rows >= 7 THEN lag7 ELSE lag1 END AS sales_lag_7,
  CASE WHEN n_rows >= 14 THEN lag14 ELSE lag1 END AS sales_lag_14,
  CASE WHEN n_rows >= 28 THEN lag28 ELSE lag1 END AS sales_lag_28,
  sales_roll_mean_7, sales_roll_mean_14, sales_roll_mean_28,
  CASE WHEN n_rows >= 7 THEN std7 ELSE 0e0 END AS sales_roll_std_7, sales_ewm_28,
  COALESCE(dfl, lag1) AS demand_forecast_lag1,
  CASE WHEN competitor > 0 THEN round_even(price / competitor, 4) ELSE 1e0 END AS price_vs_competitor,
  round_even(price * (1e0 - discount / 100e0), 2) AS effective_price,
  holiday_promotion, discount / 100e0 AS discount, round_even(discount / 100e0 * holiday_promotion, 4) AS discount_x_holiday,
  s.current_stock AS inventory_level, CAST(s.current_stock <= 0 AS INTEGER) AS stockout_flag,
  round_even(sales_roll_mean_7 * s.lead_time_days, 2) AS lead_time_demand, s.lead_time_days,
  CAST(s.current_stock < 50 AS INTEGER) AS reorder_event, lag1 AS y_pred_baseline,
  CAST({case_map('s.category', C.SCORER_CATEGORY_CODES, str(C.SCORER_DEFAULTS['category_enc']))} AS INTEGER)
    AS category_enc,
  CAST({case_map('s.region', C.SCORER_REGION_CODES, str(C.SCORER_DEFAULTS['region_enc']))} AS INTEGER)
    AS region_enc,
  CAST({case_map('seasonality', {'Winter': 0, 'Spring': 1, 'Summer': 2, 'Fall': 3, 'Autumn': 3}, str(C.SCORER_DEFAULTS['seasonality_enc']))} AS INTEGER)
    AS seasonality_enc
FROM g JOIN inventory_snapshot s ON g.store_id = s.store_id AND g.product_id = s.product_id"""


@register("scoring_features", SCORING_SQL)
def q_scoring_features(spark, sf_dir):
    return SC.scoring_features(TB.retail(spark, sf_dir), TB.snapshot(spark, sf_dir), discount_unit="percent")


@register("cold_start_features", with_ctes("inventory_snapshot") + """SELECT store_id, product_id,
  total_units_sold / 30e0 AS sales_lag_1, total_units_sold / 30e0 AS sales_lag_7,
  total_units_sold / 30e0 AS sales_lag_14, total_units_sold / 30e0 AS sales_lag_28,
  total_units_sold / 30e0 AS sales_roll_mean_7, total_units_sold / 30e0 AS sales_roll_mean_14,
  total_units_sold / 30e0 AS sales_roll_mean_28, total_units_sold / 30e0 AS sales_ewm_28,
  total_units_sold / 30e0 AS demand_forecast_lag1, total_units_sold / 30e0 AS y_pred_baseline,
  total_units_sold / 30e0 * 0.1e0 AS sales_roll_std_7,
  COALESCE(current_stock, 0) AS inventory_level, CAST(COALESCE(current_stock, 0) = 0 AS INTEGER) AS stockout_flag,
  COALESCE(lead_time_days, 7) AS lead_time_days, COALESCE(current_stock, 0) * 0.2e0 AS lead_time_demand,
  0 AS reorder_event, 0 AS category_enc, 0 AS region_enc, 0 AS seasonality_enc, 10e0 AS effective_price,
  1e0 AS price_vs_competitor, 0e0 AS discount, 0 AS holiday_promotion, 0e0 AS discount_x_holiday
FROM inventory_snapshot""")
def q_cold_start_features(spark, sf_dir):
    return SC.cold_start_features(TB.snapshot(spark, sf_dir))
