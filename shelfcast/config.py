"""Fixed values and default thresholds.

Everything here is configuration data, not logic. Values marked FIXED must
equal the ones the source application uses, otherwise results differ.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source application's values)
# ---------------------------------------------------------------------------

# Stores and their regions, in natural order.
STORE_REGIONS = {
    "S001": "Northeast",
    "S002": "Southeast",
    "S003": "Midwest",
    "S004": "West",
    "S005": "Southwest",
}

# Product -> category, products P0001..P0020 in natural order.
PRODUCT_CATEGORIES = {
    "P0001": "Snacks", "P0002": "Snacks",
    "P0003": "Beverages", "P0004": "Beverages",
    "P0005": "Dairy", "P0006": "Dairy",
    "P0007": "Beverages", "P0008": "Frozen Foods",
    "P0009": "Personal Care", "P0010": "Snacks",
    "P0011": "Household", "P0012": "Household",
    "P0013": "Bakery", "P0014": "Bakery",
    "P0015": "Produce", "P0016": "Produce",
    "P0017": "Meat", "P0018": "Meat",
    "P0019": "Canned Goods", "P0020": "Canned Goods",
}

WEATHER_CONDITIONS = ["Sunny", "Rainy", "Cloudy", "Snowy", "Windy"]

# Ordinal encodings used by the v2 feature pipeline (unknown -> -1).
CATEGORY_ORDER = ["Groceries", "Snacks", "Beverages", "Household", "Personal Care"]
REGION_CODES = {"North": 0, "South": 1, "East": 2, "West": 3, "Central": 4}
SEASON_CODES = {"Winter": 0, "Spring": 1, "Summer": 2, "Autumn": 3}

# Encodings used by the online scorer (D2), with their defaults for unknowns.
SCORER_CATEGORY_CODES = {"Snacks": 0, "Beverages": 1, "Dairy": 2, "Frozen Foods": 3, "Personal Care": 4,
                         "Household": 5, "Bakery": 6, "Produce": 7, "Meat": 8, "Canned Goods": 9}
SCORER_REGION_CODES = {"Northeast": 0, "Southeast": 1, "Midwest": 2, "West": 3, "Southwest": 4}
SCORER_SEASON_CODES = {"Winter": 0, "Spring": 1, "Summer": 2, "Fall": 3}
# Our tables say "Autumn" where the scorer says "Fall".
SCORER_SEASON_ALIASES = {"Autumn": 3}
SCORER_DEFAULTS = {"category_enc": 0, "region_enc": 0, "seasonality_enc": 1}

# Month -> season (12,1,2 winter; 3-5 spring; 6-8 summer; 9-11 autumn).
SEASON_OF_MONTH = {12: "Winter", 1: "Winter", 2: "Winter",
                   3: "Spring", 4: "Spring", 5: "Spring",
                   6: "Summer", 7: "Summer", 8: "Summer",
                   9: "Autumn", 10: "Autumn", 11: "Autumn"}

# Vendor minimum order quantities (test-data derivation).
MIN_ORDER_QTYS = [50, 100, 200, 250, 500]

# Inventory KPI thresholds.
N_DAYS = 365
CRITICAL_DAYS = 14
LOW_DAYS = 45
HEALTH_CLASSES = ["critical", "low", "healthy"]

# Days-of-supply bands of the health heat map (<=7, <=14, <=30, <=60, >60).
HEATMAP_BANDS = [(7, "≤7d"), (14, "≤14d"), (30, "≤30d"), (60, "≤60d")]
HEATMAP_LAST_BAND = "60d+"

# Trend projection: (days back, number of points).
TREND_RANGES = [(7, 7), (30, 10), (90, 13), (180, 12), (365, 13)]

# Data-quality defaults.
MISSING_THRESHOLD = 0.02
Z_THRESHOLD = 3.0
PCT_LOW, PCT_HIGH = 0.001, 0.999
OUTLIER_SHARE_THRESHOLD = 0.01
OUTLIER_COLUMNS = ["units_sold", "y", "price", "inventory_level"]
GAP_DAYS = 1

# Bias defaults.
BIAS_RATIO = 1.2
MIN_SLICE_SAMPLES = 100
MODEL_BIAS_RATIO = 1.25
MODEL_BIAS_MIN_ROWS = 10
BIAS_SLICE_COLUMNS = ["holiday_promotion", "seasonality_enc", "category_enc",
                      "region_enc", "store_id", "product_id"]

# Splits.
TRAIN_FRAC, VAL_FRAC = 0.80, 0.10
N_FOLDS, FOLD_GAP_DAYS, FOLD_VAL_DAYS = 5, 14, 60

# FIXED VALUES: columns standard-scaled for the tree model (fit on train only).
SCALED_COLUMNS = [
    "sales_lag_1", "sales_lag_7", "sales_lag_14", "sales_lag_28",
    "sales_roll_mean_7", "sales_roll_mean_14", "sales_roll_mean_28",
    "sales_roll_std_7", "sales_ewm_28", "demand_forecast_lag1",
    "price_vs_competitor", "effective_price",
    "inventory_level", "lead_time_demand", "y_pred_baseline",
]

# FIXED VALUES: model features used for training (27 features + series code).
TRAIN_FEATURES = [
    "sales_lag_1", "sales_lag_7", "sales_lag_14", "sales_lag_28",
    "sales_roll_mean_7", "sales_roll_mean_14", "sales_roll_mean_28",
    "sales_roll_std_7", "sales_ewm_28", "demand_forecast_lag1",
    "price_vs_competitor", "effective_price",
    "holiday_promotion", "discount", "discount_x_holiday",
    "dow", "month", "is_weekend",
    "inventory_level", "stockout_flag", "lead_time_demand",
    "lead_time_days", "reorder_event",
    "category_enc", "region_enc", "seasonality_enc",
    "y_pred_baseline", "series_enc",
]

# Registry.
PROMOTION_MIN_GAIN = 0.05
MIN_SERIES_HISTORY = 30

PIPELINE_VERSION = "2.0"
PIPELINE_VERSION_V1 = "1.0"

# FIXED VALUES: column order of the v2 feature table (meta, ids, features, label).
META_COLS = ["as_of_date", "series_id", "horizon", "pipeline_version", "created_at"]
ID_COLS = ["store_id", "product_id"]
FEATURE_COLS = [
    "sales_lag_1", "sales_lag_7", "sales_lag_14", "sales_lag_28",
    "sales_roll_mean_7", "sales_roll_mean_14", "sales_roll_mean_28",
    "sales_roll_std_7", "sales_ewm_28",
    "demand_forecast_lag1",
    "price_vs_competitor", "effective_price",
    "holiday_promotion", "discount", "discount_x_holiday",
    "dow", "month", "is_weekend",
    "inventory_level", "stockout_flag", "lead_time_demand",
    "lead_time_days", "reorder_event",
    "category_enc", "region_enc", "seasonality_enc",
    "y_pred_baseline", "sample_weight",
]
LABEL_COLS = ["y"]
FINAL_COLS = META_COLS + ID_COLS + FEATURE_COLS + LABEL_COLS

# FIXED VALUES: required input columns (schema check P01).
REQUIRED_RETAIL = [
    "date", "store_id", "product_id", "category", "region",
    "units_sold", "inventory_level", "units_ordered",
    "demand_forecast", "price", "discount",
    "holiday_promotion", "competitor_pricing", "seasonality",
]
REQUIRED_SNAPSHOT = ["store_id", "product_id", "lead_time_days"]

# FIXED VALUES: display names of the source application (for readers of its files).
DISPLAY_NAMES = {
    "Date": "date", "Store ID": "store_id", "Product ID": "product_id",
    "Category": "category", "Region": "region",
    "Inventory Level": "inventory_level", "Units Sold": "units_sold",
    "Units Ordered": "units_ordered", "Demand Forecast": "demand_forecast",
    "Price": "price", "Discount": "discount",
    "Weather Condition": "weather_condition",
    "Holiday/Promotion": "holiday_promotion",
    "Competitor Pricing": "competitor_pricing", "Seasonality": "seasonality",
    "Current Stock": "current_stock", "Total Units Sold": "total_units_sold",
    "Total Units Received": "total_units_received", "Lead Time Days": "lead_time_days",
}
