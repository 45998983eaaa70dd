"""Daily-series feature pipeline.

Plan shape (see ``explain``): the snapshot join on (store, product) is a
shuffle join whose hash partitioning on the series keys is reused by every
window below, so the whole pipeline costs one shuffle of the daily table.
All windows share ``partitionBy(store, product)``; lags/rolls/label are one
Window operator over one sort, the EWM adds one more sort on the same
partitioning.  Scalars (median lead time, per-store shares) are tiny
aggregates attached by broadcast.

Scale: a window partition is one series = one row per day, so its length is
bounded by the calendar (a few thousand rows), never by input volume; the
line-level volume is absorbed earlier by the partial aggregation that builds
the daily table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.functions import scalar as S
from shelfcast.functions.ewm import ewm_adjust_false
from shelfcast.functions.joins import attach_row
from shelfcast.session import cut_lineage

KEYS = ["store_id", "product_id"]


def require_columns(df: DataFrame, cols: Sequence[str], what: str = "retail data") -> None:
    """Raise naming the missing columns (metadata only, no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns in {what}: {missing}")


def dedup_keep_first(df: DataFrame, keys: Sequence[str] = ("date", "store_id", "product_id"),
                     order_col: str | None = None, method: str = "series") -> DataFrame:
    """Keep the first row per key by ingest order.

    ``order_col`` is the ingest order.  Without one (a derived table has no
    input order) the survivor is chosen deterministically by a hash of the
    whole row: identical duplicates are interchangeable, and a deterministic
    plan lets Spark reuse exchanges between branches of the same query.

    ``method="series"`` (daily tables): the first key (the date) becomes the
    sort key inside the partition of the others, so the dedup shares the
    series partitioning of the windows that follow (no extra shuffle); a row
    is a duplicate when the previous row of its series has the same date.

    ``method="aggregate"`` (raw, possibly skewed rows): ``min_by`` per key
    with partial aggregation before the shuffle, so a hot key is reduced
    map-side and never lands whole in one task.
    """
    keys = list(keys)
    seq, part = keys[0], keys[1:]
    tmp = "__ingest"
    if order_col is None:
        df = df.withColumn(tmp, F.xxhash64(*[F.col(c) for c in df.columns]))
        order_col = tmp
    if method == "aggregate":
        rest = [c for c in df.columns if c not in keys and c not in (tmp, order_col)]
        first = F.min_by(F.struct(*rest), F.col(order_col)).alias("__first")
        out = df.groupBy(*keys).agg(first).select(*keys, "__first.*")
        return out.select(*[c for c in df.columns if c not in (tmp, order_col)])
    w = Window.partitionBy(*part).orderBy(seq, order_col)
    first = F.row_number().over(w) == 1
    same_as_prev = F.lag(seq, 1).over(w).eqNullSafe(F.col(seq))
    out = (df.withColumn("__keep", first | ~same_as_prev)
             .filter(F.col("__keep")).drop("__keep"))
    return out.drop(tmp) if tmp in out.columns else out


def clip_negatives(df: DataFrame, cols: Sequence[str] = ("units_sold", "inventory_level")) -> DataFrame:
    """Negatives -> 0, nulls stay null."""
    for c in cols:
        df = df.withColumn(c, S.clip_lower(c, 0).cast(df.schema[c].dataType))
    return df


def join_lead_times(retail: DataFrame, snapshot: DataFrame, fill: str = "median",
                    lead_median: DataFrame | None = None) -> DataFrame:
    """J01 + J02: left join lead time per series; fill misses with the row-weighted median.

    Duplicated snapshot keys fan out like a pandas merge.  The median is an
    exact ``percentile`` (its value->count map is bounded by the number of
    distinct lead times); it is taken over the joined rows, re-using the join's
    shuffles, and attached as a one-row broadcast.
    """
    snap = snapshot.select(*KEYS, F.col("lead_time_days").cast("double").alias("lead_time_days"))
    j = retail.join(snap, KEYS, "left")
    if fill != "median":
        return j
    med = (lead_median.select(F.col("lead_median").alias("__lead_median")) if lead_median is not None
           else j.agg(F.percentile(F.col("lead_time_days"), 0.5).alias("__lead_median")))
    return (attach_row(j, med)
            .withColumn("lead_time_days", F.coalesce("lead_time_days", "__lead_median"))
            .drop("__lead_median"))


def store_weights(df: DataFrame, store_col: str = "store_id", counts_col: str | None = None) -> DataFrame:
    """J08/W10 helper: per-store inverse-frequency weight frame (store, sample_weight).

    Shares are taken over the non-null store ids; a store's weight is
    1/max(share, 1e-6) clipped to [0.1, 10].  ``counts_col``: rows stand for that many.
    """
    n = F.count(F.lit(1)) if counts_col is None else F.sum(counts_col)
    counts = df.filter(F.col(store_col).isNotNull()).groupBy(store_col).agg(n.alias("__n"))
    total = counts.agg(F.sum("__n").alias("__total"))
    shares = attach_row(counts, total)
    share = F.col("__n") / F.col("__total")
    w = F.lit(1.0) / F.greatest(share, F.lit(1e-6))
    return shares.select(store_col, S.clip(w, 0.1, 10.0).alias("sample_weight"))


def series_store_weights(df: DataFrame, store_col: str = "store_id",
                         weights: DataFrame | None = None, counts_col: str | None = None) -> DataFrame:
    """One row per series with its store's inverse-frequency weight.

    ``df`` is hash-partitioned by the series keys (the snapshot join), so the
    row count per series is an aggregate with no exchange; per-store shares
    come from that one-row-per-series frame (small), so a hot store is never
    gathered in one task.  ``weights`` (store, sample_weight) overrides the
    shares (incremental runs).
    """
    keys = [store_col, "product_id"] if "product_id" in df.columns else [store_col]
    if counts_col is None:
        per_series = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    else:
        per_series = df.select(*keys, F.col(counts_col).alias("__n"))
    if weights is None:
        per_store = (per_series.filter(F.col(store_col).isNotNull()).groupBy(store_col)
                               .agg(F.sum("__n").alias("__n")))
        total = per_store.agg(F.sum("__n").alias("__total"))
        share = F.col("__n") / F.col("__total")
        weights = attach_row(per_store, total).select(
            store_col, S.clip(F.lit(1.0) / F.greatest(share, F.lit(1e-6)), 0.1, 10.0).alias("sample_weight"))
    return per_series.select(*keys).join(weights, store_col, "inner")


def with_sample_weight(df: DataFrame, store_col: str = "store_id", weights: DataFrame | None = None,
                       series_weights: DataFrame | None = None) -> DataFrame:
    """Join the weights back on the series keys (unseen/null store -> 10).

    Joining on the series keys keeps the big side's hash partitioning and
    sort order (no shuffle of the big side, no sort).
    """
    sw = series_weights if series_weights is not None else series_store_weights(df, store_col, weights)
    keys = [c for c in sw.columns if c != "sample_weight"]
    out = df.join(sw, keys, "left")
    # A store with no share (null id) gets 1/1e-6 clipped to the upper bound.
    return out.withColumn("sample_weight", F.coalesce("sample_weight", F.lit(10.0)))


def _roll(col: str, n: int, min_periods: int, w: Window, fn) -> F.Column:
    frame = w.rowsBetween(-n, -1)
    return F.when(F.count(col).over(frame) >= min_periods, fn(col).over(frame))


def with_series_features(df: DataFrame, horizon: int = 1, value: str = "units_sold",
                         lags: Sequence[int] = (1, 7, 14, 28),
                         means: Sequence[tuple[int, int]] = ((7, 3), (14, 7), (28, 7)),
                         std: tuple[int, int] | None = (7, 3),
                         ewm_span: int = 28, forecast_lag: bool = True,
                         ewm_value: str | None = None) -> DataFrame:
    """W01-W06, W09 (baseline) and the label W05, one window spec for all.

    ``ewm_value`` feeds the EWM from another column (incremental runs put the
    carried EWM state in the first row of a look-back window there).
    """
    w = Window.partitionBy(*KEYS).orderBy("date")
    cols = {}
    for k in lags:
        cols[f"sales_lag_{k}"] = F.lag(value, k).over(w)
    for n, mp in means:
        cols[f"sales_roll_mean_{n}"] = _roll(value, n, mp, w, F.avg)
    if std:
        cols[f"sales_roll_std_{std[0]}"] = _roll(value, std[0], std[1], w, F.stddev_samp)
    if forecast_lag:
        cols["demand_forecast_lag1"] = F.lag("demand_forecast", 1).over(w)
    cols["y"] = F.lead(value, horizon).over(w)
    df = df.withColumns(cols)
    df = ewm_adjust_false(df, ewm_value or value, KEYS, "date", span=ewm_span, out=f"sales_ewm_{ewm_span}")
    if horizon == 1:
        base = F.coalesce(F.col("sales_lag_1"), F.col("sales_lag_7"))
    else:
        base = F.col("sales_lag_7")
    return df.withColumn("y_pred_baseline", base)


def with_row_features(df: DataFrame, discount_unit: str = "percent",
                      category_order: Sequence[str] = C.CATEGORY_ORDER,
                      region_codes: dict = C.REGION_CODES,
                      season_codes: dict = C.SEASON_CODES) -> DataFrame:
    """Per-row pricing, inventory, calendar and encoding columns."""
    return df.withColumns({
        "price_vs_competitor": S.price_ratio("price", "competitor_pricing"),
        "effective_price": S.effective_price("price", "discount", discount_unit),
        "stockout_flag": S.flag(F.col("inventory_level") == 0),
        "reorder_event": S.flag(F.col("units_ordered") > 0),
        "lead_time_demand": S.clip_lower("sales_roll_mean_7", 0) * F.col("lead_time_days"),
        "discount_x_holiday": F.col("discount") * F.col("holiday_promotion"),
        "dow": S.weekday_monday0("date"),
        "month": F.month("date"),
        "is_weekend": (S.weekday_monday0("date") >= 5).cast("int"),
        "category_enc": S.encode_by_list("category", category_order),
        "region_enc": S.encode_by_map("region", region_codes),
        "seasonality_enc": S.encode_by_map("seasonality", season_codes),
    })


def _finish(df: DataFrame, horizon: int, version: str, warmup: str,
            final_cols: Sequence[str], include_created_at: bool, rows: str = "labelled") -> DataFrame:
    # Warm-up rows (no long lag) and tail rows (no label) leave.
    df = df.dropna(subset=[warmup, "y"]) if rows == "labelled" else df.filter(F.col("__latest")).drop("__latest")
    df = df.withColumns({
        "as_of_date": F.col("date"),
        "horizon": F.lit(horizon).cast("int"),
        "pipeline_version": F.lit(version),
        "created_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    })
    # Fixed output schema; absent columns are skipped.
    cols = [c for c in final_cols if c in df.columns and (include_created_at or c != "created_at")]
    return df.select(*cols)


def lead_time_median(retail: DataFrame, snapshot: DataFrame) -> DataFrame:
    """J02 statistic as a one-row frame (``lead_median``) over the joined rows."""
    j = retail.select(*KEYS).join(snapshot.select(*KEYS, F.col("lead_time_days").cast("double")), KEYS, "left")
    return j.agg(F.percentile(F.col("lead_time_days"), 0.5).alias("lead_median"))


def features_v2(retail: DataFrame, snapshot: DataFrame, horizon: int = 1,
                discount_unit: str = "percent", dedup: bool = True,
                include_created_at: bool = True, weights: DataFrame | None = None,
                lead_median: DataFrame | None = None, dedup_method: str = "aggregate",
                ewm_value: str | None = None, keep: Sequence[str] = (), materialize: bool = True,
                order_col: str | None = None, rows: str = "labelled", **code_maps) -> DataFrame:
    """The v2 feature table: 36 columns (35 without ``created_at``).

    ``rows="latest"`` gives the rows to score instead of the rows to learn from: the last
    row of each series, by the same transform, short histories included (their lags are
    null).  Its label lies ``horizon`` days after ``as_of_date`` and is not known yet.

    ``order_col`` is the ingest order that decides between conflicting
    duplicates (P02; the readers' ``_ingest``); it is not part of the result.

    ``weights`` (store, sample_weight) and ``lead_median`` (one row) override
    the two table-wide statistics, for incremental runs over a subset of
    series that must match a full run.
    """
    require_columns(retail, C.REQUIRED_RETAIL, "retail data")
    require_columns(snapshot, C.REQUIRED_SNAPSHOT, "snapshot")
    df = retail
    if dedup:
        df = dedup_keep_first(df, order_col=order_col, method=dedup_method)
    if order_col:
        df = df.drop(order_col)
    df = clip_negatives(df)
    df = join_lead_times(df, snapshot, fill="none")
    # The joined daily table is materialised once (reliable checkpoint in the
    # shared folder): the table-wide statistics and the windows all read it,
    # so the line-level aggregation behind it runs once, and a lost executor
    # never re-runs it.  Both statistics come from one small frame of rows
    # per (series, lead time): the row-weighted median lead time is a
    # frequency-weighted percentile of it, the store shares are sums over it.
    if materialize:
        df = cut_lineage(df)
    stats = df.groupBy(*KEYS, "lead_time_days").agg(F.count(F.lit(1)).alias("__n"))
    if lead_median is None:
        lead_median = stats.agg(F.percentile(F.col("lead_time_days"), F.lit(0.5), F.col("__n"))
                                .alias("lead_median"))
    df = (attach_row(df, lead_median.select(F.col("lead_median").alias("__lead_median")))
          .withColumn("lead_time_days", F.coalesce("lead_time_days", "__lead_median")).drop("__lead_median"))
    per_series = stats.groupBy(*KEYS).agg(F.sum("__n").alias("__n"))
    sw = series_store_weights(per_series, weights=weights, counts_col="__n")
    df = df.withColumn("series_id", F.concat_ws("_", F.col("store_id").cast("string"),
                                                  F.col("product_id").cast("string")))
    df = with_series_features(df, horizon, ewm_value=ewm_value)
    if rows == "latest":
        df = df.withColumn("__latest", F.lead("date", 1).over(Window.partitionBy(*KEYS).orderBy("date")).isNull())
    df = with_row_features(df, discount_unit, **code_maps)
    df = with_sample_weight(df, series_weights=sw)
    return _finish(df, horizon, C.PIPELINE_VERSION, "sales_lag_28", list(C.FINAL_COLS) + list(keep),
                   include_created_at, rows)


V1_FEATURES = [
    "sales_lag_1", "sales_lag_7", "sales_lag_14",
    "sales_roll_mean_7", "sales_roll_mean_14", "sales_roll_mean_28",
    "sales_ewm_28", "dow", "month",
    "price", "discount", "holiday_promotion",
    "competitor_pricing", "weather_condition", "seasonality",
    "inventory_level", "units_ordered",
    "y_pred_baseline", "sample_weight",
]
V1_FINAL = C.META_COLS + C.ID_COLS + V1_FEATURES + C.LABEL_COLS
V1_REQUIRED = ["date", "store_id", "product_id", "units_sold", "inventory_level", "price",
               "discount", "holiday_promotion", "competitor_pricing", "weather_condition",
               "seasonality", "units_ordered"]


def features_v1(retail: DataFrame, horizon: int = 1, dedup: bool = True,
                include_created_at: bool = True, order_col: str | None = None) -> DataFrame:
    """The older feature set (lags 1/7/14, raw columns, warm-up on lag-14)."""
    require_columns(retail, V1_REQUIRED, "retail data")
    df = dedup_keep_first(retail, order_col=order_col, method="aggregate") if dedup else retail
    df = df.drop(order_col) if order_col else df
    df = cut_lineage(clip_negatives(df))          # one pass over the source, see features_v2
    sw = series_store_weights(df)
    df = with_series_features(df, horizon, lags=(1, 7, 14), std=None, forecast_lag=False)
    df = df.withColumns({"dow": S.weekday_monday0("date"), "month": F.month("date"),
                         "series_id": F.concat_ws("_", "store_id", "product_id")})
    df = with_sample_weight(df, series_weights=sw)
    return _finish(df, horizon, C.PIPELINE_VERSION_V1, "sales_lag_14", V1_FINAL, include_created_at)


def feature_summary(features: DataFrame) -> DataFrame:
    """Number of series and date range of a feature table (one row)."""
    return features.agg(F.count(F.lit(1)).alias("n_rows"),
                        F.countDistinct("series_id").alias("n_series"),
                        F.min("as_of_date").alias("min_date"),
                        F.max("as_of_date").alias("max_date"))
