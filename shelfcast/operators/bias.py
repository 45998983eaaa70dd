"""Slice bias operators.

Slices are unpivoted into (slice_col, slice_val) pairs — one explode of an
array of structs — and aggregated in one group-by with partial aggregation,
so a slice value holding a third of the rows is reduced map side.  The
overall metrics are a one-row aggregate attached by broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast import config as C
from shelfcast.functions import scalar as S
from shelfcast.functions.joins import attach_row

# Names of the encoder's codes: its maps, read backwards.  Codes the encoder gives to
# values it does not know are a slice of their own.
UNKNOWN = {-1: "Unknown"}
MODEL_SLICE_MAPS = {
    "category_enc": dict(enumerate(C.CATEGORY_ORDER)) | UNKNOWN,
    "region_enc": {code: name for name, code in C.REGION_CODES.items()} | UNKNOWN,
    "seasonality_enc": {code: name for name, code in C.SEASON_CODES.items()} | UNKNOWN,
}


def _err_cols(y: str, pred: str) -> dict[str, Column]:
    ok = F.col(y).isNotNull() & F.col(pred).isNotNull()
    err = (F.col(y) - F.col(pred)).cast("double")
    ape = F.when(ok & (F.col(y) != 0), F.abs(err / F.col(y).cast("double")))
    return {"_ok": ok, "_ae": F.when(ok, F.abs(err)), "_ape": ape}


def slice_performance(df: DataFrame, slice_cols: Sequence[str] = C.BIAS_SLICE_COLUMNS,
                      y: str = "y", pred: str = "y_pred_baseline",
                      ratio: float = C.BIAS_RATIO) -> DataFrame:
    """B01 (A12, U04): per slice value rows, share, MAE, MAPE, MAE ratio and flag.

    Null slice values and slices without a usable (y, pred) row are skipped;
    the MAE ratio is null when the overall MAE is 0 (then every slice is
    flagged, as an infinite ratio would be).
    """
    cols = [c for c in slice_cols if c in df.columns]
    base = df.select(*cols, y, pred).withColumns(_err_cols(y, pred))
    overall = base.agg(F.count(F.lit(1)).alias("total_rows"),
                       F.count_if("_ok").alias("overall_count"),
                       F.avg("_ae").alias("overall_mae"),
                       (F.avg("_ape") * F.lit(100.0)).alias("overall_mape"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("slice_col"),
                                         F.col(c).cast("string").alias("slice_val")) for c in cols]))
    long = base.select(pairs.alias("p"), "_ok", "_ae", "_ape").select("p.*", "_ok", "_ae", "_ape") \
               .filter(F.col("slice_val").isNotNull())
    g = long.groupBy("slice_col", "slice_val").agg(
        F.count(F.lit(1)).alias("sample_count"), F.count_if("_ok").alias("usable"),
        F.avg("_ae").alias("mae"), (F.avg("_ape") * F.lit(100.0)).alias("mape"))
    g = attach_row(g.filter(F.col("usable") > 0), overall)
    r = F.when(F.col("overall_mae") > 0, F.col("mae") / F.col("overall_mae"))
    return g.select("slice_col", "slice_val", "sample_count",
                    (F.col("sample_count") / F.col("total_rows")).alias("sample_ratio"),
                    "mae", "mape", r.alias("mae_ratio"),
                    F.coalesce(r > F.lit(ratio), F.lit(True)).alias("bias_flag"),
                    "overall_mae", "overall_mape", "overall_count")


def mitigation_plan(perf: DataFrame, min_samples: int = C.MIN_SLICE_SAMPLES) -> DataFrame:
    """The mitigation plan in long form, one row per (slice column, slice value).

    Each row carries the inverse weight, the low-sample / high-bias flags and
    its recommendation sentences (at most two); the column-level counts and
    priority come from one aggregate per slice column joined back.  The plan
    is not folded into one map per column: a slice column such as the product
    id has as many values as there are products, and that group must not be
    gathered in one task.  Inverse weights divide by (slices + 1), as the
    source counts its overall entry among the slices (D11).
    """
    per_col = perf.groupBy("slice_col").agg(
        F.count(F.lit(1)).alias("n_slices"),
        F.count_if(F.col("sample_count") < min_samples).alias("low_sample_slices"),
        F.count_if("bias_flag").alias("high_bias_slices"))
    pr = (F.when((F.col("low_sample_slices") > 0) & (F.col("high_bias_slices") > 0), "high")
           .when((F.col("low_sample_slices") > 0) | (F.col("high_bias_slices") > 0), "medium")
           .otherwise("low"))
    per_col = per_col.withColumn("priority", pr)
    p = perf.join(per_col, "slice_col", "inner")
    low = F.col("sample_count") < min_samples
    weight = F.lit(1.0) / F.greatest(F.col("sample_count") / (F.col("n_slices") + 1), F.lit(0.01))
    msg_low = F.when(low, F.format_string(
        "%s has only %d rows: collect or oversample.",
        F.col("slice_val"), F.col("sample_count")))
    ratio_txt = F.when(F.col("mae_ratio").isNull(), F.lit("None")).otherwise(
        F.format_string("%.2f", F.col("mae_ratio")))
    msg_bias = F.when(F.col("bias_flag"), F.format_string(
        "%s is predicted worse than average (error ratio %s): look for features that explain it.",
        F.col("slice_val"), ratio_txt))
    return p.select("slice_col", "slice_val", "sample_count", low.alias("low_sample"),
                    F.col("bias_flag").alias("high_bias"), weight.alias("weight"),
                    F.filter(F.array(msg_low, msg_bias), lambda m: m.isNotNull()).alias("recommendations"),
                    "low_sample_slices", "high_bias_slices", "priority")


def bias_summary(perf: DataFrame, min_samples: int = C.MIN_SLICE_SAMPLES) -> DataFrame:
    """Slices analysed, flagged, low-sample (the overall entry counts too, D11)."""
    per_col = perf.groupBy("slice_col").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bias_flag").alias("f"),
        F.count_if(F.col("sample_count") < min_samples).alias("l"),
        F.first("overall_count").alias("oc"))
    return per_col.agg(
        F.sum("n").cast("long").alias("total_slices_analyzed"),
        F.sum("f").cast("long").alias("high_bias_slices"),
        (F.sum("l") + F.count_if(F.col("oc") < min_samples)).cast("long").alias("low_sample_slices"))


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "prediction",
                       group: Sequence[str] = (), mape_mask: str = "positive", digits: int = 4) -> DataFrame:
    """MAE, RMSE, MAPE, R2 (= 1 - SSE/SST), n; rounded half-even to ``digits``.

    One aggregate (per group if given): SST from sums as sum(y^2) - n*mean^2
    would cancel badly, so it uses ``var_pop(y) * n``.  MAPE over y > 0
    (training) or y != 0 (pipeline), D10.
    """
    yv, pv = F.col(y).cast("double"), F.col(pred).cast("double")
    e = yv - pv
    mask = yv > 0 if mape_mask == "positive" else yv != 0
    aggs = [F.avg(F.abs(e)).alias("_mae"), F.sqrt(F.avg(e * e)).alias("_rmse"),
            (F.avg(F.when(mask, F.abs(e / yv))) * F.lit(100.0)).alias("_mape"),
            F.sum(e * e).alias("_sse"), (F.var_pop(yv) * F.count(yv)).alias("_sst"),
            F.count(F.lit(1)).alias("n")]
    g = df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)
    r2 = F.when(F.col("_sst") > 0, F.lit(1.0) - F.col("_sse") / F.col("_sst"))
    return g.select(*group,
                    S.round_half_even("_mae", digits).alias("mae"),
                    S.round_half_even("_rmse", digits).alias("rmse"),
                    S.round_half_even("_mape", digits).alias("mape"),
                    S.round_half_even(r2, digits).alias("r2"), "n")


def model_slice_bias(df: DataFrame, pred: str, y: str = "y",
                     slice_maps: Mapping[str, Mapping[int, str]] | None = None,
                     min_rows: int = C.MODEL_BIAS_MIN_ROWS,
                     threshold: float = C.MODEL_BIAS_RATIO - 1.0) -> DataFrame:
    """B04 (+B05 text): per decoded slice MAE/RMSE/R2/n vs overall; flag disparity > 25%."""
    maps = MODEL_SLICE_MAPS if slice_maps is None else slice_maps
    maps = {c: m for c, m in maps.items() if c in df.columns}
    entries = []
    for c, m in maps.items():
        pairs = []
        for code, name in m.items():
            pairs += [F.lit(int(code)), F.lit(name)]
        entries.append(F.struct(F.lit(c).alias("slice_col"),
                                F.element_at(F.create_map(*pairs), F.col(c).cast("int")).alias("slice_val")))
    long = df.select(F.explode(F.array(*entries)).alias("p"), y, pred).select("p.*", y, pred) \
             .filter(F.col("slice_val").isNotNull())
    per = regression_metrics(long, y, pred, group=["slice_col", "slice_val"]).filter(F.col("n") >= min_rows)
    overall = regression_metrics(df, y, pred).select(F.col("mae").alias("overall_mae"))
    j = attach_row(per, overall)
    disp = F.when(F.col("overall_mae") > 0, (F.col("mae") - F.col("overall_mae")) / F.col("overall_mae"))
    flagged = F.coalesce(disp > F.lit(threshold), F.lit(False))
    pct = S.round_half_even(disp * F.lit(100.0), 1)
    text = F.when(flagged, F.format_string(
        "%s=%s: error %s%% above average; give the slice more weight, a model or features of its own.",
        F.col("slice_col"), F.col("slice_val"), pct.cast("string")))
    return j.select("slice_col", "slice_val", "mae", "rmse", "r2", "n", "overall_mae",
                    flagged.alias("flagged"), F.when(flagged, pct).alias("disparity_pct"),
                    text.alias("mitigation"))
