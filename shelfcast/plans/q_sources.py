"""Queries: change detection on the daily table."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.plans import tables as TB
from shelfcast.plans.catalog import register
from shelfcast.plans.sqlbase import with_ctes
from shelfcast.sources import readers as RD


@register("fingerprint", with_ctes("retail_daily")
          + "SELECT COUNT(*) AS row_count, CAST(MAX(date) AS VARCHAR) AS max_date FROM retail_daily")
def q_fingerprint(spark, sf_dir):
    return RD.fingerprint(TB.retail(spark, sf_dir))


@register("fingerprint_changed", with_ctes("retail_daily") + """SELECT c.row_count, c.max_date,
  NOT (c.row_count IS NOT DISTINCT FROM l.row_count AND c.max_date IS NOT DISTINCT FROM l.max_date) AS changed
FROM (SELECT COUNT(*) AS row_count, CAST(MAX(date) AS VARCHAR) AS max_date FROM retail_daily) c,
     (SELECT COUNT(*) AS row_count, CAST(MAX(date) AS VARCHAR) AS max_date FROM retail_daily
      WHERE date < (SELECT MAX(date) FROM retail_daily)) l""")
def q_fingerprint_changed(spark, sf_dir):
    """S11 decision: the table against its state before the last day arrived."""
    r = TB.retail(spark, sf_dir)
    last_day = r.agg(F.max("date").alias("_m"))
    from shelfcast.functions.joins import attach_row
    before = attach_row(r, last_day).filter(F.col("date") < F.col("_m")).drop("_m")
    return RD.fingerprint_changed(RD.fingerprint(r), RD.fingerprint(before))
