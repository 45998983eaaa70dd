"""The derived retail tables of one test-data folder, by name (lazy; nothing is cached here)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.sources import testdata as T


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.retail_daily(spark, sf_dir)


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.inventory_snapshot(spark, sf_dir)


def partial_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot without S005 x P0020 (``lead_time_join`` and ``order_rejects`` need a miss)."""
    return T.inventory_snapshot(spark, sf_dir, drop_missing=True)


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.vendors(spark, sf_dir)


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.order_headers(spark, sf_dir)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.order_lines(spark, sf_dir)


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.conversation_turns(spark, sf_dir)
