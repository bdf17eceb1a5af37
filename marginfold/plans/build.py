"""CSV files to finished reports, one written layer after the other."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from marginfold.operators import checks, dims, fact, reports, staging, views
from marginfold.operators.rollup import order_rows
from marginfold.params import DEFAULT_PARAMS, EconomicsParams
from marginfold.plans.together import together
from marginfold.schemas import RAW_COLUMNS
from marginfold.sources.csv_raw import load_raw
from marginfold.sources.layers import COMPRESSION, read_table, stored_counts, write_table
from marginfold.sources.scratch import discard, scratch_folder, written


@dataclass(frozen=True)
class BuildResult:
    """Small result frames of a build; the tables themselves are under its output folder."""

    ingest: DataFrame
    counts: DataFrame
    channel_cac: DataFrame
    waterfall: DataFrame
    categories: DataFrame
    channels: DataFrame
    checks: DataFrame


def build_staging(spark: SparkSession, root: str, params: EconomicsParams = DEFAULT_PARAMS) -> dict[str, DataFrame]:
    """Write the staging layer from the raw one."""
    raw = {name: read_table(spark, root, "raw", name) for name in RAW_COLUMNS}

    def keep(name: str, frame: DataFrame) -> DataFrame:
        return write_table(frame, root, "staging", name)

    orders = keep("stg_orders", staging.stage_orders(raw["orders"], params))
    frames = {
        "stg_order_items": staging.stage_order_items(raw["order_items"], orders, raw["products"]),
        "stg_order_payments": staging.stage_payments(raw["order_payments"], orders, params),
        "stg_products": staging.stage_products(raw["products"]),
        "stg_customers": staging.stage_customers(raw["customers"]),
        "stg_marketing_leads": staging.stage_leads(raw["marketing_qualified_leads"]),
        "stg_closed_deals": staging.stage_deals(raw["closed_deals"], raw["marketing_qualified_leads"]),
    }
    kept = together(spark, {name: partial(keep, name, frame) for name, frame in frames.items()})
    tables = {"stg_orders": orders, **kept}
    funnel = staging.channel_funnel(
        tables["stg_marketing_leads"], tables["stg_closed_deals"], tables["stg_customers"], orders
    )
    tables["stg_channel_summary"] = keep("stg_channel_summary", staging.attach_spend(funnel, params.monthly_spend))
    return tables


def build_analytics(
    stage: dict[str, DataFrame], root: str, params: EconomicsParams = DEFAULT_PARAMS
) -> dict[str, DataFrame]:
    """Write the fact once, fold it to orders once, then write every report from the two."""
    base = fact.fact_base(
        stage["stg_order_items"],
        stage["stg_orders"],
        stage["stg_customers"],
        stage["stg_order_payments"],
        fact.channel_cac(stage["stg_channel_summary"]),
        params,
    )
    # Written first, so that the joins' shuffles are gone when the base moves: together they were the most
    # that a build holds on disk. The base is narrower than the lines made from it, so it is what moves to its month.
    spark = base.sparkSession
    joined = scratch_folder(spark)
    lines = fact.lines_of(written(base, joined, COMPRESSION).hint("rebalance", "order_month"))
    stored = write_table(lines, root, "analytics", "fact_order_items", partition_by="order_month", rebalanced=True)
    discard(spark, joined)
    scratch = scratch_folder(spark)
    orders = written(order_rows(stored), scratch, COMPRESSION)
    tables = {
        "summary_by_month": reports.summary_by_month(stored, orders),
        "rpt_category_profitability": reports.category_profitability(stored),
        "rpt_loss_making_orders": reports.loss_making_orders(stored, orders),
        "rpt_customer_profitability": reports.customer_profitability(stored, orders),
        "rpt_cac_by_channel": reports.cac_by_channel(stored, stage["stg_channel_summary"], orders),
        "rpt_profit_waterfall": reports.profit_waterfall(stored),
    }
    built = together(spark, {name: partial(write_table, frame, root, "analytics", name) for name, frame in tables.items()})
    discard(spark, scratch)
    return {"fact_order_items": stored, **built}


def register_views(stage: dict[str, DataFrame]) -> None:
    """The two dimension views, over the staging tables."""
    dims.dim_products(stage["stg_products"]).createOrReplaceTempView("dim_products")
    dims.dim_customers(stage["stg_customers"], stage["stg_orders"]).createOrReplaceTempView("dim_customers")


def run_all(
    spark: SparkSession, csv_folder: str, root: str, params: EconomicsParams = DEFAULT_PARAMS
) -> BuildResult:
    """Ingest, staging, analytics, reports and headline checks; an error stops the build."""
    ingest = load_raw(spark, csv_folder, root, params.csv_files)
    stage = build_staging(spark, root, params)
    built = build_analytics(stage, root, params)
    register_views(stage)
    named = {f"staging.{n}": t for n, t in stage.items()} | {f"analytics.{n}": t for n, t in built.items()}
    known = {"staging": stored_counts(spark, root, "staging", stage), "analytics": stored_counts(spark, root, "analytics", built)}
    labelled = {f"{layer}.{n}": counts for layer, tables in known.items() for n, counts in tables.items()}
    return BuildResult(
        ingest=ingest,
        counts=views.table_counts(named, labelled),
        channel_cac=views.channel_cac_report(stage["stg_channel_summary"]),
        waterfall=built["rpt_profit_waterfall"],
        categories=views.category_summary(built["rpt_category_profitability"]),
        channels=views.channel_economics(built["rpt_cac_by_channel"]),
        checks=checks.reconciliation_summary(
            read_table(spark, root, "raw", "order_items"),
            read_table(spark, root, "raw", "orders"),
            stage["stg_order_payments"],
            built["fact_order_items"],
            built,
            params,
            known["analytics"],
        ),
    )
