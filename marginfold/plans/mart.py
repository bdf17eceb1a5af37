"""The whole model as lazy DataFrames over seven raw tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from marginfold.operators import dims, fact, reports, staging
from marginfold.params import DEFAULT_PARAMS, EconomicsParams


class Mart:
    """Every staging table, the fact, dimensions and reports, composed but not run.

    The fact here is built without the staging filters on lines and payments: its own joins with
    the completed orders do the same, one shuffle cheaper.
    """

    def __init__(self, raw: Mapping[str, DataFrame], params: EconomicsParams = DEFAULT_PARAMS):
        self.raw, self.params = raw, params

    @cached_property
    def completed(self) -> DataFrame:
        return staging.completed_orders(self.raw["orders"], self.params)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stage_orders(self.raw["orders"], self.params)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stage_order_items(self.raw["order_items"], self.completed, self.raw["products"])

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.stage_payments(self.raw["order_payments"], self.completed, self.params)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stage_products(self.raw["products"])

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stage_customers(self.raw["customers"])

    @cached_property
    def stg_marketing_leads(self) -> DataFrame:
        return staging.stage_leads(self.raw["marketing_qualified_leads"])

    @cached_property
    def stg_closed_deals(self) -> DataFrame:
        return staging.stage_deals(self.raw["closed_deals"], self.raw["marketing_qualified_leads"])

    @cached_property
    def funnel(self) -> DataFrame:
        return staging.channel_funnel(
            self.stg_marketing_leads, self.stg_closed_deals, self.stg_customers, self.completed
        )

    @cached_property
    def stg_channel_summary(self) -> DataFrame:
        return staging.attach_spend(self.funnel, self.params.monthly_spend)

    @cached_property
    def _lines(self) -> DataFrame:
        return staging.line_economics(self.raw["order_items"], self.raw["products"])

    @cached_property
    def _prices(self) -> DataFrame:
        return staging.line_prices(self.raw["order_items"])

    @cached_property
    def _payments(self) -> DataFrame:
        return staging.payments_by_order(self.raw["order_payments"], self.params)

    @cached_property
    def fact_base(self) -> DataFrame:
        return fact.fact_base(
            self._lines,
            self.stg_orders,
            self.stg_customers,
            self._payments,
            fact.channel_cac(self.stg_channel_summary),
            self.params,
            self._prices,
        )

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return fact.fact_order_items(
            self._lines,
            self.stg_orders,
            self.stg_customers,
            self._payments,
            self.stg_channel_summary,
            self.params,
            self._prices,
        )

    @cached_property
    def dim_products(self) -> DataFrame:
        return dims.dim_products(self.stg_products)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dims.dim_customers(self.stg_customers, self.stg_orders)

    @cached_property
    def summary_by_month(self) -> DataFrame:
        return reports.summary_by_month(self.fact_order_items)

    @cached_property
    def rpt_category_profitability(self) -> DataFrame:
        return reports.category_profitability(self.fact_order_items)

    @cached_property
    def rpt_loss_making_orders(self) -> DataFrame:
        return reports.loss_making_orders(self.fact_order_items)

    @cached_property
    def rpt_customer_profitability(self) -> DataFrame:
        return reports.customer_profitability(self.fact_order_items)

    @cached_property
    def rpt_cac_by_channel(self) -> DataFrame:
        return reports.cac_by_channel(self.fact_order_items, self.stg_channel_summary)

    @cached_property
    def rpt_profit_waterfall(self) -> DataFrame:
        return reports.profit_waterfall(self.fact_order_items)

    @property
    def staging_tables(self) -> dict[str, DataFrame]:
        return {
            "stg_orders": self.stg_orders,
            "stg_order_items": self.stg_order_items,
            "stg_order_payments": self.stg_order_payments,
            "stg_products": self.stg_products,
            "stg_customers": self.stg_customers,
            "stg_marketing_leads": self.stg_marketing_leads,
            "stg_closed_deals": self.stg_closed_deals,
            "stg_channel_summary": self.stg_channel_summary,
        }

    @property
    def reports(self) -> dict[str, DataFrame]:
        return {
            "rpt_category_profitability": self.rpt_category_profitability,
            "rpt_loss_making_orders": self.rpt_loss_making_orders,
            "rpt_customer_profitability": self.rpt_customer_profitability,
            "rpt_cac_by_channel": self.rpt_cac_by_channel,
            "rpt_profit_waterfall": self.rpt_profit_waterfall,
        }

    @property
    def analytics_tables(self) -> dict[str, DataFrame]:
        return {
            "fact_order_items": self.fact_order_items,
            "summary_by_month": self.summary_by_month,
            **self.reports,
        }
