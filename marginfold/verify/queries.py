"""Every operator as a query over a folder of star-schema tables."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marginfold.functions.money import money
from marginfold.operators import checks, fact, views
from marginfold.params import DEFAULT_PARAMS
from marginfold.plans.build import BuildResult, run_all
from marginfold.plans.mart import Mart
from marginfold.schemas import ORDER_MONEY, RAW_COLUMNS
from marginfold.sources.csv_raw import load_raw
from marginfold.sources.layers import COMPRESSION, Layer, read_table, stored_counts
from marginfold.sources.scratch import scratch_folder, shuffles_freed, written
from marginfold.sources.tpch import StarTables

Query = Callable[[SparkSession, str], DataFrame]


def comparable(frame: DataFrame) -> DataFrame:
    """Result types every engine prints alike: decimals as text with all their places, times to the microsecond."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.LongType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        return column

    return frame.select(*[plain(f) for f in frame.schema])


_made: dict[tuple, object] = {}
_making = threading.RLock()


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what a folder holds: another state means other tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in entries))


def _once(spark: SparkSession, folder: str, what: str, make: Callable[[], object]):
    """What several queries over a folder share, made on first use in a Spark application.

    It is made anew when a file of the folder was added, removed or changed.
    """
    key = (spark.sparkContext.applicationId, folder, what)
    state = _state(spark, folder)
    with _making:
        if key not in _made or _made[key][0] != state:
            _made[key] = (state, make())
        return _made[key][1]


class _RawOnDemand(Layer):
    """The canonical raw tables of a folder, each written when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._root = scratch_folder(spark)
        self._tables = StarTables(spark, folder)
        super().__init__(spark, self._root, "raw", list(RAW_COLUMNS))

    def __getitem__(self, name: str) -> DataFrame:
        with _making:
            if name in RAW_COLUMNS and name not in self._open:
                self._tables.write(name, self._root)
            return super().__getitem__(name)

    def source(self, name: str) -> DataFrame:
        """The table as written, or as derived where it was not asked for yet, to be read once."""
        return self[name] if name in self._open else getattr(self._tables, name)()

    def release(self) -> None:
        """Delete what sources were derived from; their frames end here, written tables stay."""
        with _making:
            self._tables.release()


def raw_layer(spark: SparkSession, folder: str) -> _RawOnDemand:
    return _once(spark, folder, "raw", lambda: _RawOnDemand(spark, folder))


def mart(spark: SparkSession, folder: str) -> Mart:
    return _once(spark, folder, "mart", lambda: Mart(raw_layer(spark, folder)))


class _StoredMart(Mart):
    """A mart whose fact is written once, for queries that read it several times."""

    def __init__(self, raw):
        super().__init__(raw)
        self.fact_order_items = written(super().fact_order_items, compression=COMPRESSION)


def stored_mart(spark: SparkSession, folder: str) -> Mart:
    return _once(spark, folder, "stored mart", lambda: _StoredMart(raw_layer(spark, folder)))


def _on_mart(build: Callable[[Mart], DataFrame]) -> Query:
    return lambda spark, folder: comparable(build(mart(spark, folder)))


def _on_stored_mart(build: Callable[[Mart], DataFrame]) -> Query:
    return lambda spark, folder: comparable(build(stored_mart(spark, folder)))


def _table(name: str) -> Query:
    return _on_mart(lambda m: getattr(m, name))


def _totals(m: Mart) -> DataFrame:
    return fact.order_totals(m._prices.join(m.completed.select("order_id"), "order_id", "left_semi"))


def _base(m: Mart) -> DataFrame:
    return _decimals(m.fact_base.drop("_whole", "_half"))


def _decimals(lines: DataFrame) -> DataFrame:
    """The cents, hundredths and millionths inside the fact build, as decimals."""
    amounts = (
        "item_revenue item_cogs logistics_cost return_cost order_payment_fee"
        " order_total_revenue channel_cac payment_fee discount_allocated cac_allocation"
        " contribution_margin contribution_margin_pct net_profit net_margin_pct"
    ).split()
    out = {c: money(c, ORDER_MONEY) for c in amounts if c in lines.columns}
    if "item_revenue_share" in lines.columns:
        out["item_revenue_share"] = F.expr("cast(item_revenue_share as decimal(9,0)) * 0.000001BD")
    return lines.withColumns(out)


def _allocated(m: Mart) -> DataFrame:
    lines = fact.revenue_share(m.fact_base)
    lines = fact.allocate_by_revenue_share(lines, "order_payment_fee", "payment_fee")
    lines = fact.allocate_by_revenue_share(lines, "order_discount", "discount_allocated")
    return _decimals(
        lines.select("order_id", "order_item_id", "item_revenue_share", "payment_fee", "discount_allocated")
    )


def _cac_allocated(m: Mart) -> DataFrame:
    lines = fact.allocate_cac(m.fact_base)
    return _decimals(lines.select("order_id", "order_item_id", "is_first_order", "channel_cac", "cac_allocation"))


def _cascade(m: Mart) -> DataFrame:
    return _decimals(
        fact.cost_cascade(fact.allocate_costs(m.fact_base)).select(
            "order_id",
            "order_item_id",
            "contribution_margin",
            "contribution_margin_pct",
            "net_profit",
            "net_margin_pct",
            "is_profit_leak",
        )
    )


# Rows of a CSV file at most.
_CSV_ROWS = 1_000_000


def _csv_copy(spark: SparkSession, folder: str) -> str:
    """The canonical tables of ``folder`` as CSV sources with a header, one folder of gzip files per table.

    A gzip file is read by one task, so no file gets more than ``_CSV_ROWS`` rows.
    """

    def write() -> str:
        target = scratch_folder(spark)
        raw = raw_layer(spark, folder)
        for name in raw:
            frame = raw.source(name)
            text = frame.select(*[_source_text(f).alias(f.name) for f in frame.schema]).write
            with shuffles_freed(spark):
                (
                    text.option("header", True)
                    .option("escape", '"')
                    .option("compression", "gzip")
                    .option("maxRecordsPerFile", _CSV_ROWS)
                    .csv(f"{target}/{DEFAULT_PARAMS.csv_files[name]}")
                )
        raw.release()
        return target

    return _once(spark, folder, "csv", write)


def _source_text(field: T.StructField):
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(field.name, "yyyy-MM-dd HH:mm:ss")
    return F.col(field.name).cast("string")


def _loaded(spark: SparkSession, folder: str) -> tuple[DataFrame, Mart]:
    """The status rows of a CSV ingestion, and the model over the tables it loaded."""

    def load() -> tuple[DataFrame, Mart]:
        root = scratch_folder(spark)
        status = load_raw(spark, _csv_copy(spark, folder), root)
        return status, Mart(Layer(spark, root, "raw", list(RAW_COLUMNS)))

    return _once(spark, folder, "loaded", load)


def _load_raw(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_loaded(spark, folder)[0].select("table_name", "file", "status", "row_count"))


def _staged_from_loaded(name: str) -> Query:
    return lambda spark, folder: comparable(getattr(_loaded(spark, folder)[1], name))


def _built(spark: SparkSession, folder: str) -> tuple[BuildResult, str]:
    """The results of a whole build from CSV files, and the folder it wrote."""

    def build() -> tuple[BuildResult, str]:
        root = scratch_folder(spark)
        return run_all(spark, _csv_copy(spark, folder), root), root

    return _once(spark, folder, "built", build)


def _run_all(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_built(spark, folder)[0].counts)


def _on_kept_counts(build: Callable, layer: str, names: Iterable[str]) -> Query:
    """A check over tables that the build wrote, from the counts kept with them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        root = _built(spark, folder)[1]
        return comparable(build(Layer(spark, root, layer, list(names)), stored_counts(spark, root, layer, names)))

    return run


def _built_table(name: str) -> Query:
    return lambda spark, folder: comparable(read_table(spark, _built(spark, folder)[1], "analytics", name))


def _all_tables(m: Mart) -> dict[str, DataFrame]:
    return {f"staging.{n}": t for n, t in m.staging_tables.items()} | {
        f"analytics.{n}": t for n, t in m.analytics_tables.items()
    }


def _summary(m: Mart) -> DataFrame:
    return checks.reconciliation_summary(
        m.raw["order_items"],
        m.raw["orders"],
        m.stg_order_payments,
        m.fact_order_items,
        m.reports,
        m.params,
    )


def _ordered(name: str) -> Query:
    return _on_mart(lambda m: views.in_report_order(name, getattr(m, name)))


# Queries on what ingestion loaded and what the build wrote, by the query that gives the same rows.
LOADED = {
    "b41_loaded_orders": ("stg_orders", "b01_stage_orders"),
    "b41_loaded_order_items": ("stg_order_items", "b02_stage_order_items"),
    "b41_loaded_order_payments": ("stg_order_payments", "b03_stage_payments"),
    "b41_loaded_products": ("stg_products", "b04_stage_products"),
    "b41_loaded_customers": ("stg_customers", "b05_stage_customers"),
    "b41_loaded_leads": ("stg_marketing_leads", "b06_stage_leads"),
    "b41_loaded_deals": ("stg_closed_deals", "b07_stage_deals"),
}
BUILT = {
    "b51_built_fact": ("fact_order_items", "b17_fact_order_items"),
    "b51_built_months": ("summary_by_month", "b20_summary_by_month"),
    "b51_built_categories": ("rpt_category_profitability", "b21_category_profitability"),
    "b51_built_loss_orders": ("rpt_loss_making_orders", "b22_loss_making_orders"),
    "b51_built_customers": ("rpt_customer_profitability", "b23_customer_profitability"),
    "b51_built_channels": ("rpt_cac_by_channel", "b24_cac_by_channel"),
    "b51_built_waterfall": ("rpt_profit_waterfall", "b25_profit_waterfall"),
}


# The reports whose completeness is checked.
_REPORTS = [name for name in views.REPORT_ORDER if name.startswith("rpt_")]

# Checks from kept counts, by the query that gives the same rows.
KEPT = {
    "b33_kept_completeness": "b33_report_completeness",
    "b34_kept_min_rows": "b34_check_min_rows",
    "b35_kept_not_null": "b35_check_not_null",
}


def queries() -> dict[str, Query]:
    return {
        "b01_stage_orders": _table("stg_orders"),
        "b02_stage_order_items": _table("stg_order_items"),
        "b03_stage_payments": _table("stg_order_payments"),
        "b04_stage_products": _table("stg_products"),
        "b05_stage_customers": _table("stg_customers"),
        "b06_stage_leads": _table("stg_marketing_leads"),
        "b07_stage_deals": _table("stg_closed_deals"),
        "b08_channel_funnel": _table("funnel"),
        "b09_attach_spend": _table("stg_channel_summary"),
        "b10_order_totals": _on_mart(_totals),
        "b11_return_costs": _on_mart(lambda m: fact.return_costs(m._lines, m.stg_orders)),
        "b12_channel_cac": _on_mart(lambda m: fact.channel_cac(m.stg_channel_summary)),
        "b13_fact_base": _on_mart(_base),
        "b14_allocate_by_revenue_share": _on_mart(_allocated),
        "b15_allocate_cac": _on_mart(_cac_allocated),
        "b16_cost_cascade": _on_mart(_cascade),
        "b17_fact_order_items": _table("fact_order_items"),
        "b18_dim_products": _table("dim_products"),
        "b19_dim_customers": _table("dim_customers"),
        "b20_summary_by_month": _table("summary_by_month"),
        "b21_category_profitability": _table("rpt_category_profitability"),
        "b22_loss_making_orders": _table("rpt_loss_making_orders"),
        "b23_customer_profitability": _table("rpt_customer_profitability"),
        "b24_cac_by_channel": _table("rpt_cac_by_channel"),
        "b25_profit_waterfall": _table("rpt_profit_waterfall"),
        "b26_reconcile_revenue": _on_mart(
            lambda m: checks.reconcile_revenue(m.raw["order_items"], m.raw["orders"], m.fact_order_items)
        ),
        "b27_reconcile_fee": _on_mart(lambda m: checks.reconcile_fee(m.fact_order_items, m.stg_order_payments)),
        "b28_reconcile_discount": _on_mart(lambda m: checks.reconcile_discount(m.fact_order_items, m.stg_orders)),
        "b29_check_cac_rules": _on_mart(lambda m: checks.check_cac_rules(m.fact_order_items)),
        "b30_check_return_rules": _on_mart(lambda m: checks.check_return_rules(m.fact_order_items)),
        "b31_check_cascade": _on_mart(lambda m: checks.check_cascade(m.fact_order_items)),
        "b32_sanity_summary": _on_mart(lambda m: checks.sanity_summary(m.fact_order_items)),
        "b33_report_completeness": _on_stored_mart(lambda m: checks.report_completeness(m.reports)),
        "b33_kept_completeness": _on_kept_counts(
            lambda tables, known: checks.report_completeness(tables, known), "analytics", _REPORTS
        ),
        "b34_check_min_rows": _on_mart(lambda m: checks.check_min_rows(m.raw)),
        "b34_kept_min_rows": _on_kept_counts(
            lambda tables, known: checks.check_min_rows(tables, known=known), "raw", RAW_COLUMNS
        ),
        "b35_check_not_null": _on_mart(lambda m: checks.check_required_columns(m.raw)),
        "b35_kept_not_null": _on_kept_counts(
            lambda tables, known: checks.check_required_columns(tables, known=known), "raw", RAW_COLUMNS
        ),
        "b36_check_staging_filter": _on_mart(lambda m: checks.check_staging_filter(m.stg_orders)),
        "b37_check_cogs": _on_mart(lambda m: checks.check_cogs(m.stg_order_items, m.stg_order_payments)),
        "b38_check_fact_integrity": _on_mart(lambda m: checks.check_fact_integrity(m.fact_order_items)),
        "b39_business_sanity": _on_mart(lambda m: checks.business_sanity(m.fact_order_items)),
        "b40_reconciliation_summary": _on_stored_mart(_summary),
        "b40_overall_verdict": _on_stored_mart(lambda m: checks.overall_verdict(_summary(m))),
        "b41_load_raw": _load_raw,
        **{query: _staged_from_loaded(name) for query, (name, _) in LOADED.items()},
        "b42_table_counts": _on_stored_mart(lambda m: views.table_counts(_all_tables(m))),
        "b43_channel_cac_report": _on_mart(lambda m: views.channel_cac_report(m.stg_channel_summary)),
        "b44_category_summary": _on_mart(lambda m: views.category_summary(m.rpt_category_profitability)),
        "b45_channel_economics": _on_mart(lambda m: views.channel_economics(m.rpt_cac_by_channel)),
        "b46_fact_explorer": _on_mart(lambda m: views.fact_explorer(m.fact_order_items)),
        "b47_monthly_averages": _on_mart(lambda m: views.monthly_averages(m.summary_by_month)),
        "b48_leak_breakdown": _on_mart(lambda m: views.leak_breakdown(m.rpt_profit_waterfall)),
        "b49_quick_stats": _on_mart(lambda m: views.quick_stats(m.fact_order_items)),
        "b50_waterfall_steps": _on_mart(lambda m: views.waterfall_steps(m.rpt_profit_waterfall)),
        "b51_run_all": _run_all,
        **{query: _built_table(name) for query, (name, _) in BUILT.items()},
        **{f"b52_ordered_{name}": _ordered(name) for name in views.REPORT_ORDER},
        # The fact is read once, for its key, so it is not written first.
        "q1_check_key": _on_mart(
            lambda m: checks.check_primary_keys({**m.staging_tables, "fact_order_items": m.fact_order_items})
        ),
    }
