"""The warehouse: every model by name, wired to the models it reads.

``Warehouse(raw)[name]`` returns a lazy DataFrame; asking for a mart plans the whole chain
from the raw scans. ``build`` materializes the marts, and writes the tables that several
marts read once, to shared storage, so that they are neither recomputed per mart nor lost
with an executor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.operators.joins import plan_bytes
from subscope.plans import conform as c
from subscope.plans import marts as m
from subscope.plans import staging as s
from subscope.schemas import RAW_TABLES
from subscope.session import size_shuffle
from subscope.sources.calendar import date_spine, spine_of
from subscope.sources.raw import read_raw
from subscope.sources.sinks import read_mart, write_mart

CALENDAR_START = "2019-01-01"  # fixed value

STAGED: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "stg_accounts": ("crm_accounts", s.stage_accounts),
    "stg_invoices": ("crm_aos_invoices", s.stage_invoices),
    "stg_addresses": ("crm_addresses", s.stage_addresses),
    "stg_api_logs": ("crm_api_logs", s.stage_api_logs),
    "stg_channel_partners": ("crm_channel_partners", s.stage_channel_partners),
    "stg_corporate_companies": ("crm_corporate_company", s.stage_corporate_companies),
    "stg_countries": ("crm_countries", s.stage_countries),
    "stg_cp_skus": ("crm_cp_skus", s.stage_cp_skus),
    "stg_credit_notes": ("crm_credit_notes", s.stage_credit_notes),
    "stg_devices": ("crm_devices", s.stage_devices),
    "stg_devices_journey": ("crm_devices_journey", s.stage_devices_journey),
    "stg_invoice_line_items": ("crm_invoice_line_items", s.stage_invoice_line_items),
    "stg_master_skus": ("crm_master_skus", s.stage_master_skus),
    "stg_order_items": ("crm_order_items", s.stage_order_items),
    "stg_orders": ("crm_orders", s.stage_orders),
    "stg_payment_history": ("crm_payment_history", s.stage_payment_history),
    "stg_payment_methods": ("crm_payment_methods", s.stage_payment_methods),
    "stg_payments": ("crm_payments", s.stage_payments),
    "stg_programs": ("crm_programs", s.stage_programs),
    "stg_subscription_durations": ("crm_subscription_durations", s.stage_subscription_durations),
    "stg_subscription_pricing": ("crm_subscription_pricing", s.stage_subscription_pricing),
    "stg_subscriptions": ("crm_subscriptions", s.stage_subscriptions),
    "stg_program_skus": ("crm_program_skus", s.stage_program_skus),
    "stg_psp_payment_methods": ("payments_payment_methods", s.stage_psp_payment_methods),
    "stg_psp_payments": ("payments_payments", s.stage_psp_payments),
    "stg_psp_refunds": ("payments_refunds", s.stage_psp_refunds),
    "stg_psp_subscribers": ("payments_subscribers", s.stage_psp_subscribers),
    "stg_psp_subscriptions": ("payments_subscriptions", s.stage_psp_subscriptions),
    "stg_psp_transactions": ("payments_transactions", s.stage_psp_transactions),
}


# Slim variants ("ctx_") of conformed tables: the columns other facts look up, without the
# joins that only serve a table's own mart.
CONTEXT: dict[str, Callable[[Warehouse], DataFrame]] = {
    "ctx_programs": lambda w: c.program_directory(w["stg_programs"], w["int_channel_partners"]),
    "ctx_device_skus": lambda w: w["int_device_skus"],
    "ctx_customer_keys": lambda w: w["stg_accounts"].select("customer_id"),
    "ctx_orders": lambda w: c.order_context(w["stg_orders"], w["ctx_programs"]),
    "ctx_orders_customers": lambda w: c.int_orders(
        w["stg_orders"], w["ctx_programs"], w["ctx_customer_keys"], None
    ),
    "ctx_item_orders": lambda w: c.item_context(w["stg_order_items"], w["ctx_orders"]),
    "ctx_item_skus": lambda w: c.int_order_items(
        w["stg_order_items"], None, w["ctx_device_skus"], w["stg_cp_skus"], w["stg_master_skus"]
    ),
    "ctx_order_items": lambda w: c.item_context(w["ctx_item_skus"], w["ctx_orders"]),
    "ctx_prices": lambda w: c.int_subscriptions(
        w["stg_subscriptions"], w["stg_subscription_pricing"],
        w["stg_subscription_durations"], None,
    ),
    "ctx_subscriptions": lambda w: c.subscription_context(w["ctx_prices"], w["ctx_orders"]),
    "ctx_payments": lambda w: c.int_payments_unified(
        c.int_payments_crm(w["stg_payments"], w["ctx_orders"], w["ctx_customer_keys"]),
        w["int_payments_psp"],
    ),
    "ctx_devices": lambda w: c.int_devices(
        w["stg_devices"], w["ctx_item_orders"], w["stg_subscriptions"]
    ),
}

CONFORMED: dict[str, Callable[[Warehouse], DataFrame]] = {
    "int_channel_partners": lambda w: c.int_channel_partners(w["stg_channel_partners"]),
    "int_customers": lambda w: c.int_customers(w["stg_accounts"], w["stg_corporate_companies"]),
    "int_device_skus": lambda w: c.int_device_skus(w["stg_program_skus"], w["stg_master_skus"]),
    "int_programs": lambda w: c.int_programs(
        w["stg_programs"], w["int_channel_partners"], w["stg_subscriptions"], w["stg_orders"]
    ),
    "int_orders": lambda w: c.int_orders(
        w["stg_orders"], w["ctx_programs"], w["int_customers"], w["stg_payments"]
    ),
    "int_order_items": lambda w: c.item_context(w["ctx_item_skus"], w["ctx_orders_customers"]),
    "int_subscriptions": lambda w: c.subscription_context(
        w["ctx_prices"], w["ctx_orders_customers"]
    ),
    "int_devices": lambda w: c.int_devices(
        w["stg_devices"], w["ctx_order_items"], w["stg_subscriptions"]
    ),
    "int_customer_device_counts": lambda w: c.int_customer_device_counts(
        w["stg_devices"], w["stg_order_items"], w["stg_subscriptions"]
    ),
    "int_subscription_snapshots_monthly": lambda w: c.int_subscription_snapshots_monthly(
        w["ctx_subscriptions"], w.as_of
    ),
    "int_payments_crm": lambda w: c.int_payments_crm(
        w["stg_payments"], w["ctx_orders"], w["stg_accounts"]
    ),
    "int_payments_psp": lambda w: c.int_payments_psp(
        w["stg_psp_payments"], w["stg_psp_transactions"]
    ),
    "int_payments_unified": lambda w: c.int_payments_unified(
        w["int_payments_crm"], w["int_payments_psp"]
    ),
    "int_payment_attempts": lambda w: c.int_payment_attempts(
        w["stg_payment_history"], w["ctx_payments"]
    ),
    "int_invoices": lambda w: c.int_invoices(w["stg_invoices"], w["int_customers"]),
    "int_invoice_line_items": lambda w: c.int_invoice_line_items(
        w["stg_invoice_line_items"], w["ctx_subscriptions"], w["stg_invoices"]
    ),
    "int_credit_notes": lambda w: c.int_credit_notes(
        w["stg_credit_notes"], c.int_invoices(w["stg_invoices"], w["stg_accounts"])
    ),
    "int_refunds": lambda w: c.int_refunds(
        c.int_payments_crm(
            w["stg_payments"].where("is_refunded"), w["ctx_orders"], None
        )
    ),
    "int_finance_reconciliation": lambda w: c.int_finance_reconciliation(
        w["stg_payments"], w["stg_invoices"], w["stg_credit_notes"]
    ),
    "int_partner_api_events": lambda w: c.int_partner_api_events(
        w["stg_api_logs"], w["ctx_orders"], w["stg_subscriptions"], w["stg_accounts"],
        w["int_channel_partners"], w.parent_types,
    ),
}

MARTS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "fct_orders": lambda w: m.fct_orders(c.int_orders(
        w["stg_orders"], w["ctx_programs"], w["ctx_customer_keys"], w["stg_payments"]
    )),
    "fct_order_items": lambda w: m.fct_order_items(w["ctx_order_items"]),
    "dim_customers": lambda w: m.dim_customers(
        w["int_customers"], w["int_customer_device_counts"]
    ),
    "dim_channel_partners": lambda w: m.dim_channel_partners(
        w["int_channel_partners"], w["int_partner_api_events"]
    ),
    "dim_programs": lambda w: m.dim_programs(w["int_programs"]),
    "dim_corporate_companies": lambda w: m.dim_corporate_companies(
        w["stg_corporate_companies"], w["stg_accounts"]
    ),
    "dim_device_skus": lambda w: m.dim_device_skus(w["stg_master_skus"], w["ctx_item_skus"]),
    "dim_dates": lambda w: m.dim_dates(w.spine()),
    "fct_subscriptions": lambda w: m.fct_subscriptions(w["int_subscriptions"]),
    "fct_subscription_monthly_snapshots": lambda w: m.fct_subscription_monthly_snapshots(
        w["int_subscription_snapshots_monthly"]
    ),
    "dim_subscription_pricing": lambda w: m.dim_subscription_pricing(
        w["stg_subscription_pricing"], w["ctx_prices"]
    ),
    "dim_subscription_durations": lambda w: m.dim_subscription_durations(
        w["stg_subscription_durations"], w["ctx_prices"]
    ),
    "fct_payments": lambda w: m.fct_payments(w["ctx_payments"]),
    "fct_payment_attempts": lambda w: m.fct_payment_attempts(w["int_payment_attempts"]),
    "fct_psp_transactions": lambda w: m.fct_psp_transactions(
        w["stg_psp_transactions"], w["stg_psp_payments"]
    ),
    "dim_payment_methods": lambda w: m.dim_payment_methods(
        w["stg_payment_methods"], w["stg_psp_payment_methods"]
    ),
    "fct_invoices": lambda w: m.fct_invoices(
        c.int_invoices(w["stg_invoices"], w["ctx_customer_keys"])
    ),
    "fct_invoice_line_items": lambda w: m.fct_invoice_line_items(c.int_invoice_line_items(
        w["stg_invoice_line_items"], w["stg_subscriptions"].select("subscription_id"),
        w["stg_invoices"],
    )),
    "fct_credit_notes": lambda w: m.fct_credit_notes(
        c.int_credit_notes(w["stg_credit_notes"], w["stg_invoices"])
    ),
    "fct_refunds": lambda w: m.fct_refunds(w["int_refunds"]),
    "fct_finance_reconciliation_monthly": lambda w: m.fct_finance_reconciliation_monthly(
        w["int_finance_reconciliation"]
    ),
    "fct_devices": lambda w: m.fct_devices(w["ctx_devices"]),
    "fct_device_journey_events": lambda w: m.fct_device_journey_events(
        w["stg_devices_journey"], w["ctx_devices"]
    ),
    "fct_partner_api_events": lambda w: m.fct_partner_api_events(w["int_partner_api_events"]),
    "bridge_cp_skus": lambda w: m.bridge_cp_skus(
        w["stg_cp_skus"], w["ctx_device_skus"], w["int_channel_partners"]
    ),
}

# Read by several marts, and more than a narrow step away from the raw tables.
SHARED = (
    "ctx_item_skus", "ctx_prices", "ctx_payments", "ctx_devices", "int_partner_api_events",
)
PARTITIONED = {"fct_subscription_monthly_snapshots": ("snapshot_quarter",)}
AS_OF_STAGED = {"stg_payment_methods"}


class Warehouse:
    """Lazy, memoized models over a source of raw tables."""

    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[str], DataFrame],
        as_of: date | str,
        calendar_start: date | str = CALENDAR_START,
        parent_types: Mapping[str, str] | None = None,
        ready: Mapping[str, DataFrame] | None = None,
    ) -> None:
        self.spark = spark
        self.raw = raw
        self.as_of = date.fromisoformat(str(as_of))
        self.calendar_start = calendar_start
        self.parent_types = parent_types
        self._models: dict[str, DataFrame] = dict(ready or {})
        self._ready = frozenset(ready or ())

    @classmethod
    def over(cls, spark: SparkSession, root: str, as_of: date | str, **kw) -> Warehouse:
        """Over raw parquet tables below ``root``."""
        return cls(spark, lambda table: read_raw(spark, root, table), as_of, **kw)

    @classmethod
    def of_marts(cls, spark: SparkSession, root: str, as_of: date | str) -> Warehouse:
        """Over marts written earlier; reports and metrics then start from those."""
        ready = {n: read_mart(spark, root, n) for n in MARTS}
        return cls(spark, lambda t: read_raw(spark, root, t), as_of, ready=ready)

    def given(self, ready: Mapping[str, DataFrame]) -> Warehouse:
        """The same warehouse, with some models taken as they are."""
        return Warehouse(
            self.spark, self.raw, self.as_of, self.calendar_start, self.parent_types, ready
        )

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._models:
            self._models[name] = self._plan(name)
        return self._models[name]

    def _plan(self, name: str) -> DataFrame:
        if name in STAGED:
            table, stage = STAGED[name]
            raw = self.raw(table)
            return stage(raw, self.as_of) if name in AS_OF_STAGED else stage(raw)
        for models in (CONTEXT, CONFORMED, MARTS):
            if name in models:
                return models[name](self)
        raise KeyError(name)

    def snapshot_subscriptions(self) -> DataFrame | None:
        """Subscriptions to count monthly snapshots from; None where the snapshots are written already."""
        written = {"fct_subscription_monthly_snapshots", "int_subscription_snapshots_monthly"} & self._ready
        return None if written else self["ctx_subscriptions"]

    def spine(self) -> DataFrame:
        """Day spine from the calendar start to a year after ``as_of``, end excluded.

        The start may be a one-row DataFrame, to take it from the data.
        """
        d = self.as_of
        leap = d.month == 2 and d.day == 29
        end = (d - timedelta(days=1) if leap else d).replace(year=d.year + 1)
        if isinstance(self.calendar_start, DataFrame):
            start = F.col(self.calendar_start.columns[0])
            return spine_of(self.calendar_start, start, F.lit(str(end)).cast("date"))
        return date_spine(self.spark, self.calendar_start, end)


def size_for(
    warehouse: Warehouse, scan_bytes: int | None = None, tables: Iterable[str] = tuple(RAW_TABLES)
) -> int:
    """Size the session's shuffles for the largest raw table; returns its bytes.

    The estimate is Catalyst's. Where a session has none (Spark Connect), ``scan_bytes`` must say it.
    """
    if scan_bytes is None:
        sizes = [plan_bytes(warehouse.raw(t)) for t in tables]
        if None in sizes:
            raise ValueError("this session estimates no sizes: pass scan_bytes")
        scan_bytes = max(sizes)
    size_shuffle(warehouse.spark, scan_bytes)
    return scan_bytes


def shared_folder(spark: SparkSession, fallback: str) -> str:
    """Folder for tables shared within one run: the cluster's checkpoint folder if it has
    one, else a place next to the output."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or fallback
    return f"{base.rstrip('/')}/run-{uuid4().hex}"


def build(
    warehouse: Warehouse, out: str, marts: Iterable[str] = tuple(MARTS),
    shared: str | None = None,
) -> dict[str, str]:
    """Full refresh of the marts below ``out``; returns the path of each.

    ``shared`` is where the tables used by several marts go for the run; by default the
    session's checkpoint folder. They can be removed once the marts are written.
    """
    spark = warehouse.spark
    size_for(warehouse)
    folder = shared or shared_folder(spark, f"{out.rstrip('/')}/_shared")
    ready: dict[str, DataFrame] = {}
    for name in SHARED:
        path = write_mart(warehouse.given(ready)[name], folder, name)
        ready[name] = spark.read.parquet(path)
    complete = warehouse.given(ready)
    return {n: write_mart(complete[n], out, n, PARTITIONED.get(n, ())) for n in marts}
