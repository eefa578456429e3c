"""Gold: the eight published metric tables.

The order base feeds every table and the per-customer aggregate feeds four of
them plus the quantile thresholds, so both are *stage points*: with a
``stage`` function they are materialised once and everything downstream
reads the materialised copy (the published job recomputed the order table
for each of its writes, counts and quantile calls). ``run`` stages to the
shared checkpoint folder with a write + read, which also cuts the lineage: a
lost executor re-reads files instead of recomputing upstream shuffles.

Tables are built on first access, so a caller needing one table does not pay
for the others (e.g. location performance never computes thresholds).
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from gustolake.operators import base, metrics, ranking
from gustolake.plans import jobs
from gustolake.session import scratch_dir
from gustolake.sources import contracts as C
from gustolake.sources import io

GOLD_DATABASE = "gold"
# The silver columns that the gold tables read.
ITEM_COLUMNS = tuple(dict.fromkeys((*base.LINE_KEY, *base.ORDER_KEY, "item_category", "line_revenue")))
OPTION_COLUMNS = (*base.LINE_KEY, "is_discount", "option_revenue")
LINE_COLUMNS = tuple(dict.fromkeys((
    *base.LINE_KEY, *base.ORDER_KEY, "item_category", "total_line_revenue", "total_discount_amount", "has_discount",
)))
# In the silver frames: the lines with their options, staged by order. Order base and sales trends then read these.
ORDER_LINES = "order_lines"
PROFILE_TABLES = ("fact_daily_clv", "fact_rfm_segments", "fact_churn_indicators", "dim_customer")
Stage = Callable[[DataFrame, str], DataFrame]


def no_stage(df: DataFrame, name: str) -> DataFrame:
    return df


checkpoint_stage = ranking.checkpointed


def path_stage(spark: SparkSession, root: str) -> Stage:
    """Write to ``root/<name>`` (Parquet) and read back."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        io.write_layer(df, path)
        return io.read_layer(spark, path)

    return stage


def bucket_stage(spark: SparkSession, root: str, by: str) -> Stage:
    """Write to ``root/<name>`` (Parquet) in buckets of column ``by``, as many as a shuffle has partitions, and read
    back: what is grouped or joined by that column is then not shuffled again.

    Buckets need a catalog entry while the files are written and looked up; it is dropped at once, the files stay."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        entry = f"stage_{name}_{uuid.uuid4().hex[:12]}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        io.write_buckets(df, f"{root.rstrip('/')}/{name}", entry, buckets, by)
        out = spark.table(entry)
        spark.sql(f"DROP TABLE {entry}")
        return out

    return stage


class GoldTables(Mapping[str, DataFrame]):
    """name -> gold table in its published schema, built on first access."""

    NAMES = tuple(C.GOLD_CONTRACTS)

    def __init__(self, silver: dict[str, DataFrame], as_of: dt.date, approx: bool = False,
                 discount_mode: str = "twice", stage: Stage = no_stage):
        self.silver, self.as_of, self.approx = silver, as_of, approx
        self.discount_mode, self.stage = discount_mode, stage
        self._memo: dict[str, DataFrame] = {}
        # tables may be requested from several threads: one lock per key, so that a
        # long stage only holds up those who need it
        self._lock = threading.Lock()
        self._locks: dict[str, threading.RLock] = {}

    def _once(self, key: str, make: Callable[[], DataFrame]) -> DataFrame:
        with self._lock:
            lock = self._locks.setdefault(key, threading.RLock())
        with lock:
            if key not in self._memo:
                self._memo[key] = make()
            return self._memo[key]

    @property
    def orders(self) -> DataFrame:
        def make() -> DataFrame:
            if ORDER_LINES in self.silver:
                df = base.orders(self.silver[ORDER_LINES], self.discount_mode)
            else:
                df = base.build(self.silver, self.discount_mode)
            return self.stage(df, "order_base")

        return self._once("_orders", make)

    @property
    def customers(self) -> DataFrame:
        return self._once(
            "_customers", lambda: self.stage(metrics.customer_base(self.orders, self.as_of), "customer_base")
        )

    @property
    def profile(self) -> DataFrame:
        def make() -> DataFrame:
            materialise = checkpoint_stage if self.stage is no_stage else self.stage
            thr = metrics.thresholds(self.customers, approx=self.approx, stage=materialise)
            if self.stage is not no_stage:
                # eight scalars: fetch once and apply as literals, like the
                # published job's approxQuantile, instead of re-running the
                # quantile plan inside every table that uses them
                thr = thr.first().asDict()
            return self.stage(metrics.customer_profile(self.customers, thr, self.as_of), "customer_profile")

        return self._once("_profile", make)

    def _make(self, name: str) -> DataFrame:
        a = self.as_of
        makers: dict[str, Callable[[], DataFrame]] = {
            "fact_daily_clv": lambda: metrics.clv(self.profile),
            "fact_rfm_segments": lambda: metrics.rfm(self.profile),
            "fact_churn_indicators": lambda: metrics.churn(self.profile),
            "fact_sales_trends": lambda: metrics.sales_trends(
                self.orders, self.silver.get(ORDER_LINES, self.silver["order_items"]), self.silver["date_dim"]
            ),
            "fact_loyalty_comparison": lambda: metrics.loyalty(self.orders, a),
            "fact_location_performance": lambda: metrics.location(
                # the rank counts its input before it runs: materialise the one-row-per-location
                # aggregate even on the lazy path (reliable checkpoint in the shared folder), so the
                # order table is aggregated once, not once for the count and once for the result
                self.orders, a, stage=checkpoint_stage if self.stage is no_stage else self.stage
            ),
            "fact_discount_effectiveness": lambda: metrics.discount(self.orders, a),
            "dim_customer": lambda: metrics.dim_customer(self.profile),
        }
        return io.to_contract_types(makers[name](), C.GOLD_CONTRACTS[name])

    def __getitem__(self, name: str) -> DataFrame:
        if name not in C.GOLD_CONTRACTS:
            raise KeyError(name)
        return self._once(name, lambda: self._make(name))

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)


def build(
    silver: dict[str, DataFrame], as_of: dt.date, approx: bool = False, discount_mode: str = "twice",
    stage: Stage = no_stage,
) -> GoldTables:
    """Gold tables in their published schema (lazy unless ``stage`` materialises)."""
    return GoldTables(silver, as_of, approx, discount_mode, stage)


def run(
    spark: SparkSession,
    silver: dict[str, DataFrame],
    as_of: dt.date,
    gold_root: str,
    database: str | None = GOLD_DATABASE,
    approx: bool = False,
    discount_mode: str = "twice",
    stage_root: str | None = None,
) -> dict[str, DataFrame]:
    """Compute and publish all gold tables; returns name -> published table.

    The staged intermediates are deleted at the end, also after a failure."""
    stage_root = stage_root or scratch_dir(spark, f"gold-stage-{uuid.uuid4().hex[:8]}")
    tables = build(silver, as_of, approx, discount_mode, stage=path_stage(spark, stage_root))
    root = gold_root.rstrip("/")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    try:
        tables.orders  # every table reads the staged order base: stage it first
        # tables needing only the order base first, so they run while the customer
        # profile (aggregate -> thresholds -> labels) is being staged
        order = sorted(tables, key=lambda n: n in PROFILE_TABLES)
        published = jobs.run_all({
            name: (lambda name=name: io.publish(
                spark, tables[name], C.GOLD_CONTRACTS[name], f"{root}/{name}", name, database
            ))
            for name in order
        })
    finally:
        io.delete_folder(spark, stage_root)
    return {name: published[name] for name in tables}
