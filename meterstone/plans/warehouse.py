"""The warehouse: sources in, dimensions and facts out, all lazy."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstone.plans import dimensions, operations, quality, receivables, reliability, staging, usage
from meterstone.settings import Settings

TABLES = (
    "dim_date", "dim_rate", "dim_premise", "dim_geography", "dim_customer",
    "fact_bill", "fact_payment", "fact_ar_monthly", "fact_ar_customer",
    "fact_outage", "fact_ami_daily", "fact_work_order", "fact_service_order",
    "fact_interaction", "fact_payment_plan", "dq_summary",
)

#: What bucketed tables are dealt by.
BUCKET_KEYS = {"fact_bill": "bill_id", "fact_payment": "bill_id", "dim_customer": "customer_id", "fact_ar_customer": "customer_id"}


class Warehouse:
    """Datasets by name over typed extracts.

    ``sources`` maps extract names (``ERCH``, ``towns``, ...) to DataFrames with
    the curated types. Each property builds a plan once and runs nothing.
    ``store`` writes tables to Parquet and continues from the files, so many
    reports can share one computation.
    """

    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame], cfg: Settings = Settings()):
        self.spark, self.src, self.cfg = spark, sources, cfg

    def store(self, folder: str, tables: Iterable[str] = TABLES, buckets: int = 0, only: Mapping[str, Iterable[str]] = {}) -> "Warehouse":
        """Write tables below ``folder`` and go on from the files; ``only`` names the columns of a table whose others nobody reads.

        With ``buckets`` the tables of ``BUCKET_KEYS`` become bucketed tables of the session's catalog (their files lie in
        ``folder`` as well): bills and payments of a bill are in the same bucket, so the ledger joins and sums them
        without moving either. Open items are written once, in month folders, when both balances are stored: the monthly
        balances read all of them and the balances of the business date its month only.
        """
        tables, base = list(tables), folder.rstrip("/")
        for name in tables:
            if name == "fact_ar_monthly" and "fact_ar_customer" in tables and self.cfg.window_start <= self.cfg.as_of <= self.cfg.window_end:
                items = self.open_items
                items.hint("rebalance", "me").write.mode("overwrite").partitionBy("me").parquet(f"{base}/open_items")
                self.__dict__["open_items"] = self.spark.read.schema(items.schema).parquet(f"{base}/open_items").select(*items.columns)
                self.__dict__["fact_ar_monthly"] = receivables.fact_ar_monthly(self.open_items, self.dim_customer)
                self.__dict__["open_items_as_of"] = self.open_items.filter(F.col("me") == F.lit(self.cfg.as_of))
            if name in only:
                self.__dict__[name] = getattr(self, name).select(*only[name])
            self.__dict__[name] = self._stored(name, f"{base}/{name}", buckets)
            # reports go on from the stored fact
            if name == "fact_payment":
                owner = self.dim_customer.select("customer_id", *receivables.OWNER)
                self.__dict__["owned_payments"] = self.fact_payment.join(owner, "customer_id")
            if name == "fact_ami_daily":
                place = self.dim_premise.select("premise_id", *usage.PLACE)
                self.__dict__["placed_reads"] = self.fact_ami_daily.join(place, "premise_id")
        return self

    def _stored(self, name: str, path: str, buckets: int) -> DataFrame:
        df, key = getattr(self, name), BUCKET_KEYS.get(name)
        if not buckets or key is None:
            # no rebalance: it would move every row once more, and readers split large files
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
            return self.spark.read.parquet(path)
        table = f"{name}_{uuid.uuid4().hex}"
        # one file a bucket: the shuffle deals by the same hash as the buckets
        df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
        return self.spark.table(table)

    # staging
    @cached_property
    def customer(self):
        return staging.customer(self.src["BUT000"], self.src["FKKVKP"])

    @cached_property
    def premise(self):
        return staging.premise(self.src["EVBS"], self.src["ADRC"], self.src["towns"])

    @cached_property
    def installation(self):
        return staging.installation(self.src["EANL"], self.src["EQUI"])

    @cached_property
    def contract(self):
        return staging.contract(self.src["EVER"])

    @cached_property
    def bill(self):
        return staging.bill(self.src["ERCH"])

    @cached_property
    def payment(self):
        return staging.payment(self.src["DFKKZP"])

    @cached_property
    def payment_plan(self):
        return staging.payment_plan(self.src["ZINSTPLAN"])

    @cached_property
    def service_order(self):
        return staging.service_order(self.src["ZSRVORD"])

    @cached_property
    def work_order(self):
        return staging.work_order(self.src["AUFK"])

    @cached_property
    def outage(self):
        return staging.outage(self.src["outage_events"])

    @cached_property
    def interaction(self):
        return staging.interaction(self.src["interactions"])

    @cached_property
    def ami_read(self):
        return staging.ami_read(self.src["daily_reads"])

    @cached_property
    def weather(self):
        return staging.weather(self.src["daily_weather"])

    @cached_property
    def rate(self):
        return staging.rate(self.src["rate_schedules"])

    # dimensions
    @cached_property
    def dim_rate(self):
        return self.rate

    @cached_property
    def dim_premise(self):
        return dimensions.dim_premise(self.premise, self.installation)

    @cached_property
    def dim_geography(self):
        return dimensions.dim_geography(self.src["towns"], self.dim_premise)

    @cached_property
    def dim_customer(self):
        return dimensions.dim_customer(self.customer, self.contract, self.installation, self.dim_premise, self.cfg)

    @cached_property
    def event_days(self):
        return reliability.event_days(self.outage, self.dim_geography, self.cfg)

    @cached_property
    def dim_date(self):
        return dimensions.dim_date(self.spark, self.cfg, self.weather, self.event_days)

    # facts
    @cached_property
    def fact_bill(self):
        return receivables.fact_bill(self.bill)

    @cached_property
    def owned_payments(self):
        return receivables.owned_payments(self.payment, self.dim_customer)

    @cached_property
    def fact_payment(self):
        return receivables.fact_payment(self.owned_payments)

    @cached_property
    def open_spans(self):
        return receivables.open_spans(self.fact_bill, self.fact_payment, self.cfg.window_start, self.cfg.window_end)

    @cached_property
    def open_items(self):
        return receivables.items_of_spans(self.open_spans)

    @cached_property
    def open_items_as_of(self):
        cfg = self.cfg
        if cfg.window_start <= cfg.as_of <= cfg.window_end:
            return receivables.items_of_spans(receivables.spans_at(self.open_spans, cfg.as_of)).filter(F.col("me") == F.lit(cfg.as_of))
        return receivables.open_items_as_of(self.fact_bill, self.fact_payment, cfg)

    @cached_property
    def fact_ar_monthly(self):
        return receivables.ar_monthly_of_spans(self.open_spans, self.dim_customer)

    @cached_property
    def fact_ar_customer(self):
        return receivables.fact_ar_customer(self.open_items_as_of)

    @cached_property
    def fact_outage(self):
        return reliability.fact_outage(self.outage, self.dim_date)

    @cached_property
    def placed_reads(self):
        return usage.placed_reads(self.ami_read, self.dim_premise, self.cfg)

    @cached_property
    def fact_ami_daily(self):
        return usage.fact_ami_daily(self.placed_reads)

    @cached_property
    def fact_work_order(self):
        return operations.fact_work_order(self.work_order, self.cfg)

    @cached_property
    def fact_service_order(self):
        return operations.fact_service_order(self.service_order, self.dim_premise, self.cfg)

    @cached_property
    def fact_interaction(self):
        return operations.fact_interaction(self.interaction)

    @cached_property
    def fact_payment_plan(self):
        return operations.fact_payment_plan(self.payment_plan, self.dim_customer)

    @cached_property
    def dq_summary(self):
        return quality.dq_summary(
            self.dim_premise, self.dim_customer, self.src["DFKKZP"], self.fact_payment,
            self.fact_bill, self.fact_ami_daily, self.fact_interaction, self.fact_outage, self.cfg,
        )
