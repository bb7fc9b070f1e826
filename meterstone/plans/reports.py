"""Report datasets at page grain, over a Warehouse."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstone.functions import codes
from meterstone.functions import dates as D
from meterstone.functions import text as T
from meterstone.operators.lag import previous_values
from meterstone.operators.months import counts_by_month, month_number
from meterstone.operators.statistics import count_where, sum_where
from meterstone.plans.warehouse import Warehouse

c = F.col
rows = lambda name: F.count(F.lit(1)).alias(name)
total = lambda name: F.sum(name).alias(name)

# Names of the published datasets.
PUBLISHED = (
    "dim_period", "date_daily", "division", "revenue_residential_monthly", "revenue_commercial_monthly",
    "ar_aging_monthly", "ar_top_accounts", "payments_monthly", "digital_adoption_monthly", "ami_daily_profile",
    "reliability_events", "work_orders_monthly", "work_order_backlog", "contact_center_daily",
    "collections_orders_monthly", "moratorium_compliance", "payment_plans_monthly",
    "billing_exceptions_monthly", "rebills_monthly", "service_orders_monthly", "customer_360",
    "customer_bills_recent", "data_quality",
)


class Reports:
    def __init__(self, warehouse: Warehouse):
        self.wh, self.cfg = warehouse, warehouse.cfg

    def store(self, folder: str, names: Iterable[str]) -> "Reports":
        """Write these datasets below ``folder`` and go on from the files, for datasets that several others are made from."""
        for name in names:
            path = f"{folder.rstrip('/')}/{name}"
            getattr(self, name).write.mode("overwrite").parquet(path)
            self.__dict__[name] = self.wh.spark.read.parquet(path)
        return self

    # calendar and division -------------------------------------------------

    @cached_property
    def dim_period(self) -> DataFrame:
        return self.wh.dim_date.filter("is_in_window").select(
            D.period_key(c("month_start")).alias("period_key"), "month_start", "month_end", "year", "quarter",
            "month_num", "month_name", "month_short", "year_month",
        ).distinct()

    @cached_property
    def date_daily(self) -> DataFrame:
        return self.wh.dim_date.filter("is_in_window").select(
            "date", D.period_key(c("month_start")).alias("period_key"), "month_start", "year_month", "year",
            "month_short", "day_of_week", "day_name", "is_weekend", "is_winter_moratorium", "is_major_event_day",
            "daily_saidi_min", "temp_avg_f", "temp_max_f", "temp_min_f", "precip_in", "max_gust_mph",
            "heating_degree_days", "cooling_degree_days",
        )

    @cached_property
    def division(self) -> DataFrame:
        return self.wh.dim_geography.groupBy("division").agg(
            total("customers_served"), total("gas_customers_served"), rows("towns")
        )

    # revenue ---------------------------------------------------------------
    @cached_property
    def revenue_monthly(self) -> DataFrame:
        residential = T.one_of(c("segment_code"), codes.RESIDENTIAL_CLASS_CODES)
        who = self.wh.dim_customer.select("customer_id", T.folded(c("segment_code")).alias("segment_code"), "segment", "division")
        amounts = ("elec_delivery_amt", "elec_supply_amt", "gas_delivery_amt", "gas_supply_amt", "tax_amt", "total_amt")
        # dealt by customer and month as bills: sums are wider, hardly fewer and would fill the memory of a task before the shuffle;
        # a month of a customer with very many bills is all that meets in one task
        billed = (
            self.wh.fact_bill.filter(~c("is_reversed"))
            .withColumn("gas_rate_code", F.coalesce("gas_rate_code", F.lit("None")))
            .select("customer_id", "bill_month", "elec_rate_code", "gas_rate_code", "elec_supplier", "kwh", "therms", *amounts)
            .repartition("customer_id", "bill_month")
            .groupBy("customer_id", "bill_month", "elec_rate_code", "gas_rate_code", "elec_supplier")
            .agg(rows("bills"), total("kwh"), total("therms"), *[total(a) for a in amounts])
        )
        return (
            billed.join(who, "customer_id")
            .groupBy("bill_month", "segment_code", "division", "segment", "elec_rate_code", "gas_rate_code", "elec_supplier")
            # after the first step each customer is one row per group
            .agg(total("bills"), F.count("customer_id").alias("customers_billed"), total("kwh"), total("therms"),
                 *[F.sum(a).cast("decimal(38,2)").alias(a) for a in amounts])
            .select(
                D.period_key(c("bill_month")).alias("period_key"), "bill_month",
                F.when(residential, codes.RESIDENTIAL_CLASS).otherwise(codes.COMMERCIAL_CLASS).alias("customer_class"),
                "division", "segment", "elec_rate_code", "gas_rate_code", "elec_supplier",
                "bills", "customers_billed", "kwh", "therms", *amounts,
            )
        )

    @cached_property
    def revenue_residential_monthly(self) -> DataFrame:
        return self.revenue_monthly.filter(c("customer_class") == codes.RESIDENTIAL_CLASS)

    @cached_property
    def revenue_commercial_monthly(self) -> DataFrame:
        return self.revenue_monthly.filter(c("customer_class") == codes.COMMERCIAL_CLASS)

    # receivables -----------------------------------------------------------
    @cached_property
    def ar_aging_monthly(self) -> DataFrame:
        return self.wh.fact_ar_monthly

    @cached_property
    def ar_top_accounts(self) -> DataFrame:
        who = self.wh.dim_customer.select(
            "customer_id", "account_id", "customer_name", "segment", "division", "city",
            "is_low_income", "has_medical_cert", "is_active",
        )
        owed = self.wh.fact_ar_customer.select(
            "customer_id", "open_amt", "past_due_amt", "past_due_1_30", "past_due_31_60", "past_due_61_90",
            "past_due_91_180", "written_off_amt", "oldest_days_past_due", "open_bills",
        )
        return (
            who.join(owed, "customer_id")
            .orderBy(c("past_due_amt").desc(), "customer_id")
            .limit(self.cfg.top_accounts)
        )

    # payments and adoption -------------------------------------------------
    @cached_property
    def payments_monthly(self) -> DataFrame:
        return self.wh.owned_payments.groupBy("payment_month", "channel", "segment", "division").agg(
            rows("payments"), F.sum("amount").alias("amount")
        )

    @cached_property
    def digital_adoption_monthly(self) -> DataFrame:
        """Customers active at each month-end, counted by the steps at both ends of their tenure."""
        customers, left = self.wh.dim_customer, F.coalesce("move_out_date", F.lit(D.OPEN_END))
        first, last = month_number(c("move_in_date")), month_number(left) - 1
        since = lambda flag, day: (F.when(c(flag), F.greatest(first, month_number(c(day)))), F.when(c(day).isNotNull(), last))
        counts = counts_by_month(
            customers, ["segment", "division"],
            {"active_customers": (first, last), "autopay_customers": since("is_autopay", "autopay_date"),
             "paperless_customers": since("is_paperless", "paperless_date")},
            self.cfg.window_start, self.cfg.window_end, "month_end",
        )
        return counts.select("month_end", "segment", "division", "active_customers", "autopay_customers", "paperless_customers")

    # usage -----------------------------------------------------------------
    @cached_property
    def ami_daily_profile(self) -> DataFrame:
        valid = ~c("is_missing") & ~c("is_spike")
        return (
            self.wh.placed_reads.groupBy("read_date", "division", "elec_rate_code")
            .agg(
                rows("meters_expected"),
                count_where(~c("is_missing")).alias("meters_reporting"),
                count_where(F.upper(F.rtrim("read_quality")) == "ESTIMATED").alias("reads_estimated"),
                count_where(c("is_spike")).alias("reads_spike"),
                sum_where(valid, "kwh").alias("kwh_valid"),
                count_where(valid).alias("reads_valid"),
                F.max(F.when(~c("is_spike"), c("peak_kw"))).alias("max_peak_kw"),
            )
        )

    # reliability -----------------------------------------------------------
    @cached_property
    def reliability_events(self) -> DataFrame:
        return self.wh.fact_outage.select(
            "outage_id", "outage_start", "restore_time", "outage_date", "duration_min", "is_open", "division",
            "municipality", "circuit_id", "device_type", "cause", "customers_out", "customer_minutes",
            "is_major_event_day",
        )

    # work orders -----------------------------------------------------------
    @cached_property
    def work_orders_monthly(self) -> DataFrame:
        return (
            self.wh.fact_work_order.filter(c("status") != "Deleted")
            .groupBy(D.month_start(c("created_date")).alias("created_month"), "order_type", "commodity",
                     "asset_class", "division", "priority", "status")
            .agg(
                rows("work_orders"),
                count_where(c("finished_on_time")).alias("finished_on_time"),
                F.count("actual_finish").alias("finished"),
                total("planned_cost"), total("actual_cost"),
            )
        )

    @cached_property
    def work_order_backlog(self) -> DataFrame:
        return self.wh.fact_work_order.filter("is_open").select(
            "work_order_id", "order_type", "description", "asset_class", "commodity", "functional_location",
            "work_center", "priority", "created_date", "planned_start", "planned_finish", "status", "planned_cost",
            "actual_cost", "division", "municipality", "open_age_days", "is_overdue",
        )

    # contact center --------------------------------------------------------
    @cached_property
    def contact_center_daily(self) -> DataFrame:
        agent = F.upper(F.rtrim("channel")) == codes.AGENT_CHANNEL.upper()
        return self.wh.fact_interaction.groupBy("interaction_date", "channel", "reason", "site", "is_assisted").agg(
            rows("contacts"),
            count_where(c("is_identified")).alias("identified_contacts"),
            F.sum("wait_sec").alias("wait_sec_total"),
            count_where(agent & (c("wait_sec") <= 30)).alias("answered_within_30s"),
            count_where(agent).alias("agent_calls"),
            F.sum("handle_sec").alias("handle_sec_total"),
            count_where(c("first_contact_resolved")).alias("resolved_first_contact"),
            count_where(c("transferred")).alias("transferred"),
            F.count("csat").alias("csat_responses"),
            F.sum("csat").alias("csat_total"),
            count_where(c("csat") >= 4).alias("csat_satisfied"),
        )

    # credit and collections ------------------------------------------------
    @cached_property
    def _collection_orders(self) -> DataFrame:
        who = self.wh.dim_customer.select("account_id", "segment", "is_low_income", "has_medical_cert")
        return self.wh.fact_service_order.join(who, "account_id")

    @cached_property
    def collections_orders_monthly(self) -> DataFrame:
        return (
            self._collection_orders.filter(T.one_of(c("order_type_code"), ("DISC_NP", "RECONNECT")))
            .groupBy(D.month_start(c("created_date")).alias("created_month"), "order_type", "status", "division",
                     "segment", "is_low_income")
            .agg(
                rows("orders"),
                count_where(c("cycle_days") <= 1).alias("completed_within_1_day"),
                F.avg(c("cycle_days").cast("double")).alias("avg_cycle_days"),
            )
        )

    @cached_property
    def moratorium_compliance(self) -> DataFrame:
        season = self.wh.dim_date.select(c("date").alias("completed_date"), "is_winter_moratorium")
        return (
            self._collection_orders.filter(T.same_text(c("order_type_code"), "DISC_NP") & (c("status") == "Completed"))
            .join(season, "completed_date")
            .groupBy("is_winter_moratorium", "segment", "has_medical_cert")
            .agg(rows("disconnects_completed"))
        )

    @cached_property
    def payment_plans_monthly(self) -> DataFrame:
        return self.wh.fact_payment_plan.groupBy(
            D.month_start(c("created_date")).alias("created_month"), "plan_type", "status", "segment", "division",
            "is_low_income",
        ).agg(
            rows("plans"), total("total_amt"), total("down_payment"),
            F.avg(c("num_installments").cast("double")).alias("avg_installments"),
        )

    # meter to cash ---------------------------------------------------------
    @cached_property
    def billing_exceptions_monthly(self) -> DataFrame:
        """Rebills and reversed bills leave before the previous bill is looked up."""
        reviewed = self.wh.fact_bill.filter(~c("is_reversed") & (c("bill_type") != "Rebill")).select(
            "bill_id", "bill_date", "bill_month", "customer_id", "elec_rate_code", "bill_type", "billing_days", "kwh",
            "elec_estimated", "gas_estimated",
        )
        compared = previous_values(
            reviewed, ["customer_id"], ["bill_date", "bill_id"],
            {"prior_kwh": "kwh", "prior_estimated": "elec_estimated"}, piece=D.month_start(c("bill_date")),
        )
        who = self.wh.dim_customer.select("customer_id", "division", "segment")
        swing = F.try_divide(F.abs(c("kwh") - c("prior_kwh")), c("prior_kwh"))
        # summed per customer before the dimension join, so a hot customer joins as a few rows
        per_customer = compared.groupBy("customer_id", "bill_month", "elec_rate_code").agg(
            rows("bills"),
            count_where(c("elec_estimated")).alias("elec_estimated"),
            count_where(c("gas_estimated")).alias("gas_estimated"),
            count_where(c("elec_estimated") & c("prior_estimated")).alias("consecutive_estimates"),
            count_where((c("kwh") == 0) & (c("bill_type") == "Regular") & (c("billing_days") >= 20))
            .alias("zero_usage_bills"),
            count_where((c("prior_kwh") > 0) & (swing > 0.5)).alias("high_variance_bills"),
        )
        counters = ("bills", "elec_estimated", "gas_estimated", "consecutive_estimates", "zero_usage_bills",
                    "high_variance_bills")
        return (
            per_customer.join(who, "customer_id")
            .groupBy("bill_month", "division", "segment", "elec_rate_code")
            .agg(*[total(n) for n in counters])
        )

    @cached_property
    def rebills_monthly(self) -> DataFrame:
        return (
            self.wh.fact_bill.filter("is_reversed")
            .groupBy(D.month_start(c("reversal_date")).alias("reversal_month"))
            .agg(rows("reversed_bills"), F.sum("total_amt").alias("reversed_amt"))
        )

    @cached_property
    def service_orders_monthly(self) -> DataFrame:
        done = c("status") == "Completed"
        return self.wh.fact_service_order.groupBy(
            D.month_start(c("created_date")).alias("created_month"), "order_type", "status", "division", "work_center"
        ).agg(
            rows("orders"),
            count_where(done).alias("completed"),
            sum_where(done, "cycle_days").alias("cycle_days_total"),
            count_where(c("status") == "Open").alias("open_orders"),
            F.max("open_age_days").alias("max_open_age_days"),
        )

    # customer drill-through ------------------------------------------------
    @cached_property
    def customer_360(self) -> DataFrame:
        home = self.wh.dim_premise.select(
            "premise_id", "address_line", "zip", "latitude", "longitude", "premise_type", "elec_rate_code",
            "gas_rate_code", "elec_meter_technology",
        )
        owed = self.wh.fact_ar_customer.select(
            "customer_id", "open_amt", "past_due_amt", "written_off_amt", "oldest_days_past_due"
        )
        zero = F.lit(0).cast("decimal(38,2)")
        return (
            self.wh.dim_customer.join(home, "premise_id")
            .join(owed, "customer_id", "left")
            .select(
                "customer_id", "account_id", "customer_name", "customer_type", "segment", "division", "city",
                "address_line", "zip", "latitude", "longitude", "premise_type", "elec_rate_code", "gas_rate_code",
                "elec_meter_technology", "elec_supplier", "move_in_date", "move_out_date", "is_active",
                "tenure_years", "has_email", "has_phone", "is_autopay", "is_paperless", "is_budget_billing",
                "is_low_income", "has_medical_cert",
                *[F.coalesce(a, zero).alias(a) for a in ("open_amt", "past_due_amt", "written_off_amt")],
                "oldest_days_past_due",
            )
        )

    @cached_property
    def customer_bills_recent(self) -> DataFrame:
        cutoff = F.add_months(F.lit(self.cfg.as_of), -self.cfg.recent_bill_months)
        paid = self.wh.fact_payment.groupBy("bill_id").agg(F.sum("amount").alias("paid_amt"))
        return (
            self.wh.fact_bill.filter(c("bill_date") > cutoff)
            .join(paid, "bill_id", "left")
            .select(
                "bill_id", "customer_id", "bill_date", "due_date", "period_start", "period_end", "bill_type",
                "is_reversed", "kwh", "therms", "elec_estimated", "gas_estimated", "total_amt",
                F.coalesce("paid_amt", F.lit(0).cast("decimal(24,2)")).alias("paid_amt"),
            )
        )

    @cached_property
    def data_quality(self) -> DataFrame:
        share = F.try_divide(c("rows_affected") * F.lit(100).cast("decimal(18,1)"), c("rows_checked"))
        return self.wh.dq_summary.withColumn("pct_affected", share.cast("decimal(6,2)"))
