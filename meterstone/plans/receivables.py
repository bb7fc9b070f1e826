"""Receivables: bills, payments and the month-end aging ledger."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterstone.functions import bands
from meterstone.functions import dates as D
from meterstone.functions.dates import OPEN_END
from meterstone.operators.balances import monthly_steps
from meterstone.operators.months import end_of_month_number, month_number, open_month_bounds
from meterstone.operators.statistics import sum_where
from meterstone.settings import Settings

c = F.col

# Fixed value: a bill counts as paid when at most half a cent is missing.
PAID_TOLERANCE = Decimal("0.005")
MONEY = "decimal(38,2)"


def fact_bill(bill: DataFrame) -> DataFrame:
    return bill.withColumn("bill_month", D.month_start(c("bill_date")))


OWNER = ("segment", "division")


def owned_payments(payment: DataFrame, customers: DataFrame) -> DataFrame:
    """De-duplicated payments of known accounts with their owner's segment and division."""
    owner = customers.select("account_id", "customer_id", *OWNER)
    return payment.join(owner, "account_id").select(
        "payment_id", "customer_id", "account_id", "bill_id", "payment_date",
        D.month_start(c("payment_date")).alias("payment_month"),
        "amount", "channel_code", "channel", *OWNER,
    )


def fact_payment(owned: DataFrame) -> DataFrame:
    return owned.drop(*OWNER)


def open_spans(bills: DataFrame, payments: DataFrame, window_start: date, window_end: date) -> DataFrame:
    """The months of the window in which a bill is open with one amount: bill, customer, due date, amount, first and last month number.

    A bill is open from the end of its billing month until the month in which
    its running payments first reach the total. The paid-so-far amount is
    constant between two payment months, so each (bill, payment month) row owns
    an interval of month-ends; the intervals are clipped to the window. One
    shuffle by bill serves the running sum, the join, the paid-month search and
    the as-of amount. Only intervals with a month of the window are produced.
    """
    steps = monthly_steps(payments, "bill_id", "payment_date", "amount")
    kept = bills.filter(~c("is_reversed") & (c("total_amt") > 0)).select(
        "bill_id", "customer_id", "due_date", "total_amt", D.month_end(c("bill_date")).alias("bill_me")
    )
    per_bill = Window.partitionBy("bill_id")
    enough = c("cum_paid") >= c("total_amt") - F.lit(PAID_TOLERANCE)
    rows = kept.join(steps, "bill_id", "left").withColumn("paid_me", F.min(F.when(enough, c("me"))).over(per_bill))

    never = F.lit(OPEN_END)
    zero = F.lit(0).cast("decimal(24,2)")
    interval = lambda start, stop, paid: F.struct(start.alias("since"), stop.alias("until"), paid.alias("paid"))
    unpaid = interval(c("bill_me"), F.coalesce("me", never), zero)
    after = interval(c("me"), F.coalesce("next_me", never), c("cum_paid"))
    spans = F.when(c("me").isNull(), F.array(unpaid)).when(c("is_first"), F.array(unpaid, after)).otherwise(F.array(after))

    spread = rows.select("bill_id", "customer_id", "due_date", "total_amt", "bill_me", "paid_me",
                         F.explode(spans).alias("span"))
    first = F.greatest(c("span.since"), c("bill_me"))
    stop = F.least(c("span.until"), F.coalesce("paid_me", never))
    low, high = open_month_bounds(first, stop, window_start, window_end)
    return spread.select(
        "bill_id", "customer_id", "due_date", (c("total_amt") - c("span.paid")).alias("open_amt"),
        low.alias("first_month"), high.alias("last_month"),
    ).filter(c("first_month") <= c("last_month"))


def items_of_spans(spans: DataFrame) -> DataFrame:
    """Spans expanded in place to a row a month-end."""
    months = spans.select("*", F.explode(F.sequence("first_month", "last_month")).alias("_month"))
    return months.withColumn("me", end_of_month_number(c("_month"))).select(
        "me", "bill_id", "customer_id", "due_date", "open_amt", F.datediff("me", "due_date").alias("days_past_due"),
    )


def spans_at(spans: DataFrame, day: date) -> DataFrame:
    """The spans that hold a month-end, cut to it."""
    month = month_number(F.lit(day))
    return spans.filter((c("first_month") <= month) & (c("last_month") >= month)).withColumns({"first_month": month, "last_month": month})


def open_items(bills: DataFrame, payments: DataFrame, window_start: date, window_end: date) -> DataFrame:
    """Every bill at every month-end it is open: me, bill, customer, amount, age."""
    return items_of_spans(open_spans(bills, payments, window_start, window_end))


def fact_ar_monthly(opened: DataFrame, customers: DataFrame) -> DataFrame:
    """Open amounts by month-end, segment, division and aging bucket.

    Open items are first summed per customer, month and bucket (combined before
    the shuffle, so a customer with very many bills costs one row per bucket).
    After that every customer is one row per group and the distinct customer
    count is a plain count.
    """
    per_customer = (
        opened.withColumn("bucket_order", bands.aging_order(c("days_past_due")))
        .groupBy("customer_id", "me", "bucket_order")
        .agg(F.sum("open_amt").alias("open_amt"), F.count(F.lit(1)).alias("open_bills"))
    )
    return _ar_by_segment(per_customer, customers)


def ar_monthly_of_spans(spans: DataFrame, customers: DataFrame) -> DataFrame:
    """``fact_ar_monthly`` from spans, without moving a row for every open month.

    A span is in a bucket from the month of the bucket's lowest age to the month before the next one's, so it is cut into a run
    of months a bucket. Runs are summed per customer (combined before the shuffle, so a customer with very many bills
    costs a few rows a bucket), dealt by customer and only there expanded to months.
    """
    due, starts = c("due_date"), bands.aging_starts()
    begins = [None if age is None else month_number(F.date_add(due, age)) for _, age in starts]
    runs = []
    for (order, _), begin, after in zip(starts, begins, [*begins[1:], None]):
        low = c("first_month") if begin is None else F.greatest(c("first_month"), begin)
        high = c("last_month") if after is None else F.least(c("last_month"), after - 1)
        inside = low <= high
        if after is not None:  # without a due date the age is unknown, which is the last bucket
            inside = due.isNotNull() & inside
        runs.append(F.when(inside, F.struct(F.lit(order).alias("bucket_order"), low.alias("first_month"), high.alias("last_month"))))
    cut = spans.select("customer_id", "open_amt", F.explode(F.array_compact(F.array(*runs))).alias("_run"))
    summed = cut.select("customer_id", "_run.*", "open_amt").groupBy("customer_id", "bucket_order", "first_month", "last_month").agg(
        F.sum("open_amt").alias("open_amt"), F.count(F.lit(1)).alias("open_bills"))
    months = summed.repartition("customer_id").select("*", F.explode(F.sequence("first_month", "last_month")).alias("_month"))
    per_customer = (
        months.groupBy("customer_id", "_month", "bucket_order")
        .agg(F.sum("open_amt").alias("open_amt"), F.sum("open_bills").alias("open_bills"))
        .withColumn("me", end_of_month_number(c("_month")))
    )
    return _ar_by_segment(per_customer, customers)


def _ar_by_segment(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    known = customers.select("customer_id", "segment", "division")
    return (
        per_customer.join(known, "customer_id")
        .groupBy(c("me").alias("month_end"), "segment", "division", "bucket_order")
        .agg(
            F.sum("open_amt").cast(MONEY).alias("open_amt"),
            F.sum("open_bills").alias("open_bills"),
            F.count("customer_id").alias("open_accounts"),
        )
        .select(
            "month_end", "segment", "division",
            bands.aging_bucket(c("bucket_order")).alias("aging_bucket"), "bucket_order",
            (c("bucket_order") < bands.WRITTEN_OFF[1]).alias("is_receivable"),
            "open_amt", "open_bills", "open_accounts",
        )
    )


def fact_ar_customer(opened_as_of: DataFrame) -> DataFrame:
    """Balance per customer from the open items of one month-end."""
    age = c("days_past_due")
    limit = bands.WRITE_OFF_AFTER_DAYS
    money = lambda test, name: sum_where(test, "open_amt").cast(MONEY).alias(name)
    return opened_as_of.groupBy("customer_id").agg(
        money(age <= limit, "open_amt"),
        money(age.between(1, limit), "past_due_amt"),
        money(age <= 0, "current_amt"),
        money(age.between(1, 30), "past_due_1_30"),
        money(age.between(31, 60), "past_due_31_60"),
        money(age.between(61, 90), "past_due_61_90"),
        money(age.between(91, limit), "past_due_91_180"),
        money(age > limit, "written_off_amt"),
        F.max(F.when(age <= limit, age)).alias("oldest_days_past_due"),
        sum_where(age <= limit, F.lit(1)).alias("open_bills"),
    )


def open_items_as_of(bills: DataFrame, payments: DataFrame, cfg: Settings) -> DataFrame:
    """Open items at the as-of date only (it must be a month-end, as in the ledger)."""
    return open_items(bills, payments, cfg.as_of, cfg.as_of).filter(c("me") == F.lit(cfg.as_of))
