"""The aging ledger: golden bill, edges, brute force."""

import random
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from meterstone.plans import receivables as R
from meterstone.settings import Settings

START, END = date(2024, 10, 1), date(2025, 9, 30)
BILL = "bill_id int, customer_id int, bill_date date, due_date date, is_reversed boolean, total_amt decimal(14,2)"
PAY = "bill_id int, payment_date date, amount decimal(14,2)"


def frames(spark, bills, pays):
    money = lambda x: Decimal(str(x))
    b = spark.createDataFrame([(*r[:5], money(r[5])) for r in bills], BILL)
    p = spark.createDataFrame([(a, d, money(x)) for a, d, x in pays], PAY)
    return b, p


def month_end(d):
    return (d.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


def brute(bills, pays, start, end):
    months, m = [], month_end(start)
    while m <= month_end(end):
        months.append(m)
        m = month_end(m + timedelta(days=1))
    out = []
    for bid, cust, day, due, reversed_, total in bills:
        if reversed_ or total <= 0:
            continue
        steps, cum, paid = [], Decimal(0), None
        mine = sorted((month_end(d), Decimal(str(x))) for b, d, x in pays if b == bid)
        for me in sorted({x[0] for x in mine}):
            cum += sum(x[1] for x in mine if x[0] == me)
            steps.append((me, cum))
            if paid is None and cum >= Decimal(str(total)) - Decimal("0.005"):
                paid = me
        for me in months:
            if me >= month_end(day) and (paid is None or me < paid):
                so_far = [c for m2, c in steps if m2 <= me]
                out.append((me, bid, Decimal(str(total)) - (so_far[-1] if so_far else 0), (me - due).days))
    return sorted(out)


def run(spark, bills, pays, start=START, end=END):
    got = R.open_items(*frames(spark, bills, pays), start, end)
    return sorted((r.me, r.bill_id, r.open_amt, r.days_past_due) for r in got.collect())


def test_golden_bill(spark):
    bills = [(1, 1, date(2024, 10, 10), date(2024, 10, 30), False, 100)]
    pays = [(1, date(2024, 11, 5), 40), (1, date(2024, 12, 20), 60)]
    assert run(spark, bills, pays) == [(date(2024, 10, 31), 1, Decimal(100), 1), (date(2024, 11, 30), 1, Decimal(60), 31)]


def test_edges(spark):
    day, due = date(2024, 11, 10), date(2024, 11, 30)
    bills = [(i, 1, day, due, i == 5, 0 if i == 6 else 100) for i in range(1, 9)]
    pays = [(2, date(2024, 11, 20), 100), (3, date(2024, 9, 1), 100), (4, date(2025, 1, 5), 150), (5, date(2024, 12, 1), 1),
            (7, date(2024, 12, 1), 99.99), (8, date(2024, 9, 1), 30)]
    got = run(spark, bills, pays)
    count = {i: sum(1 for r in got if r[1] == i) for i in range(1, 9)}
    assert count == {1: 11, 2: 0, 3: 0, 4: 2, 5: 0, 6: 0, 7: 11, 8: 11}
    assert {r[2] for r in got if r[1] == 7} == {Decimal(100), Decimal("0.01")}
    assert {r[2] for r in got if r[1] == 8} == {Decimal(70)}  # paid before it was billed
    assert got == brute(bills, pays, START, END)


def test_random_ledgers(spark):
    rng = random.Random(3)
    bills, pays = [], []
    for i in range(250):
        day = date(2024, 6, 1) + timedelta(days=rng.randrange(480))
        bills.append((i, rng.randrange(20), day, day + timedelta(days=20), rng.random() < 0.05, rng.randrange(0, 200)))
        for _ in range(rng.randrange(5)):
            pays.append((i, day + timedelta(days=rng.randrange(-90, 200)), rng.choice([-20, 10, 50, 75.5, 200])))
    assert run(spark, bills, pays) == brute(bills, pays, START, END)


def test_buckets_add_up(spark):
    rng = random.Random(5)
    bills = [(i, i % 9, date(2024, 10, 1) + timedelta(days=i), date(2024, 10, 21) + timedelta(days=i), False, 50 + i) for i in range(200)]
    pays = [(i, date(2024, 12, 1) + timedelta(days=rng.randrange(120)), 40) for i in range(0, 200, 2)]
    b, p = frames(spark, bills, pays)
    who = spark.createDataFrame([(i, "Residential" if i % 2 else "Government", "North") for i in range(9)],
                                "customer_id int, segment string, division string")
    items = R.open_items(b, p, START, END)
    ledger = R.fact_ar_monthly(items, who)
    whole = items.agg(F.sum("open_amt"), F.count("*")).first()
    parts = ledger.agg(F.sum("open_amt"), F.sum("open_bills")).first()
    assert tuple(whole) == tuple(parts)
    distinct = {(r.me, r.o): r.n for r in items.groupBy("me", R.bands.aging_order(F.col("days_past_due")).alias("o"))
                .agg(F.countDistinct("customer_id").alias("n")).collect()}
    accounts = {(r.month_end, r.bucket_order): r.n for r in ledger.groupBy("month_end", "bucket_order")
                .agg(F.sum("open_accounts").alias("n")).collect()}
    assert distinct == accounts

    cfg = Settings(as_of=date(2025, 9, 30), window_start=START, window_end=END)
    now = R.fact_ar_customer(R.open_items_as_of(b, p, cfg))
    last = ledger.filter(F.col("month_end") == F.lit(cfg.as_of))
    want = last.agg(F.sum(F.when(F.col("is_receivable"), F.col("open_amt"))), F.sum(F.when(~F.col("is_receivable"), F.col("open_amt")))).first()
    got = now.agg(F.sum("open_amt"), F.sum("written_off_amt")).first()
    assert (got[0] or 0, got[1]) == (want[0] or 0, want[1])


def test_ledger_plan_has_no_range_join(spark):
    bills = [(1, 1, date(2024, 10, 10), date(2024, 10, 30), False, 100)]
    plan = R.open_items(*frames(spark, bills, [(1, date(2024, 11, 5), 40)]), START, END)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
