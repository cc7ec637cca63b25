import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from tidemark.plans import questions as q

START = datetime(2024, 1, 1)
TYPES = ("page_view", "search", "product_click", "add_to_cart", "checkout")


@pytest.fixture(scope="module")
def clicks(spark):
    """600 events; user 1 makes a third of them."""
    draw = random.Random(5)
    rows = []
    for n in range(600):
        user = 1 if draw.random() < 0.34 else draw.randrange(2, 12)
        moment = START + timedelta(minutes=draw.randrange(0, 3000))
        rows.append((f"e{n}", user, n % 7, 20240101, draw.choice(TYPES), "mobile", f"s{n}", moment))
    names = "event_id string, user_id bigint, product_id bigint, date_key int, event_type string, device string, session_id string, event_timestamp timestamp"
    return spark.createDataFrame(rows, names), rows


@pytest.fixture(scope="module")
def facts(spark):
    draw = random.Random(6)
    rows = [
        (n, n // 2, draw.randrange(1, 14), draw.choice(["success", "failed"]), START + timedelta(minutes=draw.randrange(0, 6000)))
        for n in range(60)
    ]
    names = "order_item_id bigint, order_id bigint, user_id bigint, payment_status string, paid_at timestamp"
    return spark.createDataFrame(rows, names), rows


def funnel_by_hand(click_rows, fact_rows):
    reached = defaultdict(list)
    by_user = defaultdict(list)
    for row in click_rows:
        by_user[row[1]].append((row[4], row[7]))
    for _, _, user, status, moment in fact_rows:
        if status == "success":
            by_user[user].append(("payment", moment))
    for user, events in by_user.items():
        since = datetime.min
        for stage in q.STAGES:
            times = [t for s, t in events if s == stage and t >= since]
            if not times:
                break
            since = min(times)
            reached[stage].append(user)
    return [len(reached[s]) for s in q.STAGES]


def test_ordered_funnel(clicks, facts):
    result = q.funnel_ordered(clicks[0], facts[0]).orderBy("stage_no").collect()
    assert [r["users"] for r in result] == funnel_by_hand(clicks[1], facts[1])
    assert result[0]["of_first"] == 1.0


def test_funnel_users(clicks, facts):
    result = q.funnel_users(clicks[0], facts[0]).orderBy("stage_no").collect()
    expected = [len({r[1] for r in clicks[1] if r[4] == s}) for s in q.CLICK_STAGES]
    expected.append(len({r[2] for r in facts[1] if r[3] == "success"}))
    assert [r["users"] for r in result] == expected


def sessions_by_hand(rows, gap):
    by_user = defaultdict(list)
    for row in rows:
        by_user[row[1]].append(row[7])
    found = []
    for user, times in by_user.items():
        times.sort()
        start, count = times[0], 1
        for before, now in zip(times, times[1:]):
            if now - before > gap:
                found.append((user, start, before, count))
                start, count = now, 0
            count += 1
        found.append((user, start, times[-1], count))
    return sorted(found)


@pytest.mark.parametrize("minutes", [1, 30, 47])
def test_sessions(clicks, minutes):
    # Times are whole minutes, so gaps of exactly the limit are common here.
    result = q.sessions(clicks[0], minutes * 60).select("user_id", "session_start", "session_end", "events").collect()
    assert sorted(map(tuple, result)) == sessions_by_hand(clicks[1], timedelta(minutes=minutes))


def test_streamed_sessions_equal_batch(spark, clicks, folder):
    from tidemark.streaming import visit_sessions, write_stream

    source = clicks[0].withColumnRenamed("event_timestamp", "timestamp")
    source.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(source.schema).parquet(f"{folder}/in")
    write_stream(visit_sessions(stream), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    closed = max(r[7] for r in clicks[1]) - timedelta(hours=1, minutes=30)
    expected = [s for s in sessions_by_hand(clicks[1], timedelta(minutes=30)) if s[2] <= closed]
    got = spark.read.parquet(f"{folder}/out").select("user_id", "session_start", "session_end", "events").collect()
    assert sorted(map(tuple, got)) == expected


def test_time_to_convert(clicks):
    by_user = defaultdict(list)
    for row in clicks[1]:
        by_user[row[1]].append((row[7], row[4]))
    spans = []
    for events in by_user.values():
        checkouts = [t for t, kind in events if kind == "checkout"]
        if checkouts:
            spans.append((min(checkouts) - min(t for t, _ in events)).total_seconds())
    result = q.time_to_convert(clicks[0]).first()
    assert result["users"] == len(spans)
    assert result["avg_seconds"] == pytest.approx(sum(spans) / len(spans), abs=0.001)


FACT = "order_item_id bigint, order_id bigint, user_id bigint, product_id bigint, quantity int, line_total decimal(18,2), payment_status string, order_date timestamp"


@pytest.fixture(scope="module")
def retried(spark):
    """Line 1 was paid at the second try, line 2 twice, line 3's product is gone, line 4 failed."""
    rows = [
        (1, 1, 1, 10, 2, 9, "failed"),
        (1, 1, 1, 10, 2, 9, "success"),
        (2, 2, 1, 11, 1, 4, "success"),
        (2, 2, 1, 11, 1, 4, "success"),
        (3, 3, 1, 99, 5, 13, "success"),
        (4, 4, 1, 10, 1, 5, "failed"),
    ]
    from decimal import Decimal

    facts = spark.createDataFrame([(*r[:5], Decimal(r[5]), r[6], START) for r in rows], FACT)
    named = [(10, "ten", "a"), (11, "eleven", "a")]
    return facts, spark.createDataFrame(named, "product_id bigint, name string, category string")


def test_revenue_counts_a_line_once_and_keeps_lost_products(retried):
    found = {r.category: float(r.revenue) for r in q.revenue(*retried, "month").collect()}
    assert found == {"a": 13.0, None: 13.0}


def test_best_sellers_count_a_line_once_and_keep_lost_products(retried):
    best = q.top_products(*retried, k=2).collect()
    assert sorted((r.product_id, r.quantity, r.name) for r in best) == [(10, 3, "ten"), (99, 5, None)]
    trend = q.product_trend(retried[0], k=2).collect()
    assert sorted((r.product_id, r.quantity, r.change) for r in trend) == [(10, 3, None), (99, 5, None)]


def test_reconciliations_report_nulls(spark):
    from decimal import Decimal

    orders = spark.createDataFrame(
        [(1, "paid", Decimal(5)), (2, None, Decimal(0)), (3, "pending", None)],
        "id bigint, status string, total_amount decimal(14,2)",
    )
    items = spark.createDataFrame([(1, 5, Decimal(1))], "order_id bigint, quantity int, price decimal(12,2)")
    assert [r.order_id for r in q.order_total_gaps(orders, items).collect()] == [3]
    payments = spark.createDataFrame([(3,)], "order_id bigint")
    assert sorted(r.order_id for r in q.payment_presence_gaps(orders, payments).collect()) == [1, 2, 3]
