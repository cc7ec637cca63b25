"""Business questions over the star schema and the change log.

Aggregates are taken by key before a dimension is joined, so what is shuffled for the join is one row per key and a
single hot product, user or order costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.decode import decode_field
from tidemark.operators.changes import parse_envelope
from tidemark.schemas import ORDERS

# The stages of the conversion funnel in order; the last comes from payments.
CLICK_STAGES = ("page_view", "add_to_cart", "checkout")
STAGES = (*CLICK_STAGES, "payment")
SESSION_GAP_SECONDS = 30 * 60


def _ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double with six decimals, NULL where the whole is 0."""
    return F.when(whole > 0, F.round(part.cast("double") / whole.cast("double"), 6))


def _paid(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.filter(F.col("payment_status") == "success")


def _lines(fact_orders: DataFrame, *columns: str | Column) -> DataFrame:
    """Each order line once, however many payments its order has.

    The order is part of what must be equal: the fact comes out of a join by order, so its copies meet without a shuffle.
    """
    return fact_orders.select("order_id", "order_item_id", *columns).distinct()


def revenue(fact_orders: DataFrame, dim_products: DataFrame, grain: str) -> DataFrame:
    """Paid revenue per ``grain`` (day, week, month) and product category.

    A line counts once, even if its order was paid several times. Products that are no longer in the dimension come under a
    NULL category.
    """
    period = F.to_date(F.date_trunc(grain, "order_date")).alias("period")
    by_product = (
        _lines(_paid(fact_orders), period, "product_id", "line_total")
        .groupBy("period", "product_id")
        .agg(F.sum("line_total").alias("amount"))
    )
    return (
        by_product.join(dim_products.select("product_id", "category"), "product_id", "left")
        .groupBy("period", "category")
        .agg(F.sum("amount").cast("decimal(24,2)").alias("revenue"))
    )


def _monthly(fact_orders: DataFrame) -> DataFrame:
    month = F.to_date(F.date_trunc("month", "order_date")).alias("month")
    return (
        _lines(fact_orders, "product_id", month, "quantity")
        .groupBy("product_id", "month")
        .agg(F.sum("quantity").cast("bigint").alias("quantity"))
    )


def _best(monthly: DataFrame, k: int) -> DataFrame:
    sold = monthly.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    return sold.orderBy(F.desc("quantity"), "product_id").limit(k)


def top_products(fact_orders: DataFrame, dim_products: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best sellers by quantity, each line counted once; ties go to the lower product id.

    Products that are no longer in the dimension keep their place, without name and category.
    """
    named = dim_products.select("product_id", "name", "category")
    return _best(_monthly(fact_orders), k).join(named, "product_id", "left").select("product_id", "name", "category", "quantity")


def product_trend(fact_orders: DataFrame, k: int = 10) -> DataFrame:
    """Monthly quantity of the ``k`` best sellers, and its change from their previous month with sales.

    Totals, best sellers and trend all come from one aggregate by product and month.
    """
    monthly = _monthly(fact_orders)
    of_best = monthly.join(_best(monthly, k).select("product_id"), "product_id", "left_semi")
    before = F.lag("quantity").over(Window.partitionBy("product_id").orderBy("month"))
    return of_best.withColumn("change", F.col("quantity") - before)


def _stage_rows(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row with a count per stage -> one row per stage with conversion rates."""
    lines = []
    for number, name in enumerate(names):
        previous = names[max(number - 1, 0)]
        lines.append(
            F.struct(
                F.lit(number + 1).alias("stage_no"),
                F.lit(name).alias("stage"),
                F.col(name).alias("users"),
                _ratio(F.col(name), F.col(names[0])).alias("of_first"),
                _ratio(F.col(name), F.col(previous)).alias("of_previous"),
            )
        )
    return counts.select(F.inline(F.array(*lines)))


def funnel_users(fact_clickstream: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Distinct users seen at each stage, whatever the order of their visits."""
    clicks = fact_clickstream.select("user_id", F.col("event_type").alias("stage")).filter(
        F.col("stage").isin(*CLICK_STAGES)
    )
    paid = _paid(fact_orders).select("user_id", F.lit("payment").alias("stage"))
    flags = (
        clicks.unionByName(paid)
        .groupBy("user_id")
        .agg(*[F.max(F.when(F.col("stage") == s, 1).otherwise(0)).alias(s) for s in STAGES])
    )
    return _stage_rows(flags.agg(*[F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias(s) for s in STAGES]), STAGES)


def funnel_times(fact_clickstream: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Per user, when each stage was first reached after the stage before it (NULL: never).

    Each step meets the users, one row each, with the events of the next stage only, in an inner join: Spark splits a busy
    user's partition on either side. What it finds is one row per user again.
    """
    clicks = fact_clickstream.select("user_id", "event_type", F.col("event_timestamp").alias("at"))
    reached = (
        clicks.filter(F.col("event_type") == CLICK_STAGES[0]).groupBy("user_id").agg(F.min("at").alias(CLICK_STAGES[0]))
    )
    # Once an order, not once a line: the fact comes out of a join by order, so an order's lines meet without a shuffle.
    paid = _paid(fact_orders).select("order_id", "user_id", F.col("paid_at").alias("at")).distinct().drop("order_id")
    for number, stage in enumerate(STAGES[1:], start=1):
        events = paid if stage == "payment" else clicks.filter(F.col("event_type") == stage).drop("event_type")
        since = reached.select("user_id", F.col(STAGES[number - 1]).alias("since"))
        first = since.join(events, "user_id").filter("at >= since").groupBy("user_id").agg(F.min("at").alias(stage))
        reached = reached.join(first, "user_id", "left")
    return reached


def funnel_ordered(fact_clickstream: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Users that reached each stage after having reached the one before it."""
    times = funnel_times(fact_clickstream, fact_orders)
    return _stage_rows(times.agg(*[F.count(s).alias(s) for s in STAGES]), STAGES)


def conversion_times(fact_clickstream: DataFrame) -> DataFrame:
    """Per user that checked out: seconds from first visit to first checkout.

    A user's first event is never later than any checkout, so two minima in one aggregate answer it.
    """
    first = F.min("event_timestamp")
    checkout = F.min(F.when(F.col("event_type") == "checkout", F.col("event_timestamp")))
    per_user = fact_clickstream.groupBy("user_id").agg(first.alias("first_visit"), checkout.alias("first_checkout"))
    return per_user.filter(F.col("first_checkout").isNotNull()).withColumn(
        "micros", F.unix_micros("first_checkout") - F.unix_micros("first_visit")
    )


def time_to_convert(fact_clickstream: DataFrame) -> DataFrame:
    """Users that checked out and their average seconds from first visit to checkout."""
    total = F.sum(F.col("micros").cast("decimal(38,0)"))
    users = F.count(F.lit(1))
    return conversion_times(fact_clickstream).agg(
        users.alias("users"), F.round(total.cast("double") / users / 1e6, 3).alias("avg_seconds")
    )


def sessions(fact_clickstream: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Visits per user: events no more than ``gap_seconds`` apart belong together.

    Two events in the same time cell of that width always do, so events are first summed up per user and cell, before
    the shuffle; only cells, whose number is bounded by the time covered and not by the traffic, are then chained.
    """
    gap = gap_seconds * 1_000_000
    at = F.unix_micros("event_timestamp")
    cells = (
        fact_clickstream.filter(F.col("event_timestamp").isNotNull())
        .select("user_id", at.alias("at"), (at - F.pmod(at, F.lit(gap))).alias("cell"))
        .groupBy("user_id", "cell")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("events"))
    )
    in_time = Window.partitionBy("user_id").orderBy("first")
    opens = F.coalesce(F.col("first") - F.lag("last").over(in_time) > gap, F.lit(True)).cast("int")
    numbered = cells.withColumn("opens", opens).withColumn("session_no", F.sum("opens").over(in_time))
    return numbered.groupBy("user_id", "session_no").agg(
        F.timestamp_micros(F.min("first")).alias("session_start"),
        F.timestamp_micros(F.max("last")).alias("session_end"),
        F.sum("events").alias("events"),
    )


def delivery_time(orders_bronze: DataFrame, users: DataFrame) -> DataFrame:
    """Average hours from order to first 'delivered' change, by the user's city; needs the change log.

    Orders of users that are no longer there come under a NULL city.
    """
    fields = {f.name: f for f in ORDERS.fields}
    image = parse_envelope(orders_bronze, ORDERS, before=()).filter(F.col("after.status") == "delivered")
    delivered = image.select(
        "row_key",
        decode_field(fields["user_id"], F.col("after.user_id")).alias("user_id"),
        (
            F.unix_micros("timestamp") - F.unix_micros(decode_field(fields["order_date"], F.col("after.order_date")))
        ).alias("micros"),
    )
    # Fixed-width aggregates, so that Spark hashes instead of sorting.
    first = delivered.groupBy("row_key").agg(
        F.min("micros").alias("micros"), F.min_by("user_id", "micros").alias("user_id")
    )
    per_user = first.groupBy("user_id").agg(
        F.count("micros").alias("orders"), F.sum(F.col("micros").cast("decimal(38,0)")).alias("micros")
    )
    by_city = (
        per_user.join(users.select(F.col("id").alias("user_id"), "city"), "user_id", "left")
        .groupBy("city")
        .agg(F.sum("orders").alias("orders"), F.sum("micros").alias("micros"))
    )
    hours = F.col("micros").cast("double") / F.col("orders") / 3.6e9
    return by_city.select("city", "orders", F.round(hours, 4).alias("avg_hours"))


def cancellation_rate(stg_orders: DataFrame) -> DataFrame:
    """Cancelled orders among all, from current state."""
    orders = F.count(F.lit(1))
    cancelled = F.count_if(F.col("status") == "cancelled")
    return stg_orders.agg(orders.alias("orders"), cancelled.alias("cancelled"), _ratio(cancelled, orders).alias("rate"))


def cancellation_stages(orders_bronze: DataFrame) -> DataFrame:
    """How many cancellations left each stage.

    A change carries the row before and after it, so the stage is read off the change itself: no ordering of an order's
    versions and no shuffle but that of the final counts.
    """
    changes = parse_envelope(orders_bronze, ORDERS, before=("status",))
    left = changes.filter(
        (F.col("after.status") == "cancelled") & F.col("before.status").isNotNull() & (F.col("before.status") != "cancelled")
    )
    return left.groupBy(F.col("before.status").alias("stage")).agg(F.count(F.lit(1)).alias("cancellations"))


def payment_methods(stg_payments: DataFrame) -> DataFrame:
    """Use and failure rate per payment method."""
    payments = F.count(F.lit(1))
    failed = F.count_if(F.col("status") == "failed")
    return stg_payments.groupBy("payment_method").agg(
        payments.alias("payments"), failed.alias("failed"), _ratio(failed, payments).alias("failure_rate")
    )


def order_total_gaps(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders whose total differs from the sum of their lines, or is NULL: ``order_id, total_amount, lines_total``."""
    lines = order_items.groupBy("order_id").agg(
        F.sum((F.col("quantity") * F.col("price")).cast("decimal(18,2)")).alias("lines_total")
    )
    both = orders.select(F.col("id").alias("order_id"), "total_amount").join(lines, "order_id", "left")
    total = F.coalesce("lines_total", F.lit(0).cast("decimal(18,2)"))
    return both.select("order_id", "total_amount", total.alias("lines_total")).filter(
        ~F.col("total_amount").eqNullSafe(F.col("lines_total"))
    )


def payment_presence_gaps(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders that break "a payment if and only if not pending": ``order_id, status, payments``. NULL is not pending."""
    paid = payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("payments"))
    both = orders.select(F.col("id").alias("order_id"), "status").join(paid, "order_id", "left")
    count = F.coalesce("payments", F.lit(0))
    return both.select("order_id", "status", count.alias("payments")).filter(
        (F.col("payments") > 0) == F.col("status").eqNullSafe(F.lit("pending"))
    )
