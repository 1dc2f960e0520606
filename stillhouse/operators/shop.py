"""Forty questions about a shop: users, products, orders and order items.

Items outnumber everything else and one product, order or user may hold a large share of them,
so they are summed per key, map-side first, before any join. Ties go to the smaller key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Shop:
    """users(id, email, name, country, created_at), products(id, name, category, price, stock),
    orders(id, user_id, status, total, created_at), items(order_id, product_id, quantity, unit_price)."""

    users: DataFrame
    products: DataFrame
    orders: DataFrame
    items: DataFrame


def _date(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text), F.lit("yyyy-MM-dd"))


def _days_before(today: str, days: int) -> Column:
    return F.date_sub(F.to_date(F.lit(today)), days).cast("timestamp_ntz")


def _month_before(today: str, months: int) -> Column:
    return F.add_months(F.trunc(F.to_date(F.lit(today)), "month"), -months).cast("timestamp_ntz")


def _between(column: str, start: Column, end: Column) -> Column:
    return (F.col(column) >= start) & (F.col(column) < end)


def _money(amount: Column) -> Column:
    return F.round(F.sum(amount), 2)


def _average(amount: Column) -> Column:
    """Mean of money, from the total in cents: the same whatever the order of summing."""
    return _money(amount) / F.count(amount)


def _revenue() -> Column:
    return F.col("quantity") * F.col("unit_price")


def _per_product(s: Shop, value: Column, name: str) -> DataFrame:
    return s.items.groupBy(F.col("product_id").alias("id")).agg(value.alias(name))


def _share(part: Column) -> Column:
    return F.round(F.lit(100.0) * F.count_if(part) / F.nullif(F.count("*"), F.lit(0)), 2)


def orders_last_month(s: Shop, today: str) -> DataFrame:
    last = _between("created_at", _month_before(today, 1), _month_before(today, 0))
    return s.orders.filter(last).agg(F.count("*").alias("order_count"))


def average_order_per_customer(s: Shop) -> DataFrame:
    means = s.orders.groupBy(F.col("user_id").alias("id")).agg(_average(F.col("total")).alias("average_total"))
    return means.join(s.users.select("id", "name"), "id")


def top_products_by_revenue(s: Shop, n: int = 10) -> DataFrame:
    best = _per_product(s, _money(_revenue()), "revenue").orderBy(F.desc("revenue"), "id").limit(n)
    return s.products.select("id", "name").join(F.broadcast(best), "id")


def users_without_orders(s: Shop, since: str | None = None) -> DataFrame:
    orders = s.orders.filter(F.col("created_at") >= _date(since)) if since else s.orders
    buyers = orders.select(F.col("user_id").alias("id")).distinct()
    return s.users.join(buyers, "id", "left_anti").select("id", "name", "email")


def revenue_per_category(s: Shop) -> DataFrame:
    sold = _per_product(s, F.sum(_revenue()), "revenue")
    return s.products.select("id", "category").join(sold, "id").groupBy("category").agg(_money(F.col("revenue")).alias("revenue"))


def orders_above(s: Shop, amount: float = 500.0) -> DataFrame:
    return s.orders.filter(F.col("total") > amount).select("id", "user_id", "total")


def biggest_spender(s: Shop) -> DataFrame:
    spent = s.orders.groupBy(F.col("user_id").alias("id")).agg(_money(F.col("total")).alias("spent"))
    best = spent.orderBy(F.desc("spent"), "id").limit(1)
    return s.users.select("id", "name").join(F.broadcast(best), "id")


def recent_signups(s: Shop, today: str, days: int = 30) -> DataFrame:
    return s.users.filter(_between("created_at", _days_before(today, days), _days_before(today, 0))).agg(F.count("*").alias("signups"))


def most_ordered_products(s: Shop, n: int = 5) -> DataFrame:
    best = _per_product(s, F.count("*"), "times_ordered").orderBy(F.desc("times_ordered"), "id").limit(n)
    return s.products.select("id", "name").join(F.broadcast(best), "id")


def monthly_revenue(s: Shop, today: str, months: int = 12) -> DataFrame:
    span = _between("created_at", _month_before(today, months), _month_before(today, 0))
    month = F.date_format("created_at", "yyyy-MM")
    return s.orders.filter(span).groupBy(month.alias("month")).agg(_money(F.col("total")).alias("revenue"))


def orders_with_status(s: Shop, status: str = "cancelled") -> DataFrame:
    chosen = s.orders.filter(F.col("status") == status).select(F.col("id").alias("order_id"), "user_id", "total")
    users = s.users.select(F.col("id").alias("user_id"), "name", "email")
    return chosen.join(users, "user_id").select("order_id", "name", "email", "total")


def average_items_per_order(s: Shop) -> DataFrame:
    return s.items.groupBy("order_id").agg(F.sum("quantity").alias("n")).agg((F.sum("n") / F.count("*")).alias("average_items"))


def products_never_ordered(s: Shop, since: str | None = None) -> DataFrame:
    items = s.items
    if since:
        recent = s.orders.filter(F.col("created_at") >= _date(since)).select(F.col("id").alias("order_id"))
        items = items.join(recent, "order_id", "left_semi")
    ordered = items.select(F.col("product_id").alias("id")).distinct()
    return s.products.join(ordered, "id", "left_anti").select("id", "name")


def country_with_most_users(s: Shop) -> DataFrame:
    return s.users.groupBy("country").agg(F.count("*").alias("users")).orderBy(F.desc("users"), "country").limit(1)


def orders_from_country(s: Shop, country: str) -> DataFrame:
    users = s.users.filter(F.col("country") == country).select(F.col("id").alias("user_id"))
    return s.orders.join(users, "user_id").select("id", "user_id", "total")


def share_with_status(s: Shop, status: str = "delivered") -> DataFrame:
    return s.orders.agg(_share(F.col("status") == status).alias("percent"))


def top_customers_by_orders(s: Shop, n: int = 3) -> DataFrame:
    counts = s.orders.groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("orders"))
    return s.users.select("id", "name").join(F.broadcast(counts.orderBy(F.desc("orders"), "id").limit(n)), "id")


def stock_value(s: Shop) -> DataFrame:
    return s.products.agg(_money(F.col("price") * F.col("stock")).alias("stock_value"))


def frequent_users(s: Shop, more_than: int = 5) -> DataFrame:
    counts = s.orders.groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("orders"))
    return counts.filter(F.col("orders") > more_than).join(s.users.select("id", "name"), "id")


def revenue_by_status(s: Shop) -> DataFrame:
    return s.orders.groupBy("status").agg(_money(F.col("total")).alias("revenue"))


def dearest_product(s: Shop, category: str = "Electronics") -> DataFrame:
    return s.products.filter(F.col("category") == category).orderBy(F.desc("price"), "id").limit(1).select("id", "name", "price")


def distinct_products_last_week(s: Shop, today: str) -> DataFrame:
    week = s.orders.filter(_between("created_at", _days_before(today, 7), _days_before(today, 0)))
    items = s.items.select("order_id", "product_id").join(week.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    return items.agg(F.count_distinct("product_id").alias("products"))


def orders_with_many_products(s: Shop, more_than: int = 3) -> DataFrame:
    return s.items.groupBy("order_id").agg(F.count_distinct("product_id").alias("products")).filter(F.col("products") > more_than)


def days_to_first_order(s: Shop) -> DataFrame:
    first = s.orders.groupBy(F.col("user_id").alias("id")).agg(F.min("created_at").alias("first"))
    days = F.datediff("first", "created_at")
    return s.users.select("id", "created_at").join(first, "id").agg(
        (F.sum(days) / F.count("*")).alias("average_days"), F.count("*").alias("users")
    )


def products_in_price_band(s: Shop, low: float = 10.0, high: float = 50.0) -> DataFrame:
    return s.products.filter(F.col("price").between(low, high)).select("id", "name", "price").orderBy(F.desc("price"), "id")


def category_with_highest_average_order(s: Shop) -> DataFrame:
    bought = s.items.select("order_id", "product_id").distinct()
    categories = bought.join(s.products.select(F.col("id").alias("product_id"), "category"), "product_id").select("order_id", "category").distinct()
    totals = s.orders.select(F.col("id").alias("order_id"), "total")
    means = categories.join(totals, "order_id").groupBy("category").agg(_average(F.col("total")).alias("average_total"))
    return means.orderBy(F.desc("average_total"), "category").limit(1)


def duplicate_emails(s: Shop) -> DataFrame:
    return s.users.groupBy("email").agg(F.count("*").alias("users")).filter("users > 1")


def items_sold_per_product(s: Shop) -> DataFrame:
    sold = _per_product(s, F.sum("quantity"), "sold")
    return s.products.select("id", "name").join(sold, "id", "left").withColumn("sold", F.coalesce("sold", F.lit(0.0)))


def top_countries_by_revenue(s: Shop, n: int = 5) -> DataFrame:
    spent = s.orders.groupBy(F.col("user_id").alias("id")).agg(F.sum("total").alias("spent"))
    sums = s.users.select("id", "country").join(spent, "id").groupBy("country").agg(_money(F.col("spent")).alias("revenue"))
    return sums.orderBy(F.desc("revenue"), "country").limit(n)


def users_active_in_both(s: Shop, first_month: str, second_month: str) -> DataFrame:
    def buyers(month: str) -> DataFrame:
        start = _date(f"{month}-01")
        span = _between("created_at", start, F.add_months(F.to_date(F.lit(f"{month}-01")), 1).cast("timestamp_ntz"))
        return s.orders.filter(span).select(F.col("user_id").alias("id"))

    return s.users.select("id", "name").join(buyers(first_month).intersect(buyers(second_month)), "id")


def refund_rate(s: Shop, status: str = "cancelled") -> DataFrame:
    return s.orders.agg((F.count_if(F.col("status") == status) / F.nullif(F.count("*"), F.lit(0))).alias("refund_rate"))


def busiest_weekday(s: Shop) -> DataFrame:
    day = F.dayofweek("created_at").cast("bigint")
    return s.orders.groupBy(day.alias("weekday")).agg(F.count("*").alias("orders")).orderBy(F.desc("orders"), "weekday").limit(1)


def out_of_stock(s: Shop) -> DataFrame:
    return s.products.filter("stock = 0").select("id", "name")


def average_total_of_statuses(s: Shop, statuses: tuple[str, str] = ("shipped", "delivered")) -> DataFrame:
    return s.orders.filter(F.col("status").isin(*statuses)).groupBy("status").agg(_average(F.col("total")).alias("average_total"))


def latest_order_per_customer(s: Shop) -> DataFrame:
    newest = F.max(F.struct("created_at", F.col("id").alias("order_id"), "total"))
    return s.orders.groupBy("user_id").agg(newest.alias("o")).select(
        "user_id", "o.order_id", "o.total", F.date_format("o.created_at", "yyyy-MM-dd").alias("day")
    )


def orders_per_day(s: Shop, today: str, days: int = 7) -> DataFrame:
    """One row for each of the last days, zero where nothing was ordered."""
    span = _between("created_at", _days_before(today, days), _days_before(today, 0))
    counts = s.orders.filter(span).groupBy(F.to_date("created_at").alias("d")).agg(F.count("*").alias("n"))
    spine = s.orders.sparkSession.range(1, days + 1).select(F.date_sub(F.to_date(F.lit(today)), F.col("id").cast("int")).alias("d"))
    return spine.join(counts, "d", "left").select(
        F.date_format("d", "yyyy-MM-dd").alias("day"), F.coalesce("n", F.lit(0)).alias("orders")
    )


def names_starting_with(s: Shop, prefix: str = "J") -> DataFrame:
    return s.users.filter(F.startswith("name", F.lit(prefix))).select("id", "name")


def quantity_of_category(s: Shop, category: str = "Clothing") -> DataFrame:
    chosen = s.products.filter(F.col("category") == category).select("id")
    return _per_product(s, F.sum("quantity"), "sold").join(chosen, "id", "left_semi").agg(F.sum("sold").alias("quantity"))


def status_summary(s: Shop) -> DataFrame:
    """Count and revenue per status, with a total row (null status)."""
    return s.orders.rollup("status").agg(F.count("*").alias("orders"), _money(F.col("total")).alias("revenue"))


def buyers_of_product(s: Shop, product: int = 42) -> DataFrame:
    orders = s.items.filter(F.col("product_id") == product).select(F.col("order_id").alias("id")).distinct()
    buyers = s.orders.select("id", "user_id").join(orders, "id").select(F.col("user_id").alias("id")).distinct()
    return s.users.select("id", "name").join(buyers, "id", "left_semi")
