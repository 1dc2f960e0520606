"""Registered queries: the question catalogue over customer, part, orders and lineitem.

The tables stand in for the shop schema: customer (with its nation) for users, part for products,
lineitem for order items. Email, stock and sign-up date do not exist there and are derived from
the keys. "Today" is 2001-07-15.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stillhouse.operators import shop as q
from stillhouse.plans.registry import Tables, registered

TODAY = "2001-07-15"
SIGNUP_DAYS = 2752

USERS = f"""users AS (SELECT c_custkey AS id, c_name AS name, n_name AS country,
  'user' || (c_custkey - CASE WHEN c_custkey % 50 = 49 THEN 1 ELSE 0 END) || '@mail.example.com' AS email,
  TIMESTAMP '1994-01-01' + to_days(((c_custkey * 37) % {SIGNUP_DAYS})::INT) AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
PRODUCTS = "products AS (SELECT p_partkey AS id, p_name AS name, p_type AS category, p_retailprice AS price, (p_partkey % 7) * p_size AS stock FROM part)"
ORDERS = "o AS (SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS status, o_totalprice AS total, o_orderdate AS created_at FROM orders)"
ITEMS = "items AS (SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity, l_extendedprice AS revenue FROM lineitem)"
ALL = f"WITH {USERS}, {PRODUCTS}, {ORDERS}, {ITEMS} "


def shop(t: Tables) -> q.Shop:
    key = F.col("c_custkey")
    users = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("id"), F.col("c_name").alias("name"), F.col("n_name").alias("country"),
        F.concat(F.lit("user"), (key - F.when(key % 50 == 49, 1).otherwise(0)).cast("string"), F.lit("@mail.example.com")).alias("email"),
        F.date_add(F.lit("1994-01-01").cast("date"), ((key * 37) % SIGNUP_DAYS).cast("int")).cast("timestamp_ntz").alias("created_at"),
    )
    products = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"), ((F.col("p_partkey") % 7) * F.col("p_size")).alias("stock"),
    )
    orders = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"), F.col("o_orderdate").alias("created_at"),
    )
    items = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )
    return q.Shop(users, products, orders, items)


def ask(number: int, name: str, question, sql: str, **parameters) -> None:
    registered(f"q{number:02d}_{name}", ALL + sql)(lambda t: question(shop(t), **parameters))


ask(1, "orders_last_month", q.orders_last_month,
    "SELECT count(*) AS order_count FROM o WHERE created_at >= '2001-06-01' AND created_at < '2001-07-01'", today=TODAY)
ask(2, "average_order_per_customer", q.average_order_per_customer,
    "SELECT u.id, name, round(sum(total), 2) / count(*) AS average_total FROM o JOIN users u ON u.id = user_id GROUP BY u.id, name")
ask(3, "top_products_by_revenue", q.top_products_by_revenue,
    "SELECT p.id, name, round(sum(revenue), 2) AS revenue FROM items JOIN products p ON p.id = product_id GROUP BY p.id, name ORDER BY 3 DESC, 1 LIMIT 10")
ask(4, "users_without_orders", q.users_without_orders,
    "SELECT id, name, email FROM users WHERE id NOT IN (SELECT user_id FROM o WHERE created_at >= '2001-01-01')", since="2001-01-01")
ask(5, "revenue_per_category", q.revenue_per_category,
    "SELECT category, round(sum(revenue), 2) AS revenue FROM items JOIN products p ON p.id = product_id GROUP BY category")
ask(6, "orders_above", q.orders_above, "SELECT id, user_id, total FROM o WHERE total > 400000", amount=400000.0)
ask(7, "biggest_spender", q.biggest_spender,
    "SELECT u.id, name, round(sum(total), 2) AS spent FROM o JOIN users u ON u.id = user_id GROUP BY u.id, name ORDER BY 3 DESC, 1 LIMIT 1")
ask(8, "recent_signups", q.recent_signups,
    "SELECT count(*) AS signups FROM users WHERE created_at >= DATE '2001-07-15' - 30 AND created_at < DATE '2001-07-15'", today=TODAY)
ask(9, "most_ordered_products", q.most_ordered_products,
    "SELECT p.id, name, count(*) AS times_ordered FROM items JOIN products p ON p.id = product_id GROUP BY p.id, name ORDER BY 3 DESC, 1 LIMIT 5")
ask(10, "monthly_revenue", q.monthly_revenue,
    "SELECT strftime(created_at, '%Y-%m') AS month, round(sum(total), 2) AS revenue FROM o WHERE created_at >= '2000-07-01' AND created_at < '2001-07-01' GROUP BY 1", today=TODAY)
ask(11, "cancelled_orders", q.orders_with_status,
    "SELECT o.id AS order_id, name, email, total FROM o JOIN users u ON u.id = user_id WHERE status = 'P'", status="P")
ask(12, "average_items_per_order", q.average_items_per_order,
    "SELECT sum(quantity) / count(DISTINCT order_id) AS average_items FROM items")
ask(13, "products_never_ordered", q.products_never_ordered,
    "SELECT id, name FROM products WHERE id NOT IN (SELECT product_id FROM items JOIN o ON o.id = order_id WHERE created_at >= '2001-05-01')", since="2001-05-01")
ask(14, "country_with_most_users", q.country_with_most_users,
    "SELECT country, count(*) AS users FROM users GROUP BY country ORDER BY 2 DESC, 1 LIMIT 1")
ask(15, "orders_from_country", q.orders_from_country,
    "SELECT o.id, user_id, total FROM o JOIN users u ON u.id = user_id WHERE country = 'NATION_7'", country="NATION_7")
ask(16, "share_delivered", q.share_with_status,
    "SELECT round(100.0::DOUBLE * count(*) FILTER (WHERE status = 'F') / count(*), 2) AS percent FROM o", status="F")
ask(17, "top_customers_by_orders", q.top_customers_by_orders,
    "SELECT u.id, name, count(*) AS orders FROM o JOIN users u ON u.id = user_id GROUP BY u.id, name ORDER BY 3 DESC, 1 LIMIT 3")
ask(18, "stock_value", q.stock_value, "SELECT round(sum(price * stock), 2) AS stock_value FROM products")
ask(19, "frequent_users", q.frequent_users,
    "SELECT u.id, name, count(*) AS orders FROM o JOIN users u ON u.id = user_id GROUP BY u.id, name HAVING count(*) > 5")
ask(20, "revenue_by_status", q.revenue_by_status, "SELECT status, round(sum(total), 2) AS revenue FROM o GROUP BY status")
ask(21, "dearest_product", q.dearest_product,
    "SELECT id, name, price FROM products WHERE category = 'PROMO' ORDER BY price DESC, id LIMIT 1", category="PROMO")
ask(22, "distinct_products_last_week", q.distinct_products_last_week,
    "SELECT count(DISTINCT product_id) AS products FROM items JOIN o ON o.id = order_id WHERE created_at >= DATE '2001-07-15' - 7 AND created_at < DATE '2001-07-15'", today=TODAY)
ask(23, "orders_with_many_products", q.orders_with_many_products,
    "SELECT order_id, count(DISTINCT product_id) AS products FROM items GROUP BY order_id HAVING count(DISTINCT product_id) > 3")
ask(24, "days_to_first_order", q.days_to_first_order,
    "SELECT sum(d)::DOUBLE / count(*) AS average_days, count(*) AS users FROM (SELECT date_diff('day', u.created_at, min(o.created_at)) AS d FROM users u JOIN o ON u.id = user_id GROUP BY u.id, u.created_at)")
ask(25, "products_in_price_band", q.products_in_price_band,
    "SELECT id, name, price FROM products WHERE price BETWEEN 950 AND 1000 ORDER BY price DESC, id", low=950.0, high=1000.0)
ask(26, "category_with_highest_average_order", q.category_with_highest_average_order,
    "SELECT category, round(sum(total), 2) / count(*) AS average_total FROM (SELECT DISTINCT order_id, category FROM items JOIN products p ON p.id = product_id) JOIN o ON o.id = order_id GROUP BY category ORDER BY 2 DESC, 1 LIMIT 1")
ask(27, "duplicate_emails", q.duplicate_emails, "SELECT email, count(*) AS users FROM users GROUP BY email HAVING count(*) > 1")
ask(28, "items_sold_per_product", q.items_sold_per_product,
    "SELECT p.id, name, coalesce(sum(quantity), 0)::DOUBLE AS sold FROM products p LEFT JOIN items ON p.id = product_id GROUP BY p.id, name")
ask(29, "top_countries_by_revenue", q.top_countries_by_revenue,
    "SELECT country, round(sum(total), 2) AS revenue FROM o JOIN users u ON u.id = user_id GROUP BY country ORDER BY 2 DESC, 1 LIMIT 5")
ask(30, "users_active_in_both", q.users_active_in_both,
    "SELECT id, name FROM users WHERE id IN (SELECT user_id FROM o WHERE strftime(created_at, '%Y-%m') = '2001-01') AND id IN (SELECT user_id FROM o WHERE strftime(created_at, '%Y-%m') = '2001-02')",
    first_month="2001-01", second_month="2001-02")
ask(31, "refund_rate", q.refund_rate, "SELECT count(*) FILTER (WHERE status = 'P') / count(*) AS refund_rate FROM o", status="P")
ask(32, "busiest_weekday", q.busiest_weekday,
    "SELECT dayofweek(created_at) + 1 AS weekday, count(*) AS orders FROM o GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
ask(33, "out_of_stock", q.out_of_stock, "SELECT id, name FROM products WHERE stock = 0")
ask(34, "average_total_of_statuses", q.average_total_of_statuses,
    "SELECT status, round(sum(total), 2) / count(*) AS average_total FROM o WHERE status IN ('O', 'F') GROUP BY status", statuses=("O", "F"))
ask(35, "latest_order_per_customer", q.latest_order_per_customer,
    "SELECT user_id, id AS order_id, total, strftime(created_at, '%Y-%m-%d') AS day FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, id DESC) AS rn FROM o) WHERE rn = 1")
ask(36, "orders_per_day", q.orders_per_day,
    "SELECT strftime(d, '%Y-%m-%d') AS day, count(o.id) AS orders FROM (SELECT unnest(generate_series(TIMESTAMP '2001-07-08', TIMESTAMP '2001-07-14', INTERVAL 1 DAY)) AS d) LEFT JOIN o ON date_trunc('day', created_at) = d GROUP BY d", today=TODAY)
ask(37, "names_starting_with", q.names_starting_with, "SELECT id, name FROM users WHERE name LIKE 'Customer#00000012%'", prefix="Customer#00000012")
ask(38, "quantity_of_category", q.quantity_of_category,
    "SELECT sum(quantity) AS quantity FROM items JOIN products p ON p.id = product_id WHERE category = 'SMALL'", category="SMALL")
ask(39, "status_summary", q.status_summary, "SELECT status, count(*) AS orders, round(sum(total), 2) AS revenue FROM o GROUP BY ROLLUP (status)")
ask(40, "buyers_of_product", q.buyers_of_product,
    "SELECT id, name FROM users WHERE id IN (SELECT user_id FROM o JOIN items ON o.id = order_id WHERE product_id = 42)")
