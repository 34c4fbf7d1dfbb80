"""Retail source tables (users, orders, order_items, products).

The engine's models read four raw tables with the shop schema below. When
the raw data is TPC-H shaped (the driver's test data), ``from_tpch`` derives
the four tables with DataFrame expressions only: every column is a function
of the TPC-H columns, so the work grows with the input.

Mapping (fixed values of the test fixture):

* users: ``customer`` x 10 (user id ``c_custkey*10 + k``, k = 0..9),
  traffic_source = c_mktsegment, country/city/state = nation name,
  age = 18 + id % 60, gender = 'M' when id is even else 'F',
  created_at = 1995-01-01 00:00:00.
* orders: order_id = o_orderkey, user_id = o_custkey*10 + o_orderkey % 10,
  status from (o_orderstatus, o_orderpriority): F and 1-URGENT Returned,
  F Complete, O and 5-LOW Cancelled, O Shipped, else Processing;
  created_at = o_orderdate; shipped/delivered/returned = +1/+4/+14 days when
  the status has reached that stage; num_of_item = number of lineitem rows.
* order_items: id = 'orderkey|linenumber|partkey|suppkey|price in cents',
  status: linenumber 7 and linestatus O Cancelled, returnflag R Returned,
  linestatus F Complete, returnflag A Shipped, else Processing;
  shipped_at = l_shipdate, delivered_at = +3 days, returned_at = l_shipdate
  when returnflag R; sale_price = l_extendedprice; user_id and created_at
  from the order header.
* products: id = p_partkey, category = brand = p_brand, department 'Men'
  for even p_size else 'Women', cost = 25 x p_retailprice,
  retail_price = 50 x p_retailprice.

Plan notes. Orders are not grouped: a repeated order key stays repeated, so the
uniqueness checks can fail, and filters on status and date reach the scan. The
category mart reads nothing of the order, so it takes ``item_lines`` and never
shuffles lineitem by order key; that equals reading the full items as long as
``unique(order_id)`` passes. Customers are spread before each becomes ten users
(``CUSTOMERS_PER_TASK``). The nation lookup is tiny and is broadcast by the
planner's own size rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cartwright.sources.tables import TableSource

# Fixed values of the fixture mapping.
USERS_PER_CUSTOMER = 10
USER_CREATED_AT = "1995-01-01 00:00:00"
COST_FACTOR = 25
RETAIL_FACTOR = 50
SHIP_DAYS, DELIVER_DAYS, RETURN_DAYS = 1, 4, 14
ITEM_DELIVER_DAYS = 3

#: customers whose users one task makes. A customer is few bytes and becomes ten users, so
#: splits by bytes alone leave millions of users to one task and what groups them there
CUSTOMERS_PER_TASK = 100_000


@dataclass
class RetailSources:
    """The four raw shop tables as lazy DataFrames."""

    users: DataFrame
    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    #: order items without columns of their order, for models that read none of them
    item_lines: DataFrame


def _gender(user_id: Column) -> Column:
    return F.when(user_id % 2 == 0, F.lit("M")).otherwise(F.lit("F"))


def _days(ts: Column, n: int) -> Column:
    return ts + F.expr(f"INTERVAL {n} DAY")


def _order_status() -> Column:
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (F.when((st == "F") & (pr == "1-URGENT"), "Returned")
            .when(st == "F", "Complete")
            .when((st == "O") & (pr == "5-LOW"), "Cancelled")
            .when(st == "O", "Shipped")
            .otherwise("Processing"))


def _item_status() -> Column:
    return (F.when((F.col("l_linenumber") == 7) & (F.col("l_linestatus") == "O"), "Cancelled")
            .when(F.col("l_returnflag") == "R", "Returned")
            .when(F.col("l_linestatus") == "F", "Complete")
            .when(F.col("l_returnflag") == "A", "Shipped")
            .otherwise("Processing"))


def _spread(rows: DataFrame, key: str, most: int) -> DataFrame:
    """The rows dealt by key over tasks of about ``most`` rows; a table without more stays as it is.

    The number is that of the file footers, not an estimate. It is set, so adaptive
    execution does not merge the tasks again for their few bytes.
    """
    tasks = -(-rows.count() // most)
    return rows.repartition(tasks, key) if tasks > 1 else rows


def users_from_tpch(tables: TableSource) -> DataFrame:
    c = _spread(tables["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
                "c_custkey", CUSTOMERS_PER_TASK)
    n = tables["nation"].select("n_nationkey", "n_name")
    fanned = c.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(USERS_PER_CUSTOMER - 1))))
    uid = F.col("c_custkey") * USERS_PER_CUSTOMER + F.col("k")
    return (fanned.join(n, fanned.c_nationkey == n.n_nationkey, "left")
            .select(uid.alias("id"),
                    F.col("c_name").alias("first_name"),
                    F.col("c_name").alias("last_name"),
                    F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
                    (F.lit(18) + uid % 60).alias("age"),
                    _gender(uid).alias("gender"),
                    F.col("n_name").alias("city"),
                    F.col("n_name").alias("state"),
                    F.col("n_name").alias("country"),
                    F.col("c_mktsegment").alias("traffic_source"),
                    F.expr(f"TIMESTAMP_NTZ '{USER_CREATED_AT}'").alias("created_at")))


def orders_from_tpch(tables: TableSource) -> DataFrame:
    hdr = tables["orders"]
    counts = (tables["lineitem"].groupBy("l_orderkey")
              .agg(F.count(F.lit(1)).alias("n_items")))
    status = _order_status()
    uid = F.col("o_custkey") * USERS_PER_CUSTOMER + F.col("o_orderkey") % USERS_PER_CUSTOMER
    created = F.col("o_orderdate")
    j = hdr.join(counts, hdr.o_orderkey == counts.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        uid.alias("user_id"),
        status.alias("status"),
        _gender(uid).alias("gender"),
        created.alias("created_at"),
        F.when(status == "Returned", _days(created, RETURN_DAYS)).alias("returned_at"),
        F.when(status.isin("Shipped", "Complete", "Returned"), _days(created, SHIP_DAYS)).alias("shipped_at"),
        F.when(status.isin("Complete", "Returned"), _days(created, DELIVER_DAYS)).alias("delivered_at"),
        F.coalesce(F.col("n_items"), F.lit(0).cast("bigint")).alias("num_of_item"),
    )


def item_lines_from_tpch(tables: TableSource) -> DataFrame:
    """Order items without what they take over from their order."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    item_id = F.concat_ws("|", *[F.col(c).cast("string") for c in
                                 ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                          cents.cast("string"))
    return tables["lineitem"].select(
        item_id.alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        _item_status().alias("status"),
        F.col("l_shipdate").alias("shipped_at"),
        _days(F.col("l_shipdate"), ITEM_DELIVER_DAYS).alias("delivered_at"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("returned_at"),
        F.col("l_extendedprice").alias("sale_price"))


def order_items_from_tpch(tables: TableSource) -> DataFrame:
    """Order items with buyer and time of their order; a repeated order repeats its items."""
    hdr = tables["orders"].select(
        F.col("o_orderkey"),
        (F.col("o_custkey") * USERS_PER_CUSTOMER + F.col("o_orderkey") % USERS_PER_CUSTOMER).alias("user_id"),
        F.col("o_orderdate").alias("created_at"))
    lines = item_lines_from_tpch(tables)
    return lines.join(hdr, lines.order_id == hdr.o_orderkey, "left").select(
        "id", "order_id", "user_id", "product_id", "status", "created_at", "shipped_at",
        "delivered_at", "returned_at", "sale_price")


def products_from_tpch(tables: TableSource) -> DataFrame:
    p = tables["part"]
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_brand").alias("category"),
        F.when(F.col("p_size") % 2 == 0, "Men").otherwise("Women").alias("department"),
        (F.col("p_retailprice") * COST_FACTOR).alias("cost"),
        (F.col("p_retailprice") * RETAIL_FACTOR).alias("retail_price"),
    )


def from_tpch(tables: TableSource) -> RetailSources:
    return RetailSources(users=users_from_tpch(tables),
                         orders=orders_from_tpch(tables),
                         order_items=order_items_from_tpch(tables),
                         products=products_from_tpch(tables),
                         item_lines=item_lines_from_tpch(tables))


def from_tables(tables: TableSource, names: dict | None = None) -> RetailSources:
    """Shop-schema tables stored as such (Parquet folders or catalog names)."""
    names = names or {}
    items = tables[names.get("order_items", "order_items")]
    return RetailSources(users=tables[names.get("users", "users")],
                         orders=tables[names.get("orders", "orders")],
                         order_items=items,
                         products=tables[names.get("products", "products")],
                         item_lines=items)
