"""Data-quality checks as Spark jobs (DQ1-DQ7, AG27, JN6, ST1).

Each generic check counts failures, as generic column tests do:

* ``not_null``        rows where the column is NULL;
* ``unique``          distinct non-NULL keys that occur more than once (a key of
                      several columns is written with commas; a row with a NULL
                      part passes);
* ``accepted_values`` distinct values outside the list (NULL passes);
* ``relationships``   child rows with a non-NULL key missing in the parent.

``run_checks`` reads a model once for all its not-null, unique and
accepted-value checks. Every row gives one entry for each key and one for each
value that fails; the entries of all models are grouped by (check, typed
fingerprint) in one shuffle and then summed up by check, so a hot key is one row
a task and no check has a job of its own.

Relationships between whole-number keys are screened by exact bitmaps: the keys
of each side become words of 64 keys, or-ed together before the shuffle, and a
word of the child with a bit that the parent's lacks holds an orphan. Only child
rows in such words go on to the exact anti join, so a clean child moves one word
for up to 64 keys and nothing else. (A Bloom filter of the parent's keys could
not do this: it proves that a key is missing, never that it is there.)

``bounds`` holds rates against a table of rules (metric, least, most).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

@dataclass(frozen=True)
class Check:
    test: str                     # not_null | unique | accepted_values | relationships
    model: str
    column: str                   # for unique also several, with commas
    values: tuple = ()            # accepted values
    parent: str = ""              # relationships: parent model
    parent_column: str = ""


def _nn(model, *cols):
    return [Check("not_null", model, c) for c in cols]


def _uq(model, *cols):
    return [Check("unique", model, c) for c in cols]


# fixed values: the accepted order statuses
ORDER_STATUSES = ("Processing", "Shipped", "Complete", "Returned", "Cancelled")

# The 36 generic tests (staging 12, marts 15, analytics 9) and the composite key of the
# category mart ...
SHOP_CHECKS: list[Check] = [
    *_nn("stg_order_items", "order_item_id"), *_uq("stg_order_items", "order_item_id"),
    *_nn("stg_order_items", "order_id", "user_id", "product_id"),
    *_nn("stg_orders", "order_id"), *_uq("stg_orders", "order_id"),
    *_nn("stg_orders", "user_id"),
    *_nn("stg_users", "user_id"), *_uq("stg_users", "user_id"),
    *_nn("stg_products", "product_id"), *_uq("stg_products", "product_id"),
    *_nn("dim_users", "user_id"), *_uq("dim_users", "user_id"),
    *_nn("dim_products", "product_id"), *_uq("dim_products", "product_id"),
    *_nn("dim_orders", "order_id"), *_uq("dim_orders", "order_id"),
    Check("accepted_values", "dim_orders", "status", ORDER_STATUSES),
    *_nn("fct_order_items", "order_item_id"), *_uq("fct_order_items", "order_item_id"),
    *_nn("fct_order_items", "order_id"),
    Check("relationships", "fct_order_items", "order_id", parent="dim_orders", parent_column="order_id"),
    *_nn("fct_order_items", "user_id"),
    Check("relationships", "fct_order_items", "user_id", parent="dim_users", parent_column="user_id"),
    *_nn("fct_order_items", "product_id"),
    Check("relationships", "fct_order_items", "product_id", parent="dim_products", parent_column="product_id"),
    *_nn("mart_category_performance", "category", "gross_revenue", "gross_margin"),
    *_uq("mart_category_performance", "category, department"),
    *_nn("mart_customer_retention", "cohort_month"), *_uq("mart_customer_retention", "cohort_month"),
    *_nn("mart_customer_retention", "repeat_purchase_rate"),
    *_nn("mart_channel_performance", "traffic_source"), *_uq("mart_channel_performance", "traffic_source"),
    *_nn("mart_channel_performance", "revenue_per_customer"),
]

# ... and the assignment/fact checks the experiment write-up claims.
EXPERIMENT_CHECKS: list[Check] = [
    *_nn("stg_experiment_assignments", "user_id"), *_uq("stg_experiment_assignments", "user_id"),
    *_nn("stg_experiment_assignments", "variant"),
    Check("accepted_values", "stg_experiment_assignments", "variant", ("control", "treatment")),
    *_nn("fct_experiment_results", "order_id"), *_uq("fct_experiment_results", "order_id"),
    Check("accepted_values", "fct_experiment_results", "variant", ("control", "treatment")),
    *_nn("stg_experiment_assignments", "variant_key"),
    Check("accepted_values", "stg_experiment_assignments", "variant_key", (0, 1)),
    *_nn("fct_experiment_results", "variant", "user_id", "order_value", "order_status"),
    Check("accepted_values", "fct_experiment_results", "order_status", ("Complete", "Returned")),
    Check("relationships", "fct_experiment_results", "user_id",
          parent="stg_experiment_assignments", parent_column="user_id"),
]

ALL_CHECKS = SHOP_CHECKS + EXPERIMENT_CHECKS


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of ``column`` that occur more than once.

    For a wide (string) key the shuffle first moves only a 64-bit hash:
    hashes seen more than once are found, then only the rows carrying such a
    hash are grouped on the exact value, which also discards hash
    collisions. Fixed-width keys are grouped directly. Partial aggregation
    collapses a hot value map-side in both passes.
    """
    col = F.col(column)
    rows = df.select(col).where(col.isNotNull())
    if dict(df.dtypes)[column] in ("string", "binary"):
        h = F.xxhash64(col)
        dup_hashes = (rows.groupBy(h.alias("_h")).count().where(F.col("count") > 1)
                          .select("_h"))
        rows = rows.withColumn("_h", h).join(dup_hashes, "_h", "left_semi").drop("_h")
    return rows.groupBy(column).count().where(F.col("count") > 1)


#: orphaned words that are handed on as a list; with more, the anti join takes all rows
MOST_WORDS = 100_000


def _whole_number(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _word(key: Column) -> Column:
    """The number of the 64 keys that a key belongs to."""
    return F.shiftright(key, 6)


def _keys(sides: list[tuple[int, DataFrame, str]]) -> DataFrame:
    """(check, key): the non-NULL keys of all checks, each table read once."""
    by_table: dict[int, tuple[DataFrame, list]] = {}
    for i, df, column in sides:
        by_table.setdefault(id(df), (df, []))[1].append(F.struct(
            F.lit(i).alias("check"), F.col(column).cast("long").alias("key")))
    out = None
    for df, columns in by_table.values():
        part = df.select(F.explode(F.array(*columns)).alias("e")).select("e.*").where(
            F.col("key").isNotNull())
        out = part if out is None else out.unionAll(part)
    return out


def orphan_words(links: list[tuple[int, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(check, word): where children have a key that their parent lacks; exact."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"),
                          F.col("key").bitwiseAND(F.lit(63)).cast("int"))
    none = F.lit(0).cast("long")
    children = _keys([(i, child, column) for i, child, column, _, _ in links])
    parents = _keys([(i, parent, column) for i, _, _, parent, column in links])
    keys = children.select("check", _word(F.col("key")).alias("word"), bit.alias("child"),
                           none.alias("parent")).unionAll(
        parents.select("check", _word(F.col("key")).alias("word"), none.alias("child"),
                       bit.alias("parent")))
    words = keys.groupBy("check", "word").agg(F.bit_or("child").alias("child"),
                                              F.bit_or("parent").alias("parent"))
    return words.where(F.col("child").bitwiseAND(F.bitwise_not("parent")) != 0).select(
        "check", "word")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row: the number of child rows whose non-NULL key has no parent.

    Child rows are counted per key first, so the anti join moves one row per
    distinct key (not one per item) and a hot key is one row; the failure
    count is the sum of the orphaned keys' row counts.
    """
    per_key = (child.where(F.col(column).isNotNull())
                    .groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("_n")))
    keys = parent.select(F.col(parent_column).alias("_k"))
    orphans = per_key.join(keys, "_k", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("failures"))


def screened_orphans(links: list[tuple[int, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(check, failures): orphans of whole-number keys, for all checks at once."""
    found = (orphan_words(links).limit(MOST_WORDS + 1)
             .agg(F.collect_list(F.struct("check", "word")).alias("s"))
             .select(F.when(F.size("s") <= MOST_WORDS, F.col("s")).alias("s")))

    def suspects(keys: DataFrame) -> DataFrame:
        # one short list for all checks, read as a scalar subquery: mostly it is empty
        rows = keys.withColumn("_suspects", found.scalar())
        at = F.struct("check", _word(F.col("key")).alias("word"))
        return rows.where(F.coalesce(F.array_contains("_suspects", at), F.lit(True))).select(
            "check", "key")

    children = suspects(_keys([(i, child, column) for i, child, column, _, _ in links]))
    parents = suspects(_keys([(i, parent, column) for i, _, _, parent, column in links]))
    per_key = children.groupBy("check", "key").agg(F.count(F.lit(1)).alias("_n"))
    return (per_key.join(parents, ["check", "key"], "left_anti")
            .groupBy("check").agg(F.sum("_n").alias("failures")))


def fingerprint(columns: list[str], df: DataFrame) -> Column:
    """A typed key as two numbers; NULL if a part is NULL.

    A single whole number stands for itself, so its check is exact. Other keys
    are hashed to 128 bits: among 10^12 different keys two share them with a
    probability below 10^-14.
    """
    cols = [F.col(c) for c in columns]
    known = cols[0].isNotNull()
    for c in cols[1:]:
        known = known & c.isNotNull()
    if len(columns) == 1 and _whole_number(df, columns[0]):
        pair = F.struct(cols[0].cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    else:
        pair = F.struct(F.xxhash64(*cols).alias("a"),
                        F.xxhash64(F.lit("second"), *cols, F.lit(len(cols))).alias("b"))
    return F.when(known, pair)


def _entries(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """(check, key, value): an entry for each key, NULL and value outside its list, of one read."""
    none = F.lit(None)
    entry = lambda i, key, value: F.struct(
        F.lit(i).alias("check"), key.cast("struct<a:bigint,b:bigint>").alias("key"),
        value.cast("string").alias("value"))
    parts = []
    for i, ch in checks:
        if ch.test == "unique":
            key = fingerprint([c.strip() for c in ch.column.split(",")], df)
            parts.append(F.when(key.isNotNull(), entry(i, key, none)))
        elif ch.test == "not_null":
            parts.append(F.when(F.col(ch.column).isNull(), entry(i, none, none)))
        elif ch.test == "accepted_values":
            parts.append(F.when(~F.col(ch.column).isin(*ch.values), entry(i, none, F.col(ch.column))))
    if not parts:
        raise ValueError(f"no check reads this model: {checks}")
    return df.select(F.explode(F.array_compact(F.array(*parts))).alias("e")).select("e.*")


def run_checks(models: dict[str, DataFrame], checks: list[Check] = ALL_CHECKS) -> DataFrame:
    """One row per check: test_name, model, column_name, failures, passed."""
    by_model: dict[str, list[tuple[int, Check]]] = {}
    links = []
    slow = []
    for i, ch in enumerate(checks):
        if ch.test != "relationships":
            by_model.setdefault(ch.model, []).append((i, ch))
        else:
            link = (i, models[ch.model], ch.column, models[ch.parent], ch.parent_column)
            exact = _whole_number(link[1], ch.column) and _whole_number(link[3], ch.parent_column)
            (links if exact else slow).append(link)
    parts = []
    if by_model:
        rows = None
        for model, items in by_model.items():
            more = _entries(models[model], items)
            rows = more if rows is None else rows.unionAll(more)
        groups = rows.groupBy("check", "key", "value").agg(F.count(F.lit(1)).alias("n"))
        # a NULL fails by row, a key by group with several rows, a value by group
        failures = F.when(F.col("key").isNotNull(), (F.col("n") > 1).cast("long")).when(
            F.col("value").isNotNull(), F.lit(1)).otherwise(F.col("n"))
        parts.append(groups.groupBy("check").agg(F.sum(failures).alias("failures")))
    if links:
        parts.append(screened_orphans(links))
    parts += [orphan_rows(*link).select(F.lit(i).alias("check"), "failures")
              for i, *link in slow]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    # checks without failures may have no row: the list itself is the left side
    named = F.array(*[F.struct(F.lit(i).alias("check"), F.lit(ch.test).alias("test_name"),
                               F.lit(ch.model).alias("model"), F.lit(ch.column).alias("column_name"))
                      for i, ch in enumerate(checks)])
    counted = found.agg(F.map_from_entries(F.collect_list(F.struct("check", "failures"))).alias("f"))
    failures = F.coalesce(F.col("f")[F.col("check")], F.lit(0)).cast("bigint")
    return (counted.select("f", F.explode(named).alias("c")).select("f", "c.*")
            .select("check", "test_name", "model", "column_name", failures.alias("failures"),
                    (failures == 0).alias("passed"))
            .orderBy("check").drop("check"))


@dataclass(frozen=True)
class Bound:
    metric: str                   # the name that a failing row carries
    model: str
    column: str
    least: float
    most: float


#: the column that names a row of each mart
GRAINS = {"mart_category_performance": "category", "mart_customer_retention": "cohort_month",
          "mart_channel_performance": "traffic_source"}
#: every proportion in [0, 1], the margin in [-1, 1]
RATE_BOUNDS = (
    Bound("category return_rate", "mart_category_performance", "return_rate", 0, 1),
    Bound("category gross_margin_pct", "mart_category_performance", "gross_margin_pct", -1, 1),
    Bound("cohort repeat_purchase_rate", "mart_customer_retention", "repeat_purchase_rate", 0, 1),
    Bound("channel repeat_purchase_rate", "mart_channel_performance", "repeat_purchase_rate", 0, 1),
)
#: what a shop of this size usually shows; rows outside deserve a look
USUAL_BOUNDS = (
    Bound("category return_rate", "mart_category_performance", "return_rate", 0.345, 0.37),
    Bound("category gross_margin_pct", "mart_category_performance", "gross_margin_pct", 0.5, 0.555),
    Bound("cohort repeat_purchase_rate", "mart_customer_retention", "repeat_purchase_rate", 0.05, 0.5),
    Bound("channel repeat_purchase_rate", "mart_channel_performance", "repeat_purchase_rate", 0, 0.25),
)


def bounds(models: dict[str, DataFrame], rules: tuple[Bound, ...] = RATE_BOUNDS,
           grains: dict[str, str] | None = None) -> DataFrame:
    """(failing_metric, grain, value) of every rate outside its bounds; NULL passes.

    The rules of a model are unpivoted in one read of it (``stack``).
    """
    grains = grains or GRAINS
    out = None
    for model in dict.fromkeys(r.model for r in rules):
        own = [r for r in rules if r.model == model]
        cells = [x for r in own for x in (F.lit(r.metric), F.col(r.column).cast("double"),
                                          F.lit(float(r.least)), F.lit(float(r.most)))]
        rows = models[model].select(
            F.col(grains[model]).cast("string").alias("grain"),
            F.stack(F.lit(len(own)), *cells).alias("failing_metric", "value", "least", "most"))
        part = rows.where(~F.col("value").between(F.col("least"), F.col("most"))).select(
            "failing_metric", "grain", "value")
        out = part if out is None else out.unionByName(part)
    return out


def rate_bounds(category: DataFrame, retention: DataFrame, channel: DataFrame,
                rules: tuple[Bound, ...] = RATE_BOUNDS) -> DataFrame:
    """Singular test: the rates of the three marts that lie outside their bounds."""
    return bounds(dict(zip(GRAINS, (category, retention, channel))), rules)


def suite_with_bounds(models: dict[str, DataFrame], checks: list[Check] = ALL_CHECKS) -> DataFrame:
    """Generic checks plus the singular bounds test as one result frame."""
    generic = run_checks(models, checks)
    bounds = rate_bounds(models["mart_category_performance"], models["mart_customer_retention"],
                         models["mart_channel_performance"])
    singular = bounds.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("assert_rates_within_bounds").alias("test_name"), F.lit("analytics").alias("model"),
        F.lit("").alias("column_name"), F.col("failures").cast("bigint").alias("failures"),
        (F.col("failures") == 0).alias("passed"))
    return generic.unionByName(singular)
