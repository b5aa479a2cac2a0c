"""Product and date dimensions and the sales fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import date_key, is_text, moved, natural_key, unpacked, with_grouped_key
from tidemark.functions.times import calendar
from tidemark.operators.quality import REASON
from tidemark.operators.skew import join_lookup, settle
from tidemark.operators.temporal import join_as_of


def product_rows(feed: DataFrame, product_id: str = "product_id") -> DataFrame:
    """Feed rows with their surrogate key, one per product id (a repeat would multiply facts).

    Repeats are settled by the greatest remaining column values; rows without an id are no products.
    """
    rest = [name for name in feed.columns if name != product_id]
    kept = feed.filter(F.col(product_id).isNotNull()).groupBy(product_id).agg(F.max(F.struct(*rest)).alias("_row"))
    return kept.select(natural_key(product_id).alias("product_sk"), product_id, "_row.*")


def unseen(feed: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of a feed with one row per key whose key is not stored yet."""
    return join_lookup(feed, stored.select(key), key, "left_anti")


def order_dates(orders: DataFrame, time: str = "order_date") -> DataFrame:
    """Distinct calendar dates; no gaps are filled, and a missing date is none."""
    return orders.select(F.col(time).cast("date").alias("full_date")).filter("full_date IS NOT NULL").distinct()


def keyless(feed: DataFrame, key: str, reason: str) -> DataFrame:
    """Rows that cannot enter a dimension for want of a key, as dead letters."""
    return feed.filter(F.col(key).isNull()).withColumn(REASON, F.lit(reason))


def date_rows(dates: DataFrame) -> DataFrame:
    parts = calendar(F.col("full_date"))
    return dates.select(
        date_key("full_date").alias("date_sk"),
        "full_date",
        *[part.alias(name) for name, part in parts.items()],
    )


def with_product(facts: DataFrame, products: DataFrame) -> DataFrame:
    return join_lookup(facts, products.select("product_id", "product_sk"), "product_id", "left")


def with_date(facts: DataFrame, dates: DataFrame, time: str = "order_date") -> DataFrame:
    dated = facts.withColumn("full_date", F.to_date(F.col(time)))
    return join_lookup(dated, dates.select("full_date", "date_sk"), "full_date")


def sales_facts(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    grain: tuple[str, ...] = ("order_id",),
    how: str = "auto",
) -> DataFrame:
    """Orders with the surrogate keys of customer version, product and date.

    All joins are outer: an order without a match keeps a NULL key, and as many rows leave as
    came in while the dimensions are unique and validity windows do not overlap. The ordered pass
    over versions comes first, so that orders are counted by customer before any other join.
    Keys that are text move as bytes.
    """
    return _unpacked(_joined(orders, customers, products, dates, grain, how), customers, products)


def numbered_facts(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    grain: tuple[str, ...],
    how: str,
    write: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """`sales_facts` with their number; `write` stores the joined rows. Keys that are text stay bytes up to the end."""
    joined = write(_joined(orders, customers, products, dates, grain, how))
    return _unpacked(_with_fact_key(joined, "sales_sk"), customers, products)


def _joined(
    orders: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame, grain: tuple[str, ...], how: str
) -> DataFrame:
    used = [*grain, "customer_id", "product_id", "order_date", "quantity", "total_amount"]
    versions, sold = moved(customers, "customer_sk"), orders.select(*used)
    sold = join_as_of(sold, versions, "customer_id", "order_date", ["customer_sk"], how)
    dated = with_date(sold, dates).select(*grain, "customer_sk", "product_id", "date_sk", "quantity", "total_amount")
    joined = with_product(dated, moved(products, "product_sk"))
    return joined.select(*grain, "customer_sk", "product_sk", "date_sk", "quantity", "total_amount")


def _unpacked(facts: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    texts = [name for dim, name in ((customers, "customer_sk"), (products, "product_sk")) if is_text(dim, name)]
    return facts.withColumns({name: unpacked(name) for name in texts})


def unmatched_facts(facts: DataFrame) -> DataFrame:
    """How many facts have no customer version, product or date."""
    missing = {
        f"without_{name}": F.count_if(F.col(f"{name}_sk").isNull()) for name in ("customer", "product", "date")
    }
    return facts.agg(F.count(F.lit(1)).alias("facts"), *[n.alias(name) for name, n in missing.items()])


def with_fact_key(facts: DataFrame, name: str = "sales_sk") -> DataFrame:
    """Number the facts: a grain that occurs twice, or not at all, still gets a key of its own for each row.

    Numbers ascend with the date, so that the numbered rows lie together by month.
    """
    return _with_fact_key(settle(facts, "zstd"), name)


def _with_fact_key(written: DataFrame, name: str) -> DataFrame:
    return with_grouped_key(written, ["date_sk", *[column for column in written.columns if column != "date_sk"]], name)
