"""Frequency encodings.

Rows are reduced to one count per key before anything is joined, and the grand total is a
scalar subquery over those counts (Spark reuses their exchange).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions.coerce import as_text
from shelfcast.functions.scalars import ratio

ITEM_COLUMNS = ["item_nbr", "family", "class", "perishable"]
STORE_COLUMNS = ["store_nbr", "city", "state", "type", "cluster"]


def share(counts, name):
    """``n`` divided by the sum of all ``n`` (0 when that sum is 0)."""
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn(name, ratio(F.col("n"), total)).drop("n")


def _counts(df, key):
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def value_frequency(df, key, name="freq"):
    """Share of rows per value; rows with a null value are not counted at all."""
    return share(_counts(df, key), name)


def _sum_within(*keys):
    """Sum of ``n`` over the rows sharing ``keys``. Used only on tables already reduced to one
    row per distinct combination of a few categories, so no group grows with the data."""
    return F.sum("n").over(Window.partitionBy(*keys))


def class_shares(pairs):
    """Shares per distinct (family, class) with its number of items ``n``."""
    total = pairs.agg(F.sum("n")).scalar()
    return pairs.select(
        "family",
        "class",
        ratio(_sum_within("family"), total).alias("family_freq_items"),
        ratio(_sum_within("class"), total).alias("class_freq_items"),
        ratio(F.col("n"), _sum_within("family")).alias("class_freq_in_family"),
    )


def item_features(items):
    """Per item: perishable flag, shares of its family and class among the items, and the
    share of the class within the family. Class is compared as text; unknown is "-1"."""
    clean = items.select(
        "item_nbr",
        F.coalesce(F.col("perishable"), F.lit(0)).cast("int").alias("perishable"),
        as_text(F.col("family"), "UNKNOWN").alias("family"),
        F.coalesce(F.col("class"), F.lit(-1)).cast("string").alias("class"),
    )
    pairs = clean.groupBy("family", "class").agg(F.count(F.lit(1)).alias("n"))
    return clean.join(class_shares(pairs), ["family", "class"]).drop("family", "class")


def place_shares(places):
    """Shares per distinct (type, state, city) with its number of history rows ``n``."""
    total = places.agg(F.sum("n")).scalar()
    return places.select(
        "type",
        "state",
        "city",
        ratio(_sum_within("type"), total).alias("type_freq"),
        ratio(_sum_within("state"), total).alias("state_freq"),
        ratio(_sum_within("city"), total).alias("city_freq"),
        ratio(_sum_within("state", "city"), _sum_within("state")).alias("city_freq_in_state"),
    )


def weigh_stores(stores, per_store):
    """Stores with their number of history rows ``n`` (0 without any)."""
    places = stores.select(
        "store_nbr",
        *[as_text(F.col(c), "UNKNOWN").alias(c) for c in ("type", "state", "city")],
        F.coalesce(F.col("cluster"), F.lit(-1)).cast("int").alias("cluster"),
    )
    return places.join(per_store, "store_nbr", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def store_weights(history, stores):
    """The history is counted per store first, so the join is between store-sized tables."""
    return weigh_stores(stores, _counts(history, "store_nbr"))


def store_shares(weights):
    """Per store: cluster, and how often its type, state and city occur in the history."""
    places = weights.groupBy("type", "state", "city").agg(F.sum("n").alias("n"))
    return (
        weights.join(place_shares(places), ["type", "state", "city"])
        .drop("type", "state", "city", "n")
    )


def store_features(history, stores):
    return store_shares(store_weights(history, stores))
