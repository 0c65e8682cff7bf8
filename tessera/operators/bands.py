"""Which bands a request asks for.

A request names bands by their names or aliases, as the product's definition
gives them; an empty or missing list asks for all of them, in the definition's
order.  A name that the product does not know is a row with an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASUREMENTS = "struct<measurements array<struct<name string, aliases array<string>>>>"


def measurements(products: DataFrame, key: str = "id") -> DataFrame:
    """(product, pos, band, names) of every measurement of every definition:
    ``names`` are the band's own name and its aliases."""
    doc = F.from_json("definition", MEASUREMENTS)["measurements"]
    m = products.select(F.col(key).alias("product"), F.posexplode(doc).alias("pos", "m"))
    return m.select("product", "pos", F.col("m.name").alias("band"),
                    F.array_distinct(F.concat(F.array("m.name"), F.coalesce("m.aliases", F.array().cast("array<string>")))).alias("names"))


def select_bands(requests: DataFrame, products: DataFrame, key: str, product: str = "product", asked: str = "bands") -> DataFrame:
    """(key, pos, asked, band, error): one row per requested band in the order
    asked for (definition order if all are)."""
    m = measurements(products)
    r = requests.select(key, F.col(product).alias("product"), F.coalesce(F.col(asked), F.array().cast("array<string>")).alias("_a"))
    every = r.where(F.size("_a") == 0).join(m, "product").select(
        key, "pos", F.col("band").alias("asked"), "band", F.lit(None).cast("string").alias("error"))
    named = r.where(F.size("_a") > 0).select(key, "product", F.posexplode("_a").alias("pos", "asked"))
    known = m.select("product", "band", F.explode("names").alias("asked"))
    some = named.join(known, ["product", "asked"], "left").select(
        key, "pos", "asked", "band", F.when(F.col("band").isNull(), F.concat(F.lit("unknown band: "), "asked")).alias("error"))
    return every.unionByName(some)
