"""Daily sales of chosen product categories by region, city, client and point of sale."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.functions.values import MONEY
from billscope.operators.windows import keep_latest
from billscope.session import cut
from billscope.sources.readers import on_days


@dataclass(frozen=True)
class CategoryRule:
    """A product name that matches every ``needs`` pattern and no ``lacks`` pattern gets the label."""

    label: str
    needs: tuple[str, ...]
    lacks: tuple[str, ...] = ()


# Product categories of the daily report.
LENS_RULES = (
    CategoryRule("ACUVUE® RevitaLens", ("acuvu|а[кk]ув.?[юу]", "revit|ревит")),
    CategoryRule("ACUVUE®", ("acuvu|а[кk]ув.?[юу]",), ("revit|ревит",)),
)


def category(name: Column, rules: Sequence[CategoryRule]) -> Column:
    """Label of the first rule the lower-cased name fits; NULL when none does."""
    chain = None
    for rule in rules:
        fits = F.lit(True)
        for pattern in rule.needs:
            fits = fits & name.rlike(pattern)
        for pattern in rule.lacks:
            fits = fits & ~name.rlike(pattern)
        chain = F.when(fits, rule.label) if chain is None else chain.when(fits, rule.label)
    return chain


def receipt_lines(receipts: DataFrame, rules: Sequence[CategoryRule]) -> DataFrame:
    """Lines of sold, categorised products, each receipt counted once.

    Lines are exploded and classified first, and the few that matter are written once: receipts are read in one pass. A receipt's copies are told apart by the
    hash of their content, and the copy with the smallest hash counts; equal copies collapse. A receipt id with a NULL part
    is NULL, and all such receipts count as one.
    """
    content = F.col("content")
    line = (
        receipts.where((content.calculation_type == "Sell") & (F.col("type") == "Receipt"))
        .select(
            F.concat(
                content.cashbox_number.cast("string"), F.lit("_"), content.number.cast("string"), F.lit("_"), content.timestamp.cast("string")
            ).alias("receipt_id"),
            F.xxhash64("content").alias("copy"),
            content.cashbox_number.alias("cashbox_number"),
            F.to_date(content.timestamp).alias("date"),
            content.client.alias("client"),
            content.client_inn.alias("client_inn"),
            F.posexplode("content.products").alias("position", "product"),
        )
        .withColumn("product_name", F.lower("product.name"))
        .withColumn("category", category(F.col("product_name"), rules))
        .where(F.col("category").isNotNull())
        .withColumns({"quantity": F.col("product.quantity").cast(MONEY), "sum_rub": F.round(F.col("product.sum").cast(MONEY) / 100, 2).cast(MONEY)})
        .drop("product")
    )
    line = cut(line, "receipt_lines")
    kept = line.groupBy("receipt_id").agg(F.min("copy").alias("_copy")).withColumnRenamed("receipt_id", "_id")
    mine = line["receipt_id"].eqNullSafe(kept["_id"]) & (line["copy"] == kept["_copy"])
    return (
        line.join(kept, mine, "left_semi")
        .select(
            "receipt_id",
            "copy",
            "position",
            "cashbox_number",
            "date",
            "client",
            "client_inn",
            "product_name",
            "quantity",
            "sum_rub",
            "category",
        )
        .distinct()
        .drop("receipt_id", "copy", "position")
    )


def daily_sales(
    receipts: DataFrame,
    registers: DataFrame,
    as_of: dt.date,
    days: int = 1,
    rules: Sequence[CategoryRule] = LENS_RULES,
) -> DataFrame:
    """Quantity and money by date, client, region, city, point of sale, category and product.

    ``receipts`` has a day column ``date``; the report covers the ``days`` days before ``as_of`` (yesterday
    by default, more for a backfill). ``registers`` has ``cashbox_number``, ``from_time`` and ``address``.
    Lines are added up per register before the address lookup, which then meets far fewer rows.
    """
    lines = receipt_lines(on_days(receipts, "date", as_of - dt.timedelta(days=days), days), rules)
    per_register = lines.groupBy("cashbox_number", "date", "client", "client_inn", "category", "product_name").agg(
        F.sum("quantity").alias("quantity"), F.sum("sum_rub").alias("sum_rub")
    )
    addresses = keep_latest(registers, ["cashbox_number"], "from_time").select(
        "cashbox_number",
        F.left(F.col("address.region.code"), F.lit(2)).alias("region_code"),
        F.col("address.region.name").alias("region_name"),
        F.col("address.city.name").alias("city_name"),
        F.coalesce(F.col("address.street.guid"), F.lit("")).alias("_street"),
        F.coalesce(F.col("address.house"), F.lit("")).alias("_house"),
    )
    located = per_register.join(addresses, "cashbox_number", "left").withColumn(
        "sales_point_id",
        F.concat_ws(
            "_",
            F.coalesce("_street", F.lit("")),
            F.coalesce("_house", F.lit("")),
            F.coalesce(F.col("client_inn").cast("string"), F.lit("")),
        ),
    )
    return located.groupBy(
        "date", "client", "region_code", "region_name", "city_name", "sales_point_id", "category", "product_name"
    ).agg(
        F.round(F.sum("quantity"), 2).cast("double").alias("quantity"),
        F.round(F.sum("sum_rub"), 2).cast("double").alias("sum_rub"),
    )
