"""Points of sale matched to catalog entries by parts of their address.

Exact rule: the tax number agrees and house, street and district are all in the catalog address; this is
an equi join with a residual check. Loose rules: a district is in the catalog city; a city is in the
catalog city, address or district; a region is in the catalog address or city. Each loose rule looks at
one register attribute only, so a match is a property of (attribute kind, attribute text, catalog entry):
registers that share an attribute share its matches, and pairs need not be built to count entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.operators.joins import contains_pairs

# Which register attribute is looked for in which catalog column.
LOOSE_RULES = (
    ("district", "city_text"),
    ("city", "city_text"),
    ("city", "full_address"),
    ("city", "district_text"),
    ("region", "full_address"),
    ("region", "city_text"),
)


def exact_matches(registers: DataFrame, catalog: DataFrame, carry: list[str]) -> DataFrame:
    """``register``, ``entry`` and the ``carry`` columns of the catalog for the tax-number rule."""
    address = F.col("full_address")
    inside = address.contains(F.col("house")) & address.contains(F.col("street")) & address.contains(F.col("district"))
    left = registers.select("register", "inn", "house", "street", "district")
    right = catalog.select("entry", "inn", "full_address", *carry)
    return left.join(right, "inn").where(inside).select("register", "entry", *carry).distinct()


def attribute_matches(registers: DataFrame, catalog: DataFrame, carry: list[str]) -> DataFrame:
    """Distinct (``kind``, ``needle``, ``entry``, *carry) for the loose rules."""
    kinds = sorted({kind for kind, _ in LOOSE_RULES})
    columns = sorted({column for _, column in LOOSE_RULES})
    needles = registers.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("needle")) for k in kinds])).alias("n")
    ).select("n.*").where(F.col("needle") != "").distinct()
    texts = catalog.select(
        "entry",
        *carry,
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("haystack")) for c in columns])).alias("h"),
    ).select("entry", *carry, "h.*")
    allowed = F.array(*[F.lit(f"{kind}/{column}") for kind, column in LOOSE_RULES])
    pairs = contains_pairs(needles.select("needle"), texts.select("haystack"))
    return (
        texts.join(pairs, "haystack")
        .join(needles, "needle")
        .where(F.array_contains(allowed, F.concat_ws("/", "kind", "column")))
        .select("kind", "needle", "entry", *carry)
        .distinct()
    )


def register_attributes(registers: DataFrame) -> DataFrame:
    """(``register``, ``kind``, ``needle``) for every attribute the loose rules look at."""
    kinds = sorted({kind for kind, _ in LOOSE_RULES})
    return registers.select(
        "register",
        F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("needle")) for k in kinds])).alias("a"),
    ).select("register", "a.*").where(F.col("needle") != "").distinct()


def address_pairs(registers: DataFrame, catalog: DataFrame, require_inn: bool = False) -> DataFrame:
    """Distinct (``register``, ``entry``) pairs under all rules; with ``require_inn`` every rule needs the tax number.

    The loose pairs of a region are as many as its registers times its entries. A report that only counts
    entries should join on ``attribute_matches`` instead.
    """
    exact = exact_matches(registers, catalog, [])
    if require_inn:
        both = registers.join(catalog.withColumnRenamed("district", "_d"), "inn")
        hit = F.lit(False)
        for kind, column in LOOSE_RULES:
            hit = hit | (F.col(kind) != "") & F.col(column).contains(F.col(kind))
        return exact.unionByName(both.where(hit).select("register", "entry")).distinct()
    loose = register_attributes(registers).join(attribute_matches(registers, catalog, []), ["kind", "needle"])
    return exact.unionByName(loose.select("register", "entry")).distinct()
