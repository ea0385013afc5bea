"""One name and one address for each enterprise of the raw extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.operators.registry import first_wins, name_priority, with_sequence

# Texts that this export takes for missing (fixed values).
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def known(c: Column) -> Column:
    return F.when(~c.isin(MISSING), c)


def flatten(enterprise: DataFrame, denomination: DataFrame, address: DataFrame) -> DataFrame:
    """numero_entreprise, nom_entreprise, street_name, house_number, box_number, postcode, city_name, by number.

    The name of the best kind wins, the first in file order among equals; the first
    address in file order wins, whatever its type.
    """
    seq = lambda df: df if "seq" in df.columns else with_sequence(df)
    number = lambda c: F.trim(known(F.col(c))).alias("numero_entreprise")
    firms = enterprise.select(number("EnterpriseNumber")).distinct()
    named = seq(denomination).select("seq", number("EntityNumber"), known(F.col("Denomination")).alias("nom_entreprise"), name_priority(known(F.col("TypeOfDenomination"))).alias("k"))
    best = first_wins(named.withColumn("order", F.struct("k", "seq")), ["numero_entreprise"], "order").select("numero_entreprise", "nom_entreprise")
    placed = seq(address).select(
        "seq", number("EntityNumber"), F.coalesce(known(F.col("StreetFR")), known(F.col("StreetNL"))).alias("street_name"), known(F.col("HouseNumber")).alias("house_number"), known(F.col("Box")).alias("box_number"),
        known(F.col("Zipcode")).alias("postcode"), F.coalesce(known(F.col("MunicipalityFR")), known(F.col("MunicipalityNL"))).alias("city_name"),
    )
    first = first_wins(placed, ["numero_entreprise"]).drop("seq")
    return firms.join(best, "numero_entreprise", "left").join(first, "numero_entreprise", "left").orderBy("numero_entreprise")
