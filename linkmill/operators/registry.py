"""The registry as three keyed tables: enterprises, names, addresses.

First row in wins on each table's key.  "First" is the least ``seq``, a number that
follows the input's order; it is the ``id`` of the row that stays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.functions import normalize as N

NAME_KEY = ["enterprise_number", "name_norm"]
ADDRESS_KEY = ["enterprise_number", "address_type", "street_norm", "house_number_norm", "box_norm", "postcode", "city_norm"]
PRIORITY = {"001": 1, "002": 2, "003": 3}


@dataclass(frozen=True)
class Registry:
    enterprise: DataFrame  # enterprise_number, status
    name: DataFrame
    address: DataFrame


def with_sequence(df: DataFrame, name: str = "seq") -> DataFrame:
    """A number that follows the order of the input's rows."""
    return df.withColumn(name, F.monotonically_increasing_id())


def first_wins(df: DataFrame, key: list[str], order: str = "seq") -> DataFrame:
    """One row for each key, the least by ``order``; partial aggregation, so a hot key meets one row a task."""
    rest = [c for c in df.columns if c not in key and c != order]
    least = df.groupBy(*key).agg(F.min(F.struct(order, *rest)).alias("least"))
    return least.select(*key, *[F.col(f"least.{c}").alias(c) for c in [order, *rest]])


def last_wins(df: DataFrame, key: list[str], order: str = "seq") -> DataFrame:
    rest = [c for c in df.columns if c not in key and c != order]
    last = df.groupBy(*key).agg(F.max(F.struct(order, *rest)).alias("last"))
    return last.select(*key, *[F.col(f"last.{c}").alias(c) for c in [order, *rest]])


def name_priority(denomination_type: Column) -> Column:
    out = F.lit(9)
    for code, value in PRIORITY.items():
        out = F.when(denomination_type == code, F.lit(value)).otherwise(out)
    return out


def name_rows(df: DataFrame, number: Column, name: Column, priority: Column, kind: Column, language: Column) -> DataFrame:
    """Normalised names with their blocking keys; names that normalise to nothing go."""
    rows = df.select("seq", number.alias("enterprise_number"), N.safe_text(name).alias("name"), N.company_name(name).alias("name_norm"), priority.alias("priority"), kind.alias("denomination_type"), language.alias("language"))
    rows = rows.where("name_norm != ''")
    compact, anchors = N.compact(F.col("name_norm")), N.name_anchors(F.col("name_norm"))
    rows = rows.withColumns({"name_compact": compact, "anchors": anchors})
    return first_wins(rows, NAME_KEY).select(
        F.col("seq").alias("id"), "enterprise_number", "name", "name_norm", "name_compact",
        F.substring("name_compact", 1, 8).alias("name_prefix"), F.substring("name_compact", 1, 4).alias("name_prefix4"), F.right("name_compact", F.lit(4)).alias("name_suffix4"),
        F.length("name_compact").alias("name_length"), F.coalesce(F.get("anchors", F.lit(0)), F.lit("")).alias("anchor1"), F.coalesce(F.get("anchors", F.lit(1)), F.lit("")).alias("anchor2"),
        "priority", "denomination_type", "language",
    )


def _normal_addresses(df: DataFrame) -> DataFrame:
    rows = df.withColumns({
        "street": N.safe_text(F.col("street")), "house_number": N.safe_text(F.col("house_number")), "box": N.safe_text(F.col("box")), "city": N.safe_text(F.col("city")),
        "street_norm": N.basic(F.col("street")), "house_number_norm": N.house_number(F.col("house_number")), "box_norm": N.box(F.col("box")), "postcode": N.postcode(F.col("postcode")), "city_norm": N.basic(F.col("city")),
    })
    return rows.where("street_norm != '' or house_number_norm != '' or postcode != '' or city_norm != ''")


def address_rows(df: DataFrame) -> DataFrame:
    """Normalised addresses; input has seq, enterprise_number, address_type, street, house_number, box, postcode, city, priority, language."""
    rows = _normal_addresses(df)
    rows = rows.withColumns({"street_core": N.street_core(F.col("street_norm")), "house_number_base": N.house_base(F.col("house_number_norm"))})
    rows = rows.withColumn("street_anchor", N.street_anchor(F.col("street_core")))
    return first_wins(rows, ADDRESS_KEY).select(
        F.col("seq").alias("id"), "enterprise_number", "address_type", "street", "street_norm", "street_core", "street_anchor", "house_number", "house_number_norm", "house_number_base",
        "box", "box_norm", "postcode", "city", "city_norm", "priority", "language",
    )


def address_places(df: DataFrame) -> DataFrame:
    """The columns of ``address_rows`` that tell place, house and box: they follow from the key, so no other text is shuffled or stored."""
    least = _normal_addresses(df).groupBy(*ADDRESS_KEY).agg(F.min("seq").alias("id"))
    return least.select("id", N.street_core(F.col("street_norm")).alias("street_core"), "city_norm", "house_number_norm", N.house_base(F.col("house_number_norm")).alias("house_number_base"), "box_norm")


def from_flat(df: DataFrame, columns: dict[str, str | None]) -> Registry:
    """Registry of a flattened table, one row a name and address; ``columns``: logical to physical names.

    Any ten-digit number counts here, whatever its first digit.
    """
    rows, col = _flat_rows(df, columns)
    number = F.col("enterprise_number_norm")
    enterprise = first_wins(rows.select("seq", number.alias("enterprise_number"), N.safe_text(col("status")).alias("status")), ["enterprise_number"]).select("enterprise_number", "status")
    name = name_rows(rows, number, col("company_name"), F.lit(1), F.lit("REFERENCE"), F.lit(""))
    return Registry(enterprise, name, address_rows(flat_addresses(df, columns)))


def _flat_rows(df: DataFrame, columns: dict[str, str | None]) -> tuple[DataFrame, Callable[[str], Column]]:
    """Rows of a flattened table that have a number, and the columns of logical names."""
    col = lambda k: F.col(f"`{columns[k]}`") if columns.get(k) else F.lit("")
    rows = df if "seq" in df.columns else with_sequence(df)
    return rows.withColumn("enterprise_number_norm", N.enterprise_number(col("enterprise_number"))).where("enterprise_number_norm != ''"), col


def flat_addresses(df: DataFrame, columns: dict[str, str | None]) -> DataFrame:
    """The addresses of a flattened table, before they are normalised."""
    rows, col = _flat_rows(df, columns)
    return rows.select("seq", F.col("enterprise_number_norm").alias("enterprise_number"), F.lit("REFERENCE").alias("address_type"), *[col(k).alias(k) for k in ("street", "house_number", "box", "postcode", "city")], F.lit(1).alias("priority"), F.lit("").alias("language"))


def from_raw(enterprise: DataFrame, denomination: DataFrame, address: DataFrame, establishment: DataFrame | None = None, *, include_establishments: bool = False, include_historical: bool = False) -> Registry:
    """Registry of the raw extract's tables."""
    seq = lambda df: df if "seq" in df.columns else with_sequence(df)
    firms = seq(enterprise).select("seq", N.enterprise_number(F.col("EnterpriseNumber")).alias("enterprise_number"), N.safe_text(F.col("Status")).alias("status"))
    firms = first_wins(firms.where(N.registry_shaped(F.col("enterprise_number"))), ["enterprise_number"]).select("enterprise_number", "status")
    named = seq(denomination).withColumn("number", N.enterprise_number(F.col("EntityNumber"))).where(N.registry_shaped(F.col("number")))
    kind = N.safe_text(F.col("TypeOfDenomination"))
    names = name_rows(named, F.col("number"), F.col("Denomination"), name_priority(kind), kind, N.safe_text(F.col("Language")))

    rows = seq(address).withColumns({"number": N.enterprise_number(F.col("EntityNumber")), "address_type": N.safe_text(F.col("TypeOfAddress")), "struck": N.safe_text(F.col("DateStrikingOff")) != ""})
    if not include_historical:
        rows = rows.where(~F.col("struck"))
    found = rows.where((F.col("address_type") == "REGO") & N.registry_shaped(F.col("number"))).withColumns({"enterprise_number": F.col("number"), "priority": F.lit(1)})
    if include_establishments and establishment is not None:
        units = establishment_owners(establishment)
        other = rows.where("address_type = 'BAET'").join(units, F.col("number") == F.col("establishment_number")).withColumn("priority", F.lit(2)).drop("establishment_number")
        found = found.unionByName(other.select(*found.columns))
    return Registry(firms, names, address_rows(language_variants(found)))


def establishment_owners(establishment: DataFrame) -> DataFrame:
    """(establishment_number, enterprise_number): later rows replace earlier ones."""
    rows = establishment if "seq" in establishment.columns else with_sequence(establishment)
    rows = rows.select("seq", N.enterprise_number(F.col("EstablishmentNumber")).alias("establishment_number"), N.enterprise_number(F.col("EnterpriseNumber")).alias("enterprise_number"))
    return last_wins(rows, ["establishment_number"]).select("establishment_number", "enterprise_number").where("enterprise_number != ''")


def language_variants(rows: DataFrame) -> DataFrame:
    """Up to two variants of each address, French first; the Dutch one only if it differs."""
    variant = lambda lang, k: F.struct(F.lit(k).alias("k"), F.lit(lang).alias("language"), F.col(f"Street{lang}").alias("street"), F.col(f"Municipality{lang}").alias("city"))
    same = (N.basic(F.col("StreetFR")) == N.basic(F.col("StreetNL"))) & (N.basic(F.col("MunicipalityFR")) == N.basic(F.col("MunicipalityNL")))
    variants = F.when(same, F.array(variant("FR", 0))).otherwise(F.array(variant("FR", 0), variant("NL", 1)))
    return rows.withColumn("v", F.explode(variants)).select(
        (F.col("seq") * 2 + F.col("v.k")).alias("seq"), "enterprise_number", "address_type", F.col("v.street").alias("street"), F.col("HouseNumber").alias("house_number"), F.col("Box").alias("box"),
        F.col("Zipcode").alias("postcode"), F.col("v.city").alias("city"), (F.col("priority") + F.when(F.col("struck"), 2).otherwise(0)).alias("priority"), F.col("v.language").alias("language"),
    )


def name_frequencies(names: DataFrame) -> DataFrame:
    """How many enterprises bear each normalised name, exactly."""
    return names.groupBy("name_norm").agg(F.countDistinct("enterprise_number").alias("frequency"))
