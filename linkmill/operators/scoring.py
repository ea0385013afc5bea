"""Scores of candidate pairs, with reasons and contradictions, and their classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkmill.config import MatchConfig
from linkmill.functions import normalize as N
from linkmill.functions.similarity import similarity
from linkmill.operators.registry import Registry, name_frequencies

# Weights of the parts of an address and of a candidate's score.
ADDRESS_WEIGHTS = {"street": 0.36, "house": 0.24, "postcode": 0.24, "city": 0.12, "box": 0.04}
SCORE_WEIGHTS = {"name": 0.42, "street": 0.21, "house": 0.14, "postcode": 0.14, "city": 0.07, "box": 0.02}
HARD = ("nom très différent", "code postal différent", "numéro de rue différent")
CERTAIN, PROBABLE, NONE, SKIPPED, ERROR = "MATCH_CERTAIN", "MATCH_PROBABLE", "NO_RELIABLE_MATCH", "SKIPPED_EXISTING_NUMBER", "MATCH_ERROR"


def compare(left: Column, right: Column, house: bool = False, bases: tuple[Column, Column] | None = None) -> tuple[Column, Column]:
    """(component or null, code) of two categorical values; ``bases`` of house numbers where they are at hand."""
    a, b = bases or (N.house_base(left), N.house_base(right))
    same_base = (a != "") & (a == b) if house else F.lit(False)
    code = (
        F.when((left == "") & (right == ""), "both_missing").when(left == "", "input_missing").when(right == "", "reference_missing")
        .when(left == right, "exact").when(same_base, "same_numeric_base").otherwise("mismatch")
    )
    component = F.when(code == "exact", 100.0).when(code == "same_numeric_base", 82.0).when(code == "mismatch", 0.0)
    return component, code


#: Numbers of one list share all bits above these, so that a list of dense numbers has 8 MB at most.
LIST_BITS = 20
#: Tasks that compare and spread lists, times the shuffle partitions: the lists are small, the pairs many.
FANOUT = 8
#: Such tasks at least, times the full shares of the addresses: most shares have a task and so a file of their own, whose numbers take fewer bits.
SPREAD = 2
#: Addresses of a tile, a multiple of eight: Parquet packs values by eights, so a tile's repeated numbers are the same bytes each time.
TILE = 256
#: Tiles of a share of a place, each of which meets all contacts of the place: a large place is no single task's, and a file names few addresses, in few bits each.
SHARE = 8


def equalities(contacts: DataFrame, addresses: DataFrame, count: int = 0) -> DataFrame:
    """(source_row_number, id, house_match, box_match) of all contacts and addresses of equal street and city.

    A contact is compared once with the addresses that are equal in house and box, too; its pairs
    with them are listed after that.  The pairs are many times the input, so their order is made for
    the file they end in: a place's addresses, like ones together, are dealt into tiles, and a tile
    meets one contact after the other.  A contact's number and the codes then come in long runs, and
    the tile's numbers repeat.  An address is shuffled once; contacts, as lists of equal ones, go to
    as many shares as the addresses of their place fill.  ``count``: of addresses, if it is known.
    """
    place = ["street_core", "city_norm"]
    tasks = max(FANOUT * int(contacts.sparkSession.conf.get("spark.sql.shuffle.partitions")), SPREAD * count // (TILE * SHARE))
    like = ["house_norm", "house_base", "box_norm"]
    own = addresses.select("id", *place, F.col("box_norm").alias("b"), F.col("house_number_base").alias("h_base"), F.col("house_number_norm").alias("h"))
    alike = W.partitionBy(*place).orderBy("b", "h_base", "h", "id")
    tile = F.floor((F.row_number().over(alike) - 1) / TILE).alias("tile")
    kinds = own.select("*", tile).groupBy(*place, "tile", "b", "h_base", "h").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    tiles = kinds.groupBy(*place, "tile").agg(F.array_sort(F.collect_list(F.struct("b", "h_base", "h", "ids"))).alias("kinds"))
    left = tiles.withColumn("share", F.floor(F.col("tile") / SHARE)).drop("tile").repartition(tasks, *place, "share")
    last = own.groupBy(*place).agg(F.floor((F.count("*") - 1) / (TILE * SHARE)).alias("last"))
    lists = contacts.select("source_row_number", *place, *like, F.shiftright("source_row_number", LIST_BITS).alias("part")).repartition(*place)
    lists = lists.groupBy(*place, *like, "part").agg(F.collect_list("source_row_number").alias("rows")).drop("part")
    right = lists.join(last, place).withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).drop("last").repartition(tasks, *place, "share")
    house = compare(F.col("house_norm"), F.col("k.h"), True, (F.col("house_base"), F.col("k.h_base")))[1]
    # Sorting keeps this step out of compiled code, which would hold all pairs of a list and a tile before the first is written.
    met = left.join(right.hint("merge"), [*place, "share"]).withColumn("source_row_number", F.explode(F.array_sort("rows"))).withColumn("k", F.explode("kinds"))
    both = met.select("source_row_number", F.col("k.ids").alias("ids"), house.alias("house_match"), compare(F.col("box_norm"), F.col("k.b"))[1].alias("box_match"))
    return both.select("source_row_number", F.explode("ids").alias("id"), "house_match", "box_match")


def weighted_mean(weights: dict[str, float], values: dict[str, Column]) -> tuple[Column, Column]:
    """(mean over the values that aren't null, their weight); 0 without any."""
    total = sum((F.when(values[k].isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for k, w in weights.items()), F.lit(0.0))
    parts = sum((F.coalesce(F.lit(w) * values[k], F.lit(0.0)) for k, w in weights.items()), F.lit(0.0))
    return F.coalesce(F.try_divide(parts, total), F.lit(0.0)), total


def best_names(pairs: DataFrame, names: DataFrame, similarity=similarity) -> DataFrame:
    """The closest name variant of each pair; without any likeness the canonical one (least priority, then name)."""
    own = names.select("enterprise_number", F.col("id").alias("name_id"), F.col("name").alias("matched_name"), F.col("name_norm").alias("matched_name_norm"), F.col("priority").alias("name_priority"))
    joined = pairs.select("source_row_number", "enterprise_number", "name_norm").join(own, "enterprise_number")
    scored = joined.withColumn("s", similarity("name_norm", "matched_name_norm"))
    order = F.struct((-F.col("s.combined")).alias("a"), F.col("name_priority").alias("b"), F.when(F.col("s.combined") > 0, F.col("name_id")).alias("c"), F.col("matched_name").alias("d"), "matched_name_norm", "s")
    best = scored.groupBy("source_row_number", "enterprise_number").agg(F.min(order).alias("m"), F.max("s.error").alias("name_error"))
    return best.select("source_row_number", "enterprise_number", "name_error", F.col("m.d").alias("matched_name"), "m.matched_name_norm", F.col("m.s.combined").alias("name_raw"), F.col("m.s.weighted").alias("name_wratio"), F.col("m.s.token_set").alias("name_token_set"), F.col("m.s.token_sort").alias("name_token_sort"))


def address_features(joined: DataFrame, similarity=similarity) -> DataFrame:
    """Street, city and categorical features of contact and registry address columns (``r_`` ones), and their aggregate."""
    out = joined.withColumns({"s1": similarity("street_norm", "r_street_norm"), "s2": similarity("street_core", "r_street_core"), "s3": similarity("city_norm", "r_city_norm")})
    out = out.withColumns({"street_sim": F.greatest("s1.combined", "s2.combined"), "city_sim": F.col("s3.combined"), "address_error": F.coalesce("s1.error", "s2.error", "s3.error")}).drop("s1", "s2", "s3")
    features = {}
    for part, left, right in (("house", "house_norm", "r_house_norm"), ("box", "box_norm", "r_box_norm"), ("postcode", "postcode_norm", "r_postcode")):
        features[f"{part}_component"], features[f"{part}_match"] = compare(F.col(left), F.col(right), part == "house")
    out = out.withColumns(features)
    return out.withColumn("address_score", weighted_mean(ADDRESS_WEIGHTS, parts(out, None))[0])


def parts(df: DataFrame, name: Column | None) -> dict[str, Column]:
    both = lambda a, b: (F.col(a) != "") & (F.col(b) != "")
    out = {
        "street": F.when(both("street_norm", "r_street_norm"), F.col("street_sim")), "city": F.when(both("city_norm", "r_city_norm"), F.col("city_sim")),
        "house": F.col("house_component"), "box": F.col("box_component"), "postcode": F.col("postcode_component"),
    }
    return out if name is None else out | {"name": name}


CONTACT = ["street_norm", "street_core", "house_norm", "box_norm", "postcode_norm", "city_norm"]
ADDRESS = {"street": "r_street", "street_norm": "r_street_norm", "street_core": "r_street_core", "house_number": "r_house_number", "house_number_norm": "r_house_norm", "box": "r_box", "box_norm": "r_box_norm", "postcode": "r_postcode", "city": "r_city", "city_norm": "r_city_norm"}


def best_addresses(pairs: DataFrame, addresses: DataFrame, similarity=similarity) -> DataFrame:
    """The best address of each pair: largest aggregate, then least (priority, id); empty without any address."""
    own = addresses.select("enterprise_number", F.col("id").alias("address_id"), F.col("priority").alias("address_priority"), *[F.col(a).alias(b) for a, b in ADDRESS.items()])
    joined = pairs.select("source_row_number", "enterprise_number", *CONTACT).join(own, "enterprise_number", "left").fillna("", list(ADDRESS.values()))
    scored = address_features(joined, similarity)
    keep = [c for c in scored.columns if c not in ("source_row_number", "enterprise_number", "address_score", "address_priority", "address_id", "address_error", *CONTACT)]
    best = scored.groupBy("source_row_number", "enterprise_number").agg(F.min(F.struct((-F.col("address_score")).alias("a"), F.col("address_priority").alias("b"), F.col("address_id").alias("c"), *keep)).alias("m"), F.max("address_error").alias("address_error"))
    return best.select("source_row_number", "enterprise_number", "address_error", *[F.col(f"m.{c}").alias(c) for c in keep])


# The reasons' and contradictions' texts below are fixed values, as results show them.
def _texts(entries: list[tuple[Column, Column | str]]) -> Column:
    """The texts whose conditions hold, in order."""
    items = F.array(*[F.when(cond, F.lit(text) if isinstance(text, str) else text) for cond, text in entries])
    return F.filter(items, lambda x: x.isNotNull())


def score_pairs(pairs: DataFrame, registry: Registry, similarity=similarity) -> DataFrame:
    """All features, the score, reasons and contradictions of (contact, enterprise) pairs; ``error`` where one couldn't be scored.

    ``pairs`` has the contact's normalised columns, enterprise_number and rules.
    """
    known = pairs.join(registry.enterprise, "enterprise_number", "left")
    # A number that the enterprise table lacks has no names or addresses here, even if those tables know it.
    listed = registry.enterprise.select("enterprise_number")
    keys = ["source_row_number", "enterprise_number"]
    df = known.join(best_names(pairs, registry.name.join(listed, "enterprise_number", "left_semi"), similarity), keys, "left")
    df = df.join(best_addresses(pairs, registry.address.join(listed, "enterprise_number", "left_semi"), similarity).drop(*CONTACT), keys)
    df = df.join(name_frequencies(registry.name), "name_norm", "left").fillna("", ["matched_name", "matched_name_norm", "status"]).fillna(0, ["name_raw", "name_wratio", "name_token_set", "name_token_sort", "frequency"])
    return apply_score(df).withColumn("error", F.coalesce("name_error", "address_error"))


def apply_score(df: DataFrame) -> DataFrame:
    name, street, city = F.col("name_raw"), F.col("street_sim"), F.col("city_sim")
    has_name = (F.col("name_norm") != "") & (F.col("matched_name_norm") != "")
    same_name = (F.col("name_norm") != "") & (F.col("name_norm") == F.col("matched_name_norm"))
    has_street = (F.col("street_norm") != "") & (F.col("r_street_norm") != "")
    has_city = (F.col("city_norm") != "") & (F.col("r_city_norm") != "")
    house, postcode, box, freq = F.col("house_match"), F.col("postcode_match"), F.col("box_match"), F.col("frequency")
    house_ok = house.isin("exact", "same_numeric_base")
    base, weight = weighted_mean(SCORE_WEIGHTS, parts(df, F.when(has_name, name)))
    coverage = F.least(F.lit(1.0), weight)
    near = ~same_name & (name >= 95)
    close = ~same_name & (name >= 88) & (name < 95)
    far = ~same_name & has_name & (name < 50)
    shared = F.concat(F.lit("nom exact partagé par "), freq.cast("string"), F.lit(" entreprises"))
    frequent = F.concat(F.lit("nom exact très fréquent ("), freq.cast("string"), F.lit(" entreprises)"))
    agree = (name >= 90) & (postcode == "exact") & (house == "exact") & (street >= 82)
    inactive = F.concat(F.lit("statut BCE non actif: "), F.col("status"))
    # (condition, change of the score), in the order in which they apply.
    steps = [
        (same_name & (freq == 1), 7), (same_name & freq.between(2, 5), 3), (same_name & (freq > 20), -5), (near, 3), (far, -20),
        (postcode == "exact", 3), (postcode == "mismatch", -18), (house == "exact", 3), (house == "mismatch", -24),
        ((street >= 96), 2), (~(street >= 96) & has_street & (street < 45), -13), (~(city >= 95) & has_city & (city < 45), -7), (box == "mismatch", -5),
        ((postcode == "exact") & house_ok, 3), (agree, 5), (F.col("status") == "AC", 1), (~F.col("status").isin("AC", ""), -1),
    ]
    score = base * (F.lit(0.58) + F.lit(0.42) * coverage)
    for cond, change in steps:
        score = score + F.when(cond, F.lit(float(change))).otherwise(F.lit(0.0))
    reasons = _texts([
        (same_name, "nom normalisé exact"), (same_name & (freq == 1), "nom exact unique dans la référence"), (same_name & freq.between(2, 5), shared), (same_name & (freq > 20), frequent),
        (near, "nom quasi identique"), (close, "nom fortement similaire"), (postcode == "exact", "code postal exact"), (house == "exact", "numéro de rue exact"),
        (house == "same_numeric_base", "même base numérique de numéro de rue"), (street >= 96, "rue quasi exacte"), (city >= 95, "ville quasi exacte"), (box == "exact", "boîte exacte"),
        (agree, "nom et adresse se confirment mutuellement"), (F.col("status") == "AC", "entreprise active dans la BCE"), (~F.col("status").isin("AC", ""), inactive),
    ])
    contradictions = _texts([
        (far, HARD[0]), (postcode == "mismatch", HARD[1]), (house == "mismatch", HARD[2]), (~(street >= 96) & has_street & (street < 45), "rue très différente"),
        (~(city >= 95) & has_city & (city < 45), "ville très différente"), (box == "mismatch", "boîte différente"),
    ])
    strong = (
        ((name >= 90) & (postcode == "exact") & house_ok & (street >= 75))
        | ((F.col("name_norm") == F.col("matched_name_norm")) & (freq == 1) & (street >= 88) & ((postcode == "exact") | (city >= 95)))
        | ((name >= 87) & (street >= 94) & (house == "exact") & (postcode == "exact"))
    )
    cap = F.when(name < 50, 60.0).when(name < 62, 74.0).when(name < 75, 86.0).when(name < 82, 91.0).when(name < 86, 94.0).when(name < 90, 97.0).otherwise(1000.0)
    out = df.withColumns({"raw_score": score, "reasons": reasons, "contradictions": contradictions, "strong_evidence": strong, "evidence_coverage": F.round(coverage, 3)})
    out = out.withColumn("hard_contradictions", F.filter("contradictions", lambda x: x.isin(*HARD)))
    capped = F.when(has_name, F.least("raw_score", cap)).otherwise(F.col("raw_score"))
    capped = F.when(F.size("hard_contradictions") > 0, F.least(capped, F.lit(84.0))).otherwise(capped)
    # Nine decimals first: the last bits of a sum must not decide a tie.
    two = lambda x: F.round(F.round(x, 9), 2)
    rounded = {a: two(F.col(b)) for a, b in (("name_score", "name_raw"), ("name_wratio", "name_wratio"), ("name_token_set", "name_token_set"), ("name_token_sort", "name_token_sort"), ("street_score", "street_sim"), ("city_score", "city_sim"))}
    return out.withColumns({"score": two(F.greatest(F.lit(0.0), F.least(F.lit(100.0), capped))), **rounded})


def eligible_certain(config: MatchConfig) -> Column:
    ok = (F.col("name_score") >= config.min_name_score_certain) & (F.size("hard_contradictions") == 0)
    return ok & F.col("strong_evidence") if config.automatic_requires_strong_evidence else ok


def eligible_probable(config: MatchConfig) -> Column:
    located = (F.col("postcode_match") == "exact") | F.col("house_match").isin("exact", "same_numeric_base") | (F.col("street_score") >= 80) | (F.col("city_score") >= 92) | (F.col("name_score") >= 96)
    return (F.col("name_score") >= config.min_name_score_probable) & (F.size("hard_contradictions") <= 1) & located


def classify(config: MatchConfig) -> Column:
    """Status of a best candidate from score and score_gap."""
    certain = (F.col("score") >= config.certain_score) & (F.col("score_gap") >= config.certain_gap) & eligible_certain(config)
    probable = (F.col("score") >= config.probable_score) & (F.col("score_gap") >= config.probable_gap) & eligible_probable(config)
    return F.when(certain, CERTAIN).when(probable, PROBABLE).otherwise(NONE)
