"""The registered queries of the record-linkage operators, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.config import MatchConfig
from linkmill.functions import normalize as N
from linkmill.functions import similarity as S
from linkmill.operators import blocking, evaluate, flatten, matcher, registry, scoring
from linkmill.plans import derived as D

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return add


# ---- normalisation --------------------------------------------------------------

_REASON = f"""CASE WHEN d = '' THEN 'missing_or_non_numeric' WHEN length(d) = 11 THEN '11_digits_probable_national_register_number'
  WHEN length(d) = 9 THEN CASE WHEN 97 - CAST(substring('0' || d, 1, 8) AS BIGINT) % 97 = CAST(substring('0' || d, 9, 2) AS BIGINT) THEN '9_digits_leading_zero_was_recoverable' ELSE '9_digits_invalid_checksum_after_leading_zero' END
  WHEN length(d) <> 10 THEN 'invalid_length_' || length(d) WHEN substring(d, 1, 1) NOT IN ('0', '1') THEN 'invalid_bce_prefix'
  WHEN 97 - CAST(substring(d, 1, 8) AS BIGINT) % 97 <> CAST(substring(d, 9, 2) AS BIGINT) THEN 'invalid_bce_checksum' ELSE 'valid' END"""


@_query(f"WITH {D.BASE} SELECT p_partkey, {D.number_sql('enterprise_number')} AS number, {D.valid_sql('enterprise_number')} AS valid, (SELECT {_REASON} FROM (SELECT {D.digits_sql('enterprise_number')} AS d)) AS reason FROM con0")
def enterprise_number_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("enterprise_number")
    return D.contact_rows(spark, sf_dir).select("p_partkey", N.enterprise_number(c).alias("number"), N.enterprise_number_valid(c).alias("valid"), N.enterprise_number_reason(c).alias("reason"))


@_query(f"WITH {D.BASE} SELECT id, name_norm, name_compact, substring(name_compact, 1, 8) AS name_prefix, right(name_compact, 4) AS name_suffix4, length(name_compact) AS name_length FROM names")
def name_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.built_registry(spark, sf_dir).name.select("id", "name_norm", "name_compact", "name_prefix", "name_suffix4", F.col("name_length").cast("long").alias("name_length"))


@_query(f"WITH {D.BASE} SELECT id, coalesce(anchors[1], '') AS anchor1, coalesce(anchors[2], '') AS anchor2 FROM names")
def name_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.derived_registry(spark, sf_dir).name.select("id", "anchor1", "anchor2")


@_query(f"WITH {D.BASE} SELECT id, street_norm, street_core, street_anchor FROM addresses")
def street_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.built_registry(spark, sf_dir).address.select("id", "street_norm", "street_core", "street_anchor")


@_query(f"WITH {D.BASE} SELECT id, house_norm AS house_number_norm, house_base AS house_number_base, box_norm, postcode, city_norm FROM addresses")
def house_box_postcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.derived_registry(spark, sf_dir).address.select("id", "house_number_norm", "house_number_base", "box_norm", "postcode", "city_norm")


_ONE_LINE = "concat('Rue de la Loi ', cast(p_size as varchar(20)), case p_partkey % 3 when 0 then ' bte 4' when 1 then '/7' else '' end, case p_partkey % 4 when 0 then '' else ', 1040 Bruxelles' end)"


@_query(rf"""WITH a AS (SELECT p_partkey, {_ONE_LINE} AS t FROM part),
b AS (SELECT *, regexp_extract(t, '(?:^|[,; ])(\d{{4}}) +([^,;]+) *$', 1) AS postcode, regexp_extract(t, '(?:^|[,; ])(\d{{4}}) +([^,;]+) *$', 2) AS city, trim(regexp_replace(t, '(?:^|[,; ])(\d{{4}}) +([^,;]+) *$', ''), ' ,;') AS u FROM a),
c AS (SELECT *, regexp_extract(u, '(?:\bbte\b *|/)([a-zA-Z0-9-]+) *$', 1) AS box, trim(regexp_replace(u, '(?:\bbte\b *|/)([a-zA-Z0-9-]+) *$', ''), ' ,;/') AS v FROM b)
SELECT p_partkey, postcode, city, box, regexp_extract(v, ' (\d+)$', 1) AS house_number, regexp_replace(v, ' \d+$', '') AS street FROM c""")
def parse_full_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = D.part(spark, sf_dir).selectExpr("p_partkey", f"{_ONE_LINE} as t")
    return df.select("p_partkey", *[c.alias(k) for k, c in N.full_address(F.col("t")).items()])


# ---- registry -------------------------------------------------------------------


@_query(f"""WITH {D.BASE}, doubled AS (SELECT seq % 500 AS number, nom_entreprise AS name, seq FROM ref0)
SELECT number, name, seq FROM (SELECT *, row_number() OVER (PARTITION BY number, name ORDER BY seq) AS n FROM doubled) WHERE n = 1""")
def registry_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.reference(spark, sf_dir).select((F.col("seq") % 500).alias("number"), F.col("nom_entreprise").alias("name"), "seq")
    return registry.first_wins(rows, ["number", "name"]).select("number", "name", "seq")


_RAW_ADDRESS = {
    "EntityNumber": f"case p_partkey % 2 when 0 then {D.NUMBER} else concat('2.', substring({D.NUMBER}, 2, 11)) end", "TypeOfAddress": "case p_partkey % 2 when 0 then 'REGO' else 'BAET' end", "Zipcode": D.REFERENCE["postcode"],
    "MunicipalityNL": D.REFERENCE["city_name"], "MunicipalityFR": f"case p_partkey % 5 when 0 then '' else {D.REFERENCE['city_name']} end", "StreetNL": "concat(lower(p_type), 'straat')", "StreetFR": "case p_partkey % 4 when 0 then concat(lower(p_type), 'straat') else concat('Rue ', lower(p_type)) end",
    "HouseNumber": "cast(p_size as varchar(20))", "Box": "''", "DateStrikingOff": "case p_partkey % 10 when 3 then '01-01-2020' else '' end",
}


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = D.part(spark, sf_dir)
    return {
        "enterprise": part.selectExpr("p_partkey as seq", f"{D.NUMBER} as EnterpriseNumber", "'AC' as Status"),
        "denomination": part.selectExpr("p_partkey as seq", f"{D.NUMBER} as EntityNumber", "'2' as Language", "case p_partkey % 4 when 0 then '001' when 1 then '002' when 2 then '003' else '' end as TypeOfDenomination", f"{D.REFERENCE['nom_entreprise']} as Denomination"),
        "address": part.selectExpr("p_partkey as seq", *[f"{v} as {k}" for k, v in _RAW_ADDRESS.items()]),
        "establishment": part.selectExpr("p_partkey as seq", f"concat('2.', substring({D.NUMBER}, 2, 11)) as EstablishmentNumber", f"{D.NUMBER} as EnterpriseNumber"),
    }


@_query(f"""WITH raw AS (SELECT p_partkey AS seq, {", ".join(f"{v} AS {k}" for k, v in _RAW_ADDRESS.items())} FROM part),
units AS (SELECT {D.number_sql("concat('2.', substring(" + D.NUMBER + ", 2, 11))")} AS unit, max_by({D.NUMBER}, p_partkey) AS owner FROM part GROUP BY 1),
owned AS (SELECT r.*, CASE WHEN TypeOfAddress = 'REGO' THEN {D.number_sql('EntityNumber')} ELSE u.owner END AS number FROM raw r LEFT JOIN units u ON {D.number_sql('EntityNumber')} = u.unit WHERE DateStrikingOff = ''),
variants AS (
  SELECT seq * 2 AS id, number, TypeOfAddress AS address_type, 'FR' AS language, {D.basic_sql('StreetFR')} AS street_norm, {D.basic_sql('MunicipalityFR')} AS city_norm, HouseNumber AS house, Zipcode AS postcode FROM owned
  UNION ALL
  SELECT seq * 2 + 1, number, TypeOfAddress, 'NL', {D.basic_sql('StreetNL')}, {D.basic_sql('MunicipalityNL')}, HouseNumber, Zipcode FROM owned
  WHERE NOT ({D.basic_sql('StreetNL')} = {D.basic_sql('StreetFR')} AND {D.basic_sql('MunicipalityNL')} = {D.basic_sql('MunicipalityFR')}))
SELECT number AS enterprise_number, address_type, language, street_norm, city_norm, CASE address_type WHEN 'REGO' THEN 1 ELSE 2 END AS priority
FROM (SELECT *, row_number() OVER (PARTITION BY number, address_type, street_norm, house, postcode, city_norm ORDER BY id) AS n FROM variants WHERE number IS NOT NULL) WHERE n = 1""")
def establishment_address_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    found = registry.from_raw(raw["enterprise"], raw["denomination"], raw["address"], raw["establishment"], include_establishments=True)
    return found.address.select("enterprise_number", "address_type", "language", "street_norm", "city_norm", "priority")


@_query(f"""WITH {D.BASE}, den AS (SELECT seq, seq % 700 AS number, nom_entreprise AS name, CASE seq % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 9 END AS k FROM ref0),
adr AS (SELECT seq, seq % 600 AS number, street_name, house_number, CASE WHEN box_number <> '' THEN box_number END AS box_number, postcode, city_name FROM ref0)
SELECT lpad(CAST(f.number AS VARCHAR), 4, '0') AS numero_entreprise, d.name AS nom_entreprise, a.street_name, a.house_number, a.box_number, a.postcode, a.city_name
FROM (SELECT DISTINCT seq % 800 AS number FROM ref0) f
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY number ORDER BY k, seq) AS n FROM den) d ON d.number = f.number AND d.n = 1
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY number ORDER BY seq) AS n FROM adr) a ON a.number = f.number AND a.n = 1""")
def flatten_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = D.reference(spark, sf_dir)
    key = lambda n: F.lpad((F.col("seq") % n).cast("string"), 4, "0")
    kind = F.when(F.col("seq") % 4 == 0, "001").when(F.col("seq") % 4 == 1, "002").when(F.col("seq") % 4 == 2, "003").otherwise("")
    none = F.lit("")
    return flatten.flatten(
        ref.select(key(800).alias("EnterpriseNumber")),
        ref.select("seq", key(700).alias("EntityNumber"), kind.alias("TypeOfDenomination"), F.col("nom_entreprise").alias("Denomination")),
        ref.select("seq", key(600).alias("EntityNumber"), none.alias("StreetFR"), F.col("street_name").alias("StreetNL"), F.col("house_number").alias("HouseNumber"), F.col("box_number").alias("Box"), F.col("postcode").alias("Zipcode"), F.col("city_name").alias("MunicipalityFR"), none.alias("MunicipalityNL")),
    )


@_query(f"WITH {D.BASE} SELECT name_norm, count(DISTINCT enterprise_number) AS frequency FROM names GROUP BY name_norm")
def exact_name_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.name_frequencies(D.derived_registry(spark, sf_dir).name)


# ---- blocking -------------------------------------------------------------------

_ON = {
    "exact_name": ("names", "c.name_norm <> '' AND c.name_norm = r.name_norm"),
    "exact_name_compact": ("names", "length(c.name_compact) >= 5 AND c.name_compact = r.name_compact"),
    "postcode_house": ("addresses", "c.postcode_norm <> '' AND c.house_base <> '' AND c.postcode_norm = r.postcode AND c.house_base = r.house_base"),
    "postcode_street": ("addresses", "c.postcode_norm <> '' AND c.street_core <> '' AND c.postcode_norm = r.postcode AND c.street_core = r.street_core"),
    "city_street": ("addresses", "c.city_norm <> '' AND c.street_core <> '' AND c.city_norm = r.city_norm AND c.street_core = r.street_core"),
    "street_house": ("addresses", "length(c.street_core) >= 5 AND c.house_base <> '' AND c.street_core = r.street_core AND c.house_base = r.house_base"),
    "name_prefix": ("names", "length(c.name_compact) >= 8 AND substring(c.name_compact, 1, 8) = substring(r.name_compact, 1, 8)"),
    "city_house": ("addresses", "c.city_norm <> '' AND c.house_base <> '' AND c.city_norm = r.city_norm AND c.house_base = r.house_base"),
    "street_anchor_house": ("addresses", "length(coalesce(c.street_anchor, '')) >= 5 AND c.house_base <> '' AND c.street_anchor = r.street_anchor AND c.house_base = r.house_base"),
    "name_prefix4_length": ("names", "length(c.name_compact) >= 5 AND substring(c.name_compact, 1, 4) = substring(r.name_compact, 1, 4) AND length(r.name_compact) BETWEEN length(c.name_compact) - 3 AND length(c.name_compact) + 3"),
    "name_suffix4_length": ("names", "length(c.name_compact) >= 5 AND right(c.name_compact, 4) = right(r.name_compact, 4) AND length(r.name_compact) BETWEEN length(c.name_compact) - 3 AND length(c.name_compact) + 3"),
}
_TOKENS = D.longest_sql("list_filter(string_split(street_core, ' '), lambda t: length(t) >= 3)")
_CONTACT_ANCHOR = f"(SELECT *, coalesce({_TOKENS}[1], '') AS street_anchor FROM contacts)"


def _hits_of(rule: blocking.Rule, source: str = "contacts") -> str:
    """(source_row_number, rule, priority, enterprise_number, n, most) of one rule over a table of contacts, up to its cap and one more."""
    most = blocking._cap(rule, MatchConfig()) + 1
    anchored = f"(SELECT *, coalesce({_TOKENS}[1], '') AS street_anchor FROM {source})"
    if rule.name == "name_anchor":
        generic = D._sql_list(D.V.GENERIC_NAME_WORDS)
        pairs = f"""SELECT DISTINCT source_row_number, 'name_anchor:' || a AS rule, enterprise_number FROM (SELECT source_row_number, unnest(anchors) AS a FROM {source}) c
          JOIN (SELECT enterprise_number, unnest(anchors) AS b FROM names) r ON a = b AND length(a) >= 4 AND NOT list_contains({generic}, a)"""
    else:
        table, on = _ON[rule.name]
        pairs = f"SELECT DISTINCT c.source_row_number, '{rule.name}' AS rule, r.enterprise_number FROM {anchored} c JOIN {table} r ON {on}"
    return f"SELECT source_row_number, rule, {rule.priority} AS priority, enterprise_number, n, {most} AS most FROM (SELECT *, row_number() OVER (PARTITION BY source_row_number, rule ORDER BY enterprise_number) AS n FROM ({pairs})) WHERE n <= {most}"


def _block_sql(rule: blocking.Rule) -> str:
    return f"WITH {D.BASE} SELECT source_row_number, rule, enterprise_number, n FROM ({_hits_of(rule)})"


def _block(rule: blocking.Rule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        hits = blocking.block_hits(D.derived_contacts(spark, sf_dir), D.derived_registry(spark, sf_dir), rule.phase, MatchConfig(), (rule,))
        return hits.select("source_row_number", "rule", "enterprise_number", F.col("n").cast("long").alias("n"))

    return run


for _rule in blocking.RULES:
    _query(_block_sql(_rule), f"block_{_rule.name}")(_block(_rule))

_TIGHT = MatchConfig(max_candidates_per_block=3, max_total_candidates=5)
_PHASE1 = [r for r in blocking.RULES if r.phase == 1]


def _hits_sql(rules: list[blocking.Rule], most: int) -> str:
    """(row, rule, priority, number, n) of several rules with one cap for all."""
    parts = []
    for r in rules:
        table, on = _ON[r.name]
        parts.append(f"SELECT DISTINCT c.source_row_number, '{r.name}' AS rule, {r.priority} AS priority, r.enterprise_number FROM {_CONTACT_ANCHOR} c JOIN {table} r ON {on}")
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_row_number, rule ORDER BY enterprise_number) AS n FROM ({' UNION ALL '.join(parts)})) WHERE n <= {most + 1}"


@_query(f"WITH {D.BASE}, hits AS ({_hits_sql(_PHASE1, 3)}) SELECT source_row_number, max(n) > 3 AS truncated, count(DISTINCT rule) AS rules FROM hits GROUP BY source_row_number")
def block_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = blocking.block_hits(D.derived_contacts(spark, sf_dir), D.derived_registry(spark, sf_dir), 1, _TIGHT)
    return hits.groupBy("source_row_number").agg(F.bool_or(F.col("n") == F.col("most")).alias("truncated"), F.countDistinct("rule").alias("rules"))


@_query(f"""WITH {D.BASE}, hits AS ({_hits_sql(_PHASE1, 3)}),
s AS (SELECT source_row_number, max(n) > 3 AS cut, bool_or(rule IN ('exact_name', 'exact_name_compact', 'postcode_street', 'city_street', 'street_house')) AS settled FROM hits GROUP BY source_row_number)
SELECT c.source_row_number FROM contacts c LEFT JOIN s ON s.source_row_number = c.source_row_number WHERE NOT coalesce(s.settled AND NOT s.cut, false)""")
def phase_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    contacts = D.derived_contacts(spark, sf_dir)
    return blocking.unsettled(contacts, blocking.block_hits(contacts, D.derived_registry(spark, sf_dir), 1, _TIGHT)).select("source_row_number")


def _search_sql(source: str = "contacts") -> str:
    """(source_row_number, enterprise_number, n, most) of the prefix search over a table of contacts."""
    return f"""WITH asked AS (SELECT source_row_number, array_to_string(search, ' ') AS query, search, CASE WHEN postcode_norm <> '' OR city_norm <> '' OR street_core <> '' OR house_base <> '' THEN 140 ELSE 300 END AS most FROM {source} WHERE len(search) > 0),
queries AS (SELECT DISTINCT query, unnest(search) AS term FROM (SELECT DISTINCT query, search FROM asked)),
rows AS (SELECT id, enterprise_number, string_split(name_norm, ' ') AS tokens, len(string_split(name_norm, ' ')) AS size FROM names),
stats AS (SELECT count(*) AS n, avg(size) AS mean FROM rows),
tokens AS (SELECT id, enterprise_number, size, unnest(tokens) AS token FROM rows),
matched AS (SELECT term, id, enterprise_number, size, count(*) AS tf FROM tokens JOIN (SELECT DISTINCT term FROM queries) ON starts_with(token, term) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM matched GROUP BY term),
weights AS (SELECT term, CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END AS idf, mean FROM df, stats),
ranked AS (SELECT query, id, enterprise_number, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))), 9) AS relevance FROM queries JOIN matched USING (term) JOIN weights USING (term) GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY relevance DESC, id) AS n FROM ranked)
SELECT source_row_number, enterprise_number, n, most + 1 AS most FROM asked JOIN placed USING (query) WHERE n <= most + 1"""


@_query(f"WITH {D.BASE} SELECT source_row_number, enterprise_number, n FROM ({_search_sql()})")
def name_fts_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = blocking.search_hits(D.derived_contacts(spark, sf_dir), D.derived_registry(spark, sf_dir).name, MatchConfig())
    return hits.select("source_row_number", "enterprise_number", F.col("n").cast("long").alias("n"))


def _found_sql(source: str = "contacts") -> str:
    """Table expressions up to ``found``: all candidates of both phases within all caps, and ``cuts``: which contacts lost some."""
    settling = ", ".join(f"'{r}'" for r in blocking.SETTLING)
    union = lambda phase, source: " UNION ALL ".join(_hits_of(r, source) for r in blocking.RULES if r.phase == phase)
    return f"""h1 AS ({union(1, source)}),
settled AS (SELECT source_row_number FROM h1 GROUP BY 1 HAVING bool_or(rule IN ({settling})) AND NOT bool_or(n = most)),
more AS (SELECT c.* FROM {source} c ANTI JOIN settled USING (source_row_number)),
hits AS (SELECT * FROM h1 UNION ALL {union(2, "more")} UNION ALL SELECT source_row_number, 'name_fts' AS rule, {blocking.SEARCH_PRIORITY} AS priority, enterprise_number, n, most FROM ({_search_sql("more")})),
kept AS (SELECT source_row_number, enterprise_number, count(DISTINCT rule) AS rules, list_sort(list(DISTINCT rule)) AS rule_list, CAST(max(priority) AS BIGINT) AS priority FROM hits WHERE n < most GROUP BY ALL),
places AS (SELECT *, row_number() OVER (PARTITION BY source_row_number ORDER BY priority DESC, rules DESC, enterprise_number) AS place FROM kept),
cuts AS (SELECT source_row_number, bool_or(h.n = h.most) OR coalesce(any_value(places), 0) > 700 AS candidates_truncated, least(coalesce(any_value(places), 0), 700) AS candidate_count
  FROM hits h LEFT JOIN (SELECT source_row_number, max(place) AS places FROM places GROUP BY 1) USING (source_row_number) GROUP BY 1),
found AS (SELECT source_row_number, enterprise_number, rules, rule_list, priority FROM places WHERE place <= 700)"""


@_query(f"WITH {D.BASE}, {_found_sql()} SELECT source_row_number, enterprise_number, rules, priority FROM found")
def candidate_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = blocking.candidates(D.derived_contacts(spark, sf_dir), D.derived_registry(spark, sf_dir), MatchConfig())
    return found.select("source_row_number", "enterprise_number", F.size("rules").cast("long").alias("rules"), F.col("priority").cast("long").alias("priority"))


# ---- similarity -----------------------------------------------------------------

_PAIR = {"a": "concat(p_name, ' ', lower(p_type))", "b": "concat(lower(p_type), ' ', substring(p_name, 2, 9))"}


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.part(spark, sf_dir).selectExpr("p_partkey", *[f"{v} as {k}" for k, v in _PAIR.items()])


_LCS_TABLE = """
WITH RECURSIVE p AS (SELECT DISTINCT {a} AS a, {b} AS b FROM part),
walk(a, b, i, prev) AS (
  SELECT a, b, 0, list_transform(range(0, length(b) + 1), lambda x: 0::BIGINT) FROM p
  UNION ALL
  SELECT a, b, i + 1, list_reduce(range(1, length(b) + 1), lambda acc, j: list_append(acc, CASE WHEN substring(a, i + 1, 1) = substring(b, CAST(j AS INT), 1) THEN prev[j] + 1 ELSE greatest(prev[j + 1], acc[j]) END), [0::BIGINT])
  FROM walk WHERE i < length(a)),
lcs AS (SELECT a, b, prev[length(b) + 1] AS n FROM walk WHERE i = length(a))
"""


@F.pandas_udf(T.DoubleType())
def _indel(a, b):
    import pandas as pd

    return pd.Series([S.indel_ratio(x, y) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.DoubleType())
def _token_sort(a, b):
    import pandas as pd

    return pd.Series([S.token_sort_ratio(x, y) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.DoubleType())
def _token_set(a, b):
    import pandas as pd

    return pd.Series([S.token_set_ratio(x, y) for x, y in zip(a, b, strict=True)])


_SORTED = {k: f"array_to_string(list_sort(string_split({v}, ' ')), ' ')" for k, v in _PAIR.items()}


@_query(_LCS_TABLE.format(**_PAIR) + "SELECT DISTINCT a, b, round(200.0 * n / (length(a) + length(b)), 6) AS ratio FROM lcs")
def indel_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("a", "b").distinct().withColumn("ratio", F.round(_indel("a", "b"), 6))


@_query(_LCS_TABLE.format(**_SORTED) + "SELECT DISTINCT a, b, round(200.0 * n / (length(a) + length(b)), 6) AS ratio FROM lcs")
def token_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = lambda c: F.array_join(F.array_sort(F.split(c, " ")), " ").alias(c)
    df = _pairs(spark, sf_dir).withColumn("ratio", F.round(_token_sort("a", "b"), 6))
    return df.select(ordered("a"), ordered("b"), "ratio").distinct()


_SETS = {k: f"list_sort(list_distinct(string_split({v}, ' ')))" for k, v in _PAIR.items()}
_REST = {"a": f"array_to_string(list_filter({_SETS['a']}, lambda t: NOT list_contains({_SETS['b']}, t)), ' ')", "b": f"array_to_string(list_filter({_SETS['b']}, lambda t: NOT list_contains({_SETS['a']}, t)), ' ')"}


@_query(_LCS_TABLE.format(**_REST) + f""", rows AS (SELECT DISTINCT {_PAIR['a']} AS l, {_PAIR['b']} AS r, {_REST['a']} AS a, {_REST['b']} AS b, array_to_string(list_filter({_SETS['a']}, lambda t: list_contains({_SETS['b']}, t)), ' ') AS c FROM part),
sized AS (SELECT l, r, rows.a, rows.b, c, n, length(c) AS s, length(c) + CAST(c <> '' AS INT) + length(rows.a) AS x, length(c) + CAST(c <> '' AS INT) + length(rows.b) AS y FROM rows JOIN lcs ON rows.a = lcs.a AND rows.b = lcs.b)
SELECT l AS a, r AS b, round(CASE WHEN c <> '' AND (a = '' OR b = '') THEN 100.0 WHEN c = '' THEN 200.0 * n / (length(a) + length(b))
  ELSE greatest(100 - 100.0 * (length(a) + length(b) - 2 * n) / (x + y), 100 - 100.0 * (1 + length(a)) / (s + x), 100 - 100.0 * (1 + length(b)) / (s + y)) END, 6) AS ratio FROM sized""")
def token_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("a", "b").distinct().withColumn("ratio", F.round(_token_set("a", "b"), 6))


def similarity_sql(pairs: str) -> str:
    """Table expressions up to ``sims`` (l, r, combined, weighted, token_set, token_sort) of the texts ``pairs`` (l, r).

    The longest common subsequence is bit-parallel on 128-bit integers, for texts of up to 120 characters.
    """
    window = "CASE WHEN k < 0 THEN substring(y, 1, k + n) ELSE substring(y, k + 1, n) END"
    windows = f"SELECT DISTINCT id, x, {window} AS w FROM (SELECT *, unnest(range(1 - n, m)) AS k FROM both_ways)"
    return f"""p0 AS (SELECT DISTINCT l, r FROM ({pairs}) WHERE l <> '' AND r <> '' AND l <> r),
p1 AS (SELECT l, r, list_sort(string_split(l, ' ')) AS tl, list_sort(string_split(r, ' ')) AS tr FROM p0),
p2 AS (SELECT *, list_sort(list_distinct(tl)) AS sl, list_sort(list_distinct(tr)) AS sr, greatest(length(l), length(r)) / least(length(l), length(r)) AS spread FROM p1),
p3 AS (SELECT *, array_to_string(tl, ' ') AS ls, array_to_string(tr, ' ') AS rs, array_to_string(list_filter(sl, lambda t: list_contains(sr, t)), ' ') AS c,
  array_to_string(list_filter(sl, lambda t: NOT list_contains(sr, t)), ' ') AS rl, array_to_string(list_filter(sr, lambda t: NOT list_contains(sl, t)), ' ') AS rr FROM p2),
portions AS (SELECT DISTINCT l AS u, r AS v FROM p3 WHERE spread >= 1.5 UNION SELECT ls, rs FROM p3 WHERE spread >= 1.5 AND c = ''
  UNION SELECT array_to_string(sl, ' '), array_to_string(sr, ' ') FROM p3 WHERE spread >= 1.5 AND c = '' AND (len(sl) <> len(tl) OR len(sr) <> len(tr))),
sided AS (SELECT u, v, CASE WHEN length(u) <= length(v) THEN u ELSE v END AS x, CASE WHEN length(u) <= length(v) THEN v ELSE u END AS y FROM portions WHERE u <> '' AND v <> ''),
both_ways AS (SELECT u || chr(1) || v AS id, x, y, length(x) AS n, length(y) AS m FROM sided WHERE strpos(y, x) = 0
  UNION ALL SELECT u || chr(1) || v, y, x, length(y), length(x) FROM sided WHERE strpos(y, x) = 0 AND length(x) = length(y)),
windows AS ({windows}),
need AS (SELECT l AS x, r AS y FROM p3 UNION SELECT ls, rs FROM p3 UNION SELECT rl, rr FROM p3 WHERE rl <> '' AND rr <> '' UNION SELECT x, w FROM windows),
masks AS (SELECT x, map_from_entries(list({{'k': ch, 'v': mask}})) AS m FROM (SELECT x, ch, sum(CAST(1 AS HUGEINT) << (i - 1)) AS mask FROM (SELECT x, unnest(string_split(x, '')) AS ch, unnest(range(1, length(x) + 1)) AS i FROM (SELECT DISTINCT x FROM need)) GROUP BY ALL) GROUP BY x),
lcs AS (SELECT x, y, length(x) - bit_count(list_reduce(string_split(y, ''), lambda s, ch:
    ((s + (s & coalesce(m[ch], 0::HUGEINT))) | (s - (s & coalesce(m[ch], 0::HUGEINT)))) & ((CAST(1 AS HUGEINT) << length(x)) - 1), (CAST(1 AS HUGEINT) << length(x)) - 1)) AS n FROM need JOIN masks USING (x)),
best AS (SELECT id, max(200.0e0 * n / (length(lcs.x) + length(lcs.y))) AS ratio FROM windows w JOIN lcs ON w.x = lcs.x AND w.w = lcs.y GROUP BY id),
parts AS (SELECT u, v, CASE WHEN u = '' OR v = '' THEN CASE WHEN u = v THEN 100.0e0 ELSE 0.0e0 END WHEN strpos(y, x) > 0 THEN 100.0e0 ELSE coalesce(ratio, 0.0e0) END AS ratio FROM (SELECT u, v, x, y FROM portions LEFT JOIN sided USING (u, v)) LEFT JOIN best ON id = u || chr(1) || v),
p4 AS (SELECT p3.*, 200.0e0 * a.n / (length(l) + length(r)) AS indel, 200.0e0 * b.n / (length(ls) + length(rs)) AS token_sort,
  length(c) + CAST(c <> '' AS INT) + length(rl) AS xl, length(c) + CAST(c <> '' AS INT) + length(rr) AS yl, length(rl) + length(rr) - 2 * coalesce(d.n, 0) AS distance, 200.0e0 * coalesce(d.n, 0) / greatest(1, length(rl) + length(rr)) AS rest
  FROM p3 JOIN lcs a ON a.x = l AND a.y = r JOIN lcs b ON b.x = ls AND b.y = rs LEFT JOIN lcs d ON d.x = rl AND d.y = rr),
p5 AS (SELECT *, CASE WHEN c <> '' AND (rl = '' OR rr = '') THEN 100.0e0 WHEN c = '' THEN rest ELSE greatest(100 - 100.0e0 * distance / (xl + yl), 100 - 100.0e0 * (1 + length(rl)) / (length(c) + xl), 100 - 100.0e0 * (1 + length(rr)) / (length(c) + yl)) END AS token_set FROM p4),
p6 AS (SELECT p5.*, CASE WHEN spread <= 8 THEN 0.9e0 ELSE 0.6e0 END AS scale, q.ratio AS partial, CASE WHEN c <> '' THEN 100.0e0 ELSE greatest(t.ratio, coalesce(d.ratio, 0)) END AS partial_token
  FROM p5 LEFT JOIN parts q ON q.u = l AND q.v = r LEFT JOIN parts t ON t.u = ls AND t.v = rs LEFT JOIN parts d ON (len(sl) <> len(tl) OR len(sr) <> len(tr)) AND d.u = array_to_string(sl, ' ') AND d.v = array_to_string(sr, ' ')),
p7 AS (SELECT *, CASE WHEN spread < 1.5 THEN greatest(indel, 0.95e0 * greatest(token_sort, token_set)) ELSE greatest(indel, scale * partial, 0.95e0 * scale * partial_token) END AS weighted,
  length(regexp_replace(l, '[^a-z0-9]', '', 'g')) AS cl, length(regexp_replace(r, '[^a-z0-9]', '', 'g')) AS cr FROM p6),
sims AS (SELECT l, r, greatest(0.0e0, least(100.0e0, 0.45e0 * weighted + 0.35e0 * token_set + 0.20e0 * token_sort - CASE WHEN least(cl, cr) > 0 AND least(cl, cr) / greatest(cl, cr) < 0.45 AND least(cl, cr) < 8 THEN 12.0e0 ELSE 0.0e0 END)) AS combined, weighted, token_set, token_sort FROM p7
  UNION ALL SELECT DISTINCT l, r, 100.0e0, 100.0e0, 100.0e0, 100.0e0 FROM ({pairs}) WHERE l = r AND l <> ''
  UNION ALL SELECT DISTINCT l, r, 0.0e0, 0.0e0, 0.0e0, 0.0e0 FROM ({pairs}) WHERE l = '' OR r = '')"""


# Texts of like and of very different lengths, with and without common tokens, repeated ones included.
_LIKE = [(_PAIR["a"], _PAIR["b"]), (_PAIR["a"], "p_name"), ("p_name", "lower(p_type)"), ("concat(p_name, ' ', p_name, ' ', lower(p_type))", "trim(substring(p_name, 3, 4))"), (_PAIR["a"], "concat(trim(substring(lower(p_type), 2, 5)), ' ', trim(substring(lower(p_type), 2, 5)))")]


@_query(f"WITH {similarity_sql(' UNION '.join(f'SELECT {a} AS l, {b} AS r FROM part' for a, b in _LIKE))} SELECT l AS a, r AS b, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("combined", "weighted", "token_set", "token_sort")) + " FROM sims")
def weighted_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = D.part(spark, sf_dir)
    df = part.select(F.explode(F.array(*[F.struct(F.expr(a).alias("a"), F.expr(b).alias("b")) for a, b in _LIKE])).alias("p")).select("p.*").distinct().withColumn("s", S.similarity("a", "b"))
    return df.select("a", "b", *[F.round(f"s.{c}", 6).alias(c) for c in ("combined", "weighted", "token_set", "token_sort")])


# ---- scoring --------------------------------------------------------------------

# Features of made-up pairs, from lineitem: every branch of the score is met.
_CODE = "case {x} % 5 when 0 then 'exact' when 1 then 'mismatch' when 2 then 'both_missing' when 3 then 'input_missing' else {last} end"
_FEATURES = {
    "source_row_number": "l_orderkey * 10 + l_linenumber", "enterprise_number": "concat('0', cast(l_partkey as varchar(20)))", "name_norm": "case l_partkey % 9 when 0 then '' else 'x' end", "matched_name_norm": "case l_suppkey % 4 when 0 then 'x' when 1 then '' else 'y' end",
    "name_raw": "cast((l_partkey * 37 + l_linenumber) % 1001 as double) / 10", "street_norm": "case l_partkey % 6 when 0 then '' else 's' end", "r_street_norm": "case l_suppkey % 7 when 0 then '' else 's' end",
    "street_sim": "cast((l_suppkey * 53 + l_linenumber * 7) % 1001 as double) / 10", "city_norm": "'c'", "r_city_norm": "case l_linenumber % 3 when 0 then '' else 'c' end", "city_sim": "cast((l_partkey * 11 + l_suppkey) % 1001 as double) / 10",
    "house_match": _CODE.format(x="l_partkey", last="'same_numeric_base'"), "postcode_match": _CODE.format(x="(l_partkey + l_suppkey)", last="'exact'"), "box_match": _CODE.format(x="l_suppkey", last="'reference_missing'"),
    "frequency": "cast(case l_linenumber when 1 then 1 when 2 then 4 when 3 then 10 else 25 end as bigint)", "status": "case l_linenumber % 3 when 0 then 'AC' when 1 then '' else 'ST' end",
}
_COMPONENT = "case {m} when 'exact' then 100.0e0 when 'same_numeric_base' then 82.0e0 when 'mismatch' then 0.0e0 end"


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*[f"{v} as {k}" for k, v in _FEATURES.items()])
    df = df.selectExpr("*", *[f"{_COMPONENT.format(m=f'{p}_match')} as {p}_component" for p in ("house", "postcode", "box")])
    return df.withColumns({"name_wratio": F.lit(0.0), "name_token_set": F.lit(0.0), "name_token_sort": F.lit(0.0)})


_SCORING = f"""
f1 AS (SELECT *, {", ".join(f"{_COMPONENT.format(m=f'{p}_match')} AS {p}_component" for p in ("house", "postcode", "box"))}, name_norm <> '' AND matched_name_norm <> '' AS has_name, name_norm <> '' AND name_norm = matched_name_norm AS same_name,
  street_norm <> '' AND r_street_norm <> '' AS has_street, city_norm <> '' AND r_city_norm <> '' AS has_city FROM f0),
f2 AS (SELECT *,
  0.0e0 + CASE WHEN has_name THEN 0.42e0 ELSE 0 END + CASE WHEN has_street THEN 0.21e0 ELSE 0 END + CASE WHEN house_component IS NOT NULL THEN 0.14e0 ELSE 0 END + CASE WHEN postcode_component IS NOT NULL THEN 0.14e0 ELSE 0 END + CASE WHEN has_city THEN 0.07e0 ELSE 0 END + CASE WHEN box_component IS NOT NULL THEN 0.02e0 ELSE 0 END AS w,
  0.0e0 + CASE WHEN has_name THEN 0.42e0 * name_raw ELSE 0 END + CASE WHEN has_street THEN 0.21e0 * street_sim ELSE 0 END + coalesce(0.14e0 * house_component, 0) + coalesce(0.14e0 * postcode_component, 0) + CASE WHEN has_city THEN 0.07e0 * city_sim ELSE 0 END + coalesce(0.02e0 * box_component, 0) AS p FROM f1),
f3 AS (SELECT *, CASE WHEN w = 0 THEN 0 ELSE p / w END * (0.58e0 + 0.42e0 * least(1.0e0, w))
  + CASE WHEN same_name THEN CASE WHEN frequency = 1 THEN 7 WHEN frequency BETWEEN 2 AND 5 THEN 3 WHEN frequency > 20 THEN -5 ELSE 0 END WHEN name_raw >= 95 THEN 3 WHEN name_raw >= 88 THEN 0 WHEN has_name AND name_raw < 50 THEN -20 ELSE 0 END
  + CASE postcode_match WHEN 'exact' THEN 3 WHEN 'mismatch' THEN -18 ELSE 0 END + CASE house_match WHEN 'exact' THEN 3 WHEN 'mismatch' THEN -24 ELSE 0 END
  + CASE WHEN street_sim >= 96 THEN 2 WHEN has_street AND street_sim < 45 THEN -13 ELSE 0 END + CASE WHEN city_sim >= 95 THEN 0 WHEN has_city AND city_sim < 45 THEN -7 ELSE 0 END + CASE WHEN box_match = 'mismatch' THEN -5 ELSE 0 END
  + CASE WHEN postcode_match = 'exact' AND house_match IN ('exact', 'same_numeric_base') THEN 3 ELSE 0 END + CASE WHEN name_raw >= 90 AND postcode_match = 'exact' AND house_match = 'exact' AND street_sim >= 82 THEN 5 ELSE 0 END
  + CASE status WHEN 'AC' THEN 1 WHEN '' THEN 0 ELSE -1 END AS raw,
  CAST(NOT same_name AND name_raw < 50 AND has_name AS INT) + CAST(postcode_match = 'mismatch' AS INT) + CAST(house_match = 'mismatch' AS INT) AS hard,
  (name_raw >= 90 AND postcode_match = 'exact' AND house_match IN ('exact', 'same_numeric_base') AND street_sim >= 75) OR (name_norm = matched_name_norm AND frequency = 1 AND street_sim >= 88 AND (postcode_match = 'exact' OR city_sim >= 95)) OR (name_raw >= 87 AND street_sim >= 94 AND house_match = 'exact' AND postcode_match = 'exact') AS strong FROM f2),
scored AS (SELECT *, CAST(round(CAST(greatest(0.0e0, least(100.0e0, least(raw, CASE WHEN NOT has_name THEN 1000 WHEN name_raw < 50 THEN 60 WHEN name_raw < 62 THEN 74 WHEN name_raw < 75 THEN 86 WHEN name_raw < 82 THEN 91 WHEN name_raw < 86 THEN 94 WHEN name_raw < 90 THEN 97 ELSE 1000 END, CASE WHEN hard > 0 THEN 84 ELSE 1000 END))) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS score FROM f3)
"""
_SCORED = f"f0 AS (SELECT {', '.join(f'{v} AS {k}' for k, v in _FEATURES.items())} FROM lineitem),{_SCORING}"


@_query(f"WITH {_SCORED} SELECT source_row_number, enterprise_number, score, hard AS hard_contradictions, strong AS strong_evidence FROM scored")
def score_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scoring.apply_score(_features(spark, sf_dir))
    return df.select("source_row_number", "enterprise_number", "score", F.size("hard_contradictions").alias("hard_contradictions"), "strong_evidence")


@_query(f"""WITH {D.BASE} SELECT source_row_number, id, CASE WHEN c.house_norm = '' AND r.house_norm = '' THEN 'both_missing' WHEN c.house_norm = '' THEN 'input_missing' WHEN r.house_norm = '' THEN 'reference_missing' WHEN c.house_norm = r.house_norm THEN 'exact' WHEN c.house_base = r.house_base THEN 'same_numeric_base' ELSE 'mismatch' END AS house_match,
CASE WHEN c.box_norm = '' AND r.box_norm = '' THEN 'both_missing' WHEN c.box_norm = '' THEN 'input_missing' WHEN r.box_norm = '' THEN 'reference_missing' WHEN c.box_norm = r.box_norm THEN 'exact' ELSE 'mismatch' END AS box_match
FROM contacts c JOIN addresses r ON c.city_norm = r.city_norm AND c.street_core = r.street_core""")
def score_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, places = D.derived_addresses(spark, sf_dir)
    return scoring.equalities(made, places, places.count())


_RANKED = f"""{_SCORED},
placed AS (SELECT source_row_number // 1000 AS contact, *, row_number() OVER w AS rank, coalesce(lead(score) OVER w, 0) AS second FROM scored WINDOW w AS (PARTITION BY source_row_number // 1000 ORDER BY score DESC, enterprise_number, source_row_number)),
best AS (SELECT contact, rank, enterprise_number, score, round(score - second, 2) AS gap, round(name_raw, 2) AS name_score, round(street_sim, 2) AS street_score, round(city_sim, 2) AS city_score, house_match, postcode_match, hard, strong FROM placed)
"""
_CERTAIN_OK = "name_score >= 86 AND hard = 0 AND strong"
_PROBABLE_OK = "name_score >= 62 AND hard <= 1 AND (postcode_match = 'exact' OR house_match IN ('exact', 'same_numeric_base') OR street_score >= 80 OR city_score >= 92 OR name_score >= 96)"
_STATUS = f"CASE WHEN score >= 92 AND gap >= 8 AND {_CERTAIN_OK} THEN 'MATCH_CERTAIN' WHEN score >= 72 AND gap >= 3 AND {_PROBABLE_OK} THEN 'MATCH_PROBABLE' ELSE 'NO_RELIABLE_MATCH' END"


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up candidates of made-up contacts (a thousand row numbers each), ranked."""
    df = scoring.apply_score(_features(spark, sf_dir)).withColumn("tie", F.col("source_row_number")).withColumn("source_row_number", F.floor(F.col("source_row_number") / 1000))
    top = matcher.rank(df, MatchConfig().top_k, "tie")
    return top.select(F.col("source_row_number").alias("contact"), F.col("candidate_rank").cast("long").alias("rank"), "enterprise_number", "score", "score_gap")


@_query(f"WITH {_RANKED} SELECT contact, rank, enterprise_number, score FROM best WHERE rank <= 5")
def top_k_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).select("contact", "rank", "enterprise_number", "score")


@_query(f"WITH {_RANKED} SELECT contact, score, gap FROM best WHERE rank = 1")
def score_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).where("rank = 1").select("contact", "score", F.col("score_gap").alias("gap"))


@_query(f"WITH {_SCORED}, best AS (SELECT *, round(name_raw, 2) AS name_score, round(street_sim, 2) AS street_score, round(city_sim, 2) AS city_score, score AS gap FROM scored) SELECT source_row_number, enterprise_number, {_STATUS} AS match_status FROM best")
def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scoring.apply_score(_features(spark, sf_dir)).withColumn("score_gap", F.col("score"))
    return df.select("source_row_number", "enterprise_number", scoring.classify(MatchConfig()).alias("match_status"))


@_query(f"WITH {_SCORED}, best AS (SELECT *, round(name_raw, 2) AS name_score, round(street_sim, 2) AS street_score, round(city_sim, 2) AS city_score, score AS gap FROM scored) SELECT {_STATUS} AS match_status, count(*) AS n FROM best GROUP BY 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matcher.status_counts(classify(spark, sf_dir))


# ---- evaluation -----------------------------------------------------------------


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scoring.apply_score(_features(spark, sf_dir)).withColumn("score_gap", F.round(F.col("score") / 2, 2))
    config = MatchConfig(certain_gap=4.0)
    right = (F.col("source_row_number") % 10 != 0) | (F.col("score") > 95)
    return df.select(
        F.lit("t").alias("truth_enterprise_number"), right.alias("prediction_correct"), (right | (F.col("source_row_number") % 20 == 0)).alias("truth_in_top_k"), F.col("score").alias("match_score"), "score_gap",
        scoring.classify(config).alias("match_status"), scoring.eligible_certain(config).alias("eligible_certain"), scoring.eligible_probable(config).alias("eligible_probable"),
    )


_JUDGED = f"""{_SCORED},
best AS (SELECT *, round(name_raw, 2) AS name_score, round(street_sim, 2) AS street_score, round(city_sim, 2) AS city_score, round(score / 2, 2) AS gap FROM scored),
judged AS (SELECT source_row_number % 10 <> 0 OR score > 95 AS ok, source_row_number % 10 <> 0 OR score > 95 OR source_row_number % 20 = 0 AS top, score, gap, {_STATUS.replace('gap >= 8', 'gap >= 4')} AS status, {_CERTAIN_OK} AS certain_ok, {_PROBABLE_OK} AS probable_ok FROM best)
"""


@_query(f"""WITH {_JUDGED}, s AS (SELECT count(*) AS t, count(*) FILTER (top) AS k, count(*) FILTER (ok) AS r, count(*) FILTER (status = 'MATCH_CERTAIN') AS c, count(*) FILTER (status = 'MATCH_CERTAIN' AND ok) AS cr,
  count(*) FILTER (status = 'MATCH_PROBABLE') AS p, count(*) FILTER (status = 'MATCH_PROBABLE' AND ok) AS pr, count(*) FILTER (status = 'NO_RELIABLE_MATCH') AS z FROM judged)
SELECT t AS evaluated_rows, k / t AS candidate_recall_top_k, r / t AS top1_accuracy, c AS certain_count, c / t AS certain_coverage, coalesce(cr / nullif(c, 0), 0) AS certain_precision, c - cr AS false_certain_count,
  p AS probable_count, p / t AS probable_coverage, coalesce(pr / nullif(p, 0), 0) AS probable_precision, z AS no_match_count, z / t AS no_match_share FROM s""")
def evaluation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.metrics(_judged(spark, sf_dir))


_GRID = """, g AS (SELECT s / 2 AS score, p / 2 AS gap FROM range(184, 201) a(s), range(16, 201) b(p)),
grid AS (SELECT g.score, g.gap, count(*) AS predictions, count(*) FILTER (ok) AS correct_predictions FROM g JOIN judged j ON j.certain_ok AND j.score >= g.score AND j.gap >= g.gap GROUP BY ALL),
full_grid AS (SELECT score, gap, correct_predictions / predictions AS precision, predictions / (SELECT count(*) FROM judged) AS coverage, predictions, correct_predictions, predictions - correct_predictions AS false_predictions FROM grid)
"""


@_query(f"WITH {_JUDGED} {_GRID} SELECT * FROM full_grid")
def threshold_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.threshold_grid(_judged(spark, sf_dir), "eligible_certain", 92.0, 8.0)


@_query(f"WITH {_JUDGED} {_GRID} SELECT * FROM full_grid WHERE predictions >= 30 AND precision >= 0.9 ORDER BY coverage DESC, precision DESC, score, gap LIMIT 1")
def recommend_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.recommend(evaluate.threshold_grid(_judged(spark, sf_dir), "eligible_certain", 92.0, 8.0), 0.9, 30)


# ---- the whole ------------------------------------------------------------------


def _coded(left: str, right: str, base: str = "false") -> str:
    return f"CASE WHEN {left} = '' AND {right} = '' THEN 'both_missing' WHEN {left} = '' THEN 'input_missing' WHEN {right} = '' THEN 'reference_missing' WHEN {left} = {right} THEN 'exact' WHEN {base} THEN 'same_numeric_base' ELSE 'mismatch' END"


def _rounded(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18, 9)), 2) AS DOUBLE)"


def _joined(entries: list[tuple[str, str]]) -> str:
    """The texts whose conditions hold, in order."""
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {cond} THEN {text} END" for cond, text in entries) + "], lambda t: t IS NOT NULL), ' | ')"


_AGREE = "name_raw >= 90 AND postcode_match = 'exact' AND house_match = 'exact' AND street_sim >= 82"
_REASONS = [
    ("same_name", "'nom normalisé exact'"), ("same_name AND frequency = 1", "'nom exact unique dans la référence'"), ("same_name AND frequency BETWEEN 2 AND 5", "'nom exact partagé par ' || frequency || ' entreprises'"),
    ("same_name AND frequency > 20", "'nom exact très fréquent (' || frequency || ' entreprises)'"), ("NOT same_name AND name_raw >= 95", "'nom quasi identique'"), ("NOT same_name AND name_raw >= 88 AND name_raw < 95", "'nom fortement similaire'"),
    ("postcode_match = 'exact'", "'code postal exact'"), ("house_match = 'exact'", "'numéro de rue exact'"), ("house_match = 'same_numeric_base'", "'même base numérique de numéro de rue'"), ("street_sim >= 96", "'rue quasi exacte'"), ("city_sim >= 95", "'ville quasi exacte'"),
    ("box_match = 'exact'", "'boîte exacte'"), (_AGREE, "'nom et adresse se confirment mutuellement'"), ("status = 'AC'", "'entreprise active dans la BCE'"), ("status NOT IN ('AC', '')", "'statut BCE non actif: ' || status"),
]
_CONTRADICTIONS = [("NOT same_name AND has_name AND name_raw < 50", "'nom très différent'"), ("postcode_match = 'mismatch'", "'code postal différent'"), ("house_match = 'mismatch'", "'numéro de rue différent'")]


def matched_sql(wanted: str) -> str:
    """Table expressions up to ``top``: the ranked candidates of the contacts that are ``wanted``, all steps of the matcher in SQL."""
    pairs = " UNION ".join(f"SELECT {a} AS l, {b} AS r FROM joined" for a, b in (("name_norm", "matched_name_norm"), ("street_norm", "r_street_norm"), ("street_core", "r_street_core"), ("city_norm", "r_city_norm")))
    return f"""{D.BASE}, todo AS (SELECT * FROM contacts WHERE {wanted}),
{_found_sql("todo")},
joined AS (SELECT f.source_row_number, f.enterprise_number, f.rule_list, c.name_norm, c.street_norm, c.street_core, c.house_norm, c.house_base, c.box_norm, c.postcode_norm, c.city_norm,
  coalesce(n.name, '') AS matched_name, coalesce(n.name_norm, '') AS matched_name_norm, a.street_norm AS r_street_norm, a.street_core AS r_street_core, a.house_norm AS r_house_norm, a.house_base AS r_house_base, a.box_norm AS r_box_norm,
  a.postcode AS r_postcode, a.city_norm AS r_city_norm, e.status, e.street_name AS r_street, e.house_number AS r_house_number, e.box_number AS r_box, e.city_name AS r_city
  FROM found f JOIN todo c USING (source_row_number) LEFT JOIN names n ON n.enterprise_number = f.enterprise_number JOIN addresses a ON a.enterprise_number = f.enterprise_number JOIN ref0 e ON e.numero_entreprise = f.enterprise_number),
{similarity_sql(pairs)},
frequencies AS (SELECT name_norm, count(DISTINCT enterprise_number) AS frequency FROM names GROUP BY 1),
f0 AS (SELECT j.*, n.combined AS name_raw, n.weighted AS name_wratio, n.token_set AS name_token_set, n.token_sort AS name_token_sort, greatest(s.combined, t.combined) AS street_sim, y.combined AS city_sim,
  {_coded("house_norm", "r_house_norm", "house_base <> '' AND house_base = r_house_base")} AS house_match, {_coded("postcode_norm", "r_postcode")} AS postcode_match, {_coded("box_norm", "r_box_norm")} AS box_match, coalesce(q.frequency, 0) AS frequency
  FROM joined j JOIN sims n ON n.l = j.name_norm AND n.r = matched_name_norm JOIN sims s ON s.l = street_norm AND s.r = r_street_norm JOIN sims t ON t.l = street_core AND t.r = r_street_core JOIN sims y ON y.l = city_norm AND y.r = r_city_norm
  LEFT JOIN frequencies q ON q.name_norm = j.name_norm),
{_SCORING},
placed AS (SELECT *, row_number() OVER w AS rank, coalesce(lead(score) OVER w, 0) AS second FROM scored WINDOW w AS (PARTITION BY source_row_number ORDER BY score DESC, enterprise_number)),
top AS (SELECT * REPLACE ({", ".join(f"{_rounded(c)} AS {c}" for c in ("name_wratio", "name_token_set", "name_token_sort"))}), round(score - second, 2) AS gap, {_rounded("name_raw")} AS name_score, {_rounded("street_sim")} AS street_score, {_rounded("city_sim")} AS city_score,
  round(least(1.0e0, w), 3) AS evidence_coverage, {_joined(_REASONS)} AS reasons, {_joined(_CONTRADICTIONS)} AS contradictions, array_to_string(rule_list, ' | ') AS generation_rules FROM placed WHERE rank <= 5)"""


_VALID = D.valid_sql("enterprise_number")
_PAIR_COLUMNS = {"candidate_enterprise_number": "b.enterprise_number", "candidate_company_name": "b.matched_name", "candidate_street_name": "b.r_street", "candidate_house_number": "b.r_house_number", "candidate_box_number": "b.r_box", "candidate_postcode": "b.r_postcode", "candidate_city_name": "b.r_city"}


def _result_sql() -> str:
    zero = ", ".join(f"coalesce(b.{c}, 0) AS {n}" for c, n in (("score", "match_score"), ("second", "second_best_score"), ("gap", "score_gap"), *[(c, c) for c in ("name_score", "name_wratio", "name_token_set", "name_token_sort", "street_score", "city_score", "evidence_coverage")]))
    text = ", ".join(f"coalesce({c}, '') AS {n}" for n, c in {"hard_contradictions": "b.contradictions", "match_reasons": "b.reasons", "candidate_generation_rules": "b.generation_rules", "house_match": "b.house_match", "box_match": "b.box_match", "postcode_match": "b.postcode_match", **_PAIR_COLUMNS}.items())
    normal = ", ".join(f"c.{c} AS {n}" for n, c in {"normalised_company_name": "name_norm", "normalised_street": "street_norm", "normalised_house_number": "house_norm", "normalised_box": "box_norm", "normalised_postcode": "postcode_norm", "normalised_city": "city_norm"}.items())
    return f"""WITH {matched_sql(f"NOT {_VALID}")},
first_one AS (SELECT *, {_STATUS} AS match_status FROM top WHERE rank = 1),
every AS (SELECT *, {_VALID} AS valid FROM contacts)
SELECT c.source_row_number, c.contact_id AS source_id, CASE WHEN valid THEN 'SKIPPED_EXISTING_NUMBER' ELSE coalesce(b.match_status, 'NO_RELIABLE_MATCH') END AS match_status,
  CASE WHEN b.match_status = 'MATCH_CERTAIN' THEN b.enterprise_number ELSE '' END AS automatic_enterprise_number, CASE WHEN b.match_status IN ('MATCH_CERTAIN', 'MATCH_PROBABLE') THEN b.enterprise_number ELSE '' END AS suggested_enterprise_number,
  {zero}, coalesce(candidate_count, 0) AS candidate_count, coalesce(candidates_truncated, false) AS candidates_truncated, coalesce(b.strong, false) AS strong_evidence, {text},
  {D.number_sql("c.enterprise_number")} AS existing_enterprise_number, valid AS existing_enterprise_number_valid, {normal}, '' AS match_error
FROM every c LEFT JOIN first_one b USING (source_row_number) LEFT JOIN cuts USING (source_row_number)"""


@_query(_result_sql())
def match_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matcher.match(*D.derived(spark, sf_dir))[0]


@_query(f"""WITH {matched_sql(f"NOT {_VALID}")}
SELECT source_row_number, c.contact_id AS source_id, CAST(rank AS INTEGER) AS candidate_rank, b.enterprise_number, score, name_score, street_score, house_match, postcode_match, box_match, city_score, strong AS strong_evidence, contradictions AS hard_contradictions, reasons, generation_rules,
  {", ".join(f"{v} AS {k}" for k, v in _PAIR_COLUMNS.items())} FROM top b JOIN todo c USING (source_row_number)""")
def match_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matcher.match(*D.derived(spark, sf_dir))[1]


@_query(f"""WITH {matched_sql(_VALID)}, known AS (SELECT source_row_number, {D.number_sql("enterprise_number")} AS truth FROM todo),
among AS (SELECT source_row_number, list(enterprise_number) AS numbers FROM top GROUP BY 1)
SELECT source_row_number, truth AS truth_enterprise_number, coalesce(b.enterprise_number, '') AS predicted_enterprise_number, coalesce(b.enterprise_number = truth, false) AS prediction_correct, coalesce(list_contains(numbers, truth), false) AS truth_in_top_k,
  coalesce(match_status, 'NO_RELIABLE_MATCH') AS match_status, coalesce(score, 0) AS match_score, coalesce(gap, 0) AS score_gap, coalesce(name_score, 0) AS name_score, coalesce(street_score, 0) AS street_score, coalesce(house_match, '') AS house_match,
  coalesce(postcode_match, '') AS postcode_match, coalesce(city_score, 0) AS city_score, coalesce(strong, false) AS strong_evidence, coalesce(hard, 0) AS hard_contradiction_count, coalesce(certain_ok, false) AS eligible_certain, coalesce(probable_ok, false) AS eligible_probable
FROM known LEFT JOIN (SELECT *, {_STATUS} AS match_status, {_CERTAIN_OK} AS certain_ok, {_PROBABLE_OK} AS probable_ok FROM top WHERE rank = 1) b USING (source_row_number) LEFT JOIN among USING (source_row_number)""")
def evaluation_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    contacts, registry = D.derived(spark, sf_dir)
    return evaluate.evaluation_rows(evaluate.usable_truth(contacts), registry, MatchConfig())


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
