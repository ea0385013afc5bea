"""Contact rows in normal form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.functions import normalize as N


def normalise(df: DataFrame, columns: dict[str, str | None], order: str | None = None) -> DataFrame:
    """One normalised record for each row; explicit columns win over the one-line address, field by field.

    ``order`` names a 0-based row number (``tabular.numbered`` makes one); without it rows get
    increasing numbers with gaps.  ``source_row_number`` counts as a spreadsheet does, the
    header being row 1.
    """
    col = lambda k: N.safe_text(F.col(f"`{columns[k]}`")) if columns.get(k) else F.lit("")
    parsed = N.full_address(col("full_address")) if columns.get("full_address") else {}
    row = F.col(order) if order else F.monotonically_increasing_id()

    def either(k: str):
        return F.when(col(k) != "", col(k)).otherwise(parsed[k]) if k in parsed else col(k)

    raw = df.select(
        (row + 2).alias("source_row_number"), col("source_id").alias("source_id"), N.enterprise_number(col("enterprise_number")).alias("existing_enterprise_number"),
        N.enterprise_number_valid(col("enterprise_number")).alias("existing_enterprise_number_valid"), N.enterprise_number_reason(col("enterprise_number")).alias("existing_enterprise_number_reason"),
        col("company_name").alias("company_name"), *[either(k).alias(k) for k in ("street", "house_number", "box", "postcode", "city")],
    )
    out = raw.withColumns({
        "name_norm": N.company_name(F.col("company_name")), "street_norm": N.basic(F.col("street")), "house_norm": N.house_number(F.col("house_number")),
        "box_norm": N.box(F.col("box")), "postcode_norm": N.postcode(F.col("postcode")), "city_norm": N.basic(F.col("city")),
    })
    out = out.withColumns({
        "name_compact": N.compact(F.col("name_norm")), "anchors": N.name_anchors(F.col("name_norm")), "search": N.search_tokens(F.col("name_norm")),
        "street_core": N.street_core(F.col("street_norm")), "house_base": N.house_base(F.col("house_norm")),
    })
    filled = [F.when(F.col(c) != "", 1).otherwise(0) for c in ("name_norm", "street_norm", "house_norm", "postcode_norm", "city_norm")]
    return out.withColumns({"street_anchor": N.street_anchor(F.col("street_core")), "evidence_fields": sum(filled[1:], filled[0])})
