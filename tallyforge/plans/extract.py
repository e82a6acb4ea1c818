"""Rows of the downloadable district files."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import blank
from ..functions.text import to_proper_case
from ..operators.merge import join_parts
from ..session import maybe_broadcast

OWN_DISTRICT_TYPES = ("J", "D", "Y")


class ExtractRows(NamedTuple):
    district: DataFrame
    state: DataFrame


def extract_rows(parts: Sequence[DataFrame], sites: DataFrame, key: str = "lithocode",
                 excluded_school: str = "000001", id_pattern: str = r"^[0-9A-Z]{8}.$", roman_limit: int = 14) -> ExtractRows:
    """Cleaned student rows for the extracts.

    District rows hold each student once under the own district, again under
    the home district, and again under the school for special schools; all
    copies are made in one pass over the rows.  ``sites`` maps dcrxid to
    dasites.
    """
    rows = join_parts(parts, key)
    names = [c for c in ("dcrxnm_attend", "bcrxnm_attend", "dcrxnm_home", "ucrxlnm", "ucrxfnm") if c in rows.columns]
    clean = {
        "ssid": F.when(F.col("ssid").rlike(id_pattern), F.col("ssid")).otherwise(F.lit("")),
        "dcrxid_home": F.when(F.trim("dcrxid_home") == ".", F.lit(" ")).otherwise(F.col("dcrxid_home")),
        "dcrxid": F.col("dcrxid_attend"),
    }
    for column, old, new in (("ucsx_classname", "[", "("), ("ucrxlnm", "`", "'"), ("ucrxfnm", "`", "'"),
                             ("ucxx_room_number", "?", ""), ("ucmx_coursecode", "`", "")):
        if column in rows.columns:
            clean[column] = F.replace(F.col(column), F.lit(old), F.lit(new))
    base = rows.where(F.coalesce(F.col("bcrxid_attend") != excluded_school, F.lit(True))).withColumns(clean)
    base = base.withColumns({c: to_proper_case(c, roman_limit) for c in names})
    special = F.col("schtype").isin(list(OWN_DISTRICT_TYPES))
    home_copy = ((F.col("schtype") == "J") & ~blank("dcrxid_home")) | (
        ~special & F.col("dcrxid_home").isNotNull() & ~blank("dcrxid"))
    copies = F.filter(F.array(
        F.when(F.coalesce(special, F.lit(False)), F.struct(F.col("bcrxid_attend").alias("d"))),
        F.when(F.coalesce(home_copy, F.lit(False)), F.struct(F.col("dcrxid_home").alias("d"))),
        F.struct(F.col("dcrxid").alias("d"))), lambda x: x.isNotNull())
    stacked = base.withColumn("_copy", F.explode(copies)).withColumn("dcrxid", F.col("_copy.d")).drop("_copy")
    lookup = maybe_broadcast(sites.where(~blank("dcrxid")).select("dcrxid", "dasites"))
    return ExtractRows(stacked.join(lookup, "dcrxid", "left"), base.join(lookup, "dcrxid", "left"))
