"""Registration, table access and derived inputs of the queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def derived(self, table: str, columns: dict[str, str]) -> DataFrame:
        return getattr(self, table).selectExpr(*[f"{e} AS `{n}`" for n, e in columns.items()])

    def scratch(self) -> str:
        """A new folder next to the checkpoints, which all executors share."""
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/files-{uuid.uuid4().hex}"


def derived_sql(table: str, columns: dict[str, str]) -> str:
    """The same derived input for the SQL side."""
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {table}"


def query(name: str, sql: str | None = None):
    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, whole numbers as BIGINT, so both engines agree."""
    columns: list[Column] = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        if kind in ("double", "float"):
            columns.append((F.round(c.cast("double"), digits) + F.lit(0.0)).alias(f.name))
        elif kind in ("int", "smallint", "tinyint", "bigint"):
            columns.append(c.cast("bigint").alias(f.name))
        else:
            columns.append(c)
    return df.select(*columns)


# ------------------------------------------------------------ derived inputs

SUBJECTS = ("r", "m", "w", "s", "c")
STRANDS = {"r": ("a", "l", "x"), "m": ("n", "x")}


def _students() -> dict[str, str]:
    k = "c_custkey"
    columns = {
        "id": k, "lithocode": f"lpad(cast({k} AS STRING), 8, '0')",
        "ssid": f"CASE WHEN {k} % 17 = 0 THEN '' ELSE concat('SS', lpad(cast({k} AS STRING), 7, '0')) END",
        "grade": f"CASE WHEN {k} % 11 = 0 THEN '' WHEN {k} % 3 = 0 THEN '10.0' ELSE '11' END",
        "ucrxfnm": f"CASE WHEN {k} % 13 = 0 THEN 'ann  lee' ELSE lower(c_mktsegment) END",
        "studentmid": f"CASE WHEN {k} % 4 = 0 THEN '' ELSE 'q' END",
        "ucrxlnm": "concat('mc', lower(c_mktsegment))",
        "ucrxgen": f"CASE {k} % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '*' ELSE '1.0' END",
        "ethnicity": f"cast({k} % 9 AS STRING)", "migrant": f"cast({k} % 2 AS STRING)",
        "dob_month": f"cast({k} % 14 AS STRING)", "dob_day": f"cast({k} % 33 AS STRING)",
        "dob_year": f"CASE WHEN {k} % 19 = 0 THEN '' ELSE cast(1990 + {k} % 10 AS STRING) END",
        "schtype_attend": f"CASE {k} % 7 WHEN 0 THEN 'H' WHEN 1 THEN 'N' WHEN 2 THEN 'D' WHEN 3 THEN 'J' WHEN 4 THEN 'C' WHEN 5 THEN 'Y' ELSE 'P' END",
        "distrtype_attend": f"CASE WHEN {k} % 5 = 0 THEN 'J' ELSE 'P' END",
        "distrtype_home": f"CASE WHEN {k} % 2 = 0 THEN 'N' ELSE 'P' END",
        "dcrxid_attend": "lpad(cast(c_nationkey AS STRING), 6, '0')",
        "dcrxnm_attend": "concat('district ', cast(c_nationkey AS STRING))",
        "bcrxid_attend": f"lpad(cast({k} % 120 AS STRING), 6, '0')",
        "bcrxnm_attend": f"concat('school ', cast({k} % 120 AS STRING))",
        "dcrxid_home": f"CASE WHEN {k} % 6 = 0 THEN lpad(cast({k} % 25 AS STRING), 6, '0') ELSE '' END",
        "dcrxnm_home": f"CASE WHEN {k} % 6 = 0 THEN concat('district ', cast({k} % 25 AS STRING)) ELSE '' END",
        "bcrxid_home": f"CASE WHEN {k} % 6 = 0 THEN lpad(cast({k} % 120 AS STRING), 6, '0') ELSE '' END",
        "bcrxnm_home": f"CASE WHEN {k} % 6 = 0 THEN concat('school ', cast({k} % 120 AS STRING)) ELSE '' END",
        "dcxx_county": f"concat('county ', cast({k} % 8 AS STRING))",
        "upxxlep": f"CASE WHEN {k} % 5 = 0 THEN '1' ELSE '0' END", "upxxiep": f"CASE WHEN {k} % 8 = 0 THEN '1' ELSE '0' END",
        "preidflag": f"CASE WHEN {k} % 3 = 0 THEN 1 ELSE 0 END", "score": "c_acctbal",
    }
    for i, s in enumerate(SUBJECTS, start=1):
        columns[f"uf{s}x_attempt"] = f"CASE WHEN ({k} + {i}) % 4 = 0 OR {k} % 23 = 0 THEN '0' ELSE '1' END"
        columns[f"uf{s}x_invalid"] = f"CASE WHEN ({k} + {i}) % 9 = 0 THEN '1' ELSE '0' END"
        columns[f"up{s}xlev"] = f"CASE WHEN ({k} + {i}) % 6 = 0 THEN '' ELSE cast(({k} + {i}) % 6 AS STRING) END"
        columns[f"up{s}xraw"] = f"cast(({k} * {i}) % 40 AS STRING)"
        columns[f"uc{s}x_form"] = f"CASE WHEN ({k} + {i}) % 10 = 0 THEN 'BR' ELSE 'SP' END"
        for j, a in enumerate(("read_aloud", "extended", "dictionary", "scribe", "other")):
            columns[f"up{s}x_{a}"] = f"CASE WHEN ({k} + {i}) % {11 + j} = 0 THEN '1' ELSE '0' END"
        for j, strand in enumerate(STRANDS.get(s, ())):
            if strand != "x":
                columns[f"up{s}{strand}lev"] = f"CASE WHEN ({k} + {j}) % 5 = 0 THEN '' ELSE cast(({k} + {j}) % 4 AS STRING) END"
    columns["upwx_oe_final_1"] = f"cast({k} % 7 AS STRING)"
    columns["upwx_oe_final_4"] = f"cast({k} % 5 AS STRING)"
    return columns


STUDENTS = _students()

# A school list made of the suppliers: one school each, in its nation.
MASTER = {
    "bcrxid_c": "lpad(cast(s_suppkey AS STRING), 6, '0')",
    "bcrxnm": "CASE WHEN s_suppkey % 3 = 0 THEN concat('school ', cast(s_suppkey AS STRING)) ELSE s_name END",
    "dcrxid_c": "lpad(cast(s_nationkey AS STRING), 6, '0')",
    "dcrxnm": "concat('District ', cast(s_nationkey AS STRING))",
    "schtype": "CASE WHEN s_suppkey % 4 = 0 THEN 'D' WHEN s_suppkey % 4 = 1 THEN 'J' ELSE 'P' END",
    "distrtype": "CASE WHEN s_nationkey % 2 = 0 THEN 'J' ELSE 'P' END",
    "dcxx_county": "CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE concat('county ', cast(s_nationkey AS STRING)) END",
}

# Item answers: order = sheet, line number = item, marks from the prices.
_CENTS = "cast(floor(l_extendedprice * 100 + 0.5) AS BIGINT)"
ITEMS = {
    "flat_table_id": "l_orderkey", "id": "l_linenumber", "line_key": "l_partkey",
    "answer": f"CASE {_CENTS} % 7 WHEN 0 THEN '*' WHEN 1 THEN '-' WHEN 2 THEN '' ELSE cast({_CENTS} % 4 + 1 AS STRING) END",
    "score": f"CASE {_CENTS} % 5 WHEN 0 THEN '1' WHEN 1 THEN 'x' WHEN 2 THEN '' ELSE '0' END",
    "oe_first": f"CASE WHEN {_CENTS} % 31 = 0 THEN 'A' ELSE cast({_CENTS} % 5 AS STRING) END",
    "oe_second": f"cast(cast(floor({_CENTS} / 5) AS BIGINT) % 5 AS STRING)",
    "oe_third": f"CASE WHEN {_CENTS} % 3 = 0 THEN '' ELSE cast(cast(floor({_CENTS} / 25) AS BIGINT) % 5 AS STRING) END",
    "oe_reso": f"cast(cast(floor({_CENTS} / 125) AS BIGINT) % 5 AS STRING)",
    "oe_final": f"CASE {_CENTS} % 6 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN '' ELSE cast({_CENTS} % 5 AS STRING) END",
    "raw_intensity": f"CASE {_CENTS} % 9 WHEN 0 THEN 'F' WHEN 1 THEN 'C' WHEN 2 THEN '-' WHEN 3 THEN 'B' ELSE cast({_CENTS} % 10 AS STRING) END",
    "second_inten": f"CASE cast(floor({_CENTS} / 9) AS BIGINT) % 6 WHEN 0 THEN 'D' WHEN 1 THEN '' WHEN 2 THEN '4' ELSE '9' END",
    "raw_editor": f"cast({_CENTS} % 2 AS STRING)",
    "second_dark": f"cast(cast(floor({_CENTS} / 4) AS BIGINT) % 4 + 1 AS STRING)",
}

# Answer key: one item per line number and form, from the whole part table.
BOOKMAP_SPARK = (
    "SELECT p_size % 7 + 1 AS `item position`, CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS form_values, "
    "max(p_partkey) % 4 + 1 AS `numeric key`, 1 AS `point value`, "
    "CASE WHEN p_size % 7 = 5 THEN 'ER' WHEN p_size % 7 = 6 THEN 'SA' ELSE 'MC' END AS `item format`, "
    "'Operational' AS role, 'm' AS subject_values, '10' AS grade_values FROM part "
    "GROUP BY p_size % 7, p_partkey % 2")
BOOKMAP_SQL = BOOKMAP_SPARK.replace("`", '"')


def bookmap(t: Tables) -> DataFrame:
    return t.spark.sql(BOOKMAP_SPARK.replace("FROM part", "FROM {part}"), part=t.part)


def students(t: Tables) -> DataFrame:
    return t.derived("customer", STUDENTS)


def master(t: Tables) -> DataFrame:
    return t.derived("supplier", MASTER)


STUDENTS_SQL = derived_sql("customer", STUDENTS)
MASTER_SQL = derived_sql("supplier", MASTER)
ITEMS_SQL = derived_sql("lineitem", ITEMS)
