"""Report extracts: delimited, fixed-width and per-district files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import apply_value_format
from ..functions.numbers import to_number
from ..operators.predicates import sheet_rows, text_of
from .delimited import column_type
from .lines import add_import_order

_FORMATS = {"csv": ",", "tab": "\t"}
_EXTENSIONS = {".csv": "csv", ".tsv": "tab", ".tab": "tab", ".txt": "dlm"}


def export_delimited(df: DataFrame, path: str, dbms: str | None = None, delimiter: str | None = None,
                     columns: Sequence[str] | None = None, where: Column | str | None = None,
                     orderby: Sequence | None = None, replace: bool = True) -> int:
    """Write a delimited file with a header; returns the number of rows.

    The format follows the extension unless ``dbms`` (csv, tab, dlm) is given.
    The count comes from the write itself, not from a second pass.
    """
    if dbms is None:
        dbms = next((v for k, v in _EXTENSIONS.items() if path.lower().endswith(k)), None)
    if dbms not in ("csv", "tab", "dlm"):
        raise ValueError(f"cannot tell the format of {path!r}: give dbms csv, tab or dlm")
    if delimiter is not None and dbms != "dlm":
        raise ValueError("a delimiter goes with dbms='dlm' only")
    out = df
    if where is not None:
        out = out.where(where)
    if orderby:
        out = out.orderBy(*orderby)
    if columns:
        out = out.select(*columns)
    from pyspark.sql import Observation

    watch = Observation()
    out = out.observe(watch, F.count(F.lit(1)).alias("rows"))
    separator = _FORMATS.get(dbms, delimiter or " ")
    mode = "overwrite" if replace else "errorifexists"
    out.write.mode(mode).csv(path, sep=separator, header=True, emptyValue="")
    return int(watch.get["rows"])


def _fixed_layout(layout) -> list[dict]:
    rows = []
    for row in sheet_rows(layout):
        start, end, length = (int(float(row[k])) for k in ("start", "end", "length"))
        if length != end - start + 1:
            raise ValueError(f"length of {row.get('name')} is not end - start + 1")
        rows.append({"start": start, "length": length, "name": text_of(row["name"]), "type": text_of(row.get("type")).lower()})
    rows.sort(key=lambda r: r["start"])
    at = 1
    for r in rows:
        if r["start"] < at:
            raise ValueError(f"field {r['name']} overlaps the one before")
        at = r["start"] + r["length"]
    return rows


def fixed_width_line(layout, zero_padded: Sequence[str] = ()) -> Column:
    """One text line per row: alpha fields left, all others right-justified.

    Values are cut to their width; ``filler`` and gaps are blanks.  Columns
    named in ``zero_padded`` are whole numbers padded with zeros, missing as
    a right-aligned period.
    """
    padded = {c.lower() for c in zero_padded}
    parts, at = [], 1
    for r in _fixed_layout(layout):
        if r["start"] > at:
            parts.append(F.lit(" " * (r["start"] - at)))
        width = r["length"]
        if r["name"].lower() == "filler":
            parts.append(F.lit(" " * width))
        elif r["name"].lower() in padded:
            whole = to_number(r["name"]).try_cast("bigint").cast("string")
            parts.append(F.coalesce(F.lpad(whole, width, "0"), F.lpad(F.lit("."), width, " ")))
        else:
            text = F.substring(F.coalesce(F.col(r["name"]).cast("string"), F.lit("")), 1, width)
            parts.append(F.rpad(text, width, " ") if r["type"].startswith("alpha") else F.lpad(text, width, " "))
        at = r["start"] + width
    return F.concat(*parts)


def export_fixed_width(df: DataFrame, path: str, layout, orderby: Sequence | None = None,
                       zero_padded: Sequence[str] = (), mode: str = "overwrite") -> None:
    out = df.orderBy(*orderby) if orderby else df
    out.select(fixed_width_line(layout, zero_padded).alias("value")).write.mode(mode).text(path)


def _extract_fields(layout) -> list[dict]:
    rows = [{
        "variable": text_of(r["variable"]), "kind": text_of(r["value type"]).lower(),
        "start": int(float(r["start"])), "length": int(float(r["length"])), "format": text_of(r.get("out format")),
        "column": text_of(r.get("column name") or r["variable"]),
    } for r in sheet_rows(layout)]
    return sorted(rows, key=lambda r: r["start"])


def _extract_cell(r: dict, zero_fill: Sequence[str]) -> Column:
    width = r["length"]
    if r["kind"] != "variable":
        return F.rpad(F.substring(F.lit(r["variable"].replace("'", "")), 1, width), width, " ")
    value = F.coalesce(F.col(r["variable"]).cast("string"), F.lit(""))
    if r["format"] and "$" not in r["format"]:
        value = apply_value_format(value, r["format"].rstrip("."))
    text = F.substring(value, 1, width)
    if r["variable"].lower() in {z.lower() for z in zero_fill}:
        return F.when(value != "", F.lpad(text, width, "0")).otherwise(F.lit(" " * width))
    return F.rpad(text, width, " ")


def extract_line(layout, zero_fill: Sequence[str] = ("dasites",), skip: int = 0) -> Column:
    """Extract line: constants and formatted variables at their start places.

    ``skip`` leaves out the first fields, as the whole-state file does.
    """
    parts, at = [], 1
    for r in _extract_fields(layout)[skip:]:
        if r["start"] > at:
            parts.append(F.lit(" " * (r["start"] - at)))
            at = r["start"]
        parts.append(_extract_cell(r, zero_fill))
        at += r["length"]
    return F.concat(*parts)


def export_partitioned(df: DataFrame, folder: str, layout, key: str, order: Sequence, skip_state: int = 4,
                       zero_fill: Sequence[str] = ("dasites",), state: DataFrame | None = None,
                       max_records_per_file: int = 0) -> dict[str, str]:
    """Text and csv files per district, and one sorted whole-state file.

    Rows are range-partitioned by (key, order), so a district's files hold
    its rows in order and a very large district is spread over several tasks
    and files.  Returns the three folders.
    """
    order = list(order)
    fields = _extract_fields(layout)
    paths = {n: f"{folder.rstrip('/')}/{n}" for n in ("text", "csv", "state")}
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = df.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
    writer = lambda frame: frame.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).partitionBy("_key")
    text = sorted_rows.select(F.col(key).alias("_key"), extract_line(layout, zero_fill).alias("value"))
    writer(text).text(paths["text"])
    names: dict[str, Column] = {}
    for r in fields:  # neighbouring fields of one csv column are joined
        cell = _extract_cell(r, zero_fill)
        names[r["column"]] = F.concat(names[r["column"]], cell) if r["column"] in names else cell
    cells = sorted_rows.select(F.col(key).alias("_key"), *[c.alias(n.upper()) for n, c in names.items()])
    writer(cells).csv(paths["csv"], header=True, quoteAll=True)
    whole = (df if state is None else state).orderBy(key, *order)
    whole.select(extract_line(layout, zero_fill, skip_state).alias("value")).write.mode("overwrite").text(paths["state"])
    return paths


def copy_dataset(df: DataFrame, rename: Mapping[str, str] | None = None, id_name: str | None = None,
                 types: Mapping[str, str] | None = None, order: Sequence | None = None) -> DataFrame:
    """Copy with a rename map, or an added 1-based id, and type overrides."""
    if rename and id_name:
        raise ValueError("a rename map and an id column exclude each other")
    known = {c.lower() for c in df.columns}
    unknown = [c for c in (*(rename or {}), *(types or {})) if c.lower() not in known]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    changes = {k.lower(): column_type(v) for k, v in (types or {}).items()}
    out = df.select(*[F.col(c).try_cast(changes[c.lower()]).alias(c) if c.lower() in changes else F.col(c) for c in df.columns])
    if rename:
        out = out.withColumnsRenamed(dict(rename))
    return add_import_order(out, id_name, order) if id_name else out
