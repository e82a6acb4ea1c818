"""Teacher and class ids."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import clean_label
from ..operators.skew import number_rows

NO_TEACHER = "NO NAME"
NO_CLASS = "CLASS ASSIGNMENT UNKNOWN"


def generate_ids(df: DataFrame, subjects: Mapping[str, tuple[str, str, str]], test_date: str, grade: str = "grade",
                 district: str = "dcrxid_attend", school: str = "bcrxid_attend", prefix: str = "ID",
                 tokens: tuple[str, str] = ("T", "C"),
                 names: Mapping[str, tuple[str, str, str, str]] | None = None) -> DataFrame:
    """Add teacher and class labels and ids per subject.

    ``subjects`` maps a subject letter to its (teacher, class, section)
    columns; ``names`` to the output columns (teacher label, teacher id,
    class label, class id).  Ids number the distinct keys in sorted order over
    all subjects: ``<prefix><date><token><grade:2><n:7>`` for teachers and
    ``<prefix><date><token><subject><grade:2><n:6>`` for classes, with
    ``tokens`` (teachers, classes) as a report's readers expect them.  Keys without
    a teacher (or without any class part) get a label but no id, and do not
    take part in the numbering.
    """
    names = dict(names or {s: (f"{s}label", f"{s}teacher_id", f"i{s}xnm", f"{s}class_id") for s in subjects})
    place = [F.col(grade).cast("int").alias("g"), F.coalesce(F.col(district).cast("string"), F.lit("")).alias("d"),
             F.coalesce(F.col(school).cast("string"), F.lit("")).alias("b")]
    cells = F.array(*[
        F.struct(F.lit(s).alias("s"), clean_label(t).alias("t"), clean_label(c).alias("c"), clean_label(n).alias("n"))
        for s, (t, c, n) in subjects.items()])
    keys = df.select(*place, F.inline(cells)).distinct()
    teacher_key = ["g", "d", "b", "t"]
    teachers = number_rows(keys.where(F.col("t") != "").select(*teacher_key).distinct(), [], [F.col(k) for k in teacher_key], "i")
    teachers = teachers.withColumn("tid", F.format_string(prefix + test_date + tokens[0] + "%02d%07d", "g", "i")).drop("i")
    class_key = ["g", "d", "b", "t", "c", "n", "s"]
    has_part = (F.col("t") != "") | (F.col("c") != "") | (F.col("n") != "")
    classes = number_rows(keys.where(has_part), [], [F.col(k) for k in class_key], "i")
    classes = classes.withColumn("cid", F.format_string(prefix + test_date + tokens[1] + "%s%02d%06d", "s", "g", "i")).drop("i")
    out = df
    for s, (t, c, n) in subjects.items():
        label, teacher_id, class_label, class_id = names[s]
        tagged = out.withColumns({
            "_g": F.col(grade).cast("int"), "_d": F.coalesce(F.col(district).cast("string"), F.lit("")),
            "_b": F.coalesce(F.col(school).cast("string"), F.lit("")), "_t": clean_label(t), "_c": clean_label(c),
            "_n": clean_label(n)})
        mine = teachers.select(*[F.col(k).alias(f"_{k}") for k in teacher_key], F.col("tid").alias(teacher_id))
        own = classes.where(F.col("s") == s).select(
            *[F.col(k).alias(f"_{k}") for k in class_key if k != "s"], F.col("cid").alias(class_id))
        joined = tagged.join(mine, [f"_{k}" for k in teacher_key], "left")
        joined = joined.join(own, [f"_{k}" for k in class_key if k != "s"], "left")
        teacher_text = F.when(F.col("_t") != "", F.col("_t")).otherwise(NO_TEACHER)
        parts = F.concat_ws(" - ", teacher_text, F.nullif("_c", F.lit("")), F.nullif("_n", F.lit("")))
        any_part = reduce(lambda a, b: a | b, [F.col(k) != "" for k in ("_t", "_c", "_n")])
        out = joined.select(
            *out.columns, teacher_text.alias(label), teacher_id, F.when(any_part, parts).otherwise(NO_CLASS).alias(class_label),
            class_id)
    return out

