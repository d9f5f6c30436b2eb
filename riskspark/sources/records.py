"""Fixed-width record files driven by a layout: header, details, trailer.

A layout lists fields as (name, start, end, type) with a 0-based start and an
exclusive end; ``pairs`` adds numbered code/flag fields from a rule. Codes of
a claim beyond one record's pairs go on in further, numbered records.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.operators.windows import number_within

Field = tuple[str, int, int, str]


@dataclass(frozen=True)
class Layout:
    header: Sequence[Field]
    detail: Sequence[Field]
    trailer: Sequence[Field]
    pairs: int  # code/flag pairs of a detail record
    code: str = "diag_code_{:02d}"
    flag: str = "diag_flag_{:02d}"


def pair_fields(start: int, n: int, code_width: int, flag_width: int = 1,
                code: str = "diag_code_{:02d}", flag: str = "diag_flag_{:02d}") -> list[Field]:
    """n code/flag pairs, one after the other from ``start``."""
    out: list[Field] = []
    for i in range(n):
        at = start + i * (code_width + flag_width)
        out += [(code.format(i + 1), at, at + code_width, "string"), (flag.format(i + 1), at + code_width, at + code_width + flag_width, "string")]
    return out


# The MAO-004 encounter file.
MAO_004 = Layout(
    header=[("record_type", 0, 1, "string"), ("report_id", 1, 9, "string"), ("contract_id", 9, 15, "string"),
            ("report_date", 15, 23, "date"), ("report_desc", 23, 33, "string"), ("sub_file_type", 110, 114, "string"),
            ("phase", 114, 116, "string"), ("version", 116, 118, "int")],
    detail=[("record_type", 0, 1, "string"), ("report_id", 1, 9, "string"), ("contract_id", 9, 15, "string"),
            ("mbi", 15, 26, "string"), ("icn", 26, 43, "string"), ("encounter_type", 43, 45, "string"),
            ("encounter_icn", 45, 60, "string"), ("allowed_status", 60, 61, "string"), ("submit_date", 61, 69, "date"),
            ("dos_from", 69, 77, "date"), ("dos_thru", 77, 85, "date"), ("service_type", 85, 87, "string"),
            ("allowed_flag", 87, 88, "string"), ("reason_code", 88, 91, "string"), ("icd_type", 91, 93, "string"),
            *pair_fields(93, 38, 7)],
    trailer=[("record_type", 0, 1, "string"), ("report_id", 1, 9, "string"), ("contract_id", 9, 15, "string"),
             ("n_records", 15, 25, "bigint")],
    pairs=38)


def deal_codes(lines: DataFrame, keys: Sequence[str], code: str, flag: str, order: Sequence[str], layout: Layout,
               placed: Sequence[str] = ()) -> DataFrame:
    """One wide record for every ``layout.pairs`` codes of a key: keys, ``record``
    (from 1) and the pairs. Lines are numbered by ``order`` without gathering a
    key in one task. ``placed``: columns that each key has one value of and that
    an earlier step has gathered the lines by; they are numbered where they are
    then, by a window, and go into records without another shuffle or copy."""
    n = layout.pairs
    rows = lines.select(*dict.fromkeys([*placed, *keys, code, flag, *order]))
    if placed:
        at = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*placed, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])))
    else:
        at = number_within(rows, keys, order, "_n")
    at = at.withColumns({"record": (F.floor((F.col("_n") - 1) / n) + 1).cast("int"), "_pos": ((F.col("_n") - 1) % n).cast("int")})
    wide = at.groupBy(*placed, *keys, "record").agg(
        F.sort_array(F.collect_list(F.struct("_pos", F.col(code).alias("code"), F.col(flag).alias("flag")))).alias("_pairs"))
    return wide.withColumns({f.format(i + 1): F.get(F.col("_pairs"), F.lit(i))[c]
                             for i in range(n) for f, c in ((layout.code, "code"), (layout.flag, "flag"))}).drop("_pairs", *placed)


#: Needs no native library; the reader knows it by the files' names.
CODEC = "gzip"

#: Fields that a line leaves blank together, with one look, where none has a value.
RUN = 16


def _line(fields: Sequence[Field], values: Mapping[str, Column]) -> Column:
    """The fields at their places; a value that is too long for its field is an error, never cut."""
    runs, at = [], 0
    ordered = sorted(fields, key=lambda f: f[1])
    for first in range(0, len(ordered), RUN):
        parts, empty, begin = [], [], at
        for name, start, end, typ in ordered[first:first + RUN]:
            if start > at:
                parts.append(F.lit(" " * (start - at)))
            if name in values:
                v = values[name]
                text = F.coalesce(F.date_format(v, "yyyyMMdd") if typ == "date" else v.cast("string"), F.lit(""))
                too_long = F.raise_error(F.concat(F.lit(f"{name} has {end - start} characters, not: "), text)).cast("string")
                parts.append(F.when(F.length(text) > end - start, too_long).otherwise(F.rpad(text, end - start, " ")))
                empty.append(v.isNull())
            else:
                parts.append(F.lit(" " * (end - start)))
            at = end
        blank = F.lit(" " * (at - begin))
        runs.append(F.when(reduce(lambda a, b: a & b, empty), blank).otherwise(F.concat(*parts)) if empty else blank)
    return F.concat(*runs)


def _sliced(fields: Sequence[Field]) -> list[Column]:
    """Fields past ``_end``, the last place of the line that is not blank, are null without a look at their places."""
    out = []
    for name, start, end, typ in fields:
        raw = F.trim(F.substring("value", start + 1, end - start))
        if typ == "date":
            out.append(F.to_date(raw, "yyyyMMdd").alias(name))
        else:
            out.append(F.when(F.col("_end") > start, F.nullif(raw, F.lit(""))).cast(typ).alias(name))
    return out


def write_records(details: DataFrame, path: str, layout: Layout, common: Mapping[str, Column]) -> None:
    """Header, details and a trailer with their number as text lines under
    ``path``, in compressed files: most of a line is blank. ``common`` has the
    fields that header and trailer share. The details are written first and
    counted from there, so they are computed once. A file is read by one task
    and has one task's details."""
    spark = details.sparkSession
    values = {f[0]: F.col(f[0]) for f in layout.detail if f[0] in details.columns}
    details.select(_line(layout.detail, {**common, **values, "record_type": F.lit("D")}).alias("value")).write.text(path, compression=CODEC)
    n = spark.read.text(path).count()
    ends = spark.range(1).select(F.explode(F.array(
        _line(layout.header, {**common, "record_type": F.lit("H")}),
        _line(layout.trailer, {**common, "record_type": F.lit("T"), "n_records": F.lit(n)}))).alias("value"))
    ends.coalesce(1).write.mode("append").text(path, compression=CODEC)


def read_records(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """The detail records under ``path``, routed by the first character. Fails
    where the trailers' counts are not the number of details, or a line is of no known kind."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    kind = F.substring("value", 1, 1)
    start, end = next((f[1], f[2]) for f in layout.trailer if f[0] == "n_records")
    said = F.trim(F.substring("value", start + 1, end - start)).cast("bigint")
    seen = lines.agg(F.count(F.when(kind == "D", 1)).alias("details"), F.count(F.when(~kind.isin("H", "D", "T"), 1)).alias("unknown"),
                     F.sum(F.when(kind == "T", said)).alias("said")).first()
    if seen["unknown"] or seen["said"] != seen["details"]:
        raise ValueError(f"{path}: trailers say {seen['said']} records, there are {seen['details']}, and {seen['unknown']} lines of no known kind")
    return lines.where(kind == "D").select("value", F.length(F.rtrim("value")).alias("_end")).select(*_sliced(layout.detail))
