"""File and table sources (§2.1) with enforced schemas.

Readers never infer schemas from data (no extra pass over the files): the
schema is declared, strings are cast in one select, and fixed-width records
are sliced with ``substring`` on the text lines.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.joins import broadcast_if_small

TYPE_NAMES = {"string": T.StringType(), "integer": T.IntegerType(), "int": T.IntegerType(),
              "long": T.LongType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(),
              "boolean": T.BooleanType()}


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str, delimiter: str = ",",
             header: bool = True, date_format: str | None = None) -> DataFrame:
    """src_csv / src_pipe_txt: delimited text with an enforced schema."""
    r = spark.read.schema(schema).option("header", header).option("sep", delimiter).option("mode", "FAILFAST")
    if date_format:
        r = r.option("dateFormat", date_format)
    return r.csv(path)


def load_fixed_width(spark: SparkSession, path: str, layout: Sequence[tuple[str, int, int, str]],
                     record_type: str, type_pos: int = 1) -> DataFrame:
    """src_fixed_width: slice lines by (name, start, end, type) — 0-based
    start, exclusive end — keeping only records whose type character (1-based
    position ``type_pos``) equals ``record_type``; ``yyyyMMdd`` dates."""
    lines = spark.read.text(path)
    rec = lines.where(F.substring("value", type_pos, 1) == record_type)
    cols = []
    for name, start, end, typ in layout:
        raw = F.trim(F.substring("value", start + 1, end - start))
        if typ == "date":
            cols.append(F.to_date(raw, "yyyyMMdd").alias(name))
        else:
            cols.append(F.when(raw == "", None).otherwise(raw).cast(typ).alias(name))
    return rec.select(*cols)


def to_fixed_width(df: DataFrame, layout: Sequence[tuple[str, int, int, str]], record_type: str) -> DataFrame:
    """The inverse: one text line per row, fields padded to their widths."""
    parts = [F.lit(record_type)]
    pos = 1
    for name, start, end, typ in layout:
        if start > pos:
            parts.append(F.lit(" " * (start - pos)))
        v = F.date_format(name, "yyyyMMdd") if typ == "date" else F.col(name).cast("string")
        parts.append(F.rpad(F.coalesce(v, F.lit("")), end - start, " "))
        pos = end
    return df.select(F.concat(*parts).alias("value"))


def read_table(spark: SparkSession, path: str, columns: Sequence[str], filters: Sequence[str] = (),
               mandatory: bool = False) -> DataFrame:
    """src_table: read, check the columns exist, select, AND-fold the filters;
    a mandatory table that is empty fails (a ``limit 1`` probe)."""
    df = spark.read.parquet(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing} in {path}")
    out = df.select(*columns)
    if filters:
        out = out.where(reduce(lambda a, b: a & b, [F.expr(f) for f in filters]))
    if mandatory and out.isEmpty():
        raise ValueError(f"mandatory table {path} is empty")
    return out


def align_reference(df: DataFrame, target: T.StructType, not_null: Sequence[str] = ()) -> DataFrame:
    """src_ref_csv: case-insensitive column match, fail on missing, ignore
    extras, cast to the target types in target order; NOT NULL columns fail
    the job when null (lazily, no extra action)."""
    by_lower = {c.lower(): c for c in df.columns}
    missing = [f.name for f in target.fields if f.name.lower() not in by_lower]
    if missing:
        raise ValueError(f"reference file misses columns {missing}")
    cols = []
    for f in target.fields:
        c = F.col(by_lower[f.name.lower()]).cast(f.dataType)
        if f.name in not_null:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"null in NOT NULL column {f.name}")).cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def schema_from_mapping(spec: Mapping[str, str] | str) -> T.StructType:
    """src_schema_yaml: ``{field: type}`` (or ``field: type`` lines) →
    StructType; unknown types become string."""
    if isinstance(spec, str):
        items = []
        for line in spec.splitlines():
            line = line.split("#", 1)[0].strip()
            if ":" in line:
                k, v = line.split(":", 1)
                items.append((k.strip(), v.strip().lower()))
        spec = dict(items)
    return T.StructType([T.StructField(k, TYPE_NAMES.get(v, T.StringType())) for k, v in spec.items()])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """src_shared_rename."""
    return df.withColumnsRenamed(dict(mapping))


def parse_list(text: str | None) -> list[str]:
    """Comma list text → trimmed, non-empty items (config, driver side)."""
    return [x.strip() for x in (text or "").split(",") if x.strip()]


def union_claims(frames: Sequence[DataFrame], standard: Mapping[str, str]) -> DataFrame:
    """src_claims_base: ``unionByName(allowMissingColumns)`` then the missing
    standard columns typed as null."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return u.withColumns({c: F.lit(None).cast(t) for c, t in standard.items() if c not in u.columns})


def latest_slice(df: DataFrame, month_col: str, cycle_col: str, version_col: str) -> DataFrame:
    """src_latest_slice: latest month, then latest cycle per model version.
    Both maxima are small aggregates (one row; one row per version) joined
    back by broadcast — no whole-table window, no driver round trip."""
    mm = df.agg(F.max(month_col).alias(month_col))
    m = df.join(broadcast_if_small(mm), month_col)
    mc = m.groupBy(version_col).agg(F.max(cycle_col).alias(cycle_col))
    return m.join(broadcast_if_small(mc), [version_col, cycle_col])
