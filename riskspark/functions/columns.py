"""Reusable column expressions.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen and is pushed through Catalyst like any other
expression.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "cc_code", "normalize_cc_code", "hcc_detail_id", "age_as_of",
    "payment_year_reference_date", "age_at_service", "noisy_or", "and_all",
    "first_match", "rule_fold", "hcc_coeff_name", "count_coeff_name",
    "demog_coeff_name", "origds_coeff_name", "sorted_distinct", "split_codes",
    "icd_parts", "claim_type_label",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cc_code(n) -> Column:
    """Condition-category code ``CC`` + 3-digit zero-padded number."""
    return F.concat(F.lit("CC"), F.lpad(col_of(n).cast("int").cast("string"), 3, "0"))


def normalize_cc_code(c) -> Column:
    """``CC17`` / ``17`` / ``HCC017`` / ``CC017`` → ``CC017``; letters-only codes kept."""
    digits = F.regexp_extract(col_of(c), r"(\d+)$", 1)
    return F.when(digits == "", col_of(c)).otherwise(
        F.concat(F.lit("CC"), F.lpad(digits.cast("int").cast("string"), 3, "0")))


def hcc_detail_id(c) -> Column:
    """``H`` + padded CC code, e.g. ``HCC017``."""
    return F.concat(F.lit("H"), normalize_cc_code(c))


def age_as_of(dob, ref) -> Column:
    """Whole years between birth and the reference date."""
    return F.floor(F.months_between(col_of(ref), col_of(dob)) / 12).cast("int")


def payment_year_reference_date(period_type, begin, end) -> Column:
    """Feb 1 of the payment year: begin year + 1 (calendar), end year + 1 (fiscal)."""
    y = F.when(col_of(period_type) == "F", F.year(col_of(end))).otherwise(F.year(col_of(begin)))
    return F.make_date(y + 1, F.lit(2), F.lit(1))


def age_at_service(dob, service_dt) -> Column:
    return (F.datediff(col_of(service_dt), col_of(dob)) / 365.25).cast("int")


def noisy_or(values: Column) -> Column:
    """1 − Π(1 − c) over an array of confidences; nulls are ignored, the empty
    product is 1, so an all-null group gives 0.0."""
    return F.lit(1.0) - F.aggregate(
        F.filter(values, lambda x: x.isNotNull()), F.lit(1.0).cast("double"),
        lambda acc, x: acc * (F.lit(1.0) - x))


def and_all(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def first_match(rules: Sequence[tuple[str, object]], default) -> Column:
    """First SQL condition (by list order) that holds → its value, else default."""
    return F.coalesce(*[F.when(F.expr(cond), F.lit(val)) for cond, val in rules], F.lit(default))


def rule_fold(base: Column, rules: Sequence[tuple[Column, object]]) -> Column:
    """Apply ``when(cond, value).otherwise(current)`` in order; later rules win."""
    return reduce(lambda acc, r: F.when(r[0], F.lit(r[1])).otherwise(acc), rules, base)


def hcc_coeff_name(segment, hcc) -> Column:
    """``{segment}_HCC{n}`` with n unpadded; letters-only codes as ``{segment}_{code}``."""
    h = col_of(hcc).cast("string")
    digits = F.regexp_extract(h, r"(\d+)$", 1)
    return F.when(digits == "", F.concat_ws("_", col_of(segment), h)).otherwise(
        F.concat(col_of(segment), F.lit("_HCC"), digits.cast("int").cast("string")))


def count_coeff_name(segment, n) -> Column:
    """``{segment}_D{n}``, ``{segment}_D10P`` for n >= 10."""
    return F.concat(col_of(segment), F.lit("_D"),
                    F.when(col_of(n) >= 10, F.lit("10P")).otherwise(col_of(n).cast("string")))


def demog_coeff_name(segment, gender, age) -> Column:
    """``{segment}_{gender}{age}``; new-enrollee segments (``NE``…) have no underscore."""
    seg = col_of(segment)
    tail = F.concat(col_of(gender), col_of(age).cast("string"))
    return F.when(seg.startswith("NE") | seg.startswith("SNPNE"), F.concat(seg, tail)) \
        .otherwise(F.concat(seg, F.lit("_"), tail))


def origds_coeff_name(segment, gender) -> Column:
    return F.concat(col_of(segment), F.lit("_OriginallyDisabled_"),
                    F.when(col_of(gender) == "F", "Female").otherwise("Male"))


def sorted_distinct(arr) -> Column:
    return F.array_sort(F.array_distinct(col_of(arr)))


def split_codes(text) -> Column:
    """Comma list text → array of trimmed, non-empty items."""
    return F.filter(F.transform(F.split(col_of(text), ","), lambda x: F.trim(x)), lambda x: x != "")


def icd_parts(code) -> dict[str, Column]:
    c = col_of(code)
    return {
        "code_length": F.length(F.regexp_replace(c, r"\.", "")),
        "category3": F.substring(F.regexp_replace(c, r"\.", ""), 1, 3),
        "has_dot": c.contains("."),
    }


def claim_type_label(tp) -> Column:
    t = col_of(tp).cast("int")
    return (F.when(t == 1, "facility-inpatient").when(t == 2, "facility-outpatient")
            .when(t == 3, "professional").when(t == 4, "pharmacy"))
