"""Column expressions shared by the operators.

Everything here is a built-in Spark expression (JVM side, whole-stage
codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
# Diagnosis similarity weights: primary 0.40, full code set 0.35, group set 0.25.
DIAGNOSIS_WEIGHTS = {"primary": 0.40, "full_icd": 0.35, "3digit": 0.25}
# Treatment similarity weights: drug 0.40, procedure 0.35, complexity 0.15, duration 0.10.
TREATMENT_WEIGHTS = {"drug": 0.40, "procedure": 0.35, "complexity": 0.15, "duration": 0.10}
# Clinical similarity: diagnosis 0.60, treatment 0.40.
CLINICAL_WEIGHTS = {"diagnosis": 0.60, "treatment": 0.40}
# Retrieval blend of the neighbour-vote classifier.
RETRIEVAL_WEIGHTS = {"diagnosis": 0.35, "diagnosis_group": 0.20, "treatment": 0.25,
                     "primary": 0.10, "context": 0.10}
# Context similarity: 0.30 age (scale 15), 0.20 burden (scale 6),
# 0.20 complexity (scale 0.25), 0.15 gender, 0.15 race.
CONTEXT_WEIGHTS = {"age": (0.30, 15.0), "burden": (0.20, 6.0), "complexity": (0.20, 0.25),
                   "gender": 0.15, "race": 0.15}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_set(c: str | Column) -> Column:
    """Null-safe canonical set: null list to empty, drop null and '' items, distinct, sorted."""
    arr = F.coalesce(col(c), F.array().cast("array<string>"))
    arr = F.filter(arr, lambda x: x.isNotNull() & (F.trim(x) != F.lit("")))
    return F.array_sort(F.array_distinct(arr))


def jaccard(a: str | Column, b: str | Column, both_empty: float = 0.0) -> Column:
    """|A and B| / |A or B|; ``both_empty`` when both are empty, 0 when only one is."""
    a, b = col(a), col(b)
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return (F.when(union == 0, F.lit(float(both_empty)))
            .otherwise(inter.cast("double") / union.cast("double")))


def jaccard_from_counts(inter: Column, size_a: Column, size_b: Column,
                        both_empty: float = 0.0) -> Column:
    """Jaccard from an overlap count, as produced by a token join."""
    union = size_a + size_b - inter
    return (F.when(union == 0, F.lit(float(both_empty)))
            .otherwise(inter.cast("double") / union.cast("double")))


def closeness(a: str | Column, b: str | Column) -> Column:
    """max(0, 1 - |a - b|) for scores in [0, 1]."""
    return F.greatest(F.lit(0.0), 1.0 - F.abs(col(a).cast("double") - col(b).cast("double")))


def duration_closeness(a: str | Column, b: str | Column) -> Column:
    """1 - |a - b| / max(a, b, 1) over whole days, negatives and nulls as 0."""
    da = F.greatest(F.coalesce(col(a).cast("long"), F.lit(0)), F.lit(0))
    db = F.greatest(F.coalesce(col(b).cast("long"), F.lit(0)), F.lit(0))
    m = F.greatest(da, db, F.lit(1))
    return F.greatest(F.lit(0.0), 1.0 - F.abs(da - db).cast("double") / m.cast("double"))


def gaussian(a: str | Column, b: str | Column, scale: float, form: str = "code") -> Column:
    """Numeric closeness, 0.5 when either side is null.

    ``form="code"`` is exp(-(d/s)^2); ``form="documented"`` is exp(-d^2 / (2 s^2)).
    """
    d = col(a).cast("double") - col(b).cast("double")
    if form == "code":
        val = F.exp(-F.pow(d / F.lit(float(scale)), 2))
    else:
        val = F.exp(-F.pow(d, 2) / F.lit(2.0 * scale * scale))
    return F.coalesce(val, F.lit(0.5))


def string_match(a: str | Column, b: str | Column) -> Column:
    """1.0 when a is non-null and equal to b."""
    return F.coalesce((col(a).isNotNull() & (col(a).cast("string") == col(b).cast("string"))).cast("double"),
                      F.lit(0.0))


def context_similarity(q: dict, c: dict) -> Column:
    """Weighted context similarity of two rows given column maps with keys
    age, burden, complexity, gender, race."""
    w = CONTEXT_WEIGHTS
    return (w["age"][0] * gaussian(q["age"], c["age"], w["age"][1])
            + w["burden"][0] * gaussian(q["burden"], c["burden"], w["burden"][1])
            + w["complexity"][0] * gaussian(q["complexity"], c["complexity"], w["complexity"][1])
            + w["gender"] * string_match(q["gender"], c["gender"])
            + w["race"] * string_match(q["race"], c["race"]))


def code_group(version: str | Column, code: str | Column) -> Column:
    """Version-prefixed 3-character group, e.g. ``10_I10``."""
    return F.concat_ws("_", col(version).cast("string"), F.substring(F.trim(col(code)), 1, 3))


def surgery_flag(version: str | Column, code: str | Column) -> Column:
    """v9: first two digits in 1..86; v10: starts with '0'; otherwise false."""
    code_t = F.trim(col(code))
    v = col(version)
    return (F.when(v == 9, F.coalesce(F.substring(code_t, 1, 2).try_cast("int").between(1, 86), F.lit(False)))
            .when(v == 10, F.coalesce(F.substring(code_t, 1, 1) == F.lit("0"), F.lit(False)))
            .otherwise(F.lit(False)))


# Route lists of the prefix flavour.
IV_ROUTES = ["INTRAVENOUS", "IV DRIP", "IVPCA", "IVPB"]
ORAL_ROUTES = ["PO", "PO/NG", "PO NG", "PO-NG", "ORAL", "NG"]


def route_flags_prefix(route: str | Column) -> tuple[Column, Column]:
    """IV and oral flags, prefix + list flavour."""
    r = F.upper(F.trim(F.coalesce(col(route), F.lit(""))))
    iv = (r.like("IV%") | r.isin(IV_ROUTES)).cast("int")
    oral = (r.like("PO%") | r.isin(ORAL_ROUTES)).cast("int")
    return iv, oral


def route_flags_substring(route: str | Column) -> tuple[Column, Column]:
    """IV and oral flags, substring flavour (null route gives no flag)."""
    r = F.upper(col(route))
    iv = F.coalesce(r.like("%IV%"), F.lit(False))
    oral = F.coalesce(r.like("%PO%") | r.like("%ORAL%"), F.lit(False))
    return iv, oral


# Drug noise filters.
NOISE_LIKE_WORDS = ["saline", "dextrose", "flush"]
NOISE_REGEX = r"(?i)(saline|sodium chloride|ns|dextrose|flush|heparin lock|water|diluent)"
NOISE_REGEX_WORD_BOUNDED = r"(?i)\b(saline|sodium chloride|ns|dextrose|flush|heparin lock|water|diluent)\b"


def is_noise_drug_like(drug: str | Column) -> Column:
    d = F.lower(F.trim(col(drug)))
    cond = F.lit(False)
    for w in NOISE_LIKE_WORDS:
        cond = cond | d.like(f"%{w}%")
    return cond


def is_noise_drug_regex(drug: str | Column, word_bounded: bool = False) -> Column:
    return col(drug).rlike(NOISE_REGEX_WORD_BOUNDED if word_bounded else NOISE_REGEX)


# Fixed value: blood-pressure patterns (systolic, diastolic).
BP_SYSTOLIC_PATTERN = r"([0-9]*\.?[0-9]+)"
BP_DIASTOLIC_PATTERN = r"/\s*([0-9]*\.?[0-9]+)"


def bp_parts(text: str | Column) -> tuple[Column, Column]:
    t = col(text)
    sys_ = F.regexp_extract(t, BP_SYSTOLIC_PATTERN, 1).try_cast("double")
    dia = F.regexp_extract(t, BP_DIASTOLIC_PATTERN, 1).try_cast("double")
    return sys_, dia


def intensity_label_bins(score: str | Column, surgery_count: str | Column) -> Column:
    """Label from score + 0.15 surgery bonus (capped at 1), right-closed bins
    (-0.01, 0.33], (0.33, 0.66], (0.66, 1.01]."""
    s = F.least(col(score) + F.when(col(surgery_count) > 0, F.lit(0.15)).otherwise(F.lit(0.0)), F.lit(1.0))
    return (F.when((s > -0.01) & (s <= 0.33), F.lit("Low"))
            .when((s > 0.33) & (s <= 0.66), F.lit("Medium"))
            .when((s > 0.66) & (s <= 1.01), F.lit("High")))


def intensity_label_rule(unique_drugs: str | Column, surgery_count: str | Column,
                         proc_count: str | Column) -> Column:
    d = F.coalesce(col(unique_drugs), F.lit(0))
    s = F.coalesce(col(surgery_count), F.lit(0))
    p = F.coalesce(col(proc_count), F.lit(0))
    return (F.when((d > 15) | (s > 0), F.lit("High"))
            .when((d > 5) | (p > 1), F.lit("Medium"))
            .otherwise(F.lit("Low")))


def complexity_capped(unique_drugs, proc_count, iv_count, treatment_days) -> Column:
    """Cap flavour: caps 15, 5, 10, 14 with weights 0.35, 0.30, 0.20, 0.15, rounded to 3."""
    def term(c, cap):
        return F.least(F.lit(1.0), F.coalesce(col(c), F.lit(0)).cast("double") / F.lit(cap))
    return F.round(term(unique_drugs, 15.0) * 0.35 + term(proc_count, 5.0) * 0.30
                   + term(iv_count, 10.0) * 0.20 + term(treatment_days, 14.0) * 0.15, 3)
