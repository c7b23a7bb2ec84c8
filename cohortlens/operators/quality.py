"""Validation, QA and profiling aggregates.

Each is one (or two) aggregation jobs; nothing is collected row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.sources.io import ensure_columns


def validate_diagnoses(dx: DataFrame) -> DataFrame:
    """Row count, nulls and count-order violations of the diagnosis table."""
    return dx.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("primary_diagnosis_icd").isNull()).alias("null_primary"),
        F.count_if(F.col("diagnoses_icd_list").isNull()).alias("null_icd_list"),
        F.count_if(F.col("diagnoses_3digit_list").isNull()).alias("null_group_list"),
        F.count_if(F.col("unique_icd_count") > F.col("diagnosis_count")).alias("count_order_violations"),
        F.count_if(F.size("diagnoses_icd_list") != F.col("unique_icd_count")).alias("list_size_mismatches"))


def validate_treatments(tr: DataFrame) -> DataFrame:
    """Nulls, count relations and ratio range of the treatment table."""
    return tr.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("rx_drug_list").isNull() | F.col("proc_icd_list").isNull()).alias("null_lists"),
        F.count_if(F.col("rx_unique_drugs") > F.col("rx_total_count")).alias("drug_count_violations"),
        F.count_if(F.col("proc_group_count") > F.col("proc_count")).alias("proc_count_violations"),
        F.count_if((F.col("rx_iv_ratio") < 0) | (F.col("rx_iv_ratio") > 1)).alias("ratio_out_of_range"),
        F.count_if((F.col("treatment_complexity_score") < 0) | (F.col("treatment_complexity_score") > 1))
        .alias("score_out_of_range"))


def key_uniqueness(df: DataFrame, key: str = "hadm_id") -> DataFrame:
    """Rows, distinct keys and duplicate rows for a key."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("distinct_keys")).withColumn(
        "duplicate_rows", F.col("row_count") - F.col("distinct_keys"))


def intensity_distribution(tr: DataFrame) -> DataFrame:
    """Admissions per intensity label with mean drugs and procedures."""
    return tr.groupBy("treatment_intensity_label").agg(
        F.count(F.lit(1)).alias("admissions"),
        F.avg("rx_unique_drugs").alias("mean_unique_drugs"),
        F.avg("proc_count").alias("mean_proc_count"))


def distinct_integers(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row: the exact number of distinct non-null integers of a column.

    Ids become bits of bitmaps of 32,768 ids each, combined map-side, so the
    shuffle carries bitmaps and not ids, and no row is expanded."""
    ids = df.select(F.col(column).cast("long").alias("id")).where(F.col("id").isNotNull())
    return (ids.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
            .agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name)))


def treatment_qa(tr: DataFrame) -> DataFrame:
    """Verification row of the treatment table."""
    score, label = F.col("treatment_complexity_score"), F.col("treatment_intensity_label")
    rows = tr.agg(F.count(F.lit(1)).alias("n_rows"), F.min(score).alias("lowest_score"), F.max(score).alias("highest_score"),
                  *[F.count_if(label == x).alias(f"{x.lower()}_rows") for x in ("High", "Medium", "Low")])
    # Single rows.
    return rows.crossJoin(distinct_integers(tr, "subject_id", "n_subjects")).crossJoin(distinct_integers(tr, "hadm_id", "n_admissions"))


def diagnosis_qa(dx: DataFrame) -> DataFrame:
    """Verification row of the diagnosis table."""
    return dx.agg(F.count(F.lit(1)).alias("n_rows"), F.avg("diagnosis_count").alias("mean_codes"),
                  F.count_if(F.col("primary_diagnosis_icd").isNull()).alias("without_primary"))


def table_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column with type, null count and exact distinct count.

    Each (column, value) is counted first, with map-side combine; the values
    then only need to be counted per column, so no row is expanded once for
    every distinct count of one aggregate."""
    cols = columns or df.columns
    ensure_columns(df, cols)
    types = dict(df.dtypes)
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                                       F.col(c).cast("string").alias("v")) for c in cols]))
    values = df.select(one.alias("p")).select("p.*").groupBy("column_name", "data_type", "v").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column_name", "data_type").agg(
        F.sum("n").alias("row_count"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("v").alias("distinct_count")).select("row_count", "column_name", "data_type", "null_count", "distinct_count")


def id_columns(df: DataFrame) -> list[str]:
    """Columns whose name ends in ``id``."""
    return [c for c in df.columns if c.lower().endswith("id")]


def row_sample(df: DataFrame, n: int = 25) -> DataFrame:
    """The first n rows in order of the id columns (of all columns
    where there is none), so that the sample is the same every time; a bounded
    top n of each task, not a sort."""
    order = id_columns(df) or df.columns
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(int(n))


def top_items(events: DataFrame, dictionary: DataFrame, n: int = 50) -> DataFrame:
    """A28 + J17: top n items by distinct patients (ties by item id), over the
    events that have an item and a result.

    Events are counted for each item and patient first, with map-side combine,
    so that distinct patients are a plain count and no row is expanded; the
    dictionary join runs after the top n, so its build side is at most n rows."""
    seen = events.where(F.col("itemid").isNotNull() & F.col("valuenum").isNotNull()).groupBy("itemid", "subject_id").agg(
        F.count(F.lit(1)).alias("n"))
    agg = seen.groupBy("itemid").agg(F.sum("n").alias("event_count"), F.count("subject_id").alias("patient_count"),
                                     F.sum("n").alias("numeric_count"))
    top = agg.orderBy(F.col("patient_count").desc(), F.col("itemid").asc()).limit(int(n))
    d = dictionary.select("itemid", "label", "fluid", "category")
    return d.join(F.broadcast(top), "itemid").select("itemid", "label", "fluid", "category", "event_count",
                                                    "patient_count", "numeric_count")


def nan_check(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count of null or NaN values per numeric feature column (one row)."""
    return df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c))).alias(f"{c}_missing") for c in columns])
