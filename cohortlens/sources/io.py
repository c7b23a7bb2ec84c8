"""Sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortlens.sources.schemas import RAW_SCHEMAS


def ensure_columns(df: DataFrame, required: list[str], optional: list[str] | None = None) -> list[str]:
    """S3: raise when a required column is missing; return required plus the
    optional columns that are present."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return list(required) + [c for c in (optional or []) if c in df.columns]


def read_columns(spark: SparkSession, path: str, required: list[str],
                 optional: list[str] | None = None) -> DataFrame:
    """S2 + S3: column-list scan of a Parquet feature table (pruned at the scan)."""
    df = spark.read.parquet(path)
    return df.select(*ensure_columns(df, required, optional))


def read_raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV (optionally gzip) with an explicit schema; codes stay strings."""
    return spark.read.csv(path, header=True, schema=RAW_SCHEMAS[table], mode="PERMISSIVE")


def land_raw_tables(spark: SparkSession, csv_dir: str, out_dir: str, partitions: int | None = None) -> list[str]:
    """S1 + S6: land each raw CSV that is there once as Parquet; returns their
    names.  Gzip files do not split, so each is repartitioned before the write.
    Existence is Spark's own answer, so any store works."""
    landed = []
    for table in RAW_SCHEMAS:
        for ext in (".csv.gz", ".csv"):
            try:
                df = read_raw_csv(spark, f"{csv_dir.rstrip('/')}/{table}{ext}", table)
            except AnalysisException as error:
                if "PATH_NOT_FOUND" not in str(error.getCondition()):
                    raise
                continue
            if partitions:
                df = df.repartition(partitions)
            df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{table}")
            landed.append(table)
            break
    return landed


def write_table(df: DataFrame, path: str, sort_within: list[str] | None = None) -> None:
    """Materialise a result (create-or-replace)."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    out.write.mode("overwrite").parquet(path)


def table_or_fallback(spark: SparkSession, name: str, build):
    """Use a catalogued table when it exists, else derive it from raw data."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return build()


def has_columns(df: DataFrame, required: list[str]) -> bool:
    """Schema dispatch test."""
    return all(c in df.columns for c in required)


PROFILE_SCHEMA = T.StructType([
    T.StructField("profile_id", T.LongType()),
    T.StructField("age", T.DoubleType()),
    T.StructField("gender", T.StringType()),
    T.StructField("race", T.StringType()),
    T.StructField("bmi", T.DoubleType()),
    T.StructField("systolic_bp", T.DoubleType()),
    T.StructField("diastolic_bp", T.DoubleType()),
    T.StructField("diagnoses_icd_list", T.ArrayType(T.StringType())),
    T.StructField("diagnoses_3digit_list", T.ArrayType(T.StringType())),
    T.StructField("diagnosis_count", T.LongType()),
    T.StructField("unique_icd_count", T.LongType()),
])


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """A batch of patient profiles from JSON lines, with a fixed schema."""
    return spark.read.schema(PROFILE_SCHEMA).json(path)
