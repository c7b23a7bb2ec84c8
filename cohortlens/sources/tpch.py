"""Role bindings: the driver's TPC-H-like tables seen as admission data.

Each operator takes generic roles (patient, admission, coded item,
measurement).  These functions derive raw-shaped DataFrames from the driver's
tables so that the same operators run on them; every derivation is a lazy
projection or join, so the work grows with the input tables.

Binding (documented in README.md):

* patients      <- customer (subject_id = c_custkey, gender = c_mktsegment,
                   anchor_age = 4 * c_nationkey, race = nation name)
* admissions    <- orders (hadm_id = o_orderkey, admittime = o_orderdate,
                   dischtime = admittime + sum(l_quantity) hours, null when
                   the order has no items; admission_type = o_orderpriority,
                   hospital_expire_flag = o_orderstatus = 'F')
* omr           <- lineitem x orders (one measurement per item, dated by
                   l_shipdate, undated where l_tax is 0.05; name by return
                   flag / line status; no sequence where l_discount is 0.03)
* diagnoses_icd <- lineitem x part (code p_brand, null where l_tax is 0.07;
                   group p_type; no sequence where l_discount is 0.03)
* procedures    <- lineitem with return flag 'R' (code from p_size and
                   line number)
* prescriptions <- lineitem x part (drug p_name, route from return flag,
                   start l_shipdate, stop l_shipdate + l_quantity days)
* labevents     <- lineitem (item l_partkey, value l_extendedprice)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _version(linestatus: str = "l_linestatus"):
    return F.when(F.col(linestatus) == "F", F.lit(9)).otherwise(F.lit(10))


@dataclass
class RawTables:
    patients: DataFrame
    admissions: DataFrame
    omr: DataFrame
    diagnoses_icd: DataFrame
    d_icd_diagnoses: DataFrame
    procedures_icd: DataFrame
    d_icd_procedures: DataFrame
    prescriptions: DataFrame
    labevents: DataFrame
    d_labitems: DataFrame


def raw_tables(spark: SparkSession, sf_dir: str, parts: int | None = None) -> RawTables:
    """The roles; with ``parts`` the items of an admission are dealt into that many parts."""
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    orders = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")

    patients = (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
                .select(F.col("c_custkey").alias("subject_id"),
                        F.col("c_mktsegment").alias("gender"),
                        (F.col("c_nationkey") * 4).cast("int").alias("anchor_age"),
                        F.col("n_name").alias("race")))

    stay_hours = lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("stay_hours"))
    admissions = (orders.join(stay_hours, orders.o_orderkey == stay_hours.l_orderkey, "left")
                  .select(F.col("o_orderkey").alias("hadm_id"),
                          F.col("o_custkey").alias("subject_id"),
                          F.col("o_orderdate").alias("admittime"),
                          (F.col("o_orderdate")
                           + F.make_dt_interval(hours=F.col("stay_hours").cast("int"))).alias("dischtime"),
                          F.col("o_orderpriority").alias("admission_type"),
                          (F.col("o_orderstatus") == "F").cast("int").alias("hospital_expire_flag")))

    # The orders come last: what is then grouped by admission is already dealt by it.
    bought, placed = lineitem.join(part, lineitem.l_partkey == part.p_partkey), orders.select("o_orderkey", "o_custkey")
    if parts is not None:
        bought, placed = bought.repartition(parts, "l_orderkey"), placed.repartition(parts, "o_orderkey")
    items = bought.join(placed, lineitem.l_orderkey == orders.o_orderkey)

    name = (F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), "Height (Inches)")
            .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), "Weight (Lbs)")
            .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), "BMI (kg/m2)")
            .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), "Blood Pressure")
            .otherwise("Temperature"))
    bp_text = F.when(F.col("l_tax") == 0, F.lit("unknown")).otherwise(
        F.concat((F.col("l_quantity").cast("int") + 90).cast("string"), F.lit("/"),
                 (F.round(F.col("l_discount") * 100).cast("int") + 50).cast("string")))
    value = F.when(name == "Blood Pressure", bp_text).otherwise(F.col("l_quantity").cast("string"))
    omr = (lineitem.join(orders.select("o_orderkey", "o_custkey"), lineitem.l_orderkey == orders.o_orderkey)
           .select(F.col("o_custkey").alias("subject_id"),
                   F.when(F.col("l_tax") != 0.05, F.to_date("l_shipdate")).alias("chartdate"),
                   F.when(F.col("l_discount") != 0.03, F.col("l_linenumber")).alias("seq_num"),
                   name.alias("result_name"),
                   value.alias("result_value")))

    code = F.when(F.col("l_tax") != 0.07, F.col("p_brand"))
    diagnoses_icd = items.select(
        F.col("o_custkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"),
        F.when(F.col("l_discount") != 0.03, F.col("l_linenumber")).alias("seq_num"), code.alias("icd_code"),
        _version().alias("icd_version"),
        F.when(code.isNotNull(), F.concat(_version().cast("string"), F.lit("_"), F.col("p_type"))).alias("icd_group"))
    d_icd_diagnoses = (part.select(F.col("p_brand").alias("icd_code")).distinct()
                       .select("icd_code", F.explode(F.array(F.lit(9), F.lit(10))).alias("icd_version"),
                               F.concat(F.lit("Diagnosis "), F.col("icd_code")).alias("long_title")))

    proc_code = F.concat(F.lpad(F.col("p_size").cast("string"), 3, "0"), F.col("l_linenumber").cast("string"))
    procedures_icd = items.filter(F.col("l_returnflag") == "R").select(
        F.col("o_custkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"),
        F.col("l_linenumber").alias("seq_num"), F.to_date("l_shipdate").alias("chartdate"),
        proc_code.alias("icd_code"), _version().alias("icd_version"))
    d_icd_procedures = (procedures_icd.filter(F.col("icd_version") == 9)
                        .select("icd_code", "icd_version").distinct()
                        .withColumn("long_title", F.concat(F.lit("Procedure "), F.col("icd_code"))))

    route = (F.when(F.col("l_returnflag") == "A", "IV")
             .when(F.col("l_returnflag") == "N", "PO/NG").otherwise("TOPICAL"))
    start = F.when(F.col("l_tax") == 0.08, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("l_shipdate"))
    stop = F.when(F.col("l_discount") == 0,
                  F.col("l_shipdate") - F.make_dt_interval(days=F.lit(1))).otherwise(
        F.col("l_shipdate") + F.make_dt_interval(days=F.col("l_quantity").cast("int")))
    prescriptions = items.select(
        F.col("o_custkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"),
        start.alias("starttime"), stop.alias("stoptime"),
        F.col("p_type").alias("drug_type"), F.col("p_name").alias("drug"),
        F.col("p_brand").alias("formulary_drug_cd"),
        F.concat(F.col("p_size").cast("string"), F.lit(" mg")).alias("prod_strength"),
        (F.col("l_tax") * 100).alias("doses_per_24_hrs"), route.alias("route"))

    labevents = items.select(
        F.col("o_custkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"),
        F.col("l_partkey").alias("itemid"), F.col("l_shipdate").alias("charttime"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")).alias("valuenum"))
    d_labitems = part.select(F.col("p_partkey").alias("itemid"), F.col("p_name").alias("label"),
                             F.col("p_type").alias("fluid"), F.col("p_brand").alias("category"))

    return RawTables(patients, admissions, omr, diagnoses_icd, d_icd_diagnoses, procedures_icd,
                     d_icd_procedures, prescriptions, labevents, d_labitems)


# DuckDB versions of the same derivations, used by the oracle SQL.
ORACLE_RAW_CTES = r"""
patients AS (
  SELECT c_custkey AS subject_id, c_mktsegment AS gender, CAST(c_nationkey * 4 AS INTEGER) AS anchor_age,
         n_name AS race
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
stay_hours AS (SELECT l_orderkey, sum(l_quantity) AS stay_hours FROM lineitem GROUP BY l_orderkey),
admissions AS (
  SELECT o_orderkey AS hadm_id, o_custkey AS subject_id, o_orderdate AS admittime,
         o_orderdate + to_hours(CAST(stay_hours AS INTEGER)) AS dischtime,
         o_orderpriority AS admission_type, CAST(o_orderstatus = 'F' AS INTEGER) AS hospital_expire_flag
  FROM orders LEFT JOIN stay_hours ON o_orderkey = l_orderkey),
items AS (
  SELECT * FROM lineitem JOIN (SELECT o_orderkey, o_custkey FROM orders) o ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey),
omr AS (
  SELECT o_custkey AS subject_id, CASE WHEN l_tax <> 0.05 THEN CAST(l_shipdate AS DATE) END AS chartdate,
    CASE WHEN l_discount <> 0.03 THEN l_linenumber END AS seq_num,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Height (Inches)'
         WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Weight (Lbs)'
         WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'BMI (kg/m2)'
         WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Blood Pressure'
         ELSE 'Temperature' END AS result_name,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN
           CASE WHEN l_tax = 0 THEN 'unknown'
                ELSE CAST(CAST(l_quantity AS INTEGER) + 90 AS VARCHAR) || '/'
                     || CAST(CAST(round(l_discount * 100) AS INTEGER) + 50 AS VARCHAR) END
         ELSE CAST(l_quantity AS VARCHAR) END AS result_value
  FROM lineitem JOIN (SELECT o_orderkey, o_custkey FROM orders) o ON l_orderkey = o_orderkey),
diagnoses_icd AS (
  SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, CASE WHEN l_discount <> 0.03 THEN l_linenumber END AS seq_num,
         CASE WHEN l_tax <> 0.07 THEN p_brand END AS icd_code,
         CASE WHEN l_linestatus = 'F' THEN 9 ELSE 10 END AS icd_version,
         CASE WHEN l_tax <> 0.07 THEN CASE WHEN l_linestatus = 'F' THEN '9_' ELSE '10_' END || p_type END AS icd_group
  FROM items),
d_icd_diagnoses AS (
  SELECT icd_code, v AS icd_version, 'Diagnosis ' || icd_code AS long_title
  FROM (SELECT DISTINCT p_brand AS icd_code FROM part) b, (VALUES (9), (10)) t(v)),
procedures_icd AS (
  SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, l_linenumber AS seq_num,
         CAST(l_shipdate AS DATE) AS chartdate,
         lpad(CAST(p_size AS VARCHAR), 3, '0') || CAST(l_linenumber AS VARCHAR) AS icd_code,
         CASE WHEN l_linestatus = 'F' THEN 9 ELSE 10 END AS icd_version
  FROM items WHERE l_returnflag = 'R'),
d_icd_procedures AS (
  SELECT DISTINCT icd_code, icd_version, 'Procedure ' || icd_code AS long_title
  FROM procedures_icd WHERE icd_version = 9),
prescriptions AS (
  SELECT o_custkey AS subject_id, l_orderkey AS hadm_id,
         CASE WHEN l_tax = 0.08 THEN NULL ELSE l_shipdate END AS starttime,
         CASE WHEN l_discount = 0 THEN l_shipdate - INTERVAL 1 DAY
              ELSE l_shipdate + to_days(CAST(l_quantity AS INTEGER)) END AS stoptime,
         p_type AS drug_type, p_name AS drug, p_brand AS formulary_drug_cd,
         CAST(p_size AS VARCHAR) || ' mg' AS prod_strength, l_tax * 100 AS doses_per_24_hrs,
         CASE WHEN l_returnflag = 'A' THEN 'IV' WHEN l_returnflag = 'N' THEN 'PO/NG' ELSE 'TOPICAL' END AS route
  FROM items),
labevents AS (
  SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, l_partkey AS itemid, l_shipdate AS charttime,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice END AS valuenum
  FROM items),
d_labitems AS (
  SELECT p_partkey AS itemid, p_name AS label, p_type AS fluid, p_brand AS category FROM part)
"""
