"""Lazy feature tables over the driver's data (one place that wires roles)."""

from __future__ import annotations

import hashlib
import uuid
from pathlib import Path
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.codes import diagnosis_features
from cohortlens.operators.dataset import clinical_dataset, joined_dataset, knn_dataset
from cohortlens.operators.measurements import adult_cohort, base_features
from cohortlens.operators.treatments import (treatment_features_capped, treatment_features_minmax,
                                             treatment_tall)
from cohortlens.sources.tpch import raw_tables, read_table


def _definition() -> str:
    """Digest of the code that builds the feature tables: a changed definition
    never meets a table of an older one."""
    import cohortlens

    home = Path(cohortlens.__file__).parent
    names = [home / "plans" / "features.py", *sorted((home / "operators").glob("*.py")),
             *sorted((home / "functions").glob("*.py")), *sorted((home / "sources").glob("*.py"))]
    return hashlib.sha256(b"".join(n.read_bytes() for n in names)).hexdigest()


#: Raw tables that each stored table is built from.
_COHORT = ("customer", "nation", "orders", "lineitem")
INPUTS = {"cohort": _COHORT, "base": _COHORT, "dx": (*_COHORT, "part"), "tr": (*_COHORT, "part"), "tall": ("orders", "lineitem", "part")}
ALL_INPUTS = (*_COHORT, "part")


def input_files(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    """{table: its files as path, size and modification time}, in order.

    A listing through Spark's file reader, so that any store works: of the
    binary source only the columns that need no content are asked for, so no
    data row is read, whatever the size of the tables."""
    paths = [f"{sf_dir}/{name}.parquet" for name in ALL_INPUTS]
    rows = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
            .select("path", "length", F.col("modificationTime").cast("double").alias("at")).collect())
    out: dict[str, list[str]] = {name: [] for name in ALL_INPUTS}
    for r in rows:
        name = next(n for n in ALL_INPUTS if f"/{n}.parquet" in r["path"])
        out[name].append(f"{r['path']}:{r['length']}:{r['at']}")
    return {name: sorted(files) for name, files in out.items()}


#: Bytes of stored items (about 30 MB when shuffled) that one task groups by admission.
PART_BYTES = 8 * 2**20


def admission_parts(item_files: list[str]) -> int:
    """Number of parts for the items of admissions: it grows with the table, so
    that a task's memory does not."""
    stored = sum(int(f.rsplit(":", 2)[1]) for f in item_files)
    return -(-stored // PART_BYTES)


class Features:
    """Feature tables over the driver's data.

    With ``materialize=False`` every attribute is a lazy plan from the raw
    tables.  With ``materialize=True`` (the default for downstream queries)
    the feature tables are written once as Parquet under the cluster's
    shared ``spark.checkpoint.dir`` and read back, like the reference's
    persisted feature tables: searches and evaluations then scan a built
    table instead of rebuilding it from raw events."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self.raw = raw_tables(spark, sf_dir)

    def _stored(self, name: str, build) -> DataFrame:
        if not self.materialize:
            return build()
        from cohortlens.session import ensure_checkpoint_dir
        root = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/cohortlens-tables/{name}-{self._stamp(name)}"
        # A build goes to a folder of its own and is published by a pointer
        # that is written last: two sessions may both build, none reads half.
        try:
            found = self.spark.read.schema("path string").json(f"{root}/published").agg(F.min("path")).first()[0]
        except AnalysisException:
            found = None
        if found is None:
            found = f"{root}/{uuid.uuid4().hex}"
            build().write.parquet(found)
            self.spark.range(1).select(F.lit(found).alias("path")).write.mode("append").json(f"{root}/published")
        return self.spark.read.parquet(found)

    @cached_property
    def _files(self) -> dict[str, list[str]]:
        return input_files(self.spark, self.sf_dir)

    def _stamp(self, name: str) -> str:
        """Key of a stored table: its own inputs' files and the code, so that a
        changed input only rebuilds the tables that read it."""
        files = [f for t in INPUTS.get(name, ALL_INPUTS) for f in self._files[t]]
        return hashlib.sha256("|".join([self.sf_dir, _definition(), *files]).encode()).hexdigest()[:24]

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def cohort(self) -> DataFrame:
        """Adult valid-stay admissions: the same id set as ``base`` (which is
        this cohort left-joined to its measurements), without the
        measurement pipeline; used to restrict events to the cohort."""
        return self._cohort.select("hadm_id", "subject_id")

    @cached_property
    def _cohort(self) -> DataFrame:
        """The cohort with its admission columns: every feature table is
        restricted to it, so it is built once for all of them."""
        r = self.raw
        return self._stored("cohort", lambda: adult_cohort(r.patients, r.admissions))

    @cached_property
    def base(self) -> DataFrame:
        r = self.raw
        cohort = self._cohort if self.materialize else None
        return self._stored("base", lambda: base_features(r.patients, r.admissions, r.omr, cohort=cohort))

    @cached_property
    def dx(self) -> DataFrame:
        r = self.raw
        return self._stored("dx", lambda: diagnosis_features(r.diagnoses_icd, self.cohort, r.d_icd_diagnoses))

    @cached_property
    def tr(self) -> DataFrame:
        parts = max(admission_parts(self._files["lineitem"]), self.spark.sparkContext.defaultParallelism)
        r = raw_tables(self.spark, self.sf_dir, parts)
        return self._stored("tr", lambda: treatment_features_minmax(r.prescriptions, r.procedures_icd,
                                                                    r.d_icd_procedures, self.cohort))

    @cached_property
    def tall(self) -> DataFrame:
        r = self.raw
        return self._stored("tall", lambda: treatment_tall(r.prescriptions, r.procedures_icd, r.d_icd_procedures))

    @cached_property
    def tr_capped(self) -> DataFrame:
        r = self.raw
        return treatment_features_capped(r.prescriptions, r.procedures_icd, r.d_icd_procedures)

    @cached_property
    def clin(self) -> DataFrame:
        return clinical_dataset(self.base, self.dx, self.tr)

    @cached_property
    def joined(self) -> DataFrame:
        return joined_dataset(self.base, self.dx, self.tall, how="inner")

    @cached_property
    def knn(self) -> DataFrame:
        """Stored, as a search reads it for its statistics, its medians and its scores."""
        return self._stored("knn", lambda: knn_dataset(self.base, self.dx))
