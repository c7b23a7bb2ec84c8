"""Sparse cosine kNN over mixed features.

The feature vector of an admission is [z-scored numerics, one-hot gender,
one-hot race, multi-hot diagnosis groups, multi-hot codes].  No vector is
materialised: for a query q and row c

    dot  = sum_i z_qi z_ci + [g_q = g_c] + [r_q = r_c] + |G_q & G_c| + |D_q & D_c|
    |x|^2 = sum_i z_i^2 + 1 + 1 + |G| + |D|

(a query's unseen gender or race contributes 0, its unknown codes are
dropped).  So the exact cosine is a pure column expression over one scan.
Imputation medians (exact), means and population standard deviations are
single-row global aggregates.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.quantiles import exact_medians
from cohortlens.operators.recommend import score_treatments
from cohortlens.operators.scan_topk import Best, SharedItems, longs, numbers, scan_top_k
from cohortlens.operators.similarity import lit_set, lookup_row

# Fixed value: numeric features of the cosine kNN.
KNN_NUMERIC = ["age", "bmi", "systolic_bp", "diastolic_bp", "diagnosis_count", "unique_icd_count",
               "diagnosis_diversity_ratio"]
DEFAULT_NEIGHBOURS = 7


def scaling_stats(df: DataFrame, cols: list[str] = KNN_NUMERIC,
                  query_key: str | None = None) -> tuple[dict[str, tuple[float, float, float]], dict | None]:
    """Per column (median, mean, population std) after median imputation:
    with m the median (exact, from counted values), k non-null values and z
    nulls, the imputed sum is sum + z m and the sum of squares sumsq + z m^2.
    A zero std becomes 1 (the column then scales to 0).  With ``query_key``
    the same pass also returns the row with the smallest key (position 0)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.sum(x).alias(f"sum_{c}"), F.sum(x * x).alias(f"sq_{c}"),
                 F.count(x).alias(f"cnt_{c}")]
    if query_key:
        aggs.append(F.min_by(F.struct(*df.columns), F.col(query_key)).alias("_q"))
    row = df.agg(*aggs).first()
    medians = exact_medians(df, cols)
    n = float(row["_n"] or 0)
    out = {}
    for c in cols:
        med = medians[c] if medians[c] is not None else 0.0
        nulls = n - float(row[f"cnt_{c}"] or 0)
        total = float(row[f"sum_{c}"] or 0.0) + nulls * med
        sq = float(row[f"sq_{c}"] or 0.0) + nulls * med * med
        mean = total / n if n else 0.0
        var = max(sq / n - mean * mean, 0.0) if n else 0.0
        sd = var ** 0.5
        out[c] = (med, mean, sd if sd > 1e-12 else 1.0)
    q = row["_q"].asDict() if query_key and row["_q"] is not None else None
    return out, q


def z_expr(c: str, stats) -> Column:
    med, mean, sd = stats[c]
    return (F.coalesce(F.col(c).cast("double"), F.lit(med)) - F.lit(mean)) / F.lit(sd)


def z_value(v: Any, c: str, stats) -> float:
    med, mean, sd = stats[c]
    x = med if v is None else float(v)
    return (x - mean) / sd


def cosine_scores(df: DataFrame, q: dict, stats, vocab_filter: bool = False) -> DataFrame:
    """M3 against a literal query; adds dot, similarity and distance columns."""
    zq = {c: z_value(q.get(c), c, stats) for c in KNN_NUMERIC}
    numeric_dot = sum((F.lit(zq[c]) * z_expr(c, stats) for c in KNN_NUMERIC), F.lit(0.0))
    c_norm2 = sum((F.pow(z_expr(c, stats), 2) for c in KNN_NUMERIC), F.lit(0.0))
    qg, qd = lit_set(q.get("diagnoses_3digit_list")), lit_set(q.get("diagnoses_icd_list"))
    gender_eq = F.coalesce((F.col("gender") == F.lit(q.get("gender") or "unknown")).cast("double"), F.lit(0.0))
    race_eq = F.coalesce((F.col("race") == F.lit(q.get("race") or "unknown")).cast("double"), F.lit(0.0))
    dot = (numeric_dot + gender_eq + race_eq
           + F.size(F.array_intersect(qg, F.col("diagnoses_3digit_list"))).cast("double")
           + F.size(F.array_intersect(qd, F.col("diagnoses_icd_list"))).cast("double"))
    q_norm2 = (sum(z * z for z in zq.values()) + float(q.get("_gender_known", 1)) + float(q.get("_race_known", 1))
               + float(q.get("_n_groups", len(set(q.get("diagnoses_3digit_list") or []))))
               + float(q.get("_n_codes", len(set(q.get("diagnoses_icd_list") or [])))))
    norm2 = c_norm2 + 2.0 + F.size("diagnoses_3digit_list") + F.size("diagnoses_icd_list")
    denom = F.sqrt(norm2.cast("double")) * F.lit(q_norm2 ** 0.5)
    cos = F.when(denom > 0, dot / denom).otherwise(F.lit(0.0))
    return (df.withColumn("cosine", cos)
            .withColumn("distance", 1.0 - F.col("cosine"))
            .withColumn("similarity", F.least(F.greatest(F.col("cosine"), F.lit(0.0)), F.lit(1.0))))


def _shared(q_list, col: str, n: int = 10) -> Column:
    """First n shared items in sorted order."""
    return F.slice(F.array_sort(F.array_intersect(lit_set(q_list), F.col(col))), 1, n)


def _abs_diff(qv, col: str) -> Column:
    return F.abs(F.lit(None if qv is None else float(qv)).cast("double") - F.col(col).cast("double"))


def knn_neighbours(knn: DataFrame, query_hadm_id: Any = None, k: int = DEFAULT_NEIGHBOURS,
                   position: int | None = None, stats=None) -> DataFrame:
    """T3 + U3 + M4: k nearest admissions (self excluded) by cosine distance,
    ties by hadm_id ascending, with shared items and feature differences."""
    if query_hadm_id is None and not position:
        stats, q = scaling_stats(knn, query_key="hadm_id")
        if q is None:
            raise KeyError("empty cohort")
    else:
        stats = stats or scaling_stats(knn)[0]
        q = lookup_row(knn, "hadm_id", query_hadm_id, position=position)
    scored = cosine_scores(knn.filter(F.col("hadm_id") != F.lit(q["hadm_id"])), q, stats)
    top = scored.orderBy(F.col("distance").asc(), F.col("hadm_id").asc()).limit(int(k))
    return top.select(
        "hadm_id", "subject_id", "distance", "similarity", "los_days",
        _shared(q.get("diagnoses_icd_list"), "diagnoses_icd_list").alias("shared_diagnoses"),
        _shared(q.get("diagnoses_3digit_list"), "diagnoses_3digit_list").alias("shared_icd_groups"),
        (F.col("gender") == F.lit(q.get("gender"))).alias("same_gender"),
        (F.col("race") == F.lit(q.get("race"))).alias("same_race"),
        _abs_diff(q.get("age"), "age").alias("age_difference"),
        _abs_diff(q.get("bmi"), "bmi").alias("bmi_difference"),
        _abs_diff(q.get("systolic_bp"), "systolic_bp").alias("systolic_bp_difference"),
        _abs_diff(q.get("diastolic_bp"), "diastolic_bp").alias("diastolic_bp_difference"),
        F.size(F.array_intersect(lit_set(q.get("diagnoses_icd_list")), F.col("diagnoses_icd_list")))
        .alias("shared_diagnosis_count"))


def recommend_from_neighbours(neighbours: DataFrame, tall: DataFrame, top_n: int = 10) -> DataFrame:
    """Treatments of the neighbours, scored and ranked."""
    t = tall.select("hadm_id", "treatment_source", "treatment_key", "treatment_name", "treatment_count")
    n = neighbours.select("hadm_id", "similarity", "los_days")
    return score_treatments(n.join(t, "hadm_id"), top_n=top_n)


def complete_profile(profiles: DataFrame, knn: DataFrame) -> DataFrame:
    """P18 + P19: complete a batch of profiles against the cohort vocabulary.

    Groups default to ``UNK_`` + first three characters of each code when
    absent; counts and the diversity ratio are derived from the list when
    absent; only codes, groups, genders and races seen in the cohort count
    for the one-hot / multi-hot part (unknown ones give the zero vector).
    Vocabularies are distinct exploded values (a shuffle on the value);
    profiles are matched by exploding and a semi join, then re-collected."""
    empty = F.array().cast("array<string>")
    p = profiles.withColumn("diagnoses_icd_list", F.array_distinct(F.coalesce("diagnoses_icd_list", empty)))
    derived = F.transform("diagnoses_icd_list", lambda c: F.concat(F.lit("UNK_"), F.substring(c, 1, 3)))
    p = p.withColumn("diagnoses_3digit_list",
                     F.when(F.size(F.coalesce("diagnoses_3digit_list", empty)) == 0, F.array_distinct(derived))
                     .otherwise(F.array_distinct("diagnoses_3digit_list")))

    def known(list_col: str, vocab_col: str, out: str) -> DataFrame:
        vocab = knn.select(F.explode(vocab_col).alias("item")).distinct()
        return (p.select("profile_id", F.explode(list_col).alias("item")).join(vocab, "item", "left_semi")
                .groupBy("profile_id").agg(F.array_sort(F.collect_set("item")).alias(out)))

    genders = knn.select(F.col("gender").alias("g_known")).distinct()
    races = knn.select(F.col("race").alias("r_known")).distinct()
    out = (p.join(known("diagnoses_icd_list", "diagnoses_icd_list", "known_codes"), "profile_id", "left")
           .join(known("diagnoses_3digit_list", "diagnoses_3digit_list", "known_groups"), "profile_id", "left")
           .withColumn("gender", F.coalesce("gender", F.lit("unknown")))
           .withColumn("race", F.coalesce("race", F.lit("unknown")))
           .join(genders, F.col("gender") == F.col("g_known"), "left")
           .join(races, F.col("race") == F.col("r_known"), "left"))
    n_list = F.size("diagnoses_icd_list")
    return out.select(
        "profile_id", "age", "gender", "race", "bmi", "systolic_bp", "diastolic_bp",
        "diagnoses_icd_list", "diagnoses_3digit_list",
        F.coalesce("known_codes", empty).alias("known_codes"),
        F.coalesce("known_groups", empty).alias("known_groups"),
        F.coalesce("diagnosis_count", n_list.cast("long")).alias("diagnosis_count"),
        F.coalesce("unique_icd_count", n_list.cast("long")).alias("unique_icd_count"),
        F.coalesce(F.try_divide(n_list.cast("double"), n_list.cast("double")), F.lit(0.0))
        .alias("diagnosis_diversity_ratio"),
        F.get("diagnoses_icd_list", F.lit(0)).alias("primary_diagnosis_icd"),
        F.col("g_known").isNotNull().cast("int").alias("gender_known"),
        F.col("r_known").isNotNull().cast("int").alias("race_known"))


def knn_for_profile(knn: DataFrame, profile: dict, k: int = DEFAULT_NEIGHBOURS, stats=None) -> DataFrame:
    """M3 for one completed profile (a row of :func:`complete_profile`):
    the k nearest admissions, ties by id; nothing is excluded."""
    stats = stats or scaling_stats(knn)[0]
    q = dict(profile)
    q["diagnoses_icd_list"], q["diagnoses_3digit_list"] = q["known_codes"], q["known_groups"]
    q["_gender_known"], q["_race_known"] = q["gender_known"], q["race_known"]
    scored = cosine_scores(knn, q, stats)
    return (scored.orderBy(F.col("distance").asc(), F.col("hadm_id").asc()).limit(int(k))
            .select("hadm_id", "subject_id", "distance", "similarity", "los_days"))


def knn_for_profiles(knn: DataFrame, profiles: DataFrame, k: int = DEFAULT_NEIGHBOURS, stats=None,
                     block_rows: int = 2_048, block_profiles: int = 65_536) -> DataFrame:
    """M3 for a batch of completed profiles (:func:`complete_profile`):
    (profile_id, rank, hadm_id, subject_id, distance, similarity, los_days) of
    the k nearest admissions of each, ties by id.

    Distances are compared to nine places, as equal rows may differ in their
    last bits.  Blocks of ``block_profiles`` profiles are sent to the tasks; a task
    scans its part of the admissions, in Arrow batches, by matrix products and
    hands on k rows of each profile.  No admission is shuffled or copied.  All
    pairs are scored: the time is quadratic in the cohort."""
    from pyspark.sql import Window

    from cohortlens.session import materialize

    stats = stats or scaling_stats(knn)[0]
    empty = F.array().cast("array<string>")

    def z_array(prefix: str = "") -> Column:
        return F.array(*[z_expr(f"{prefix}{c}", {f"{prefix}{c}": stats[c]}) for c in KNN_NUMERIC])

    def square(z: Column) -> Column:
        return F.aggregate(z, F.lit(0.0), lambda s, x: s + x * x)

    def hashed(c: str) -> Column:
        return F.transform(F.coalesce(F.col(c), empty), lambda x: F.xxhash64(x))

    def flat(df: DataFrame, ids: list[str], sets: tuple[str, str], fixed: Column) -> DataFrame:
        groups, codes = sets
        return df.select(*[F.col(c).cast("long").alias(c) for c in ids], *[F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c) for c in ("gender", "race")],
                         z_array().alias("z"), hashed(groups).alias("groups"), hashed(codes).alias("codes"),
                         F.sqrt(square(z_array()) + fixed + F.size(groups) + F.size(codes)).alias("norm"))

    rows = materialize(flat(knn, ["hadm_id", "subject_id", "los_days"], ("diagnoses_3digit_list", "diagnoses_icd_list"), F.lit(2.0)))
    asked = flat(profiles, ["profile_id"], ("known_groups", "known_codes"), F.col("gender_known") + F.col("race_known"))
    asked = materialize(asked.withColumn("asked_id", F.monotonically_increasing_id()))
    near = scan_top_k(asked.drop("profile_id"), rows, _ProfileCosine, k, carry=("subject_id", "los_days"), detail=True,
                      block=block_profiles, rows_at_once=block_rows)
    # Rows of one profile id are one profile.
    order = Window.partitionBy("profile_id").orderBy(F.col("score").desc(), F.col("hadm_id").asc())
    found = near.drop("rank").withColumnRenamed("id", "hadm_id").join(asked.select("asked_id", "profile_id"), "asked_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= int(k)).select(
        "profile_id", "rank", "hadm_id", "subject_id", (1.0 - F.col("detail")).alias("distance"),
        F.least(F.greatest(F.col("detail"), F.lit(0.0)), F.lit(1.0)).alias("similarity"), "los_days")


class _ProfileCosine:
    """Cosines of profiles with admissions: numbers and frequent items by one matrix
    product in single precision, rare items by lists.  The score is 1 less the
    distance to nine places, the second number the cosine itself."""

    slack = 1e-5

    def __init__(self, asked, most_words: int | None = None):
        self.z, self.inverse = numbers(asked.column("z")), self._inverse(asked)
        self.sets = {c: SharedItems(self._lists(asked.column(c)), most_words) for c in ("gender", "race", "groups", "codes")}
        self.left = self._scaled(self.z, [x.held for x in self.sets.values()], self.inverse)

    @staticmethod
    def _lists(column):
        """A column of single items, null for none, as sets."""
        import numpy as np
        import pyarrow as pa

        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if pa.types.is_list(column.type):
            return column
        sizes = column.is_valid().to_numpy(zero_copy_only=False).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), column.drop_null())

    @staticmethod
    def _inverse(table):
        import numpy as np

        norm = table.column("norm").to_numpy()
        return np.divide(1.0, norm, out=np.zeros(len(norm)), where=norm > 0)

    @staticmethod
    def _scaled(z, sets, inverse):
        import numpy as np

        return (np.concatenate([z, *sets], axis=1) * inverse[:, None]).astype(np.float32)

    def meet(self, part) -> None:
        self.z_part, self.inverse_part = numbers(part.column("z")), self._inverse(part)
        for c, own in self.sets.items():
            own.meet(self._lists(part.column(c)))
        self.right = self._scaled(self.z_part, [x.theirs for x in self.sets.values()], self.inverse_part).T

    def pairs(self, low: int, high: int):
        import numpy as np

        rough = self.left[low:high] @ self.right
        rare = [own.rare(low, high) for own in self.sets.values()]
        for row, column in rare:
            np.add.at(rough, (row, column), (self.inverse[low + row] * self.inverse_part[column]).astype(np.float32))

        def exact(row, column):
            dot = np.einsum("ij,ij->i", self.z[low + row], self.z_part[column])
            for own in self.sets.values():
                dot += np.einsum("ij,ij->i", own.held[low + row], own.theirs[column])
            if any(len(x) for x, _ in rare):
                more = np.zeros(rough.shape, np.int32)
                for place in rare:
                    np.add.at(more, place, 1)
                dot += more[row, column]
            size = self.inverse[low + row] * self.inverse_part[column]
            cosine = dot * size
            return 1.0 - np.round(1.0 - cosine, 9), cosine

        return rough, exact


def _nearest_of_block(k: int, chunk: int = 128, most_words: int | None = None):
    """The k nearest rows of a block of admissions for every profile of a block of
    them, ``chunk`` profiles at once, with ``most_words`` frequent items of each
    kind."""
    def nearest(asked, rows):
        import numpy as np
        import pyarrow as pa

        best = Best(asked.num_rows, k, [np.int64, np.int64, np.float64], False)
        if rows.num_rows and asked.num_rows:
            carried = [longs(rows.column(c)) for c in ("subject_id", "los_days")]
            best.meet(_ProfileCosine(asked, most_words), rows, longs(rows.column("hadm_id")), carried, True, chunk)
            best.merge()
        whole = [pa.array(x, mask=x == np.iinfo(np.int64).min) for x in (best.id, *best.more[:2])]
        return pa.table([asked.column("profile_id").take(pa.array(best.row)), *whole, pa.array(best.more[2]), pa.array(1.0 - best.value)],
                        names=["profile_id", "hadm_id", "subject_id", "los_days", "cosine", "near"])

    return nearest
