"""Treatment recommendation from neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MIN_LOS = 1e-6


def recommend_drugs(neighbours: DataFrame, clin: DataFrame, similarity_col: str, top_n: int = 10) -> DataFrame:
    """Explode the neighbours' drug lists and rank drugs by weighted
    frequency, frequency, mean similarity (then name)."""
    n = neighbours.select("hadm_id", F.col(similarity_col).alias("similarity"))
    lists = clin.select("hadm_id", "rx_drug_list", F.col("mortality").cast("double").alias("mort"),
                        F.col("los_days").cast("double").alias("los"))
    rows = n.join(lists, "hadm_id").select("hadm_id", "similarity", "mort", "los",
                                           F.explode("rx_drug_list").alias("drug"))
    agg = rows.groupBy("drug").agg(
        F.count_distinct("hadm_id").alias("frequency"),
        F.sum("similarity").alias("weighted_frequency"),
        F.avg("similarity").alias("mean_similarity"),
        F.avg("mort").alias("mortality_rate"),
        F.avg("los").alias("avg_los_days"))
    return (agg.orderBy(F.col("weighted_frequency").desc(), F.col("frequency").desc(),
                        F.col("mean_similarity").desc(), F.col("drug").asc())
            .limit(int(top_n)))


def score_treatments(neighbour_treatments: DataFrame, top_n: int = 10, min_los: float = DEFAULT_MIN_LOS) -> DataFrame:
    """Per treatment (source, key, name): frequency (distinct
    neighbours), mean LOS, weighted score = sum(similarity / LOS), event
    count and the sorted supporting admissions; score = frequency /
    max(mean LOS, min_los).  LOS is floored at ``min_los``.  Ordered by
    weighted score, score, frequency (descending), then name and key.

    Input columns: hadm_id, similarity, los_days, treatment_source,
    treatment_key, treatment_name, treatment_count."""
    los = F.greatest(F.coalesce(F.col("los_days").cast("double"), F.lit(0.0)), F.lit(min_los))
    agg = neighbour_treatments.groupBy("treatment_source", "treatment_key", "treatment_name").agg(
        F.count_distinct("hadm_id").alias("frequency"),
        F.avg(los).alias("average_los"),
        F.sum(F.col("similarity") / los).alias("weighted_score"),
        F.sum("treatment_count").alias("event_count_sum"),
        F.array_join(F.array_sort(F.collect_set("hadm_id")).cast("array<string>"), ",").alias("supporting_hadm_ids"))
    agg = agg.withColumn("score", F.col("frequency") / F.greatest(F.col("average_los"), F.lit(min_los)))
    return (agg.orderBy(F.col("weighted_score").desc(), F.col("score").desc(), F.col("frequency").desc(),
                        F.col("treatment_name").asc(), F.col("treatment_key").asc())
            .limit(int(top_n)))
