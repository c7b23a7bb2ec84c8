"""Evaluation: outcome alignment, metrics, thresholds, splits (M6, M7, M9-M11,
M20, A25-A27).

No operator emits all pairs of a group or ranks a whole group in one task:
pair statistics come from counts of subsets plus closed-form totals, and
ranks and cumulative counts come from :func:`running_sums`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.running import hex_digits, md5_bucket, quantile_bucket, running_sums
from cohortlens.operators.overlaps import MOST_ITEMS, pair_totals, shared_pairs, signatures
from cohortlens.session import materialize


def hash_order(id_col: str, seed: int) -> F.Column:
    """Repeatable pseudo-random order: md5 of the id and seed (same in SQL)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))


def band_edges(bins: int) -> list[float]:
    """Equal-width edges on [0, 1], computed like numpy's linspace."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def band_of(x: F.Column, bins: int) -> F.Column:
    """Right-closed bands with the lowest edge included."""
    edges = band_edges(bins)
    expr = F.lit(None).cast("int")
    for i in reversed(range(bins)):
        expr = F.when((x >= edges[0]) & (x <= F.lit(edges[i + 1])), F.lit(i)).otherwise(expr)
    return expr


# --- M6: similarity / outcome alignment -------------------------------------

def sample_by_hash(df: DataFrame, n: int, seed: int, id_col: str = "hadm_id") -> DataFrame:
    """First n rows in hash order (a bounded TakeOrdered over the full scan)."""
    return df.withColumn("_h", hash_order(id_col, seed)).orderBy("_h", id_col).limit(int(n)).drop("_h")


def outcome_alignment(df: DataFrame, outcome: str = "mortality", sample_size: int | None = None, seed: int = 42,
                      same_version_only: bool = False, bins: int = 5, set_col: str = "diagnoses_icd_list",
                      los_rate: float = 0.05, most_items: int = MOST_ITEMS) -> tuple[DataFrame, DataFrame]:
    """Diagnosis Jaccard of all pairs of a cohort against outcome agreement.

    Returns (summary, bands).  Outcome agreement is equality, or
    exp(-rate |a - b|) for ``los_days`` (whole days).  The pairs are never
    listed: ``overlaps.py`` counts them by sizes and overlap, and pairs that
    share no code have similarity 0 and follow from the totals.  With a
    ``sample_size`` only that many rows in hash order take part."""
    if bins < 1:
        raise ValueError("bins must be >= 1")
    rate = los_rate if outcome == "los_days" else None
    grp = F.col("icd_version_mix") if same_version_only else F.lit("all")
    rows = df.filter(F.col(outcome).isNotNull())
    if same_version_only:
        rows = rows.filter(F.col("icd_version_mix").isNotNull())
    if sample_size is not None:
        rows = sample_by_hash(rows, sample_size, seed)
    sigs = materialize(signatures(rows, set_col, outcome, grp))  # read several times
    # At most (sizes)^2 x overlaps rows; every pair was counted in both orders.
    shared = materialize(shared_pairs(sigs, rate, most_items))
    x = F.col("k").cast("double") / (F.col("a") + F.col("b") - F.col("k"))
    w, yy = F.col("pairs").cast("double") / 2, F.col("agree") / 2
    pos = shared.select(x.alias("x"), w.alias("w"), yy.alias("yy")).withColumn("band", band_of(F.col("x"), bins))
    pos_band = pos.groupBy("band").agg(F.sum("w").alias("p_n"), F.sum(F.col("x") * F.col("w")).alias("p_x"), F.sum("yy").alias("p_y"))
    pos_tot = pos.agg(F.sum("w").alias("P"), F.sum(F.col("x") * F.col("w")).alias("Sx"), F.sum(F.col("x") * F.col("x") * F.col("w")).alias("Sxx"),
                      F.sum(F.col("x") * F.col("yy")).alias("Sxy"), F.sum("yy").alias("Py"))
    tot = pair_totals(sigs, rate).crossJoin(pos_tot)  # single-row aggregates
    tot = tot.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ("N", "Y", "YY", "P", "Sx", "Sxx", "Sxy", "Py")])
    var_x = F.col("N") * F.col("Sxx") - F.col("Sx") * F.col("Sx")
    var_y = F.col("N") * F.col("YY") - F.col("Y") * F.col("Y")
    corr = F.when((var_x > 0) & (var_y > 0),
                  (F.col("N") * F.col("Sxy") - F.col("Sx") * F.col("Y")) / (F.sqrt(var_x) * F.sqrt(var_y)))
    size = sigs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    summary = tot.crossJoin(size).select(
        F.lit(outcome).alias("outcome_column"), F.col("rows").cast("long").alias("sampled_patients"),
        F.col("N").cast("long").alias("pair_count"), F.lit(same_version_only).alias("same_version_only"),
        corr.alias("correlation"), F.when(F.col("N") > 0, F.col("Sx") / F.col("N")).alias("mean_similarity"),
        F.when(F.col("N") > 0, F.col("Y") / F.col("N")).alias("mean_outcome_match_rate"))
    edges = band_edges(bins)
    band_list = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("band"))
    zero = tot.select((F.col("N") - F.col("P")).alias("z_n"), (F.col("Y") - F.col("Py")).alias("z_y"))
    bands = band_list.join(pos_band, "band", "left").crossJoin(zero)
    n_ = F.coalesce("p_n", F.lit(0.0)) + F.when(F.col("band") == 0, F.col("z_n")).otherwise(F.lit(0.0))
    x_ = F.coalesce("p_x", F.lit(0.0))
    y_ = F.coalesce("p_y", F.lit(0.0)) + F.when(F.col("band") == 0, F.col("z_y")).otherwise(F.lit(0.0))
    lower = F.element_at(F.array(*[F.lit(e) for e in edges]), F.col("band") + 1)
    upper = F.element_at(F.array(*[F.lit(e) for e in edges]), F.col("band") + 2)
    bands = bands.select("band", lower.alias("band_lower"), upper.alias("band_upper"),
                         F.round(n_).cast("long").alias("pair_count"),
                         F.when(n_ > 0, x_ / n_).alias("similarity_mean"),
                         F.when(n_ > 0, y_ / n_).alias("outcome_match_rate"))
    return summary, bands


# --- M9, M10: metrics over a predictions table --------------------------------

def classification_metrics(pred: DataFrame, model_col: str = "model") -> DataFrame:
    """M9 per model: accuracy, precision, recall, F1 (0 on zero division) and
    ROC-AUC from average ranks (null when only one class is present).

    ``pred`` has model, label (0/1), score, prediction (0/1)."""
    base = pred.groupBy(model_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("label") == 1) & (F.col("prediction") == 1)).alias("tp"),
        F.count_if((F.col("label") == 0) & (F.col("prediction") == 1)).alias("fp"),
        F.count_if((F.col("label") == 0) & (F.col("prediction") == 0)).alias("tn"),
        F.count_if((F.col("label") == 1) & (F.col("prediction") == 0)).alias("fn"))
    per_score = pred.groupBy(model_col, "score").agg(F.count_if(F.col("label") == 1).alias("pos"),
                                                     F.count_if(F.col("label") == 0).alias("neg"))
    cum = running_sums(per_score, [model_col], [F.col("score")], ["neg"],
                       bucket=quantile_bucket(per_score, F.col("score")), inclusive=False)
    auc_num = cum.groupBy(model_col).agg(
        F.sum(F.col("pos") * F.col("cum_neg") + 0.5 * F.col("pos") * F.col("neg")).alias("u"),
        F.sum("pos").alias("n1"), F.sum("neg").alias("n0"))
    m = base.join(auc_num, model_col)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return m.select(
        model_col,
        ((tp + tn) / F.col("n")).alias("accuracy"),
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0)).alias("recall"),
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0)).alias("f1_score"),
        F.when((F.col("n1") > 0) & (F.col("n0") > 0),
               F.col("u") / (F.col("n1").cast("double") * F.col("n0").cast("double"))).alias("roc_auc"))


def confusion_matrix(pred: DataFrame, model_col: str = "model") -> DataFrame:
    """Tn, fp, fn, tp per model."""
    return pred.groupBy(model_col).agg(
        F.count_if((F.col("label") == 0) & (F.col("prediction") == 0)).alias("tn"),
        F.count_if((F.col("label") == 0) & (F.col("prediction") == 1)).alias("fp"),
        F.count_if((F.col("label") == 1) & (F.col("prediction") == 0)).alias("fn"),
        F.count_if((F.col("label") == 1) & (F.col("prediction") == 1)).alias("tp"))


def tune_threshold(scored: DataFrame, default: float = 0.5, min_rows: int = 20, min_positives: int = 2) -> DataFrame:
    """M7: threshold with the best accuracy, ties by F1, then the lowest
    threshold, over {default} and every score; ``default`` unless there are
    at least ``min_rows`` rows, ``min_positives`` positives and both classes
    (with ``min_positives=0`` any scores are tuned).

    Cumulative counts by score (descending) replace a rescan per threshold."""
    per = scored.groupBy("score").agg(F.count_if(F.col("label") == 1).alias("pos"),
                                      F.count_if(F.col("label") == 0).alias("neg"))
    spark = scored.sparkSession
    per = (per.unionByName(spark.range(1).select(F.lit(float(default)).alias("score"), F.lit(0).cast("long").alias("pos"),
                                                 F.lit(0).cast("long").alias("neg")))
           .groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
           .withColumn("g", F.lit(0)))
    cum = running_sums(per, ["g"], [-F.col("score")], ["pos", "neg"], bucket=quantile_bucket(per, -F.col("score")))
    tot = scored.agg(F.count(F.lit(1)).alias("N"), F.count_if(F.col("label") == 1).alias("N1"))
    c = cum.crossJoin(tot)  # single-row totals
    tp, fp = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    n1, n = F.col("N1").cast("double"), F.col("N").cast("double")
    n0 = n - n1
    acc = (tp + (n0 - fp)) / n
    f1 = F.when(2 * tp + fp + (n1 - tp) > 0, 2 * tp / (2 * tp + fp + (n1 - tp))).otherwise(F.lit(0.0))
    best = (c.select(F.col("score").alias("threshold"), acc.alias("accuracy"), f1.alias("f1_score"), "N", "N1")
            .orderBy(F.col("accuracy").desc(), F.col("f1_score").desc(), F.col("threshold").asc()).limit(1))
    eligible = (F.col("N") >= min_rows) & (F.col("N1") >= min_positives)
    if min_positives:
        eligible = eligible & (F.col("N1") < F.col("N"))
    return best.select(F.when(eligible, F.col("threshold")).otherwise(F.lit(float(default))).alias("threshold"),
                       F.when(eligible, F.col("accuracy")).alias("validation_accuracy"),
                       F.when(eligible, F.col("f1_score")).alias("validation_f1"),
                       eligible.alias("tuned"))


def residual_histogram(pred: DataFrame, bins: int = 30, model_col: str | None = None) -> DataFrame:
    """residual = label - score in equal-width bins between the minimum
    and maximum (last bin closed; a constant residual gets the +-0.5 range);
    empty bins are kept."""
    keys = [model_col] if model_col else []
    r = pred.select(*keys, (F.col("label") - F.col("score")).alias("r"))
    rng = r.groupBy(*keys).agg(F.min("r").alias("lo0"), F.max("r").alias("hi0"))
    rng = rng.select(*keys, F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                     F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    joined = r.join(rng, keys) if keys else r.crossJoin(rng)
    b = F.least(F.floor((F.col("r") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    counts = joined.groupBy(*keys, b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = pred.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    grid = rng.crossJoin(all_bins)  # (#models x bins) rows
    width = (F.col("hi") - F.col("lo")) / bins
    out = grid.join(counts, [*keys, "bin"], "left")
    return out.select(*keys, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lower"),
                      (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_upper"),
                      F.coalesce("count", F.lit(0)).cast("long").alias("count"))


# --- M11: stratified split ----------------------------------------------------

def stratified_split(df: DataFrame, label: str, test_size: float = 0.2, seed: int = 42,
                     id_col: str = "hadm_id") -> DataFrame:
    """Exact per-class test counts floor(n_c * test_size + 0.5), chosen by
    hash order; adds ``is_test``.  Rows without a label or id are left out.

    Only ids and labels are counted and ranked: counts of hash buckets name the
    one bucket of each class that holds its last test row, and that bucket alone
    is put in order.  The rows themselves then compare their hash with the edge
    of their class, so they are neither shuffled nor sorted."""
    known = df.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    keys = materialize(known.select(F.col(label).alias("_label"), F.col(id_col).alias("_id")))
    keys = keys.withColumn("_edge_h", hash_order("_id", seed)).withColumn("_b", md5_bucket(F.col("_edge_h"), hex_digits(keys.count())))
    by_class = Window.partitionBy("_label")
    buckets = (keys.groupBy("_label", "_b").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_before", F.sum("_n").over(by_class.orderBy("_b")) - F.col("_n"))
               .withColumn("_all", F.sum("_n").over(by_class)))
    n_test = F.least(F.floor(F.col("_all") * F.lit(float(test_size)) + 0.5), F.col("_all"))
    last = materialize(buckets.withColumn("_left", n_test - F.col("_before"))
                       .filter((F.col("_left") >= 1) & (F.col("_left") <= F.col("_n"))).select("_label", "_b", "_left"))
    edges = (keys.join(last, ["_label", "_b"]).groupBy("_label", "_left", "_edge_h", F.col("_id").alias("_edge_id"))
             .agg(F.count(F.lit(1)).alias("_same"))
             .withColumn("_left", F.col("_left") - F.sum("_same").over(by_class.orderBy("_edge_h", "_edge_id")) + F.col("_same")))
    # One row per class: written, so that its size is known and it is sent to the rows.
    edges = materialize(edges.filter((F.col("_left") >= 1) & (F.col("_left") <= F.col("_same"))).drop("_b"))
    h, same = hash_order(id_col, seed), F.col(id_col) == F.col("_edge_id")
    columns = [label, *[c for c in df.columns if c != label]]
    out = known.join(edges, F.col(label) == F.col("_label"), "left").withColumn(
        "is_test", F.coalesce((h < F.col("_edge_h")) | ((h == F.col("_edge_h")) & (F.col(id_col) <= F.col("_edge_id"))), F.lit(False)))
    columns += [c for c in ("is_test",) if c not in columns]
    if edges.filter("_left < _same").isEmpty():
        return out.select(*columns)
    # An id that comes several times stands at the edge: as many of its rows as are left.
    cut = F.coalesce(same & (F.col("_left") < F.col("_same")), F.lit(False))
    some = F.row_number().over(Window.partitionBy(label).orderBy(id_col)) <= F.col("_left")
    return out.filter(~cut).select(*columns).unionByName(out.filter(cut).withColumn("is_test", some).select(*columns))


def dataset_summary(joined: DataFrame, q: dict, sim_expr) -> DataFrame:
    """Rates and means of the joined dataset plus min / mean / max
    diagnosis similarity from one query row (one aggregation)."""
    s = sim_expr
    return joined.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("subject_id").alias("unique_subjects"),
        F.avg(F.col("mortality").cast("double")).alias("mortality_rate"),
        F.avg("los_days").alias("mean_los_days"),
        F.avg("diagnosis_count").alias("mean_diagnosis_count"),
        F.min(s).alias("min_similarity"), F.avg(s).alias("mean_similarity"), F.max(s).alias("max_similarity"))
