"""Class balancing over frames of (id, features array<double>, label).

"Random" choices are md5 based, hence the same on every run. Results keep the input
columns and say which rows are synthetic.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custoria.constants import HIGH_CARDINALITY, SEED
from custoria.functions.columns import hash_order, hash_unit
from custoria.functions.ranking import row_positions
from custoria.operators.encoding import listed_values
from custoria.operators.fitting import fitted
from custoria.operators.metrics import classification_metrics, roc_auc
from custoria.operators.neighbours import nearest
from custoria.operators.selection import forest, positive_score
from custoria.operators.split import class_counts, cut_classes, with_folds
from custoria.session import materialize

DRAWS_PER_ROW = 1000

# ---------------------------------------------------------------- reports and weights


def imbalance_report(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share per class, the ratio of largest to smallest, and which class is which."""
    counts = {c: n for c, n in class_counts(df, label).items() if c is not None}
    total, most, least = sum(counts.values()), max(counts.values()), min(counts.values())
    small = min(c for c, n in counts.items() if n == least)
    large = min(c for c, n in counts.items() if n == most)
    rows = [(c, n, 100.0 * n / total, most / least, c == small, c == large) for c, n in sorted(counts.items())]
    kind = dict(df.dtypes)[label]
    return df.sparkSession.createDataFrame(
        rows, f"class {kind}, n bigint, percentage double, imbalance_ratio double, is_minority boolean, is_majority boolean"
    )


def distribution_change(before: DataFrame, after: DataFrame, label: str = "label") -> DataFrame:
    """The imbalance report before and after balancing, one under the other."""
    first, second = imbalance_report(before, label), imbalance_report(after, label)
    return first.withColumn("stage", F.lit("original")).unionByName(second.withColumn("stage", F.lit("balanced")))


def class_weights(df: DataFrame, label: str = "label", strategy: str = "balanced") -> DataFrame:
    """(class, weight): n / (classes * n_c), or the root of largest over own size."""
    counts = {c: n for c, n in class_counts(df, label).items() if c is not None}
    total, most = sum(counts.values()), max(counts.values())
    rule = {"balanced": lambda n: total / (len(counts) * n), "custom": lambda n: (most / n) ** 0.5}[strategy]
    rows = [(c, rule(n)) for c, n in sorted(counts.items())]
    return df.sparkSession.createDataFrame(rows, f"class {dict(df.dtypes)[label]}, weight double")


def sample_weights(df: DataFrame, label: str = "label", strategy: str = "balanced") -> DataFrame:
    """Add the weight of the row's class."""
    weights = class_weights(df, label, strategy).withColumnRenamed("class", label)
    return df.join(F.broadcast(weights), label, "left")  # one row per class


def _classes(df: DataFrame) -> tuple:
    """(minority, majority, their counts)."""
    counts = {c: n for c, n in class_counts(df, "label").items() if c is not None}
    small, large = min(counts, key=lambda c: (counts[c], c)), max(counts, key=lambda c: (counts[c], -c))
    return small, large, counts


# ---------------------------------------------------------------- undersampling


def undersample_random(df: DataFrame, seed: int = SEED) -> DataFrame:
    """As many rows of every class as the smallest has, the first in md5 order."""
    df = df.where(F.col("label").isNotNull())  # rows without a label are of no class

    def parts(counts: dict) -> dict:
        return {c: [("keep", min(counts.values()))] for c in counts}

    return cut_classes(df, "label", "id", parts, "drop", seed, "_part").where("_part = 'keep'").drop("_part")


def tomek_links(df: DataFrame) -> DataFrame:
    """(id, neighbour) pairs that are each other's nearest row and differ in class; both directions."""
    first = materialize(nearest(df, df, 1, exclude_self=True, carry=["label"]).select("id", "neighbour", "neighbour_label"))
    # row i says its neighbour's class, the neighbour's row says i's
    back = first.select(F.col("id").alias("neighbour"), F.col("neighbour").alias("id"), F.col("neighbour_label").alias("_own"))
    return first.join(back, ["id", "neighbour"]).where("neighbour_label <> _own").select("id", "neighbour")


def undersample_tomek(df: DataFrame, both_classes: bool = False) -> DataFrame:
    """Without the members of Tomek links, by default only those outside the minority."""
    small, _, _ = _classes(df)
    doomed = tomek_links(df).select("id")
    if not both_classes:
        doomed = doomed.join(df.where(F.col("label") != small).select("id"), "id")
    return df.join(doomed, "id", "left_anti").select(df.columns)


def undersample_enn(df: DataFrame, both_classes: bool = False, k: int = 3) -> DataFrame:
    """Without rows whose k nearest neighbours are not all of their own class."""
    small, _, _ = _classes(df)
    judged = df if both_classes else df.where(F.col("label") != small)
    found = nearest(judged, df, k, exclude_self=True, carry=["label"])
    around = found.groupBy("id").agg(F.min("neighbour_label").alias("_low"), F.max("neighbour_label").alias("_high"))
    mixed = around.join(judged.select("id", "label"), "id").where("_low <> label or _high <> label").select("id")
    return df.join(mixed, "id", "left_anti").select(df.columns)


def undersample_nearmiss(df: DataFrame, k: int = 3) -> DataFrame:
    """All minority rows and as many others per class, those nearest on average to k minority rows."""
    small, _, counts = _classes(df)
    minority = df.where(F.col("label") == small)
    kept = [minority]
    for c in counts:
        if c != small:
            mine = df.where(F.col("label") == c)
            mean = nearest(mine, minority, k).groupBy("id").agg(F.avg("distance").alias("_mean"))
            best = row_positions(mean, ["_mean", "id"]).where(F.col("position") <= counts[small]).select("id")
            kept.append(mine.join(best, "id", "left_semi").select(df.columns))
    out = kept[0].select(df.columns)
    for part in kept[1:]:
        out = out.unionByName(part)
    return out


# ---------------------------------------------------------------- oversampling


def _even_shares(bases: DataFrame, total: int, seed: int) -> DataFrame:
    """(id, draws): ``total`` draws spread evenly, the remainder in md5 order."""
    placed = materialize(row_positions(bases.select("id", hash_order("id", seed=seed).alias("_h")), ["_h", "id"]))
    n = placed.count()
    if n == 0:
        return placed.select("id", F.lit(0).alias("draws")).where("false")
    return placed.select("id", (F.lit(total // n) + (F.col("position") <= total % n).cast("int")).cast("int").alias("draws"))


def _interpolate(draws: DataFrame, minority: DataFrame, neighbours: DataFrame, seed: int) -> DataFrame:
    """Synthetic rows (id, draw, neighbour, features): a point between the base and one of its neighbours."""
    degree = neighbours.groupBy("id").agg(F.max("rank").alias("_k"))
    # many draws of one base spread over rows of bounded length
    parts = draws.where("draws > 0").join(degree, "id").withColumn("_c", F.explode(F.expr(f"sequence(0, (draws - 1) div {DRAWS_PER_ROW})")))
    numbers = F.expr(f"sequence(_c * {DRAWS_PER_ROW} + 1, least(draws, (_c + 1) * {DRAWS_PER_ROW}))")
    asked = parts.repartition("id", "_c").withColumn("draw", F.explode(numbers.cast("array<int>"))).drop("_c")
    pick = F.floor(hash_unit("id", "draw", F.lit("neighbour"), seed=seed) * F.col("_k")).cast("int") + 1
    chosen = asked.select("id", "draw", pick.alias("rank")).join(neighbours.select("id", "rank", "neighbour"), ["id", "rank"])
    step = hash_unit("id", "draw", F.lit("step"), seed=seed)
    ends = chosen.join(minority.select("id", F.col("features").alias("_x")), "id").join(
        minority.select(F.col("id").alias("neighbour"), F.col("features").alias("_y")), "neighbour"
    )
    between = F.zip_with("_x", "_y", lambda x, y: x + F.col("_u") * (y - x))
    return ends.withColumn("_u", step).select("id", "draw", "neighbour", between.alias("features"))


def _append(df: DataFrame, synthetic: DataFrame, small) -> DataFrame:
    """Originals, then synthetic rows named <base>#<draw>."""
    originals = df.select(F.col("id").cast("string").alias("id"), "features", "label", F.lit(False).alias("synthetic"))
    kind = dict(df.dtypes)["label"]
    made = synthetic.select(
        F.concat_ws("#", F.col("id").cast("string"), F.col("draw").cast("string")).alias("id"), "features",
        F.lit(small).cast(kind).alias("label"), F.lit(True).alias("synthetic"),
    )
    return originals.unionByName(made)


def oversample_smote(df: DataFrame, k: int = 5, seed: int = SEED) -> DataFrame:
    """Minority raised to the majority's size with points between minority neighbours."""
    small, large, counts = _classes(df)
    minority = materialize(df.where(F.col("label") == small).select("id", "features"))
    found = materialize(nearest(minority, minority, k, exclude_self=True))
    draws = _even_shares(minority, counts[large] - counts[small], seed)
    return _append(df, _interpolate(draws, minority, found, seed), small)


def oversample_borderline(df: DataFrame, k: int = 5, m: int = 10, seed: int = SEED) -> DataFrame:
    """SMOTE from the minority rows in danger: at least half, not all, of m neighbours are of the majority."""
    small, large, counts = _classes(df)
    minority = materialize(df.where(F.col("label") == small).select("id", "features"))
    around = nearest(minority, df, m, exclude_self=True, carry=["label"])
    foreign, near = F.count_if(F.col("neighbour_label") != small), F.count("*")
    danger = around.groupBy("id").agg(foreign.alias("_f"), near.alias("_n")).where("_f >= _n / 2 and _f < _n").select("id")
    found = materialize(nearest(minority, minority, k, exclude_self=True))
    draws = _even_shares(danger, counts[large] - counts[small], seed)
    return _append(df, _interpolate(draws, minority, found, seed), small)


def oversample_adasyn(df: DataFrame, k: int = 5, seed: int = SEED) -> DataFrame:
    """More synthetic rows where more neighbours are of the majority."""
    small, large, counts = _classes(df)
    minority = materialize(df.where(F.col("label") == small).select("id", "features"))
    around = nearest(minority, df, k, exclude_self=True, carry=["label"])
    shares = materialize(around.groupBy("id").agg((F.count_if(F.col("neighbour_label") != small) / F.count("*")).alias("_share")))
    total = shares.agg(F.sum("_share")).first()[0]
    if not total:
        return _append(df, minority.select("id", F.lit(0).alias("draw"), "features").where("false"), small)
    wanted = counts[large] - counts[small]
    draws = shares.select("id", F.rint(F.col("_share") / total * wanted).cast("int").alias("draws"))
    found = materialize(nearest(minority, minority, k, exclude_self=True))
    return _append(df, _interpolate(draws, minority, found, seed), small)


def oversample_smote_mixed(df: DataFrame, categories: list[str], k: int = 5, seed: int = SEED) -> DataFrame:
    """SMOTE with text columns: a mismatch counts half the median spread per side, new rows take the neighbours' mode."""
    small, large, counts = _classes(df)
    minority = materialize(df.where(F.col("label") == small).select("id", "features", *categories))
    width = minority.select(F.size("features")).first()[0]
    spreads = minority.agg(*[F.stddev_pop(F.col("features")[i]).alias(f"s{i}") for i in range(width)]).first()
    median = sorted(s or 0.0 for s in spreads)
    middle = (median[(width - 1) // 2] + median[width // 2]) / 2
    values = listed_values(minority, categories)
    if any(len(v) > HIGH_CARDINALITY for v in values.values()):
        raise ValueError(f"a category column has more than {HIGH_CARDINALITY} values")
    flags: list[Column] = [
        F.when(F.col(c).eqNullSafe(F.lit(v)), F.lit(middle / 2)).otherwise(0.0) for c in categories for v in values[c]
    ]
    widened = minority.withColumn("features", F.concat("features", F.array(*flags)) if flags else F.col("features"))
    found = materialize(nearest(widened, widened, k, exclude_self=True, carry=categories))
    draws = _even_shares(minority, counts[large] - counts[small], seed)
    made = _interpolate(draws, minority, found, seed)
    # k rows per id, so the mode's map is that small
    modes = found.groupBy("id").agg(*[F.mode(f"neighbour_{c}", True).alias(c) for c in categories])
    made = made.join(modes, "id")
    kind = dict(df.dtypes)["label"]
    originals = df.select(F.col("id").cast("string").alias("id"), "features", "label", *categories, F.lit(False).alias("synthetic"))
    return originals.unionByName(made.select(
        F.concat_ws("#", F.col("id").cast("string"), F.col("draw").cast("string")).alias("id"), "features",
        F.lit(small).cast(kind).alias("label"), *categories, F.lit(True).alias("synthetic"),
    ))


def balance_combined(df: DataFrame, method: str = "smote_tomek", seed: int = SEED) -> DataFrame:
    """SMOTE, then Tomek or nearest-neighbour cleaning of both classes."""
    grown = materialize(oversample_smote(df, seed=seed))
    cleaners = {"smote_tomek": undersample_tomek, "smote_enn": undersample_enn}
    return cleaners[method](grown, both_classes=True)


def adaptive_method(ratio: float) -> str:
    return "smote_tomek" if ratio > 10 else "adasyn" if ratio > 5 else "borderline" if ratio > 3 else "smote"


METHODS = {
    "none": lambda df: df.withColumn("id", F.col("id").cast("string")).withColumn("synthetic", F.lit(False)),
    "smote": oversample_smote,
    "borderline": oversample_borderline,
    "adasyn": oversample_adasyn,
    "smote_tomek": balance_combined,
    "smote_enn": lambda df: balance_combined(df, "smote_enn"),
    "undersample": lambda df: undersample_random(df).withColumn("id", F.col("id").cast("string")).withColumn("synthetic", F.lit(False)),
}


def balance_adaptive(df: DataFrame) -> DataFrame:
    """The method that suits the ratio of the classes."""
    small, large, counts = _classes(df)
    return METHODS[adaptive_method(counts[large] / counts[small])](df)


def balance_cv(df: DataFrame, methods: list[str], folds: int = 5, trees: int = 100, seed: int = SEED, parallelism: int = 8) -> DataFrame:
    """Mean and deviation of AUC and F1 per method; only the training folds are balanced.

    ``parallelism`` pairs of method and fold are balanced and fitted at a time; all are ranked in one job.
    """
    data = materialize(with_folds(df, "label", "id", folds, seed))
    as_vector = lambda d: d.select(F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features"))

    def score(pair: tuple[str, int]) -> DataFrame:
        method, fold = pair
        train, held = data.where(F.col("fold") != fold).drop("fold"), data.where(F.col("fold") == fold)
        balanced = materialize(METHODS[method](train))
        model = fitted(forest(trees, seed=seed), as_vector(balanced))
        scored = positive_score(model.transform(as_vector(held))).select("label", "prediction", "score")
        return materialize(scored.select(F.lit(method).alias("method"), F.lit(fold).alias("fold"), "label", "prediction", "score"))

    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(score, [(method, fold) for method in dict.fromkeys(methods) for fold in range(folds)]))
    scored, by = parts[0], ["method", "fold"]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    aucs = {(r["method"], r["fold"]): r["auc_roc"] for r in roc_auc(scored, "label", "score", by).collect()}
    f1s = {(r["method"], r["fold"]): r["f1"] for r in classification_metrics(scored, "label", "prediction", by).collect()}
    rows = [(method, fold, aucs[method, fold], f1s[method, fold]) for method, fold in sorted(aucs)]
    scores = df.sparkSession.createDataFrame(rows, "method string, fold int, auc double, f1 double")
    out = scores.groupBy("method").agg(
        F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"), F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std")
    )
    best = out.agg(F.max_by("method", F.struct("auc_mean", "method")).alias("best_method"))
    return out.withColumn("_k", F.lit(1)).join(best.withColumn("_k", F.lit(1)), "_k").drop("_k")
