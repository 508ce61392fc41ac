"""Quality rules: hashed n-gram likelihood ratio of trusted text against the raw corpus.

DataFrame functions only. The words and word pairs of all documents are hashed into a fixed
number of buckets and counted, those of trusted documents apart. The logarithm of the
ratio of the two smoothed multinomials, averaged over the n-grams of a document, is its score.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custoria.llm.common import columns_of, rows_of
from custoria.session import materialize

#: Buckets of the hashed n-grams; the table of ratios is this long at any corpus size.
BUCKETS = 1 << 16
#: Labelled documents of each class that are used for fitting: those whose hashed id is smallest. The ratios come
#: from the trusted ones with an even hash, the threshold from all with an odd one, which the ratios have not seen.
LABELLED = 20_000
#: Added to each bucket's count.
SMOOTHING = 1.0
#: Share of the trusted sample that the threshold may lose at most, and the scores' grid.
LOST, GRID = 0.002, 1000
WORD = r"[^\x20\x09-\x0D]+"


def _words(column: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit(WORD), F.lit(0))


def base_features(df: DataFrame, column: str = "text") -> DataFrame:
    """(``row``, ``text``, ``codes``, counts): each row of ``df`` with the hashes of its words and n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = rows_of(df, column).withColumn("words", _words("text")).withColumn("lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)))
    coded = named.withColumn("codes", F.transform("words", lambda w: F.xxhash64(w)))
    counted = coded.withColumn("n", F.size("codes"))
    at = F.sequence(F.lit(0), F.greatest(F.col("n") - 3, F.lit(0)))
    threes = F.when(F.col("n") >= 3, F.transform(at, lambda i: F.xxhash64(F.get("codes", i), F.get("codes", i + 1), F.get("codes", i + 2))))
    shingled = counted.withColumn("threes", threes)
    distinct = F.size(F.array_distinct("threes"))
    # windows in the order of their hash, each with its place; equal ones stand side by side
    placed = F.when(distinct < F.size("threes"), F.array_sort(F.transform("threes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ordered = shingled.withColumn("placed", placed)
    twice = F.filter(
        F.transform("placed", lambda x, k: F.when((x["h"] == F.get("placed", k - 1)["h"]) | (x["h"] == F.get("placed", k + 1)["h"]), x["i"])),
        lambda i: i.isNotNull(),
    )
    repeated = ordered.withColumn("at", F.array_sort(twice))
    covered = F.aggregate(F.transform("at", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - i, F.lit(3)))), F.lit(0).cast("long"), lambda a, b: a + b)
    return repeated.select(
        "row",
        "text",
        "codes",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    """Fewer than 50 words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _score(ratios: Column, buckets: int) -> Column:
    """Mean ratio over the words and word pairs in ``codes``; null without words."""
    pairs = F.zip_with(
        "codes", F.slice("codes", 2, F.greatest(F.size("codes"), F.lit(1))),
        lambda a, b: F.get(ratios, F.pmod(a, F.lit(buckets)).cast("int")) + F.when(b.isNotNull(), F.get(ratios, F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"))).otherwise(0.0),
    )
    return F.when(F.size("codes") > 0, F.aggregate(pairs, F.lit(0.0), lambda x, y: x + y) / (2 * F.size("codes") - 1))


@dataclass(frozen=True)
class Fitted:
    """Logarithm of the ratio of each bucket, and the lowest score that is kept (None: all)."""

    ratios: list[float]
    threshold: float | None

    def column(self) -> Column:
        return F.from_json(F.lit(json.dumps(self.ratios)), "array<double>")


def labelled_sample(labels: DataFrame, id_column: str, bound: int) -> DataFrame:
    """At most ``bound`` ids of each class (1 trusted, 0 not); labels that are null or contradict each other are left out."""
    plain = labels.where(F.col(id_column).isNotNull() & F.col("quality").isin(0, 1)).groupBy(id_column).agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    each = [
        plain.where((F.col("low") == v) & (F.col("high") == v)).orderBy(F.xxhash64(id_column), id_column).limit(bound).select(F.col(id_column).alias("_labelled"), F.lit(v).alias("_quality"), (F.pmod(F.xxhash64(id_column), F.lit(2)) == 0).alias("_counted"))
        for v in (0, 1)
    ]
    return each[0].unionByName(each[1])


def fit(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", column: str = "text", buckets: int = BUCKETS, bound: int = LABELLED) -> Fitted:
    """Counts over every document, the trusted ones among the labelled sample apart, and the threshold.

    The sample's ids are bounded, so they are broadcast and no text is shuffled; n-gram counts
    combine in each task to one row per bucket and come to the driver as three columns. The threshold is the score between the
    two classes of the sample that errs least, but never loses more than LOST of the
    trusted ones. Without trusted documents, or
    when no score tells the classes apart, nothing is rejected.
    """
    sample = F.broadcast(materialize(labelled_sample(labels, id_column, bound)))
    plain = df.select(df[id_column].alias("id"), df[column].alias("text"))
    tagged = plain.join(sample, F.col("id") == F.col("_labelled"), "left")
    words = tagged.select(F.coalesce((F.col("_quality") == 1) & F.col("_counted"), F.lit(False)).alias("trusted"), _words("text").alias("w"))
    pairs = words.select("trusted", F.explode(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("b"))).alias("p")).select("trusted", F.xxhash64("p.a").alias("a"), F.when(F.col("p.b").isNotNull(), F.xxhash64("p.b")).alias("b"))
    grams = pairs.select("trusted", F.explode(F.array(F.col("a"), F.when(F.col("b").isNotNull(), F.xxhash64("a", "b")))).alias("g")).where("g IS NOT NULL")
    counts = grams.groupBy(F.pmod("g", F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"), F.count_if("trusted").alias("good")).toArrow()
    raw, good = [0] * buckets, [0] * buckets
    for bucket, n, n_good in zip(*(column.to_pylist() for column in counts.columns)):
        raw[bucket], good[bucket] = n, n_good
    if not sum(good):
        return Fitted([0.0], None)
    all_good, all_raw = sum(good) + SMOOTHING * buckets, sum(raw) + SMOOTHING * buckets
    ratios = [round(log((g + SMOOTHING) / all_good) - log((r + SMOOTHING) / all_raw), 9) for g, r in zip(good, raw)]
    shown = plain.join(sample.where("NOT _counted"), F.col("id") == F.col("_labelled")).select("_quality", _words("text").alias("_words"))
    coded = shown.select("_quality", F.transform("_words", lambda w: F.xxhash64(w)).alias("codes")).where(F.size("codes") >= 50)
    scored = coded.select("_quality", F.floor(_score(Fitted(ratios, None).column(), buckets) * GRID).alias("cell"))
    histogram = sorted((cell, quality, n) for quality, cell, n in scored.groupBy("_quality", "cell").agg(F.count("*").alias("n")).collect())
    return Fitted(ratios, _threshold(histogram))


def _threshold(histogram: list[tuple[int, int, int]]) -> float | None:
    """The score with the fewest errors by class share, among those that lose few trusted documents.

    It lies halfway between the occupied cells of the grid around it.
    """
    totals = {q: sum(n for _, x, n in histogram if x == q) for q in (0, 1)}
    if not totals[1]:
        return None
    lost = caught = 0
    cells = sorted({cell for cell, _, _ in histogram})
    by_cell = {(cell, q): n for cell, q, n in histogram}
    best, below = (0.0, None), None
    for cell in cells:
        # documents below the cell go
        if lost / totals[1] <= LOST:
            gain = (caught / totals[0] if totals[0] else 0.0) - lost / totals[1]
            if gain > best[0]:
                best = (gain, (cell + below + 1) / 2 / GRID)
        lost += by_cell.get((cell, 1), 0)
        caught += by_cell.get((cell, 0), 0)
        below = cell
    return best[1]


def judge(df: DataFrame, fitted: Fitted, column: str = "text") -> DataFrame:
    """``df`` with the base counts, ``base_failed``, ``quality_score`` and ``kept``.

    A null or empty text has no words: its counts are 0, its score is null and it is not kept.
    Columns of these names are replaced. Use ``keep`` to filter: a filter right behind this
    function would be moved below it and work everything out once more.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality_score", "kept"]
    plain = df.drop(*new)
    featured = base_features(plain, column)
    scored = featured.withColumn("base_failed", base_failed()).withColumn("quality_score", _score(fitted.column(), len(fitted.ratios)))
    verdict = F.lit(True) if fitted.threshold is None else F.coalesce(F.col("quality_score") >= F.lit(fitted.threshold), F.lit(False))
    judged = scored.withColumn("kept", ~F.col("base_failed") & verdict)
    return judged.select(*columns_of(plain.columns, column), *new)


def keep(df: DataFrame, fitted: Fitted, column: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept; the judged rows are stored first."""
    judged = materialize(judge(rows_of(df, column), fitted).select("row", "text", "kept"))
    return judged.where("kept").select(*columns_of(df.columns, column))
