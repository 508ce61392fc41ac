"""Exact quantiles whose memory need does not grow with the data.

Spark's ``percentile`` keeps a value -> count map per group, which is the fastest way for
bounded groups. Beyond ``BOUNDED_ROWS`` rows the target rank is first bracketed with
the mergeable ``percentile_approx`` sketch (known rank error), rows outside the bracket
are only counted, and the exact answer is picked from what is left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custoria.session import materialize

BOUNDED_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000


def _clean(value: Column) -> Column:
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def exact_quantiles(
    df: DataFrame, wanted: dict[str, list[float]], bounded_rows: int = BOUNDED_ROWS, counts: dict[str, int] | None = None
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column: {column: probabilities} -> {column: values}.

    Nulls and NaN are left out. ``counts`` may give an upper bound of the rows per column, such as
    its non-null rows; where that is small it saves a counting pass.
    """
    columns = list(wanted)
    if not columns:
        return {}
    values = df.select([_clean(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(columns)])
    long = values.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("v")) for i in range(len(columns))])))
    if counts is not None and max(counts[c] for c in columns) <= bounded_rows:
        sizes = [counts[c] for c in columns]
    else:
        found = {r["i"]: r["n"] for r in long.where("v is not null").groupBy("i").agg(F.count("*").alias("n")).collect()}
        sizes = [found.get(i, 0) for i in range(len(columns))]
    if max(sizes) <= bounded_rows:
        # one bounded map per column, the columns in parallel
        every = sorted({q for probabilities in wanted.values() for q in probabilities})
        picked = long.where("v is not null").groupBy("i").agg(F.percentile("v", F.array(*map(F.lit, every))).alias("q")).collect()
        by_column = {r["i"]: dict(zip(every, r["q"])) for r in picked}
        return {c: [by_column[i][q] if i in by_column else None for q in wanted[c]] for i, c in enumerate(columns)}

    slots = {}
    for i, c in enumerate(columns):
        for j, q in enumerate(wanted[c]):
            if sizes[i]:
                position = (sizes[i] - 1) * q
                slots[(i, j)] = {
                    "column": f"v{i}", "low": -math.inf, "high": math.inf, "below": 0, "inside": sizes[i],
                    "first": math.floor(position), "last": math.ceil(position), "share": position - math.floor(position),
                }
    _narrow(values, slots, bounded_rows)
    picked = _pick(values, slots)
    return {
        c: [picked.get((i, j)) for j in range(len(wanted[c]))] for i, c in enumerate(columns)
    }


def known_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Rows per column that are neither null nor NaN."""
    if not columns:
        return {}
    return df.agg(*[F.count(_clean(F.col(f"`{c}`"))).alias(c) for c in columns]).first().asDict()


def even_quantiles(df: DataFrame, points: dict[str, int], bounded_rows: int = BOUNDED_ROWS) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles at ``points`` even probabilities from 0 to 1 per column, exact at any size.

    Beyond the bound, the values are counted and their counts added up in order without a single
    sorting task; each value then names the grid points whose rank it covers, so at most two
    rows per grid point come back.
    """
    from custoria.functions.ranking import running_totals

    columns, sizes = list(points), known_counts(df, list(points))
    if max(sizes.values(), default=0) <= bounded_rows:
        return exact_quantiles(df, {c: [i / max(1, p - 1) for i in range(p)] for c, p in points.items()}, bounded_rows, sizes)
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), _clean(F.col(f"`{c}`")).alias("v")) for i, c in enumerate(columns)])
    counted = df.select(F.inline(pairs)).where("v is not null").groupBy("i", "v").agg(F.count("*").alias("n"))
    running = running_totals(counted, ["v"], ["n"], ["i"], bounded_rows)

    def of_column(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(x).cast("bigint") for x in values]), F.col("i") + 1)

    # the ranks of grid point j lie around j * (rows - 1) / (points - 1); whole numbers keep this exact
    steps, last = of_column([max(1, p - 1) for p in points.values()]), of_column([max(1, sizes[c] - 1) for c in columns])
    low, high = F.col("run_n") - F.col("n"), F.col("run_n")
    named = running.withColumns({"_s": steps, "_l": last, "_a": low, "_b": high})
    ranges = {
        "floor": ("(_a * _s + _l - 1) div _l", "least((_b * _s + _l - 1) div _l - 1, _s)"),
        "ceil": ("if(_a = 0, 0, ((_a - 1) * _s) div _l + 1)", "least(((_b - 1) * _s) div _l, _s)"),
    }
    grid: dict[tuple[int, int], dict[str, float]] = {}
    for side, (first, final) in ranges.items():
        hits = named.withColumns({"_f": F.expr(first), "_t": F.expr(final)}).where("_f <= _t")
        for r in hits.select("i", "v", F.explode(F.sequence("_f", "_t")).alias("j")).collect():
            grid.setdefault((r["i"], r["j"]), {})[side] = r["v"]
    out: dict[str, list[float | None]] = {}
    for i, (c, p) in enumerate(points.items()):
        out[c] = []
        for j in range(p):
            ends = grid.get((i, j))
            share = (j * (sizes[c] - 1)) % max(1, p - 1) / max(1, p - 1)
            out[c].append(None if ends is None else ends["floor"] + (ends["ceil"] - ends["floor"]) * share)
    return out


def _inside(slot: dict) -> Column:
    return F.col(slot["column"]).between(F.lit(slot["low"]), F.lit(slot["high"]))


def _narrow(values: DataFrame, slots: dict, bounded_rows: int) -> None:
    """Shrink each slot's value bracket until few rows are inside, or only ties are left."""
    open_slots = {k for k, s in slots.items() if s["inside"] > bounded_rows}
    while open_slots:
        keys = sorted(open_slots)
        # slots that look at the same rows share one sketch
        asked: dict[tuple, list[float]] = {}
        places = {}
        for k in keys:
            slot, slack = slots[k], 2.0 / SKETCH_ACCURACY
            low = max(0.0, (slot["first"] - slot["below"]) / slot["inside"] - slack)
            high = min(1.0, (slot["last"] + 1 - slot["below"]) / slot["inside"] + slack)
            ranks = asked.setdefault((slot["column"], slot["low"], slot["high"]), [])
            places[k] = (slot["column"], slot["low"], slot["high"]), len(ranks)
            ranks += [low, high]
        sketches = [
            F.percentile_approx(F.when(F.col(column).between(F.lit(low), F.lit(high)), F.col(column)), ranks, SKETCH_ACCURACY).alias(f"b{i}")
            for i, ((column, low, high), ranks) in enumerate(asked.items())
        ]
        sketched = dict(zip(asked, values.agg(*sketches).first()))
        brackets = {k: sketched[rows][at : at + 2] for k, (rows, at) in places.items()}
        checks = []
        for i, k in enumerate(keys):
            low, high = brackets[k]
            v = F.col(slots[k]["column"])
            checks += [F.count_if(v < low).alias(f"below{i}"), F.count_if(v.between(low, high)).alias(f"in{i}")]
        seen = values.agg(*checks).first()
        for i, k in enumerate(keys):
            slot, (low, high) = slots[k], brackets[k]
            below, inside = seen[2 * i], seen[2 * i + 1]
            covers = below <= slot["first"] and slot["last"] < below + inside
            if covers and inside < slot["inside"]:
                slot.update(low=low, high=high, below=below, inside=inside)
                if inside <= bounded_rows or low == high:
                    open_slots.discard(k)
            else:  # no further progress: the bracket holds a few heavily repeated values
                open_slots.discard(k)


def _pick(values: DataFrame, slots: dict) -> dict:
    keys = sorted(slots)
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), F.when(_inside(slots[k]), F.col(slots[k]["column"])).alias("value"))
            for i, k in enumerate(keys)
        ]
    )
    counted = (
        values.select(F.inline(rows)).where("value is not null").groupBy("slot", "value").agg(F.count("*").alias("n"))
    )
    running = F.sum("n").over(W.partitionBy("slot").orderBy("value"))
    spark = values.sparkSession
    bounds = spark.createDataFrame(
        [(i, slots[k]["first"] - slots[k]["below"], slots[k]["last"] - slots[k]["below"]) for i, k in enumerate(keys)],
        "slot int, first bigint, last bigint",
    )
    # one bounded row per requested quantile on the small side
    hits = (
        counted.withColumn("upto", running)
        .join(F.broadcast(bounds), "slot")
        .where("(upto > first and upto - n <= first) or (upto > last and upto - n <= last)")
        .collect()
    )
    out = {}
    for i, k in enumerate(keys):
        mine = sorted(h["value"] for h in hits if h["slot"] == i)
        out[k] = mine[0] + (mine[-1] - mine[0]) * slots[k]["share"]
    return out


def hot_groups(df: DataFrame, keys: list[str], bounded_rows: int = BOUNDED_ROWS) -> DataFrame | None:
    """Keys of the groups too large for one task's value map; None when there are none.

    The bound is the same for any table; the number of such keys is the rows over the bound at most.
    """
    if df.count() <= bounded_rows:
        return None
    hot = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > bounded_rows).drop("_n")
    hot = materialize(hot.withColumn("_hot", F.lit(True)))
    return None if hot.isEmpty() else hot


def aggregate_with_medians(
    df: DataFrame, keys: list[str], aggregates: list[Column], medians: dict[str, str], bounded_rows: int = BOUNDED_ROWS
) -> DataFrame:
    """``groupBy(keys).agg(aggregates + medians)`` that no oversized group can overload.

    Without hot groups this is one plain aggregation. With them, hot rows stay out of the
    per-group value maps and their medians come from bracketed counting.
    """
    hot = hot_groups(df, keys, bounded_rows) if medians else None
    if hot is None:
        return df.groupBy(*keys).agg(*aggregates, *[F.median(_clean(F.col(c))).alias(a) for a, c in medians.items()])
    flagged = df.join(hot, keys, "left")
    cold = [F.median(F.when(F.col("_hot").isNull(), _clean(F.col(c)))).alias(a) for a, c in medians.items()]
    out = flagged.groupBy(*keys).agg(*aggregates, *cold)
    for alias, column in medians.items():
        found = _hot_median(flagged.where("_hot"), keys, column).withColumnRenamed("_median", "_hot_median")
        out = (
            out.join(found, keys, "left")
            .withColumn(alias, F.coalesce(alias, "_hot_median"))
            .drop("_hot_median")
        )
    return out


def _hot_median(rows: DataFrame, keys: list[str], column: str, rounds: int = 2) -> DataFrame:
    """Exact median of a few huge groups: bracket twice, then walk the value counts inside."""
    base = rows.select(*keys, _clean(F.col(column)).alias("_v")).where("_v is not null")
    state = base.groupBy(*keys).agg(F.count("*").alias("_n")).select(
        *keys, "_n",
        F.lit(0).cast("bigint").alias("_below"), F.col("_n").alias("_in"),
        F.lit(-math.inf).alias("_low"), F.lit(math.inf).alias("_high"),
    )
    first, last = F.expr("(_n - 1) div 2"), F.expr("_n div 2")
    for _ in range(rounds):
        state = materialize(state)
        slack = 2.0 / SKETCH_ACCURACY
        grid = base.join(state, keys).where("_v between _low and _high")
        # the sketch takes constant ranks only, so ask for an even grid and pick the bracket
        ranks = [i / 1000 for i in range(1001)]
        sketch = grid.groupBy(*keys).agg(F.percentile_approx("_v", ranks, SKETCH_ACCURACY).alias("_grid"))
        at_low = F.greatest(F.lit(0), F.floor(((first - F.col("_below")) / F.col("_in") - slack) * 1000)).cast("int")
        at_high = F.least(F.lit(1000), F.ceil(((last + 1 - F.col("_below")) / F.col("_in") + slack) * 1000)).cast("int")
        narrowed = state.join(sketch, keys).select(
            *keys, "_n", F.col("_below").alias("_below0"), F.col("_in").alias("_in0"),
            F.col("_low").alias("_low0"), F.col("_high").alias("_high0"),
            F.element_at("_grid", at_low + 1).alias("_low"), F.element_at("_grid", at_high + 1).alias("_high"),
        )
        counted = base.join(materialize(narrowed), keys).groupBy(*keys).agg(
            F.first("_n").alias("_n"),
            *[F.first(c).alias(c) for c in ("_below0", "_in0", "_low0", "_high0", "_low", "_high")],
            F.count_if(F.col("_v") < F.col("_low")).alias("_below"),
            F.count_if(F.col("_v").between(F.col("_low"), F.col("_high"))).alias("_in"),
        )
        covers = (F.col("_below") <= first) & (last < F.col("_below") + F.col("_in"))
        state = counted.select(
            *keys, "_n", *[F.when(covers, F.col(c)).otherwise(F.col(f"{c}0")).alias(c) for c in ("_below", "_in", "_low", "_high")]
        )
    state = materialize(state)
    inside = base.join(state, keys).where("_v between _low and _high")
    counts = inside.groupBy(*keys, "_v", "_n", "_below").agg(F.count("*").alias("_c"))
    upto = F.col("_below") + F.sum("_c").over(W.partitionBy(*keys).orderBy("_v"))
    walked = counts.withColumn("_upto", upto)
    at = (F.col("_upto") > first) & (F.col("_upto") - F.col("_c") <= last)
    return walked.where(at).groupBy(*keys).agg(((F.min("_v") + F.max("_v")) / 2).alias("_median"))
