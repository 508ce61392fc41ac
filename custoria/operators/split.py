"""Stratified splits that are exact per class, reproducible and need no shuffle of the wide rows."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custoria.constants import SEED, SPLIT_SHARES
from custoria.functions.columns import hash_order

#: Hex digits of the hash that one pass counts by, and rows of a range that are looked at one by one.
DIGITS, FEW_ROWS = 4, 10_000


def class_counts(df: DataFrame, label: str) -> dict:
    return {r["_label"]: r["n"] for r in df.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("n")).collect()}


def cut_classes(
    df: DataFrame, label: str, key: str, parts: Callable[[dict], dict[object, list[tuple[str, int]]]], rest: str, seed: int = SEED,
    name: str = "part", few_rows: int = FEW_ROWS,
) -> DataFrame:
    """Add the part of each row: within its class, in md5 order, up to (part, last row) boundaries.

    ``parts`` gives them from the rows per class. The boundary rows are found by counting rows per class and leading hex digits of
    the hash: each pass looks into the ranges that hold a boundary, until one has few rows. So nothing
    is ordered and no copy is made; the rows are compared with those few values.
    """
    order = hash_order(key, seed=seed)
    slim = df.select(F.col(label).alias("_label"), order.alias("_hash"), F.col(key).cast("string").alias("_key"))

    def histogram(rows: DataFrame, depth: int, digits: int) -> dict:
        counted = rows.groupBy("_label", F.substring("_hash", 1, depth + digits).alias("_range")).agg(F.count("*").alias("n")).collect()
        found: dict = {}
        for r in counted:
            found.setdefault((r["_label"], r["_range"][:depth] if r["_range"] else ""), []).append((r["_range"] or "", r["n"]))
        return found

    def within(ranges: set) -> Column:
        """Rows of one of the (class, leading digits)."""
        test = F.lit(False)
        for value, lead in ranges:
            test = test | (F.col("_label").eqNullSafe(F.lit(value)) & F.col("_hash").startswith(lead))
        return test

    depth = DIGITS
    counted = histogram(slim, 0, depth)
    counts = {value: sum(n for _, n in held) for (value, _), held in counted.items()}
    # boundaries as (class, part, leading digits, rows that still lie before it in their range)
    open_cuts, start = [], {}
    for value, cuts in parts(counts).items():
        for part, end in cuts:
            if start.get(value, 0) < end:
                open_cuts.append((value, part, "", end))
                start[value] = end
    while True:
        narrowed, largest = [], 0
        for value, part, lead, left in open_cuts:
            for longer, n in sorted(counted[value, lead]):
                if left <= n:
                    narrowed.append((value, part, longer, left))
                    largest = max(largest, n)
                    break
                left -= n
        open_cuts = narrowed
        if largest <= few_rows or depth >= 32:
            break
        counted = histogram(slim.where(within({(v, lead) for v, _, lead, _ in open_cuts})), depth, DIGITS)
        depth += DIGITS
    ranges = {(v, lead) for v, _, lead, _ in open_cuts}
    last = slim.where(within(ranges)).groupBy("_label", "_hash", "_key").agg(F.count("*").alias("n")).collect() if ranges else []
    mine, assigned = F.struct(order.alias("h"), F.col(key).cast("string").alias("k")), F.lit(rest)
    for value, part, lead, left in reversed(open_cuts):
        for r in sorted((r for r in last if r["_label"] == value and r["_hash"].startswith(lead)), key=lambda r: (r["_hash"], r["_key"] is not None, r["_key"])):
            left -= r["n"]
            if left <= 0:
                break
        edge = F.struct(F.lit(r["_hash"]).alias("h"), F.lit(r["_key"]).cast("string").alias("k"))
        assigned = F.when(F.col(label).eqNullSafe(F.lit(value)) & (mine <= edge), part).otherwise(assigned)
    return df.withColumn(name, assigned)


def split_stratified(
    df: DataFrame, label: str, key: str, shares: dict[str, float] | None = None, seed: int = SEED, few_rows: int = FEW_ROWS
) -> DataFrame:
    """Add ``split``: every class is cut at the cumulative shares, to the row."""
    shares = shares or SPLIT_SHARES
    names = list(shares)
    reached = list(accumulate(shares[p] for p in names[:-1]))

    def parts(counts: dict) -> dict:
        return {value: [(part, int(n * up_to + 0.5)) for part, up_to in zip(names, reached)] for value, n in counts.items()}

    return cut_classes(df, label, key, parts, names[-1], seed, "split", few_rows)


def split_report(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of each class in each part."""
    counted = df.groupBy("split", F.col(label).alias("class")).agg(F.count("*").alias("n"))
    sizes = df.groupBy("split").agg(F.count("*").alias("split_rows"))
    total = df.count()
    return counted.join(F.broadcast(sizes), "split").select(  # one row per part
        "split", "class", "n", "split_rows", (F.col("split_rows") / F.lit(total)).alias("split_share"),
        (F.col("n") / F.col("split_rows")).alias("class_share"),
    )


def with_folds(df: DataFrame, label: str, key: str, folds: int, seed: int = SEED, few_rows: int = FEW_ROWS) -> DataFrame:
    """Add ``fold`` 0..folds-1: every class, in md5 order, is cut into parts of equal size, to the row.

    Rows without a label are left out. A class with fewer rows than folds is an error: a fold
    without it could not be scored.
    """
    def parts(counts: dict) -> dict:
        short = {c: n for c, n in counts.items() if n < folds}
        if short:
            raise ValueError(f"{folds} folds need as many rows of every class; there are {short}")
        return {c: [(fold, n * (fold + 1) // folds) for fold in range(folds - 1)] for c, n in counts.items()}

    return cut_classes(df.where(F.col(label).isNotNull()), label, key, parts, folds - 1, seed, "fold", few_rows)
