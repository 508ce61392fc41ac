"""Removal of repeated runs of lines by winnowing over line hashes, in DataFrame functions only.

A window is the shortest run of lines, taken forwards from a line or backwards from it, that is
long enough to count: LINES lines or WORDS words. The smallest line hash of each window (the
last one of equals) is its fingerprint, so that two equal windows always have one in common.
Windows whose fingerprint occurs once in the corpus end there. The others are grouped by digests
of their lines, and every line of a window whose lines also stand earlier is deleted. Positions are not
joined and matches not extended: windows overlap, so what goes are exactly the runs of long enough
size that repeat earlier ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custoria.llm.common import columns_of, rows_of
from custoria.session import materialize

LINES, WORDS = 3, 50
SPACES = " \t\r\n\f\x0b"
#: A line break that is followed by a line with a word: blank lines stay with the line above.
BREAK = r"\n(?=[ \t\r\f\x0B]*[^ \t\r\n\f\x0B])"


def _windows(size: Column, words: Column, lines: int, least: int) -> Column:
    """(begin, end) of the windows of a text, end inclusive."""

    def reach(at: Column, step: int) -> Column:
        """How many lines from ``at`` on make a window; null beyond the text."""
        total, out = F.get(words, at), F.when(F.get(words, at) >= least, 1)
        inside = (at >= 0) & (at < size)
        out = F.when(inside & (total >= least), 1)
        for k in range(1, lines):
            place = at + step * k
            total = total + F.get(words, place)
            inside = (place >= 0) & (place < size)
            out = out.when(inside & ((total >= least) | F.lit(k == lines - 1)), k + 1)
        return out if lines > 1 else F.when(inside, 1)

    every = F.sequence(F.lit(0), size - 1)
    forward = F.transform(every, lambda i: F.struct(i.alias("b"), (i + reach(i, 1) - 1).alias("e")))
    backward = F.transform(every, lambda i: F.struct((i - reach(i, -1) + 1).alias("b"), i.alias("e")))
    return F.filter(F.array_distinct(F.concat(forward, backward)), lambda w: w["b"].isNotNull() & w["e"].isNotNull())


def repeated_windows(df: DataFrame, id_column: str, column: str, lines: int = LINES, words: int = WORDS) -> DataFrame:
    """(``_nulls``, ``_id``, ``_text``, ``removed``): line numbers, from 0, that repeat earlier lines, for the texts that have any."""
    texts = df.where(F.length(F.trim(F.col(column), F.lit(SPACES))) > 0).select(
        F.col(id_column).isNull().alias("nulls"), F.col(id_column).alias("id"), F.xxhash64(column).alias("hash"), F.split(column, BREAK).alias("lines")
    )
    coded = texts.select(
        "nulls", "id", "hash",
        F.transform("lines", lambda x: F.xxhash64(F.trim(x, F.lit(SPACES)))).alias("codes"),
        F.transform("lines", lambda x: F.regexp_count(x, F.lit(r"[^ \t\r\n\f\x0B]+"))).alias("words"),
        F.size("lines").alias("n"),
    )
    windows = coded.select("nulls", "id", "hash", "codes", _windows(F.col("n"), F.col("words"), lines, words).alias("w"), "n")

    def described(w: Column) -> Column:
        run = F.slice("codes", w["b"] + 1, w["e"] - w["b"] + 1)
        low = F.array_min(run)
        return F.struct(
            w["b"].alias("b"), w["e"].alias("e"), low.alias("mark"),
            F.xxhash64(run).alias("k1"), F.xxhash64(F.lit("second"), run).alias("k2"),
            (w["e"] - F.array_position(F.reverse(run), low).cast("int") + 1).alias("at"),
        )

    # three passes read the windows: worked out once, they are narrow rows
    rows = materialize(windows.select("nulls", "id", "hash", F.inline(F.transform("w", described))))
    # a fingerprint is a place; windows that share it count once
    marks = rows.select("nulls", "id", "hash", "at", "mark").distinct().groupBy("mark").agg(F.count("*").alias("places")).where("places > 1").select("mark")
    met = rows.drop("at").join(marks, "mark", "left_semi")
    firsts = met.groupBy("k1", "k2").agg(F.min(F.struct("nulls", "id", "hash", "b")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    here = F.struct("nulls", "id", "hash", "b")
    later = met.join(firsts, ["k1", "k2"]).where(here > F.col("first"))
    spans = later.groupBy("nulls", "id", "hash").agg(F.collect_list(F.struct("b", "e")).alias("spans"))
    return spans.select(
        F.col("nulls").alias("_nulls"), F.col("id").alias("_id"), F.col("hash").alias("_text"),
        F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["b"], s["e"])))).alias("removed"),
    )


def dedup_lines(df: DataFrame, id_column: str = "doc_id", column: str = "text", lines: int = LINES, words: int = WORDS) -> DataFrame:
    """``df`` without the lines of runs that also stand earlier, and with counts of them.

    Earlier is a smaller id (nulls last), then a smaller hash of the text, then a smaller place in
    the text; rows of the same id and text are one place and lose the same lines. Lines are
    compared without spaces around them; blank lines belong to the line above. Adds
    ``line_count``, ``lines_removed`` and ``line_runs_removed`` (maximal runs). Texts that lose
    nothing stay as they are, to the byte; null stays null with counts of 0, and a text that
    loses every line becomes empty. Columns of the three names are replaced.
    """
    base = df.drop("line_count", "lines_removed", "line_runs_removed")
    found = repeated_windows(base, id_column, column, lines, words)
    whole = rows_of(base, column, id=id_column).withColumn("hash", F.xxhash64("text"))
    joined = whole.join(
        found, (F.col("id").isNull() == F.col("_nulls")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_text")), "left"
    )
    split = joined.withColumn("lines", F.split("text", BREAK)).withColumn("gone", F.array_sort("removed"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    left = F.when(F.size("gone") >= F.size("lines"), F.lit("")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    # runs begin at numbers that do not follow the one before them
    runs = F.size(F.filter(F.transform("gone", lambda x, k: (k == 0) | (F.get("gone", k - 1) != x - 1)), lambda first: first))
    none = F.lit(0).cast("long")
    return split.select(
        *[F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias(c) if c == column else plain for c, plain in zip(base.columns, columns_of(base.columns, column))],
        F.when(F.length(F.trim("text", F.lit(SPACES))) > 0, F.size("lines").cast("long")).otherwise(none).alias("line_count"),
        F.coalesce(F.size("gone").cast("long"), none).alias("lines_removed"),
        F.coalesce(F.when(F.col("gone").isNotNull(), runs).cast("long"), none).alias("line_runs_removed"),
    )


#: The same result stated without fingerprints: every window against all earlier ones.
SQL = r"""
WITH t AS (
  SELECT doc_id, text, string_split(regexp_replace(text, '\n([ \t\r\f\x0B]*[^ \t\r\n\f\x0B])', chr(1) || '\1', 'g'), chr(1)) AS lines
  FROM documents
), l AS (
  SELECT doc_id, len(lines) AS n, i, lines[i] AS line, trim(lines[i], E' \t\r\n\f\x0B') AS body,
         len(regexp_extract_all(lines[i], '[^ \t\r\n\f\x0B]+')) AS w
  FROM t, unnest(range(1, len(lines) + 1)) AS u(i)
  WHERE length(trim(text, E' \t\r\n\f\x0B')) > 0
), p AS (
  SELECT *, lead(w, 1) OVER f AS w1, lead(w, 2) OVER f AS w2, lag(w, 1) OVER f AS v1, lag(w, 2) OVER f AS v2,
         lead(body, 1) OVER f AS a1, lead(body, 2) OVER f AS a2, lag(body, 1) OVER f AS c1, lag(body, 2) OVER f AS c2
  FROM l WINDOW f AS (PARTITION BY doc_id ORDER BY i)
), x AS (
  SELECT doc_id, i AS b, CASE WHEN w >= 50 THEN i WHEN w + w1 >= 50 THEN i + 1 WHEN w2 IS NOT NULL THEN i + 2 END AS e,
         CASE WHEN w >= 50 THEN [body] WHEN w + w1 >= 50 THEN [body, a1] WHEN w2 IS NOT NULL THEN [body, a1, a2] END AS k FROM p
  UNION
  SELECT doc_id, CASE WHEN w >= 50 THEN i WHEN w + v1 >= 50 THEN i - 1 WHEN v2 IS NOT NULL THEN i - 2 END, i,
         CASE WHEN w >= 50 THEN [body] WHEN w + v1 >= 50 THEN [c1, body] WHEN v2 IS NOT NULL THEN [c2, c1, body] END FROM p
), r AS (
  SELECT doc_id, b, e FROM (SELECT *, min((doc_id, b)) OVER (PARTITION BY k) AS first FROM x WHERE k IS NOT NULL)
  WHERE (doc_id, b) > first
), d AS (SELECT DISTINCT doc_id, unnest(range(b, e + 1)) AS i FROM r
), g AS (
  SELECT l.doc_id, count(*) AS n_lines, count(d.i) AS n_removed,
         string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE d.i IS NULL) AS kept,
         count(*) FILTER (WHERE d.i IS NOT NULL AND q.i IS NULL) AS n_runs
  FROM l LEFT JOIN d USING (doc_id, i) LEFT JOIN d AS q ON q.doc_id = l.doc_id AND q.i = l.i - 1 GROUP BY l.doc_id
)
SELECT t.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
       sha256(CASE WHEN coalesce(n_removed, 0) = 0 THEN t.text ELSE coalesce(kept, '') END) AS kept_sha256
FROM t LEFT JOIN g USING (doc_id)
"""
