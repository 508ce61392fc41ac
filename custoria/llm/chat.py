"""Reply trees as conversations for training: paths, branch scores, a chat template and its loss mask.

Each message points at the one it replies to. Self-joins of narrow rows double the distance that every
message looks up its tree, so its depth and the score of the branch down to it are known after
as many joins as the depth has binary digits. The leaves of a tree are ranked by that score; from the
chosen ones the same tables of jumps, longest first, list every message of the path exactly once.
Texts move once: a tree's texts and the places where they stand meet under the tree's key, where each
path is put together. Trees with very many messages are joined message by message instead.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custoria.session import materialize

START, END, STOP = "<|im_start|>", "<|im_end|>", "<|im_end|>\n"
#: Messages of one tree that meet in one task. The list of larger trees has at most LARGE_TREES rows.
TREE, LARGE_TREES = 100_000, 100_000
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    """``text`` in which no ``<|`` is left: one more backslash between ``<`` and ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role(role: Column) -> Column:
    """A role on one line; its line breaks become a control string, which no escaped text holds."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("<|n|>"))


def turns(formatted: Column) -> Column:
    """The (role, text) pairs that were formatted, in order."""

    def read(turn: Column) -> Column:
        body = F.substr(turn, F.lit(len(START) + 1))
        at = F.instr(body, "\n")
        role = unescaped(F.replace(F.substr(body, F.lit(1), at - 1), F.lit("<|n|>"), F.lit("\n")))
        return F.struct(role.alias("role"), unescaped(F.substr(body, at + 1)).alias("text"))

    parts = F.split(formatted, r"<\|im_end\|>\n")
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), read)


def learned(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescaped(F.substr(formatted, s["begin"].cast("int") + 1, (s["end"] - s["begin"]).cast("int"))))


def _stored_paths(replies: DataFrame, best: int | None) -> tuple[DataFrame, DataFrame]:
    """From (tree, id, parent, score): messages (n, tree, id), and the places (leaf, n, pos, path) of the chosen paths; the
    leaf's own place says which path it is."""
    nodes = replies.groupBy("tree", "id").agg(F.min("parent").alias("parent"), F.max(F.when(~F.isnan("score"), F.col("score"))).alias("score"))
    nodes = materialize(nodes.select(F.monotonically_increasing_id().alias("n"), "tree", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    above = nodes.where("id IS NOT NULL").select(F.col("n").alias("up"), F.col("tree").alias("its_tree"), F.col("id").alias("its_id"))
    linked = nodes.join(above, (F.col("its_id") == F.col("parent")) & F.col("its_tree").eqNullSafe(F.col("tree")) & (F.col("up") != F.col("n")), "left")
    # up: the message 2**k steps above, or null where the tree begins before; steps and total lead there
    state = materialize(linked.select("n", "up", F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long").alias("steps"), F.col("score").alias("total")))
    parents = state.where("up IS NOT NULL").select(F.col("up").alias("n")).distinct()
    known, active, jumps = state.where("up IS NULL"), state.where("up IS NOT NULL"), []
    most = nodes.count()
    while not active.isEmpty() and 1 << len(jumps) <= max(1, most):
        jumps.append(active.select("n", "up"))
        far = known.unionByName(active).select(F.col("n").alias("mid"), F.col("up").alias("far"), F.col("steps").alias("more"), F.col("total").alias("added"))
        state = materialize(active.join(far, F.col("up") == F.col("mid")).select("n", F.col("far").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("total") + F.col("added")).alias("total")))
        known, active = known.unionByName(state.where("up IS NULL")), state.where("up IS NOT NULL")
    leaves = known.join(parents, "n", "left_anti").join(nodes.select("n", "tree", "id"), "n")
    order = Window.partitionBy("tree").orderBy(F.col("total").desc(), F.col("steps").desc(), F.col("id").asc_nulls_first())
    ranked = leaves.withColumn("path_rank", F.row_number().over(order))
    if best is not None:
        ranked = ranked.where(F.col("path_rank") <= best)
    path = F.struct(F.col("id").alias("leaf"), F.col("path_rank").cast("long").alias("path_rank"), F.col("total").alias("path_score"), (F.col("steps") + 1).alias("n_messages"))
    places = materialize(ranked.select(F.col("n").alias("leaf"), "n", F.col("steps").alias("pos"), path.alias("path")))
    none = F.lit(None).cast(places.schema["path"].dataType).alias("path")
    for k, jump in reversed(list(enumerate(jumps))):
        further = places.join(jump, "n").select("leaf", F.col("up").alias("n"), (F.col("pos") - (1 << k)).alias("pos"), none)
        places = materialize(places.unionByName(further))
    return nodes.select("n", "tree", "id"), places


def _formatted(rows: DataFrame) -> DataFrame:
    """Rows (tree, place, role, text) as one row per (tree, leaf); where the tree is hashed already, nothing moves."""
    head = F.concat(F.lit(START), _role(F.col("role")), F.lit("\n"))
    rows = rows.select("tree", "place.leaf", "place.pos", "place.path", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    rows = rows.select("*", F.concat("head", "body", F.lit(STOP)).alias("piece"))
    before = Window.partitionBy("tree", "leaf").orderBy("pos", "role", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("until", F.sum(F.length("piece")).over(before))
    begin = F.col("until") - F.length("piece") + F.length("head")
    turn = F.struct("until", "piece", F.when(F.col("role") == LEARNED, begin).alias("begin"), (begin + F.length("body")).alias("end"))
    whole = rows.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("pieces"), F.first("path", ignorenulls=True).alias("path"))
    spans = F.transform(F.filter("pieces", lambda p: p["begin"].isNotNull()), lambda p: F.struct(p["begin"].alias("begin"), p["end"].alias("end")))
    return whole.select("tree", "path.*", F.array_join(F.col("pieces")["piece"], "").alias("formatted"), spans.alias("loss_spans"))


def conversations(messages: DataFrame, replies: DataFrame | None = None, best: int | None = 1, tree: str = "tree", message: str = "message", parent: str = "parent", role: str = "role", text: str = "text", score: str | None = "score") -> DataFrame:
    """One row per chosen root-to-leaf path: ``tree``, ``leaf``, ``path_rank``, ``path_score``, ``n_messages``,
    ``formatted`` and ``loss_spans``, the [begin, end) of what is learned in code points of ``formatted``.

    ``messages`` holds tree, message, role and text; ``replies`` holds tree, message, parent and score and is
    taken from ``messages`` where it is not given. The ``best`` leaves of each tree by the sum of the scores on their
    path are chosen (all where it is None); ties: the deeper one, then the smaller message id.

    * A null or NaN score counts as 0, a null role or text as empty.
    * Rows of one tree and message id are parts of one message and follow each other by role and text, copies as often as
      they occur; its parent is the smallest that is given, its score the largest. Null is an id (and a tree) as any other.
    * A message without a parent, whose parent is not in its tree, or that is its own parent begins a path.
    * Messages on or below a loop of parents have no root and stand in no path.
    * An empty table gives an empty one. Other columns are not carried, so none clashes.
    """
    said = messages.select(F.col(tree).alias("tree"), F.col(message).alias("id"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    given = messages if replies is None else replies
    given = given.select(F.col(tree).alias("tree"), F.col(message).alias("id"), F.col(parent).alias("parent"), (F.col(score).cast("double") if score else F.lit(0.0)).alias("score"))
    nodes, places = _stored_paths(given, best)
    sizes = nodes.groupBy("tree").count().where(F.col("count") > max(TREE, nodes.count() // LARGE_TREES)).select(F.col("tree").alias("large"))
    large = materialize(sizes)
    stands = places.join(nodes, "n").select("tree", "id", F.struct("leaf", "pos", "path").alias("place"))
    if large.isEmpty():
        found = _formatted(_by_tree(said, stands))
    else:
        big = F.broadcast(large)  # at most LARGE_TREES rows
        is_large = F.col("large").eqNullSafe(F.col("tree"))
        small = _formatted(_by_tree(said.join(big, is_large, "left_anti"), stands.join(big, is_large, "left_anti")))
        said, stands = said.join(big, is_large, "left_semi"), stands.join(big, is_large, "left_semi")
        stands = stands.select(F.col("tree").alias("its_tree"), F.col("id").alias("its_id"), "place")
        both = said.join(stands, F.col("tree").eqNullSafe(F.col("its_tree")) & F.col("id").eqNullSafe(F.col("its_id")))
        found = small.unionByName(_formatted(both.select("tree", "place", "role", "text")))
    return found.select("tree", "leaf", "path_rank", "path_score", "n_messages", "formatted", "loss_spans")


def _by_tree(said: DataFrame, stands: DataFrame) -> DataFrame:
    """Texts with their places, both dealt by tree once: windows and groups by more keys then stay where they are."""
    stands = stands.groupBy("tree", "id").agg(F.collect_list("place").alias("places"))
    texts = said.withColumn("places", F.lit(None).cast(stands.schema["places"].dataType))
    marks = stands.select("tree", "id", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "places")
    met = texts.unionByName(marks).repartition("tree")
    order = Window.partitionBy("tree", "id").orderBy(F.col("places").isNull())
    met = met.withColumn("places", F.first("places", ignorenulls=True).over(order)).where("text IS NOT NULL")
    return met.select("tree", F.explode("places").alias("place"), "role", "text")


#: The registered query for DuckDB.
SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
shown AS (SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
  + length(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|n|>')) + 24 AS chars FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""
