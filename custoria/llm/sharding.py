"""Weighted rendezvous hashing of record keys over shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custoria.session import materialize


def draw(key: Column, shard: Column) -> Column:
    """A number in (0, 1) that the key and the shard's name decide: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), shard.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def shard_of(key: Column, weights: dict[int, float]) -> Column:
    """The shard with the highest score: -weight / ln(draw); the smallest number of equals.

    A further shard only takes the keys that it scores highest for, a removed one only gives
    up its own, and a changed weight moves keys to or from that shard alone. A null key counts as empty.
    """
    if not weights or min(weights.values()) <= 0:
        raise ValueError("each shard needs a weight above zero")
    scores = [F.struct((-F.lit(float(w)) / F.log(draw(key, F.lit(s)))).alias("score"), F.lit(-s).alias("shard")) for s, w in sorted(weights.items())]
    return -F.array_max(F.array(*scores))["shard"]


def with_slots(df: DataFrame, shard: str = "shard", key: str = "doc_id") -> DataFrame:
    """``df``, stored, with ``slot``: gapless numbers from 0 within each shard, in the order of the key.

    The rows are dealt by ranges of the key and stored; each range is numbered by itself and
    shifted by what the ranges before it hold, so no task holds a whole shard. Rows of one key
    spread over ranges by their place in the first stored table. What is stored does not
    change, so numbers and shifts agree whatever is run again.
    """
    part, place = "_part", "_place"
    first = materialize(df.drop("slot").withColumn(place, F.monotonically_increasing_id()))
    stored = materialize(first.repartitionByRange(key, place).withColumn(part, F.spark_partition_id()))
    counts = stored.groupBy(shard, part).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select(F.col(shard).alias("_shard"), F.col(part).alias("_at"), F.coalesce(before, F.lit(0)).alias("_shift"))
    numbered = stored.withColumn("_row", F.row_number().over(Window.partitionBy(shard, part).orderBy(key, place)))
    joined = numbered.join(shifts, (F.col(shard) == F.col("_shard")) & (F.col(part) == F.col("_at")))
    return joined.select(*[numbered[c] for c in df.columns if c != "slot"], (F.col("_row") - 1 + F.col("_shift")).cast("long").alias("slot"))


def assign(df: DataFrame, shards: int | dict[int, float], id_column: str = "doc_id", column: str = "text", grown: int | dict[int, float] | None = None) -> DataFrame:
    """(id, ``size``, ``text_crc32``, ``shard``, ``grown_shard``, ``slot``) of every row.

    ``size`` is the UTF-8 length plus 1 and a null text counts as empty. Rows of one key, repeated
    or not, share a shard. ``grown_shard`` is the place under ``grown`` shards (one more, of weight 1).
    An empty table gives an empty result.
    """
    weights = dict.fromkeys(range(shards), 1.0) if isinstance(shards, int) else shards
    wider = {**weights, max(weights) + 1: 1.0} if grown is None else dict.fromkeys(range(grown), 1.0) if isinstance(grown, int) else grown
    data = F.coalesce(F.col(column), F.lit("")).cast("binary")
    key = F.col(id_column)
    placed = df.select(
        key,
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, wider).alias("grown_shard"),
    )
    return with_slots(placed, "shard", id_column)


#: The same for 16 shards: the checksum is folded byte by byte over a table made by its rule.
SQL = r"""
WITH RECURSIVE c(n, k, v) AS (
  SELECT range, 0, range::UBIGINT FROM range(256)
  UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM c WHERE k < 8
), tab AS (SELECT list(v ORDER BY n) AS t FROM c WHERE k = 8
), d AS (SELECT doc_id, coalesce(text, '') AS x, hex(encode(coalesce(text, ''))) AS h FROM documents
), crc AS (
  SELECT doc_id, x,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::UBIGINT)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM d, tab
), s AS (
  SELECT doc_id, s, -1.0 / ln((('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || s)[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) AS score
  FROM documents, range(17) AS r(s)
), best AS (
  SELECT doc_id, arg_max(s, score) FILTER (WHERE s < 16)::INT AS shard, arg_max(s, score)::INT AS grown_shard FROM s GROUP BY doc_id
)
SELECT doc_id, strlen(x) + 1 AS size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM crc JOIN best USING (doc_id)
"""
