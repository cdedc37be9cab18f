"""Sharding by extendible hashing: only buckets above the byte limit split on another bit.

The directory grows from the root in rounds of ``STEP`` bits. A round sums bytes per prefix for the
rows of buckets still open (combined before the shuffle, so a round moves at most 2^STEP sums per open
bucket and task) and closes each branch at the fewest bits with which it fits. What the last bit
cannot part, rows with one and the same key, overflows into numbered shards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratascore.functions.hashing import hash_u32
from stratascore.session import materialize

LIMIT = 16 << 20
STEP = 8
DEPTH = 32
BROADCAST_ROWS = 1 << 18  # of about 50 bytes each


def bytes_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def _prefix(bits: int) -> Column:
    return F.shiftright("__h", DEPTH - bits)


def _placed(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.withColumns({
        "__h": hash_u32(F.coalesce(F.col(key).cast("string"), F.lit("")), "shard"),
        "__bytes": bytes_of(F.col(text)), "__from": F.spark_partition_id(),
    })


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Leaves of ``rows(__h, __bytes)``: ``bits, prefix, bytes, n``, written to the shared folder.

    A bucket closes if its bytes fit the limit or if it has one row; with all ``DEPTH`` bits used it
    closes in any case, and ``bytes`` then tells that it is above the limit.
    """
    leaves, still = [], None
    for bits in range(STEP, DEPTH + 1, STEP):
        part = rows.withColumn("__p", _prefix(bits))
        if still is not None:
            near = still.count() <= BROADCAST_ROWS
            part = part.withColumn("__q", _prefix(bits - STEP)).join(
                F.broadcast(still) if near else still, "__q", "left_semi")
        sums = part.groupBy("__p").agg(F.sum("__bytes").alias("bytes"), F.count("*").alias("n"))
        # every ancestor within this round: its sums, then the first that fits on the way down
        up = sums.select("__p", "bytes", "n", F.explode(F.sequence(F.lit(0), F.lit(STEP))).alias("k"))
        up = up.select((F.lit(bits) - F.col("k")).alias("bits"), F.expr("shiftright(__p, k)").alias("prefix"), "bytes", "n")
        tree = materialize(up.groupBy("bits", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")), "shard-tree")
        fits = (F.col("bytes") <= limit) | (F.col("n") == 1)
        too_big = tree.where(~fits).selectExpr("bits AS b", "prefix AS p")
        done = tree.where(fits if bits < DEPTH else fits | (F.col("bits") == DEPTH))
        parents = done.withColumn("b", F.col("bits") - 1).withColumn("p", F.shiftright("prefix", 1))
        first = parents.join(too_big, ["b", "p"], "left_semi").drop("b", "p")
        if bits == STEP:
            first = first.union(tree.where(fits & (F.col("bits") == 0)))
        leaves.append(first.select("bits", "prefix", "bytes", "n"))
        still = too_big.where(F.col("b") == bits).select(F.col("p").alias("__q"))
        if bits == DEPTH or still.isEmpty():
            break
    return materialize(reduce(DataFrame.union, leaves), "shard-leaves")


def shard(docs: DataFrame, limit: int = LIMIT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with a column ``shard``, the bucket's hash bits (``*`` if nothing had to split), and ``shard_bytes``.

    No shard holds more than ``limit`` bytes of text, unless one row alone does, which then has a
    shard of its own as far as the hash parts it. Rows of one key that together pass the limit get
    ``<bits>.<partition>.<number>``, cut within each input partition at every ``limit`` bytes.
    Null text has 0 bytes and a null key hashes like an empty one; repeated rows are rows. Columns
    named ``shard`` or ``shard_bytes`` in ``docs`` are replaced. An empty table gives an empty result.
    """
    narrow = materialize(_placed(docs.select(key, text), text, key).select("__h", "__bytes"), "shard-rows")
    leaves = directory(narrow, limit)
    kept = [c for c in docs.columns if c not in ("shard", "shard_bytes")]
    rows = _placed(docs.select(*kept), text, key)
    depths = sorted(r.bits for r in leaves.select("bits").distinct().collect())  # at most DEPTH + 1
    name = F.when(F.col("bits") == 0, F.lit("*")).otherwise(F.lpad(F.bin("prefix"), F.col("bits"), F.lit("0")))
    crowded = (F.col("bytes") > limit) & (F.col("n") > 1)
    named = leaves.select("bits", "prefix", F.struct(name.alias("shard"), "bytes", crowded.alias("crowded")).alias("leaf"))
    found = [F.lit(None).cast(named.schema["leaf"].dataType)]
    for bits in depths:
        level = named.where(F.col("bits") == bits).select(F.col("prefix").alias(f"__p{bits}"), F.col("leaf").alias(f"__l{bits}"))
        small = level.count() <= BROADCAST_ROWS
        rows = rows.withColumn(f"__p{bits}", _prefix(bits)).join(F.broadcast(level) if small else level, f"__p{bits}", "left")
        found.append(F.col(f"__l{bits}"))
    rows = rows.withColumn("__leaf", F.coalesce(*found))
    if leaves.where(crowded).isEmpty():
        return rows.select(*_result(kept))
    # Rows of one key: those above half the limit stand alone, the others are cut at every half limit
    # of the bytes before them, so no cut holds more than the limit.
    over = rows.where("__leaf.crowded").withColumn("__large", F.col("__bytes") > limit / 2)
    chain = Window.partitionBy("__h", "__from", "__large").orderBy(key, "__bytes")
    before = F.sum("__bytes").over(chain.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__bytes")
    cut = F.when(F.col("__large"), F.concat(F.lit("x"), F.row_number().over(chain))).otherwise(
        F.floor(before / F.lit(limit / 2)).cast("string"))
    over = over.withColumn("__to", F.concat_ws(".", "__leaf.shard", "__from", cut))
    over = over.withColumn("__sum", F.sum("__bytes").over(Window.partitionBy("__to")))
    cut_rows = over.select(*kept, F.col("__to").alias("shard"), F.col("__sum").alias("shard_bytes"))
    return rows.where("NOT __leaf.crowded").select(*_result(kept)).union(cut_rows)


def _result(kept: list[str]) -> list[Column]:
    return [*map(F.col, kept), F.col("__leaf.shard").alias("shard"), F.col("__leaf.bytes").alias("shard_bytes")]


SHARD_SQL = """
WITH placed AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS bytes,
         ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':shard')[1:8])::BIGINT AS h
  FROM documents),
numbered AS (SELECT *, row_number() OVER () AS r FROM placed),
tree AS (
  SELECT r, b, doc_id, bytes, h >> (32 - b) AS p, sum(bytes) OVER w AS total, count(*) OVER w AS n
  FROM numbered, range(0, 33) t(b) WINDOW w AS (PARTITION BY b, h >> (32 - b))),
leaf AS (SELECT r, min(b) AS b FROM tree WHERE total <= {limit} OR n = 1 GROUP BY r)
SELECT t.doc_id, t.bytes AS n_bytes, CASE WHEN t.b = 0 THEN '*' ELSE lpad(bin(t.p), t.b::INT, '0') END AS shard,
       t.total::BIGINT AS shard_bytes
FROM tree t JOIN leaf USING (r, b)
"""
