"""Mixing sources to target weights as a time-varying curriculum, in DataFrame functions only.

Each source has a weight schedule over the training run, a ramp from a first to a last weight. Its
integral is the source's share of all words. The words a source takes lie one after the other on a
line; the cumulative demand of the ramp, inverted, turns each place on that line into a moment of the
run, and documents are range-sorted by that moment.

A source may hold a third of all rows, so no running sum goes over a whole source: documents are
hashed into stretches per source, more of them for more rows, the stretches are summed first (combined before the
shuffle), and the running sum inside one stretch starts at the sum of the stretches before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratascore.functions.hashing import hash_u32
from stratascore.llm.common import WORD
from stratascore.session import materialize

RAMPS = ((7.5, 2.5), (2.0, 2.0), (0.5, 1.5))  # (first, last) weight: means 5, 2, 1
MAX_REPEATS = 3
BUCKETS = 4096  # stretches a source, at least
ROWS_PER_STRETCH = 1 << 14  # on average, if one source held all rows


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def stretches_of(rows: int) -> int:
    """Stretches a source: a power of two that keeps them short. The result does not depend on it."""
    return min(1 << 31, max(BUCKETS, 1 << max(0, rows // ROWS_PER_STRETCH).bit_length()))


def _place(docs: DataFrame, text: str, key: str, source: str, buckets: int) -> DataFrame:
    """``docs`` with its size, its hash and the stretch it falls in."""
    placed = docs.withColumns({
        "__size": words_of(F.col(text)),
        "__hash": hash_u32(F.coalesce(F.col(key).cast("string"), F.lit("")), "mix"),
        "__name": F.coalesce(F.col(source), F.lit("")),
        "__none": F.col(source).isNull(),
    })
    return placed.withColumn("__stretch", F.floor(F.col("__hash") / F.lit((1 << 32) // buckets)).cast("bigint"))


def source_targets(sizes: DataFrame, ramps: Sequence[tuple[float, float]] = RAMPS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets from ``__none, __name, source_size``: one row per source, so one window task reads them.

    Sources in code point order, null last, take the ramps in turn. All words are shared by the
    integral of the ramp; a source stops at ``max_repeats`` times its size and what it cannot take
    goes to the others by weight. The level at which nobody is above its limit is found in closed
    form: sources are ordered by limit over weight, and the first one below its limit sets the level.
    """
    first = F.element_at(F.lit([float(a) for a, _ in ramps]), F.col("__turn"))
    last = F.element_at(F.lit([float(b) for _, b in ramps]), F.col("__turn"))
    turn = F.row_number().over(Window.orderBy("__none", "__name"))
    ranked = sizes.withColumn("__turn", (turn - 1) % len(ramps) + 1)
    ranked = ranked.withColumns({"weight": (first + last) / 2, "slope": (last - first) / (first + last),
                                 "limit": (F.lit(max_repeats) * F.col("source_size")).cast("double")})
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "__none", "__name")
    full = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    level = ranked.withColumn("__level", (total - full) / rest)
    level = level.withColumn("__at", F.row_number().over(by_limit))
    open_at = F.when(F.col("limit") > F.col("__level") * F.col("weight"), F.struct("__at", "__level"))
    share = F.min(open_at).over(Window.partitionBy()).getField("__level") * F.col("weight")
    target = F.least("limit", F.coalesce(share, F.col("limit")))
    return level.withColumn("target", target).select("__none", "__name", "source_size", "target", "slope")


def plan_mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
             ramps: Sequence[tuple[float, float]] = RAMPS, max_repeats: int = MAX_REPEATS,
             extra: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: key, ``extra`` columns, ``size, source_size, target, copies, taken, moments``.

    A source's documents stand in hash order. Each is taken as often as the target holds the whole
    source; the words left over go to the documents at the front, so a source misses its target by
    at most half a document. ``moments`` has the training position of each copy, ascending: the share of the
    run, 0..1, at which the source's cumulative demand reaches the middle of the document. ``buckets`` is the
    number of stretches, by default from the number of rows; it changes no result.

    Null text has size 0; a null source is a source of its own, the last; a null key hashes like an
    empty one. Rows that tie in hash, key and size are alike, so their order does not matter, and
    repeated rows are rows. An empty table gives an empty result. Columns not named are dropped, and
    a column called ``size`` or ``target`` in ``docs`` is not read.
    """
    place = ["__none", "__name", "__stretch"]
    buckets = buckets or stretches_of(docs.count())
    alone = materialize(_place(docs.select(key, text, source), text, key, source, buckets)
                        .groupBy(*place).agg(F.sum("__size").alias("__words")), "mix-stretches")
    sources = source_targets(alone.groupBy("__none", "__name").agg(F.sum("__words").alias("source_size")),
                             ramps, max_repeats)
    before = Window.partitionBy("__none", "__name").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = alone.withColumn("__before", F.coalesce(F.sum("__words").over(before), F.lit(0))).drop("__words")
    offsets = offsets.join(sources, ["__none", "__name"])
    wide = _place(docs.select(*dict.fromkeys([key, text, source, *extra])), text, key, source, buckets)
    wide = wide.select(*place, "__size", "__hash", *dict.fromkeys([key, *extra]))
    inside = Window.partitionBy(*place).orderBy("__hash", key, "__size").rowsBetween(Window.unboundedPreceding, -1)
    rows = wide.withColumn("__inside", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    rows = rows.join(offsets.select(*[F.col(c).alias(f"{c}_") for c in place], "__before", F.col("source_size").alias("__all"),
                                    F.col("target").alias("__target"), F.col("slope").alias("__slope")),
                     on=[F.col(c) == F.col(f"{c}_") for c in place])
    start = F.col("__before") + F.col("__inside")
    middle = start + F.col("__size") / F.lit(2.0)
    whole = F.when(F.col("__all") > 0, F.least(F.floor(F.col("__target") / F.col("__all")), F.lit(max_repeats))).otherwise(0)
    left = F.col("__target") - F.col("__whole") * F.col("__all")
    copies = F.col("__whole") + F.when((F.col("__whole") < max_repeats) & (F.col("__middle") < left), 1).otherwise(0)
    rows = rows.withColumns({"__middle": middle, "__whole": whole.cast("int")}).withColumn("__copies", copies.cast("int"))
    moments = F.expr("""transform(if(__copies > 0, sequence(0, __copies - 1), cast(array() as array<int>)),
        k -> least((k * __all + __middle) / __target, 1D))""")
    s = F.col("__slope")
    invert = lambda u: F.when(s == 0, u).otherwise(  # noqa: E731  of (1 - s) t + s t^2
        (F.sqrt((1 - s) * (1 - s) + 4 * s * u) - (1 - s)) / (2 * s))
    return rows.select(
        *dict.fromkeys([key, *extra]), F.col("__size").alias("size"), F.col("__all").cast("bigint").alias("source_size"),
        F.col("__target").alias("target"), F.col("__copies").alias("copies"),
        (F.col("__copies") * F.col("__size")).cast("bigint").alias("taken"),
        F.transform(moments, invert).alias("moments"),
    )


def mix_positions(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """One row per row of ``docs``, range-sorted by its first training position; rows that are not taken come last.

    Key, ``size, source_size, target, copies, taken`` and ``first_position, last_position``, both null for a
    row without copies. Equal positions are ordered by key. Nulls, ties and empty tables as in ``plan_mix``.
    """
    plan = plan_mix(docs, text, key, source, **options)
    first, last = F.get("moments", F.lit(0)), F.get("moments", F.size("moments") - 1)
    placed = plan.withColumns({"first_position": first, "last_position": last}).drop("moments")
    return placed.orderBy(F.asc_nulls_last("first_position"), key)


def mixed_order(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The training run: each row of ``docs`` as often as it is taken, all columns kept, in order of its moment.

    The sort is a range partitioning by moment; each partition is one stretch of the run. Wordless
    documents are taken as often as their source's turn gives them and change no word count.
    """
    names = docs.columns
    packed = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), F.col(source).alias("__source"),
                         F.struct(*[F.col(c) for c in names]).alias("__row"))
    plan = plan_mix(packed, "__text", "__key", "__source", extra=["__row"], **options)
    taken = plan.select("__row", "__key", F.explode("moments").alias("__moment"))
    return taken.orderBy("__moment", "__key").select(*[F.col("__row").getField(c).alias(c) for c in names])


MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':mix')[1:8])::BIGINT AS h
  FROM documents),
per_source AS (
  SELECT source, sum(size)::DOUBLE AS n, row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM docs GROUP BY source),
weighted AS (
  SELECT *, CASE (turn - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 3 * n AS cap
  FROM per_source),
levels AS (
  SELECT *, row_number() OVER o AS pos,
         (sum(n) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
  FROM weighted WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
targets AS (
  SELECT source, n, CASE w WHEN 5 THEN -0.5::DOUBLE WHEN 2 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS slope, least(cap, coalesce((SELECT lv FROM levels WHERE cap > lv * w ORDER BY pos LIMIT 1) * w, cap)) AS target
  FROM levels),
placed AS (
  SELECT d.doc_id, d.size, t.n, t.target, t.slope,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2.0::DOUBLE AS middle,
         CASE WHEN t.n > 0 THEN least(floor(t.target / t.n), 3) ELSE 0 END::INT AS whole
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, (whole + CASE WHEN whole < 3 AND middle < target - whole * n THEN 1 ELSE 0 END)::INT AS copies FROM placed),
demanded AS (
  SELECT *, CASE WHEN copies > 0 THEN least(middle / target, 1) END AS u,
         CASE WHEN copies > 0 THEN least(((copies - 1) * n + middle) / target, 1) END AS v
  FROM counted)
SELECT doc_id, size, n::BIGINT AS source_size, target, (size * copies)::BIGINT AS taken, copies,
       CASE WHEN slope = 0 THEN u ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * u) - (1 - slope)) / (2 * slope) END AS first_position,
       CASE WHEN slope = 0 THEN v ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * v) - (1 - slope)) / (2 * slope) END AS last_position
FROM demanded
"""
