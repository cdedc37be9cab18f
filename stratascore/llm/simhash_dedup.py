"""SimHash near-duplicates: every pair of fingerprints within the radius, by tiled exact comparison.

Fingerprints are merged to distinct ones first, so a group of copies is one row. Five blocks of the
64 bits choose which pairs can meet at all: two fingerprints that differ in at most three bits agree
in two whole blocks, so each is laid under its ten pairs of blocks. What shares a pair of blocks is
compared in tiles with exclusive-or and bit counts; tiles are cut by population count, and two tiles
whose counts differ by more than the radius never meet. A key with more than ``TILE`` fingerprints is
spread over tile pairs, each a unit of work of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratascore.llm.common import components, local_labels, lower_words, shingle_hashes, sign_bits
from stratascore.session import materialize

SHINGLE = 3
RADIUS = 3
BLOCKS = 5
TILE = 4096
ROWS_AT_ONCE = 256


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """64-bit SimHash of the text's word shingles as a bigint; null and blank texts have fingerprint 0."""

    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        marks = [sign_bits(shingle_hashes(lower_words(t), size)) for t in texts]
        return pd.Series(np.array(marks, np.uint64).view(np.int64))

    return run(text)


def _block_keys(radius: int, blocks: int) -> Column:
    """One key for each choice of ``blocks - radius`` blocks: the choice's number and the bits in them."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(number).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def _units(radius: int) -> str:
    """SQL: the tile pairs a fingerprint of a crowded key takes part in, and on which side.

    ``tiles`` maps a population count to its number of tiles.
    """
    own = "named_struct('p', pc, 's', cast(pmod(xxhash64(fp), tiles[pc]) as int))"
    other = "named_struct('p', e.key, 's', t)"
    near = f"filter(map_entries(tiles), e -> abs(e.key - pc) <= {radius})"
    unit = (f"named_struct('lo', least({own}, {other}), 'hi', greatest({own}, {other}), "
            f"'side', if({own} <= {other}, 0, 1))")
    return f"flatten(transform({near}, e -> transform(sequence(0, e.value - 1), t -> {unit})))"


def _compare(x: np.ndarray, y: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles as positions in ``x`` followed by ``y``, at most one per row.

    Both sides are in the order of their population counts, so a strip of ``x`` meets only the
    stretch of ``y`` whose counts lie within the radius.
    """
    px, py = np.bitwise_count(x), np.bitwise_count(y)
    shift, n = (0, len(x)) if same else (len(x), len(x) + len(y))
    label = np.arange(n)
    for at in range(0, len(x), ROWS_AT_ONCE):
        strip = x[at : at + ROWS_AT_ONCE]
        low = np.searchsorted(py, max(int(px[at]) - radius, 0), "left")
        high = np.searchsorted(py, int(px[at + len(strip) - 1]) + radius, "right")
        i, j = np.nonzero(np.bitwise_count(strip[:, None] ^ y[None, low:high]) <= radius)
        if len(i):
            left = np.concatenate([i + at, np.arange(n)])
            right = np.concatenate([j + low + shift, label])
            label = local_labels(n, left, right)
    linked = np.nonzero(label != np.arange(n))[0]
    return linked, label[linked]


def _tile_links(frames: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by unit, side and population count; a unit may span batches."""
    rest = None

    def unit_links(fp: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        split = np.searchsorted(side, 1)
        if split == 0 or split == len(fp):
            same = fp if split else fp[:0]
            left, right = _compare(same, same, True, radius)
        else:
            left, right = _compare(fp[:split], fp[split:], False, radius)
        return fp[left], fp[right]

    def links(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        fp, side = frame["fp"].to_numpy(np.int64).view(np.uint64), frame["side"].to_numpy()
        ends = np.append(starts[1:], len(frame))
        # units of two or three rows are most of them: compare a row with the next one and the one after
        a, b = [], []
        small = ends - starts <= 3
        inside = np.repeat(np.where(small, np.arange(len(starts)), -1), ends - starts)
        plain = frame["crowded"].to_numpy() == 0
        for lag in (1, 2):
            at = np.nonzero((inside[lag:] == inside[:-lag]) & (inside[lag:] >= 0) & plain[lag:])[0]
            hit = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= radius]
            a.append(fp[hit])
            b.append(fp[hit + lag])
        for s, e in zip(starts, ends, strict=True):
            if e - s > 3 or (e - s > 1 and not plain[s]):
                x, y = unit_links(fp[s:e], side[s:e])
                a.append(x)
                b.append(y)
        return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    keys = ["choice", "bits", "lo_p", "lo_s", "hi_p", "hi_s"]
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        values = frame[keys].to_numpy(np.int64)
        starts = np.concatenate([[0], np.nonzero((values[1:] != values[:-1]).any(axis=1))[0] + 1])[: len(frame)]
        if not len(frame):
            continue
        rest = frame.iloc[starts[-1] :]
        if len(starts) > 1:
            yield links(frame.iloc[: starts[-1]], starts[:-1])
    if rest is not None and len(rest):
        yield links(rest.reset_index(drop=True), np.array([0]))


def close_links(marks: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` within ``radius`` of each other.

    A unit of work returns one link per row to the smallest member it reaches, not all pairs, so the
    links have the same components as the full list.
    """
    laid = marks.select("fp", F.bit_count("fp").alias("pc"), F.explode(_block_keys(radius, blocks)).alias("key"))
    laid = laid.select("fp", "pc", "key.choice", "key.bits")
    cells = laid.groupBy("choice", "bits", "pc").agg(F.count("*").alias("n"))
    crowded = cells.groupBy("choice", "bits").agg(  # at most 65 entries each
        F.sum("n").alias("rows"),
        F.map_from_entries(F.collect_list(F.struct("pc", F.ceil(F.col("n") / tile).cast("int")))).alias("tiles"),
    ).where(F.col("rows") > tile).drop("rows")
    whole = "array(named_struct('lo', named_struct('p', -1, 's', 0), 'hi', named_struct('p', -1, 's', 0), 'side', 0))"
    work = laid.join(crowded, ["choice", "bits"], "left").select(
        "choice", "bits", "fp", "pc", F.col("tiles").isNotNull().cast("int").alias("crowded"),
        F.explode(F.expr(f"if(tiles is null, {whole}, {_units(radius)})")).alias("u"),
    ).selectExpr("choice", "bits", "u.lo.p AS lo_p", "u.lo.s AS lo_s", "u.hi.p AS hi_p", "u.hi.s AS hi_s",
                 "u.side AS side", "crowded", "pc", "fp")
    unit = ["choice", "bits", "lo_p", "lo_s", "hi_p", "hi_s"]
    dealt = work.repartition(*unit).sortWithinPartitions(*unit, "side", "pc")
    return dealt.mapInPandas(lambda frames: _tile_links(frames, radius), "a bigint, b bigint").where("a <> b")


def simhash_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits), ``component_id``, ``mark`` (a hash of the text).

    Rows link if their fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest
    ``doc_id`` reachable. Null, blank and wordless texts have fingerprint 0 and link like any other.
    Repeated rows each return a row; an id of null is never the smallest unless all are null. Other
    columns are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("mark"), fingerprint(F.col(text)).alias("fp"))
    rows = materialize(rows, "simhash-marks")
    marks = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(close_links(marks.select("fp"), radius), "simhash-links")
    linked = marks.join(roots, marks.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    group = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.select("fp", "root").join(group, "root")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root", "mark")


def keep_one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row left of each group of near copies, the one with the smallest id.

    All columns stay as they are. Repeated rows are one group; of rows that tie in id, the one with
    the smaller text hash stays. A row with a null id stays only if its group has no other.
    """
    groups = simhash_groups(docs, text, key)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "mark")
    chosen = groups.groupBy("root").agg(F.min(order).alias("pick"))
    chosen = chosen.select(F.col("pick.doc_id").alias("__id"), F.col("pick.mark").alias("__mark"))
    marked = docs.withColumn("__mark_of", F.xxhash64(text))
    kept = marked.join(chosen, marked[key].eqNullSafe(F.col("__id")) & (F.col("__mark_of") == F.col("__mark")), "left_semi")
    if not groups.groupBy("doc_id", "mark").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([key, "__mark_of"])  # whole rows that repeat
    return kept.drop("__mark_of")
