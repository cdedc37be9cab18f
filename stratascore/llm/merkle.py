"""Merkle manifest of a table: one tree per group of rows, one tree over the groups, a proof per row.

Slot pivot: the children of a parent are spread into ``fanout`` columns by conditional aggregates over
(tree, position div fanout). The columns side by side are hashed into the parent; the columns without
the own one are the siblings, which is all that a proof holds. Trees of all groups grow level by level
together, so a level is one shuffle of a table that shrinks by the fanout each time, and proofs come
down the same tables by joins on (tree, position), a key that occurs once on either side.

Positions inside a tree come from a range sort over all rows, so a group with a third of them lies in
many tasks. Two numbers and the root reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratascore.session import materialize, release

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"
ROW_BITS = 33  # monotonically_increasing_id numbers the rows of a partition in its lower 33 bits


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, concatenated as UTF-8; a null part counts as nothing."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, a colon and the value, or ``-`` if it is null."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda done, step: digest(step["left"], done, step["right"]))


def proof_text(proof: Column) -> Column:
    """All siblings of a proof, concatenated level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def _numbered(rows: DataFrame, order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``pos`` (from 0) in ``order`` inside their ``tree``, and ``n``, the rows of the tree; and the table to release.

    The sorted table is written once. A row's place in its part is the difference of two ids; the rows
    before the part come from one count per tree and part, as many as parts and trees together.
    """
    tied = rows.withColumn("tie", F.monotonically_increasing_id())  # spreads rows that are equal in all else
    ranged = tied.orderBy("tree", *order, "tie").drop("tie").withColumn("at", F.monotonically_increasing_id())
    placed = materialize(ranged.withColumn("part", F.shiftright("at", ROW_BITS)), name)
    parts = placed.groupBy("tree", "part").agg(F.count("*").alias("held"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.sum("held").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("tree", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("held").over(tree).alias("n"))
    found = placed.join(parts, ["tree", "part"]).withColumn("pos", F.col("before") + F.col("at") - F.col("first"))
    return found.drop("at", "part", "first", "before", *order), placed


def _grown(leaves: DataFrame, fanout: int, name: str) -> tuple[list[DataFrame], DataFrame, list[DataFrame]]:
    """All levels above ``leaves`` (``tree, pos, n, load, digest``).

    Gives the tables of parents from the lowest level up (``tree, pos``, one struct of load and digest
    a slot), the tops (``tree, digest, height``), and the tables to release after use.
    """
    nodes = materialize(leaves, f"{name}-leaves")
    kept, parents, tops = [nodes], [], [nodes.where("n = 1").selectExpr("tree", "digest", "0 AS height")]
    slots = [f"slot{s}" for s in range(fanout)]
    width = nodes.agg(F.max("n")).first()[0] or 0
    while width > 1:
        own = F.struct(*[c for c in nodes.columns if c in ("load", "digest")])
        grouped = nodes.where("n > 1").groupBy("tree", "n", F.expr(f"pos div {fanout}").alias("up"))
        level = grouped.agg(*[F.first(F.when(F.col("pos") % fanout == s, own), ignorenulls=True).alias(slot) for s, slot in enumerate(slots)])
        level = level.select("tree", F.col("up").alias("pos"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), *slots,
                             digest(*[F.col(f"{s}.digest") for s in slots]).alias("digest"))
        table = materialize(level, f"{name}-level")
        kept.append(table)
        parents.append(table.select("tree", "pos", *slots))
        nodes, width = table.select("tree", "pos", "n", "digest"), -(-width // fanout)
        tops.append(nodes.where("n = 1").selectExpr("tree", "digest", f"{len(parents)} AS height"))
    return parents, reduce(DataFrame.union, tops), kept


def _proved(parents: Sequence[DataFrame], fanout: int, tops: DataFrame, singles: DataFrame) -> DataFrame:
    """``tree, load, digest, top, proof`` of every leaf, from ``tops`` (``tree, height, top, proof``) downwards."""
    slots = [f"slot{s}" for s in range(fanout)]
    hashes = [F.coalesce(F.col(f"{s}.digest"), F.lit("")) for s in slots]

    def entering(height: int) -> DataFrame:
        return tops.where(F.col("height") == height).select("tree", F.lit(0).cast("bigint").alias("pos"), "top", "proof")

    above = None
    for height in range(len(parents), 0, -1):
        here = entering(height) if above is None else entering(height).union(above.select("tree", "pos", "top", "proof"))
        steps = [F.when(F.col(slot).isNotNull(), F.struct(
            F.lit(s).alias("slot"), F.col(slot).alias("own"),
            F.struct(F.concat(F.lit(""), *hashes[:s]).alias("left"), F.concat(F.lit(""), *hashes[s + 1:]).alias("right")).alias("step"),
        )) for s, slot in enumerate(slots)]
        children = parents[height - 1].join(here, ["tree", "pos"]).select(
            "tree", "pos", "top", "proof", F.explode(F.array_compact(F.array(*steps))).alias("child"))
        above = children.select("tree", (F.col("pos") * fanout + F.col("child.slot")).alias("pos"), "top",
                                F.concat(F.array("child.step"), "proof").alias("proof"), "child.own")
    alone = singles.join(entering(0).drop("pos"), "tree").select("tree", "load", "digest", "top", "proof")
    return alone if above is None else alone.union(above.select("tree", "own.load", "own.digest", "top", "proof"))


def merkle_manifest(rows: DataFrame, key: str = "doc_id", by: str = "source", fields: Sequence[str] = FIELDS,
                    carry: Sequence[str] = (), fanout: int = FANOUT) -> DataFrame:
    """``key``, the ``carry`` columns, ``leaf, subroot, root, proof`` for every row of ``rows``.

    A leaf is the digest of ``fields``. The rows of one value of ``by`` are one tree, in the order of
    ``key``, null first, rows of one key by leaf; ``fanout`` nodes in a row have one parent, the last
    ones may be fewer, even one. The tops, ordered by ``by`` (null first, UTF-8 bytewise), are the
    leaves of the tree that ends in ``root``. ``proof`` lists from the leaf up what stands left and
    right of the own node, as concatenated hex; ``folded(leaf, proof)`` is the root.

    A null field is told apart from an empty one; a null in ``by`` is a group of its own. Repeated rows
    are rows, each with a place; which of two equal rows has which place is open. A lone row is its own
    top, with no step in its tree. An empty table gives an empty result. Columns not named are not read.
    """
    tree = F.coalesce(F.concat(F.lit(":"), F.col(by)), F.lit(""))  # null sorts before every value
    load = F.struct(F.col(key).alias("key"), F.struct(F.lit(0).alias("none"), *carry).alias("carry"))
    leaves = rows.select(tree.alias("tree"), load.alias("load"), leaf_digest([F.col(f) for f in fields]).alias("digest"))
    leaves = materialize(leaves.withColumns({"key": F.col("load.key"), "hash": F.col("digest")}), "merkle-rows")
    numbered, placed = _numbered(leaves, ["key", "hash"], "merkle-sorted")
    parents, tops, kept = _grown(numbered, fanout, "merkle")
    release(leaves, placed)
    heights = materialize(tops, "merkle-tops")
    upper = heights.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.struct("tree", "height").alias("load"), "digest")
    numbered, placed = _numbered(upper, ["name"], "merkle-tops-sorted")
    crown, summit, crown_kept = _grown(numbered, fanout, "merkle-crown")
    last = summit.first()
    root = None if last is None else last["digest"]
    steps = F.array().cast(PROOF)
    whole = _proved(crown, fanout, summit.select("tree", "height", F.col("digest").alias("top"), steps.alias("proof")),
                    crown_kept[0].where("n = 1"))
    groups = materialize(whole.select("load.tree", "load.height", F.col("digest").alias("top"), "proof"), "merkle-groups")
    release(heights, placed, *crown_kept)
    proved = _proved(parents, fanout, groups, kept[0].where("n = 1"))
    return proved.select(F.col("load.key").alias(key), *[F.col("load.carry").getField(c).alias(c) for c in carry],
                         F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.lit(root).cast("string").alias("root"), "proof")


def without_breaks(key: str = "doc_id", text: str = "text") -> Column:
    """The text without line feeds where 2 divides the CRC-32 of the key; a null key leaves it as it is."""
    return F.when(F.crc32(F.col(key).cast("string")) % 2 == 0, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))


def verified_manifest(docs: DataFrame) -> DataFrame:
    """Digest columns of the manifest of ``docs``, each row held against its proof after the tampering above.

    A row whose text has no line feed, or is null, is as it was and verifies.
    """
    other = leaf_digest([without_breaks() if f == "text" else F.col(f) for f in FIELDS])
    rows = docs.select(*FIELDS).withColumn("tampered_leaf", other)
    found = merkle_manifest(rows, carry=["tampered_leaf"])
    found = found.withColumn("folded_root", folded(F.col("tampered_leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values) + ")"


CRC_SQL = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda z: ascii(z)::BIGINT),
  lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
  lambda y, k: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)))"""

MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce(':' || source, '') AS tree, {_sql_leaf("text")} AS leaf,
         CASE WHEN {CRC_SQL} % 2 = 0 THEN {_sql_leaf("replace(text, chr(10), '')")} ELSE {_sql_leaf("text")} END AS other
  FROM documents),
placed AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes(lv, tree, pos, n, h) AS (
  SELECT 0, tree, pos, n, leaf FROM placed
  UNION ALL
  SELECT lv + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lv, tree, pos // 3, n),
tops AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
crown(lv, pos, n, h) AS (
  SELECT 0, pos, n, h FROM tops
  UNION ALL
  SELECT lv + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM crown WHERE n > 1 GROUP BY lv, pos // 3, n),
lower_steps AS (
  SELECT p.id, c.lv, coalesce(string_agg(c.h, '' ORDER BY c.pos) FILTER (c.pos < l.at), '') AS lo,
         coalesce(string_agg(c.h, '' ORDER BY c.pos) FILTER (c.pos > l.at), '') AS hi
  FROM (SELECT id, tree, lv, pos // (3 ** lv)::BIGINT AS at FROM placed, (SELECT DISTINCT lv FROM nodes WHERE n > 1)) l
  JOIN placed p ON p.id = l.id
  JOIN nodes c ON c.tree = l.tree AND c.lv = l.lv AND c.n > 1 AND c.pos // 3 = l.at // 3 GROUP BY ALL),
upper_steps AS (
  SELECT l.tree, c.lv, coalesce(string_agg(c.h, '' ORDER BY c.pos) FILTER (c.pos < l.at), '') AS lo,
         coalesce(string_agg(c.h, '' ORDER BY c.pos) FILTER (c.pos > l.at), '') AS hi
  FROM (SELECT tree, lv, pos // (3 ** lv)::BIGINT AS at FROM tops, (SELECT DISTINCT lv FROM crown WHERE n > 1)) l
  JOIN crown c ON c.lv = l.lv AND c.n > 1 AND c.pos // 3 = l.at // 3 GROUP BY ALL),
lower_proof AS (SELECT id, list(lo || '|' || hi ORDER BY lv) AS steps FROM lower_steps GROUP BY id),
upper_proof AS (SELECT tree, list(lo || '|' || hi ORDER BY lv) AS steps FROM upper_steps GROUP BY tree),
proved AS (
  SELECT p.*, t.h AS subroot, (SELECT h FROM crown WHERE n = 1) AS root,
         list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) AS steps
  FROM placed p JOIN tops t ON t.tree = p.tree LEFT JOIN lower_proof a ON a.id = p.id LEFT JOIN upper_proof b ON b.tree = p.tree),
folded AS (
  SELECT *, list_reduce([other] || steps, lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root FROM proved)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM folded
"""
