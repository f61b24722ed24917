"""A Merkle manifest of a dataset, with the proof of every row, by a butterfly exchange.

Leaves are numbered per group and dealt in blocks of ``fanout ** depth``
neighbours. A task hashes a block's own subtree. Then the blocks exchange:
in each round, aligned groups of ``fanout`` blocks that differ in one digit
of their number swap their subtree roots, and each hashes the parent for
itself. After a round every block knows one more ancestor and the siblings
beside it; after the last it has the whole upper proof and the root, without
a pass back down. Blocks that the last digit lacks are filled up by empty
ones, which take part so that each group is complete and add nothing to a
hash; there are fewer than ``fanout`` times as many.

A round moves one short row a block. A group of any size is only ever many
blocks. The group roots are the leaves of the upper tree, which is built by
the same functions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from omoplate.llm.common import broadcast_if_small, crc32_sql, cut_lineage, ready, table
from omoplate.llm.packing import numbered

FANOUT = 2
DEPTH = 11
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sized(c: Column) -> Column:
    """UTF-8 byte count, colon, value; a null is a dash."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes: list[str], fanout: int, depth: int | None) -> list[list[str]]:
    """The levels of a tree from the leaves up: ``depth`` of them above the leaves, or up to one node if None."""
    out = [nodes]
    while len(out) <= depth if depth is not None else len(out[-1]) > 1:
        low = out[-1]
        out.append([_hash(low[i:i + fanout]) for i in range(0, len(low), fanout)])
    return out


def path(tree: list[list[str]], at: int, fanout: int) -> list[tuple[str, str]]:
    """For a leaf, level by level, the digests left and right of its own in its run."""
    out = []
    for low in tree[:-1]:
        run = at - at % fanout
        out.append(("".join(low[run:at]), "".join(low[at + 1:run + fanout])))
        at //= fanout
    return out


def fold(node: str, siblings: list) -> str:
    """The root that a node and its path lead to."""
    for left, right in siblings:
        node = _hash([left, node, right])
    return node


def exchange(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``blocks``: grp, block (from 0 in each grp, none missing), node and how many the grp has, n_blocks.
    Adds ``upper``, the array of (left, right) from the block to its group's root, and ``top``, that root."""
    most = blocks.agg(F.max("n_blocks")).collect()[0][0] or 0
    rounds = 0
    while fanout ** rounds < most:
        rounds += 1
    # the empty blocks behind the last of each group, up to a power of the fanout
    power = F.coalesce(*[F.when(F.col("n_blocks") <= fanout ** r, fanout ** r) for r in range(rounds)], F.lit(fanout ** rounds))
    state = blocks.select("grp", "block", "node", "n_blocks", power.cast("long").alias("power"))
    empty = state.filter((F.col("block") == F.col("n_blocks") - 1) & (F.col("n_blocks") < F.col("power"))).select(
        "grp", F.explode(F.sequence("n_blocks", F.col("power") - 1)).alias("block"),
        F.lit(None).cast("string").alias("node"), "n_blocks", "power")
    state = state.unionByName(empty).withColumn("upper", F.array().cast("array<struct<left:string,right:string>>"))
    for r in range(rounds):
        step = fanout ** r
        digit = F.floor(F.col("block") / step) % fanout
        taking = F.col("power") > step  # smaller groups have their root already
        # all digits but this one; blocks that take no part are groups of their own
        rest = F.when(taking, F.col("block") - digit * step).otherwise(F.col("block"))
        swap = Window.partitionBy("grp", rest)
        state = state.withColumn("digit", digit).withColumn(
            "_run", F.when(taking, F.array_sort(F.collect_list(
                F.when(F.col("node").isNotNull(), F.struct("digit", "node"))).over(swap))))
        pick = lambda test: F.concat_ws("", F.transform(F.filter("_run", test), lambda x: x["node"]))
        # an empty block keeps no proof, but knows the nodes above it like any other
        state = state.withColumn("upper", F.when(taking, F.concat("upper", F.array(F.struct(
            pick(lambda x: x["digit"] < F.col("digit")).alias("left"),
            pick(lambda x: x["digit"] > F.col("digit")).alias("right"))))).otherwise(F.col("upper")))
        state = state.withColumn("node", F.when(~taking, F.col("node")).when(
            F.size("_run") > 0, digest(pick(lambda x: F.lit(True))))).drop("_run", "digit")
    return state.filter(F.col("block") < F.col("n_blocks")).select("grp", "block", "upper", F.col("node").alias("top"))


_PACKED = "grp string, block long, n_blocks long, ids array<long>, leaves binary, changed binary, node string"


def _blocks(leaves: DataFrame, fanout: int, depth: int) -> DataFrame:
    """One row per block of ``leaves`` (grp, at, n, doc_id, leaf, changed), with its leaves as they follow."""
    size = fanout ** depth

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        n = t.column("n")[0].as_py()
        leaf = t.column("leaf").to_pylist()
        top = levels(leaf, fanout, depth if n > size else None)[-1]
        return pa.table({
            "grp": pa.array([t.column("grp")[0].as_py()], pa.string()), "block": pa.array([t.column("block")[0].as_py()], pa.int64()),
            "n_blocks": pa.array([-(-n // size)], pa.int64()), "ids": pa.array([t.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            "leaves": pa.array([bytes.fromhex("".join(leaf))], pa.binary()),
            "changed": pa.array([bytes.fromhex("".join(t.column("changed").to_pylist()))], pa.binary()),
            "node": pa.array(top, pa.string())})

    dealt = leaves.withColumn("block", F.floor(F.col("at") / size).cast("long"))
    return dealt.groupBy("grp", "block").applyInArrow(pack, _PACKED)


_PROVED = "grp string, doc_id long, leaf string, changed string, path array<struct<left:string,right:string>>, top string"


def prove(leaves: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """``leaves``: grp, at (from 0 in each grp), n (leaves of the grp), doc_id, leaf, changed (both hex).
    Returns each leaf with its ``path`` to the root of its group, ``top``; and each grp with its top."""
    packed = cut_lineage(_blocks(leaves, fanout, depth))
    upper = cut_lineage(exchange(packed.select("grp", "block", "node", "n_blocks"), fanout))
    size, pairs = fanout ** depth, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                both = [[row[k][i:i + 32].hex() for i in range(0, len(row[k]), 32)] for k in ("leaves", "changed")]
                tree = levels(both[0], fanout, depth if row["n_blocks"] > 1 else None)
                above = [(x["left"], x["right"]) for x in row["upper"]]
                for at in range(0, len(both[0]), 512):
                    part = range(at, min(at + 512, len(both[0])))
                    paths = [[{"left": x, "right": y} for x, y in path(tree, i, fanout) + above] for i in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["grp"]] * len(part), pa.string()), pa.array([row["ids"][i] for i in part], pa.int64()),
                         *(pa.array([x[i] for i in part], pa.string()) for x in both), pa.array(paths, pairs),
                         pa.array([row["top"]] * len(part), pa.string())],
                        names=["grp", "doc_id", "leaf", "changed", "path", "top"])

    same = packed["grp"].eqNullSafe(upper["grp"]) & (packed["block"] == upper["block"])
    proved = packed.join(upper, same).select(packed["grp"], packed["n_blocks"], "ids", "leaves", "changed", "upper", "top"
                                             ).mapInArrow(unpack, _PROVED)
    return proved, upper.filter("block = 0").select("grp", "top")


def _placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Numbers the leaves of each grp in order, from 0: ``at``, and their number ``n``. Rows are numbered
    over all groups by range, so a group that holds most rows is spread like any other."""
    all_ = numbered(leaves, ["grp", *order], "place")
    groups = all_.groupBy(F.col("grp").alias("_grp")).agg(F.min("place").alias("_first"), F.count(F.lit(1)).alias("n"))
    return all_.join(broadcast_if_small(cut_lineage(groups)), F.col("grp").eqNullSafe(F.col("_grp"))).withColumn(
        "at", F.col("place") - F.col("_first")).drop("_grp", "_first", "place")


def manifest(docs: DataFrame, fanout: int = FANOUT, depth: int = DEPTH, tampered: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the SHA-256 of doc_id, source, lang, n_chars and text, each
    with its length or a dash if null, so a null differs from an empty
    text. The trees of the languages (null is one of them, and the first)
    stand under one root in the order of their names. Rows that share a
    doc_id follow by leaf, rows without one come first; equal rows are
    leaves of their own. Where ``tampered`` holds, the row is checked with
    its n_chars one higher; a null n_chars stays null and so verifies. A
    text is hashed where it is read, however long. An empty table gives no
    rows; other columns are ignored.
    """
    ready(docs.sparkSession)
    fields = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"),
                         F.col("text").cast("string").alias("text"))
    changed = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    one = lambda more: digest(*[sized(F.col(f) + more if f == "n_chars" else F.col(f)) for f in FIELDS])
    leaf = one(F.lit(0).cast("long"))
    rows = fields.select(F.col("lang").cast("string").alias("grp"), "doc_id", leaf.alias("leaf"),
                         F.when(changed, one(F.lit(1).cast("long"))).alias("changed"))
    # rows that are equal in all three could not be spread by range without a number of their own
    rows = cut_lineage(rows.withColumn("changed", F.coalesce("changed", "leaf")).withColumn("row", F.monotonically_increasing_id()))
    proved, subroots = prove(_placed(rows, ["doc_id", "leaf", "row"]).drop("row"), fanout, depth)
    # the leaves of the upper tree; their place in it serves as their id
    tops = cut_lineage(_placed(subroots.select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("name"),
                                               F.col("top").alias("leaf"), F.col("top").alias("changed")), ["name"]))
    above, _ = prove(tops.withColumn("doc_id", F.col("at")).drop("name"), fanout, depth)
    above = above.select(F.col("doc_id").alias("at"), F.col("path").alias("_above"), F.col("top").alias("root"))
    above = broadcast_if_small(cut_lineage(above.join(tops.select("at", F.col("name").alias("_name")), "at").drop("at")))
    whole = proved.join(above, F.col("grp").eqNullSafe(F.col("_name"))).withColumn("path", F.concat("path", "_above"))
    up = lambda node: F.aggregate("path", node, lambda x, s: digest(s["left"], x, s["right"]))
    proof = digest(F.concat_ws("", F.transform("path", lambda s: F.concat(s["left"], s["right"]))))
    return whole.select("doc_id", "leaf", F.col("top").alias("subroot"), "root", proof.alias("proof_sha256"),
                        up(F.col("changed")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)


_SIZED = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_SIZED.format(f) for f in FIELDS) + ")"

ORACLE_SQL = {"op12_merkle_manifest": f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_LEAF} AS leaf,
         CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 7 = 0 THEN {_LEAF.replace("n_chars", "(n_chars + 1)")} ELSE {_LEAF} END AS changed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
low AS (
  SELECT lang, 0 AS level, pos, leaf AS node, n FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
  FROM low WHERE n > 1 GROUP BY lang, level, pos // 2, n),
tops AS (
  SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, pos, node, n FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
  FROM high WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (
  SELECT p.doc_id, p.lang, p.pos AS leaf_at, l.level, (p.pos >> l.level) % 2 = 1 AS right_hand, s.node AS sibling
  FROM placed p JOIN (SELECT DISTINCT lang, level FROM low WHERE n > 1) l ON p.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN low s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT p.doc_id, p.lang, p.pos, 1000 + l.level, (t.pos >> l.level) % 2 = 1, s.node
  FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang, (SELECT DISTINCT level FROM high WHERE n > 1) l
  LEFT JOIN high s ON s.level = l.level AND s.pos = xor(t.pos >> l.level, 1)),
ordered AS (
  SELECT lang, leaf_at, list(struct_pack(r := right_hand, s := coalesce(sibling, '')) ORDER BY level) AS path,
         sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof
  FROM steps GROUP BY lang, leaf_at),
folded AS (
  SELECT p.lang, p.pos, 1 AS i, p.changed AS node, coalesce(o.path, []) AS path, coalesce(o.proof, sha256('')) AS proof
  FROM placed p LEFT JOIN ordered o ON p.lang IS NOT DISTINCT FROM o.lang AND p.pos = o.leaf_at
  UNION ALL
  SELECT lang, pos, i + 1, sha256(CASE WHEN path[i].r THEN path[i].s || node ELSE node || path[i].s END), path, proof
  FROM folded WHERE i <= len(path))
SELECT p.doc_id, p.leaf, t.node AS subroot, (SELECT node FROM high WHERE n = 1) AS root, f.proof AS proof_sha256,
       f.node AS folded_root, f.node = (SELECT node FROM high WHERE n = 1) AS verified
FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang
JOIN folded f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos AND f.i = len(f.path) + 1
"""}
