"""Merkle dataset manifest by checkpoint-and-recompute.

Every row is a leaf: the SHA-256 of its fields. Within a source the leaves
stand by id; every ``FAN`` consecutive nodes become one node of the next
level until one is left, the source's subroot. The subroots, by source, give
the root in the same way.

* Positions come from ranges that are written once: a row's number among its
  source's rows in its range, plus the source's rows in the ranges before (a
  table of one row a range and source). A source that holds a third of all rows spreads
  over many ranges, so no task holds a source.
* Only every ``STRIDE``-th level is written (levels 0, 2, 4 ...). A stored
  level's nodes are grouped into aligned subtrees of ``FAN ** STRIDE`` nodes,
  which climb ``STRIDE`` levels at once; what lies between is not kept.
* A proof regenerates the missing interior nodes of each aligned subtree from
  its stored nodes, emits the siblings left and right of every node's path,
  appends the path of the subtree's own top, and drops the interior nodes.

A tree of n leaves has the least height h with ``FAN ** h >= n``; a run may
have one node, which is hashed like any other. A lone leaf is its own subroot.

Fields: each is ``-`` if null, else its UTF-8 byte count, ``:`` and its value,
so null and empty differ. Rows without an id come first in their source, the
rows without a source are the first source. Equal ids stand by leaf; equal
rows are leaves of their own, in any order, which changes no digest. An empty
table has no root (None) and no proofs. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.sinks import checkpoint

FAN = 16
STRIDE = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = "top"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(fields: Mapping[str, Column] | None = None) -> Column:
    """The leaf of a row; ``fields`` replaces columns of ``FIELDS``."""
    def framed(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(*[framed((fields or {}).get(c, F.col(c))) for c in FIELDS])


def height(n: Column) -> Column:
    """The least h with FAN ** h >= n."""
    powers = [FAN ** i for i in range(64) if FAN ** i < 1 << 63]
    return F.size(F.filter(F.array(*[F.lit(p).cast("bigint") for p in powers]), lambda p: p < n))


@dataclass
class Tree:
    """Trees of many groups: ``levels[i]`` has the nodes of level i * STRIDE (grp, pos, hash, height)."""
    levels: list[DataFrame]
    roots: DataFrame  # grp, root


@dataclass
class Manifest:
    root: str | None
    sources: Tree
    top: Tree
    carried: list[str] = field(default_factory=list)


def _placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with ``grp``, the first of ``order``) with ``pos`` within the group and the group's ``height``."""
    by = [F.col(c).asc_nulls_first() for c in order]
    ranged = checkpoint(rows.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), name)
    of = Window.partitionBy("grp")
    spans = ranged.groupBy("grp", "_part").agg(F.count("*").alias("_n"))
    offsets = spans.select("grp", "_part", height(F.sum("_n").over(of)).alias("height"),
                           (F.sum("_n").over(of.orderBy("_part")) - F.col("_n") - 1).alias("_shift"))
    here = F.row_number().over(Window.partitionBy("_part", "grp").orderBy(*by[1:]))
    return ranged.withColumn("_here", here).join(offsets, ["grp", "_part"]).withColumn("pos", F.col("_here") + F.col("_shift")).drop("_part", "_here", "_shift")


def _above(line: Column) -> Column:
    """The next level over a line of digests."""
    runs = F.sequence(F.lit(0).cast("bigint"), F.floor((F.size(line) - 1) / FAN))
    return F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(line, (r * FAN + 1).cast("int"), FAN), "").cast("binary"), 256))


def _blocks(nodes: DataFrame, level: int, carried: list[str] = ()) -> DataFrame:
    """Aligned subtrees over a stored level: grp, block, height, nodes and the levels l0 .. l<STRIDE> over them."""
    node = F.struct("pos", "hash", *carried)
    out = (nodes.where(F.col("height") > level)
           .groupBy("grp", "height", F.expr(f"pos div {FAN ** STRIDE}").alias("block"))
           .agg(F.sort_array(F.collect_list(node)).alias("nodes")).withColumn("l0", F.col("nodes.hash")))
    for j in range(STRIDE):
        below = F.col(f"l{j}")
        out = out.withColumn(f"l{j + 1}", F.when(F.col("height") > level + j, _above(below)).otherwise(below))
    return out


def _grow(leaves: DataFrame, name: str) -> Tree:
    """The stored levels over ``leaves`` (grp, pos, hash, height and others)."""
    levels, roots, level = [leaves], [], 0
    most = leaves.agg(F.max("height")).first()[0] or 0
    while True:
        here = levels[-1]
        roots.append(here.where(F.col("height") <= level).select("grp", F.col("hash").alias("root")))
        if most <= level:
            break
        up = _blocks(here.select("grp", "pos", "hash", "height"), level).select(
            "grp", F.col("block").alias("pos"), F.col(f"l{STRIDE}")[0].alias("hash"), "height")
        level += STRIDE
        levels.append(checkpoint(up, f"{name}-{level}"))
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return Tree(levels, out)


def _step(i: Column, j: int) -> Column:
    """The siblings of node i's ancestor j levels up, within its run."""
    at = F.floor(i / FAN ** j).cast("int")
    q = at % FAN
    line = F.col(f"l{j}")
    return F.struct(F.array_join(F.slice(line, at - q + 1, q), "").alias("left"),
                    F.array_join(F.slice(line, at + 2, FAN - 1 - q), "").alias("right"))


def _paths(tree: Tree, above: DataFrame, carried: list[str] = ()) -> DataFrame:
    """grp, root, the leaf's ``hash`` and ``carried`` columns, and ``path``: the siblings level by level.
    ``above`` (grp, root, path) has the path of each group's root."""
    tops = above.select("grp", "root", F.col("path").alias("_above"))
    found: DataFrame | None = None  # of the stored level above: grp, pos, root, path
    for k in reversed(range(len(tree.levels))):
        level, extra = k * STRIDE, list(carried) if k == 0 else []
        nodes = tree.levels[k].select("grp", "pos", "hash", "height", *extra)
        # a group that ends at this level or below it: its only node is the root
        out = nodes.where(F.col("height") <= level).join(tops, "grp").select(
            "grp", "pos", "root", "hash", F.col("_above").alias("path"), *extra)
        if found is not None:
            parents = found.select("grp", F.col("pos").alias("block"), "root", F.col("path").alias("_above"))

            def path(i: Column, level: int = level) -> Column:
                own = [F.when(F.col("height") > level + j, F.array(_step(i, j))).otherwise(F.array().cast("array<struct<left:string,right:string>>"))
                       for j in range(STRIDE)]
                return F.concat(*own, F.col("_above"))
            each = F.transform("nodes", lambda x, i: F.struct(x.alias("node"), path(i).alias("path")))
            inner = (_blocks(nodes, level, extra).join(parents, ["grp", "block"]).select("grp", "root", F.explode(each).alias("_e"))
                     .select("grp", "_e.node.pos", "root", "_e.node.hash", "_e.path", *[F.col(f"_e.node.{c}") for c in extra]))
            out = out.unionByName(inner)
        found = out
    return found


def build(docs: DataFrame, carry: Mapping[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``. ``carry`` names further columns, computed beside
    the leaf in the one scan of the table, that the proofs return."""
    carry = {"doc_id": F.col("doc_id"), **(carry or {})}
    rows = docs.select(F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("grp"),
                       leaf().alias("hash"), *[v.alias(k) for k, v in carry.items()])
    sources = _grow(_placed(checkpoint(rows, "merkle-rows"), ["grp", "doc_id", "hash"], "merkle-leaves"), "merkle-level")
    subroots = sources.roots.select(F.lit(_TOP).alias("grp"), F.col("grp").alias("source"), F.col("root").alias("hash"))
    top = _grow(_placed(subroots, ["grp", "source"], "merkle-sources"), "merkle-top")
    found = top.roots.first()
    return Manifest(found["root"] if found else None, sources, top, list(carry))


def proofs(m: Manifest) -> DataFrame:
    """leaf, subroot, path (array of the siblings left and right, level by level
    from the leaf to the root) and the carried columns, one row a leaf."""
    none = F.array().cast("array<struct<left:string,right:string>>")
    root = m.top.roots.select("grp", "root", none.alias("path"))
    tops = _paths(m.top, root, ["source"]).select(F.col("source").alias("grp"), F.col("hash").alias("root"), "path")
    return _paths(m.sources, tops, m.carried).select(
        *m.carried, F.col("hash").alias("leaf"), F.col("root").alias("subroot"), "path")


def siblings(path: Column) -> Column:
    """All siblings of a path as one text, left to right, level by level."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]).cast("binary"), 256))
