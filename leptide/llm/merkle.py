"""Merkle manifest of a table, with nested-interval labels.

Every row is a leaf; the leaves of a group (a source) stand in order and make
a tree of runs of `fan` nodes, and the roots of the groups make a tree of their
own. A node is labelled by the interval of leaf ranks it covers, and lies in
the bucket of its level that its place says, so the parent of a node is found
by a join on (level, tree, bucket) in which its interval contains the node's.
What the parent's interval covers besides the node's own are the siblings.

Rows are ranked over ranges of (group, order), never a whole group in a task.
A run has at most `fan` nodes, so no key of any join or grouping is hot. Proofs
travel down the levels with the inner nodes, one copy for the `fan` leaves of a
run; a row's own steps are put together where they are folded.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

FAN = 16
#: More levels than any count of rows that fits a long needs (fan of 2 or more).
MOST_LEVELS = 63


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def fold(start: Column, steps: Column) -> Column:
    """Root reached from a leaf: every step hashes what stands left and right of the node."""
    return F.aggregate(steps, start, lambda h, s: digest(s["left"], h, s["right"]))


def proof(steps: Column) -> Column:
    """All siblings of all levels, from the leaf up, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def _height(n: Column, fan: int) -> Column:
    """How often n nodes have to be run together until one is left."""
    over = F.filter(F.sequence(F.lit(0), F.lit(MOST_LEVELS)), lambda i: F.pow(F.lit(float(fan)), i) < n.cast("double"))
    return F.size(over)


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with `part`, a range of the order, and `pos`, their position over all from 0.

    The sorted table is written, so that positions stay as they are. One total
    a range is all that a single task sums up.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    done = saved(ranged.withColumn("at", F.monotonically_increasing_id()), "sorted")
    done = done.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    totals = done.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return done.join(offsets, "part").withColumn("pos", F.col("before") + F.col("at")).drop("at", "before")


@dataclass
class Tree:
    """levels[k - 1]: nodes of level k: (tree, at, lo, hi, digest, children); a child has lo, hi, digest and what was carried."""

    levels: list[DataFrame]
    tops: DataFrame  # (tree, lo, hi, digest): the last node of each tree


def grow(nodes: DataFrame, *, fan: int = FAN, name: str = "nodes") -> Tree:
    """Run nodes (tree, at, lo, hi, digest, height, carried...) together, level by level."""
    carried = [c for c in nodes.columns if c not in ("tree", "at", "height")]
    most = nodes.agg(F.max("height")).first()[0] or 0
    plain = ["tree", "lo", "hi", "digest"]
    levels, tops = [], nodes.where("height = 0").select(*plain)
    for k in range(1, most + 1):
        child = F.struct("lo", "hi", "digest", *[c for c in carried if c not in plain])
        runs = nodes.where(F.col("height") >= k).groupBy("tree", F.floor(F.col("at") / fan).alias("at")).agg(
            F.sort_array(F.collect_list(child)).alias("children"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("height").alias("height")
        )
        joined = F.array_join(F.transform("children", lambda c: c["digest"]), "")
        nodes = saved(runs.withColumn("digest", digest(joined)), f"{name}-{k}")
        levels.append(nodes)
        tops = tops.unionByName(nodes.where(F.col("height") == k).select(*plain))
        carried = plain[1:]
    return Tree(levels, tops)


def _step(children: Column, lo: Column, hi: Column) -> Column:
    """The interval difference in a parent: digests before the node's interval and after it."""
    text = lambda keep: F.array_join(F.transform(F.filter(children, keep), lambda c: c["digest"]), "")
    return F.struct(text(lambda c: c["hi"] <= lo).alias("left"), text(lambda c: c["lo"] >= hi).alias("right"))


def descend(tree: Tree, tops: DataFrame, *, fan: int = FAN) -> DataFrame:
    """(tree, at, lo, hi, children, steps, told...) of every run of level 1.

    tops: (tree, steps, told...) for each tree: the steps above its root.
    `steps` of a run lead from the run's digest up. Each level is joined with
    the one above by bucket and containment.
    """
    told = [c for c in tops.columns if c not in ("tree", "steps")]
    above = None
    for k in range(len(tree.levels), 0, -1):
        level = tree.levels[k - 1]
        own = level.where(F.col("height") == k).join(tops, "tree").select("tree", "at", "lo", "hi", "children", "steps", *told)
        if above is not None:
            node, parent = level.where(F.col("height") > k).alias("n"), above.alias("p")
            inside = (
                (F.col("n.tree") == F.col("p.tree")) & (F.floor(F.col("n.at") / fan) == F.col("p.at"))
                & (F.col("p.lo") <= F.col("n.lo")) & (F.col("n.hi") <= F.col("p.hi"))
            )
            steps = F.concat(F.array(_step(F.col("p.children"), F.col("n.lo"), F.col("n.hi"))), F.col("p.steps"))
            under = node.join(parent, inside).select("n.tree", "n.at", "n.lo", "n.hi", "n.children", steps.alias("steps"), *[f"p.{c}" for c in told])
            own = own.unionByName(under)
        above = own
    return above


def manifest(rows: DataFrame, *, group: str, order: str, leaf: str, carry: Sequence[str] = (), fan: int = FAN) -> DataFrame:
    """(order, leaf, carried..., subroot, root, steps) for every row.

    `leaf` names a column with the row's digest. Groups stand by their value,
    null first, strings by their bytes; rows of a group by `order`, null first;
    rows of equal order by their digest, so that repeated rows have a defined
    tree. `steps` is the inclusion proof, from the leaf up: struct(left, right)
    of the siblings' digests. A group of one row has its leaf for a subroot, a
    single group its subroot for the root. An empty table gives no rows.
    `carry` names further columns of `rows` that the result keeps.
    """
    at = rows.select(F.col(group).alias("grp"), F.col(order).alias("ord"), F.col(leaf).alias("digest"), F.struct(*carry, F.lit(0).alias("_")).alias("extra"))
    leaves = placed(saved(at, "leaves"), "grp", "ord", "digest")
    groups = leaves.groupBy("grp").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    numbered = placed(groups, "first").withColumnRenamed("pos", "tree").drop("part")
    numbered = saved(numbered.withColumn("height", _height(F.col("n"), fan)), "groups")
    # a group of many ranges meets its number once a range
    parts = leaves.select("part", "grp").distinct().join(numbered.withColumnRenamed("grp", "its"), F.col("grp").eqNullSafe(F.col("its"))).select(
        F.col("part").alias("in_part"), "its", "tree", "first", "height"
    )
    nodes = leaves.join(parts, (F.col("part") == F.col("in_part")) & F.col("grp").eqNullSafe(F.col("its"))).select(
        "tree", (F.col("pos") - F.col("first")).alias("at"), F.col("pos").alias("lo"), (F.col("pos") + 1).alias("hi"), "digest", "height", "ord", "extra"
    )
    nodes = saved(nodes, "ranked")
    trees = grow(nodes, fan=fan, name="runs")

    n = numbered.count()
    tops = trees.tops.select(F.lit(0).alias("tree"), F.col("tree").alias("at"), "lo", "hi", "digest").withColumn("height", _height(F.lit(n), fan))
    tops = saved(tops, "subroots")
    over = grow(tops, fan=fan, name="over")
    subroot = {"subroot": F.col("digest"), "tree": F.col("at")}
    none = F.array().cast("array<struct<left:string,right:string>>")
    if over.levels:
        root = over.tops.select("tree", F.col("digest").alias("root"), none.alias("steps"))
        run = descend(over, root, fan=fan)
        c = F.col("c")
        paths = run.withColumn("c", F.explode("children")).join(tops.select(F.col("at").alias("number"), F.col("lo").alias("c_lo")), F.col("c.lo") == F.col("c_lo")).select(
            F.col("number").alias("tree"), F.concat(F.array(_step(F.col("children"), c["lo"], c["hi"])), "steps").alias("steps"), c["digest"].alias("subroot"), "root"
        )
    else:
        paths = tops.select(F.col("at").alias("tree"), none.alias("steps"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    paths = saved(paths, "paths")

    told = ["subroot", "root"]
    extra = [F.col("extra").getField(c).alias(c) for c in carry]
    alone = nodes.where("height = 0").join(paths, "tree").select(F.col("ord").alias(order), F.col("digest").alias(leaf), *extra, *told, "steps")
    if not trees.levels:
        return alone
    runs = descend(trees, paths, fan=fan)
    c = F.col("c")
    out = runs.withColumn("c", F.explode("children")).select(
        c["ord"].alias(order), c["digest"].alias(leaf), *[c["extra"].getField(x).alias(x) for x in carry], *told,
        F.concat(F.array(_step(F.col("children"), c["lo"], c["hi"])), "steps").alias("steps"),
    )
    return out.unionByName(alone)


def _sql(levels: int = 4, fan: int = FAN) -> str:
    """The same level by level in another engine's SQL, for groups of up to fan ** levels rows."""
    enc = lambda c: f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
    leaf_of = lambda text: "sha256(" + " || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    shifted = "list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda z: ord(z)::bigint)), lambda c, b: {shifted}), 4294967295)"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(p: str) -> str:
        out = ""
        for k in range(levels):
            out += f""",
{p}{k + 1} as (select tree, i // {fan} as i, (n + {fan - 1}) // {fan} as n, sha256(string_agg(d, '' order by i)) as d from {p}{k} where n > 1 group by tree, i // {fan}, n),
{p}s{k} as (select a.tree, a.i, coalesce(string_agg(b.d, '' order by b.i) filter (b.i < a.i), '') as l, coalesce(string_agg(b.d, '' order by b.i) filter (b.i > a.i), '') as r
  from {p}{k} a join {p}{k} b on a.tree = b.tree and a.i // {fan} = b.i // {fan} where a.n > 1 group by a.tree, a.i)"""
        return out + f""",
{p}top as ({" union all ".join(f"select tree, d from {p}{k} where n = 1" for k in range(levels + 1))})"""

    folds, last, at = "", "y", "i"
    for p, tree_, first in (("a", "y.tree", "i"), ("b", "0", "tree")):
        for k in range(levels):
            place = f"(y.{first} // {fan ** k})"
            name = f"y{p}{k}"
            folds += f""",
{name} as (select y.* exclude (h, proof), case when s.tree is null then h else sha256(s.l || h || s.r) end as h, case when s.tree is null then proof else proof || s.l || s.r end as proof
  from {last} y left join {p}s{k} s on s.tree = {tree_} and s.i = {place})"""
            last = name
    return rf"""
with x as (select doc_id, source, {leaf_of("text")} as leaf, {leaf_of(f"case when {crc} % 5 = 0 then {low} else text end")} as seen, dense_rank() over (order by source nulls first) - 1 as tree from documents),
a0 as (select *, leaf as d, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by tree) as n from x){tree("a")},
b0 as (select 0 as tree, tree as i, count(*) over () as n, d from atop){tree("b")},
y as (select a0.doc_id, a0.leaf, a0.tree, a0.i, seen as h, '' as proof, atop.d as subroot, btop.d as root from a0 join atop using (tree), btop){folds}
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, h as folded_root, h = root as verified from {last}
"""


SQL = _sql()
