"""Merkle manifest of a dataset by slot pivots, with inclusion proofs that fold to the root.

Every row is a leaf; leaves of a group (a language) ascend by key and hash up to a subroot,
subroots ascend by group and hash up to the root. A node's children are ``fanout``
consecutive nodes of the level below (the last run may be shorter, even a lone node), and
its digest is that of their digests, concatenated.

1. Leaves are numbered inside their group by a distributed sort (``dense_key``); only
   digests and keys are moved, never texts.
2. Slot pivot: conditional aggregates spread the nodes under one ancestor into columns, one
   per slot; concatenating the columns of a run hashes their parent. One shuffle spreads
   the children of several levels (``fanout ** steps`` slots, at most ``SLOTS``), so there
   are about log(rows) / log(16) shuffles, each a sixteenth of the one before.
   Leaves arrive sorted, so map tasks merge nearly all slots before the shuffle.
3. Siblings are the columns of a run without the own slot. Paths go down again block by
   block: a block's row takes the path above it and hands each child its own.

A group's number is its place in the order of groups (null first, bytewise), numbered the
same way; no group, level or path is collected. Only the largest group's size and the root
reach the driver.

Nulls: a null field is ``-``, a null key sorts first, null is a group of its own. Rows with
equal keys are ordered by leaf; wholly equal rows get each other's places in either order.
An empty table gives no rows. Columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from ..operators.sizing import small_side
from .common import stage

#: Most slots spread by one shuffle.
SLOTS = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<l:string,r:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else number of UTF-8 bytes, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def siblings(path: Column) -> Column:
    """The path's sibling digests, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), "")


def _steps(fanout: int) -> int:
    steps = 1
    while fanout ** (steps + 1) <= SLOTS:
        steps += 1
    return steps


def _levels_up(n: int, fanout: int) -> int:
    """Levels over ``n`` nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def _blocks(nodes: DataFrame, fanout: int, payload: Sequence[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """Pivot nodes (g, pos, n, digest, payload) level by level.

    Returns the stored block tables (bottom first) and (g, top): each group's last node.
    Block columns: g, blk, up (levels that the group still has in the block), more, d<t>_<j>
    (digest of the j-th node at level t of the block) and, at the bottom, p<j> (payload).
    """
    steps = _steps(fanout)
    width = fanout**steps
    largest = nodes.agg(F.max("n")).first()[0]
    tables: list[DataFrame] = []
    tops: DataFrame | None = None
    while True:
        lifted = not tables
        carried = F.struct(*payload) if lifted and payload else None
        place = nodes.select("*", F.expr(f"pos div {width}").alias("blk"), (F.col("pos") % width).alias("slot"))
        slots = [F.max(F.when(F.col("slot") == j, F.col("digest"))).alias(f"d0_{j}") for j in range(width)]
        if carried is not None:
            slots += [F.max(F.when(F.col("slot") == j, carried)).alias(f"p{j}") for j in range(width)]
        spread = place.groupBy("g", "blk", "n").agg(*slots)
        # n nodes remain in the group at this level: it ends in this block if they fit.
        up = F.lit(steps)
        for t in reversed(range(steps)):
            up = F.when(F.col("n") <= fanout**t, t).otherwise(up)
        spread = spread.withColumn("up", up).withColumn("more", F.col("n") > width)
        for t in range(steps):
            parents = []
            for j in range(width // fanout ** (t + 1)):
                run = [F.col(f"d{t}_{j * fanout + i}") for i in range(fanout)]
                # Children fill a run from the left, so the first tells whether there is a parent.
                parents.append(F.when(run[0].isNotNull() & (F.col("up") > t), F.sha2(F.concat_ws("", *run), 256)).alias(f"d{t + 1}_{j}"))
            spread = spread.select("*", *parents)
        table = stage(spread, f"{name}-{len(tables)}")
        tables.append(table)
        top = F.coalesce(*[F.when(F.col("up") == t, F.col(f"d{t}_0")) for t in range(steps + 1)])
        ended = table.filter(~F.col("more")).select("g", top.alias("top"))
        tops = ended if tops is None else tops.union(ended)
        if largest is None or largest <= width:
            return tables, tops
        largest = -(-largest // width)
        nodes = table.filter("more").select("g", F.col("blk").alias("pos"), F.ceil(F.col("n") / width).cast("long").alias("n"), F.col(f"d{steps}_0").alias("digest"))


def _children(blocks: DataFrame, above: DataFrame, fanout: int, payload: bool) -> DataFrame:
    """(g, pos, path, subroot, payload) of every node at the bottom of ``blocks``; ``above`` holds (g, blk, path, subroot)."""
    steps = _steps(fanout)
    width = fanout**steps
    rows = blocks.join(above, ["g", "blk"])
    nodes = []
    for j in range(width):
        path = []
        for t in range(steps):
            own = j // fanout**t
            first = own - own % fanout
            left = F.concat_ws("", *[F.col(f"d{t}_{i}") for i in range(first, own)])
            right = F.concat_ws("", *[F.col(f"d{t}_{i}") for i in range(own + 1, first + fanout)])
            path.append(F.struct(left.alias("l"), right.alias("r")))
        inside = F.slice(F.array(*path), F.lit(1), F.col("up"))
        parts = [F.lit(j).alias("slot"), F.col(f"d0_{j}").alias("digest"), inside.alias("inside")]
        nodes.append(F.struct(*parts, *([F.col(f"p{j}").alias("payload")] if payload else [])))
    every = rows.select("g", "blk", "path", "subroot", F.explode(F.array(*nodes)).alias("node")).filter(F.col("node.digest").isNotNull())
    pos = (F.col("blk") * width + F.col("node.slot")).alias("pos")
    path = F.concat("node.inside", "path").cast(PATH).alias("path")
    return every.select("g", pos, path, "subroot", "node.digest", *([F.col("node.payload").alias("payload")] if payload else []))


def _paths(tables: list[DataFrame], ends: DataFrame, fanout: int, payload: bool) -> DataFrame:
    """Paths of the bottom nodes; ``ends`` holds (g, path, subroot): the path above each group's last node."""
    given: DataFrame | None = None
    for depth, blocks in reversed(list(enumerate(tables))):
        above = blocks.filter(~F.col("more")).select("g", "blk").join(ends, "g").select("g", "blk", "path", "subroot")
        if given is not None:
            above = above.union(given.select("g", F.col("pos").alias("blk"), "path", "subroot"))
        # A block table's inner rows are a sixteenth of the rows below: cheap to store.
        given = _children(blocks, above, fanout, payload and depth == 0)
        if depth:
            given = stage(given.drop("digest"), f"paths-{depth}")
    return given


def merkle_manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", fanout: int = 2, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per row of ``docs``: key and group (under their names), leaf, subroot, root, path, carried columns.

    ``path`` lists from leaf to root the digests left and right of the own one
    (array of l, r; both empty for a lone node); ``fold`` and ``siblings`` read it.
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    rows = docs.select(
        F.col(key).alias("key"), F.col(group).cast("string").alias("grp"), leaf_digest([F.col(c) for c in fields]).alias("digest"), F.struct(F.lit(0).alias("_"), *carry).alias("carried")
    )
    rows = stage(rows, "leaves")
    # A row's place in its group is its place in the whole order, less that of the group's first.
    placed = dense_key(rows, ["grp", "key", "digest"], "row")
    groups = stage(placed.groupBy("grp").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")), "groups")
    groups = stage(dense_key(groups, ["grp"], "g"), "numbered-groups")
    named = groups.select((F.col("g") - 1).alias("g"), F.col("grp").alias("name"), "first", "n")
    nodes = placed.join(small_side(named, materialised=True), F.col("grp").eqNullSafe(F.col("name")))
    nodes = nodes.select("g", (F.col("row") - F.col("first")).alias("pos"), "n", "digest", "key", "grp", "carried")

    tables, tops = _blocks(nodes, fanout, ["key", "grp", "carried"], "blocks")
    tops = stage(tops, "subroots")
    n = tops.count()
    upper = tops.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.lit(n).cast("long").alias("n"), F.col("top").alias("digest"))
    upper_tables, root = _blocks(upper, fanout, [], "upper")
    found = root.first()
    root = F.lit(found["top"] if found else None).cast("string")
    end = tops.sparkSession.createDataFrame([(0,)], "g long").select("g", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"))
    ends = _paths(upper_tables, end, fanout, False).select(F.col("pos").alias("g"), "path", F.col("digest").alias("subroot"))
    leaves = _paths(tables, stage(ends, "group-paths"), fanout, True)
    return leaves.select(
        F.col("payload.key").alias(key), F.col("payload.grp").alias(group), F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path",
        *[F.col(f"payload.carried.{c}").alias(c) for c in carry],
    )


def tampered_leaf(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", changed: str = "n_chars", every: int = 7) -> Column:
    """The leaf of a row whose ``changed`` column was raised by 1, where ``every`` divides the key's crc32; else null.

    A null key or a null ``changed`` is left as it is.
    """
    more = (F.col(changed).cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    hit = (F.crc32(F.col(key).cast("string").cast("binary")) % every == 0) & F.col(changed).isNotNull()
    return F.when(hit, leaf_digest([more if c == changed else F.col(c) for c in fields]))
