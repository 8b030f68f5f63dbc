"""Operator 12, the prefix trie of conversations: ROLLUP over positional columns of turn ids.

Each conversation is laid out in blocks of WIDTH turns, one row with a column per place. A block is keyed by the node that
its conversation has reached before it (the block number and 128 bits that all turns so far make together), so one
GROUP BY block, node, ROLLUP (place 1, ..., place WIDTH) gives every prefix of every conversation a row, whatever its
length; grouping_id tells how many places count. A second ROLLUP, over the nodes, sums up what lies below each of them
within its block; what lies in further blocks is added to the nodes that these hang from before, in rounds that reach
twice as many blocks each.

Nothing gathers a conversation, a node's members or its children: places come from counts of sorted partitions, members
are counted with partial aggregates, and the digest of a node's ends reads chunks of ids in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved

#: Turns in a block; blocks of a conversation that one window takes; turns of a conversation that one join key has; ids in a chunk.
WIDTH, RUN, SPAN, IDS = 8, 4096, 4096, 4096
#: A parent with more than one in HEAVY of all nodes as children is broadcast: fewer than HEAVY such parents exist.
HEAVY = 1024


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), key, chars: the turns of each conversation in the order of turn, nulls first; equal turns by
    role, then by the first 64 characters of the text, then by the MD5 of both.

    key stands for role and text (null: empty) and holds the text's length. Repeated rows are turns of their own. Rows
    without a conv_id belong to no conversation and are left out. Other columns play no part.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)).cast("binary"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.substring(text, 1, 64).alias("start"),
        F.concat_ws("-", digest, F.length(text).cast("string")).alias("key"), F.monotonically_increasing_id().alias("row"),
    )
    rows = saved(rows, "turn-keys")  # sampling the ranges would hash the texts again
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("start"), F.col("key"), F.col("row")]
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv_id", "key", F.monotonically_increasing_id().alias("at"))
    placed = saved(placed, "turns").withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most a row for each partition
    parts = parts.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return saved(placed.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("place"), "key"), "turn-places")


def share_openings(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that they share openings: conversation c has the first h turns of conversation c - c % every
    (all if it has fewer, none if there is no such conversation), then its own turns after its first h; h is the CRC-32 of
    c in decimal, modulo most. Returns the turns (conv_id, place, key) and one row per conversation, turnless ones too."""
    hold = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", hold).withColumn("root", F.expr(f"conv_id - conv_id % {every}"))
    convs = saved(convs, "conversations")
    roots = convs.where(f"conv_id % {every} = 0").select(F.col("conv_id").alias("root"), F.col("n").alias("n_root"))
    opened = convs.join(roots, "root", "left").select("conv_id", "root", "n", "h", F.least("h", F.coalesce("n_root", F.lit(0))).alias("opening"))
    opened = saved(opened, "openings")
    span = opened.where("n > h").select("conv_id", "h", "opening", F.explode(F.expr(f"sequence(0L, (n - 1) div {SPAN})")).alias("span"))
    own = turns.withColumn("span", F.expr(f"place div {SPAN}")).join(span, ["conv_id", "span"]).where("place >= h")
    own = own.select("conv_id", F.expr("place - h + opening").alias("place"), "key")
    # A root has the openings of `every` conversations on either side at most.
    lead = turns.where((F.col("conv_id") % every == 0) & (F.col("place") < most)).select(F.col("conv_id").alias("root"), "place", "key")
    lead = opened.where("opening > 0").join(lead, "root").where("place < opening").select("conv_id", "place", "key")
    return own.unionByName(lead), opened.select("conv_id")


def _hashes(key: str, place: str) -> tuple[str, str]:
    return f"xxhash64({key}, {place})", f"xxhash64('b', {place}, {key})"


def _blocks(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, int]:
    """One row per conversation and block: p1, p2 (all turns before it), x1, x2 (its own turns), t1..., filled; and the last block's number."""
    a, b = _hashes("key", "place")
    rows = turns.select("conv_id", F.expr(f"place div {WIDTH}").alias("block"), F.expr(f"place % {WIDTH}").alias("slot"), "key", F.expr(a).alias("a"), F.expr(b).alias("b"))
    none = convs.select("conv_id", F.lit(0).cast("long").alias("block"), *[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes[2:]])
    rows = rows.unionByName(none).withColumn("run", F.expr(f"block div {RUN}")).repartition("conv_id", "run")
    places = [F.max(F.when(F.col("slot") == i, F.col("key"))).alias(f"t{i + 1}") for i in range(WIDTH)]
    out = rows.groupBy("conv_id", "run", "block").agg(*places, F.count("key").alias("filled"), *[F.coalesce(F.bit_xor(c), F.lit(0)).alias(x) for c, x in (("a", "x1"), ("b", "x2"))])
    before = Window.partitionBy("conv_id", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    out = saved(out.select("*", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(p) for x, p in (("x1", "p1"), ("x2", "p2"))]), "blocks")
    last = out.agg(F.max("block")).first()[0] or 0
    if last >= RUN:
        runs = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
        heads = out.groupBy("conv_id", "run").agg(F.bit_xor("x1").alias("h1"), F.bit_xor("x2").alias("h2"))
        heads = heads.select("conv_id", "run", *[F.coalesce(F.bit_xor(h).over(runs), F.lit(0)).alias(h) for h in ("h1", "h2")])
        out = out.join(heads, ["conv_id", "run"]).withColumns({"p1": F.expr("p1 ^ h1"), "p2": F.expr("p2 ^ h2")}).drop("h1", "h2")
        out = saved(out, "blocks-joined")
    return out.drop("run"), last


def _rolled(rows: DataFrame, aggregates: str) -> DataFrame:
    """GROUP BY block, p1, p2, ROLLUP (t1, ...): block, p1, p2, t1..., level and the aggregates, without groups of places that no turn fills."""
    places = ", ".join(f"t{i + 1}" for i in range(WIDTH))
    sql = f"select block, p1, p2, {places}, {WIDTH} - bit_count(grouping_id()) as level, {aggregates} from {{rows}} group by block, p1, p2, rollup ({places})"
    out = rows.sparkSession.sql(sql, rows=rows)
    return out.where(f"case when level = 0 then block = 0 else element_at(array({places}), level) is not null end")


def _digests(ends: DataFrame) -> DataFrame:
    """ends (depth, k1, k2, conv_id) -> ends_sha256 per (depth, k1, k2): of the ids in ascending order, comma-joined.

    A sort deals the ids of one node over as many tasks as it takes; each makes chunks of IDS at most, and the tasks that
    read these hash them one after the other, holding one at a time.
    """
    node = ["depth", "k1", "k2"]

    def chunked(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out: list[tuple] = []
            for *at, conv in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not out or out[-1][0] != at or len(out[-1][1]) >= IDS:
                    out.append((at, []))
                out[-1][1].append(conv)
            cols = [pa.array([at[i] for at, _ in out], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([ids[0] for _, ids in out], pa.int64()), pa.array([",".join(map(str, ids)) for _, ids in out])], names=[*node, "first", "ids"])

    def hashed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, state = None, None

        def made(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k, _ in done], pa.int64()) for i in range(3)), pa.array([s for _, s in done], pa.string())], names=[*node, "ends_sha256"])

        for batch in batches:
            done = []
            for *at, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if at != key:
                    if state:
                        done.append((key, state.hexdigest()))
                    key, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield made(done)
        if state:
            yield made([(key, state.hexdigest())])

    n = max(1, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chunks = ends.repartitionByRange(n, *node, "conv_id").sortWithinPartitions(*node, "conv_id").mapInArrow(chunked, "depth long, k1 long, k2 long, first long, ids string")
    chunks = saved(chunks, "end-chunks").repartition(*node).sortWithinPartitions(*node, "first")
    return chunks.mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations' turn sequences (turns: conv_id, place, key; convs: conv_id).

    conv_id (smallest member), depth, parent_conv_id (its parent's conv_id; root: null), n_convs, n_children, n_leaves,
    saved_tokens (over its subtree, each node's members beyond the first times the code points of its last text) and
    ends_sha256 (of the members that end here, ascending, comma-joined). Conversations without turns end at the root.
    Copies of a conversation share all nodes. Without conversations there is no root and no row.
    """
    blocks, last = _blocks(turns, convs)
    blocks = blocks.where("block = 0 or filled > 0")
    places = [f"t{i + 1}" for i in range(WIDTH)]
    nodes = _rolled(blocks, "count(*) as n_convs, min(conv_id) as conv_id")
    steps = [_hashes(t, f"block * {WIDTH} + {i}") for i, t in enumerate(places)]
    made = [" ^ ".join([p, *(f"if(level > {i}, {s[k]}, 0L)" for i, s in enumerate(steps))]) for k, p in enumerate(("p1", "p2"))]
    above = [" ^ ".join([p, *(f"if(level > {i + 1}, {s[k]}, 0L)" for i, s in enumerate(steps))]) for k, p in enumerate(("p1", "p2"))]
    chars = f"coalesce(cast(substring(element_at(array({', '.join(places)}), nullif(level, 0)), 34) as long), 0L)"
    nodes = saved(nodes.withColumns({"depth": F.expr(f"block * {WIDTH} + level"), "k1": F.expr(made[0]), "k2": F.expr(made[1]), "q1": F.expr(above[0]), "q2": F.expr(above[1]), "own": F.expr(f"(n_convs - 1) * {chars}")}), "nodes")
    key = ["depth", "k1", "k2"]
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = saved(nodes.join(kids, key, "left").na.fill(0, ["n_children"]).withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")), "nodes-counted")

    below = _below(nodes, blocks, last)
    nodes = nodes.join(below, key, "left").na.fill(0, ["more_leaves", "more_saved"])
    nodes = nodes.withColumns({"leaves": F.col("leaves") + F.col("more_leaves"), "own": F.col("own") + F.col("more_saved"), "node": F.struct(*key, "q1", "q2", "conv_id", "n_convs", "n_children")})
    nodes = nodes.withColumnRenamed("level", "top")
    tree = _rolled(nodes, "min_by(node, top) as node, sum(leaves) as n_leaves, sum(own) as saved_tokens")
    tree = saved(tree.select("node.*", "n_leaves", "saved_tokens"), "tree")

    heavy = F.col("n_children") * HEAVY > tree.count()
    parents = tree.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), heavy.alias("heavy"))
    up = ["depth", "q1", "q2"]
    hot = F.broadcast(parents.where("heavy").drop("heavy"))
    rest = tree.join(hot.drop("parent_conv_id"), up, "left_anti").join(parents.where("not heavy").drop("heavy"), up, "left")
    tree = tree.join(hot, up).unionByName(rest)

    ends = blocks.groupBy("conv_id").agg(F.sum("filled").alias("depth"), F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2")).select(*key, "conv_id")
    out = tree.join(_digests(saved(ends, "ends")), key, "left")
    numbers = [F.col(c).cast("long").alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    return out.select(*numbers, F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def _below(nodes: DataFrame, blocks: DataFrame, last: int) -> DataFrame:
    """For nodes from which further blocks hang (depth, k1, k2): more_leaves and more_saved, all that lies in those blocks.

    Each round adds to a block the sums of the blocks that lie 1, 2, 4, ... further down; a member conversation tells
    which block is that far above another.
    """
    hung = nodes.where("block > 0").groupBy("block", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.sum("leaves").alias("leaves"), F.sum("own").alias("saved"))
    reach = 1
    while reach < last:
        hung = saved(hung, "blocks-summed")
        prior = blocks.where("block > 0").select("conv_id", "block", F.col("p1").alias("a1"), F.col("p2").alias("a2"))
        far = hung.select("conv_id", (F.col("block") - reach).alias("block"), "leaves", "saved").where("block > 0").join(prior, ["conv_id", "block"])
        far = far.groupBy("block", F.col("a1").alias("p1"), F.col("a2").alias("p2")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        hung = hung.join(far, ["block", "p1", "p2"], "left").select("block", "p1", "p2", "conv_id", F.expr("leaves + coalesce(l, 0)").alias("leaves"), F.expr("saved + coalesce(s, 0)").alias("saved"))
        reach *= 2
    return hung.select((F.col("block") * WIDTH).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
