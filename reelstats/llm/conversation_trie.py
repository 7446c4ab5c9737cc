"""Prefix trie of conversations, rolled up by centroid decomposition (operator 11).

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it.

1. **Order.** Turns are range-sorted by conversation, turn, role and text, so that a
   conversation of any length is spread over tasks, and numbered within (task,
   conversation); an offset per (conversation, task) completes the numbers. From
   here on only two 64-bit hashes of a turn and its length travel.
2. **Prefixes.** A prefix is named by the xor of the hashes of its (place, turn)
   pairs, in two lanes of 64 bits: a running xor over stretches of `stretch` turns, and
   a carry into each stretch. Removing the last turn's hash names the parent.
3. **Nodes** are groups of equal prefixes (partial aggregates first).
4. **Rollup.** The forest of parent edges, one tree for each first turn, is rolled up by
   centroid decomposition. A node's weight is the number of (member, turn) pairs
   at or below it, which the grouping of step 3 gives without a walk of the tree.
   The centroid of a component is its deepest node that holds more than half of the
   component's weight. Taking it out splits the component into the parts below its
   children and the part above. The total of the centroid and the parts below it is
   its sum in this component, and is added to all nodes on the path from
   the centroid to the component's top; their weights shrink by the centroid's.
   No part has more than half of the weight, so the recursion is as deep as the logarithm.
   Components with more than `part_nodes` nodes are split by joins, all at
   once, one written table a round; smaller ones are grouped into tasks and
   split there with numpy in the same way.

   In a join round, the members' own paths tell where a node lies: a node is below the
   centroid if the path of its smallest member passes through it, and the path to
   the top is that of the centroid's smallest member.
5. **Ends.** The ids of conversations that end at a node are range-sorted over all
   tasks, joined into blocks, and the blocks of a node are hashed one after the other.

Defined cases: a null role or text is empty; a null turn comes first; turns that
share a number are ordered by role and text; repeated rows are turns of their own;
rows without a conv_id belong to no conversation and are left out; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelstats.llm.tables import written

STRETCH = 4096
PART_NODES = 1 << 14
BUFFER_NODES = 1 << 16
BLOCK_BYTES = 1 << 16
GROUP = 100  # conversations c - c % GROUP lend their openings
OPENING = 6  # to c, up to OPENING - 1 turns

KEY = ["key1", "key2"]
PARENT = ["parent1", "parent2"]
PART = ["part1", "part2"]


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, counts), both written.

    turns: conv_id, task, nth (place within the task), turn1, turn2 (hashes), n_chars.
    counts: conv_id, task, before (turns of the conversation in earlier tasks), total.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    )
    hashed = (
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", F.xxhash64("role", "text").alias("turn1"), F.xxhash64(F.lit(11), "text", "role").alias("turn2"), F.char_length("text").cast("long").alias("n_chars"))
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        last, after = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy()
            head = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            size = np.diff(np.append(head, len(ids)))
            nth = np.arange(len(ids)) - np.repeat(head, size)
            if ids[0] == last:
                nth[: size[0]] += after
            last, after = ids[-1], int(nth[-1]) + 1
            yield pa.record_batch([*batch.columns, pa.array(np.full(len(ids), task, np.int32)), pa.array(nth, pa.int64())], names=[*batch.schema.names, "task", "nth"])

    turns = written(hashed.mapInArrow(number, "conv_id long, turn1 long, turn2 long, n_chars long, task int, nth long"), "turns")
    mine = Window.partitionBy("conv_id")
    counts = turns.groupBy("conv_id", "task").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "task",
        F.coalesce(F.sum("n").over(mine.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(mine).alias("total"),
    )
    return turns, written(counts, "turn-counts")


def own_turns(turns: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sequence, convs) of the conversations as they are: sequence has conv_id, place, turn1, turn2, n_chars, total; convs has conv_id, total."""
    sequence = turns.join(counts, ["conv_id", "task"]).select("conv_id", (F.col("nth") + F.col("before")).alias("place"), "turn1", "turn2", "n_chars", "total")
    return sequence, counts.where("before = 0").select("conv_id", "total")


def shared_openings(turns: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As own_turns, but conversation c starts with the first h turns of conversation c - c % 100 (all if fewer,
    none if absent), then has its own turns after its first h; h is the crc32 of the decimal c modulo 6."""
    opening = F.struct(F.col("place"), "turn1", "turn2", "n_chars")
    first = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("nth") < OPENING - 1)).join(counts, ["conv_id", "task"])
    heads = (
        first.withColumn("place", F.col("nth") + F.col("before")).where(F.col("place") < OPENING - 1)
        .groupBy(F.col("conv_id").alias("lender")).agg(F.sort_array(F.collect_list(opening)).alias("head"))  # OPENING - 1 turns at most
    )
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(OPENING)).cast("int")
    convs = (
        counts.withColumn("lender", F.col("conv_id") - F.col("conv_id") % GROUP).join(heads, "lender", "left")
        .withColumn("skip", h)
        .withColumn("head", F.when(F.col("skip") > 0, F.slice(F.coalesce("head", F.array().cast("array<struct<place:long,turn1:long,turn2:long,n_chars:long>>")), F.lit(1), F.greatest("skip", F.lit(1)))).otherwise(F.array()))
        .withColumn("lent", F.size("head").cast("long"))
        .select("conv_id", "task", "before", "skip", "lent", "head", (F.col("lent") + F.greatest(F.col("total") - F.col("skip"), F.lit(0))).alias("total"))
    )
    convs = written(convs, "rebuilt-counts")
    one = convs.where("before = 0")
    lent = one.select("conv_id", "total", F.inline("head")).select("conv_id", "place", "turn1", "turn2", "n_chars", "total")
    own = (
        turns.join(convs.select("conv_id", "task", "before", "skip", "lent", "total"), ["conv_id", "task"])
        .withColumn("nth", F.col("nth") + F.col("before")).where("nth >= skip")
        .select("conv_id", (F.col("nth") - F.col("skip") + F.col("lent")).alias("place"), "turn1", "turn2", "n_chars", "total")
    )
    return lent.unionByName(own), one.select("conv_id", "total")


def prefixes(sequence: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """conv_id, depth, key1, key2, parent1, parent2, tree1, tree2 (the first turn's key), n_chars, total of every prefix but the empty one."""
    placed = sequence.withColumn("stretch", F.floor(F.col("place") / stretch)).withColumn("x1", F.xxhash64("place", "turn1", "turn2")).withColumn("x2", F.xxhash64(F.lit(5), "turn2", "place", "turn1"))
    so_far = Window.partitionBy("conv_id", "stretch").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select(
        "conv_id", "stretch", "place", "n_chars", "total", "x1", "x2",
        *(F.bit_xor(f"x{i}").over(so_far).alias(f"run{i}") for i in (1, 2)), *(F.first(f"x{i}").over(so_far).alias(f"first{i}") for i in (1, 2)),
    )
    # conversations longer than a stretch: what the stretches before add up to, and the first turn
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        placed.where(F.col("total") > stretch).groupBy("conv_id", "stretch")
        .agg(*(F.bit_xor(f"x{i}").alias(f"all{i}") for i in (1, 2)), *(F.max(F.when(F.col("place") == 0, F.col(f"x{i}"))).alias(f"head{i}") for i in (1, 2)))
        .select("conv_id", "stretch", *(F.bit_xor(f"all{i}").over(earlier).alias(f"carry{i}") for i in (1, 2)), *(F.first(f"head{i}").over(earlier).alias(f"head{i}") for i in (1, 2)))
        .where("stretch > 0")
    )
    full = local.join(carry, ["conv_id", "stretch"], "left")

    def key(i: int) -> Column:
        return F.col(f"run{i}").bitwiseXOR(F.coalesce(f"carry{i}", F.lit(0).cast("long")))

    return full.select(
        "conv_id", (F.col("place") + 1).alias("depth"), key(1).alias("key1"), key(2).alias("key2"),
        key(1).bitwiseXOR(F.col("x1")).alias("parent1"), key(2).bitwiseXOR(F.col("x2")).alias("parent2"),
        F.coalesce("head1", "first1").alias("tree1"), F.coalesce("head2", "first2").alias("tree2"), "n_chars", "total",
    )


def tree_nodes(paths: DataFrame) -> DataFrame:
    """One row per prefix of paths: members, weight and children; parent_conv_id is null at depth 1."""
    same = ["depth", *PARENT, "tree1", "tree2", "n_chars"]
    grouped = paths.groupBy(KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("total") - F.col("depth") + 1).alias("weight"),
        *(F.min(c).alias(c) for c in same),
    )
    nodes = written(grouped, "trie-nodes")
    children = nodes.where("depth > 1").groupBy(*(F.col(p).alias(k) for p, k in zip(PARENT, KEY))).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, KEY, "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"),
    )
    parents = nodes.select(F.col("key1").alias("parent1"), F.col("key2").alias("parent2"), F.col("conv_id").alias("parent_conv_id"))
    # first turns have the root as parent: kept out of the join, they would all share its key
    below = counted.where("depth > 1").join(parents, PARENT, "left")
    first = counted.where("depth = 1").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return written(below.unionByName(first), "trie-edges")


def decompose(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray, added: np.ndarray) -> np.ndarray:
    """Sums of values over all subtrees, plus added, by centroid decomposition of a forest.

    parent: index of each node's parent, -1 for a top; weight: as in the module's
    docstring; values, added: one row per node.
    """
    n = len(parent)
    parent, weight, sums = parent.copy(), weight.copy(), added.copy()
    top = np.where(parent < 0, np.arange(n), parent)
    while not np.array_equal(up := top[top], top):
        top = up
    live = np.arange(n)
    is_centroid = np.zeros(n, bool)
    while len(live):
        heavy = live[2 * weight[live] > weight[top[live]]]
        heavy = heavy[np.lexsort((-depth[heavy], top[heavy]))]
        centroid = heavy[np.concatenate([[True], top[heavy][1:] != top[heavy][:-1]])]
        is_centroid[centroid] = True
        has = live[parent[live] >= 0]
        child = has[is_centroid[parent[has]]]
        above = parent[child]
        # new tops: the old ones, the centroids' children, and the centroids alone
        label = np.arange(n)
        label[has] = parent[has]
        label[child], label[centroid] = child, centroid
        while not np.array_equal(up := label[label[live]], label[live]):
            label[live] = up
        total = np.zeros_like(values)
        np.add.at(total, label[live], values[live])
        below = np.zeros_like(values)
        np.add.at(below, above, total[child])
        share = below[centroid] + values[centroid]
        sums[centroid] += share
        lost, at = weight[centroid], parent[centroid]
        while len(at):
            on = at >= 0
            at, share, lost = at[on], share[on], lost[on]
            sums[at] += share
            weight[at] -= lost
            at = parent[at]
        parent[child] = -1
        top = label
        live = live[~is_centroid[live]]
    return sums


def _parents(key: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Row of each row's parent key, -1 where it isn't here; keys and parents are pairs, shape (n, 2)."""
    order = np.lexsort((key[:, 1], key[:, 0]))
    k = key[order]
    at = np.searchsorted(k[:, 0], parent[:, 0])
    out = np.full(len(key), -1, np.int64)
    open_ = np.arange(len(key))
    while len(open_):
        i = at[open_]
        ok = i < len(k)
        ok[ok] = k[i[ok], 0] == parent[open_[ok], 0]
        open_, i = open_[ok], i[ok]
        hit = k[i, 1] == parent[open_, 1]
        out[open_[hit]] = order[i[hit]]
        open_ = open_[~hit]
        at[open_] += 1
    return out


_STATE = [*PART, *KEY, *PARENT, "depth", "conv_id", "weight", "leaf", "saved", "add_leaves", "add_saved"]
_SUMS = "key1 long, key2 long, n_leaves long, saved_tokens long"


def _roll_up_parts(parts: DataFrame) -> DataFrame:
    """Subtree sums of components that fit into a task each; a task takes many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def solved(rows: np.ndarray) -> pa.RecordBatch:
            part1, part2, key1, key2, up1, up2, depth, weight, leaf, saved, add1, add2 = rows
            key = np.stack([key1, key2], 1)
            parent = _parents(key, np.stack([up1, up2], 1))
            inside = parent >= 0
            # a part's top has its parent in another part
            inside[inside] = (part1[inside] == part1[parent[inside]]) & (part2[inside] == part2[parent[inside]])
            parent[~inside] = -1
            sums = decompose(parent, depth, weight, np.stack([leaf, saved], 1), np.stack([add1, add2], 1))
            return pa.record_batch([pa.array(c) for c in (key1, key2, sums[:, 0], sums[:, 1])], names=["key1", "key2", "n_leaves", "saved_tokens"])

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in _STATE if c != "conv_id"])
            held.append(rows)
            n += rows.shape[1]
            if n >= BUFFER_NODES:
                rows = np.concatenate(held, axis=1)
                # the last component may go on
                same = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
                cut = int(np.argmax(same))
                if cut:
                    yield solved(rows[:, :cut])
                held, n = [rows[:, cut:]], rows.shape[1] - cut
        if n:
            yield solved(np.concatenate(held, axis=1))

    return parts.select(_STATE).repartition(*PART).sortWithinPartitions(*PART).mapInArrow(run, _SUMS)


def roll_up(nodes: DataFrame, paths: DataFrame, part_nodes: int = PART_NODES) -> DataFrame:
    """key1, key2, n_leaves and saved_tokens summed over the subtree of every node."""
    zero = F.lit(0).cast("long")
    state = nodes.select(
        F.col("tree1").alias("part1"), F.col("tree2").alias("part2"), *KEY, *PARENT, "depth", "conv_id", "weight", "leaf", "saved",
        zero.alias("add_leaves"), zero.alias("add_saved"),
    )
    sizes = written(state.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("all_weight")).where(F.col("n") > part_nodes), "large-parts")
    if sizes.isEmpty():
        return _roll_up_parts(state)
    small, done = [state.join(sizes, PART, "left_anti")], []
    state = written(state.join(sizes.select(*PART, "all_weight"), PART), "trie-state")
    trees = sizes.select(F.col("part1").alias("tree1"), F.col("part2").alias("tree2"))
    walk = written(paths.join(trees, ["tree1", "tree2"], "left_semi").select(F.col("conv_id").alias("walker"), F.col("depth").alias("at"), *KEY, *PARENT), "trie-walks")
    while True:
        centroid = written(
            state.where(2 * F.col("weight") > F.col("all_weight")).groupBy(PART)
            .agg(F.max_by(F.struct(*KEY, F.col("depth").alias("at"), F.col("conv_id").alias("walker"), "weight"), "depth").alias("c"))
            .select(*PART, F.col("c.key1").alias("c1"), F.col("c.key2").alias("c2"), F.col("c.at").alias("c_depth"), F.col("c.walker").alias("c_walker"), F.col("c.weight").alias("c_weight")),
            "centroids",
        )
        # conversations that go on below a centroid, and the child that they take
        onward = walk.join(centroid.select("c1", "c2", "c_depth", *PART), (F.col("parent1") == F.col("c1")) & (F.col("parent2") == F.col("c2"))).select(
            F.col("walker").alias("conv_id"), *PART, F.col("key1").alias("child1"), F.col("key2").alias("child2"), "c_depth"
        )
        marked = written(
            state.alias("s").join(onward.alias("o"), (F.col("s.conv_id") == F.col("o.conv_id")) & (F.col("s.part1") == F.col("o.part1")) & (F.col("s.part2") == F.col("o.part2")) & (F.col("depth") > F.col("c_depth")), "left")
            .select("s.*", "child1", "child2")
            .join(centroid.select(*PART, "c1", "c2"), PART)
            .withColumn("is_c", (F.col("key1") == F.col("c1")) & (F.col("key2") == F.col("c2"))).drop("c1", "c2"),
            "trie-marks",
        )
        share = written(
            marked.where("is_c or child1 is not null").groupBy(PART).agg(F.sum("leaf").alias("b_leaves"), F.sum("saved").alias("b_saved")).join(centroid, PART),
            "trie-shares",
        )
        # nodes from the centroid (inclusive, to finish it) to the component's top
        up = walk.join(share, (F.col("walker") == F.col("c_walker")) & (F.col("at") <= F.col("c_depth"))).select(
            *KEY, F.col("part1").alias("p1"), F.col("part2").alias("p2"), "b_leaves", "b_saved", "c_weight"
        )
        zero_or = lambda c: F.coalesce(c, zero)
        moved = written(
            marked.alias("m").join(up.alias("u"), (F.col("m.key1") == F.col("u.key1")) & (F.col("m.key2") == F.col("u.key2")) & (F.col("part1") == F.col("p1")) & (F.col("part2") == F.col("p2")), "left")
            .select(
                F.coalesce("child1", "part1").alias("part1"), F.coalesce("child2", "part2").alias("part2"), "m.key1", "m.key2", *PARENT, "depth", "conv_id",
                (F.col("weight") - F.when(F.col("is_c"), zero).otherwise(zero_or("c_weight"))).alias("weight"), "leaf", "saved",
                (F.col("add_leaves") + zero_or("b_leaves")).alias("add_leaves"), (F.col("add_saved") + zero_or("b_saved")).alias("add_saved"), "is_c",
            ),
            "trie-moved",
        )
        done.append(moved.where("is_c").select(*KEY, F.col("add_leaves").alias("n_leaves"), F.col("add_saved").alias("saved_tokens")))
        rest = moved.where("not is_c").drop("is_c")
        sizes = written(rest.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("all_weight")).where(F.col("n") > part_nodes), "large-parts")
        small.append(rest.join(sizes, PART, "left_anti"))
        if sizes.isEmpty():
            break
        state = written(rest.join(sizes.select(*PART, "all_weight"), PART), "trie-state")
    return reduce(DataFrame.unionByName, done, _roll_up_parts(reduce(DataFrame.unionByName, [s.select(_STATE) for s in small])))


def end_digests(ends: DataFrame) -> DataFrame:
    """key1, key2 and the SHA-256 of the key's conv_ids, ascending and joined by commas."""

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # key1, key2, first id, ids
        for batch in batches:
            out = []
            for k1, k2, c in zip(*(batch.column(n).to_pylist() for n in ("key1", "key2", "conv_id"))):
                if held and held[0] == k1 and held[1] == k2 and held[4] < BLOCK_BYTES:
                    held[3].append(str(c))
                    held[4] += len(held[3][-1]) + 1
                    continue
                if held:
                    out.append((*held[:3], ",".join(held[3])))
                held = [k1, k2, c, [str(c)], 0]
            if out:
                yield _blocks(out)
        if held:
            yield _blocks([(*held[:3], ",".join(held[3]))])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(*(batch.column(n).to_pylist() for n in ("key1", "key2", "ids"))):
                if (k1, k2) == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (k1, k2), hashlib.sha256()
                sha.update(ids.encode())
            if out:
                yield _digests(out)
        if key is not None:
            yield _digests([(*key, sha.hexdigest())])

    order = [*KEY, "conv_id"]
    blocks = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(block, "key1 long, key2 long, conv_id long, ids string")
    return blocks.repartition(*KEY).sortWithinPartitions(*order).mapInArrow(digest, "key1 long, key2 long, ends_sha256 string")


def _blocks(rows: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["key1", "key2", "conv_id", "ids"])


def _digests(rows: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], names=["key1", "key2", "ends_sha256"])


def prefix_trie(conversations: DataFrame, openings: bool = False, part_nodes: int = PART_NODES, stretch: int = STRETCH) -> DataFrame:
    """One row per trie node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    openings: conversations are rebuilt with shared openings first (shared_openings).
    """
    sequence, convs = (shared_openings if openings else own_turns)(*ordered_turns(conversations))
    paths = written(prefixes(sequence, stretch), "trie-paths")
    nodes = tree_nodes(paths)
    sums = written(roll_up(nodes, paths, part_nodes), "trie-sums")
    zero = F.lit(0).cast("long")
    turnless = convs.where("total = 0").select(zero.alias("key1"), zero.alias("key2"), "conv_id")
    ends = written(end_digests(paths.where("depth = total").select(*KEY, "conv_id").unionByName(turnless)), "trie-ends")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    root, members = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    at_root = ends.where("key1 = 0 and key2 = 0").agg(F.max("ends_sha256")).first()[0]
    body = (
        nodes.join(sums, KEY).join(ends, KEY, "left")
        .withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root).cast("long")).otherwise(F.col("parent_conv_id")))
        .withColumn("ends_sha256", F.coalesce("ends_sha256", none)).select(columns)
    )
    # the root's sums are the totals of its components
    top = nodes.where("depth = 1").join(sums, KEY).agg(
        F.count(F.lit(1)).alias("n_children"), F.greatest(F.coalesce(F.sum("n_leaves"), zero), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), zero).alias("saved_tokens")
    ).where(F.lit(members > 0)).select(
        F.lit(root).cast("long").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(members).cast("long").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens", F.coalesce(F.lit(at_root).cast("string"), none).alias("ends_sha256"),
    )
    return body.unionByName(top.select(columns))
