"""The prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

A node is a distinct sequence of first turns. What stands below it is added up without a walk along
the edges: a component of the trie is split at its centroid, the deepest node that has over half of
the component's weight below it. The total of what is below the centroid is added to every node
between it and the component's top, and then the part above and each part below are components of
at most half the weight. Components that fit a task are finished there from the bottom up.

A node's weight is the number of its conversations, and what a subtree weighs follows from the rows
that begin with the node: each conversation passes one node a turn. So the nodes between a centroid
and the top are those over half of the component's weight, which each can tell for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ship, small_or_not

RUN_TURNS = 1024  # turns of one conversation that are ordered and added up in one go
TASK_WEIGHT = 20_000
HOT_CHILDREN = 10_000
ID_RUN = 4096  # conversation ids that are listed in one row
PARTS = [f"p{i}" for i in range(4)]
SUMS = [f"s{i}" for i in range(4)]
NO_TURN = -(1 << 62)


def placed_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, run, place, length, role, text``: every turn with its place (from 1) in its
    conversation and the conversation's length.

    Turns are ordered by number (null first), role and text, so repeated rows and ties have a defined
    order; null roles and texts are empty; rows without a conversation id are left out. Places are
    counted by runs of turn numbers, so that a very long conversation is no single group.
    """
    number = F.col(f"`{turn}`").cast("bigint")
    rows = turns.select(
        F.col(f"`{conv}`").cast("bigint").alias("conv_id"),
        number.alias("turn"),
        F.coalesce(_run(number, RUN_TURNS), F.lit(NO_TURN)).alias("run"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).where("conv_id is not null")
    of_conv = Window.partitionBy("conv_id")
    upto = of_conv.orderBy("run").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = rows.groupBy("conv_id", "run").agg(F.count("*").alias("c"))
    runs = runs.select(
        "conv_id", "run", (F.sum("c").over(upto) - F.col("c")).alias("before"), F.sum("c").over(of_conv).alias("length")
    )
    inside = Window.partitionBy("conv_id", "run").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = rows.withColumn("in_run", F.row_number().over(inside)).join(runs, ["conv_id", "run"])
    return placed.select("conv_id", "run", (F.col("before") + F.col("in_run")).alias("place"), "length", "role", "text")


def _run(number: Column, size: int) -> Column:
    """The number of the run that holds ``number``; ``size`` is a power of two."""
    return F.shiftright(number, size.bit_length() - 1)


def rebuilt(turns: DataFrame, block: int = 100, most: int = 6, **columns: str) -> DataFrame:
    """``conv_id, depth, length, role, text``: conversations that share first turns.

    Of conversation c the first ``crc32(c) % most`` turns give way to as many first turns of
    conversation ``c - c % block`` (all if it has fewer, none if it is absent). Besides its turns,
    at depths 1 to ``length``, each conversation has a row of depth 0 without text, so that one
    without turns is there too. See ``placed_turns`` for nulls and ties. An empty table gives no rows.
    """
    scratch = Scratch(turns.sparkSession)
    placed = scratch.write(placed_turns(turns, **columns), "placed")
    runs = placed.groupBy("conv_id", "run").agg(F.max("length").alias("length"))
    convs = runs.groupBy("conv_id").agg(F.max("length").alias("length"))
    given = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = convs.select("conv_id", "length", given.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    taken = F.least("h", F.coalesce("base_length", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken)
    convs = scratch.write(
        convs.select(
            "conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("new")
        ),
        "convs",
    )
    heads = placed.where(F.col("place") < most).select(F.col("conv_id").alias("base"), "place", "role", "text")
    first = convs.join(heads, "base").where("place <= taken")
    first = first.select("conv_id", F.col("place").alias("depth"), F.col("new").alias("length"), "role", "text")
    # What a turn must know of its conversation comes with its run, not with the whole conversation.
    known = runs.select("conv_id", "run").join(convs, "conv_id")
    own = placed.drop("length").join(known, ["conv_id", "run"]).where("place > h")
    own = own.select("conv_id", F.expr("place - h + taken").alias("depth"), F.col("new").alias("length"), "role", "text")
    root = convs.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.col("new").alias("length"), F.lit("").alias("role"), F.lit("").alias("text"))
    return first.unionByName(own).unionByName(root)


def _key(depth: Column, sums: list[Column]) -> tuple[Column, Column]:
    return F.xxhash64(depth, *sums), F.xxhash64(*reversed(sums), F.lit(11), depth)


def memberships(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, depth, length, chars, k1, k2, q1, q2``: each turn as its conversation's passage
    through a node, with the node's key and its parent's.

    A key is made of four running sums over the turns so far, of 31 bits of each turn's hash, so it
    can be built by runs; equal sequences have equal keys, and others the same one with a chance of
    about 2^-120 a pair.
    """
    hashes = [F.xxhash64("depth", "role", "text"), F.xxhash64("text", F.lit(7), "role", "depth")]
    parts = [
        F.when(F.col("depth") > 0, F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 31) - 1))).otherwise(0)
        for h in hashes
        for shift in (0, 32)
    ]
    steps = rows.select(
        "conv_id",
        "depth",
        _run(F.col("depth"), RUN_TURNS).alias("run"),
        "length",
        F.length("text").cast("bigint").alias("chars"),
        *(p.cast("bigint").alias(name) for p, name in zip(parts, PARTS, strict=True)),
    )
    steps = scratch.write(steps, "steps")
    upto = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = steps.groupBy("conv_id", "run").agg(*(F.sum(p).alias(p) for p in PARTS))
    runs = runs.select("conv_id", "run", *((F.sum(p).over(upto) - F.col(p)).alias(s) for p, s in zip(PARTS, SUMS, strict=True)))
    inside = Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = steps.select("*", *(F.sum(p).over(inside).alias(f"in_{p}") for p in PARTS)).join(runs, ["conv_id", "run"])
    own = [F.col(s) + F.col(f"in_{p}") for p, s in zip(PARTS, SUMS, strict=True)]
    above = [a - F.col(p) for a, p in zip(own, PARTS, strict=True)]
    up = F.col("depth") - 1
    return scratch.write(
        summed.select(
            "conv_id",
            "depth",
            "length",
            "chars",
            *(k.alias(name) for k, name in zip(_key(F.col("depth"), own), ("k1", "k2"), strict=True)),
            *(F.when(up >= 0, k).alias(name) for k, name in zip(_key(up, above), ("q1", "q2"), strict=True)),
        ),
        "memberships",
    )


def trie_nodes(members: DataFrame, scratch: Scratch) -> DataFrame:
    """``k1, k2, q1, q2, conv_id, depth, parent_conv_id, n_convs, n_children, weight, leaf, saved``."""
    nodes = members.groupBy("k1", "k2").agg(
        F.max("q1").alias("q1"),
        F.max("q2").alias("q2"),
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.count("*").alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
        F.max("chars").alias("chars"),
    )
    nodes = scratch.write(nodes, "nodes_alone")
    children = nodes.where("q1 is not null").groupBy("q1", "q2").agg(F.count("*").alias("n_children"))
    children = children.select(F.col("q1").alias("k1"), F.col("q2").alias("k2"), "n_children")
    nodes = nodes.join(children, ["k1", "k2"], "left").fillna(0, ["n_children"])
    nodes = scratch.write(
        nodes.select(
            "*",
            (F.col("n_children") == 0).cast("bigint").alias("leaf"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        ),
        "nodes_counted",
    )
    # A node with very many children meets them by broadcast, the others by a shuffle.
    name = [F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id")]
    hot = scratch.write(nodes.where(F.col("n_children") > HOT_CHILDREN).select(*name), "hot_parents")
    hot = small_or_not(hot, 32)
    others = nodes.where((F.col("n_children") > 0) & (F.col("n_children") <= HOT_CHILDREN)).select(*name)
    by_hot = nodes.join(hot, ["q1", "q2"])
    rest = nodes.join(hot.select("q1", "q2"), ["q1", "q2"], "left_anti").join(others, ["q1", "q2"], "left")
    return scratch.write(by_hot.unionByName(rest).drop("chars"), "nodes")


CARRIED = ["k1", "k2", "q1", "q2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children"]
STATE = ["c1", "c2", "weight", "leaf", "saved", "more_leaf", "more_saved"]
RESULT = ["k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def rolled_up(nodes: DataFrame, members: DataFrame, scratch: Scratch, task_weight: int = TASK_WEIGHT) -> DataFrame:
    """``nodes`` with ``n_leaves`` and ``saved_tokens``: the sums of ``leaf`` and ``saved`` below each
    node, itself included.

    A round splits every component of more than ``task_weight`` at its centroid, so there are at
    most log2(total weight / task_weight) + 1 rounds. Each is written, and only counts reach the
    driver. Which child of a centroid a deeper node belongs to is read from the path of the
    conversation that names it, once for each run of nodes of one conversation.
    """
    zero = F.lit(0).cast("bigint")
    root = dict(zip(("c1", "c2"), _key(zero, [zero] * len(SUMS)), strict=True))
    start = nodes.withColumns({**root, "more_leaf": zero, "more_saved": zero})
    state = scratch.write(start.select(*CARRIED, *STATE), "open_0")
    done, closed, step = [], [], 0
    while True:
        comps = state.groupBy("c1", "c2").agg(F.max("weight").alias("cw")).where(F.col("cw") > task_weight)
        comps = scratch.write(comps, f"comps_{step}")
        if comps.isEmpty():
            closed.append(state)
            break
        comps = small_or_not(comps, 32)
        closed.append(state.join(comps.select("c1", "c2"), ["c1", "c2"], "left_anti"))
        state, finished = _split(state.join(comps, ["c1", "c2"]), members, scratch, step)
        done.append(finished)
        step += 1
    whole = closed[0]
    for part in closed[1:]:
        whole = whole.unionByName(part)
    out = _finish(whole)
    for part in done:
        out = out.unionByName(part)
    return out


def _split(big: DataFrame, members: DataFrame, scratch: Scratch, step: int) -> tuple[DataFrame, DataFrame]:
    """The components of ``big`` without their centroids, split there, and the finished centroids."""
    over_half = 2 * F.col("weight") > F.col("cw")
    centroid = F.max_by(F.struct("k1", "k2", "weight", "depth"), "depth").alias("x")
    found = big.where(over_half).groupBy("c1", "c2").agg(centroid)
    found = found.select(
        "c1", "c2", F.col("x.k1").alias("x1"), F.col("x.k2").alias("x2"),
        F.col("x.weight").alias("x_weight"), F.col("x.depth").alias("x_depth"),
    )
    centroids = small_or_not(scratch.write(found, f"centroids_{step}"), 64)
    run = _run(F.col("depth"), RUN_TURNS).alias("run")
    marked = big.join(centroids, ["c1", "c2"]).select("*", run)
    deep = marked.where("depth > x_depth").select("c1", "c2", "conv_id", "run", "x1", "x2").distinct()
    # The passages of conversations through children of centroids; a key is unique to its component.
    passed = members.select("conv_id", F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("q1").alias("x1"), F.col("q2").alias("x2"))
    passed = passed.join(centroids.select("x1", "x2"), ["x1", "x2"], "left_semi")
    labels = deep.join(passed, ["conv_id", "x1", "x2"]).select("c1", "c2", "conv_id", "run", "a1", "a2")
    below = F.col("depth") > F.col("x_depth")
    labelled = marked.join(labels, ["c1", "c2", "conv_id", "run"], "left").withColumn("below", below & F.col("a1").isNotNull())
    labelled = scratch.write(labelled, f"labelled_{step}")
    itself = (F.col("k1") == F.col("x1")) & (F.col("k2") == F.col("x2"))
    totals = labelled.where(F.col("below") | itself).groupBy("c1", "c2").agg(
        F.sum("leaf").alias("t_leaf"), F.sum("saved").alias("t_saved")
    )
    totals = small_or_not(scratch.write(totals, f"totals_{step}"), 48)
    added = labelled.join(totals, ["c1", "c2"])
    finished = added.where(itself).select(
        *RESULT[:-2], (F.col("more_leaf") + F.col("t_leaf")).alias("n_leaves"), (F.col("more_saved") + F.col("t_saved")).alias("saved_tokens")
    )
    between = over_half & ~F.col("below")  # those from the centroid to the top
    then = lambda value: F.when(between, value).otherwise(F.lit(0))
    rest = added.where(~itself).select(
        *CARRIED,
        F.when(F.col("below"), F.col("a1")).otherwise(F.col("c1")).alias("c1"),
        F.when(F.col("below"), F.col("a2")).otherwise(F.col("c2")).alias("c2"),
        (F.col("weight") - then(F.col("x_weight"))).alias("weight"),
        "leaf",
        "saved",
        (F.col("more_leaf") + then(F.col("t_leaf"))).alias("more_leaf"),
        (F.col("more_saved") + then(F.col("t_saved"))).alias("more_saved"),
    )
    return scratch.write(rest, f"open_{step + 1}"), finished


def _finish(nodes: DataFrame) -> DataFrame:
    """Components of bounded weight, each whole in one task, from the bottom up."""
    kept = [c for c in CARRIED if c not in ("q1", "q2")]

    def total(rows: list[tuple]) -> pa.RecordBatch:
        """Of rows by component and depth: ``(key, parent's key, leaf, saved, more of each, kept)``;
        keys are by component, so a component's top has no parent."""
        place = {row[0]: i for i, row in enumerate(rows)}
        leaves, saved = [row[2] for row in rows], [row[3] for row in rows]
        for i in range(len(rows) - 1, -1, -1):
            parent = place.get(rows[i][1])
            if parent is not None:
                leaves[parent] += leaves[i]
                saved[parent] += saved[i]
        return pa.RecordBatch.from_arrays(
            [
                *(pa.array(c, pa.int64()) for c in zip(*(row[6] for row in rows), strict=True)),
                pa.array([n + row[4] for n, row in zip(leaves, rows, strict=True)], pa.int64()),
                pa.array([n + row[5] for n, row in zip(saved, rows, strict=True)], pa.int64()),
            ],
            names=RESULT,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows, buffer = None, [], []
        for batch in batches:
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                comp = (columns["c1"][i], columns["c2"][i])
                if comp != last:
                    buffer += rows
                    rows, last = [], comp
                    if len(buffer) > TASK_WEIGHT:
                        yield total(buffer)
                        buffer = []
                rows.append(
                    (
                        (comp, columns["k1"][i], columns["k2"][i]),
                        (comp, columns["q1"][i], columns["q2"][i]),
                        columns["leaf"][i],
                        columns["saved"][i],
                        columns["more_leaf"][i],
                        columns["more_saved"][i],
                        tuple(columns[c][i] for c in kept),
                    )
                )
        buffer += rows
        if buffer:
            yield total(buffer)

    dealt = nodes.repartition("c1", "c2").sortWithinPartitions("c1", "c2", "depth")
    types = ", ".join(f"{c} bigint" for c in RESULT)
    return dealt.select(*CARRIED, *STATE).mapInArrow(run, types)


def end_digests(members: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256``: the digest of the ascending ids of the conversations that end at a
    node. Ids are listed by runs, and only a node's own digest takes its runs one after the other."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"k1": last[0], "k2": last[1], "ends_sha256": state.hexdigest()}],
                pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]),
            )

        for batch in batches:
            rows = []
            for k1, k2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), strict=True):
                if (k1, k2) != last:
                    if last:
                        rows.append(row())
                    last, state = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if rows:
                yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        if last:
            yield row()

    ends = members.where("depth = length").withColumn("run", _run(F.col("conv_id"), ID_RUN))
    listed = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    runs = ends.groupBy("k1", "k2", "run").agg(listed.alias("ids"))
    dealt = runs.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "run")
    return dealt.select("k1", "k2", "ids").mapInArrow(fold, "k1 bigint, k2 bigint, ends_sha256 string")


def prefix_trie(rows: DataFrame, task_weight: int = TASK_WEIGHT) -> DataFrame:
    """One row for each node of the trie of the conversations in ``rows`` (``conv_id, depth, length,
    role, text``, as ``rebuilt`` gives them: depths 0 to ``length`` without gaps).

    ``conv_id``, the smallest of its members (the conversations that begin with the node's turns);
    ``depth``; ``parent_conv_id``, its parent's ``conv_id`` (null at the root); ``n_convs``, members;
    ``n_children``; ``n_leaves``, childless nodes below it; ``saved_tokens``, the sum over what is
    below of ``n_convs - 1`` times the code points of the last text; ``ends_sha256``, the digest of the
    ids of the members that end here, ascending, with commas between. A node is below itself. Equal
    conversations end at one node; other columns are ignored; an empty table gives no rows.
    """
    ship(rows.sparkSession)
    scratch = Scratch(rows.sparkSession)
    members = memberships(rows.select("conv_id", "depth", "length", "role", "text"), scratch)
    nodes = trie_nodes(members, scratch)
    found = rolled_up(nodes, members, scratch, task_weight).join(end_digests(members), ["k1", "k2"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(*RESULT[2:], F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
