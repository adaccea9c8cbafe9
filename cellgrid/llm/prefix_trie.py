"""Conversation prefix trie: one node for each distinct sequence of first turns, with totals over its subtree.

A node's key is its depth and two 64-bit values, the exclusive or of hashes of (place, turn) over its turns, so that keys
of all prefixes are running values, also of a conversation that is spread over many tasks.

Totals come from parallel tree contraction. In a round, leaves are raked (their total is final, and is added to the
parent's), and every second node of a chain of nodes with one child is compressed (its child hangs on its parent, and
carries what the node adds on the way). Contracted nodes are then expanded again: a node's total is that of the child it
was contracted onto, which may be a contracted node itself, plus what the child carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.llm._shared import discard, shared_dir, split_join, stored

KEY = ["depth", "k1", "k2"]
NODE = ["conv_id", "depth"]
#: Turns of a conversation whose running keys one task works out.
BLOCK = 512
#: Numerically consecutive ids that are joined to one string before they are hashed.
IDS = 4096


def ordered_turns(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, pos (from 1), t1, t2, chars`` in order, and conversations ``conv_id, n_turns``.

    ``t1, t2`` are two hashes of (role, text), ``chars`` the text's code points. Rows are sorted by conversation, turn (null first), role and text over all tasks, so
    that a conversation of any length is split; a row's place follows from its range's first row. Rows without a
    ``conv_id`` take no part; a null role or text is an empty one; repeated rows are turns of their own.
    """
    turns = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(
        dealt.select(
            "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
            F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit("turn"), "text", "role").alias("t2"), F.char_length("text").alias("chars"),
        ),
        f"{path}/placed",
    )
    ranges = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part")
    ranges = ranges.withColumn("shift", F.sum("n").over(before) - F.col("n") - F.col("first") + 1)
    turns = placed.join(ranges.select("conv_id", "part", "shift"), ["conv_id", "part"])
    return turns.select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "t1", "t2", "chars"), ranges.groupBy("conv_id").agg(F.sum("n").alias("n_turns"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, chars, last`` of ``turns`` with the keys ``k1, k2`` of the prefix and ``p1, p2`` of its parent.

    ``turns`` has ``conv_id, depth (from 1), t1, t2`` besides. Blocks of a conversation are worked out apart, and what the
    blocks before amount to is added.
    """
    own = turns.withColumns({
        "g1": F.xxhash64("depth", "t1", "t2"), "g2": F.xxhash64(F.lit("prefix"), "depth", "t2", "t1"),
        "block": F.floor((F.col("depth") - 1) / BLOCK),
    }).drop("t1", "t2")
    inside = Window.partitionBy("conv_id", "block").orderBy("depth")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = own.groupBy("conv_id", "block").agg(F.bit_xor("g1").alias("b1"), F.bit_xor("g2").alias("b2"))
    zero = F.lit(0).cast("bigint")
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(b).over(before), zero).alias(b) for b in ("b1", "b2")])
    local = own.withColumns({f"l{i}": F.bit_xor(f"g{i}").over(inside) for i in (1, 2)})
    keyed = local.join(blocks, ["conv_id", "block"])
    keyed = keyed.withColumns({f"k{i}": F.col(f"l{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)})
    keyed = keyed.withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"g{i}")) for i in (1, 2)})
    return keyed.select("conv_id", *KEY, "p1", "p2", "chars", "last")


def trie_nodes(prefix: DataFrame, convs: DataFrame, path: str) -> DataFrame:
    """Nodes ``conv_id (smallest member), depth, parent_conv_id, n_convs, chars, k1, k2``; the root's keys are 0.

    ``convs`` has each ``conv_id`` once, those without turns too.
    """
    zero = F.lit(0).cast("bigint")
    root = convs.groupBy(zero.alias("depth"), zero.alias("k1"), zero.alias("k2")).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    inner = prefix.groupBy(*KEY, "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"))
    root, inner = stored(root, f"{path}/root"), stored(inner, f"{path}/inner")
    parents = inner.select(*KEY, "conv_id").unionByName(root.select(*KEY, "conv_id"))
    parents = parents.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    inner = split_join(inner, parents, ["depth", "p1", "p2"], ["k1", "k2"])
    root = root.withColumns({"chars": F.lit(0), "parent_conv_id": F.lit(None).cast("bigint")})
    columns = [*NODE, "parent_conv_id", "n_convs", "chars", "k1", "k2"]
    return inner.select(*columns).unionByName(root.select(*columns))


def subtree_totals(nodes: DataFrame, values: list[str], path: str) -> DataFrame:
    """``conv_id, depth, n_children`` and, for each of ``values`` (bigint), its sum over the node's subtree.

    ``nodes`` has ``conv_id, depth, parent_conv_id, parent_depth`` (both null for a root) and the values. Rounds rake all
    leaves and compress nodes of chains; each round's nodes are written to ``path``, and a round joins by unique
    keys only. A chain of nodes one level apart halves in each of the first rounds (those of odd depth go, then those of
    odd half depth, and so on); later ones pick by a hash.
    """
    spark = nodes.sparkSession
    up = ["parent_conv_id", "parent_depth"]
    accs, extras = [f"a_{v}" for v in values], [f"e_{v}" for v in values]
    zero = F.lit(0).cast("bigint")
    kids = nodes.where("parent_conv_id is not null").groupBy(*up).agg(F.count("*").alias("kids"))
    kids = kids.select(F.col("parent_conv_id").alias("conv_id"), F.col("parent_depth").alias("depth"), "kids")
    live = nodes.join(kids, NODE, "left").select(
        *NODE, *up, *[F.col(v).cast("bigint").alias(a) for v, a in zip(values, accs)], *[zero.alias(e) for e in extras], F.coalesce("kids", zero).alias("kids"))
    live = stored(live, f"{path}/start")
    counted = live.select(*NODE, F.col("kids").alias("n_children"))
    bits = max(1, int(live.agg(F.coalesce(F.max("depth"), zero)).first()[0]).bit_length())
    rounds: list[DataFrame] = []
    while True:
        done = F.col("kids") == 0
        carried = [(F.col(a) + F.col(e)) for a, e in zip(accs, extras)]
        # what leaves give their parent, and the child that stays (of one alone it is the one)
        seen = live.where("parent_conv_id is not null").groupBy(*up).agg(
            F.sum(F.when(done, 0).otherwise(1)).alias("stay"), *[F.sum(F.when(done, c).otherwise(0)).alias(f"g_{v}") for c, v in zip(carried, values)],
            F.min(F.when(~done, F.struct(*NODE, *extras))).alias("child"),
        ).select(F.col("parent_conv_id").alias("conv_id"), F.col("parent_depth").alias("depth"), "stay", *[f"g_{v}" for v in values], "child")
        after = live.join(seen, NODE, "left")
        gained = {a: F.col(a) + F.coalesce(f"g_{v}", zero) for a, v in zip(accs, values)}
        r = len(rounds)
        coin = (lambda conv, depth: F.shiftright(depth, r) % 2) if r < bits else (lambda conv, depth: F.pmod(F.xxhash64(F.lit(r), conv, depth), F.lit(2)))  # noqa: B023
        splice = (F.col("stay") == 1) & F.col("parent_conv_id").isNotNull() & (coin(F.col("conv_id"), F.col("depth")) == 1) & (coin(F.col("parent_conv_id"), F.col("parent_depth")) == 0)
        state = F.when(done, "leaf").when(F.coalesce(splice, F.lit(False)), "chain").otherwise("live")
        rounds.append(stored(after.withColumn("state", state).withColumns(gained | {"kids": F.coalesce("stay", zero)}).select(*NODE, *up, *accs, *extras, "kids", "child", "state"), f"{path}/{r}"))
        # a compressed node's child takes its place, and carries what the node adds
        gone = rounds[-1].where("state = 'chain'")
        moves = gone.select(F.col("child.conv_id").alias("conv_id"), F.col("child.depth").alias("depth"), F.struct(*up).alias("to"), *[(F.col(a) + F.col(e)).alias(f"m_{v}") for a, e, v in zip(accs, extras, values)])
        stay = rounds[-1].where("state = 'live'").join(moves, NODE, "left")
        live = stay.select(
            *NODE, *[F.when(F.col("to").isNull(), F.col(u)).otherwise(F.col("to")[u]).alias(u) for u in up], *accs,
            *[(F.col(e) + F.coalesce(f"m_{v}", zero)).alias(e) for e, v in zip(extras, values)], "kids",
        )
        if rounds[-1].where("state = 'live'").isEmpty():
            break
    every = spark.read.schema(rounds[0].schema).parquet(*[f"{path}/{r}" for r in range(len(rounds))])
    totals = every.where("state = 'leaf'").select(*NODE, *accs)
    # expand: chains of contracted nodes get shorter by half in each step, until all hang on a raked node
    hangs = stored(every.where("state = 'chain'").select(
        *NODE, F.col("child.conv_id").alias("on_conv"), F.col("child.depth").alias("on_depth"), *[(F.col(a) + F.col(f"child.{e}")).alias(a) for a, e in zip(accs, extras)]), f"{path}/hangs")
    step = 0
    while True:
        next_ = hangs.select(F.col("conv_id").alias("on_conv"), F.col("depth").alias("on_depth"), F.struct("on_conv", "on_depth", *accs).alias("next"))
        both = hangs.join(next_, ["on_conv", "on_depth"], "left")
        if both.where("next is not null").isEmpty():
            break
        step += 1
        far = {c: F.coalesce(F.col(f"next.{c}"), F.col(c)) for c in ("on_conv", "on_depth")}
        hangs = stored(both.withColumns(far | {a: F.col(a) + F.coalesce(F.col(f"next.{a}"), zero) for a in accs}).select(*hangs.columns), f"{path}/hangs{step}")
    ends = totals.select(F.col("conv_id").alias("on_conv"), F.col("depth").alias("on_depth"), *[F.col(a).alias(f"t_{a}") for a in accs])
    expanded = hangs.join(ends, ["on_conv", "on_depth"]).select(*NODE, *[(F.col(a) + F.col(f"t_{a}")).alias(a) for a in accs])
    totals = totals.unionByName(expanded)
    return counted.join(totals, NODE).select(*NODE, "n_children", *[F.col(a).alias(v) for a, v in zip(accs, values)])


def prefix_trie(turns: DataFrame, convs: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie, and the conversations that end at each.

    ``turns`` has ``conv_id, depth (from 1, without gaps), t1, t2, chars, last``, ``convs`` each ``conv_id`` once, with its
    ``n_turns``. What is written on the way goes to the folder ``path``, which the results read. Nodes are
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, k1, k2``, ends ``depth, k1, k2, member``.
    Without conversations there is no node; conversations without turns are members of the root, and end there. Nodes,
    totals and ends are grouped by keys of 128 bits; no task holds a conversation, the children of a node or its members.
    """
    prefix = stored(prefixes(turns), f"{path}/prefixes")
    nodes = stored(trie_nodes(prefix, convs, path), f"{path}/nodes")
    valued = nodes.withColumns({
        "parent_depth": F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
    })
    leafless = nodes.select("parent_conv_id", (F.col("depth") - 1).alias("parent_depth")).where("parent_conv_id is not null").distinct()
    leafless = leafless.select(F.col("parent_conv_id").alias("conv_id"), F.col("parent_depth").alias("depth"), F.lit(0).cast("bigint").alias("n_leaves"))
    valued = valued.join(leafless, NODE, "left").withColumn("n_leaves", F.coalesce("n_leaves", F.lit(1).cast("bigint")))
    totals = subtree_totals(valued, ["n_leaves", "saved_tokens"], f"{path}/rounds")
    out = nodes.join(totals, NODE).select(*NODE, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "k1", "k2")
    zero = F.lit(0).cast("bigint")
    empty = convs.where("n_turns = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.col("conv_id").alias("member"))
    ends = prefix.where("last").select(*KEY, F.col("conv_id").alias("member")).unionByName(empty)
    return out, ends


def digest_ids(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, sha256``: the hash of each node's ``member`` ids in ascending order, joined by commas.

    Ids are joined in chunks of a bounded range each; a task then hashes a node's chunks one after the other, without
    holding more than a batch of them.
    """
    chunks = ends.groupBy(*KEY, F.floor(F.col("member") / IDS).alias("chunk")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda m: m.cast("string")), ",").alias("ids"))
    dealt = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out = []
            for *k, ids in zip(*(batch[c].to_pylist() for c in (*KEY, "ids"))):
                if k == key:
                    sha.update(b"," + ids.encode())
                else:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*KEY, "sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, sha.hexdigest())], [*KEY, "sha256"])

    return dealt.mapInArrow(run, "depth bigint, k1 bigint, k2 bigint, sha256 string")


def rebuilt(rows: DataFrame, path: str, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their hundred: the inputs of :func:`prefix_trie`.

    Conversation c takes the first h turns of c - c % ``every`` (as many as it has; none if it is not there), then its own
    turns after its first h, where h is the crc32 of c's digits modulo ``most``.
    """
    turns, convs = ordered_turns(rows, path)
    turns, convs = stored(turns, f"{path}/turns"), stored(convs, f"{path}/convs")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = F.col("conv_id") - F.col("conv_id") % every
    sized = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    convs = convs.withColumns({"h": h, "base": base}).join(sized, "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0).cast("bigint"))))
    convs = stored(convs.withColumn("own", F.greatest(F.col("n_turns") - F.col("h"), F.lit(0).cast("bigint"))), f"{path}/sized")
    head = turns.where((F.col("pos") < most) & (base == F.col("conv_id"))).select(F.col("conv_id").alias("base"), "pos", "t1", "t2", "chars")
    head = head.join(convs.where("taken > 0").select("conv_id", "base", "taken", "own"), "base").where("pos <= taken")
    head = head.select("conv_id", F.col("pos").alias("depth"), "t1", "t2", "chars", ((F.col("own") == 0) & (F.col("pos") == F.col("taken"))).alias("last"))
    # a conversation that is spread over several ranges meets its row of each range
    tail = turns.where(F.col("pos") > h)
    tail = split_join(tail, convs.select("conv_id", "h", "taken", "n_turns"), ["conv_id"], ["pos"])
    tail = tail.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "t1", "t2", "chars", (F.col("pos") == F.col("n_turns")).alias("last"))
    return head.unionByName(tail), convs.select("conv_id", (F.col("taken") + F.col("own")).alias("n_turns"))


def conversation_trie(rows: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations, with the digest of the conversations that end at each node.

    ``rows`` has ``conv_id, turn, role, text``; more columns don't matter, however named. Ties of a turn go by role and
    text, so that equal rows are turns in a row. An empty table, or one without any ``conv_id``, gives no rows; texts of any
    length count whole.
    """
    path = shared_dir(rows.sparkSession)
    nodes, ends = prefix_trie(*rebuilt(rows, path), path)
    out = nodes.join(digest_ids(ends), KEY, "left").drop("k1", "k2")
    out = stored(out.withColumn("ends_sha256", F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest()))).drop("sha256"))
    discard(path, rows.sparkSession)
    return out
