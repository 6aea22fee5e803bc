"""A prefix trie of conversations by van Emde Boas recursion.

Sequences of turns are cut at half depth, the halves at half of theirs, and so on. On
the way up, equal blocks of 1, 2, 4, ... turns get equal names. On the way down, each cut
names the prefix that ends there from the prefix that begins its segment and the block
between: all segments of one size are cut in parallel, and each prefix is named once, so
the names of a corpus cost as many rows as it has turns. Totals are grafted upward in the
opposite order: what lies below the cuts of the smallest segments is added to the nodes
above them first, then what lies below the cuts of segments twice that size.

Names are SHA-256 digests of what they name, so they need no exchange: only the two
halves of a block have to meet, by conversation and place.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from sftprep.llm.store import keep

# Ids of one range of this length are written as text by one task.
ID_RANGE = 1 << 15
# Turns of one conversation that may meet one row of it in a join.
TURN_RANGE = 1 << 12
# At most this many nodes are looked up without a shuffle: 64 bytes each.
HEAVY_NODES = 1 << 16


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def item_digest(role: Column, text: Column) -> Column:
    """The name of one turn; the role's length tells where the text begins."""
    return _digest(F.encode(F.length(role).cast("string"), "utf-8"), F.encode(F.lit(":"), "utf-8"),
                   F.encode(role, "utf-8"), F.encode(text, "utf-8"))


def _local_places(batches):
    """The place of each row of a sorted partition among the rows of its conversation."""
    import numpy as np

    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids = batch.column("conv_id").to_numpy()
        n = len(ids)
        if not n:
            continue
        heads = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        place = np.arange(n) - np.repeat(heads, np.diff(np.r_[heads, n]))
        if last == ids[0]:
            place[: heads[1] if len(heads) > 1 else n] += seen
        last, seen = ids[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"), pa.array(np.full(n, part, np.int32)), pa.array(place.astype(np.int64)),
                batch.column("item"), batch.column("chars"),
            ],
            ["conv_id", "part", "place", "item", "chars"],
        )


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, item, chars``: turns numbered from 0 within each conversation.

    Rows are sorted in ranges and counted where they lie, so a conversation of any length
    is spread over tasks; the rows before a range are summed per conversation and range.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv_id is not null")
    rows = rows.withColumn("item", item_digest(F.col("role"), F.col("text")))
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    placed = keep(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "item", F.length("text").cast("long").alias("chars"))
        .mapInArrow(_local_places, "conv_id long, part int, place long, item binary, chars long")
    )
    found = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations that lie in several ranges have anything before a range.
    offsets = found.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")).where("offset > 0")
    return placed.join(offsets, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("pos"), "item", "chars"
    )


def rebuilt(turns: DataFrame, family: int = 100, spread: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their family's first conversation.

    Gives ``(conv_id)`` of all conversations, and ``conv_id, pos, item, chars`` of what they
    consist of: the first h turns of conversation ``c - c % family``, then their own from
    place h on, with ``h = crc32(c as text) % spread``. At most ``spread - 1`` turns are copied.
    """
    own = keep(ordered_turns(turns))
    lengths = keep(own.groupBy("conv_id").agg(F.count("*").alias("n")))
    c = F.col("conv_id")
    share = F.crc32(F.encode(c.cast("string"), "utf-8")) % spread
    first = c - c % family
    copied = keep(
        lengths.select("conv_id", first.alias("base"), share.alias("h"))
        .join(
            own.where((F.col("pos") < spread - 1) & (c % family == 0))
            .groupBy(c.alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "item", "chars"))).alias("turns")),
            "base",
        )
        .select("conv_id", F.filter("turns", lambda t: t["pos"] < F.col("h")).alias("turns"))
    )
    # A family's first conversation may have fewer than h turns: what follows moves up.
    # A long conversation meets its own row once per range of its turns.
    place = F.expr(f"pos div {TURN_RANGE}")
    moves = (
        lengths.join(copied.select("conv_id", F.size("turns").alias("have")), "conv_id", "left")
        .select(
            "conv_id", (F.coalesce("have", F.lit(0)) - share).alias("move"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"n div {TURN_RANGE}"))).alias("range"),
        )
        .where("move <> 0")
    )
    tails = own.where(F.col("pos") >= share).withColumn("range", place).join(moves, ["conv_id", "range"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("move", F.lit(0))).alias("pos"), "item", "chars"
    )
    heads = copied.select("conv_id", F.inline("turns"))
    convs = lengths.select("conv_id")
    return convs, keep(heads.select("conv_id", "pos", "item", "chars").union(tails))


def prefix_names(items: DataFrame) -> DataFrame:
    """``conv_id, depth, name``: a name for the first ``depth`` turns of each conversation,
    equal for equal prefixes, for every depth from 1 on.

    ``items`` holds ``conv_id, pos, item``. Segments of every size are cut at half, from the
    whole depth down to two turns; the number of rounds is the logarithm of the depth.
    """
    longest = items.agg(F.max("pos")).first()[0]
    if longest is None:
        return items.select("conv_id", F.col("pos").alias("depth"), F.col("item").alias("name"))
    rounds = (int(longest) + 1).bit_length()
    # blocks[k]: names of the whole blocks of 2^k turns, (conv_id, place, name).
    blocks = [items.select("conv_id", F.col("pos").alias("place"), F.col("item").alias("name"))]
    for _ in range(1, rounds):
        last = blocks[-1]
        halves = last.groupBy("conv_id", F.shiftright("place", 1).alias("place")).agg(
            F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("left"),
            F.max(F.when(F.col("place") % 2 == 1, F.col("name"))).alias("right"),
        )
        blocks.append(keep(
            halves.where("left is not null and right is not null")
            .select("conv_id", "place", _digest(F.col("left"), F.col("right")).alias("name"))
        ))
    # Segments begin at a prefix that has a name; the empty one has the digest of nothing.
    nothing = F.unhex(F.lit(hashlib.sha256(b"").hexdigest()))
    named, starts = [], None
    for k in reversed(range(rounds)):
        # The first half of segment s of 2^(k+1) turns is block 2 s of 2^k turns.
        first_half = blocks[k].where("place % 2 = 0").select(
            "conv_id", F.shiftright("place", 1).alias("segment"), F.col("name").alias("block")
        )
        cut = first_half.where("segment = 0").withColumn("root", nothing)
        if starts is not None:
            cut = cut.unionByName(first_half.join(starts, ["conv_id", "segment"]))
        cut = keep(cut.select("conv_id", "segment", _digest(F.col("root"), F.col("block")).alias("name")))
        named.append(cut.select(
            "conv_id", F.shiftleft(F.col("segment") * 2 + 1, k).cast("long").alias("depth"), "name"
        ))
        # The cut begins the second half; the first half begins where the segment did,
        # whether or not the conversation goes on to the cut.
        after = cut.select("conv_id", (F.col("segment") * 2 + 1).alias("segment"), F.col("name").alias("root"))
        if starts is not None:
            after = after.union(starts.select("conv_id", (F.col("segment") * 2).alias("segment"), "root"))
        starts = after
    out = named[0]
    for more in named[1:]:
        out = out.union(more)
    return out


def _hash_in_order(batches):
    """SHA-256 of the texts of each node, which lie in order over the batches."""
    name, depth, state, first = None, None, None, True
    for batch in batches:
        names, depths, texts = (batch.column(c).to_pylist() for c in ("name", "depth", "ids"))
        done = []
        for n, d, text in zip(names, depths, texts):
            if (n, d) != (name, depth):
                if state is not None:
                    done.append((name, depth, state.hexdigest()))
                name, depth, state, first = n, d, hashlib.sha256(), True
            state.update(text.encode() if first else b"," + text.encode())
            first = False
        if done:
            yield _ends_batch(done)
    if state is not None:
        yield _ends_batch([(name, depth, state.hexdigest())])


def _ends_batch(rows):
    name, depth, sha = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(name, pa.binary()), pa.array(depth, pa.int64()), pa.array(sha, pa.string())],
        ["name", "depth", "ends_sha256"],
    )


def ends_of(ends: DataFrame) -> DataFrame:
    """``name, depth, ends_sha256`` from the node ``(name, depth)`` each ``conv_id`` ends at.

    Ids of one range are put in order by one task; where a node has more than one such
    text, a digest has to be fed with them one after the other, a text at a time.
    """
    texts = keep(
        ends.groupBy("name", "depth", F.floor(F.col("conv_id") / ID_RANGE).alias("range"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    )
    counts = texts.groupBy("name", "depth").agg(F.count("*").alias("n"), F.min("ids").alias("ids"))
    alone = counts.where("n = 1").select("name", "depth", F.sha2("ids", 256).alias("ends_sha256"))
    many = (
        texts.join(counts.where("n > 1").select("name", "depth"), ["name", "depth"], "left_semi")
        .repartition("name", "depth").sortWithinPartitions("name", "depth", "range")
        .select("name", "depth", "ids").mapInArrow(_hash_in_order, "name binary, depth long, ends_sha256 string")
    )
    return alone.union(many)


def prefix_trie(convs: DataFrame, items: DataFrame) -> DataFrame:
    """The nodes of the trie of ``items (conv_id, pos, item, chars)``.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``, one row per distinct prefix; a node is named by its smallest member and
    depth. ``convs`` has one ``conv_id`` per conversation, those without turns included.
    """
    smallest = convs.agg(F.min("conv_id")).first()[0]
    paths = keep(
        prefix_names(items.select("conv_id", "pos", "item"))
        .join(items.select("conv_id", (F.col("pos") + 1).alias("depth"), "chars"), ["conv_id", "depth"])
    )
    nodes = keep(
        paths.groupBy("depth", "name")
        .agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"))
    )
    # Each path names its nodes by their owners. A node that a large share of all paths
    # hold is looked up where the rows lie: there are at most HEAVY_NODES such nodes.
    heavy = nodes.where(F.col("n_convs") > max(1000, paths.count() // HEAVY_NODES))
    marked = paths.select("conv_id", "depth", "name").join(
        F.broadcast(heavy.select("depth", "name", F.col("owner").alias("_heavy"))), ["depth", "name"], "left"
    )
    light = marked.where("_heavy is null").join(nodes.select("depth", "name", "owner"), ["depth", "name"])
    owners = keep(
        marked.where("_heavy is not null").select("conv_id", "depth", F.col("_heavy").alias("owner"))
        .union(light.select("conv_id", "depth", "owner"))
    )
    # The parent of a node that conversation c owns lies on the path of c.
    root = F.lit(smallest).cast("long")
    above = owners.select(F.col("conv_id").alias("owner"), (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    tree = keep(
        nodes.join(above, ["owner", "depth"], "left").select(
            "owner", "depth", "name", "n_convs",
            F.when(F.col("depth") == 1, root).otherwise(F.col("parent")).alias("parent"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        )
    )
    children = tree.groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children")
    )
    inner = keep(
        tree.join(children, ["owner", "depth"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    )
    # Totals of each node's own, (owner, depth, leaves, saved), to which those of what
    # lies below are added, one size of segments after the other.
    totals = inner.select("owner", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), "saved")
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    path = owners.select(F.col("conv_id").alias("of"), F.col("depth"), "owner")
    half = 1
    while half <= deepest:
        cuts = totals.where((F.col("depth") % (2 * half) == half))
        # A cut's ancestors within the upper half; depth 0, the root, is summed apart.
        lifted = (
            cuts.where(F.col("depth") > 1)
            .select(
                F.col("owner").alias("of"), "leaves", "saved",
                F.explode(F.sequence(F.greatest(F.col("depth") - half, F.lit(1)), F.col("depth") - 1)).alias("depth"),
            )
            .where(F.col("depth") >= 1)
            .join(path, ["of", "depth"])
            .groupBy("owner", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        )
        totals = keep(
            totals.union(lifted.select("owner", "depth", "leaves", "saved"))
            .groupBy("owner", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        )
        half *= 2
    last = items.groupBy("conv_id").agg(F.count("*").alias("depth"))
    ends = ends_of(last.join(paths.select("conv_id", "depth", "name"), ["conv_id", "depth"]).select("conv_id", "depth", "name"))
    none = hashlib.sha256(b"").hexdigest()
    out = (
        inner.join(totals.select("owner", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")), ["owner", "depth"])
        .join(ends, ["name", "depth"], "left")
        .select(
            F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )
    # The root, one row: every conversation starts with no turn. Its parts are one row each.
    turnless = convs.join(last, "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.unhex(F.lit(none)).alias("name")
    )
    parts = (
        convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
        .unionByName(
            out.where("depth = 1").agg(
                F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
            ),
            allowMissingColumns=True,
        )
        .unionByName(ends_of(turnless).select("ends_sha256"), allowMissingColumns=True)
    )
    top = (
        parts.agg(*(F.max(c).alias(c) for c in parts.columns)).where("n_convs > 0")
        .select(
            "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
            F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )
    return out.union(top)


def conversation_trie(turns: DataFrame, family: int = 100, spread: int = 6) -> DataFrame:
    """The prefix trie of rebuilt conversations (see ``rebuilt`` and ``prefix_trie``).

    ``turns`` has ``conv_id, turn, role, text``; other columns are left out. Turns are
    ordered by ``turn``, null first, equal ones by role and text. A null role or text is
    empty. Repeated rows are turns of their own. Rows without a ``conv_id`` belong to no
    conversation. The remainder of a negative id is negative. An empty table has no nodes,
    not even a root.
    """
    return prefix_trie(*rebuilt(turns, family, spread))
