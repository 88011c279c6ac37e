"""The prefix trie of conversations, with totals of every subtree by centroid decomposition.

A prefix of d turns is named by d and by sums of hashes of (place, turn) over its turns, so a name is a running
sum along a conversation. Conversations are laid out over ranges of (conversation, place), so that one with
any share of all rows is cut over many tasks, each of which adds what the ranges before it had.

Inside, a node is one of its members and a depth: the member first in an order by hash. The nodes of
one such member are the end of its path, a chain, and a path from the root changes chains about as often as
the logarithm of the members. Totals go up in two steps. The nodes at or below which there are at most
``block`` (turn, conversation) pairs fall into small components, each summed in one task, many at a time. What is left
at the top has chains that are cut into segments of at most ``block`` nodes; the tree of segments is
summed in one task, and added down each segment's path to its top. Both sums are by centroid
decomposition. ``block`` grows with the root of the table, so neither step meets more than about that.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.centroids import subtree_sums
from strataflow.llm.common import saved, ship

WORD = r"[^\x20\x09-\x0D]+"
#: Least number of pairs in a component, nodes that a task sums at a time, ids that go on as one text.
LEAST_BLOCK, NODES, IDS = 1_024, 1 << 18, 1_000
LANES = ["s0", "s1", "s2", "s3"]
PREFIX = ["pos", *LANES]
VALUES = ["n_leaves", "saved_tokens"]
TURN = "conv_id long, pos long, t1 long, t2 long, words long"


def running(
    df: DataFrame, key: str, order: list[Column], keep: list[str], amounts: dict[str, Column], purpose: str
) -> DataFrame:
    """``key``, ``keep`` and running sums of ``amounts`` (none negative) over each key's rows in ``order``.

    Rows are laid out by ranges, sorted and added up in one pass; a key that goes on over several ranges
    gets what the ranges before had, from one row of sums per range.
    """
    names = list(amounts)
    # The last column tells repeated rows apart, so that ranges can cut between them.
    laid = df.withColumn("__row", F.monotonically_increasing_id())
    ranges = [F.col(key), *order, F.col("__row")]
    laid = laid.repartitionByRange(*ranges).sortWithinPartitions(*ranges)
    lean = laid.select(
        key, *keep, *[c.cast("long").alias(n) for n, c in amounts.items()],
        F.spark_partition_id().cast("long").alias("part"),
    )
    added = [T.StructField("first", T.BooleanType()), T.StructField("at", T.LongType())]
    schema = T.StructType([*lean.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, last, sums, at = None, None, [0] * len(names), 0
        for batch in batches:
            keys = batch.column(key).to_numpy()
            if not len(keys):
                continue
            begun = keys[0] if begun is None else begun
            new = np.r_[keys[0] != last, keys[1:] != keys[:-1]]
            start = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
            columns = {name: batch.column(name) for name in batch.schema.names}
            for k, name in enumerate(names):
                amount = batch.column(name).to_numpy()
                total = np.cumsum(amount)
                base = np.where(start >= 0, (total - amount)[start], -sums[k])
                columns[name] = pa.array(total - base)
                sums[k] = int((total - base)[-1])
            last = keys[-1]
            columns["first"] = pa.array(keys == begun)
            columns["at"] = pa.array(np.arange(at, at + len(keys)))
            at += len(keys)
            yield pa.record_batch(list(columns.values()), list(columns))

    local = saved(lean.mapInArrow(run, schema), purpose)
    row = F.struct(key, *names)
    ends = local.groupBy("part").agg(
        F.max_by(row, F.when(F.col("first"), F.col("at"))).alias("first"),
        F.max_by(row, "at").alias("last"),
    )
    # One row per range.
    adds, before = [], None
    for end in ends.orderBy("part").collect():
        add = [0] * len(names)
        if before and before[0] == end["first"][key]:
            add = before[1]
            adds.append((end["part"], *add))
        own = [end["last"][n] for n in names]
        if end["last"][key] == end["first"][key]:
            own = [a + b for a, b in zip(add, own)]
        before = (end["last"][key], own)
    schema = "__part long, " + ", ".join(f"__{n} long" for n in names)
    adds = F.broadcast(df.sparkSession.createDataFrame(adds, schema))
    goes_on = F.col("first") & (F.col("part") == F.col("__part"))
    sums = [(F.col(n) + F.coalesce(F.col(f"__{n}"), F.lit(0))).alias(n) for n in names]
    return local.join(adds, goes_on, "left").select(key, *keep, *sums)


def numbered(conversations: DataFrame) -> DataFrame:
    """The turns (see TURN) of each conversation, numbered from 1 in order of turn, NULL first.

    Of turns of one number that with the smaller role and then text comes first. Texts go on as two
    hashes, but for those whose order they have to settle.
    """
    empty = F.lit("")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), empty).alias("role"),
        F.coalesce(F.col("text"), empty).alias("text"),
    )
    moment = ["conv_id", "turn"]
    lean = rows.select(
        *moment, "role",
        F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit("turn"), "text", "role").alias("t2"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        F.col("text").alias("tie"),
    )
    tied = saved(rows.groupBy(*moment).agg(F.count("*").alias("n")).where("n > 1"), "tied-turns")
    if tied.take(1):
        ties = tied.select(F.col("conv_id").alias("__c"), F.col("turn").alias("__t"))
        same = (F.col("conv_id") == F.col("__c")) & F.col("turn").eqNullSafe(F.col("__t"))
        alone = lean.withColumn("tie", empty).join(ties, same, "left_anti")
        lean = alone.unionAll(lean.join(ties, same, "left_semi"))
    else:
        lean = lean.withColumn("tie", empty)
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]
    kept = ["t1", "t2", "words"]
    return running(lean, "conv_id", order, kept, {"pos": F.lit(1)}, "turns").select(
        "conv_id", "pos", *kept
    )


def whole(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations with their length, turns) as they are."""
    return turns.groupBy("conv_id").agg(F.max("pos").alias("length")), turns


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """The same, after the first h turns of conversation c are taken from conversation c - c % every.

    h is the hash of c modulo ``most``; all turns if there are fewer, none if there is no such conversation.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    given = (F.col("conv_id") % every == 0) & (F.col("pos") < most)
    heads = saved(turns.where(given).withColumnRenamed("conv_id", "base"), "heads")
    known = heads.groupBy("base").agg(F.max("pos").alias("known"))
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n")).select("*", base, head.alias("h"))
    taken = F.least("h", F.coalesce("known", F.lit(0))).alias("taken")
    all_ = own.join(known, "base", "left").select("conv_id", "base", "n", "h", taken)
    rest = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    all_ = saved(all_.withColumn("length", F.col("taken") + rest), "conversations")
    first = all_.where("taken > 0").join(heads, "base").where("pos <= taken")
    moved = turns.where(F.col("pos") > head).join(
        all_.select("conv_id", (F.col("taken") - F.col("h")).alias("moved")), "conv_id"
    )
    names = [part.split()[0] for part in TURN.split(", ")]
    later = moved.withColumn("pos", F.col("pos") + F.col("moved")).select(*names)
    return all_.select("conv_id", "length"), first.select(*names).unionAll(later)


def paths(all_: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each prefix of each conversation, the empty one too: its name, the words of its last turn,
    and how many prefixes the conversation has from it on."""
    lanes = [
        F.shiftright(F.xxhash64(F.lit(lane), "pos", "t1", "t2"), shift).bitwiseAND(F.lit(0xFFFFFFFF))
        for lane, shift in ((1, 0), (1, 32), (2, 0), (2, 32))
    ]
    sums = running(
        turns, "conv_id", [F.col("pos")], ["pos", "words"], dict(zip(LANES, lanes)), "prefixes"
    )
    zero = F.lit(0).cast("long")
    roots = all_.select(
        "conv_id", zero.alias("pos"), zero.alias("words"), *[zero.alias(n) for n in LANES],
        (F.col("length") + 1).alias("weight"),
    )
    rows = sums.join(all_, "conv_id").withColumn("weight", F.col("length") - F.col("pos") + 1)
    return rows.select(*roots.columns).unionAll(roots)


def _chosen() -> Column:
    """The member first in an order by hash, of a group."""
    return F.min(F.struct(F.xxhash64("conv_id").alias("h"), "conv_id"))["conv_id"]


def _sum_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtree sums of whole components (top_chain, top_pos), which come one after another."""
    waiting: list[pa.RecordBatch] = []

    def summed(table: pa.Table) -> pa.RecordBatch:
        column = {n: table.column(n).to_numpy() for n in table.column_names}
        _, code = np.unique(np.r_[column["chain"], column["up_chain"]], return_inverse=True)
        n = table.num_rows
        width = int(column["pos"].max()) + 2
        own, above = code[:n] * width + column["pos"], code[n:] * width + column["up_pos"]
        order = np.argsort(own)
        found = order[np.minimum(np.searchsorted(own[order], above), n - 1)]
        is_top = (column["chain"] == column["top_chain"]) & (column["pos"] == column["top_pos"])
        parent = np.where(is_top, -1, found)
        values = np.stack([column[v] for v in VALUES], axis=1)
        sums = subtree_sums(parent, column["weight"], values)
        arrays = [table.column("chain").combine_chunks(), table.column("pos").combine_chunks()]
        return pa.record_batch([*arrays, *map(pa.array, sums.T)], ["chain", "pos", *VALUES])

    held = 0
    for batch in batches:
        waiting.append(batch)
        held += batch.num_rows
        if held < NODES:
            continue
        table = pa.Table.from_batches(waiting)
        # The last component may go on.
        a, b = table.column("top_chain").to_numpy(), table.column("top_pos").to_numpy()
        edge = np.flatnonzero((a != a[-1]) | (b != b[-1]))
        cut = int(edge[-1]) + 1 if len(edge) else 0
        if cut:
            yield summed(table.slice(0, cut))
        waiting = table.slice(cut).to_batches()
        held = table.num_rows - cut
    if held:
        yield summed(pa.Table.from_batches(waiting))


def rollup(nodes: DataFrame, block: int) -> DataFrame:
    """chain, pos and the VALUES summed over each node's subtree.

    ``nodes`` has chain, pos (unique), up_chain, up_pos (the parent; NULL at the root), weight (pairs at and
    below), the VALUES, and of its chain: begin (its first pos), and top_chain, top_pos: the highest node on the path
    with a weight of at most ``block``, NULL if there is none.
    """
    zero = F.lit(0).cast("long")
    links = ["chain", "pos", "up_chain", "up_pos", "weight", *VALUES]
    small = nodes.where(F.col("weight") <= block).select(
        *[F.coalesce(n, zero).alias(n) if n.startswith("up_") else F.col(n) for n in links],
        "top_chain", "top_pos",
    )
    laid = small.repartition("top_chain", "top_pos").sortWithinPartitions("top_chain", "top_pos")
    schema = "chain long, pos long, " + ", ".join(f"{v} long" for v in VALUES)
    low = saved(laid.mapInArrow(_sum_components, schema), "components")
    large = saved(
        nodes.where(F.col("weight") > block).select(
            *links, "begin", F.floor((F.col("pos") - F.col("begin")) / block).alias("segment")
        ),
        "large-nodes",
    )
    if not large.take(1):
        return low
    # What small components give to the node above them.
    at_top = (F.col("pos") == F.col("top_pos")) & (F.col("chain") == F.col("top_chain"))
    tops = nodes.where((F.col("weight") <= block) & at_top).select("chain", "pos", "up_chain", "up_pos")
    given = tops.join(low, ["chain", "pos"]).groupBy("up_chain", "up_pos")
    given = given.agg(*[F.sum(v).alias(f"from_{v}") for v in VALUES])
    given = given.withColumnsRenamed({"up_chain": "chain", "up_pos": "pos"})
    own = large.join(given, ["chain", "pos"], "left").select(
        *links[:5], "begin", "segment",
        *[(F.col(v) + F.coalesce(f"from_{v}", zero)).alias(v) for v in VALUES],
    )
    own = saved(own, "large-sums")
    # A segment is a path; the node that it hangs on belongs to another one.
    first = own.groupBy("chain", "segment").agg(
        F.min("pos").alias("top_pos"), F.max("weight").alias("weight"),
        *[F.min_by(n, "pos").alias(n) for n in ("up_chain", "up_pos")],
        *[F.sum(v).alias(v) for v in VALUES],
    )
    first = saved(first.withColumnRenamed("top_pos", "pos"), "segments")
    hangs = own.select(
        F.col("chain").alias("up_chain"), F.col("pos").alias("up_pos"), F.col("segment").alias("up_segment")
    )
    tree = first.join(hangs, ["up_chain", "up_pos"], "left").select(
        "chain", "segment", "weight", F.coalesce("up_chain", zero).alias("up_chain"),
        F.coalesce("up_segment", F.lit(-1).cast("long")).alias("up_segment"), *VALUES,
    )

    def sum_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        column = {n: table.column(n).to_numpy() for n in table.column_names}
        _, code = np.unique(np.r_[column["chain"], column["up_chain"]], return_inverse=True)
        n, width = table.num_rows, int(column["segment"].max()) + 2
        own, above = code[:n] * width + column["segment"], code[n:] * width + column["up_segment"]
        order = np.argsort(own)
        found = order[np.minimum(np.searchsorted(own[order], above), n - 1)]
        parent = np.where(column["up_segment"] < 0, -1, found)
        values = np.stack([column[v] for v in VALUES], axis=1)
        sums = subtree_sums(parent, column["weight"], values)
        arrays = [pa.array(column["chain"]), pa.array(column["segment"]), *map(pa.array, sums.T)]
        yield pa.record_batch(arrays, ["chain", "segment", *VALUES])

    # One task, over about the root of the number of rows.
    schema = "chain long, segment long, " + ", ".join(f"{v} long" for v in VALUES)
    one = tree.repartition(1).sortWithinPartitions("chain", "segment")
    total = saved(one.mapInArrow(sum_segments, schema), "segment-sums")
    below = first.drop(*VALUES).join(total, ["chain", "segment"]).where(F.col("up_chain").isNotNull())
    below = below.groupBy("up_chain", "up_pos").agg(*[F.sum(v).alias(f"from_{v}") for v in VALUES])
    below = below.withColumnsRenamed({"up_chain": "chain", "up_pos": "pos"})
    # The first node of a chain's next segment hangs on the last of this one, too.
    down = Window.partitionBy("chain", "segment").orderBy(F.col("pos").desc())
    high = own.join(below, ["chain", "pos"], "left").select(
        "chain", "pos",
        *[F.sum(F.col(v) + F.coalesce(f"from_{v}", zero)).over(down).alias(v) for v in VALUES],
    )
    return low.unionAll(high)


def ends_hashes(ends: DataFrame) -> DataFrame:
    """chain, pos and the sha256 of the ascending ids of ``ends`` (chain, pos, conv_id), joined by commas.

    Ids are laid out by ranges and joined into texts of some thousand; a node's texts then go through a
    running hash in order. No list of ids is ever held.
    """
    by = ["chain", "pos"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chain, pos, ids = (batch.column(n).to_numpy() for n in (*by, "conv_id"))
            new = np.r_[True, (chain[1:] != chain[:-1]) | (pos[1:] != pos[:-1])]
            cuts = np.r_[np.flatnonzero(new), len(new)] if len(new) else np.zeros(1, np.int64)
            shown = ids.tolist()
            joined = [",".join(map(str, shown[a:b])) for a, b in zip(cuts[:-1], cuts[1:])]
            at = cuts[:-1]
            arrays = [chain[at], pos[at], ids[at], np.diff(cuts)]
            yield pa.record_batch([*map(pa.array, arrays), pa.array(joined, pa.string())], [*by, "id", "n", "ids"])

    laid = ends.repartitionByRange(*by, "conv_id").sortWithinPartitions(*by, "conv_id")
    texts = saved(
        laid.mapInArrow(join, "chain long, pos long, id long, n long, ids string"), "ends",
        {"spark.sql.execution.arrow.maxRecordsPerBatch": str(IDS)},
    )
    counted = saved(texts.groupBy(*by).agg(F.count("*").alias("texts")).where("texts > 1"), "long-ends")
    if not counted.take(1):
        return texts.select(*by, F.sha2("ids", 256).alias("ends_sha256"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running_hash, done = None, None, []
        for batch in batches:
            for chain, pos, ids in zip(*(batch.column(n).to_pylist() for n in (*by, "ids"))):
                if (chain, pos) == now:
                    running_hash.update(b"," + ids.encode())
                    continue
                if now:
                    done.append((*now, running_hash.hexdigest()))
                now, running_hash = (chain, pos), hashlib.sha256(ids.encode())
            if len(done) >= 512:
                yield pa.record_batch(list(map(pa.array, zip(*done))), [*by, "ends_sha256"])
                done = []
        if now:
            done.append((*now, running_hash.hexdigest()))
            yield pa.record_batch(list(map(pa.array, zip(*done))), [*by, "ends_sha256"])

    long = texts.join(counted.drop("texts"), by, "left_semi")
    long = long.repartition(*by).sortWithinPartitions(*by, "id").select(*by, "ids")
    long = long.mapInArrow(digest, "chain long, pos long, ends_sha256 string")
    short = texts.join(counted, by, "left_anti").select(*by, F.sha2("ids", 256).alias("ends_sha256"))
    return short.unionAll(long)


def prefix_trie(all_: DataFrame, turns: DataFrame, least_block: int = LEAST_BLOCK) -> DataFrame:
    """The nodes of the trie of ``all_`` (conv_id, length) and their ``turns`` (see TURN)."""
    rows = saved(paths(all_, turns), "paths")
    named = saved(
        rows.groupBy(*PREFIX).agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("least"), _chosen().alias("chain"),
            F.max("words").alias("words"), F.sum("weight").alias("weight"),
        ),
        "nodes",
    )
    total = named.where("pos = 0").agg(F.sum("weight")).first()[0]
    block = max(least_block, math.isqrt(total or 0))
    light = F.col("weight") <= block
    # Each prefix of each conversation with its node; written, so that a node of all of them can be split.
    on = saved(
        rows.select("conv_id", *PREFIX, (F.col("weight") == 1).alias("end")).join(
            named.select(*PREFIX, "chain", "weight"), PREFIX
        ).select("conv_id", "pos", "end", "chain", "weight"),
        "prefix-nodes",
    )
    mine = F.col("chain") == F.col("conv_id")
    chains = saved(
        on.groupBy(F.col("conv_id").alias("chain")).agg(
            F.min(F.when(mine, F.col("pos"))).alias("begin"),
            F.max(F.when(mine, F.col("pos"))).alias("stop"),
            F.max_by("chain", F.when(~mine, F.col("pos"))).alias("up"),
            F.min_by("chain", F.when(light, F.col("pos"))).alias("top_chain"),
            F.min(F.when(light, F.col("pos"))).alias("top_pos"),
        ).where("begin is not null"),
        "chains",
    )
    # Children of a node: the next of its chain, and the chains that begin below it.
    hung = chains.where("up is not null").groupBy(
        F.col("up").alias("chain"), (F.col("begin") - 1).alias("pos")
    ).agg(F.count("*").alias("hung"))
    goes_on = (F.col("pos") < F.col("stop")).cast("long")
    first = F.col("pos") == F.col("begin")
    nodes = named.drop(*LANES).join(chains, "chain").join(hung, ["chain", "pos"], "left")
    nodes = nodes.withColumn("n_children", goes_on + F.coalesce("hung", F.lit(0)))
    nodes = saved(
        nodes.select(
            "chain", "pos", "n_convs", "least", "weight", "begin", "top_chain", "top_pos", "n_children",
            F.when(first, F.col("up")).otherwise(F.col("chain")).alias("up_chain"),
            F.when(F.col("pos") > 0, F.col("pos") - 1).alias("up_pos"),
            (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        ),
        "trie",
    )
    sums = rollup(nodes, block)
    hashes = ends_hashes(on.where("end").select("chain", "pos", "conv_id"))
    above = nodes.select(
        F.col("chain").alias("up_chain"), F.col("pos").alias("up_pos"), F.col("least").alias("parent_conv_id")
    )
    none = hashlib.sha256(b"").hexdigest()
    return (
        nodes.drop(*VALUES)
        .join(sums, ["chain", "pos"])
        .join(hashes, ["chain", "pos"], "left")
        .join(above, ["up_chain", "up_pos"], "left")
        .select(
            F.col("least").alias("conv_id"), F.col("pos").alias("depth"), "parent_conv_id", "n_convs",
            "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )


def conversation_trie(
    conversations: DataFrame,
    rebuild: bool = False,
    every: int = 20,
    most: int = 4,
    least_block: int = LEAST_BLOCK,
) -> DataFrame:
    """One row per distinct sequence of first turns (role, text): a node of the trie, the empty one too.

    conv_id (the smallest member) and depth name a node, parent_conv_id its parent (NULL: root). n_convs
    counts members, n_children and n_leaves the nodes below, saved_tokens the words that need not be
    repeated in the subtree; ends_sha256 is of the ids that end at the node. With ``rebuild`` conversations
    first share heads, see ``rebuilt``.

    A NULL role or text is empty, a NULL turn comes first; turns of one number are ordered by role and text,
    and repeated rows are turns each. Rows with a NULL conv_id belong to no conversation. A text of any length
    counts by its hashes; turns with two equal hashes of 64 bits are held to be equal. Other columns play
    no part; an empty table gives no rows.
    """
    ship(conversations.sparkSession)
    turns = numbered(conversations)
    all_, turns = rebuilt(turns, every, most) if rebuild else whole(turns)
    return prefix_trie(all_, turns, least_block)
