"""Prefix trie of conversations by burst tries.

Every conversation is a sequence of turns, each known by a digest of its role
and text. Conversations are cut into segments of a bounded number of turns; a
segment is filed under the digest of all turns before it. At first all segments
with the same past are one suffix container under one trie head. Containers
with too many turns burst by the next turn id (past all turns that the whole
container agrees on), until each is small; equal suffixes are one suffix with a
count, so copies never keep a container large. The remaining containers are
sorted and swept into nodes, and the heads that bursting left behind become
nodes from the sums of the containers below them.

Sums over subtrees that reach past a segment travel by conversation: the root
of each later segment's subtree is credited to its smallest member, and that
member's earlier segments carry the sum. So nothing grows with the length of a
conversation or the depth of the trie but tables. Rows are ordered inside
conversations along a range partitioning, so that one conversation with a third
of all turns is spread over tasks.

Edge cases: turns of equal number come in order of the digest of role and text;
a null turn number comes first; null roles and texts count as empty; rows
without a conv_id belong to no conversation; repeated rows are turns of their
own; an empty table has no nodes, not even the root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadspark.session import cut, scratch_path

#: Turns of a segment.
SEGMENT = 256
#: A container with more turns bursts.
CONTAINER = 50_000
#: Conversations are rebuilt from the first turns of the conversation whose id is the next lower multiple of this.
STRIDE = 100
#: At most this many turns less one come from there.
MOST_SHARED = 6
#: Ids of one node that are joined to one piece of text before the pieces are hashed in order.
IDS_A_PIECE = 4_096

_SUFFIX = "array<struct<id:string,chars:int>>"


def _digest(text: Column) -> Column:
    """22 characters for 128 bits."""
    return F.substring(F.base64(F.unhex(F.md5(text))), 1, 22)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, id, chars of each row that has a conv_id; texts end here."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    body = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)  # the length keeps role and text apart
    return conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _digest(body).alias("id"), F.length(text).alias("chars"))


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in the conversation, in parts: conv_id, part, at (place in the part), id, chars; and
    per conversation and part the rows before the part and of the whole conversation: conv_id, part, before, n_turns."""
    spark = rows.sparkSession
    path = scratch_path(spark, "turns")
    rows.repartitionByRange("conv_id", "turn", "id").withColumn("part", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "id")
    parts = stored.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    own = Window.partitionBy("conv_id")
    parts = parts.select("conv_id", "part", (F.sum("n").over(own.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(own).alias("n_turns"))
    return stored.withColumn("at", F.row_number().over(inside) - 1).drop("turn"), parts


def rebuilt(conversations: DataFrame, stride: int = STRIDE, most_shared: int = MOST_SHARED) -> DataFrame:
    """Turns of all rebuilt conversations and, behind the last, a row without id: conv_id, pos, id, chars."""
    rows, parts = placed(turns(conversations))
    base = F.col("conv_id") - F.col("conv_id") % stride
    heads = (
        rows.filter((F.col("conv_id") % stride == 0) & (F.col("at") < most_shared - 1))
        .join(parts, ["conv_id", "part"])
        .withColumn("pos", F.col("before") + F.col("at"))
        .filter(F.col("pos") < most_shared - 1)
        .groupBy("conv_id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id", "chars"))), lambda x: F.struct(x["id"].alias("id"), x["chars"].alias("chars"))).alias("head"))
        .withColumnRenamed("conv_id", "base")
    )
    own = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared
    info = parts.withColumn("base", base).withColumn("own", own).join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast(_SUFFIX)), F.lit(1), F.col("own").cast("int"))).withColumn("shift", F.size("head") - F.col("own"))
    info = cut(info.select("conv_id", "part", "before", "n_turns", "own", "head", "shift"))
    pos = F.col("before") + F.col("at")
    kept = rows.join(info.drop("head"), ["conv_id", "part"]).filter(pos >= F.col("own")).select("conv_id", (pos + F.col("shift")).alias("pos"), "id", "chars")
    once = info.filter(F.col("before") == 0)
    first = once.select("conv_id", F.posexplode("head").alias("pos", "t")).select("conv_id", F.col("pos").cast("long").alias("pos"), "t.id", "t.chars")
    last = once.select("conv_id", (F.greatest(F.col("n_turns") - F.col("own"), F.lit(0)) + F.size("head")).alias("pos"), F.lit(None).cast("string").alias("id"), F.lit(0).alias("chars"))
    return kept.unionByName(first).unionByName(last)


def _text(suffix: str | Column) -> Column:
    return F.array_join(F.transform(suffix, lambda x: x["id"]), "")


def _node(path: Column) -> Column:
    """Names the node that a path leads to from the past of its segment."""
    return _digest(F.concat_ws("/", "k", "past", _text(path)))


def segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """One row for each segment of a conversation: conv_id, k, past (digest of what comes before), suffix, ended, last_chars
    (of the turn before the segment), tail (names the node one turn before the segment's end, if it reaches so far) and up
    (the tail of the segment before). Stored."""
    spark = rows.sparkSession
    path = scratch_path(spark, "segments")
    segs = rows.groupBy("conv_id", F.floor(F.col("pos") / size).alias("k")).agg(F.array_sort(F.collect_list(F.struct("pos", "id", "chars"))).alias("t"))
    real = F.filter("t", lambda x: x["id"].isNotNull())
    segs.select("conv_id", "k", F.transform(real, lambda x: F.struct(x["id"].alias("id"), x["chars"].alias("chars"))).alias("suffix"), F.element_at("t", -1)["id"].isNull().alias("ended")).write.parquet(path)
    segs = spark.read.parquet(path)
    body = _digest(_text(F.slice("suffix", 1, size - 1)))
    tail = F.when(F.size("suffix") >= size - 1, _digest(F.concat_ws("/", "k", "past", body)))
    more = segs.filter("k > 0").select("conv_id").distinct()
    if more.isEmpty():
        return segs.withColumn("past", F.lit("0.0")).withColumn("last_chars", F.lit(0)).withColumn("tail", tail).withColumn("up", F.lit(None).cast("string"))
    one, two = F.xxhash64("k", _text("suffix")), F.xxhash64(_text("suffix"), "k")
    lean = segs.join(more, "conv_id", "left_semi").select("conv_id", "k", one.alias("one"), two.alias("two"), F.try_element_at("suffix", F.lit(-1))["chars"].alias("last"), body.alias("body"))
    step = Window.partitionBy("conv_id").orderBy("k")
    before = step.rowsBetween(Window.unboundedPreceding, -1)
    # each segment's hashes hold its number, so that their exclusive or tells the order as well
    past = F.concat_ws(".", *(F.coalesce(F.bit_xor(c).over(before), F.lit(0)) for c in ("one", "two")))
    lean = lean.withColumn("past", past).withColumn("last_chars", F.lag("last").over(step)).withColumn("up", F.lag(F.col("past")).over(step)).withColumn("up_body", F.lag("body").over(step))
    lean = cut(lean.select("conv_id", "k", "past", "last_chars", F.when(F.col("k") > 0, _digest(F.concat_ws("/", F.col("k") - 1, "up", "up_body"))).alias("up")))
    out = segs.join(lean, ["conv_id", "k"], "left").withColumn("past", F.coalesce("past", F.lit("0.0"))).withColumn("last_chars", F.coalesce("last_chars", F.lit(0)))
    path = scratch_path(spark, "segments")
    out.withColumn("tail", tail).write.parquet(path)
    return spark.read.parquet(path)


def merged(segs: DataFrame) -> DataFrame:
    """Equal segments with the same past become one suffix: n conversations, ``first`` the smallest, and the sums that they carry."""
    own = segs.groupBy("k", "past", "suffix", "ended").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"), F.sum("below_leaves").alias("below_leaves"), F.sum("below_saved").alias("below_saved"), F.max("last_chars").alias("last_chars"), F.max("up").alias("up")
    )
    return own.withColumn("depth", F.lit(0))


def burst(suffixes: DataFrame, container: int = CONTAINER) -> DataFrame:
    """Suffixes with ``depth``, the number of turns that are trie heads above their container, so that no container
    of more than one suffix has more than ``container`` turns left, as far as there are turns to burst by."""
    done: list[DataFrame] = []
    work = suffixes
    while True:
        work = cut(work.withColumn("name", _node(F.slice("suffix", F.lit(1), F.col("depth")))))
        rest = F.slice("suffix", F.col("depth") + 1, F.greatest(F.size("suffix") - F.col("depth"), F.lit(0)))
        sizes = work.groupBy("name").agg(F.count("*").alias("c"), F.sum(F.size("suffix") - F.col("depth")).alias("left"))
        big = sizes.filter((F.col("c") > 1) & (F.col("left") > container)).select("name")
        if big.isEmpty():
            done.append(work)
            break
        done.append(work.join(big, "name", "left_anti"))
        hot = work.join(big, "name").withColumn("rest", rest)
        ends = hot.groupBy("name").agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
        apart = F.array_position(F.zip_with("low", "high", lambda x, y: F.coalesce(x == y, F.lit(False))), False)
        # array_position is 0 where low is high: then nothing is left to tell the suffixes apart but where they end
        steps = ends.select("name", F.when(apart > 0, apart).otherwise(F.size("low") + 1).cast("int").alias("step"))
        work = hot.join(steps, "name").withColumn("depth", F.least(F.col("depth") + F.col("step"), F.size("suffix"))).drop("rest", "step", "name")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ender long, name string, root boolean"


def _swept(container: list[dict]) -> Iterator[list]:
    """Nodes of one container, its root first; suffixes come sorted and are read from ``depth`` on."""
    head = container[0]
    base = head["depth"]
    nodes = [[head["first"], base, None, 0, 0, 0, 0, None, 0, None]]  # as in _NODE to ender, then chars, parent
    stack, last = [0], []

    def close() -> None:
        own = nodes[stack.pop()]
        own[5] = own[5] or int(not own[4])
        own[6] += (own[3] - 1) * own[8]
        if stack:
            up = nodes[stack[-1]]
            up[5] += own[5]
            up[6] += own[6]

    for s in container:
        ids = s["suffix"][base:]
        inner = ids if s["ended"] else ids[:-1]  # the last turn of a segment that goes on is the next one's root
        same = 0
        while same < min(len(stack) - 1, len(inner)) and last[same] == inner[same]["id"]:
            same += 1
        while len(stack) - 1 > same:
            close()
        for x in inner[same:]:
            nodes[stack[-1]][4] += 1
            nodes.append([s["first"], base + len(stack), None, 0, 0, 0, 0, None, x["chars"], stack[-1]])
            stack.append(len(nodes) - 1)
        last = [x["id"] for x in inner]
        for i in stack:
            nodes[i][3] += s["n"]
            nodes[i][0] = min(nodes[i][0], s["first"])
        end = nodes[stack[-1]]
        if s["ended"]:
            end[7] = s["first"]
        else:
            end[4] += bool(ids)
            end[5] += s["below_leaves"]
            end[6] += s["below_saved"]
    while len(stack) > 1:
        close()
    for own in nodes:
        if own[9] is not None:
            own[2] = nodes[own[9]][0]
    yield from nodes


def sweep(suffixes: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Nodes of all containers (``root`` false) and one row for the root of each container (``root`` true, its sums without itself)."""
    columns = ["k", "depth", "suffix", "ended", "n", "first", "below_leaves", "below_saved", "name"]
    ordered = suffixes.select(*columns).repartition("name").sortWithinPartitions("name", "suffix", F.desc("ended"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[list] = []

        def finish() -> None:
            base = held[0]["k"] * size
            for i, own in enumerate(_swept(held)):
                out.append([own[0], base + own[1], *own[2:8], held[0]["name"], i == 0])

        def batch_of(rows: list[list]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 8 + [pa.string(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in _NODE.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                for s in batch.slice(at, 1_000).to_pylist():
                    if held and held[0]["name"] != s["name"]:
                        finish()
                        held.clear()
                    held.append(s)
                if len(out) >= 10_000:
                    yield batch_of(out)
                    out.clear()
        if held:
            finish()
        if out:
            yield batch_of(out)

    return ordered.mapInArrow(run, _NODE)


def heads(suffixes: DataFrame, swept: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Nodes of the trie heads: the roots of containers and all turns above them in their segment."""
    roots = swept.filter("root").select("name", F.col("n_convs").alias("n"), F.col("conv_id").alias("first"), F.col("n_children").alias("inner"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), "ender")
    paths = suffixes.groupBy("name", "k", "past", "depth").agg(F.min(F.slice("suffix", F.lit(1), F.col("depth"))).alias("path"), F.max("last_chars").alias("last_chars"), F.max("up").alias("up"))
    below = paths.join(roots, "name")
    level = below.withColumn("d", F.explode(F.sequence(F.lit(0), F.least(F.col("depth"), F.lit(size - 1)))))
    own = F.slice("path", F.lit(1), F.col("d"))
    at_root = F.col("d") == F.col("depth")
    level = level.select(
        "k", "d", _node(own).alias("node"), F.when(F.col("d") > 0, _node(F.slice("path", F.lit(1), F.greatest(F.col("d") - 1, F.lit(0))))).alias("parent"),
        F.when(F.col("d") > 0, F.try_element_at("path", F.greatest(F.col("d"), F.lit(1)))["chars"]).otherwise(F.col("last_chars")).alias("chars"),
        F.when(at_root, F.lit(None)).otherwise(F.try_element_at("path", F.col("d") + 1)["id"]).alias("next"),
        "n", "first", F.when(at_root, F.col("inner")).otherwise(0).alias("inner"), "leaves", "saved", F.when(at_root, F.col("ender")).alias("ender"), "up",
    )
    # children first by (node, next turn), so that a head with many containers is summed before its key is met
    part = level.groupBy("k", "d", "node", "parent", "chars", "next").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("inner").alias("inner"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ender").alias("ender"), F.max("up").alias("up")
    )
    nodes = part.groupBy("k", "d", "node", "parent", "chars").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), (F.sum("inner") + F.count("next")).alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ender").alias("ender"), F.max("up").alias("up")
    )
    nodes = cut(nodes.withColumn("own", (F.col("n") - 1) * F.col("chars")).withColumn("leaf", (F.col("n_children") == 0).cast("long")))
    # what a head saves itself, and whether it is a leaf, counts for all heads above it in its segment
    names = below.withColumn("d", F.explode(F.sequence(F.lit(0), F.least(F.col("depth"), F.lit(size - 1))))).select(_node(own).alias("node"), F.explode(F.transform(F.sequence(F.lit(0), F.col("d")), lambda d: _node(F.slice("path", F.lit(1), d)))).alias("above")).distinct()
    sums = names.join(nodes.select("node", "own", "leaf"), "node").groupBy(F.col("above").alias("node")).agg(F.sum("own").alias("heads_saved"), F.sum("leaf").alias("heads_leaves"))
    ups = nodes.select(F.col("node").alias("parent"), F.col("first").alias("parent_conv_id"))
    return (
        nodes.join(sums, "node")
        .join(ups, "parent", "left")
        .select(
            F.col("first").alias("conv_id"), (F.col("k") * size + F.col("d")).alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), "n_children", (F.col("leaves") + F.col("heads_leaves")).alias("n_leaves"),
            (F.col("saved") + F.col("heads_saved")).alias("saved_tokens"), "ender", "up",
        )
    )


def parents(segs: DataFrame) -> DataFrame:
    """up, parent_conv_id: smallest member of each node that stands one turn before the end of a segment."""
    return segs.filter(F.col("tail").isNotNull()).groupBy(F.col("tail").alias("up")).agg(F.min("conv_id").alias("across"))


def _nodes(segs: DataFrame, size: int, container: int) -> DataFrame:
    suffixes = cut(burst(merged(segs), container))
    swept = cut(sweep(suffixes, size))
    return swept.filter(~F.col("root")).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ender", F.lit(None).cast("string").alias("up")).unionByName(heads(suffixes, swept, size))


def ends(segs: DataFrame) -> DataFrame:
    """ender, ends_sha256: of all conversations that end with the same turns, the smallest id and the digest of their ids."""
    pieces = (
        segs.filter("ended")
        .select(_node(F.col("suffix")).alias("mark"), "conv_id", F.floor(F.col("conv_id") / IDS_A_PIECE).alias("piece"))
        .groupBy("mark", "piece")
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("mark", F.element_at("ids", 1).alias("first"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, first, digest = None, None, hashlib.sha256()
        out: list[tuple[int, str]] = []
        for batch in batches:
            for m, f, t in zip(*(batch.column(c).to_pylist() for c in ("mark", "first", "text"))):
                if m == mark:
                    digest.update(b",")
                else:
                    if mark is not None:
                        out.append((first, digest.hexdigest()))
                    mark, first, digest = m, f, hashlib.sha256()
                digest.update(t.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["ender", "ends_sha256"])
                out = []
        if mark is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([digest.hexdigest()])], names=["ender", "ends_sha256"])

    return pieces.repartition("mark").sortWithinPartitions("mark", "first").mapInArrow(run, "ender long, ends_sha256 string")


def trie(conversations: DataFrame, size: int = SEGMENT, container: int = CONTAINER, stride: int = STRIDE, most_shared: int = MOST_SHARED) -> DataFrame:
    """One row for each node of the prefix trie of the rebuilt conversations, as the columns say."""
    segs = segments(rebuilt(conversations, stride, most_shared), size)
    none = F.lit(0).cast("long")
    flat = segs.withColumn("below_leaves", none).withColumn("below_saved", none)
    later = flat.filter("k > 0")
    if not later.isEmpty():
        roots = _nodes(later, size, container).filter(F.col("depth") % size == 0)
        deeper = Window.partitionBy("conv_id").orderBy(F.desc("k"))
        roots = roots.select("conv_id", (F.col("depth") / size).cast("long").alias("k"), "n_leaves", "saved_tokens")
        credit = roots.select("conv_id", (F.col("k") - 1).alias("k"), F.sum("n_leaves").over(deeper).alias("leaves"), F.sum("saved_tokens").over(deeper).alias("saved"))
        # the sum from a root on counts for all segments of its member that no later sum of the member covers
        many = segs.filter("k > 0").select("conv_id").distinct()
        known = segs.join(many, "conv_id", "left_semi").select("conv_id", "k").join(credit, ["conv_id", "k"], "left")
        filled = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.currentRow, Window.unboundedFollowing)
        sums = known.select("conv_id", "k", F.first("leaves", ignorenulls=True).over(filled).alias("leaves"), F.first("saved", ignorenulls=True).over(filled).alias("saved"))
        flat = segs.join(cut(sums), ["conv_id", "k"], "left").withColumn("below_leaves", F.coalesce("leaves", none)).withColumn("below_saved", F.coalesce("saved", none)).drop("leaves", "saved")
    nodes = _nodes(flat, size, container)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(parents(segs), "up", "left")
        .join(ends(segs), "ender", "left")
        .select("conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "across")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256"))
    )
