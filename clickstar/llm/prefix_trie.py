"""Prefix trie of conversations, built as burst tries.

A turn's id is the 128-bit hash of its role and text, and a conversation is the string of
its turns' ids. Equal conversations are one record with the number of its members, their
smallest id and the hash of their ids. The records are suffixes in one container under the
root; a container that holds more than ``limit`` turns bursts: the ids that all its suffixes
begin with become a head, one path of trie nodes, and every suffix moves on to the container
of its next turn id. Heads are found for all oversized containers of a round at once, and a
burst always parts a container, so rounds follow the branchings above large containers, not
the length of conversations. The containers that are left are dealt over the cluster, sorted,
and swept once: a stack of open nodes follows the common prefix of neighbours and emits a node
when the sweep leaves it. Sums of subtrees then climb from the last round's heads to the root.

The sweep reads sorted rows and keeps one path and the children of its nodes, at most the turns of
one container. Members' ids are formatted in blocks of 2^16 neighbouring ids before the one hash over all of
them is taken, so a group of copies that holds a third of all conversations arrives at its task
as ready pieces of text, one for each block; that hash itself is a sequence and is not cut further.

Defined cases: turns are ordered by turn (null first), ties by role, then turn id; null role or
text is empty; a repeated row is a turn of its own; rows without conv_id belong to no
conversation and are left out; a conversation without turns ends at the root; no conversation
gives no node, not even a root; other columns are not read. A conversation is held as one row of
20 bytes for each turn, whatever the length of its texts.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstar.llm.tables import Scratch

ID_BYTES = 16
BLOCK_BITS = 16
LIMIT = 1 << 16
EMPTY_HASH = hashlib.sha256(b"").hexdigest()

RECORD = pa.schema([("ids", pa.binary()), ("chars", pa.list_(pa.int32())), ("n", pa.int64()),
                    ("least", pa.int64()), ("ends", pa.string())])
SUFFIX = ["level", "above", "container", "skip", "ids", "chars", "n", "least", "ends"]
NODE = pa.schema([("level", pa.int32()), ("above", pa.string()), ("top", pa.bool_()),
                  ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                  ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                  ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())])


def ddl(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.binary(): "binary", pa.int64(): "bigint", pa.string(): "string",
             pa.bool_(): "boolean", pa.list_(pa.int32()): "array<int>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, id, chars) with ``pos`` from 0 in the order of the turns; texts stay behind."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "id")
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return (turns.where("conv_id IS NOT NULL")
            .select("conv_id", "turn", role.alias("role"), F.unhex(F.md5(named)).alias("id"),
                    F.length(text).alias("chars"))
            .select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "id",
                    "chars"))


def as_records(positions: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, ids, chars): each conversation as one string of turn ids, even without turns."""
    rows = positions.select("conv_id", F.struct("pos", "id", "chars").alias("t")).unionByName(
        conversations.select("conv_id", F.lit(None).cast(
            "struct<pos:bigint,id:binary,chars:int>").alias("t")))
    ordered = F.array_sort("turns")
    return rows.groupBy("conv_id").agg(F.collect_list("t").alias("turns")).select(
        "conv_id", F.unhex(F.array_join(F.transform(ordered, lambda t: F.hex(t.id)), "")).alias("ids"),
        F.transform(ordered, lambda t: t.chars).alias("chars"))


def rebuilt(turns: DataFrame, share: int = 100, most: int = 6) -> DataFrame:
    """Conversation c with its first turns from c - c % share, crc32(c) % most of them.

    The turns copied are fewer than ``most`` a conversation. They come from a table of the first
    turns only, keyed by conversation and place, so a hot conversation lends a few rows.
    """
    numbered = numbered_turns(turns)
    conversations = turns.where("conv_id IS NOT NULL").select("conv_id").distinct()
    head = F.crc32(F.col("conv_id").cast("string")) % most
    asked = conversations.select("conv_id", (F.col("conv_id") - F.col("conv_id") % share).alias("base"),
                                 F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most - 2).cast("long"))).alias("pos")
                                 ).where(F.col("pos") < head)
    lent = numbered.where(F.col("pos") < most - 1).select(
        F.col("conv_id").alias("base"), "pos", "id", "chars")
    copied = asked.join(lent, ["base", "pos"]).select("conv_id", "pos", "id", "chars")
    own = numbered.where(F.col("pos") >= head)
    return as_records(copied.unionByName(own), conversations)


def merge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record for each run of equal keys; hashes the blocks' texts as they pass."""
    key, digest, row, out = None, None, None, []

    def done():
        if key is not None:
            out.append((*row, digest.hexdigest()))

    def table():
        rows = [[r[i] for r in out] for i in range(5)]
        out.clear()
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, RECORD)], schema=RECORD)

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("seq", "said", "n", "least", "ids", "chars")]
        for seq, said, n, least, ids, chars in zip(*columns):
            if seq != key:
                done()
                key, digest, row = seq, hashlib.sha256(said.encode()), [ids, chars, n, least]
            else:
                digest.update(b"," + said.encode())
                row[2] += n
                row[3] = min(row[3], least)
        if len(out) >= 4096:
            yield table()
    done()
    yield table()


def distinct_records(convs: DataFrame) -> DataFrame:
    """Equal conversations as one record (ids, chars, n, least, ends)."""
    blocks = convs.groupBy(F.md5("ids").alias("seq"),
                           F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("members"), F.first("ids").alias("ids"),
        F.first("chars").alias("chars"))
    texts = blocks.select(
        "seq", "block", F.array_join(F.transform("members", lambda c: c.cast("string")), ",").alias("said"),
        F.size("members").cast("long").alias("n"), F.col("members")[0].alias("least"), "ids", "chars")
    return texts.repartition("seq").sortWithinPartitions("seq", "block").mapInArrow(
        merge_blocks, ddl(RECORD))


def common(low: bytes, high: bytes) -> int:
    """Turns that all strings between ``low`` and ``high`` begin with."""
    return len(os.path.commonprefix([low, high])) // ID_BYTES


HEAD = pa.schema([("container", pa.string()), ("above", pa.string()), ("skip", pa.int64()),
                  ("upto", pa.int64()), ("n", pa.int64()), ("least", pa.int64()),
                  ("chars", pa.list_(pa.int32()))])


def head_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path that a bursting container's suffixes share, from its smallest and largest."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            r["upto"] = common(r["low"]["ids"], r["high"])
            texts = [0, *r["low"]["chars"]]  # the root's text is empty
            r["chars"] = texts[r["skip"]:r["upto"] + 1]
        yield pa.RecordBatch.from_pylist([{f.name: r[f.name] for f in HEAD} for r in rows], HEAD)


class Sweep:
    """Nodes of sorted containers.

    An open node is [depth, conv_id, n_convs, n_children, n_leaves, saved, chars, ends, kids]; its
    smallest member is known when it closes, so its children wait for it until then.
    """

    def __init__(self) -> None:
        self.container, self.above, self.level, self.last = None, None, 0, b""
        self.open: list[list] = []
        self.out: list[list] = []

    def close(self, depth: int) -> None:
        """Emits what hangs under the open nodes deeper than ``depth``."""
        while self.open and self.open[-1][0] > depth:
            at, least, n, children, leaves, saved, chars, ends, kids = self.open.pop()
            for kid in kids:
                kid[5] = least
            self.out += kids
            node = [self.level, self.above, not self.open, least, at, None, n, children,
                    leaves or 1, saved + (n - 1) * chars, ends]
            if not self.open:
                self.out.append(node)
                continue
            up = self.open[-1]
            up[1], up[2], up[3] = min(up[1], least), up[2] + n, up[3] + 1
            up[4], up[5] = up[4] + node[8], up[5] + node[9]
            up[8].append(node)

    def add(self, level, above, container, skip, ids, chars, n, least, ends) -> None:
        if container != self.container:
            self.close(-1)
            self.container, self.above, self.level = container, above, level
            shared = skip - 1
        else:
            shared = common(self.last, ids)
            self.close(shared)
        for depth in range(shared + 1, len(ids) // ID_BYTES + 1):
            self.open.append([depth, least, 0, 0, 0, 0, chars[depth - 1] if depth else 0,
                              EMPTY_HASH, []])
        end = self.open[-1]
        end[1], end[2], end[7] = min(end[1], least), end[2] + n, ends
        self.last = ids

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(NODE)],
                               schema=NODE)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sweeper = Sweep()
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in SUFFIX)):
            sweeper.add(*row)
            if len(sweeper.out) >= 10_000:
                yield sweeper.taken()
    sweeper.close(-1)
    yield sweeper.taken()


def prefix_key(turns: Column) -> Column:
    """The key of the container under the first ``turns`` turns."""
    return F.md5(F.substring("ids", F.lit(1), (turns * ID_BYTES).cast("int")))


def burst(level: DataFrame, large: DataFrame, scratch: Scratch, at: int
          ) -> tuple[DataFrame, DataFrame]:
    """The heads of the ``large`` containers, and their suffixes in containers one level down."""
    bursting = level.join(large, "container")
    shared = bursting.groupBy("container", "above", "skip").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"),
        F.min(F.struct("ids", "chars")).alias("low"), F.max("ids").alias("high"))
    paths = scratch.keep(shared.mapInArrow(head_paths, ddl(HEAD)), f"paths-{at}")
    moved = bursting.join(paths.select("container", "upto"), "container")
    length = F.octet_length("ids") / ID_BYTES
    # suffixes differ, so at most one ends with the path
    ends = moved.where(length == F.col("upto")).select("container", "ends")
    heads = scratch.keep(paths.join(ends, "container", "left"), f"heads-{at}")
    below = moved.where(length > F.col("upto")).select(
        F.lit(at + 1).alias("level"), F.col("container").alias("above"),
        prefix_key(F.col("upto") + 1).alias("container"), (F.col("upto") + 1).alias("skip"),
        "ids", "chars", "n", "least", "ends")
    return heads, scratch.keep(below, f"suffixes-{at + 1}")


def trie(convs: DataFrame, scratch: Scratch, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie over ``convs`` (conv_id, ids, chars)."""
    level = scratch.keep(distinct_records(convs).select(
        F.lit(0).alias("level"), F.lit(None).cast("string").alias("above"),
        F.lit("").alias("container"), F.lit(0).cast("long").alias("skip"), "ids", "chars", "n",
        "least", "ends"), "suffixes-0")
    containers, heads = None, []
    while True:
        turns = (F.octet_length("ids") / ID_BYTES).cast("long") - F.col("skip") + 1
        large = scratch.keep(level.groupBy("container").agg(
            F.sum(turns).alias("turns"), F.count(F.lit(1)).alias("suffixes"))
            .where((F.col("turns") > limit) & (F.col("suffixes") > 1)).select("container"),
            f"large-{len(heads)}")
        bursts = not large.isEmpty()
        small = level.join(large, "container", "left_anti") if bursts else level
        containers = small if containers is None else containers.unionByName(small)
        if not bursts:
            break
        found, level = burst(level, large, scratch, len(heads))
        heads.append(found)
    swept = scratch.keep(
        containers.select(SUFFIX).repartition("container").sortWithinPartitions("container", "ids")
        .mapInArrow(sweep, ddl(NODE)), "swept")
    tops = swept.where("top AND above IS NOT NULL")
    nodes, hanging = swept.where("NOT top OR above IS NULL"), None
    for at in reversed(range(len(heads))):
        below = tops.where(F.col("level") == at + 1)
        below = below if hanging is None else below.unionByName(hanging)
        done, paths = hang(heads[at], below, scratch, at)
        nodes = nodes.unionByName(done).unionByName(paths.where("NOT top OR above IS NULL"))
        hanging = paths.where("top AND above IS NOT NULL")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        "saved_tokens", "ends_sha256")


def hang(heads: DataFrame, below: DataFrame, scratch: Scratch, at: int
         ) -> tuple[DataFrame, DataFrame]:
    """The nodes right below a round's heads, with their parents, and the nodes of the heads' paths.

    A head gets the sums of all that hangs under it; each node of its path adds its own text.
    """
    sums = below.groupBy(F.col("above").alias("container")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved"))
    full = scratch.keep(heads.join(sums, "container"), f"summed-{at}")
    done = below.join(full.select(F.col("container").alias("above"), F.col("least")), "above") \
        .withColumn("parent_conv_id", F.col("least")).select([f.name for f in NODE])
    path = full.select("*", F.posexplode("chars").alias("pos", "own"))
    paid = F.aggregate(F.slice("chars", F.col("pos") + 1, F.size("chars") - F.col("pos")),
                       F.lit(0).cast("long"), lambda total, c: total + c)
    last, first = F.col("pos") == F.size("chars") - 1, F.col("pos") == 0
    return done, path.select(
        F.lit(at).alias("level"), "above", first.alias("top"), F.col("least").alias("conv_id"),
        (F.col("skip") + F.col("pos")).alias("depth"),
        F.when(~first, F.col("least")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n") - 1) * paid).alias("saved_tokens"),
        F.when(last, F.coalesce("ends", F.lit(EMPTY_HASH))).otherwise(EMPTY_HASH).alias("ends_sha256"))
