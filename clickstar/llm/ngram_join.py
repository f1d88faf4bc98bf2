"""Exact Jaccard join of documents by word n-grams, with filters under several token orders.

Two sets whose Jaccard similarity reaches the threshold share a token in their prefixes,
the first ``n - ceil(threshold * n) + 1`` tokens of each, under whatever total order all
sets are sorted by. Three orders are used: rare tokens first, hash ascending and hash
descending. The first one makes candidates by an equality join on its prefix tokens; a
candidate must then share a prefix token in both other orders too; what is left is
verified on the whole sets.

"Rare first" needs no exact counts, as any total order is right: counts are kept per
bucket of hashes over all documents, 2^18 of them at any corpus size. They tell apart the
tokens of passages that many documents share, which would make long lists of candidates.

Steps: (1) one pass over the texts gives each document its set's class (a 64-bit hash) and
size, and the counts; equal sets are one node from here on. (2) A second pass emits prefix
tokens; those of a single class go, the rest are the lists. A candidate pair first compares the
shapes of its sets, 128 counts or one for 16 tokens, which bound their difference from below; whole sets are
made again from the texts for the classes that are left, which a bit filter of fixed size picks
before anything is shuffled, and meet for the prefixes of the other two orders and, if those
share a token each, for the overlap itself.
(3) Each list pairs its members with the one whose prefix is shared most, the text that others
were made from; verified links are joined to components, and lists that still hold several
do so once more. Groups of near copies thus cost one pair per member. (4) Lists that still
hold several components emit their pairs across components, so no link is lost; a pair must
be able to reach the threshold from the places of its token. (5) Components get their
smallest doc_id.

Nothing but the counts (2^18), the bits of filters (2^26 each) and totals reaches the driver.

Defined cases: texts that are null or without words have an empty set, link with nothing
and are their own component; a shorter text is one shingle of all its words; rows that
repeat a doc_id are documents of their own; a null doc_id never becomes a component's id
unless the component has no other; an empty table gives an empty result. Other columns are
not read. Two different sets of one class hash would be taken as equal (odds 2^-64 a pair).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstar.llm.graph import components
from clickstar.llm.tables import Scratch
from clickstar.llm.text_hash import set_class, shingle_sets, small

BUCKETS = 1 << 18
SHAPE_PARTS = 128
FILTER_BITS = 1 << 26
# Classes that a task remembers as done; forgetting one only repeats rows.
REMEMBERED = 200_000


def prefix_length(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1


def partner_possible(n: int, percent: int) -> bool:
    """Whether a set of n can link with a different one."""
    return 100 * n >= percent * (n + 1)


def bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(46)).astype(np.int64)


def shape(tokens: np.ndarray) -> bytes:
    """How many tokens of a set lie in each of SHAPE_PARTS parts of the hashes, up to 255.

    Large sets have more parts, a power of two times as many, with 16 tokens each at most on average:
    in fewer parts the counts of any two of them are close by chance.
    """
    parts = max(SHAPE_PARTS, 1 << (-(-len(tokens) // 16) - 1).bit_length())
    counts = np.bincount((tokens & np.uint64(parts - 1)).astype(np.int64), minlength=parts)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def folded(shapes: list[bytes], parts: int) -> np.ndarray:
    """The counts that shapes of at least ``parts`` parts have in ``parts``, a row each."""
    lengths = np.fromiter(map(len, shapes), np.int64, len(shapes))
    out = np.empty((len(shapes), parts), np.int16)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        counts = np.frombuffer(b"".join([shapes[i] for i in at]), np.uint8)
        out[at] = np.minimum(counts.reshape(len(at), -1, parts).sum(axis=1, dtype=np.int64), 255)
    return out


def alike(percent: int):
    """The pairs (a, b, n_a, shape_a, n_b, shape_b) whose shapes leave a link possible, as (a, b).

    Each token that only one of two sets has changes one count by 1, so the counts differ by at most
    the size of the symmetric difference, and a link bounds that by its share of both sizes.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            both = batch["n_a"].to_numpy().astype(np.int64) + batch["n_b"].to_numpy()
            a, b = batch["shape_a"].to_pylist(), batch["shape_b"].to_pylist()
            parts = np.minimum(*[np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b)])
            apart = np.empty(len(a), np.int64)
            for n in np.unique(parts).tolist():
                at = np.flatnonzero(parts == n)
                apart[at] = np.abs(folded([a[i] for i in at], n) - folded([b[i] for i in at], n)).sum(axis=1)
            keep = pa.array(apart * (100 + percent) <= both * (100 - percent))
            yield pa.record_batch([batch["a"].filter(keep), batch["b"].filter(keep)], schema=schema)

    return run


def seen(width: int, keyed: bool):
    """(doc_id, text) to (doc_id, class, n, shape) and, at a task's end, (bucket, n) counts.

    If ``keyed``, a row's third column, its text's key, is passed on at the end.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("class", pa.int64()), ("n", pa.int64()),
                        ("bucket", pa.int32()), ("shape", pa.binary()),
                        *[("text_key", pa.int64())] * keyed])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in small(batches):
            classes, sizes, held, shapes = [], [], [], []
            for tokens in shingle_sets(batch.column(1).to_pylist(), width):
                sizes.append(len(tokens))
                shapes.append(shape(tokens))
                classes.append(set_class(tokens) if len(tokens) else None)
                held.append(bucket(tokens))
            if held:
                counts += np.bincount(np.concatenate(held), minlength=BUCKETS)
            yield pa.record_batch([batch.column(0), pa.array(classes, pa.int64()),
                                   pa.array(sizes, pa.int64()),
                                   pa.nulls(len(sizes), pa.int32()), pa.array(shapes, pa.binary()),
                                   *batch.columns[2:]], schema=schema)
        used = np.flatnonzero(counts)
        nothing = pa.nulls(len(used), pa.int64())
        yield pa.record_batch([nothing, nothing, pa.array(counts[used]),
                               pa.array(used.astype(np.int32)), pa.nulls(len(used), pa.binary()),
                               *[nothing] * keyed], schema=schema)

    return run


def prefixes(width: int, percent: int, counts: np.ndarray):
    """(text) to (token, class, n, pos): each set's prefix under the order of rare tokens first."""
    schema = pa.schema([("token", pa.int64()), ("class", pa.int64()), ("n", pa.int32()),
                        ("pos", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in small(batches):
            tokens, classes, sizes, lengths = [], [], [], []
            for s in shingle_sets(batch.column(0).to_pylist(), width):
                if not len(s) or not partner_possible(len(s), percent):
                    continue
                c = set_class(s)
                if c in done:
                    continue
                if len(done) >= REMEMBERED:
                    done.clear()
                done.add(c)
                k = prefix_length(len(s), percent)
                first = s[np.argsort(counts[bucket(s)], kind="stable")[:k]]
                tokens.append(first)
                classes.append(c)
                sizes.append(len(s))
                lengths.append(k)
            if tokens:
                yield pa.record_batch([
                    pa.array(np.concatenate(tokens).view(np.int64)),
                    pa.array(np.repeat(np.array(classes, np.int64), lengths)),
                    pa.array(np.repeat(np.array(sizes, np.int32), lengths)),
                    pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths]))],
                    schema=schema)

    return run


def passes(wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which signed 64-bit values the filter lets through."""
    at = values.view(np.uint64) & np.uint64(FILTER_BITS - 1)
    return (wanted[(at >> np.uint64(3)).astype(np.int64)]
            >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def only(column: int, wanted: np.ndarray):
    """The rows whose value in a column the filter lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(wanted, batch.column(column).to_numpy())))

    return run


def let_through(wanted: np.ndarray):
    """``passes`` as a Column function: of the rows only the tested column goes to Python."""
    @F.arrow_udf("boolean")
    def run(values: pa.Array) -> pa.Array:
        return pa.array(passes(wanted, values.to_numpy()))

    return run


def chosen_sets(width: int, wanted: np.ndarray):
    """(text) to one row (class, n, tokens) of each class that the filter lets through."""
    schema = pa.schema([("class", pa.int64()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in small(batches):
            out: list[list] = [[] for _ in schema]
            for s in shingle_sets(batch.column(0).to_pylist(), width):
                if not len(s):
                    continue
                c = set_class(s)
                if c in done or not passes(wanted, np.array([c], np.int64))[0]:
                    continue
                if len(done) >= REMEMBERED:
                    done.clear()
                done.add(c)
                for held, value in zip(out, (c, len(s), s.view(np.int64))):
                    held.append(value)
            yield pa.record_batch([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    return run


def filter_bits(values: DataFrame) -> np.ndarray:
    """A bit for each value of the only column, as bytes: FILTER_BITS / 8, whatever the input.

    Values that were not put in pass by chance, more of them the more there are; what the
    filter lets through is joined exactly afterwards.
    """
    at = F.pmod(values.columns[0], F.lit(FILTER_BITS))
    rows = (values.select(at.alias("at")).groupBy(F.shiftright("at", 5).alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(at % 32 as int)))").alias("bits")))
    words = np.zeros(FILTER_BITS // 32, np.uint32)
    found = rows.toArrow()
    words[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return words.view(np.uint8)


def size_fits(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def can_reach(n: Column, pos: Column, m: Column, at: Column, percent: int) -> Column:
    """Whether sets that share a token at these places of the first order can link.

    If it is the first token they share, the overlap is at most 1 plus what comes after it
    in either set, and it must be percent / (100 + percent) of both sizes together. A pair
    that links passes at its first shared token at least.
    """
    most = F.least(n - pos, m - at)
    return size_fits(n, m, percent) & (most * (100 + percent) >= (n + m) * percent)


class Join:
    """One run of the join over ``docs(doc_id, text)``."""

    def __init__(self, docs: DataFrame, scratch: Scratch, width: int, percent: int,
                 keyed: bool = False) -> None:
        self.docs, self.scratch = docs.select("doc_id", "text"), scratch
        self.width, self.percent, self.keyed = width, percent, keyed
        if keyed:
            self.docs = self.docs.withColumn("text_key", text_key())

    def text_pass(self, columns: list[str], function, schema: str, name: str) -> DataFrame:
        rows = self.docs.select(*columns).mapInArrow(function, schema)
        return self.scratch.keep(rows, name)

    def membership(self) -> DataFrame:
        """(doc_id, n_shingles, component_id) for each document, and its keys if ``keyed``."""
        keys = ["text_key"] * self.keyed
        both = self.text_pass(["doc_id", "text", *keys], seen(self.width, self.keyed),
                              "doc_id bigint, class bigint, n bigint, bucket int, shape binary"
                              + ", text_key bigint" * self.keyed, "seen")
        counted = (both.where("bucket IS NOT NULL").groupBy("bucket")
                   .agg(F.sum("n").alias("n")).toArrow())
        counts = np.zeros(BUCKETS, np.int64)
        counts[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
        lists = self.lists(counts)
        listed = both.where("class IS NOT NULL").mapInArrow(
            only(1, filter_bits(lists.select("class"))), both.schema)
        self.shapes = self.scratch.keep(listed.dropDuplicates(["class"]).select(
            "class", "n", "shape"), "shapes")
        labels = self.labels(lists)
        docs = both.where("bucket IS NULL").select("doc_id", "class", F.col("n").alias("n_shingles"),
                                                   *keys)
        return self.smallest_ids(docs, labels)

    def lists(self, counts: np.ndarray) -> DataFrame:
        """(token, class, n, pos): the prefix tokens that several classes share."""
        emitted = self.text_pass(["text"], prefixes(self.width, self.percent, counts),
                                 "token bigint, class bigint, n int, pos int", "prefixes")
        several = (emitted.groupBy("token").agg(F.min("class").alias("x"), F.max("class").alias("y"))
                   .where("x < y").select("token"))
        several = self.scratch.keep(several, "several")
        left = emitted.mapInArrow(only(0, filter_bits(several)), emitted.schema)
        lists = self.scratch.keep(left.join(several, "token").distinct(), "lists")
        self.scratch.drop("prefixes", "several")
        return lists

    def sets(self, classes: DataFrame) -> DataFrame:
        """(class, n, tokens) of at least the given classes, each once, in the order of the hashes.

        Not written: both sides of a verification read the one shuffle that deals them by class.
        """
        rows = self.docs.select("text").mapInArrow(
            chosen_sets(self.width, filter_bits(classes)), "class bigint, n int, tokens array<bigint>")
        return rows.dropDuplicates(["class"])

    def labels(self, lists: DataFrame) -> DataFrame:
        """(node, label) of all classes that have a link."""
        p = self.percent
        prefix = F.col("n") - F.ceil(F.col("n") * p / 100) + 1
        weight = lists.groupBy("class").agg((F.count("*") / F.first(prefix)).alias("weight"))
        rows = self.scratch.keep(lists.join(weight, "class"), "weighted")
        band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / p)))
        tried, links, labels = None, None, None
        for turn, group in (("star", ["token", "band"]), ("again", ["token"])):
            rows = rows.withColumn("band", band)
            if labels is None:
                rows = rows.withColumn("label", F.col("class"))
            pairs = self.fresh(self.stars(rows, group), tried, f"{turn}-pairs")
            found = self.verified(pairs, turn)
            links = found if labels is None else labels.where("node <> label").toDF(
                "a", "b").union(found)
            labels = self.scratch.keep(components(links, self.scratch, turn), f"{turn}-labels")
            tried = pairs if tried is None else tried.union(pairs)
            rows = self.mixed(rows, labels, turn)
        pairs = self.fresh(self.across(rows), tried, "across-pairs")
        links = labels.where("node <> label").toDF("a", "b").union(self.verified(pairs, "across"))
        return self.scratch.keep(components(links, self.scratch, "last"), "labels")

    def mixed(self, rows: DataFrame, labels: DataFrame, name: str) -> DataFrame:
        """The lists that hold several components, with each row's ``label``.

        ``most`` is the component with most rows of the list.
        """
        marked = rows.drop("label", "band", "most").join(
            labels.withColumnRenamed("node", "class"), "class", "left")
        marked = self.scratch.keep(marked.withColumn("label", F.coalesce("label", "class")),
                                   f"{name}-marked")
        several = (marked.groupBy("token", "label").agg(F.count("*").alias("x"))
                   .groupBy("token").agg(F.count("*").alias("labels"),
                                         F.max(F.struct("x", "label")).alias("m"))
                   .where("labels > 1").select("token", F.col("m.label").alias("most")))
        return self.scratch.keep(marked.join(several, "token"), f"{name}-mixed")

    def fresh(self, pairs: DataFrame, tried: DataFrame | None, name: str) -> DataFrame:
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        return self.scratch.keep(pairs, name)

    def stars(self, rows: DataFrame, group: list[str]) -> DataFrame:
        """Each list's members paired with the member whose prefix is shared most.

        That is the text most others were made from: a changed copy has tokens of its own.
        """
        lead = F.max(F.struct("weight", F.col("class").alias("c"), F.col("n").alias("m"),
                              F.col("pos").alias("at"), F.col("label").alias("of"))).alias("lead")
        leaders = rows.groupBy(*group).agg(lead).select(*group, "lead.*").drop("weight")
        return rows.join(leaders, group).where(
            (F.col("class") != F.col("c")) & (F.col("label") != F.col("of"))
            & can_reach(F.col("n"), F.col("pos"), F.col("m"), F.col("at"), self.percent)).select(
            F.least("c", "class").alias("a"), F.greatest("c", "class").alias("b")).distinct()

    def across(self, rows: DataFrame) -> DataFrame:
        """All pairs of a list's members that are in different components and can still link.

        One of each pair is outside the list's largest component, so a large group of near
        copies meets the few others only, not itself.
        """
        a, b = rows.where("label <> most").alias("a"), rows.alias("b")
        met = a.join(b, (F.col("a.token") == F.col("b.token"))
                     & (F.col("a.label") != F.col("b.label"))
                     & can_reach(F.col("a.n"), F.col("a.pos"), F.col("b.n"), F.col("b.pos"),
                                 self.percent))
        return met.select(F.least("a.class", "b.class").alias("a"),
                          F.greatest("a.class", "b.class").alias("b")).distinct()

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that share prefix tokens in both hash orders and reach the threshold.

        The sets' shapes, a fixed number of bytes each, tell most pairs that met by chance apart, so
        that whole sets are made and moved only for texts that resemble one another.
        """
        def with_sides(pairs: DataFrame, sets: DataFrame) -> DataFrame:
            for side in ("a", "b"):
                pairs = pairs.join(sets.select(*[F.col(c).alias(side if c == "class" else f"{c}_{side}")
                                                 for c in sets.columns]), side)
            return pairs

        near = with_sides(pairs, self.shapes).where(
            size_fits(F.col("n_a"), F.col("n_b"), self.percent)).select(
            "a", "b", "n_a", "shape_a", "n_b", "shape_b").mapInArrow(
            alike(self.percent), "a bigint, b bigint")
        near = self.scratch.keep(near, f"{name}-candidates")
        if near.isEmpty():
            return near
        sets = self.sets(near.select("a").union(near.select("b")))

        def prefix(side: str, last: bool) -> Column:
            n = F.col(f"n_{side}")
            k = (n - F.ceil(n * self.percent / F.lit(100)) + 1).cast("int")
            return F.slice(f"tokens_{side}", n - k + 1 if last else F.lit(1), k)

        common = F.size(F.array_intersect("tokens_a", "tokens_b"))
        shared = (F.arrays_overlap(prefix("a", False), prefix("b", False))
                  & F.arrays_overlap(prefix("a", True), prefix("b", True)))
        return self.scratch.keep(with_sides(near, sets).where(shared).where(
            100 * common >= self.percent * (F.col("n_a") + F.col("n_b") - common))
            .select("a", "b"), f"{name}-links")

    def smallest_ids(self, docs: DataFrame, labels: DataFrame) -> DataFrame:
        """Each document with its component's smallest id; rows without one come last.

        If ``keyed``, ``least`` is a row: its id and, among rows that share it, the least text key.
        """
        row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
        per_class = docs.where("class IS NOT NULL").groupBy("class").agg(
            F.min(row if self.keyed else "doc_id").alias("least"))
        joined = per_class.join(labels.withColumnRenamed("node", "class"), "class", "left")
        joined = joined.select("class", "least", F.coalesce("label", "class").alias("label"))
        joined = self.scratch.keep(joined, "classes")
        ids = joined.groupBy("label").agg(F.min("least").alias("least"))
        per_class = joined.drop("least").join(ids, "label").select("class", "least")
        found = docs.join(per_class, "class", "left")
        alone = F.col("class").isNull()
        chosen = F.col("least.doc_id" if self.keyed else "least")
        columns = ["doc_id", "n_shingles",
                   F.when(alone, F.col("doc_id")).otherwise(chosen).alias("component_id")]
        if self.keyed:
            columns += ["text_key", F.when(alone, F.col("text_key")).otherwise(
                F.col("least.text_key")).alias("component_key")]
        return found.select(*columns)


def text_key() -> Column:
    """Tells texts of one id apart; 64 bits, as in a class."""
    return F.xxhash64("text")


def near_duplicates(docs: DataFrame, scratch: Scratch, width: int = 5, percent: int = 80,
                    keyed: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id): see the module's text.

    If ``keyed``, it also has (text_key, component_key): the text's key, and that of the component's row
    that :func:`one_per_group` keeps, whose id is ``component_id``.
    """
    return Join(docs, scratch, width, percent, keyed).membership()


def one_per_group(docs: DataFrame, membership: DataFrame, scratch: Scratch) -> DataFrame:
    """One row of ``docs`` for each group of a keyed membership, columns unchanged.

    It has the group's smallest id, or none if no row has one. Rows without words are groups
    of their own; of those that share an id and a text one stays, those without an id all
    stay. Only rows that a group loses are joined; a filter of their keys picks them first, so
    that the texts of the others, most of all, are not shuffled for the join.
    """
    first = (F.col("doc_id").eqNullSafe(F.col("component_id"))
             & (F.col("text_key") == F.col("component_key")))
    per_row = membership.where("doc_id IS NOT NULL OR n_shingles > 0").groupBy(
        F.col("doc_id").alias("_near_id"), F.col("text_key").alias("_near_key")).agg(
        F.count("*").alias("_near_rows"), F.max(first).alias("_near_first"))
    marks = scratch.keep(per_row.where("_near_rows > 1 OR NOT _near_first"), "marks")
    marked = let_through(filter_bits(marks.select(
        F.xxhash64("_near_id", "_near_key").alias("key"))))
    keyed = docs.withColumn("_near_text", text_key()).withColumn(
        "_near_mark", marked(F.xxhash64(F.col("doc_id").cast("bigint"), "_near_text")))
    joined = keyed.where("_near_mark").join(
        marks, F.col("doc_id").eqNullSafe(F.col("_near_id"))
        & (F.col("_near_text") == F.col("_near_key")), "left")
    kept = keyed.where("NOT _near_mark").unionByName(
        joined.where("_near_rows IS NULL"), allowMissingColumns=True)
    if not marks.where("_near_rows > 1 AND _near_first").isEmpty():
        repeated = joined.where("_near_rows > 1 AND _near_first")
        kept = kept.unionByName(repeated.dropDuplicates(["_near_id", "_near_key"]))
    return kept.select(*docs.columns)
