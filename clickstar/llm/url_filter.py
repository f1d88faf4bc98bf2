"""URL rules decided by Bloom filter cascades, exact over the corpus's own keys.

A rule is a key ``host/path/``: it fits a url whose host is that host or below it and
whose path starts with that path. A url offers as keys each of its host's suffixes joined
with each of its path's leading folders. The keys of all urls together are the universe.

A cascade decides membership of a list for every key of the universe. Its first level is
a Bloom filter of the listed keys; the second holds the universe's keys that the first
lets through wrongly, the third the listed keys that the second lets through, and so on
until a level lets nothing through wrongly. Testing is a projection over literals: no join
and no shuffle of the urls. Building reads the urls once for the size of the universe and
once for the first level's positives, which are about twice the list; all further levels
read only those.

Defined cases: a null url or one without ``://`` has an empty host and path and fits no
rule; repeated urls and repeated listed keys change nothing; an empty list makes a cascade
without levels that holds nothing; an empty table gives an empty result. Other columns of
the input are not read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstar.llm.tables import Scratch, lower_ascii

MAX_LEVELS = 64


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` of 64 bits, ``hashes`` positions per key."""

    words: tuple[int, ...]
    hashes: int
    seed: int

    @property
    def bits(self) -> int:
        return 64 * len(self.words)

    def holds(self, key: Column) -> Column:
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        found = F.lit(True)
        for at in positions(key, self.bits, self.hashes, self.seed):
            word = F.get(words, F.shiftright(at, 6).cast("int"))
            found = found & (F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1)
        return found


def positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    first, second = F.xxhash64(F.lit(seed), key), F.xxhash64(key, F.lit(seed))
    part = [F.pmod(h, F.lit(bits)) for h in (first, second)]
    return [F.pmod(part[0] + F.lit(i) * part[1], F.lit(bits)) for i in range(hashes)]


def bloom(keys: DataFrame, count: int, rate: float, seed: int) -> Level:
    """A filter of ``keys(key)``; the driver gets its words, a size set by ``count``."""
    hashes = max(1, round(-math.log2(rate)))
    n_words = max(1, math.ceil(count * hashes / math.log(2) / 64))
    at = keys.select(F.explode(F.array(*positions(F.col("key"), 64 * n_words, hashes, seed)))
                     .alias("at"))
    words = [0] * n_words
    for row in (at.groupBy(F.shiftright("at", 6).alias("word"))
                .agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("value"))
                .collect()):
        words[row.word] = row.value
    return Level(tuple(words), hashes, seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether the list holds ``key``; exact for every key of the universe."""
        inside = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels), 0, -1):
            inside = F.when(self.levels[depth - 1].holds(key), inside).otherwise(
                F.lit(depth % 2 == 0))
        return inside


def build(universe: DataFrame, lists: dict[str, DataFrame], scratch: Scratch
          ) -> dict[str, Cascade]:
    """A cascade for each list of ``key``, over ``universe(key)``, repeats allowed."""
    total = max(1, universe.agg(F.approx_count_distinct("key", 0.02)).first()[0])
    listed, sizes, first = {}, {}, {}
    for name, keys in lists.items():
        listed[name] = scratch.keep(keys.select("key").where("key IS NOT NULL").distinct(),
                                    f"listed-{name}")
        sizes[name] = listed[name].count()
        if sizes[name]:
            rate = min(0.5, math.sqrt(0.5) * sizes[name] / total)
            first[name] = bloom(listed[name], sizes[name], rate, 1)
    if not first:
        return {name: Cascade(()) for name in lists}
    passed = F.array_compact(F.array(*[F.when(level.holds(F.col("key")), F.lit(name))
                                       for name, level in first.items()]))
    positives = scratch.keep(
        universe.select("key", F.explode(passed).alias("list")).distinct(), "positives")
    cascades = {name: Cascade(()) for name in lists}
    for name, level in first.items():
        wrong = scratch.keep(positives.where(F.col("list") == name).select("key")
                             .join(listed[name], "key", "left_anti"), f"wrong-{name}")
        cascades[name] = Cascade(tuple(deepen(level, listed[name], sizes[name], wrong)))
    return cascades


def deepen(first: Level, listed: DataFrame, n_listed: int, wrong: DataFrame) -> list[Level]:
    """Adds levels until none of the other side's keys passes."""
    levels, inside, outside = [first], listed, wrong
    while True:
        n = outside.count()
        if n == 0:
            return levels
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end; are listed keys also in the universe twice?")
        levels.append(bloom(outside, n, 0.5, len(levels) + 1))
        inside, outside = outside, inside.where(levels[-1].holds(F.col("key")))


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_suffixes(host: Column, labels: int) -> Column:
    """The host and the domains above it, of at most ``labels`` labels, longest first."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    starts = F.sequence(F.greatest(F.lit(1), n - labels + 1), n)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(starts, lambda i: F.array_join(F.slice(parts, i, n - i + 1), ".")))


def key_prefixes(path: Column, folders: int) -> Column:
    """The path's leading folders ``/``, ``/a/``, ... up to ``folders`` deep, longest first."""
    parts = F.split(path, "/", folders + 3)
    deep = F.least(F.size(parts) - 2, F.lit(folders))
    return F.when(~path.startswith("/"), F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(deep, F.lit(0), F.lit(-1)),
                    lambda i: F.concat(F.array_join(F.slice(parts, 1, i + 1), "/"), F.lit("/"))))


def keys_of(host: Column, path: Column, labels: int, folders: int) -> Column:
    """All keys of a url that a rule of that many labels and folders can equal."""
    prefixes = key_prefixes(path, folders)
    return F.flatten(F.transform(key_suffixes(host, labels), lambda suffix: F.transform(
        prefixes, lambda prefix: F.concat(suffix, prefix))))


def judge(pages: DataFrame, block: list[str], allow: list[str],
          host_list: Callable[[DataFrame], DataFrame], scratch: Scratch) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to ``pages(page_id, url)``.

    Of the rules that fit, the longest decides; equally long ones cannot both fit unless
    they are one key, and then ``block`` wins. Without a rule a url is blocked if its host
    is on the list that ``host_list`` makes from the corpus's hosts (``host``), of any size.
    """
    rules = [*block, *allow]
    if any("/" not in r or not r.endswith("/") for r in rules):
        raise ValueError("a rule is a host and a path that ends with /")
    labels = max([1, *(r.split("/", 1)[0].count(".") + 1 for r in rules)])
    folders = max([0, *(r.count("/") - 1 for r in rules)])
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"),
                        path_of(F.col("url")).alias("path"))
    spark = pages.sparkSession
    rows = "SELECT explode(from_json('{}', 'array<string>')) AS key"
    universe = urls.select(F.explode(F.concat(
        keys_of(F.col("host"), F.col("path"), labels, folders),
        F.array(F.concat(F.lit("@"), F.col("host"))))).alias("key"))
    hosts = urls.select("host").distinct()
    cascades = build(universe, {
        "block": spark.sql(rows.format(json.dumps(block))),
        "allow": spark.sql(rows.format(json.dumps(allow))),
        "hosts": host_list(hosts).select(F.concat(F.lit("@"), F.col("host")).alias("key")),
    }, scratch)
    fitting = F.filter(keys_of(F.col("host"), F.col("path"), labels, folders),
                       lambda key: cascades["block"].holds(key) | cascades["allow"].holds(key))
    longest = F.aggregate(fitting, F.lit(None).cast("string"), lambda best, key: F.when(
        best.isNull() | (F.length(key) > F.length(best)), key).otherwise(best))
    judged = urls.withColumn("rule", longest)
    on_list = cascades["hosts"].holds(F.concat(F.lit("@"), F.col("host")))
    return judged.withColumn("verdict", F.when(
        F.when(F.col("rule").isNotNull(), cascades["block"].holds(F.col("rule")))
        .otherwise(on_list), "block").otherwise("allow"))
