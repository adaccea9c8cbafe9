"""URL filter: a Bloom filter cascade for the listed hosts, with longest-match rules on top.

A plain Bloom filter errs on keys that are not listed. The cascade removes those errors: level 0 encodes the listed
keys, level 1 the unlisted keys of the corpus that level 0 lets pass, level 2 the listed keys that level 1 lets pass,
and so on until a level lets nothing wrong pass. A key's answer is that of the first level that rejects it. As the
levels were made over every key of the corpus, the answer is exact for all of them, and needs no join.

Everything is DataFrame functions: a level is one row with an array of 64-bit words, read by the plan as a scalar
subquery. The size of every level is checked: beyond ``max_bits`` the keys are split by hash into shards with a cascade
each. Rows are then written once, in a folder for each shard and without a shuffle, and each shard is a job of its own
that reads its folder and its own levels alone: no plan ever holds the levels of two shards.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellgrid.llm._shared import bigints, discard, shared_dir, stored

#: Levels beyond which a cascade is taken to be broken; each leaves a small share of the keys.
MOST_LEVELS = 64
#: Bits for each key and hashes of the levels after the first: they hold few keys, and err on few.
LATER_BITS, LATER_HASHES = 6, 3
#: Shards whose jobs run at the same time.
AT_ONCE = 4


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``bits`` has one row with the array ``words``."""

    number: int
    size: int
    hashes: int
    bits: DataFrame


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]
    shard: int
    shards: int


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _places(key: Column, number: int, size: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(size).cast("bigint")) for i in range(hashes)]


def _bit(place: Column) -> Column:
    """The place's bit in its 64-bit word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))


def _passes(key: Column, level: Level) -> Column:
    words = level.bits.scalar()
    places = _places(key, level.number, level.size, level.hashes)
    hits = (F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0 for p in places)
    return functools.reduce(lambda a, b: a & b, hits)


def _slot(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(shards))


def _at_once(spark: SparkSession, do: Callable, args: Iterable) -> list:
    """``do`` of each argument, some of them at the same time, as each starts Spark jobs of its own."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(inheritable_thread_target(spark)(do), args))


def build_cascade(keys: DataFrame, bits_per_key: int = 10, hashes: int = 4, max_bits: int = 1 << 28) -> list[Cascade]:
    """Cascades that tell the listed from the other keys of ``keys(key string, listed boolean)``.

    ``keys`` is the complete universe: repeated keys count once, a key that is listed once is listed, null keys are
    left out. ``max_bits`` bounds every level (32 MB as it stands). The number of shards follows from the number of keys
    and the errors to expect of the first level; a shard that outgrows the bound all the same is split in two. An empty
    list gives cascades that list nothing.
    """
    spark = keys.sparkSession
    base = stored(
        keys.where(F.col("key").isNotNull()).groupBy("key").agg(F.bool_or(F.coalesce("listed", F.lit(False))).alias("listed"))
    )
    count = base.agg(F.count_if("listed").alias("listed"), F.count_if(~F.col("listed")).alias("others")).first()
    errors = count.others * (1 - math.exp(-hashes / bits_per_key)) ** hashes if count.listed else 0
    shards = max(1, math.ceil(max(count.listed * bits_per_key, errors * LATER_BITS) * 1.1 / max_bits))
    if shards > 1:
        base.withColumn("slot", _slot(F.col("key"), shards)).write.partitionBy("slot").parquet(at := shared_dir(spark))
        discard(base)
        base = spark.read.schema("key string, listed boolean, slot bigint").parquet(at)
        base._stored_at = at

    def one(part: tuple[int, int]) -> Cascade | None:
        shard, of = part
        own = base if shards == 1 else base.where(F.col("slot") == shard % shards)
        own = own if of == shards else own.where(_slot(F.col("key"), of) == shard)
        return _one(own.select("key", "listed"), bits_per_key, hashes, shard, of, max_bits, spark)

    todo, found = [(s, shards) for s in range(shards)], []
    while todo:
        made = _at_once(spark, one, todo)
        found += [c for c in made if c is not None]
        todo = [half for (s, of), c in zip(todo, made) if c is None for half in ((s, 2 * of), (s + of, 2 * of))]
    discard(base)
    return found


def _one(keys: DataFrame, bits_per_key: int, hashes: int, shard: int, shards: int, max_bits: int, spark: SparkSession) -> Cascade | None:
    """The cascade of a shard; None if one of its levels would exceed ``max_bits``."""
    levels: list[Level] = []
    inside, outside = keys.where("listed"), keys.where("not listed")
    while n := inside.count():
        number = len(levels)
        if number >= MOST_LEVELS:
            raise RuntimeError(f"the cascade does not end: {n} keys are left after {number} levels")
        size, k = max(64, -(-n * (LATER_BITS if levels else bits_per_key) // 64) * 64), LATER_HASHES if levels else hashes
        if size > max(64, max_bits):
            for level in levels:
                discard(level.bits)
            return None
        set_bits = (
            inside.select(F.explode(F.array(*_places(F.col("key"), number, size, k))).alias("p"))
            .groupBy(F.shiftright("p", 6).alias("w"))
            .agg(F.bit_or(_bit(F.col("p"))).alias("bits"))
        )
        dense = set_bits.unionByName(spark.range(size // 64).select(F.col("id").alias("w"), F.lit(0).cast("bigint").alias("bits"))).groupBy("w").agg(F.bit_or("bits").alias("bits"))
        one = dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"]).alias("words"))
        level = Level(number, size, k, stored(one, shared_dir(spark)))
        levels.append(level)
        inside, outside = outside.where(_passes(F.col("key"), level)), inside
    return Cascade(tuple(levels), shard, shards)


def _in_cascade(key: Column, cascade: Cascade) -> Column:
    """True for listed keys: the answer of the first level that rejects the key."""
    answer = F.lit(len(cascade.levels) % 2 == 1)
    for level in reversed(cascade.levels):
        answer = F.when(_passes(key, level), answer).otherwise(F.lit(level.number % 2 == 1))
    return answer


def with_listed(df: DataFrame, key: str, cascades: list[Cascade], out: str = "listed") -> DataFrame:
    """``df`` with a boolean column ``out``: whether ``key`` is listed. Null keys are not.

    One cascade is a column of the plan. Several are a job each over the rows of their shard, which are written to shared
    storage before and after.
    """
    def told(rows: DataFrame, cascade: Cascade) -> DataFrame:
        return rows.withColumn(out, F.coalesce(F.col(key).isNotNull() & _in_cascade(F.col(key), cascade), F.lit(False)))

    if len(cascades) == 1:
        return told(df, cascades[0])
    spark = df.sparkSession
    most = max(c.shards for c in cascades)
    place = {r: i for i, c in enumerate(cascades) for r in range(c.shard, most, c.shards)}
    own = F.coalesce(F.get(bigints([place[r] for r in range(most)]), _slot(F.col(key), most).cast("int")), F.lit(0))
    dealt, done = shared_dir(spark), shared_dir(spark)
    df.withColumn("__shard", own).write.partitionBy("__shard").parquet(dealt)
    rows = spark.read.schema(df.withColumn("__shard", own).schema).parquet(dealt)

    def judge(i: int) -> StructType:
        judged = told(rows.where(F.col("__shard") == i).drop("__shard"), cascades[i])
        judged.write.parquet(f"{done}/shard={i}")
        return judged.schema

    schemas = _at_once(spark, judge, range(len(cascades)))
    discard(dealt, spark)
    return spark.read.schema(schemas[0]).parquet(f"{done}/shard=*")


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct ``rule, verdict`` of the longest fitting rule (``host, path, verdict``), null where none fits.

    A rule fits its host and all its subdomains if the path starts with the rule's. Of two rules of one length the
    alphabetically first wins.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))[::-1]:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def hosts_under(hosts: DataFrame, names: DataFrame) -> DataFrame:
    """``hosts(key)`` with ``listed``: whether one of the host's dot-separated labels is in the table ``names(name)``.

    ``hosts`` has each host once; the list may be of any size, as it is joined by label.
    """
    labels = hosts.select("key", F.explode(F.array_distinct(F.split("key", r"\."))).alias("name"))
    found = labels.join(names.select("name").distinct(), "name", "left_semi").select("key").distinct()
    return hosts.select("key", F.lit(False).alias("listed")).unionByName(found.withColumn("listed", F.lit(True)))


def filter_urls(pages: DataFrame, names: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", **bloom) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``, in place of columns of these names.

    A host is listed if one of its dot-separated labels is in the table ``names(name string)``, which is joined with the
    hosts once, when the cascade is built; the cascade over all hosts of ``pages`` then answers for each row. The verdict
    is that of the longest rule, else ``block`` for listed hosts and ``allow`` for all others. Null urls and urls without
    ``://`` have an empty host and path, fit no rule and are allowed; urls of any length are judged whole; null and
    repeated names change nothing; an empty table gives no rows; repeated rows are judged alike.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    cascades = build_cascade(hosts_under(pages.select(host.alias("key")).distinct(), names), **bloom)
    judged = with_listed(pages.withColumns({"host": host, "path": path}), "host", cascades, "__listed")
    judged = judged.withColumn("__rule", longest_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("__listed"), "block").otherwise("allow"))
    return judged.withColumns({"rule": F.col("__rule.rule"), "verdict": verdict}).drop("__rule", "__listed")
