"""URL filters: (host, path) rules and a Bloom filter cascade for listed hosts.

The cascade holds membership exactly for every key of a known universe (all keys of the
corpus), without a join. Level 0 is a Bloom filter of the listed keys. Its false positives
among the other keys of the universe go into level 1, the listed keys that level 1 wrongly
holds go into level 2, and so on until a level has no false positive. A key is looked up
level by level; the first level that doesn't hold it decides.

A level's bits are put together by a distributed ``bit_or`` and come to the driver as words
(``bits_per_key`` bits for each key that the level encodes). If the listed keys need more
than ``max_bytes`` per filter, the keys are split by hash into shards with a cascade each, every one
broadcast alone and rows dealt by shard, so what a task holds keeps its bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains if the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed rules of the query.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)

#: The query's list: hosts with one of these labels.
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and for urls without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_columns(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, else null; equally long ones go by name."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _mix(h: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h ^ np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(29))


def _positions(h: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """One row of ``hashes`` bit positions per key hash."""
    a, b = _mix(h, 2 * level + 1), _mix(h, 2 * level + 2) | np.uint64(1)
    with np.errstate(over="ignore"):
        return (a[:, None] + np.arange(hashes, dtype=np.uint64)[None, :] * b[:, None]) % np.uint64(bits)


def holds(words: np.ndarray, h: np.ndarray, level: int, hashes: int) -> np.ndarray:
    p = _positions(h, level, len(words) * 64, hashes)
    return ((words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1)).all(axis=1)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[np.ndarray, ...]
    hashes: int

    def contains(self, h: np.ndarray) -> np.ndarray:
        """True for listed keys, by key hash; exact for keys of the universe."""
        out = np.zeros(len(h), bool)
        open_ = np.arange(len(h))
        for level, words in enumerate(self.levels):
            if not len(open_):
                break
            held = holds(words, h[open_], level, self.hashes)
            out[open_] = held if level % 2 == 0 else ~held
            open_ = open_[held]
        return out


def key_hash(key: Column) -> Column:
    return F.xxhash64(key)


def _level(keys: DataFrame, level: int, n: int, bits_per_key: int, hashes: int) -> np.ndarray:
    size = -(-n * bits_per_key // 64)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            p = _positions(b.column(0).to_numpy().view(np.uint64), level, size * 64, hashes).ravel()
            bit = np.left_shift(np.uint64(1), p & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((p >> np.uint64(6)).astype(np.int64)), pa.array(bit)], ["word", "bits"])

    words = np.zeros(size, np.uint64)
    parts = keys.select("h").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    got = parts.toPandas()  # at most ``size`` rows
    words[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return words


def _outside(keys: DataFrame, words: np.ndarray, level: int, hashes: int) -> DataFrame:
    """The keys that the level holds."""
    shared = keys.sparkSession.sparkContext.broadcast(words)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield b.filter(pa.array(holds(shared.value, b.column(0).to_numpy().view(np.uint64), level, hashes)))

    return keys.mapInArrow(run, keys.schema)


def build_cascades(
    spark: SparkSession, universe: DataFrame, bits_per_key: int = 10, hashes: int = 5, max_bytes: int = 32 << 20, max_levels: int = 40
) -> list[Cascade]:
    """``universe(key, listed)`` → cascades by shard (``pmod(hash, number of cascades)``).

    Keys may repeat and be null (ignored); a key that is listed once is listed. An empty
    list gives a cascade without levels, which contains nothing.
    """
    keys = universe.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed"))
    keys = written(spark, keys.select(key_hash(F.col("key")).alias("h"), "listed"), "url_keys")
    n = keys.where("listed").count()
    shards = max(1, -(-n * bits_per_key // (8 * max_bytes)))
    out = []
    for s in range(shards):
        part = keys.where(F.pmod("h", F.lit(shards)) == s)
        inside, other = part.where("listed").select("h"), part.where(~F.col("listed")).select("h")
        count = n if shards == 1 else inside.count()
        levels: list[np.ndarray] = []
        while count:
            if len(levels) == max_levels:
                raise RuntimeError("two keys share a 64-bit hash: choose another key hash")
            words = _level(inside, len(levels), count, bits_per_key, hashes)
            levels.append(words)
            false = written(spark, _outside(other, words, len(levels) - 1, hashes), "url_false_positives")
            inside, other, count = false, inside, false.count()
        out.append(Cascade(tuple(levels), hashes))
    return out


def listed(spark: SparkSession, df: DataFrame, key: str, cascades: list[Cascade], out: str = "listed") -> DataFrame:
    """``df`` with ``out``: whether the key is listed (false for null keys)."""
    shared = [spark.sparkContext.broadcast(c) for c in cascades]
    n = len(shared)

    @F.pandas_udf("boolean")
    def contains(h: pd.Series) -> pd.Series:
        v = h.to_numpy(np.int64)
        found = np.zeros(len(v), bool)
        shard = np.mod(v, n)
        for s in np.unique(shard):  # one, if rows are dealt by shard
            at = shard == s
            found[at] = shared[s].value.contains(v[at].view(np.uint64))
        return pd.Series(found)

    if n > 1:  # a hot key's shard is dealt to several tasks
        df = df.repartition(F.pmod(key_hash(F.col(key)), F.lit(n)), F.floor(F.rand(5) * 16))
    return df.withColumn(out, F.col(key).isNotNull() & contains(key_hash(F.col(key))))


def _with_host(pages: DataFrame, url: str) -> DataFrame:
    host, path = host_and_path(F.col(url))
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return pages.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"))


def labelled_hosts(pages: DataFrame, url: str = "url", labels: tuple[str, ...] = LISTED_LABELS) -> DataFrame:
    """``host``: the different hosts of ``pages`` that hold one of the labels."""
    hosts = _with_host(pages, url).select("host").distinct()
    return hosts.where(F.arrays_overlap(F.split("host", r"\."), F.array(*[F.lit(x) for x in labels])))


def judge(
    spark: SparkSession, pages: DataFrame, blocklist: DataFrame | None = None, url: str = "url", rules: tuple[Rule, ...] = RULES, host: str = "host"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the longest that fits, else null) and ``verdict``.

    Without a rule, the hosts of ``blocklist`` (its column ``host``, A-Z lower-cased; only the very host, not its
    subdomains) are blocked and others allowed; membership comes from a cascade over all hosts of ``pages`` and the
    list. The list may be of any size, hold repeated, null and unused hosts, or be empty; None lists the
    ``labelled_hosts``. Input columns of ``pages`` with those names are replaced. Null urls have an empty host and
    path, no rule, and are allowed unless the empty host is listed. Repeated rows stay.
    """
    df = _with_host(pages, url)
    listing = labelled_hosts(pages, url) if blocklist is None else blocklist
    keys = listing.select(F.translate(F.col(host if blocklist is not None else "host"), UPPER, LOWER).alias("key"), F.lit(True).alias("listed"))
    cascades = build_cascades(spark, df.select(F.col("host").alias("key"), F.lit(False).alias("listed")).unionByName(keys))
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    df = listed(spark, df, "host", cascades, "\x01listed").withColumn("rule", name)
    own = F.when(F.col("\x01listed"), F.lit("block")).otherwise(F.lit("allow"))
    return df.withColumn("verdict", F.coalesce(verdict, own)).drop("\x01listed")


def sql(rules: tuple[Rule, ...] = RULES, labels: tuple[str, ...] = LISTED_LABELS) -> str:
    """DuckDB SQL for the query's rows."""
    fits = {r.name: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in rules}
    longest = sorted(rules, key=lambda r: (-len(r.name), r.name))
    rule = "CASE " + " ".join(f"WHEN {fits[r.name]} THEN '{r.name}'" for r in longest) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits[r.name]} THEN '{r.verdict}'" for r in longest)
    names = ", ".join(f"'{x}'" for x in labels)
    return f"""
WITH a AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a
), c AS (
  SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b
)
SELECT page_id, host, path, {rule} AS rule,
  {verdict} WHEN list_has_any(string_split(host, '.'), [{names}]) THEN 'block' ELSE 'allow' END AS verdict
FROM c"""
