"""URL filter: host rules, and a Bloom filter cascade for the urls that no rule decides.

The key universe is every distinct host of the pages. Keys go to shards by hash; each shard's cascade is built by one
task of bounded size: level 1 holds the listed keys, level 2 the unlisted keys that level 1 lets through, level 3 the
listed keys that level 2 lets through, and so on until nothing passes wrongly. A key is judged by the first level
that doesn't hold it, so membership is exact for every key of the universe, by bit tests, without a join.

The cascades take about 1.44 log2(unlisted / listed) + 4 bits per listed key. Up to ``max_bytes`` (measured before)
they are broadcast; beyond it each shard's distinct hosts are judged beside its cascade and the verdicts are joined.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule, and its empty host is
a key like any other; null and repeated page_ids are kept; other columns are ignored; an empty table gives no rows;
an empty list gives empty cascades, which hold nothing.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, stage
from .textnum import mix

#: (verdict, host, path): fixed by the contract.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Hosts with one of these labels are listed for blocking.
LISTED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
KEYS_PER_SHARD = 200_000
MAX_BYTES = 64 << 20
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    whole = F.regexp_extract(rest, r"^[^?#]*", 0)
    host = F.substring_index(whole, "/", 1)
    return F.translate(host, *_LOWER), F.substr(whole, F.length(host) + 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):   # a longer rule is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _bits(h1: np.ndarray, h2: np.ndarray, level: int, m: int, k: int) -> np.ndarray:
    a = mix(h1 + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    b = mix(h2 ^ a) | np.uint64(1)
    return np.stack([(a + b * np.uint64(i)) % np.uint64(m) for i in range(k)])


def build_cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> bytes:
    """Levels of one shard: per level the size in bits (u64), the number of hashes (u32), the bits."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    out, level = [], 0
    while len(inside):
        level += 1
        p = min(0.5, max(1e-9, len(inside) * math.sqrt(0.5) / max(1, len(outside)))) if level == 1 else 0.5
        k = max(1, math.ceil(math.log2(1 / p)))
        m = max(64, math.ceil(len(inside) * k / math.log(2)))
        filled = np.zeros(m, bool)
        filled[_bits(h1[inside], h2[inside], level, m, k).ravel()] = True
        out.append(struct.pack("<QI", m, k) + np.packbits(filled).tobytes())
        passed = outside[filled[_bits(h1[outside], h2[outside], level, m, k)].all(axis=0)]
        inside, outside = passed, inside   # the next level holds what this one lets through wrongly
    return b"".join(out)


def parse_cascade(data: bytes) -> list[tuple[int, int, np.ndarray]]:
    out, at = [], 0
    while at < len(data):
        m, k = struct.unpack_from("<QI", data, at)
        size = -(-m // 8)
        out.append((m, k, np.frombuffer(data, np.uint8, size, at + 12)))
        at += 12 + size
    return out


def in_cascade(levels: list[tuple[int, int, np.ndarray]], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed (exact for the keys that the cascade was built over)."""
    listed = np.full(len(h1), len(levels) % 2 == 1)   # a key that all levels hold
    open_ = np.arange(len(h1))
    for level, (m, k, bits) in enumerate(levels, 1):
        at = _bits(h1[open_], h2[open_], level, m, k)
        held = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1).all(axis=0)
        listed[open_[~held]] = level % 2 == 0
        open_ = open_[held]
    return listed


def _hashed(df: DataFrame, shards: int) -> DataFrame:
    return (df.withColumn("h1", F.xxhash64(F.lit(1), "host")).withColumn("h2", F.xxhash64(F.lit(2), "host"))
            .withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "host"), F.lit(shards)).cast("int")))


def cascades(universe: DataFrame, shards: int) -> DataFrame:
    """(shard, data) of ``universe`` (distinct host, listed)."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        data = build_cascade(pdf["h1"].to_numpy().view(np.uint64), pdf["h2"].to_numpy().view(np.uint64),
                             pdf["listed"].to_numpy(bool))
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1].astype("int32"), "data": [data]})

    return _hashed(universe, shards).select("shard", "h1", "h2", "listed").groupBy("shard").applyInPandas(
        build, "shard int, data binary")


def judge(pages: DataFrame, listed: DataFrame, keys_per_shard: int = KEYS_PER_SHARD,
          max_bytes: int = MAX_BYTES) -> DataFrame:
    """``pages`` (with a ``host``) and the column ``listed``: whether the cascade holds the host. ``listed`` (host):
    the keys to hold."""
    spark = pages.sparkSession
    mark = listed.select("host").distinct().withColumn("listed", F.lit(True))
    universe = pages.select("host").unionByName(listed.select("host")).distinct()
    universe = stage(universe.join(mark, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False))), "op5-keys")
    shards = max(1, -(-universe.count() // keys_per_shard))
    built = stage(cascades(universe, shards), "op5-cascades")
    size = built.agg(F.coalesce(F.sum(F.length("data")), F.lit(0)).alias("n")).first()["n"]
    if size > max_bytes:
        def beside(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            hit = in_cascade(parse_cascade(right["data"].iloc[0]), left["h1"].to_numpy().view(np.uint64),
                             left["h2"].to_numpy().view(np.uint64))
            return pd.DataFrame({"host": left["host"], "listed": hit})

        verdicts = (_hashed(universe.select("host"), shards).groupBy("shard").cogroup(built.groupBy("shard"))
                    .applyInPandas(beside, "host string, listed boolean"))
        verdicts = verdicts.withColumnRenamed("host", "_host")
        return pages.join(verdicts, pages["host"].eqNullSafe(verdicts["_host"])).drop("_host")

    shared = spark.sparkContext.broadcast({r["shard"]: bytes(r["data"]) for r in built.collect()})   # <= max_bytes
    keyed = _hashed(pages, shards)
    schema = T.StructType([*pages.schema.fields, T.StructField("listed", T.BooleanType())])
    names = pages.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = {k: parse_cascade(v) for k, v in shared.value.items()}
        for b in batches:
            h1, h2 = (b.column(b.schema.get_field_index(c)).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            shard = b.column(b.schema.get_field_index("shard")).to_numpy()
            hit = np.zeros(len(shard), bool)
            for s in np.unique(shard):
                at = np.flatnonzero(shard == s)
                hit[at] = in_cascade(levels[s], h1[at], h2[at])
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(hit)],
                                             [*names, "listed"])

    return keyed.mapInArrow(run, schema)


def listed_hosts(hosts: DataFrame, labels=LISTED_LABELS) -> DataFrame:
    """The hosts (host) that have one of ``labels`` between dots."""
    return hosts.select("host").distinct().where(F.arrays_overlap(F.split("host", "\\."), F.array(*map(F.lit, labels))))


def op5_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = read(spark, sf_dir, "pages").select("page_id", "url")
    host, path = host_and_path(F.col("url"))
    pages = url.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    return judge(pages, listed_hosts(pages)).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


_FITS = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
_CASES = [(_FITS.format(h=h, p=p), h + p, v) for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
ORACLE = f"""
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
w AS (SELECT page_id, regexp_extract(rest, '^[^?#]*', 0) AS whole FROM r),
h AS (SELECT page_id, split_part(whole, '/', 1) AS raw, whole FROM w),
p AS (SELECT page_id, translate(raw, '{_LOWER[0]}', '{_LOWER[1]}') AS host, substr(whole, length(raw) + 1) AS path FROM h)
SELECT page_id, host, path, CASE {' '.join(f"WHEN {c} THEN '{r}'" for c, r, _ in _CASES)} END AS rule,
       CASE {' '.join(f"WHEN {c} THEN '{v}'" for c, _, v in _CASES)}
            WHEN list_has_any(string_split(host, '.'), {list(LISTED_LABELS)}) THEN 'block' ELSE 'allow' END AS verdict
FROM p
"""
