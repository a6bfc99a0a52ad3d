"""URL filters: a blocked Bloom filter in front of an exact hash join.

The list holds canonical entries ``host/path``. A URL is judged by every entry it
could match: each suffix of its host at a dot (the host itself included) joined
with each prefix of its path whose length occurs in the list. The blocked Bloom
filter (one 64-bit block per key, ``BITS`` bits set in it) is an aggregate of the
listed keys; candidates look up their block and only those whose bits are all set
go to the exact join on the key, which removes the false positives. The longest
entry that joins gives the verdict; a URL that no entry matches gets ``default``.

All DataFrame expressions. Before the filter the distinct (host, path) pairs are
taken, so a host with a third of all rows costs its distinct paths. The Bloom
blocks are sent to all executors only while their counted size is at most
``BROADCAST_BYTES``; larger lists meet the candidates in equality joins, which AQE
splits where a key is hot.

Defined results: a null URL or one without ``://`` has an empty host and path,
matches no entry, and gets ``default``; an empty host matches nothing; repeated
rows are judged alike; repeated entries count once (of two verdicts for the same
entry, ``block`` holds); an empty list lets every URL take ``default``; other
columns of the input are kept, with ``host path rule verdict`` replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits set per key, and Bloom bits per listed key (false positives about 1 in 200).
BITS = 5
BITS_PER_KEY = 16
#: The largest filter or list that is broadcast.
BROADCAST_BYTES = 8 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(name: str) -> Column:
    return F.xxhash64(F.col(name))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(key, F.lit(blocks).cast("bigint"))


def _bits(key: Column) -> Column:
    """The bits of a key inside its block, from a second hash of it."""
    h = F.xxhash64(key, F.lit(1))
    out = None
    for i in range(BITS):
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                              F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def bloom_blocks(entries: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of the listed keys, one row per non-empty block."""
    return entries.select(_block(F.col("key"), blocks).alias("block"), _bits(F.col("key")).alias("b")) \
        .groupBy("block").agg(F.bit_or("b").alias("bits"))


def candidates(pairs: DataFrame, lengths: list[int]) -> DataFrame:
    """(host, path, entry, key): every listed form that could match a (host, path)."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(F.col("_labels"), i, F.size("_labels")), "."))
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    out = (pairs.where("host <> ''").withColumn("_labels", labels).withColumn("_suffix", F.explode(suffixes))
           .withColumn("_n", F.explode(fits))
           .withColumn("entry", F.concat("_suffix", F.expr("substring(path, 1, _n)"))))
    return out.select("host", "path", "entry", _key("entry").alias("key"))


def url_filter(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule and verdict. ``rules`` has ``entry`` (``host/path``)
    and ``verdict`` (``allow`` or ``block``)."""
    listed = (rules.where("entry IS NOT NULL").groupBy("entry").agg(F.max("verdict").alias("verdict"))
              .withColumn("key", _key("entry")))
    facts = listed.agg(F.count("*").alias("n"), F.sum(F.length("entry") + 40).alias("bytes")).first()
    named = df.drop("host", "path", "rule", "verdict") \
        .withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    if not facts["n"]:
        return named.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    # path lengths of the entries: at most as many values as a URL has characters
    path = F.expr("substring(entry, instr(entry, '/'))")
    lengths = sorted(r["n"] for r in listed.where("instr(entry, '/') > 0").select(F.length(path).alias("n"))
                     .distinct().collect())
    blocks = max(1, facts["n"] * BITS_PER_KEY // 64)
    bloom = bloom_blocks(listed, blocks)
    small = blocks * 24 <= BROADCAST_BYTES and facts["bytes"] <= BROADCAST_BYTES
    sent = F.broadcast if small else (lambda d: d)
    pairs = named.select("host", "path").distinct()
    possible = (candidates(pairs, lengths).withColumn("block", _block(F.col("key"), blocks))
                .join(sent(bloom), "block").where(F.col("bits").bitwiseAND(_bits(F.col("key"))) == _bits(F.col("key"))))
    exact = possible.join(sent(listed.select("key", "entry", "verdict")), ["key", "entry"])
    best = exact.groupBy("host", "path").agg(
        F.max(F.struct(F.length("entry").alias("n"), "entry", "verdict")).alias("_best"))
    # a left join of the rows on (host, path): both columns together are near-unique keys
    return (named.join(best, ["host", "path"], "left")
            .withColumn("rule", F.col("_best.entry"))
            .withColumn("verdict", F.coalesce("_best.verdict", F.lit(default))).drop("_best"))
