"""Allow and block rules for URLs, looked up in a sorted array of digests.

The rules' keys (host and path) become 64-bit xxhash digests, sorted, with the full strings
beside them, in one file. Spark ships the file to every executor, whose Python workers map it
into memory, so a list costs its pages once per machine. A batch of URLs gives all its candidate
keys at once: every parent domain of the host with every prefix of the path that is as long as
some rule's path. One vectorised binary search finds the digests, and a digest that is found
counts only if the stored strings are equal too.

A file is shipped only up to ``MAX_RULES`` rules, whose size is bounded. A longer list is dealt
out by ranges of the digest, each with its own sorted array in the task that holds the range, and
the URLs' distinct candidate keys go to the task of their digest.

Defined results: a null URL, or one without ``://``, has empty host and path and no rule; where
no rule fits, the list does not hold the URL and it is allowed. The longest rule wins (host and
path together, then the longer host); of repeated rules with different verdicts "block" wins.
Repeated rows are judged alike; empty tables give empty tables.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.shared import Tables, shared_dir

MAX_RULES = 2_000_000
MAX_KEY_BYTES = 64 << 20

# The seed that Spark's own xxhash64 has, so that both sides can make the digest.
DIGEST_SEED = 42

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEP = "\x00"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path by the rules above, as built-in expressions."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(_url, locate('://', _url) + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _packed(keyed: dict[bytes, bool], path_lengths: list[int]) -> bytes:
    """The digest file: counts, path lengths, sorted digests, string ends, verdicts, strings."""
    keys = list(keyed)
    digests = np.array([xxhash.xxh64_intdigest(k, DIGEST_SEED) for k in keys], dtype="<u8")
    order = np.argsort(digests, kind="stable")
    ends = np.cumsum([len(keys[i]) for i in order], dtype="<u8")
    blocks = np.array(list(keyed.values()), dtype="u1")[order]
    lengths = np.array(path_lengths, dtype="<u8")
    head = struct.pack("<QQ", len(keys), len(lengths))
    texts = b"".join(keys[i] for i in order)
    return head + lengths.tobytes() + digests[order].tobytes() + ends.tobytes() + blocks.tobytes() + texts


def _merged(rules: list[tuple[str, str, bool]]) -> bytes:
    """The file of all rules; of repeated ones a block counts."""
    keyed: dict[bytes, bool] = {}
    for host, path, block in rules:
        key = f"{host}{_SEP}{path}".encode()
        keyed[key] = keyed.get(key, False) or block
    return _packed(keyed, sorted({len(p.encode()) for _, p, _ in rules}))


class DigestArray:
    """Sorted digests over the bytes of a digest file, mapped or in memory."""

    def __init__(self, data: np.ndarray) -> None:
        n, lengths = struct.unpack("<QQ", data[:16].tobytes())
        parts, at = [], 16
        for count, kind in ((lengths, "<u8"), (n, "<u8"), (n, "<u8"), (n, "u1")):
            width = count * np.dtype(kind).itemsize
            parts.append(data[at : at + width].view(kind))
            at += width
        self.lengths, self.digests, self.ends, self.blocks = parts
        self.path_lengths = [int(x) for x in self.lengths]
        self.texts = data[at:]

    def probe(self, keys: list[bytes]) -> list[int | None]:
        """Per key the verdict found (1 block, 0 allow), or None."""
        found: list[int | None] = [None] * len(keys)
        if not keys or not len(self.digests):
            return found
        digests = (xxhash.xxh64_intdigest(k, DIGEST_SEED) for k in keys)
        wanted = np.fromiter(digests, dtype="u8", count=len(keys))
        first = np.searchsorted(self.digests, wanted)
        inside = first < len(self.digests)
        hits = np.flatnonzero(inside)[self.digests[first[inside]] == wanted[inside]]
        for i in hits.tolist():
            k = int(first[i])
            while k < len(self.digests) and self.digests[k] == wanted[i]:
                start = int(self.ends[k - 1]) if k else 0
                if self.texts[start : int(self.ends[k])].tobytes() == keys[i]:
                    found[i] = int(self.blocks[k])
                    break
                k += 1
        return found


@lru_cache(maxsize=4)
def _mapped(name: str) -> DigestArray:
    return DigestArray(np.memmap(SparkFiles.get(name), dtype="u1", mode="r"))


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[tuple[int, int, bytes]]:
    """(length of rule, length of host, key) for each rule that would fit."""
    if not host:
        return
    raw, at = path.encode(), 0
    prefixes = [raw[:n] for n in lengths if n <= len(raw)]
    while True:
        parent = host[at:].encode()
        for prefix in prefixes:
            yield len(parent) + len(prefix), len(parent), parent + _SEP.encode() + prefix
        dot = host.find(".", at)
        if dot < 0:
            return
        at = dot + 1


def _ship(spark: SparkSession, content: bytes) -> str:
    """Write the file to the shared folder and have every executor fetch it."""
    name = f"digests-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/weftline/{name}")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(content)
    out.close()
    spark.sparkContext.addFile(target.toString())
    return name


def _by_digest(urls: DataFrame, rules: list[tuple[str, str, bool]]) -> DataFrame:
    name = _ship(urls.sparkSession, _merged(rules))

    @F.pandas_udf("struct<rule string, block boolean>")
    def look_up(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        array = _mapped(name)
        keys, owners, ranks = [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            for total, in_host, key in candidates(host, path, array.path_lengths):
                keys.append(key)
                owners.append(i)
                ranks.append((total, in_host))
        best: dict[int, tuple[tuple[int, int], bytes, int]] = {}
        for key, owner, rank, block in zip(keys, owners, ranks, array.probe(keys), strict=True):
            if block is not None and (owner not in best or rank > best[owner][0]):
                best[owner] = (rank, key, block)
        rule = [best[i][1].decode().replace(_SEP, "", 1) if i in best else None for i in range(len(hosts))]
        block = [bool(best[i][2]) if i in best else None for i in range(len(hosts))]
        return pd.DataFrame({"rule": pd.Series(rule, dtype=object), "block": pd.Series(block, dtype=object)})

    return urls.withColumn("_found", look_up("host", "path"))


def _by_range(urls: DataFrame, rules: DataFrame, range_bytes: int) -> DataFrame:
    """The same with the digests dealt out by range: distinct keys meet the rules of their range."""
    tables = Tables(urls.sparkSession)
    lengths = rules.select(F.octet_length("path").alias("n")).distinct()
    # Distinct lengths are bounded by the longest path, not by the number of rules.
    widths = sorted(r["n"] for r in lengths.collect())
    weight = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 32)).first()[0]
    parts = max(1, -(-(weight or 0) // range_bytes))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, totals, in_hosts, keys = [], [], [], []
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                for total, in_host, key in candidates(host, path, widths):
                    rows.append(i)
                    totals.append(total)
                    in_hosts.append(in_host)
                    keys.append(key)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host").take(at),
                    batch.column("path").take(at),
                    pa.array(totals, pa.int32()),
                    pa.array(in_hosts, pa.int32()),
                    pa.array(keys, pa.binary()),
                ],
                names=["host", "path", "total", "in_host", "key"],
            )

    # Spark's xxhash64 is the digest of these bytes; its upper bits, unsigned, are its range.
    def ranged(df: DataFrame) -> DataFrame:
        top = F.shiftrightunsigned(F.xxhash64("key"), 33)
        return df.withColumn("part", F.shiftright(top * F.lit(parts), 31))

    pairs = urls.select("host", "path").distinct()
    kinds = "host string, path string, total int, in_host int, key binary"
    wanted = tables.cut(pairs.mapInArrow(asked, kinds), "candidates")
    key = F.encode(F.concat("host", F.lit(_SEP), "path"), "UTF-8")
    blocked = F.max(F.col("verdict") == "block").alias("block")
    unique = rules.groupBy(key.alias("key")).agg(blocked)

    def probe(questions: pa.Table, held: pa.Table) -> pa.Table:
        keyed = dict(zip(held.column("key").to_pylist(), held.column("block").to_pylist(), strict=True))
        keys = questions.column("key").to_pylist()
        array = DigestArray(np.frombuffer(_packed(keyed, widths), "u1"))
        found = [(k, bool(block)) for k, block in zip(keys, array.probe(keys), strict=True) if block is not None]
        return pa.table(
            {"key": pa.array([k for k, _ in found], pa.binary()), "block": pa.array([b for _, b in found], pa.bool_())}
        )

    questions = ranged(wanted.select("key").distinct()).groupBy("part")
    found = questions.cogroup(ranged(unique).groupBy("part")).applyInArrow(probe, "key binary, block boolean")
    found = tables.cut(found, "found")
    rule = F.concat(
        F.decode(F.expr("substring(key, 1, in_host)"), "UTF-8"), F.decode(F.expr("substring(key, in_host + 2)"), "UTF-8")
    )
    best = F.max(F.struct("total", "in_host", rule.alias("rule"), "block"))
    judged = wanted.join(found, "key").groupBy("host", "path").agg(best.alias("_best"))
    judged = judged.select("host", "path", F.struct("_best.rule", "_best.block").alias("_found"))
    return urls.join(tables.cut(judged, "judged"), ["host", "path"], "left")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    max_rules: int = MAX_RULES,
    range_bytes: int = MAX_KEY_BYTES,
) -> DataFrame:
    """``(page, host, path, rule, verdict)``: every row of ``pages`` and what the rules say.

    ``rules`` is ``(host, path, verdict)``; ``page`` holds the columns of ``pages`` asked for.
    """
    page = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    rows = pages.select(page.alias("page"), F.col(url).alias("_url"))
    host, path = split_url(F.col("_url"))
    urls = rows.withColumns({"host": host, "path": path}).drop("_url")
    known = rules.where("host IS NOT NULL AND host <> '' AND path IS NOT NULL")
    weight = F.sum(F.octet_length("host") + F.octet_length("path"))
    n, weight = known.agg(F.count(F.lit(1)), F.coalesce(weight, F.lit(0))).first()
    if n <= max_rules and weight <= MAX_KEY_BYTES:
        listed = [(r["host"], r["path"], r["verdict"] == "block") for r in known.collect()]
        judged = _by_digest(urls, listed)
    else:
        judged = _by_range(urls, known, range_bytes)
    block = F.coalesce(F.col("_found.block"), F.lit(False))
    return judged.select(
        "page",
        "host",
        "path",
        F.col("_found.rule").alias("rule"),
        F.when(block, "block").otherwise("allow").alias("verdict"),
    )
