"""URL filter over a sorted digest array.

Rules are strings ``host/path`` with a verdict.  Their 64-bit xxhash keys are
sorted into one packed file image together with the full strings; every task
memory-maps that image and probes it for the keys a url can match (each host
suffix with each path prefix of a length that some rule has) by one vectorised
binary search per batch.  A key that hits is confirmed against the stored full
string, so hash collisions never decide.  The longest confirmed rule wins.

Defined cases: a null url, or one without ``://``, has empty host and path and
matches nothing; a rule without ``/`` fits every path of its host and subdomains;
repeated rules count once and, if their verdicts differ,
``block`` wins; null rules are ignored; no rules: every url gets the default.
"""

from __future__ import annotations

import mmap
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "host string, path string, rule string, verdict string"

#: Largest packed image that is broadcast; longer rule lists are probed by a join (same results).
MAX_IMAGE_BYTES = 64 << 20

_ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host up to ``/ ? #`` with A-Z lower-cased, path up to ``? #``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    for i, ch in enumerate(rest):
        if ch in "/?#":
            host, rest = rest[:i], rest[i:]
            break
    else:
        host, rest = rest, ""
    for mark in "?#":
        rest = rest.partition(mark)[0]
    return host.translate(_ASCII_LOWER), rest


def candidates(host: str, path: str, lengths: tuple[int, ...]) -> list[str]:
    """Every rule string that would fit: host suffixes at label borders x path prefixes, longest first."""
    if not host:
        return []
    parts = host.split(".")
    tails = [".".join(parts[i:]) for i in range(len(parts))]
    heads = [path[:n] for n in lengths if n <= len(path)]
    return sorted((t + h for t in tails for h in heads if t), key=lambda s: (-len(s), s))


def pack(rules: list[tuple[str, str]]) -> bytes:
    """Image of a rule list: header, sorted keys, string offsets, verdict bits, strings."""
    best: dict[str, bool] = {}
    for rule, verdict in rules:
        best[rule] = best.get(rule, False) or verdict == "block"
    rows = sorted((xxhash.xxh64_intdigest(r.encode()), r.encode(), b) for r, b in best.items())
    keys = np.array([k for k, _, _ in rows], np.uint64)
    offs = np.cumsum([0, *(len(r) for _, r, _ in rows)]).astype(np.int64)
    block = np.array([b for _, _, b in rows], np.uint8)
    lengths = np.unique([len(r.decode()) - len(r.decode().partition("/")[0]) for _, r, _ in rows]).astype(np.int64)  # of the paths, 0 without one
    return (struct.pack("<qq", len(rows), len(lengths)) + lengths.tobytes() + keys.tobytes()
            + offs.tobytes() + block.tobytes() + b"".join(r for _, r, _ in rows))


class DigestArray:
    """Read side of :func:`pack`, on a memory-mapped copy of the image."""

    def __init__(self, image: bytes):
        with tempfile.TemporaryFile() as file:  # no name is left behind; the map keeps the pages
            file.write(image)
            file.flush()
            self.map = mmap.mmap(file.fileno(), len(image), access=mmap.ACCESS_READ)
        n, m = struct.unpack_from("<qq", self.map)
        at = 16
        self.lengths = tuple(np.frombuffer(self.map, np.int64, m, at).tolist())
        self.keys = np.frombuffer(self.map, np.uint64, n, at := at + 8 * m)
        self.offs = np.frombuffer(self.map, np.int64, n + 1, at := at + 8 * n)
        self.block = np.frombuffer(self.map, np.uint8, n, at := at + 8 * (n + 1))
        self.text = at + n

    def find(self, strings: list[str]) -> np.ndarray:
        """Index of each string among the rules, -1 where it is none."""
        out = np.full(len(strings), -1, np.int64)
        if not len(self.keys) or not strings:
            return out
        raw = [s.encode() for s in strings]
        want = np.fromiter(map(xxhash.xxh64_intdigest, raw), np.uint64, len(raw))
        at = np.searchsorted(self.keys, want)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == want):
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == want[i]:  # equal keys lie side by side
                if self.map[self.text + self.offs[k]: self.text + self.offs[k + 1]] == raw[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def rule(self, k: int) -> str:
        return self.map[self.text + self.offs[k]: self.text + self.offs[k + 1]].decode()


def _parts(urls: pa.Array) -> tuple[list[str], list[str]]:
    pairs = [split_url(u) for u in urls.to_pylist()]
    return [h for h, _ in pairs], [p for _, p in pairs]


def url_filter(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", max_image_bytes: int = MAX_IMAGE_BYTES) -> DataFrame:
    """One row (id, host, path, rule, verdict) per row of ``pages``.

    ``rules`` has columns ``rule`` and ``verdict``.  Its size is measured first:
    up to ``max_image_bytes`` it is packed and broadcast, beyond that the
    candidate strings are joined with it by key and string.
    """
    spark = pages.sparkSession
    rules = rules.select("rule", "verdict").where("rule is not null").distinct()
    size = rules.agg(F.sum(F.octet_length("rule") + 32)).first()[0] or 0
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    id_type = rows.schema["_id"].dataType.simpleString()
    if size > max_image_bytes:
        return _by_join(rows, rules, default).withColumnRenamed("_id", id_col)
    image = spark.sparkContext.broadcast(pack([(r.rule, r.verdict) for r in rules.collect()]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestArray(image.value)
        for batch in batches:
            hosts, paths = _parts(batch.column(1))
            tried = [candidates(h, p, index.lengths) for h, p in zip(hosts, paths)]
            hit = index.find([c for cs in tried for c in cs])
            rule, verdict, at = [], [], 0
            for cs in tried:
                k = next((k for k in hit[at: at + len(cs)] if k >= 0), -1)
                at += len(cs)
                rule.append(index.rule(k) if k >= 0 else None)
                verdict.append(("block" if index.block[k] else "allow") if k >= 0 else default)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                 pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=["_id", "host", "path", "rule", "verdict"])

    return rows.mapInArrow(judge, f"_id {id_type}, {SCHEMA}").withColumnRenamed("_id", id_col)


def _by_join(rows: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same decision for rule lists of any size: candidates meet the rules in a shuffle join."""
    lower = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    known = (rules.groupBy("rule").agg(F.max(F.expr("verdict = 'block'")).alias("_block"))
             .withColumn("_key", F.xxhash64("rule")))
    lengths = known.select(F.length(F.substring_index("rule", "/", 1)).alias("h"), F.length("rule").alias("n"))
    lengths = [r.n for r in lengths.select((F.col("n") - F.col("h")).alias("n")).distinct().collect()]
    host = lower(F.coalesce(F.regexp_extract("_url", r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))
    path = F.coalesce(F.regexp_extract("_url", r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
    parsed = rows.withColumn("_row", F.monotonically_increasing_id()).select("_row", "_id", host.alias("host"), path.alias("path"))
    tails = F.expr("transform(sequence(1, size(split(host, '[.]'))), i -> array_join(slice(split(host, '[.]'), i, size(split(host, '[.]'))), '.'))")
    heads = F.filter(F.transform(F.array(*map(F.lit, sorted(lengths))),
                                 lambda n: F.when(n <= F.length("path"), F.substring("path", F.lit(1), n))),
                     lambda h: h.isNotNull())
    tried = (parsed.where("host <> ''").withColumn("_t", F.explode(tails)).where("_t <> ''")
             .withColumn("_h", F.explode(heads)).select("_row", F.concat("_t", "_h").alias("rule"))
             .withColumn("_key", F.xxhash64("rule")))
    best = (tried.join(known, ["_key", "rule"]).groupBy("_row")
            .agg(F.max_by(F.struct("rule", "_block"), F.struct(F.length("rule"), "rule")).alias("_b")))
    verdict = (F.when(F.col("_b").isNull(), default).when(F.col("_b._block"), "block").otherwise("allow"))
    return (parsed.join(best, "_row", "left")
            .select("_id", "host", "path", F.col("_b.rule").alias("rule"), verdict.alias("verdict")))
