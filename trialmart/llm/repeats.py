"""Removal of windows that an earlier document has: the Spark side, shared by words and bytes.

A window is ``WINDOW`` consecutive units (bytes or words) of one document; it
goes if its content also starts in a document with a smaller id.  The steps:

1.  Equal texts: the smallest id of each text represents it; every other copy
    of at least ``WINDOW`` units is covered whole.  (A map-side combined
    ``min`` per text digest.)
2.  Every window has a minimiser, the smallest hash of its ``gram``-unit
    pieces.  Equal windows have equal minimisers, so only minimisers that two
    documents have can matter.  Each document sends its distinct ones to hash
    buckets, 4 bytes each, which send back those that are shared.
3.  Runs of consecutive windows with the same, shared, minimiser travel as one
    packed string to the minimiser's bucket.
4.  A bucket sorts the windows of its distinct strings exactly (the two
    operators differ here), takes the smallest id of each window and returns
    the covered stretches.
5.  The stretches meet their documents again.

The documents are dealt by a hash of id and text into groups of some
``GROUP_BYTES``, so neither a frequent id nor missing ids fill a group: rows
without an id are never covered and don't take part, and if rows repeat id and
text, each such pair takes part once (reduced map-side) and its result is joined
to the rows, a join that Spark can split.  Steps 2, 3 and 5 read one and the same
exchange.  Everything else that moves is packed in rows
of arrays per group or bucket, and its volume follows the input.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytes_ import NOT_SPACE, U64, mix, prefix_hash, ragged, slices, span_hash, text_view, tokens
from .spark_ import shuffle_parts

WINDOW = 50
#: Text bytes of one group of documents, and of the text whose windows one bucket gets.
GROUP_BYTES = 2 << 20
#: Minimisers per bucket of step 2.
FINGERPRINTS = 1 << 20

LINKS = T.StructType().add("_dp", "long").add("_kind", "integer").add("_id", "long").add("_data", "binary")
BUCKET = T.StructType().add("_bucket", "long").add("_data", "binary")


def pack(*arrays: np.ndarray) -> bytes:
    head = struct.pack(f"<B{len(arrays)}q", len(arrays), *(a.nbytes for a in arrays))
    return zstandard.compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), 1)


def unpack(data: bytes, *types: type) -> list[np.ndarray]:
    data = zstandard.decompress(data)
    sizes = struct.unpack_from(f"<{len(types)}q", data, 1)
    at, out = 1 + 8 * len(types), []
    for size, kind in zip(sizes, types):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


class Units:
    """The units of a run of texts and the hashes of their ``gram``-unit pieces."""

    def __init__(self, column: pa.Array, kind: str, gram: int):
        raw, offs = text_view(column)
        if kind == "byte":
            self.raw, self.counts = raw, np.diff(offs)
            n = max(0, len(raw) - gram + 1)
            at = np.arange(n)
            self.hashes = span_hash(prefix_hash(raw), at, at + gram) if n else np.zeros(0, U64)
            self.starts = self.ends = None
        else:
            starts, ends, self.counts = tokens(raw, offs, NOT_SPACE)
            words = span_hash(prefix_hash(raw), starts, ends)
            n = max(0, len(words) - gram + 1)
            h = np.zeros(n, U64)
            with np.errstate(over="ignore"):
                for t in range(gram):
                    h = h * U64(0x9E3779B97F4A7C15) + words[t: t + n]
            self.hashes = mix(h)
            lens = ends - starts  # the words again, one blank between any two
            self.starts = np.cumsum(lens + 1) - lens - 1
            self.ends = self.starts + lens
            self.raw = np.full(int((lens + 1).sum()), 0x20, np.uint8)
            self.raw[ragged(self.starts, lens)] = raw[ragged(starts, lens)]
        self.gram = gram

    def runs(self) -> tuple[np.ndarray, ...]:
        """(text, first window, windows, minimiser) of maximal runs of windows with one minimiser."""
        total, ends = int(self.counts.sum()), np.cumsum(self.counts)
        span = WINDOW - self.gram + 1
        windows = np.maximum(self.counts - WINDOW + 1, 0)
        if not windows.sum():
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),)
        low, have = self.hashes, 1
        while have < span:  # minimum over 2, 4, 8 ... pieces, then the rest
            step = min(have, span - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        starts = ragged(ends - self.counts, windows)
        owner = np.repeat(np.arange(len(windows)), windows)
        value = low[starts]
        fresh = np.ones(len(value), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(fresh)
        return owner[first], starts[first], np.diff(np.append(first, len(value))), value[first]

    def span(self, first: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, byte length of each) of stretches of units."""
        if self.starts is None:
            return self.raw[ragged(first, units)], units
        size = self.ends[first + units - 1] - self.starts[first]
        return self.raw[ragged(self.starts[first], size)], size


def _tag(text: bytes) -> int:
    return struct.unpack("<q", hashlib.sha256(text).digest()[:8])[0]


def _rows_of(left: pa.Table) -> tuple[list, list[bytes]]:
    raw, offs = text_view(left.column("_text"))
    data = raw.tobytes()
    return left.column("_id").to_pylist(), [data[a:b] for a, b in zip(offs, offs[1:])]


def _representatives(left: pa.Table, right: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Rows of the left side that stand for their text, once each, with their ids and tags."""
    reps = {(i, d) for k, i, d in zip(*(right.column(c).to_pylist() for c in ("_kind", "_id", "_data"))) if k == 0}
    keep, ids, tags = [], [], []
    for row, (i, text) in enumerate(zip(*_rows_of(left))):
        digest = hashlib.sha256(text).digest()
        if (i, digest) in reps:
            reps.discard((i, digest))
            keep.append(row), ids.append(i), tags.append(struct.unpack("<q", digest[:8])[0])
    return left.take(pa.array(keep, pa.int64())), np.array(ids, np.int64), np.array(tags, np.int64)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    edge = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])) if len(order) else []
    for a, b in zip(edge, [*edge[1:], len(order)]):
        yield int(bucket[order[a]]), order[a:b]


def _table(schema: T.StructType, rows: list[tuple]) -> pa.Table:
    kinds = {"long": pa.int64(), "integer": pa.int32(), "binary": pa.binary()}
    kinds = [kinds[{"bigint": "long", "int": "integer"}.get(f.dataType.simpleString(), f.dataType.simpleString())] for f in schema]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """(bucket, packed rows) of a partition that is sorted by bucket, one bucket at a time."""
    rows = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    for bucket, group in groupby(rows, key=lambda r: r[0]):
        yield bucket, [data for _, data in group]


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _group(id_: str, digest: str | Column, groups: int) -> Column:
    return F.pmod(F.xxhash64(id_, digest), F.lit(groups))


def deal_groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the group ``_dp`` that a worker handles at once."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return docs.withColumn("_dp", _group(id_col, _digest(text_col), total // GROUP_BYTES + 1))


def find_repeats(docs: DataFrame, *, kind: str, gram: int, classes: Callable[[np.ndarray, np.ndarray], tuple],
                 finish: Callable, out: T.StructType, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """Run the steps above.

    ``classes(raw, sizes)`` gets the distinct strings of a bucket (bytes and
    byte lengths) and returns (windows per string, class of every window);
    equal windows have equal classes.  ``finish(text, covered)`` turns a text
    and its covered unit ranges (None: all) into the values of ``out``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), F.struct(*keep).alias("_row"))
    named, nameless = rows.where("_id is not null"), rows.where("_id is null")
    row = T.StructType([rows.schema["_row"]])

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros((0, 2), np.int64)
        for part in slices(batches, "_text"):
            raw, offs = text_view(part.column(0))
            data = raw.tobytes()
            yield _results([finish(data[a:b], none) for a, b in zip(offs, offs[1:])], part.column(1), "_row", out)

    whole = nameless.select("_text", "_row").mapInArrow(untouched, T.StructType([*row, *out])).select("_row.*", *out.names)
    keyed = named.withColumn("_digest", _digest("_text"))
    repeated = not keyed.groupBy("_id", "_digest").count().where("count > 1").isEmpty()
    if not repeated:
        found = _covered(named, kind=kind, gram=gram, classes=classes, finish=finish, out=out)
        return found.select("_row.*", *out.names).unionByName(whole)
    once = (keyed.groupBy("_id", "_digest").agg(F.first("_text").alias("_text"))
            .select("_id", "_text", F.struct("_id", "_digest").alias("_row")))
    found = _covered(once, kind=kind, gram=gram, classes=classes, finish=finish, out=out)
    found = found.select(F.col("_row._id").alias("_i"), F.col("_row._digest").alias("_d"), F.struct(*out.names).alias("_found"))
    met = (keyed.select("_id", "_digest", "_row")
           .join(found, (F.col("_id") == F.col("_i")) & (F.col("_digest") == F.col("_d"))))
    return met.select("_row.*", "_found.*").unionByName(whole)


def _results(values: list[tuple], carried: pa.Array, name: str, out: T.StructType) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    columns = list(zip(*values)) or [()] * len(out)
    return pa.RecordBatch.from_arrays([carried, *(pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, out))],
                                      names=[name, *out.names])


def _covered(rows: DataFrame, *, kind: str, gram: int, classes: Callable, finish: Callable, out: T.StructType) -> DataFrame:
    """(``_row``, values of ``out``) of the rows (``_id``, ``_text``, ``_row``), whose ids are not null."""
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    parts = max(shuffle_parts(spark), total // (64 << 20))
    buckets = max(parts, total // GROUP_BYTES)
    thirds = max(parts, int(total * 2 / (WINDOW - gram + 2)) // FINGERPRINTS)
    groups = total // GROUP_BYTES + 1
    dealt = rows.select(_group("_id", _digest("_text"), groups).alias("_dp"), "_id", "_text", "_row")
    reps = (rows.select("_id", _digest("_text").alias("_data")).groupBy("_data").agg(F.min("_id").alias("_id"))
            .select(_group("_id", "_data", groups).alias("_dp"), F.lit(0).alias("_kind"), "_id", "_data"))

    def meet(right: DataFrame, step: Callable, schema: T.StructType) -> DataFrame:
        return dealt.groupBy("_dp").cogroup(right.groupBy("_dp")).applyInArrow(step, schema)

    def spread(packed: DataFrame) -> DataFrame:
        return packed.repartition(parts, "_bucket").sortWithinPartitions("_bucket")

    def group_of(left: pa.Table, right: pa.Table) -> np.ndarray:
        return np.array([(left if left.num_rows else right).column("_dp")[0].as_py()], np.int64)

    def send_minimisers(left: pa.Table, right: pa.Table) -> pa.Table:
        here = group_of(left, right)
        left, ids, _ = _representatives(left, right)
        text, _, _, low = Units(left.column("_text"), kind, gram).runs()
        order = np.lexsort((low, text))
        text, low = text[order], low[order]
        fresh = np.ones(len(low), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (low[1:] != low[:-1])
        text, low = text[fresh], low[fresh]
        sent = []
        for bucket, pick in _by_bucket((low >> U64(32)) % U64(thirds)):
            who, count = np.unique(text[pick], return_counts=True)
            sent.append((bucket, pack(ids[who], count.astype(np.int32), low[pick].astype(np.uint32), here)))
        return _table(BUCKET, sent)

    def shared_minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, packed in _streams(batches):
            pieces = [unpack(p, np.int64, np.int32, np.uint32, np.int64) for p in packed]
            who = np.concatenate([np.repeat(ids, n) for ids, n, _, _ in pieces])
            low = np.concatenate([low for _, _, low, _ in pieces])
            home = np.concatenate([np.full(len(low), at[0]) for _, _, low, at in pieces])
            order = np.lexsort((who, low))
            who, low, home = who[order], low[order], home[order]
            edge = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
            many = np.diff(np.append(edge, len(low)))
            two = who[edge] != who[edge + many - 1]
            hit = np.repeat(two, many)
            who, code, home = who[hit], low[hit].astype(U64) | U64(bucket << 32), home[hit]
            rows_ = []
            for dp, pick in _by_bucket(home):
                pick = pick[np.argsort(who[pick], kind="stable")]
                ids, n = np.unique(who[pick], return_counts=True)
                rows_.append((dp, 1, None, pack(ids, n.astype(np.int32), code[pick])))
            if rows_:
                yield _table(LINKS, rows_).combine_chunks().to_batches()[0]

    def send_strings(left: pa.Table, right: pa.Table) -> pa.Table:
        here = group_of(left, right)
        left, ids, tags = _representatives(left, right)
        known = [unpack(d, np.int64, np.int32, U64)
                 for k, d in zip(right.column("_kind").to_pylist(), right.column("_data").to_pylist()) if k == 1]
        if not known:
            return _table(BUCKET, [])
        known = np.concatenate([mix(code ^ mix(np.repeat(who, n).view(U64))) for who, n, code in known])
        units = Units(left.column("_text"), kind, gram)
        text, first, windows, low = units.runs()
        code = low & U64(0xFFFFFFFF) | ((low >> U64(32)) % U64(thirds)) << U64(32)
        hit = np.isin(mix(code ^ mix(ids[text].view(U64))), known)
        text, first, windows, low = text[hit], first[hit], windows[hit], low[hit]
        begin = (np.cumsum(units.counts) - units.counts)[text]
        sent = []
        for bucket, pick in _by_bucket(mix(low, 3) % U64(buckets)):
            raw, size = units.span(first[pick], windows[pick] + WINDOW - 1)
            sent.append((bucket, pack(ids[text[pick]], tags[text[pick]], first[pick] - begin[pick],
                                      size.astype(np.int64), raw, here)))
        return _table(BUCKET, sent)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, packed in _streams(batches):
            pieces = [unpack(p, np.int64, np.int64, np.int64, np.int64, np.uint8, np.int64) for p in packed]
            home = np.concatenate([np.full(len(p[0]), p[5][0]) for p in pieces])
            ids, tags, first, size = (np.concatenate([p[k] for p in pieces]) for k in range(4))
            raw = np.concatenate([p[4] for p in pieces])
            offsets = np.concatenate([[0], np.cumsum(size)])
            strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
            coded = strings.dictionary_encode()
            which = coded.indices.to_numpy()
            raw, offs = text_view(coded.dictionary)
            owner = np.full(len(offs) - 1, np.iinfo(np.int64).max)
            np.minimum.at(owner, which, ids)
            last = np.full(len(offs) - 1, np.iinfo(np.int64).min)
            np.maximum.at(last, which, ids)
            windows, group = classes(raw, np.diff(offs))
            least = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, group, np.repeat(owner, windows))
            least = least[group]
            begin = np.cumsum(windows) - windows
            late = np.flatnonzero(ids > np.minimum.reduceat(least, begin)[which])  # strings with a covered window
            at = ragged(begin[which[late]], windows[which[late]])
            string = np.repeat(late, windows[which[late]])
            gone = least[at] < ids[string]
            place = (first[string] + ragged(np.zeros(len(late), np.int64), windows[which[late]]))[gone]
            string = string[gone]
            if not len(string):
                continue
            fresh = np.ones(len(string), bool)
            fresh[1:] = (string[1:] != string[:-1]) | (place[1:] != place[:-1] + 1)
            a = np.flatnonzero(fresh)
            b = np.append(a[1:], len(string)) - 1
            who, tag, low, high = ids[string[a]], tags[string[a]], place[a], place[b] + WINDOW
            rows_ = [(dp, 2, None, pack(who[pick], tag[pick], low[pick], high[pick])) for dp, pick in _by_bucket(home[string[a]])]
            yield _table(LINKS, rows_).combine_chunks().to_batches()[0]

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds, reps_, data = (right.column(c).to_pylist() for c in ("_kind", "_id", "_data"))
        standing = {(i, d) for k, i, d in zip(kinds, reps_, data) if k == 0}
        found = [unpack(d, np.int64, np.int64, np.int64, np.int64) for k, d in zip(kinds, data) if k == 2]
        ranges: dict[tuple[int, int], np.ndarray] = {}
        if found:
            who, tag, low, high = (np.concatenate([f[k] for f in found]) for k in range(4))
            order = np.lexsort((low, tag, who))
            who, tag, low, high = who[order], tag[order], low[order], high[order]
            edge = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (tag[1:] != tag[:-1])))
            for a, b in zip(edge, [*edge[1:], len(who)]):
                ranges[int(who[a]), int(tag[a])] = merged(low[a:b], high[a:b])
        none = np.zeros((0, 2), np.int64)
        values = []
        for i, text in zip(*_rows_of(left)):
            digest = hashlib.sha256(text).digest()
            if (i, digest) not in standing:
                covered = None
            else:
                covered = ranges.get((i, struct.unpack("<q", digest[:8])[0]), none)
            values.append(finish(text, covered))
        return pa.Table.from_batches([_results(values, left.column("_row").combine_chunks(), "_row", out)])

    shared = spread(meet(reps, send_minimisers, BUCKET)).mapInArrow(shared_minimisers, LINKS)
    strings = meet(reps.union(shared), send_strings, BUCKET)
    stretches = spread(strings).mapInArrow(cover, LINKS)
    full = T.StructType([T.StructField("_row", rows.schema["_row"].dataType), *out])
    return meet(reps.union(stretches), apply, full)


def merged(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Union of ranges sorted by their low end; ranges that touch become one."""
    reach = np.maximum.accumulate(high)
    fresh = np.append(True, low[1:] > reach[:-1])
    start = np.flatnonzero(fresh)
    return np.stack([low[start], reach[np.append(start[1:], len(low)) - 1]], 1)
