"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= c lie within eps = sqrt(2 - 2c) of each other.
Vectors are rotated onto principal axes (fitted on a bounded sample; a rotation
keeps all distances, so it decides only the speed), and sorted per label and
vector length by the cells of an eps grid on the leading axes.  Vectors are
scaled by a power of two first, which is exact, so that no square of a tiny or
huge component under- or overflows.  The sorted sequence is cut into
blocks; two blocks whose boxes on the leading axes are more than eps apart hold
no pair and are skipped, and so are halves of blocks in the recursive join
inside a task.  What is left is compared exactly, in double precision.

Equal vectors of one label travel once with their count, so copies are never
paired.  A join task returns one row per vector and block pair (its links and a
root), never pairs.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite
components, or whose label or id is null, links with nothing and is kept;
vectors of different lengths never link, those of one length do, whatever other
lengths the label has; rows with the same vector are linked with each other, also
if the id repeats; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spark_ import components, cut, shuffle_parts

MIN_COSINE = 0.98
AXES = 8
BLOCK = 1024
LEAF = 128
SAMPLE = 2000


def _rows(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Every vector times the power of two that brings its largest component to [0.5, 1)."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(1))[:, None]


class _Axes:
    """Principal axes by vector length; a length that the sample lacks takes its first components."""

    def __init__(self, sample: list[list[float]], count: int):
        self.count, self.known = count, {}
        for width in {len(x) for x in sample}:
            self.known[width] = _axes(_unit(np.array([x for x in sample if len(x) == width])), min(count, width))

    def place(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of the vectors' directions on the leading axes."""
        width = x.shape[1]
        axes = self.known[width] if width in self.known else np.eye(width, min(self.count, width))
        return _unit(x) @ axes


def _axes(sample: np.ndarray, count: int) -> np.ndarray:
    centred = sample - sample.mean(0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    return np.ascontiguousarray(vectors[:, ::-1][:, :count])


def _apart(lo_a: np.ndarray, hi_a: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray) -> float:
    gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return float((gap * gap).sum())


class _Side:
    def __init__(self, raw: bytes, ids: bytes, copies: bytes, axes: _Axes):
        self.ids, self.copies = np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64)
        self.x = _scaled(np.frombuffer(raw, np.float64).reshape(len(self.ids), -1))
        self.norm = np.sqrt((self.x * self.x).sum(1))
        self.p = axes.place(self.x)
        self.links = np.zeros(len(self.ids), np.int64)
        self.root = self.ids.copy()


def _join(a: _Side, b: _Side, ra: slice, rb: slice, cosine: float, eps2: float) -> bool:
    """Links between two intervals of the sequences; True if a root changed."""
    pa_, pb = a.p[ra], b.p[rb]
    if _apart(pa_.min(0), pa_.max(0), pb.min(0), pb.max(0)) > eps2:
        return False
    na, nb = ra.stop - ra.start, rb.stop - rb.start
    if max(na, nb) > LEAF:
        halves = lambda r: [slice(r.start, (r.start + r.stop) // 2), slice((r.start + r.stop) // 2, r.stop)] if r.stop - r.start > LEAF else [r]
        same, changed = a is b and ra == rb, False
        for i, u in enumerate(halves(ra)):
            for j, v in enumerate(halves(rb)):
                if not same or i <= j:
                    changed |= _join(a, b, u, v, cosine, eps2)
        return changed
    close = a.x[ra] @ b.x[rb].T / (a.norm[ra, None] * b.norm[None, rb]) >= cosine
    if a is b and ra == rb:
        np.fill_diagonal(close, False)
    if not close.any():
        return False
    a.links[ra] += close @ b.copies[rb]
    if not (a is b and ra == rb):
        b.links[rb] += a.copies[ra] @ close
    i, j = np.nonzero(close)
    i, j = i + ra.start, j + rb.start
    low = np.minimum(a.root[i], b.root[j])
    changed = bool((low < a.root[i]).any() or (low < b.root[j]).any())
    np.minimum.at(a.root, i, low)
    np.minimum.at(b.root, j, low)
    return changed


def near_duplicate_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                           label_col: str = "label", cosine: float = MIN_COSINE, axes: int = AXES,
                           block: int = BLOCK) -> DataFrame:
    """One row (id, n_links, component_id, kept) per row of ``vectors``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).alias("_label"),
                          F.col(vector_col).cast("array<double>").alias("_x"))
    sane = (F.col("_id").isNotNull() & F.col("_label").isNotNull() & F.col("_x").isNotNull() & (F.size("_x") > 0)
            & F.forall("_x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            & F.exists("_x", lambda v: v != 0))
    sane = F.coalesce(sane, F.lit(False))
    good = rows.where(sane)
    distinct = (good.groupBy("_label", "_x").agg(F.min("_id").alias("_rep"), F.count("*").alias("_copies"))
                .select("_label", F.size("_x").alias("_w"), "_x", "_rep", "_copies"))
    sample = good.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE).select("_x").collect()
    axis = _Axes([r["_x"] for r in sample], axes)
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9
    shared = spark.sparkContext.broadcast(axis)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(1).to_numpy()
            for width in np.unique(widths):
                some = batch.take(pa.array(np.flatnonzero(widths == width)))
                cell = np.floor(shared.value.place(_rows(some.column(2))) / eps).astype(np.int32)
                offsets = pa.array(np.arange(0, cell.size + 1, cell.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.ListArray.from_arrays(offsets, pa.array(cell.ravel()))],
                                                 names=[*some.schema.names, "_cell"])

    schema = T.StructType([*distinct.schema, T.StructField("_cell", T.ArrayType(T.IntegerType()))])
    parts = shuffle_parts(spark)
    ordered = (distinct.mapInArrow(cells, schema).repartitionByRange(parts, "_label", "_w", "_cell", "_rep")
               .sortWithinPartitions("_label", "_w", "_cell", "_rep"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_label", "_w", "_first", "_lo", "_hi", "_n", "_raw", "_ids", "_copies"]
        for batch in batches:
            labels, widths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            edges = [0, *(k for k in range(1, len(labels)) if labels[k] != labels[k - 1] or widths[k] != widths[k - 1]), len(labels)]
            for at, end in ((k, min(k + block, b)) for a, b in zip(edges, edges[1:]) for k in range(a, b, block)):
                ids, copies = (batch.column(c).slice(at, end - at).to_numpy() for c in (3, 4))
                x = _rows(batch.column(2).slice(at, end - at))
                p = shared.value.place(x)
                box = [pa.array([edge.tolist()], pa.list_(pa.float64())) for edge in (p.min(0), p.max(0))]
                packed = [pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (x, ids, copies)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), batch.column(1).slice(at, 1), pa.array([int(ids[0])]),
                                                  *box, pa.array([end - at]), *packed], names=names)

    label_type = distinct.schema["_label"].dataType.simpleString()
    cut_blocks = cut(ordered.mapInArrow(
        blocks, f"_label {label_type}, _w int, _first long, _lo array<double>, _hi array<double>, _n long, "
                "_raw binary, _ids binary, _copies binary"))  # the block borders must not change on a retry

    # Boxes meet over the cells of the first axis: a block stands in each cell that it covers or touches.
    box = cut_blocks.select("_label", "_w", "_first", "_lo", "_hi")
    cell = lambda c, d: (F.floor(F.get(c, F.lit(0)) / eps) + d).cast("long")
    left = box.withColumn("_c", F.explode(F.sequence(cell("_lo", 0), cell("_hi", 0))))
    right = (box.withColumn("_c", F.explode(F.sequence(cell("_lo", -1), cell("_hi", 1))))
             .select("_label", "_w", "_c", F.col("_first").alias("_second"), F.col("_lo").alias("_lo2"), F.col("_hi").alias("_hi2")))
    gap = lambda i: F.greatest(F.lit(0.0), F.get("_lo", i) - F.get("_hi2", i), F.get("_lo2", i) - F.get("_hi", i))  # noqa: E731  (0 beyond the last axis)
    apart = sum((gap(F.lit(i)) * gap(F.lit(i)) for i in range(axes)), F.lit(0.0))
    pairs = (left.join(right, ["_label", "_w", "_c"]).where("_first <= _second").where(apart <= eps * eps)
             .select("_label", "_first", "_second").distinct())
    data = cut_blocks.select("_label", "_first", "_raw", "_ids", "_copies")
    other = data.toDF("_label", "_second", "_raw2", "_ids2", "_copies2")
    met = (pairs.join(data, ["_label", "_first"]).join(other, ["_label", "_second"])
           .select("_first", "_second", "_raw", "_ids", "_copies", "_raw2", "_ids2", "_copies2"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                first, second, *raw = (c[r].as_py() for c in batch.columns)
                a = _Side(*raw[:3], shared.value)
                b = a if first == second else _Side(*raw[3:], shared.value)
                whole = slice(0, len(a.ids)), slice(0, len(b.ids))
                changed = _join(a, b, *whole, cosine, eps * eps)
                links = a.links.copy(), b.links.copy()
                while changed:  # roots spread until they hold for the whole block pair
                    changed = _join(a, b, *whole, cosine, eps * eps)
                sides = [(a, links[0])] if a is b else [(a, links[0]), (b, links[1])]
                for side, n in sides:
                    hit = n > 0
                    if hit.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(side.ids[hit]), pa.array(n[hit]), pa.array(side.root[hit])], names=["_rep", "_n", "_root"])

    linked = cut(met.mapInArrow(join, "_rep long, _n long, _root long"))
    links = linked.groupBy("_rep").agg(F.sum("_n").alias("_n"))
    group = components(linked.where("_rep <> _root").select("_rep", "_root").distinct(), "_rep", "_root")
    known = (distinct.join(links, "_rep", "left").join(group.withColumnRenamed("id", "_rep"), "_rep", "left")
             .select(F.col("_label").alias("_l"), F.col("_x").alias("_v"), (F.coalesce("_n", F.lit(0)) + F.col("_copies") - 1).alias("_n"),
                     F.coalesce("root", "_rep").alias("_root")))
    out = rows.join(known, sane & (F.col("_label") == F.col("_l")) & (F.col("_x") == F.col("_v")), "left")
    return out.select(F.col("_id").alias(id_col), F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("_root", "_id").alias("component_id"),
                      F.coalesce(F.col("_id") == F.coalesce("_root", "_id"), F.lit(True)).alias("kept"))
