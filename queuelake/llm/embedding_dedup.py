"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, exact reranking.

ITQ learns, on a bounded sample, a centre and rotations under which the signs of a vector are a balanced binary code.
Codes are cut into pieces: as wide as a label's rows ask, so that a bucket of evenly spread vectors stays small, and so
many of them that a pair just above the threshold meets in one with `MEET`, whatever the dimension (short vectors get
more rotations). A table per piece holds every vector under (label, piece). Vectors that meet in a table are compared as original vectors in double precision. A pair is counted only in the first table
where it meets, so the codes settle what was counted where and no list of pairs is needed.

Bit-equal vectors of a label are one node with its number of copies. A bucket is worked on in tiles of at most
`TILE_ROWS` x `TILE_ROWS` vectors: a bucket larger than that is dealt over all pairs of its blocks. Tiles return a
number of links per node and links enough to join what they found (a forest), not the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm.shared import components, stored
from queuelake.session import prepare

THRESHOLD = 0.98
#: Vectors drawn, by a hash of their id, to learn the rotations.
FIT_VECTORS = 20_000
#: The narrowest piece, and the rows of a label that a value of a piece may have when codes are even.
PIECE_BITS, PIECE_ROWS = 16, 16
#: The share of pairs at the threshold that meet, if bits of a code were independent.
MEET = 0.994
TILE_ROWS = 2048
FEW_AXES = 8


def tables(width: int, threshold: float = THRESHOLD) -> int:
    """How many pieces of so many bits it takes: a bit of two vectors at an angle differs with angle / pi."""
    same = (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** width
    return int(np.ceil(np.log(1 - MEET) / np.log1p(-min(same, 1 - 1e-12))))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length one, as bytes of doubles; those that cannot be compared are left out."""
    for batch in batches:
        column = batch.column("embedding").cast(pa.list_(pa.float64()))
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.flatnonzero(sizes > 0)
        value = column.flatten().to_numpy(zero_copy_only=False)  # A null is not a number here.
        at = (np.cumsum(sizes) - sizes)[rows]
        if len(rows):
            largest = np.maximum.reduceat(np.abs(value), at)
            rows, at, largest = (x[np.isfinite(largest) & (largest > 0)] for x in (rows, at, largest))
        units = []
        for begin, size, scale in zip(at.tolist(), sizes[rows].tolist(), largest.tolist() if len(rows) else [], strict=True):
            # Scaled first, so that no square leaves the range of doubles; adding 0 turns -0 into 0.
            scaled = value[begin : begin + size] / scale + 0.0
            units.append((scaled / np.sqrt(scaled @ scaled)).tobytes())
        kept = pa.array(rows)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(kept), batch.column("label").take(kept), pa.array(sizes[rows], pa.int32()), pa.array(units, pa.binary())], names=["vec_id", "label", "size", "unit"])


def itq(sample: np.ndarray, seed: int, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Centre and rotation (principal axes, then turned to lie near the corners of a cube).

    In fewer than `FEW_AXES` dimensions learned turns of all seeds end up alike, and pieces would miss the same pairs:
    there the turn stays as drawn.
    """
    centre = sample.mean(axis=0)
    spread = sample - centre
    axes = np.linalg.svd(spread, full_matrices=False)[2] if len(spread) >= sample.shape[1] else np.eye(sample.shape[1])
    spread = spread @ axes.T
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(sample.shape[1],) * 2))[0]
    for _ in range(rounds if sample.shape[1] >= FEW_AXES else 0):
        left, _, right = np.linalg.svd(np.where(spread @ turn >= 0, 1.0, -1.0).T @ spread)
        turn = (left @ right).T
    return centre, axes.T @ turn


def fit(vectors: DataFrame, fit_vectors: int, bits: dict[int, int]) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    """For each length of vector, rotations enough for so many bits, learned from those of the sample."""
    rows = vectors.orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(fit_vectors).select("unit").collect()
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r.unit) // 8, []).append(np.frombuffer(r.unit))
    return {size: [itq(np.array(by_size[size]), seed) if size in by_size else _plain(size, seed) for seed in range(-(-n // size))] for size, n in bits.items()}


def _plain(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A rotation without learning, for a length the sample lacks."""
    return np.zeros(size), np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0]


def _codes(model, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    """Rows (node, label, size, pieces) with the pieces of all codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, widths = batch.column("size").to_numpy(), batch.column("width").to_numpy()
            for size, width in np.unique(np.stack([sizes, widths]), axis=1).T.tolist():
                rows = batch.filter(pa.array((sizes == size) & (widths == width)))
                unit = np.frombuffer(b"".join(rows.column("unit").to_pylist())).reshape(-1, size)
                number = tables(width, threshold)
                turns = model.value[size][: -(-number * width // size)]
                bits = np.concatenate([(unit - centre) @ turn >= 0 for centre, turn in turns], axis=1)[:, : number * width]
                pieces = bits.reshape(-1, width) @ (1 << np.arange(width, dtype=np.int64))
                pieces = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * number, pa.int32()), pa.array(pieces))
                yield pa.RecordBatch.from_arrays([rows.column("node"), rows.column("label"), rows.column("size"), pieces], names=["node", "label", "size", "pieces"])

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links enough to join what the given links join."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _tile(threshold: float) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """Compare the vectors of block x with those of block y of one bucket."""
        table = table.sort_by("node")
        node, block, copies = (table.column(c).to_numpy() for c in ("node", "block", "copies"))
        number = table.column("piece_no")[0].as_py()
        x, y = table.column("tile_x")[0].as_py(), table.column("tile_y")[0].as_py()
        unit = np.stack([np.frombuffer(v.as_buffer()) for v in table.column("unit")])
        pieces = np.stack([np.asarray(v.values.to_numpy()) for v in table.column("pieces")])
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        near = unit[left] @ unit[right].T >= threshold
        i, j = np.nonzero(near)
        i, j = left[i], right[j]
        keep = i < j if x == y else np.ones(len(i), bool)
        i, j = i[keep], j[keep]
        # Counted in the first table where both have the same piece.
        first = np.ones(len(i), bool)
        for k in range(number):
            first &= pieces[i, k] != pieces[j, k]
        i, j = i[first], j[first]
        counts = np.bincount(i, weights=copies[j], minlength=len(node)) + np.bincount(j, weights=copies[i], minlength=len(node))
        some = np.flatnonzero(counts)
        links = _forest(node[i], node[j])
        none = [None] * len(links)
        return pa.table(
            {
                "node": pa.array([*node[some].tolist(), *none], pa.int64()),
                "links": pa.array([*counts[some].astype(np.int64).tolist(), *none], pa.int64()),
                "a": pa.array([None] * len(some) + [p[0] for p in links], pa.int64()),
                "b": pa.array([None] * len(some) + [p[1] for p in links], pa.int64()),
            }
        )

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, fit_vectors: int = FIT_VECTORS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Only vectors of equal, non-null label and equal length are compared. Null, empty and zero vectors, and those with
    a null or non-finite component, link with nothing: n_links 0, component_id their own id. component_id is the
    smallest vec_id reachable. Rows that repeat a vec_id are vectors of their own that share a node's name. A row
    without vec_id links with nothing, has no component and is not kept. Other columns are not read.
    """
    spark = prepare(vectors.sparkSession)
    usable = vectors.where("label IS NOT NULL AND vec_id IS NOT NULL").select("vec_id", F.col("label").cast("int").alias("label"), "embedding")
    usable = stored(usable.mapInArrow(_units, "vec_id bigint, label int, size int, unit binary"), "units")
    nodes = stored(usable.groupBy("label", "size", "unit").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "vectors")
    members = usable.join(nodes, ["label", "size", "unit"]).select("vec_id", "node", "copies")

    width = F.least(F.lit(30), F.greatest(F.lit(PIECE_BITS), F.ceil(F.log2(F.count("*") / F.lit(PIECE_ROWS))))).cast("int")
    widths = stored(nodes.groupBy("label", "size").agg(width.alias("width")), "vector-widths")
    bits = {r.size: tables(r.width, threshold) * r.width for r in widths.groupBy("size").agg(F.max("width").alias("width")).collect()}
    model = spark.sparkContext.broadcast(fit(nodes.withColumnRenamed("node", "vec_id"), fit_vectors, bits))
    wide = nodes.join(widths, ["label", "size"]).select("node", "label", "size", "unit", "width")
    coded = stored(wide.mapInArrow(_codes(model, threshold), "node bigint, label int, size int, pieces array<bigint>"), "codes")
    entries = coded.select("node", "label", "size", "pieces", F.posexplode("pieces").alias("piece_no", "piece"))
    bucket = ["label", "size", "piece_no", "piece"]
    blocks = F.ceil(F.col("rows") / F.lit(tile_rows)).cast("int")
    crowded = entries.groupBy(*bucket).agg(F.count("*").alias("rows")).where("rows > 1").withColumn("blocks", blocks).drop("rows")
    placed = entries.join(crowded, bucket).withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    # Each block meets itself and every other block once.
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiled = placed.select("*", partner).select(*bucket, "node", "pieces", "block", F.least("block", "other").alias("tile_x"), F.greatest("block", "other").alias("tile_y"))
    full = tiled.join(nodes.select("node", "unit", "copies", F.col("label").alias("of")), "node").where("label = of").drop("of")
    met = stored(full.groupBy(*bucket, "tile_x", "tile_y").applyInArrow(_tile(threshold), "node bigint, links bigint, a bigint, b bigint"), "vector-links")

    links = met.where("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    own = members.where("vec_id <> node").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    joined = components(met.where("a IS NOT NULL").select("a", "b").union(own)).withColumnRenamed("id", "vec_id")
    counted = members.join(links, "node", "left").select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")).groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    rows = vectors.select("vec_id").join(counted, "vec_id", "left").join(joined, "vec_id", "left")
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
