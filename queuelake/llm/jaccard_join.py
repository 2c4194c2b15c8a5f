"""Near-duplicate documents by Jaccard similarity of word n-grams, exact at the threshold.

1. Every document becomes the sorted array of its distinct shingle hashes. Documents with equal arrays are one node
   (the digest of the array), so copies never meet each other: tasks list a node once, whatever its copies.
2. Shingles are ordered rarest first, by a table of counts over all documents (hashed, of fixed size; any common order
   gives right results, a better one gives shorter lists). A node of n shingles is listed under the first
   n - ceil(t n) + 1 of them; two nodes that link share one of these, and the first one they share leads: it is among
   the first n - ceil(2 t n / (1 + t)) + 1 of the smaller. A list, in order of size, is cut where no row leads to the
   next ones within the sizes that can link, and rows that nothing leads to are dropped before anything is stored.
3. In two rounds each list proposes pairs of its nodes with one of them, a hub; lists of one group get one of a few
   hubs, so a group of m near copies costs a few times m proposals. A proposed pair is compared by bitmap signatures:
   bits of one that the other lacks bound the overlap from above. Only pairs that pass meet with their sorted arrays,
   which are intersected exactly. What links is merged into components.
4. Lists that still hold nodes of different components are joined into clusters. A cluster's nodes, ordered by size,
   are cut into blocks; two blocks whose sizes can link are a tile, where every pair of nodes of different components
   is tried, by longer bitmaps and then exactly, until a link makes the two components one. No pair that could join
   two components is left out, and a tile gives fewer links than it has components. Should a cluster
   outgrow `CLUSTER_NODES`, its lists propose their pairs one by one instead.

Hashes have 64 bits and stand for the words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from queuelake.llm import textbytes
from queuelake.llm.shared import BROADCAST_IDS, components, stored, with_ids
from queuelake.session import prepare

WORDS = 5
PERCENT = 80
#: Cells of the table of shingle counts, and the pieces in which it is summed.
_CELLS, _PIECES = 1 << 24, 16
#: Hubs of a group in each round, as masks that reorder the nodes; nodes of a block; nodes of a cluster cut in blocks.
_HUBS = (0, 0x5DEECE66D1234567, 0x2545F4914F6CDD1D, 0x369DEA0F31A53F85)
BLOCK_NODES, CLUSTER_NODES = 512, 50_000
#: Shingles of a node that takes one place in a block; a longer one takes more.
NODE_SHINGLES = 2048
#: Two rows of a list that can be those of the first shared shingle of a link.
_MAY_LINK = "100L * least({a}size, {b}size) >= {percent}L * greatest({a}size, {b}size) AND ({a}leads OR {a}size > {b}size) AND ({b}leads OR {b}size > {a}size)"


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, sorted; a row of fewer words has its whole sequence."""
    data = textbytes.lower(data)
    starts, ends, row = textbytes.words(data, offsets)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    word = textbytes.span_hashes(textbytes.prefix_sums(data), starts, ends)
    first, count = textbytes.runs(row)
    # Sums of word hashes, each times a factor for its place; rows of few words have sums of fewer terms.
    padded = np.concatenate([word, np.zeros(width, np.uint64)])
    total = np.zeros(len(word), np.uint64)
    short = np.repeat(count < width, count)
    for i in range(width):
        term = padded[i : i + len(word)] * np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64))
        if short.any():
            term[short & (row != np.concatenate([row, np.full(width, -1)])[i : i + len(word)])] = 0
        total += term
    heads = np.maximum(count - width + 1, 1)
    last = np.repeat(first + heads, count)
    at = np.arange(len(word)) < last
    row, value = row[at], textbytes.mix(total[at] + np.minimum(np.repeat(count, count)[at], width).astype(np.uint64))
    ends = np.cumsum(heads)
    for begin, end in zip((ends - heads).tolist(), ends.tolist(), strict=True):
        value[begin:end].sort()
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def _digests(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each row, and its node: 64 bits of a digest of the sorted array."""
    count = np.bincount(row, minlength=n)
    at = np.concatenate([[0], np.cumsum(count)])
    node = np.array([int.from_bytes(hashlib.blake2b(value[at[i] : at[i + 1]].tobytes(), digest_size=8).digest(), "big", signed=True) for i in range(n)], np.int64)
    return count, node


def _cell(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(20)).astype(np.int64) & (_CELLS - 1)


def _sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each document, and the task's table of shingle counts in pieces."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("piece", pa.int64()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task counts to 255 in a cell: what is more frequent than that is no rare shingle anyway.
        table = np.zeros(_CELLS, np.uint8)
        for rows, data, offsets in textbytes.slices(batches):
            row, value = shingles(data, offsets, width)
            count, node = _digests(row, value, len(rows))
            cell, n = np.unique(_cell(value), return_counts=True)
            table[cell] = np.minimum(table[cell] + n, 255)
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(count, pa.int64()), pa.array(node, pa.int64(), mask=count == 0), none, pa.nulls(len(rows), pa.binary())], schema=schema)
        if table.any():
            none = pa.nulls(1, pa.int64())
            for piece, counts in enumerate(np.split(table, _PIECES)):
                yield pa.RecordBatch.from_arrays([none, none, none, pa.array([piece], pa.int64()), pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], schema=schema)

    return run


def _sum_cells(table: pa.Table) -> pa.Table:
    total = np.zeros(_CELLS // _PIECES, np.uint64)
    for counts in table.column("counts"):
        total += np.frombuffer(zlib.decompress(counts.as_py()), np.uint8)
    # Only the order of the counts matters: eighths of their logarithm keep it well enough in a byte each.
    total = np.rint(8 * np.minimum(np.log2(1.0 + total), 31)).astype(np.uint8)
    return pa.table({"piece": table.column("piece").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def _counts(sets: DataFrame) -> np.ndarray:
    """How many distinct shingles of documents fall in each cell, as a logarithm: 16 MB, whatever the input."""
    rows = sets.where("piece IS NOT NULL").select("piece", "counts").groupBy("piece").applyInArrow(_sum_cells, "piece bigint, counts binary").collect()
    table = np.zeros((_PIECES, _CELLS // _PIECES), np.uint8)
    for r in rows:
        table[r.piece] = np.frombuffer(r.counts, np.uint8)
    return table.ravel()


def _listed(width: int, percent: int, counts) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    """Rows (shingle, node, size, leads) of the rarest shingles of each node, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = counts.value, set()
        for rows, data, offsets in textbytes.slices(batches):
            row, value = shingles(data, offsets, width)
            _, node = _digests(row, value, len(rows))
            fresh = np.array([not (x in seen or seen.add(x)) for x in node.tolist()], bool)
            row, value = row[fresh[row]], value[fresh[row]]
            order = np.lexsort((value, table[_cell(value)], row))
            row, value = row[order], value[order]
            first, size = textbytes.runs(row)
            listed = size - (percent * size + 99) // 100 + 1
            leading = size - (2 * percent * size + 99 + percent) // (100 + percent) + 1
            place = np.arange(len(row)) - np.repeat(first, size)
            keep = place < np.repeat(listed, size)
            leads = (place < np.repeat(leading, size))[keep]
            yield pa.RecordBatch.from_arrays([pa.array(value[keep].view(np.int64)), pa.array(node[row[keep]]), pa.array(np.repeat(size, size)[keep].astype(np.int32)), pa.array(leads)], names=["shingle", "node", "size", "leads"])

    return run


def _in_lists(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows sorted by shingle, size and node, one per node, where some row leads to another of a size that can link.

    `shingle` becomes the name of the part of the list. The last row of a batch is held, as the next may follow it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([held[0], batch] if held else [batch]).combine_chunks().to_batches()[0]
            shingle, node = rows.column("shingle").to_numpy(), rows.column("node").to_numpy()
            new = np.ones(len(rows), bool)
            new[1:] = (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])
            rows, shingle, node = rows.filter(pa.array(new)), shingle[new], node[new]
            size, leads = rows.column("size").to_numpy().astype(np.int64), rows.column("leads").to_numpy(zero_copy_only=False)
            at = np.arange(len(rows))
            begin = np.zeros(len(rows), np.int64)
            begin[1:] = np.where(shingle[1:] != shingle[:-1], at[1:], 0)
            begin = np.maximum.accumulate(begin)
            # The size of the latest leading row of the list, this row included; 0 if there is none.
            latest = np.maximum.accumulate(np.where(leads, at, -1))
            reach = np.where(latest >= begin, size[latest], held[3] if held else 0)
            reach[(latest < begin) & (begin > 0)] = 0
            follows = np.zeros(len(rows), bool)
            follows[0] = held is not None and held[1]
            follows[1:] = (at[1:] > begin[1:]) & (100 * reach[:-1] >= percent * size[1:])
            start = np.maximum.accumulate(np.where(leads & ~follows, at, -1))
            name = textbytes.mix(shingle.view(np.uint64) + textbytes.mix(node.view(np.uint64)[start])).view(np.int64)
            if held:
                name[(start < 0) & (begin == 0)] = held[2]
            keep = follows.copy()
            keep[:-1] |= leads[:-1] & follows[1:]
            rows = rows.set_column(0, "shingle", pa.array(name))
            yield rows.slice(0, len(rows) - 1).filter(pa.array(keep[:-1])).select(["shingle", "node", "size", "leads"])
            # Held with its own shingle, by which the next row is compared.
            held = rows.slice(len(rows) - 1).set_column(0, "shingle", pa.array(shingle[-1:])), bool(follows[-1]), name[-1], int(reach[-1])
        if held and held[1]:
            yield held[0].set_column(0, "shingle", pa.array([held[2]], pa.int64()))

    return run


def _signature(value: np.ndarray, factor: int = 4) -> bytes:
    """Bitmap of the lowest hash bits; its length is a power of two of at least `factor` times the set's size."""
    bits = 1 << max(6, int(factor * len(value) - 1).bit_length())
    marks = np.zeros(bits, np.uint8)
    marks[(value & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def overlap_bound(a: bytes, n_a: int, b: bytes, n_b: int) -> int:
    """No fewer than the elements two sets share, from their bitmaps; the longer bitmap is folded to the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(v.reshape(-1, size), axis=0) for v in (x, y))
    return min(n_a - int(np.bitwise_count(x & ~y).sum()), n_b - int(np.bitwise_count(y & ~x).sum()))


def _links(shared: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * shared >= percent * (n_a + n_b - shared)


def _candidates(width: int, factor: int, arrays: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Bitmaps (unless the factor is 0) and sorted arrays of documents, as asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in textbytes.slices(batches):
            row, value = shingles(data, offsets, width)
            count, node = _digests(row, value, len(rows))
            sets = np.split(value, np.cumsum(count)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(count, pa.int64()), pa.array([_signature(s, factor) for s in sets] if factor else [None] * len(sets), pa.binary()), pa.array([s.tobytes() for s in sets] if arrays else [None] * len(sets), pa.binary())], names=["node", "n", "bits", "hashes"])

    return run


def _pass_bound(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bits_a", "n_a", "bits_b", "n_b"))
            keep = [_links(overlap_bound(*x), x[1], x[3], percent) for x in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """Elements that two sorted arrays share."""
    small, large = (x, y) if len(x) < len(y) else (y, x)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int((large[at] == small).sum())


def _intersect(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("hashes_a"), batch.column("hashes_b"), strict=True):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                keep.append(_links(_shared(x, y), len(x), len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Sets:
    """Bitmaps and arrays of nodes, worked out from one document of each."""

    def __init__(self, docs: DataFrame, rows: DataFrame, width: int, percent: int) -> None:
        self.docs, self.width, self.percent = docs, width, percent
        self.of_node = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    def of(self, nodes: DataFrame, factor: int, arrays: bool = False, keep: bool = True) -> DataFrame:
        """Sets of nodes, stored unless they are read once."""
        ids = stored(self.of_node.join(nodes, "node", "left_semi").select("doc_id"), "set-ids")
        made = with_ids(self.docs, ids, "doc_id").mapInArrow(_candidates(self.width, factor, arrays), "node bigint, n bigint, bits binary, hashes binary")
        return stored(made, "sets") if keep else made

    def verified(self, pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
        """Of proposed pairs (a, b), those that link."""
        side = lambda sets, x, what: sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col(what).alias(f"{what}_{x}"))
        near = pairs.join(side(bitmaps, "a", "bits"), "a").join(side(bitmaps, "b", "bits"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        return self.exact(near.mapInArrow(_pass_bound(self.percent), "a bigint, b bigint"))

    def exact(self, near: DataFrame) -> DataFrame:
        """Of pairs whose bitmaps allow it, those that link."""
        side = lambda sets, x, what: sets.select(F.col("node").alias(x), F.col(what).alias(f"{what}_{x}"))
        near = stored(near, "near-pairs")
        arrays = self.of(near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), 0, arrays=True)
        met = near.join(side(arrays, "a", "hashes"), "a").join(side(arrays, "b", "hashes"), "b").select("a", "b", "hashes_a", "hashes_b")
        return stored(met.mapInArrow(_intersect(self.percent), "a bigint, b bigint"), "near-links")


def _tile(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links that join components in two blocks: no more than the block's components less one.

    Every pair of nodes of different components whose bitmaps let them link is tried exactly, until a link ties the two.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        node, size, component, block = (table.column(c).to_numpy() for c in ("node", "n", "component", "block"))
        x, y = table.column("tile_x")[0].as_py(), table.column("tile_y")[0].as_py()
        bodies = [np.frombuffer(b.as_buffer(), np.uint8) for b in table.column("bits")]
        sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in table.column("hashes")]
        least = min(map(len, bodies))
        bits = np.stack([np.bitwise_or.reduce(b.reshape(-1, least), axis=0) for b in bodies]).view(np.uint64)
        tied = np.unique(component, return_inverse=True)[1]
        right = np.flatnonzero(block == y)
        out: list[tuple[int, int]] = []
        for i in np.flatnonzero(block == x).tolist():
            # Two nodes of one block are tried once.
            others = right[right > i] if x == y else right
            others = others[tied[others] != tied[i]]
            lacks = np.bitwise_count(bits[i] & ~bits[others]).sum(axis=1, dtype=np.int64)
            lacked = np.bitwise_count(bits[others] & ~bits[i]).sum(axis=1, dtype=np.int64)
            bound = np.minimum(size[i] - lacks, size[others] - lacked)
            near = np.flatnonzero(100 * bound >= percent * (size[i] + size[others] - bound))
            for j in others[near[np.argsort(-bound[near], kind="stable")]].tolist():
                if tied[i] != tied[j] and _links(_shared(sets[i], sets[j]), size[i], size[j], percent):
                    out.append((i, j))
                    tied[tied == tied[j]] = tied[i]
        a, b = node[np.array(out, np.int64).reshape(-1, 2)].T
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return run


def _of_clusters(clusters: DataFrame, sets: _Sets, percent: int, block_nodes: int) -> DataFrame:
    """Links found in tiles of blocks; clusters has cluster, node, component, n.

    Bitmaps of these nodes are long, so that hardly a pair passes them that does not link. A block has at most
    `block_nodes` nodes, fewer if they are long: a tile fits in a task whatever the texts. Of nodes that a link ties to
    many, as all of a group of copies, a tile gives one link for each component, not one for each node.
    Bitmaps and arrays are made where the texts are and go from there to the tiles, unless the tiles' rows are too many
    to be sent to the texts.
    """
    share = F.greatest("n", F.lit(NODE_SHINGLES))
    before = F.sum(share).over(W.partitionBy("cluster").orderBy("n", "node").rowsBetween(W.unboundedPreceding, W.currentRow)) - share
    placed = clusters.withColumn("block", F.floor(before / (block_nodes * NODE_SHINGLES)).cast("int"))
    placed = stored(placed, "cluster-blocks")
    blocks = placed.groupBy("cluster", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("component").alias("least"), F.max("component").alias("most"))
    x = blocks.select("cluster", F.col("block").alias("tile_x"), F.col("high").alias("high_x"), F.col("least").alias("least_x"), F.col("most").alias("most_x"))
    y = blocks.select("cluster", F.col("block").alias("tile_y"), F.col("low").alias("low_y"), F.col("least").alias("least_y"), F.col("most").alias("most_y"))
    tiles = x.join(y, "cluster").where(f"tile_x <= tile_y AND 100 * high_x >= {percent} * low_y AND least(least_x, least_y) < greatest(most_x, most_y)").select("cluster", "tile_x", "tile_y")
    of_block = tiles.select("*", F.explode(F.array_distinct(F.array("tile_x", "tile_y"))).alias("block"))
    places = stored(placed.select("cluster", "node", "component", "block").join(of_block, ["cluster", "block"]), "tile-places")
    full = sets.of(places.select("node").distinct(), 16, arrays=True, keep=False)
    # A place has some six times the bytes of an id.
    rows = full.join(F.broadcast(places) if places.count() <= BROADCAST_IDS // 6 else places, "node")
    return stored(rows.groupBy("cluster", "tile_x", "tile_y").applyInArrow(_tile(percent), "a bigint, b bigint"), "near-links")


def near_duplicates(docs: DataFrame, width: int = WORDS, percent: int = PERCENT, block_nodes: int = BLOCK_NODES, cluster_nodes: int = CLUSTER_NODES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when 100 * shared shingles >= percent * all shingles of the two. component_id is the smallest
    doc_id that links reach, the document's own if it links with none. Null, empty and blank texts have no shingles
    and link with nothing. Rows that repeat a doc_id are one document with several texts. A row without doc_id links
    with nothing and has no component. Columns other than doc_id and text are not read; no rows give no rows.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sets = stored(docs.mapInArrow(_sets(width), "doc_id bigint, n_shingles bigint, node bigint, piece bigint, counts binary"), "shingle-sets")
    rows = sets.where("piece IS NULL").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
    counts = spark.sparkContext.broadcast(_counts(sets))

    listed = docs.where("doc_id IS NOT NULL").mapInArrow(_listed(width, percent, counts), "shingle bigint, node bigint, size int, leads boolean")
    # A node is listed once by each task that has a copy.
    sorted_lists = listed.repartition("shingle").sortWithinPartitions("shingle", "size", "node")
    lists = stored(sorted_lists.mapInArrow(_in_lists(percent), "shingle bigint, node bigint, size int, leads boolean"), "shingle-lists")
    counts.unpersist()
    sets = _Sets(docs, rows, width, percent)
    bitmaps = sets.of(lists.select("node").distinct(), 4)

    found, open_lists = None, lists.withColumn("component", F.col("node"))
    for turn in range(2):
        # Which hub a list takes goes by its shingle.
        mask = F.element_at(F.array(*[F.lit(m) for m in _HUBS]), (F.pmod(F.shiftright("shingle", 7 + turn), F.lit(len(_HUBS))) + 1).cast("int"))
        turned = F.col("node").bitwiseXOR(mask)
        hubs = open_lists.groupBy("shingle").agg(F.min(F.struct(turned.alias("node"), F.col("size"), F.col("leads"))).alias("hub"))
        stars = open_lists.join(hubs, "shingle").where(_MAY_LINK.format(a="hub.", b="", percent=percent))
        stars = stars.select(F.col("hub.node").bitwiseXOR(mask).alias("hub"), "node").where("hub <> node")
        pairs = stars.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
        links = sets.verified(pairs, bitmaps)
        found = links if found is None else found.union(links)
        known = lists.join(components(found).withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component_id", "node")).drop("component_id")
        known = stored(known, "shingle-lists")
        mixed = known.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("shingle")
        open_lists = stored(known.join(mixed, "shingle", "left_semi"), "open-lists")

    heads = open_lists.groupBy("shingle").agg(F.min("node").alias("a"))
    joined = open_lists.join(heads, "shingle").select("a", F.col("node").alias("b")).distinct()
    clusters = components(joined).select(F.col("id").alias("node"), F.col("component_id").alias("cluster"))
    clusters = stored(clusters.join(open_lists.select("node", "component", F.col("size").cast("bigint").alias("n")).distinct(), "node"), "clusters")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("nodes"))
    large = sizes.where(F.col("nodes") > cluster_nodes).select("cluster")
    rest = _of_clusters(clusters.join(large, "cluster", "left_anti"), sets, percent, block_nodes)
    if not large.isEmpty():
        wide = open_lists.join(clusters.join(large, "cluster", "left_semi").select("node"), "node", "left_semi")
        met = wide.alias("a").join(
            wide.alias("b"),
            F.expr("a.shingle = b.shingle AND a.component <> b.component AND a.node < b.node AND " + _MAY_LINK.format(a="a.", b="b.", percent=percent)),
        )
        rest = rest.union(sets.verified(met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct(), bitmaps))

    of_node = components(found.union(rest))
    named = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(of_node.withColumnRenamed("id", "node"), "node", "left")
    # A doc_id with several texts ties its nodes together, as does a node shared by several doc_ids.
    ties = rows.where("node IS NOT NULL").select("doc_id", "node").distinct().join(named.select("node", F.coalesce("component_id", "node").alias("component")), "node")
    return _named(rows, ties)


def _named(rows: DataFrame, ties: DataFrame) -> DataFrame:
    """component_id as the smallest doc_id; components that share a doc_id are one."""
    least = ties.groupBy("component").agg(F.min("doc_id").alias("least"))
    by_doc = stored(ties.join(least, "component").groupBy("doc_id").agg(F.min("least").alias("least"), F.max("least").alias("other")), "components")
    joined = by_doc.where("least <> other").select(F.col("least").alias("a"), F.col("other").alias("b"))
    if not joined.isEmpty():
        wide = ties.join(least, "component").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
        by_doc = by_doc.select("doc_id").join(components(wide).withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("component_id", "doc_id").alias("least"))
    return rows.join(by_doc.select("doc_id", "least"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
