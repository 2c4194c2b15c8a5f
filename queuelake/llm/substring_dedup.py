"""Removal of byte strings of a given length that stand at two places or more, by refining ranks until unique.

Ranks of growing strings decide the matter, as in prefix doubling, and Spark sorts the rank rows; but a rank row for
every byte of every round would be hundreds of times the input, so the first ranks are sparse:

1. Each window (a string of `width` bytes) is charged to one 64-byte gram inside it, the one with the smallest hash.
   Equal windows choose equal grams at equal offsets. Neighbouring windows choose the same occurrence of a gram, so
   one row per occurrence carries them all: the gram's rank, and the rank of its whole context, the bytes of all its
   windows. Spark sorts these pairs. A gram seen once ends its windows; a context seen twice decides all of them.
2. What is left, contexts that share a gram and differ somewhere (edges of passages, edits in near copies), is sorted
   by gram with its bytes, and ranks are doubled exactly, from 8 bytes to 64 and then over the window, dropping what
   has become unique. A gram with more than `run_rows` such contexts is not held by one task: its windows become rows
   of their own with the ranks of their halves, and Spark sorts those.

Texts are taken once each, whatever number of documents has them; a text that two documents have is covered whole.
Within a slice of texts repeated contexts are decided before the shuffle, so a passage that a third of all documents
share travels once per slice. Ranks of 64-byte grams and of contexts are 64-bit hashes; step 2 compares bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm import textbytes
from queuelake.llm.shared import stored
from queuelake.session import prepare

WIDTH, GRAM = 200, 64
RUN_ROWS = 20_000
#: Bytes of contexts whose ranks are doubled together.
_CHUNK = 1 << 20
#: Rows of step 1. pos: start of the first of n windows; back: bytes from there to the gram.
_ROW = "fp bigint, ctx bigint, key bigint, pos bigint, n int, back int, state int"
#: States before the sort: open, decided, stands for a decided context. After it: decided, open, decided witness.
_OPEN, _DECIDED, _WITNESS = 0, 1, 2


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _columns(*arrays: np.ndarray) -> pa.RecordBatch:
    kinds = [np.int64] * 4 + [np.int32] * 3
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a).view(np.int64) if a.dtype == np.uint64 else a.astype(k)) for a, k in zip(arrays, kinds, strict=True)], names=[c.split()[0] for c in _ROW.split(", ")])


def _anchors(width: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for rows, data, offsets in textbytes.slices(batches):
            keys = rows.column("key").to_numpy()
            long = np.diff(offsets) >= width
            fresh = np.array([bool(x) and not (k in seen or seen.add(k)) for k, x in zip(keys.tolist(), long.tolist(), strict=True)], bool)
            if not fresh.any():
                continue
            sums = textbytes.prefix_sums(data)
            start = np.arange(len(data) - gram + 1)
            hashes = textbytes.span_hashes(sums, start, start + gram)
            least = _sliding_min(hashes, width - gram + 1)
            inside = np.zeros(len(least) + 1, np.int8)
            np.add.at(inside, offsets[:-1][fresh], 1)
            np.add.at(inside, offsets[1:][fresh] - width + 1, -1)
            at = np.flatnonzero(np.cumsum(inside[:-1]))
            row = np.searchsorted(offsets, at, "right") - 1
            value = least[at]
            first = np.ones(len(at), bool)
            first[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
            # A gram that stands twice in a window: the charge moves on once the left one is passed.
            begin = np.flatnonzero(first)
            lo, n, doc, fp = at[begin], np.diff(np.append(begin, len(at))), row[begin], value[begin]
            lo, n, back, doc, fp = _split_at_grams(hashes, lo, n, doc, fp, width - gram + 1)
            ctx = textbytes.span_hashes(sums, lo, lo + n - 1 + width)
            ctx = textbytes.mix(ctx + (n.astype(np.uint64) << np.uint64(16)) + back.astype(np.uint64))
            key, pos = keys[doc], lo - offsets[doc]
            order = np.lexsort((ctx, fp))
            same = np.zeros(len(order), bool)
            same[1:] = (fp[order][1:] == fp[order][:-1]) & (ctx[order][1:] == ctx[order][:-1])
            again = same.copy()
            again[:-1] |= same[1:]
            state = np.where(again & ~same, _WITNESS, _OPEN)[~same]
            kept = order[~same]
            yield _columns(fp[kept], ctx[kept], key[kept], pos[kept], n[kept], back[kept], state)
            done = order[again]
            if len(done):
                spread = textbytes.mix(key[done].astype(np.uint64) + pos[done].astype(np.uint64))
                yield _columns(spread, ctx[done], key[done], pos[done], n[done], back[done], np.full(len(done), _DECIDED))

    return run


def _split_at_grams(hashes: np.ndarray, lo: np.ndarray, n: np.ndarray, doc: np.ndarray, fp: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Charge each run of windows with one smallest gram to the leftmost of its occurrences still inside."""
    # Only positions that are the minimum of some window can be charged: the maximum of the minimums over them.
    least = _sliding_min(hashes, span)
    edge = np.zeros(span - 1, np.uint64)
    minimal = np.flatnonzero(hashes == ~_sliding_min(~np.concatenate([edge, least, edge]), span))
    left, right = np.searchsorted(minimal, lo), np.searchsorted(minimal, lo + n - 1 + span)
    size = right - left
    owner = np.repeat(np.arange(len(lo)), size)
    at = minimal[np.repeat(left - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
    hit = hashes[at] == fp[owner]
    at, owner = at[hit], owner[hit]
    first, count = textbytes.runs(owner)
    single = at[first]
    several = np.flatnonzero(count > 1)
    back = single - lo
    if not len(several):
        return lo, n, back, doc, fp
    plain = np.ones(len(lo), bool)
    plain[several] = False
    out: list[tuple[int, int, int, int, int]] = []
    for i in several.tolist():
        begin, stop = int(lo[i]), int(lo[i] + n[i])
        for a in at[first[i] : first[i] + count[i]].tolist():
            if begin < stop and a >= begin:
                end = min(stop, a + 1)
                out.append((begin, end - begin, a - begin, int(doc[i]), int(fp[i])))
                begin = end
    more = np.array(out, dtype=object).reshape(-1, 5)
    join = lambda a, k, kind: np.concatenate([a[plain], more[:, k].astype(kind)])
    return join(lo, 0, np.int64), join(n, 1, np.int64), join(back, 2, np.int64), join(doc, 3, np.int64), join(fp, 4, np.uint64)


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (fp, ctx, key, pos): decided intervals, and the contexts that share a gram but differ."""
    names = [c.split()[0] for c in _ROW.split(", ")]

    def settle(part: dict[str, np.ndarray], before: int | None, after: int | None) -> pa.RecordBatch:
        fp, ctx = part["fp"], part["ctx"]
        new = np.ones(len(fp), bool)
        new[1:] = (fp[1:] != fp[:-1]) | (ctx[1:] != ctx[:-1])
        twin = np.zeros(len(fp), bool)
        twin[1:] = ~new[1:] & (part["key"][1:] == part["key"][:-1]) & (part["pos"][1:] == part["pos"][:-1])
        first = np.flatnonzero(new)
        places = np.add.reduceat((~twin).astype(np.int64), first)
        marked = np.maximum.reduceat(part["state"], first)
        heads = fp[first]
        shared = np.zeros(len(first), bool)
        shared[1:] |= heads[1:] == heads[:-1]
        shared[:-1] |= heads[1:] == heads[:-1]
        shared[0] |= before is not None and heads[0] == before
        shared[-1] |= after is not None and heads[-1] == after
        run = np.cumsum(new) - 1
        whole = (places > 1) | (marked > 0)
        passed = part["state"] == _DECIDED
        gives = passed | (whole[run] & (part["state"] == _OPEN))
        opens = np.where(whole, _WITNESS, _OPEN)[run]
        keep = np.flatnonzero(gives & ~twin)
        asks = np.flatnonzero(shared[run] & new & ~passed)
        rows = np.concatenate([keep, asks])
        state = np.concatenate([np.full(len(keep), _DECIDED), opens[asks]])
        return _columns(*(part[c][rows] for c in names[:-1]), state)

    held: dict[str, np.ndarray] | None = None
    before: int | None = None
    for batch in batches:
        rows = {c: batch.column(c).to_numpy() for c in names}
        if held is not None:
            rows = {c: np.concatenate([held[c], rows[c]]) for c in names}
        fp, ctx = rows["fp"], rows["ctx"]
        if not len(fp):
            continue
        last = len(fp) - 1
        cut = int(np.flatnonzero((fp != fp[last]) | (ctx != ctx[last]))[-1]) + 1 if ((fp != fp[last]) | (ctx != ctx[last])).any() else 0
        if cut:
            yield settle({c: v[:cut] for c, v in rows.items()}, before, int(fp[cut]))
            before = int(fp[cut - 1])
        held = {c: v[cut:] for c, v in rows.items()}
    if held is not None and len(held["fp"]):
        yield settle(held, before, None)


_CONTEXT = "fp bigint, key bigint, pos bigint, n int, back int, state int, bytes binary"


def _contexts(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Bytes of the open contexts of each text, once per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            out: list[tuple] = []
            data, offsets = textbytes.utf8(batch.column("text"))
            for i, (key, asked) in enumerate(zip(batch.column("key").to_pylist(), batch.column("asked"), strict=True)):
                if key in seen:
                    continue
                seen.add(key)
                body = data[offsets[i] : offsets[i + 1]].tobytes()
                out += [(r["fp"], key, r["pos"], r["n"], r["back"], r["state"], body[r["pos"] : r["pos"] + r["n"] - 1 + width]) for r in asked.as_py()]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            columns = list(zip(*out, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _CONTEXT.split(", ")])

    return run


def _rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs of ranks, in 32 bits: there are fewer than bytes in a chunk."""
    return np.unique((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64), return_inverse=True)[1].astype(np.uint32)


def repeated_windows(fp: np.ndarray, back: np.ndarray, n: np.ndarray, bodies: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, window) of the windows that stand in two of the contexts, by doubling ranks of their bytes."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    data = np.frombuffer(b"".join(bodies) + bytes(64), np.uint8)
    context = np.repeat(np.arange(len(n)), n)
    number = np.arange(len(context)) - np.repeat(np.cumsum(n) - n, n)
    # Windows can be equal only with the same gram at the same offset.
    name = _rank(np.unique(fp, return_inverse=True)[1][context], back[context] - number)
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    rank = np.unique(np.ascontiguousarray(eight).view(np.uint64).ravel(), return_inverse=True)[1].astype(np.uint32)
    length = 8
    live = np.arange(len(context))
    while length < 64 and length * 2 <= width:
        rank = _rank(rank[:-length], rank[length:])
        length *= 2
    place = 0
    while len(live):
        counts = np.bincount(name)
        keep = counts[name] > 1
        live, name = live[keep], name[keep]
        if place == width or not len(live):
            break
        at = min(place, width - length)
        name = _rank(name, rank[begin[context[live]] + number[live] + at])
        place = at + length
    return context[live], number[live]


def _double(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of contexts sorted by gram, intervals (key, pos, n) of repeated windows in the open ones."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        fp, key, pos, n, back, state = (table.column(c).to_numpy() for c in ("fp", "key", "pos", "n", "back", "state"))
        context, number = repeated_windows(fp, back.astype(np.int64), n.astype(np.int64), table.column("bytes").to_pylist(), width)
        mine = state[context] == _OPEN
        context, number = context[mine], number[mine]
        new = np.ones(len(context), bool)
        new[1:] = (context[1:] != context[:-1]) | (number[1:] != number[:-1] + 1)
        first = np.flatnonzero(new)
        runs = np.diff(np.append(first, len(context)))
        c = context[first]
        return pa.RecordBatch.from_arrays([pa.array(key[c]), pa.array(pos[c] + number[first]), pa.array(runs.astype(np.int32))], names=["key", "pos", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += batch.column("bytes").nbytes
            if size > _CHUNK:
                table = pa.Table.from_batches(held).combine_chunks()
                fp = table.column("fp").to_numpy()
                other = np.flatnonzero(fp != fp[-1])
                cut = int(other[-1]) + 1 if len(other) else 0
                if cut:
                    yield settle(table.slice(0, cut))
                    table = table.slice(cut)
                held, size = table.to_batches(), sum(b.column("bytes").nbytes * len(b) // max(1, len(table)) for b in table.to_batches()) // max(1, cut or 1)
        if held:
            yield settle(pa.Table.from_batches(held).combine_chunks())

    return run


def _window_rows(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each window with the ranks of its halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, pos, n, state, body in zip(*(batch.column(c).to_pylist() for c in ("key", "pos", "n", "state", "bytes")), strict=True):
                sums = textbytes.prefix_sums(np.frombuffer(body, np.uint8))
                at = np.arange(n)
                half = [textbytes.span_hashes(sums, at + x, at + y).view(np.int64) for x, y in ((0, width // 2), (width // 2, width))]
                yield pa.RecordBatch.from_arrays([pa.array(half[0]), pa.array(half[1]), pa.array([key] * n, pa.int64()), pa.array(pos + at), pa.array([state] * n, pa.int32())], names=["first", "second", "key", "pos", "state"])

    return run


def _remove(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            data, offsets = textbytes.utf8(batch.column("text"))
            for i, (doc, several, marks) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("several").to_pylist(), batch.column("marks"), strict=True)):
                body = data[offsets[i] : offsets[i + 1]]
                cover = np.zeros(len(body) + 1, np.int32)
                if several and len(body) >= width:
                    cover[0], cover[-1] = 1, -1
                elif marks.is_valid:
                    pos, n = (marks.values.field(k).to_numpy() for k in (0, 1))
                    np.add.at(cover, pos, 1)
                    np.add.at(cover, pos + n - 1 + width, -1)
                gone = np.cumsum(cover[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                for column, value in zip(out, (doc, len(body), int(gone.sum()), spans, hashlib.sha256(body[~gone].tobytes()).hexdigest()), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def repeated_intervals(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, run_rows: int = RUN_ROWS) -> DataFrame:
    """(key, pos, n): n window starts from byte pos of the text with this hash repeat elsewhere.

    Texts that several documents have are counted once here.
    """
    texts = docs.select(F.xxhash64("text").alias("key"), "text").where("text IS NOT NULL")
    ranked = texts.mapInArrow(_anchors(width, gram), _ROW).repartition("fp").sortWithinPartitions("fp", "ctx", "key", "pos")
    decided = stored(ranked.mapInArrow(_decide, _ROW), "window-ranks")
    whole = decided.where(F.col("state") == _DECIDED).select("key", "pos", "n")
    asked = decided.where(F.col("state") != _DECIDED).groupBy("key").agg(F.collect_list(F.struct("fp", "pos", "n", "back", "state")).alias("asked"))
    contexts = stored(texts.join(asked, "key").mapInArrow(_contexts(width), _CONTEXT), "window-contexts")
    hot = contexts.groupBy("fp").agg(F.count("*").alias("rows")).where(F.col("rows") > run_rows).select("fp")
    cool = contexts.join(hot, "fp", "left_anti").repartition("fp").sortWithinPartitions("fp", "key", "pos")
    found = whole.union(cool.mapInArrow(_double(width), "key bigint, pos bigint, n int"))
    windows = contexts.join(hot, "fp", "left_semi").mapInArrow(_window_rows(width), "first bigint, second bigint, key bigint, pos bigint, state int")
    place = F.xxhash64("key", "pos")
    twice = windows.groupBy("first", "second").agg(F.min(place).alias("x"), F.max(place).alias("y"), F.max("state").alias("w")).where("x <> y OR w > 0")
    return found.union(windows.where(F.col("state") == _OPEN).join(twice, ["first", "second"], "left_semi").select("key", "pos", F.lit(1).alias("n")))


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes when a string of `width` bytes over it also starts elsewhere, in the same or another document, both
    judged on the input; strings never cross documents. Texts shorter than `width`, empty and null ones (0 bytes)
    lose nothing. Rows are documents even where ids repeat. Other columns are not read; no rows give no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    marks = repeated_intervals(docs, width, gram, run_rows).withColumn("several", F.lit(None).cast("int"))
    copies = rows.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key", F.lit(None).cast("bigint").alias("pos"), F.lit(None).cast("int").alias("n"), F.lit(1).alias("several"))
    of_text = marks.union(copies).groupBy("key").agg(F.max("several").alias("several"), F.collect_list(F.when(F.col("pos").isNotNull(), F.struct(F.col("pos"), F.col("n").cast("bigint").alias("n")))).alias("marks"))
    joined = rows.join(of_text, "key", "left").select("doc_id", "text", "several", "marks")
    return joined.mapInArrow(_remove(width), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
