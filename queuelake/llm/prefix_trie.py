"""The trie of conversations that are rebuilt from a base's head and their own rest, by composable fingerprints.

A sequence of turns has the fingerprint (p, n): its length n and p, the sum of turn codes times powers of a base.
Fingerprints are a monoid: (p, n) and (q, m) combine to (p + B^n q, n + m). So products of parts, of partitions as
much as of heads and rests, give those of the whole, and no rebuilt conversation is ever written out.

1. `coded` sorts turns by conversation and place over range partitions. Each task has the products of its own turns;
   those of conversations that cross a boundary, at most two a partition, are composed and put before. So no task
   needs a whole conversation. Stored turn references hold codes, products and sizes, no texts.
2. `prefixes` combines, for each conversation, the products of the base's head with those of its own rest.
3. Prefixes of equal depth and fingerprint are a node. Its members must refer to turns of one code and have parents of
   one fingerprint, which the same aggregate finds out; by induction over depths members then have equal turns, if
   equal codes mean equal turns, for which roles and texts of repeated codes are compared (`_codes_hold`). Should either
   fail, everything is done again with other codes.
4. A node of one member has a chain below it and ends in one leaf. For the others, leaves and savings are summed over
   subtrees by ancestor jumps that double: as many rounds as the greatest shared depth has binary digits.
5. Ids of the conversations that end at a node are sorted over range partitions, cut into pieces of text, and the
   pieces hashed in order; a node at which a third of all conversations end is spread over tasks but for the hashing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm import textbytes
from queuelake.llm.shared import id_hash, stored, with_ids
from queuelake.session import prepare

#: Conversations in a family, whose first is the base; heads have fewer turns than HEADS.
FAMILY, HEADS = 5, 9
#: Bytes of ids hashed at once.
PIECE_BYTES = 1 << 16
#: The two odd bases of fingerprints (any odd numbers do).
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1

#: (attempt, role, text) -> 16 bytes
Code = Callable[[int, str, str], bytes]


def digest_code(attempt: int, role: str, text: str) -> bytes:
    head = role.encode()
    return hashlib.blake2b(len(head).to_bytes(8, "big") + head + text.encode(), digest_size=16, key=attempt.to_bytes(8, "big")).digest()


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2^64, bit by bit; negative exponents are inverse."""
    out = np.ones(len(exponents), np.uint64)
    for sign in (1, -1):
        left = np.maximum(sign * exponents, 0)
        factor = pow(base, sign, 1 << 64)
        while left.any():
            out[(left & 1).astype(bool)] *= np.uint64(factor)
            factor = factor * factor & _MASK
            left >>= 1
    return out


def combine(a: tuple[int, int, int], b: tuple[int, int, int]) -> tuple[int, int, int]:
    """The fingerprint (length, two products) of one sequence behind another."""
    return (a[0] + b[0], *((a[k + 1] + pow(_BASES[k], a[0], 1 << 64) * b[k + 1]) & _MASK for k in (0, 1)))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy().view(np.uint64)


def _local(attempt: int, code: Code) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Codes of sorted turns, their places and products as far as this task goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, before = TaskContext.get().partitionId(), None, (0, 0, 0)
        for batch in batches:
            if not len(batch):
                continue
            conv = batch.column("conv_id").to_numpy()
            codes = b"".join(code(attempt, r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True))
            codes = np.frombuffer(codes, np.uint64).reshape(-1, 2)
            first, size = textbytes.runs(conv)
            place = np.arange(len(conv)) - np.repeat(first, size)
            # The first run goes on from the batch before, if it is of the same conversation.
            carried = before if last == conv[0] else (0, 0, 0)
            place[: size[0]] += carried[0]
            products = []
            for k in (0, 1):
                sums = np.cumsum(codes[:, k] * _powers(_BASES[k], place), dtype=np.uint64)
                start = np.where(first > 0, sums[first - 1], np.uint64(0)) - np.where(first > 0, np.uint64(0), np.uint64(carried[k + 1]))
                products.append(sums - np.repeat(start, size))
            last, before = conv[-1], (int(place[-1]) + 1, int(products[0][-1]), int(products[1][-1]))
            columns = [batch.column("conv_id"), pa.array(np.full(len(conv), part)), pa.array(place + 1), _long(products[0]), _long(products[1])]
            columns += [_long(np.ascontiguousarray(codes[:, 0])), _long(np.ascontiguousarray(codes[:, 1])), batch.column("n_bytes")]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "idx", "p1", "p2", "t1", "t2", "n_bytes"])

    return run


def _carry(before: dict[tuple[int, int], tuple[int, int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Puts the products of earlier partitions before those of the rows of conversations that cross boundaries."""
    convs = np.array(sorted({c for c, _ in before}), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, part = batch.column("conv_id").to_numpy(), batch.column("part").to_numpy()
            idx, p = batch.column("idx").to_numpy().copy(), [_unsigned(batch, "p1").copy(), _unsigned(batch, "p2").copy()]
            for at in np.unique(np.stack([conv, part])[:, np.isin(conv, convs)], axis=1).T.tolist():
                n, *products = before[tuple(at)]
                rows = (conv == at[0]) & (part == at[1])
                idx[rows] += n
                for k in (0, 1):
                    p[k][rows] = np.uint64(products[k]) + np.uint64(pow(_BASES[k], n, 1 << 64)) * p[k][rows]
            columns = [batch.column("conv_id"), pa.array(idx), _long(p[0]), _long(p[1]), *(batch.column(c) for c in ("t1", "t2", "n_bytes"))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "idx", "p1", "p2", "t1", "t2", "n_bytes"])

    return run


def coded(turns: DataFrame, attempt: int = 0, code: Code = digest_code) -> DataFrame:
    """Stored turn references: (conv_id, idx from 1, product of turns 1 to idx, code, bytes) of non-null (conv_id, turn, role, text)."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first()]
    dealt = turns.select("conv_id", "turn", "role", "text", F.octet_length("text").cast("bigint").alias("n_bytes")).repartitionByRange(*order)
    local = dealt.sortWithinPartitions(*order, "role", "text").mapInArrow(_local(attempt, code), "conv_id bigint, part bigint, idx bigint, p1 bigint, p2 bigint, t1 bigint, t2 bigint, n_bytes bigint")
    local = stored(local, "local-turns")
    ends = local.groupBy("conv_id", "part").agg(F.max(F.struct("idx", "p1", "p2")).alias("end"))
    parts = ends.groupBy("conv_id").agg(F.count("*").alias("parts")).where("parts > 1").select("conv_id")
    # A conversation in several partitions is the first or the last of each: at most two rows a partition.
    crossing = ends.join(parts, "conv_id", "left_semi").orderBy("conv_id", "part").collect()
    before, so_far = {}, {}
    for r in crossing:
        before[r.conv_id, r.part] = so_far.get(r.conv_id, (0, 0, 0))
        so_far[r.conv_id] = combine(before[r.conv_id, r.part], (r.end.idx, r.end.p1 & _MASK, r.end.p2 & _MASK))
    return stored(local.mapInArrow(_carry(before), "conv_id bigint, idx bigint, p1 bigint, p2 bigint, t1 bigint, t2 bigint, n_bytes bigint"), "turns")


def _code_rows(attempt: int, code: Code) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = b"".join(code(attempt, r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True))
            codes = np.frombuffer(codes, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(codes[:, k])) for k in (0, 1)] + [batch.column("role"), batch.column("text")], names=["t1", "t2", "role", "text"])

    return run


def _codes_hold(turns: DataFrame, references: DataFrame, attempt: int, code: Code) -> bool:
    """Whether turns of equal codes have equal roles and texts; only codes that repeat are looked at."""
    shared = stored(references.groupBy("t1", "t2").agg(F.count("*").alias("n")).where("n > 1").select("t1").distinct(), "shared-codes")
    rows = turns.select("role", "text").mapInArrow(_code_rows(attempt, code), "t1 bigint, t2 bigint, role string, text string")
    turn = F.struct("role", "text")
    met = with_ids(rows, shared, "t1").groupBy("t1", "t2").agg(F.min(turn).alias("x"), F.max(turn).alias("y"))
    return met.where("x <> y").isEmpty()


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes that end in a conversation's own rest: the base's head combined with the rest so far."""
    for batch in batches:
        idx, h, hb = (batch.column(c).to_numpy() for c in ("idx", "h", "hb"))
        columns = [batch.column("conv_id"), pa.array(hb + idx - h)]
        parents = []
        for k, base in enumerate(_BASES, 1):
            own, skipped, head, turn = (_unsigned(batch, c) for c in (f"p{k}", f"skipped{k}", f"head{k}", f"t{k}"))
            shift = _powers(base, hb - h)
            columns.append(_long(head + shift * (own - skipped)))
            parents.append(_long(head + shift * (own - skipped - turn * _powers(base, idx - 1))))
        yield pa.RecordBatch.from_arrays([*columns, *parents, *(batch.column(c) for c in ("t1", "t2", "n_bytes"))], names=list(_PREFIX))


_PREFIX = ("conv_id", "depth", "f1", "f2", "g1", "g2", "t1", "t2", "n_bytes")
_PREFIX_DDL = ", ".join(f"{c} bigint" for c in _PREFIX)


def plans(references: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """What each conversation is rebuilt from, stored: base head of hb turns (`base_turns`, `head1`, `head2`), rest after h own turns."""
    early = F.collect_list(F.when(F.col("idx") < heads, F.struct("idx", "p1", "p2", "t1", "t2", "n_bytes")))
    convs = stored(references.groupBy("conv_id").agg(F.max("idx").alias("n"), F.array_sort(early).alias("early")), "conversations")
    own = convs.select("conv_id", "n", "early", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), (id_hash("conv_id") % heads).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("early").alias("base_early"))
    joined = own.join(bases, "base", "left").withColumn("hb", F.least("h", F.coalesce("base_n", F.lit(0))))
    product = lambda turns, n, k: F.when(n > 0, F.element_at(turns, n.cast("int"))[f"p{k}"]).otherwise(F.lit(0)).cast("bigint")
    skipped = F.least("h", "n")
    return stored(
        joined.select(
            "conv_id", "h", "hb",
            (F.col("hb") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
            F.when(F.col("hb") > 0, F.slice("base_early", F.lit(1), F.col("hb").cast("int"))).alias("base_turns"),
            *[product(F.col("base_early"), F.col("hb"), k).alias(f"head{k}") for k in (1, 2)],
            *[product(F.col("early"), skipped, k).alias(f"skipped{k}") for k in (1, 2)],
        ),
        "plans",
    )


def prefixes(references: DataFrame, plan: DataFrame) -> DataFrame:
    """A row for each rebuilt turn, stored: its conversation, depth, the fingerprint of the turns up to it (f1, f2) and up to
    the one before (g1, g2), its code and bytes."""
    heads = plan.where("hb > 0").select("conv_id", F.posexplode("base_turns").alias("at", "turn"), "base_turns")
    parent = lambda k: F.when(F.col("at") > 0, F.col("base_turns")[F.greatest(F.col("at") - 1, F.lit(0))][f"p{k}"]).otherwise(F.lit(0))
    of_heads = heads.select(
        "conv_id", (F.col("at") + 1).cast("bigint").alias("depth"), F.col("turn.p1").alias("f1"), F.col("turn.p2").alias("f2"),
        parent(1).alias("g1"), parent(2).alias("g2"), "turn.t1", "turn.t2", "turn.n_bytes",
    )
    rests = references.join(plan.drop("base_turns", "length"), "conv_id").where("idx > h")
    return stored(of_heads.union(rests.mapInArrow(_rests, _PREFIX_DDL)), "prefixes")


def _nodes(rows: DataFrame) -> DataFrame | None:
    """Nodes but for the root, stored; None if members of one have different last turns or parents."""
    kept = ("g1", "g2", "t1", "t2")
    found = rows.groupBy("depth", "f1", "f2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        *[F.min(c).alias(c) for c in kept], *[F.max(c).alias(f"{c}_max") for c in kept],
    )
    found = stored(found, "nodes")
    if not found.where(" OR ".join(f"{c} <> {c}_max" for c in kept)).isEmpty():
        return None
    return found.select("depth", "f1", "f2", "g1", "g2", "conv_id", "n_convs", "n_bytes")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, f1, f2, conv_id) as pieces of comma-joined ids."""
    node, first, ids, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip((*node, first, ",".join(ids)), (*[pa.int64()] * 4, pa.string()), strict=True)], names=["depth", "f1", "f2", "first", "ids"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "f1", "f2", "conv_id")), strict=True):
            if key != node or size > PIECE_BYTES:
                if ids:
                    held.append(piece())
                node, first, ids, size = key, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if ids:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces, which come in order."""
    node, state = None, None
    out: list[tuple] = []
    schema = pa.schema([("depth", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("ends_sha256", pa.string())])

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "f1", "f2", "ids")), strict=True):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                out.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(ids.encode())
        if out:
            yield flush()
            out = []
    if state is not None:
        out.append((*node, state.hexdigest()))
        yield flush()


def _ends(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256) of the nodes at which conversations end, stored."""
    empty = plan.where("length = 0").select(F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("f1"), F.lit(0).cast("bigint").alias("f2"), "conv_id")
    last = rows.join(plan.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"]).select("depth", "f1", "f2", "conv_id")
    key = ["depth", "f1", "f2"]
    ends = stored(last.union(empty), "ends").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    pieces = stored(ends.mapInArrow(_pieces, "depth bigint, f1 bigint, f2 bigint, first bigint, ids string"), "end-pieces")
    dealt = pieces.repartition(*key).sortWithinPartitions(*key, "first")
    return stored(dealt.mapInArrow(_hashed, "depth bigint, f1 bigint, f2 bigint, ends_sha256 string"), "end-digests")


def _subtrees(tree: DataFrame) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) over whole subtrees, of stored nodes with what each has itself."""
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    jump, at = 1, tree
    while jump <= deepest:
        given = at.where(F.col("depth") >= jump).groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - jump).alias("depth"))
        given = given.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        onward = at.where(F.col("depth") >= jump).select(F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + jump).alias("depth"), F.col("parent_conv_id").alias("next"))
        summed = at.join(given, ["conv_id", "depth"], "left").join(onward, ["parent_conv_id", "depth"], "left")
        at = stored(
            summed.select(
                "conv_id", "depth", F.col("next").alias("parent_conv_id"),
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            ),
            "subtrees",
        )
        jump *= 2
    return at.select("conv_id", "depth", "n_leaves", "saved_tokens")


def conversation_trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS, code: Code = digest_code) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn (null first), equal ones by role and text; null roles and texts are empty. Conversation c
    is rebuilt from the first h turns of c - c % family (all if fewer, none if absent) and its own turns after its first
    h; h is crc32 of the decimal c modulo `heads`, and % has the sign of c. Rows without conv_id belong to no
    conversation and are left out. Repeated rows are turns of their own. Other columns are not read; no rows give no rows.
    """
    prepare(conversations.sparkSession)
    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", empty("role"), empty("text"))
    attempt, nodes = 0, None
    while nodes is None:
        references = coded(turns, attempt, code)
        if _codes_hold(turns, references, attempt, code):
            plan = plans(references, family, heads)
            rows = prefixes(references, plan)
            nodes = _nodes(rows)
        attempt += 1
    all_of = plan.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = all_of.select(*[F.lit(0).cast("bigint").alias(c) for c in ("depth", "f1", "f2")], *[F.lit(None).cast("bigint").alias(c) for c in ("g1", "g2")], "conv_id", "n_convs", F.lit(0).cast("bigint").alias("n_bytes"))
    nodes = nodes.union(root)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("conv_id").alias("parent_conv_id"))
    tree = stored(nodes.join(parents, ["depth", "g1", "g2"], "left"), "tree")

    alone = F.sum((F.col("n_convs") == 1).cast("bigint"))
    below = tree.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"), alone.alias("alone"))
    tree = tree.join(below, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    tree = stored(tree, "tree")
    # Only shared nodes, and the root, have more than a chain below them.
    own_leaves = F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("alone")).cast("bigint")
    shared = tree.where("n_convs > 1 OR depth = 0").select("conv_id", "depth", "parent_conv_id", own_leaves.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    sums = _subtrees(stored(shared, "subtrees"))
    out = tree.join(sums, ["conv_id", "depth"], "left").join(_ends(rows, plan), ["depth", "f1", "f2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
