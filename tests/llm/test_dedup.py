"""Exact, near and substring duplicates, and near vectors, against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from tests_prose import prose

from queuelake.llm import embedding_dedup, exact_dedup, jaccard_join, substring_dedup
from queuelake.llm.shared import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def rows_of(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def union(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_exact(rows):
    groups = {}
    for i, text, *_ in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(body, []).append((-len(text or ""), i is None, i or 0, i))
    out = []
    for body, members in groups.items():
        keep = min(members)[3]
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(m[3], keep, len(members), m[3] == keep, sha) for m in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_bytes,key", [(16 << 20, exact_dedup.digest_key), (64, exact_dedup.digest_key), (256, lambda b: len(b) % 2), (1 << 20, lambda b: -5)])
def test_exact_groups(as_docs, odd_rows, bucket_bytes, key):
    """Also with keys that collide, buckets that split and a key that needs pages."""
    rows = odd_rows + [(100 + i, f"text {i % 7}", "en", "s") for i in range(60)]
    found = exact_dedup.exact_groups(as_docs(rows), bucket_bytes, key)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(rows)


def test_exact_directory_doubles(as_docs):
    rows = [(i, f"text {i}" + "x" * 50, "en", "s") for i in range(200)] + [(1000 + i, "copy" * 30, "en", "s") for i in range(40)]
    index = exact_dedup.index_entries(as_docs(rows)).drop("body").cache()
    buckets = exact_dedup.directory(index, 400)
    assert len(buckets) > 16 and max(b[1] for b in buckets) > 4
    assert [b[0] for b in buckets] == sorted({b[0] for b in buckets}) and buckets[0][0] == 0


def shingle_sets(rows, width=5):
    out = {}
    for i, text, *_ in rows:
        words = WORD.findall((text or "").encode().lower())
        out.setdefault(i, []).append({tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set())
    return out


def brute_near(rows):
    sets = {i: s for i, s in shingle_sets(rows).items() if i is not None}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b])
    ]
    return union(links, sets)


def near_rows(seed, groups=8, copies=9):
    draw, rows, at = random.Random(seed), [], 1000
    for g in range(groups):
        base = prose(seed * 100 + g, draw.choice([4, 5, 9, 40, 150]))
        for c in range(copies):
            words = list(base)
            for _ in range(draw.randrange(0, max(1, len(base) // 16) + 1)):
                words[draw.randrange(len(words))] = f"x{draw.randrange(1000)}"
            if c % 3 == 2:
                words += prose(at, draw.randrange(0, len(base) // 4 + 1))
            rows.append((at, " ".join(words), "en", "s"))
            at += 1
    return rows


@pytest.mark.parametrize("block_nodes,cluster_nodes", [(512, 50_000), (2, 50_000), (512, 1)])
def test_near_duplicates(as_docs, odd_rows, block_nodes, cluster_nodes):
    """Also with blocks of two nodes, and with every cluster too large for tiles."""
    rows = odd_rows + near_rows(3)
    found = jaccard_join.near_duplicates(as_docs(rows), block_nodes=block_nodes, cluster_nodes=cluster_nodes)
    expected, sizes = brute_near(rows), shingle_sets(rows)
    assert len(rows) == found.count()
    for r in found.collect():
        assert r.component_id == (expected[r.doc_id] if r.doc_id is not None else None), r
        assert r.n_shingles in {len(s) for s in sizes[r.doc_id]}
    assert len(set(expected.values())) < len(expected) - 20


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_lists_are_cut_where_nothing_leads_on(batch):
    """Every pair that a list has to propose stays in one part of it, however the rows are cut in batches."""
    draw = random.Random(6)
    rows = sorted((draw.randrange(12), int(1.3 ** draw.randrange(1, 14)) + draw.randrange(3), node) for node in range(160))
    leads = [draw.random() < 0.4 for _ in rows]
    table = pa.table({"shingle": [r[0] for r in rows], "node": [r[2] for r in rows], "size": pa.array([r[1] for r in rows], pa.int32()), "leads": leads})
    twice = table.take(pa.array([i for i in range(len(rows)) for _ in range(1 + i % 2)]))
    found = [r for b in jaccard_join._in_lists(80)(iter(twice.to_batches(max_chunksize=batch))) for r in b.to_pylist()]
    part = {r["node"]: r["shingle"] for r in found}
    assert len(part) == len(found)
    pairs = [(x[2], y[2]) for i, x in enumerate(rows) for y in rows[i + 1 :] if leads[i] and x[0] == y[0] and 100 * x[1] >= 80 * y[1]]
    assert all(part[x] == part[y] for x, y in pairs)
    assert set(part) == {node for pair in pairs for node in pair}
    assert len(set(part.values())) > 12


def test_overlap_bound_never_below():
    draw = np.random.default_rng(4)
    for n, m in ((1, 1), (30, 37), (200, 160), (900, 5)):
        a, b = (np.unique(draw.integers(0, 1 << 60, k, dtype=np.uint64)) for k in (n, m))
        b[: min(n, m) // 2] = a[: min(n, m) // 2]
        b = np.unique(b)
        bound = jaccard_join.overlap_bound(jaccard_join._signature(a), len(a), jaccard_join._signature(b), len(b))
        assert bound >= len(np.intersect1d(a, b))


def test_components(spark):
    draw = random.Random(9)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(300)] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7), (1000, 5)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r.id: r.component_id for r in components(frame).collect()} == {i: c for i, c in union(links, range(1001)).items() if i in linked}


def brute_remove(rows, width):
    count = {}
    for _, text, *_ in rows:
        body = (text or "").encode()
        for k in range(len(body) - width + 1):
            count[body[k : k + width]] = count.get(body[k : k + width], 0) + 1
    out = []
    for i, text, *_ in rows:
        body = (text or "").encode()
        gone = np.zeros(len(body) + 2, bool)
        for k in range(len(body) - width + 1):
            if count[body[k : k + width]] > 1:
                gone[k + 1 : k + 1 + width] = True
        kept = bytes(b for b, g in zip(body, gone[1:], strict=False) if not g)
        out.append((i, len(body), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width,gram,run_rows", [(40, 16, 20_000), (40, 16, 1), (64, 8, 20_000)])
def test_remove_repeats(as_docs, odd_rows, width, gram, run_rows):
    """Passages at any offset, runs of one byte, periods, copies; also with every gram too frequent for one task."""
    draw, passage = random.Random(8), " ".join(prose(77, 30))
    rows = [r for r in odd_rows if r[0] != 7]
    for i in range(30):
        begin = draw.randrange(len(passage) - 60)
        cut = passage[begin : begin + draw.randrange(20, 160)]
        rows.append((100 + i, " ".join(prose(i, draw.randrange(0, 40))) + cut + " ".join(prose(900 + i, draw.randrange(0, 30))), "en", "s"))
    rows += [(200, "a" * 150, "en", "s"), (201, "ab" * 60, "en", "s"), (202, "xyz" * 50 + "tail", "en", "s"), (203, "é" * 45, "en", "s"), (204, "a" * 39, "en", "s")]
    found = substring_dedup.remove_repeats(as_docs(rows), width, gram, run_rows)
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_remove(rows, width)


def test_near_vectors(spark):
    draw = np.random.default_rng(3)
    vectors, at = [], 0
    for label in (0, 1, None):
        for base in draw.normal(size=(40, 32)):
            for _ in range(int(draw.integers(1, 6))):
                vectors.append((at, [float(x) for x in (base + draw.normal(scale=0.06, size=32)) * draw.uniform(0.5, 3)], label))
                at += 1
    same = vectors[3][1]
    vectors += [(at + i, same, 0) for i in range(5)] + [(at + 9, same, 1), (at + 10, [x * 2 for x in same], 0)]
    odd = [(900, None, 0), (901, [], 0), (902, [0.0] * 32, 0), (903, [float("nan")] + same[1:], 0), (904, [None] + same[1:], 0), (905, same[:16], 0), (None, same, 0), (906, [float("inf")] + same[1:], 1)]
    frame = spark.createDataFrame([(*v, i, i) for i, v in enumerate(vectors + odd)], "vec_id bigint, embedding array<float>, label int, node bigint, pieces bigint").repartition(4)
    units = {i: np.array(np.float32(v), float) / np.linalg.norm(np.array(np.float32(v), float)) for i, v, _ in vectors}
    labels = {i: x for i, _, x in vectors}
    true = [(a, b) for a in units for b in units if a < b and labels[a] is not None and labels[a] == labels[b] and units[a] @ units[b] >= 0.98]
    for tile_rows in (2048, 3):
        found = {r.vec_id: r for r in embedding_dedup.near_vectors(frame, tile_rows=tile_rows).collect() if r.vec_id is not None}
        degree = {i: sum(i in p for p in true) for i in units}
        assert all(found[i].n_links <= degree[i] for i in units)
        assert sum(found[i].n_links for i in units) >= 0.97 * sum(degree.values()) > 100
        expected = union(true, units)
        assert sum(found[i].component_id != expected[i] for i in units) <= len(units) // 50
        for i in (900, 901, 902, 903, 904, 905, 906):
            assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)


@pytest.mark.parametrize("size,width", [(2, 16), (5, 16), (8, 16), (16, 16), (32, 16), (64, 16), (200, 16), (64, 22)])
def test_recall_just_above_the_threshold(spark, monkeypatch, size, width):
    """Pairs at a cosine of 0.981, whatever the dimension and the width of the pieces."""
    monkeypatch.setattr(embedding_dedup, "PIECE_BITS", width)
    draw = np.random.default_rng(size)
    rows, planted = [], 250
    for i in range(planted):
        one = draw.normal(size=size)
        one /= np.linalg.norm(one)
        side = draw.normal(size=size)
        side -= one * (side @ one)
        other = 0.981 * one + np.sqrt(1 - 0.981**2) * side / np.linalg.norm(side)
        # A label for every pair: the pair is found, or nothing is.
        rows += [(2 * i, [float(x) for x in one], i), (2 * i + 1, [float(x) for x in other], i)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").coalesce(4)
    found = embedding_dedup.near_vectors(frame).where("n_links = 1").count()
    assert found >= 0.95 * 2 * planted, found / planted / 2


def test_tile_gives_few_links():
    """A tile joins its components by fewer links than it has components, whatever the pairs that link."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    # A group of 60 near copies and one far set.
    sets = [np.sort(np.concatenate([base[:-4], rng.integers(0, 1 << 63, 4, dtype=np.uint64)])) for _ in range(60)]
    sets += [np.sort(rng.integers(0, 1 << 63, 200, dtype=np.uint64))]
    linked = {(a, b) for a in range(61) for b in range(a + 1, 61) if jaccard_join._links(jaccard_join._shared(sets[a], sets[b]), 200, 200, 80)}
    for components_ in (list(range(61)), [0] * 30 + list(range(30, 61))):
        for block in ([0] * 61, [i % 2 for i in range(61)]):
            table = pa.table({
                "node": pa.array(range(61), pa.int64()), "n": pa.array([200] * 61, pa.int64()), "component": pa.array(components_, pa.int64()), "block": pa.array(block, pa.int32()),
                "bits": pa.array([jaccard_join._signature(s, 16) for s in sets], pa.binary()), "hashes": pa.array([s.tobytes() for s in sets], pa.binary()),
                "tile_x": pa.array([0] * 61, pa.int32()), "tile_y": pa.array([max(block)] * 61, pa.int32()),
            })
            found = [(r["a"], r["b"]) for r in jaccard_join._tile(80)(table).to_pylist()]
            assert set(found) <= linked
            assert len(found) < len(set(components_))
            tried = [(a, b) for a, b in linked if block[a] != block[b] or not max(block)]
            whole = [(components_[a], components_[b]) for a, b in tried]
            assert union([(components_[a], components_[b]) for a, b in found], components_) == union(whole, components_)


def test_long_nodes_take_more_places(as_docs, monkeypatch):
    """Blocks cut by size give the same components as blocks cut by nodes."""
    monkeypatch.setattr(jaccard_join, "NODE_SHINGLES", 20)
    texts = [" ".join(prose(f"{n} {k}", n)) for n in (30, 60, 120, 240) for k in range(3)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(100 + i, t + " more", "en", "s") for i, t in enumerate(texts)]
    found = rows_of(jaccard_join.near_duplicates(as_docs(rows), block_nodes=2), "doc_id", "component_id")
    assert found == sorted([(i, i) for i in range(12)] + [(100 + i, i) for i in range(12)], key=repr)


@pytest.mark.parametrize("run", [exact_dedup.exact_groups, jaccard_join.near_duplicates, substring_dedup.remove_repeats])
def test_no_rows(as_docs, run):
    assert run(as_docs([(1, "x", "en", "s")]).where("doc_id = 0")).count() == 0


def test_no_vectors(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_sets_of_tiles_are_not_stored(as_docs, monkeypatch):
    """Bitmaps and arrays of a cluster's nodes go from the texts to the tiles, without a copy of them in between."""
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :]), "en", "s") for i in range(0, 240, 2)]
    whole, done = [], jaccard_join.stored

    def stored(frame, name):
        out = done(frame, name)
        if name == "sets":
            whole.append(out.where("bits IS NOT NULL AND hashes IS NOT NULL").count())
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    # No hub links these, so their lists are left to the tiles.
    monkeypatch.setattr(jaccard_join._Sets, "verified", lambda self, pairs, bitmaps: pairs.limit(0))
    found = rows_of(jaccard_join.near_duplicates(as_docs(rows), block_nodes=8), "doc_id", "component_id")
    assert found == sorted([(r[0], 0) for r in rows], key=repr) and whole and not any(whole)
