"""Words, their near words and forms, against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from queuelake.llm import spelling_variants as sv

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, min_length=6, min_count=5):
    n = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: k for w, k in n.items() if len(w) >= min_length and k >= min_count}


def brute_variants(n):
    near = {w: set() for w in n}
    masks = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            masks[w[:i] + "\0" + w[i + 1 :]].add(w)
            less = w[:i] + w[i + 1 :]
            if less in n:
                near[w].add(less)
                near[less].add(w)
    for words in masks.values():
        for w in words:
            near[w] |= words - {w}
    form = {w: max(near[w], key=lambda x: (n[x], [-ord(c) for c in x] + [1]), default=None) for w in n}
    form = {w: f if f is not None and n[f] >= 5 * n[w] else None for w, f in form.items()}
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def found(frame):
    rows = [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def words_of(spark, n):
    return spark.createDataFrame([(w, k, 1) for w, k in n.items()], "word string, n bigint, key int").repartition(4)


def edited(rng, word, letters):
    i, kind = rng.randrange(len(word) + 1), rng.randrange(3)
    return (word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :])[kind]


def test_documents(as_docs, odd_rows):
    """Null ids and texts, capitals within and beyond ASCII, signs inside the range, dropped letters, repeated rows."""
    rng = random.Random(4)
    base = ["conversation", "éléphant", "Straße" * 2, "sep×arated", "abcdef", "ABCDEFG", "abcdefgh", "zzzzzz", "Ätherisch", "ätherisch"]
    rows = [(900 + i, " ".join(rng.choice(base) if rng.random() < 0.8 else edited(rng, rng.choice(base), "aeé") for _ in range(200)), None, None) for i in range(30)]
    rows += odd_rows + [(None, "short run conversatio3n", None, None)] * 9
    words = brute_words(rows)
    assert any(f is not None for _, f, *_ in brute_variants(words))
    assert found(sv.spelling_variants(as_docs(rows))) == brute_variants(words)


def test_typos_hit_whole_runs(as_docs):
    rows = [(i, "Wordlike morelike " * 3, None, None) for i in range(400)]
    assert {(r.word, r.n) for r in sv.vocabulary(as_docs(rows), min_length=1, min_count=1).collect()} == set(brute_words(rows, 1, 1).items())


@pytest.mark.parametrize("part_words", [sv.PART_WORDS, 40, 7])
def test_variants(spark, part_words):
    """All lengths from one letter, ties of counts, chains of forms, lists that are cut into parts, other scripts."""
    rng = random.Random(part_words)
    n = {"".join(x): rng.choice([1, 5, 5, 25, 125]) for k in (1, 2, 3, 4) for x in itertools.product("abc", repeat=k)}
    for stem in ("aaaaaaaaaa", "banane" * 3, "слово" * 2, "x" * 130, "\U0001f600" * 5, "ab" * 40):
        words = [stem]
        for _ in range(60):
            words.append(edited(rng, rng.choice(words), stem[:2] + "c"))
        n.update({w: rng.choice([1, 2, 10, 50, 250, 1250]) for w in words if w})
    assert found(sv.variants(words_of(spark, n), part_words=part_words)) == brute_variants(n)


def test_odd_words(spark):
    assert found(sv.variants(words_of(spark, {}))) == set()
    rows = spark.createDataFrame([("", 9), (None, 9), ("word", None), ("words", 4), ("wordy", 20)], "word string, n bigint")
    assert found(sv.variants(rows)) == {("words", "wordy", "wordy", 4, 1, 20), ("wordy", None, "wordy", 20, 1, None)}


def test_very_long_word(as_docs):
    long = "q" * 50_000
    rows = [(i, f"{long} {long}x {long[:100]}r", None, None) for i in range(5)]
    assert found(sv.spelling_variants(as_docs(rows))) == brute_variants(brute_words(rows))


def test_cells_are_bounded(spark, monkeypatch):
    """The index of a class is cut between lists, never inside one."""
    n = {a + b + c: 1 + i for i, (a, b, c) in enumerate(itertools.product("abcdefgh", "xyz", ("lmn", "lon", "lm", "mlmn")))}
    whole = found(sv.variants(words_of(spark, n)))
    rows = sv.filed(words_of(spark, n)).withColumns({"as_index": sv.F.lit(True), "as_query": sv.F.lit(True)}).toArrow()
    monkeypatch.setattr(sv, "CELLS", 1)
    monkeypatch.setattr(sv, "PAIRS", 3)
    total = Counter()
    for r in sv._near(rows).to_pylist():
        total[r["word"]] += r["n_near"]
    assert {w: total[w] for w in n} == {w: near for w, _, _, _, near, _ in whole} and whole == brute_variants(n)


def test_sets_against_edit_distance():
    """One list of the index, bit by bit: 70 words in two lanes."""
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([5, 6]))) for _ in range(400)})
    codes = np.concatenate([np.frombuffer(w.encode(), np.uint8) for w in words]).astype(np.int64) - 97
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths) - lengths
    index = sv.Lanes(codes, starts, lengths, 2)
    lanes = np.tile(np.arange(index.lanes), len(words))
    near = {(w, x) for w in words for x in words if w != x and any(w[:i] + w[i + 1 :] in (x, x[:i] + x[i + 1 :]) or x[:i] + x[i + 1 :] == w for i in range(7))}
    near = {(w, x) for w, x in near if abs(len(w) - len(x)) == 1 or (len(w) == len(x) and sum(a != b for a, b in zip(w, x, strict=True)) == 1)}
    for head, longer in itertools.product((True, False), repeat=2):
        asked = [i for i, w in enumerate(words) if len(w) == 5 + longer]
        of = np.repeat(asked, index.lanes)
        sets = sv.near_sets(index, lanes[: len(of)], codes, starts[of], 5, longer, 2, head)
        got = {(words[q], words[64 * int(lane) + b]) for q, lane, bits in zip(of, lanes, sets, strict=False) for b in range(64) if int(bits) >> b & 1}
        wanted = {(w, x) for w, x in near if len(w) == 5 + longer and len(x) in ((5,) if longer else (5, 6)) and (w[:2] == x[:2]) == head}
        assert got == wanted
