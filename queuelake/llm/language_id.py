"""Language identification with interpolated Kneser-Ney character models, one per language.

Text becomes symbols: letters in lower case, and one space for every run of anything else. A language's model holds,
for each order up to five, the probability of every seen n-gram in a sorted array of hashes, and the weight of every
seen context for what it has not seen. A document gets the language of the lowest cross-entropy per symbol, and is
rejected when even that is far above what training documents of the language have at such a length.

A classifier may be fitted on a bounded sample: about `FIT_SYMBOLS` characters of each language, whole documents drawn
by a hash of the text. Scoring covers all documents and all of their text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm import textbytes
from queuelake.llm.shared import id_hash, stored
from queuelake.session import prepare

ORDER = 5
#: Characters of each language, on average, that the models are fitted on.
FIT_SYMBOLS = 4_000_000
#: A document is rejected beyond this many standard deviations and this factor of its language's cross-entropy.
REJECT_DEVIATIONS, REJECT_FACTOR = 12.0, 2.0
_FACTOR = [pow(0x9E6C63D0876A9A99, k, 1 << 64) for k in range(ORDER)]
_CACHE_CELLS = 1 << 22

_tables: dict[str, np.ndarray] = {}


def _symbols(points: np.ndarray) -> np.ndarray:
    """Lower-case letter of each code point, 32 for what is no letter."""
    if "symbol" not in _tables:
        table = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                small = c.lower()
                table[i] = ord(small) if len(small) == 1 else i
        _tables["symbol"] = table
    return _tables["symbol"][points]


def streams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all rows, each row after ORDER - 1 spaces; positions to score, their rows, and letters per row."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    symbol = _symbols(points)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(heads[offsets]))
    letter = symbol != 32
    letters = np.bincount(row[letter], minlength=len(offsets) - 1)
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (row[1:] == row[:-1])
    symbol, row = symbol[keep], row[keep]
    count = np.bincount(row, minlength=len(offsets) - 1)
    at = np.arange(len(symbol)) + (ORDER - 1) * (row + 1)
    stream = np.full(len(symbol) + (ORDER - 1) * len(count), 32, np.uint64)
    stream[at] = symbol
    return stream, at, row, letters


def gram_hashes(stream: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Hashes of the n-grams that end at the positions, for n of 1 to ORDER; of n - 1 symbols before it with `at - 1`."""
    out, total = [], np.zeros(len(at), np.uint64)
    for k in range(ORDER):
        total = total + (stream[at - k] + np.uint64(1)) * np.uint64(_FACTOR[k])
        out.append(total)
    return out


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in textbytes.slices(batches):
        langs = np.array(rows.column("lang").to_pylist(), object)
        stream, at, row, _ = streams(data, offsets)
        for lang in sorted(set(langs)):
            mine = at[langs[row] == lang] if len(row) else at
            if not len(mine):
                continue
            _, first, n = np.unique(gram_hashes(stream, mine)[-1], return_index=True, return_counts=True)
            grams = ["".join(map(chr, stream[i - ORDER + 1 : i + 1].tolist())) for i in mine[first].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(grams, pa.string()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])


def _hash(gram: str) -> int:
    return sum((ord(c) + 1) * _FACTOR[k] for k, c in enumerate(reversed(gram))) & ((1 << 64) - 1)


def kneser_ney(counts: dict[str, int], alphabet: int) -> dict[str, list[tuple[np.ndarray, np.ndarray]]]:
    """Sorted hash arrays with log probabilities of the n-grams and log weights of the contexts, for each order."""
    by_order: list[dict[str, int]] = [{} for _ in range(ORDER)]
    by_order[-1] = counts
    for n in range(ORDER - 1, 0, -1):
        # Below the highest order a gram counts once for each symbol seen before it.
        lower: dict[str, int] = defaultdict(int)
        for gram in by_order[n]:
            lower[gram[1:]] += 1
        by_order[n - 1] = lower
    grams, contexts, below = [], [], {}
    for n, own in enumerate(by_order):
        values = list(own.values())
        once, twice = values.count(1), values.count(2)
        discount = once / (once + 2 * twice) if once and twice else 0.5
        total: dict[str, int] = defaultdict(int)
        kinds: dict[str, int] = defaultdict(int)
        for gram, c in own.items():
            total[gram[:-1]] += c
            kinds[gram[:-1]] += 1
        weight = {h: discount * kinds[h] / total[h] for h in total}
        now = {g: (c - discount) / total[g[:-1]] + weight[g[:-1]] * (below[g[1:]] if n else 1 / alphabet) for g, c in own.items()}
        for out, table in ((grams, now), (contexts, weight)):
            keys = np.array([_hash(g) for g in table], np.uint64)
            order = np.argsort(keys)
            out.append((keys[order], np.log(np.array(list(table.values())))[order].astype(np.float32)))
        below = now
    return {"grams": grams, "contexts": contexts}


def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, values = table
    if not len(hashes):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return hashes[at] == keys, values[at]


class Scorer:
    """Log probabilities under every language; those of n-grams met before are kept in a table of fixed size."""

    def __init__(self, model: dict) -> None:
        self.model = model
        self.bits = max(10, (_CACHE_CELLS // max(1, len(model["langs"]))).bit_length() - 1)
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.zeros((len(model["langs"]), 1 << self.bits), np.float32)

    def _work_out(self, stream: np.ndarray, at: np.ndarray) -> np.ndarray:
        here, before = gram_hashes(stream, at), gram_hashes(stream, at - 1)
        out = np.empty((len(self.model["langs"]), len(at)), np.float32)
        for i, tables in enumerate(self.model["tables"]):
            seen, p = _found(tables["grams"][0], here[0])
            p = np.where(seen, p, tables["contexts"][0][1][0] - np.log(self.model["alphabet"])) if len(tables["contexts"][0][1]) else np.full(len(at), -np.log(self.model["alphabet"]))
            for n in range(1, ORDER):
                seen, own = _found(tables["grams"][n], here[n])
                known, weight = _found(tables["contexts"][n], before[n - 1])
                p = np.where(seen, own, p + np.where(known, weight, 0))
            out[i] = p
        return out

    def rows(self, stream: np.ndarray, at: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Summed log probability of each row under each language."""
        keys = gram_hashes(stream, at)[-1]
        slot = (textbytes.mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)
        hit = self.keys[slot] == keys
        miss = np.flatnonzero(~hit)
        new = np.empty((len(self.values), 0), np.float32)
        if len(miss):
            _, first, inverse = np.unique(keys[miss], return_index=True, return_inverse=True)
            new = self._work_out(stream, at[miss[first]])
            where = slot[miss[first]]
        out = np.empty((len(self.values), n))
        for i in range(len(self.values)):
            p = self.values[i][slot]
            if len(miss):
                p[miss] = new[i][inverse]
            out[i] = np.bincount(row, weights=p, minlength=n)
        if len(miss):
            where, one = np.unique(where, return_index=True)
            self.keys[where] = keys[miss[first]][one]
            self.values[:, where] = new[:, one]
        return out


def _entropies(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    """Rows (doc_id, fold, lang, letters, symbols, best, entropy, margin)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for rows, data, offsets in textbytes.slices(batches):
            stream, at, row, letters = streams(data, offsets)
            size = np.bincount(row, minlength=len(rows))
            per = scorer.rows(stream, at, row, len(rows)) / np.maximum(size, 1)
            if len(per):
                best = per.argmax(axis=0)
                top = per[best, np.arange(len(rows))]
                # Share of the best language when at most 40 symbols count as evidence.
                share = 1 / np.exp((per - top) * np.minimum(size, 40)).sum(axis=0)
            else:
                best, top, share = np.zeros(len(rows), np.int64), np.zeros(len(rows)), np.zeros(len(rows))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("fold"), rows.column("lang"), pa.array(letters, pa.int64()), pa.array(size, pa.int64()), pa.array(best, pa.int64()), pa.array(-top, pa.float64()), pa.array(share, pa.float64())],
                names=["doc_id", "fold", "lang", "letters", "symbols", "best", "entropy", "share"],
            )

    return run


_ENTROPY = "doc_id bigint, fold bigint, lang string, letters bigint, symbols bigint, best bigint, entropy double, share double"


def fit(docs: DataFrame, fit_symbols: int = FIT_SYMBOLS) -> dict:
    """Models from rows with text and lang whose fold (crc32 of the id as text, modulo 3) is not 1."""
    known = docs.select("doc_id", "text", "lang").where((id_hash() % 3 != 1) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = known.groupBy("lang").agg(F.sum(F.length("text")).alias("size"))
    # Two to the 63 times the share of a language's documents to take.
    limit = (F.least(F.lit(1.0), F.lit(float(fit_symbols)) / F.col("size")) * 9.2e18).cast("bigint")
    drawn = known.join(F.broadcast(sizes.select("lang", limit.alias("limit"))), "lang")
    drawn = stored(drawn.where(F.xxhash64("text", F.lit(7)).bitwiseAND(F.lit((1 << 63) - 1)) <= F.col("limit")).select("doc_id", "text", "lang"), "language-sample")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for r in drawn.select("text", "lang").mapInArrow(_count_grams, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r.lang][r.gram] = r.n
    langs = sorted(counts)
    alphabet = len({c for grams in counts.values() for g in grams for c in g}) + 1
    model = {"langs": langs, "alphabet": alphabet, "tables": [kneser_ney(counts[x], alphabet) for x in langs]}
    # Cross-entropies of the sample by language: mean, and the spread of one symbol's.
    spread = {x: (0.0, 0.0) for x in langs}
    if langs:
        place = docs.sparkSession.sparkContext.broadcast(model)
        scored = drawn.select("doc_id", F.lit(0).cast("bigint").alias("fold"), "text", "lang").mapInArrow(_entropies(place), _ENTROPY).where("symbols > 0")
        mean = F.sum(F.col("entropy") * F.col("symbols")) / F.sum("symbols")
        means = {r.lang: r.m for r in scored.groupBy("lang").agg(mean.alias("m")).collect()}
        centre = F.element_at(F.create_map(*[F.lit(v) for kv in means.items() for v in kv]), F.col("lang"))
        for r in scored.groupBy("lang").agg(F.sqrt(F.avg(F.pow(F.col("entropy") - centre, 2) * F.col("symbols"))).alias("s")).collect():
            spread[r.lang] = (means[r.lang], r.s)
    return model | {"spread": [spread[x] for x in langs]}


def identify(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected, entropy (nats per symbol).

    held_out marks rows whose crc32(doc_id as text) modulo 3 is 1 (null ids count as empty text); without `model` it
    is fitted on the others. Null texts and texts without a letter are `und` with score 0 and are rejected. If there
    is nothing to learn from, every row is. `rejected` is a decision beside the language: lang_pred stays the nearest.
    Ties go to the language that sorts first. Columns beyond doc_id, text and lang are not read.
    """
    spark = prepare(docs.sparkSession)
    model = fit(docs) if model is None else model
    langs, spread = model["langs"], model["spread"]
    place = spark.sparkContext.broadcast(model)
    rows = docs.select("doc_id", id_hash().alias("crc"), "text").select("doc_id", (F.col("crc") % 3).alias("fold"), "text", F.lit(None).cast("string").alias("lang"))
    scored = rows.mapInArrow(_entropies(place), _ENTROPY)
    known = (F.col("letters") > 0) & F.lit(bool(langs))
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("best") + 1).cast("int"))
    mean, deviation = pick([s[0] for s in spread] or [0.0]), pick([s[1] for s in spread] or [0.0])
    far = (F.col("entropy") > mean + REJECT_DEVIATIONS * deviation / F.sqrt("symbols")) & (F.col("entropy") > REJECT_FACTOR * mean)
    return scored.select(
        "doc_id",
        (F.col("fold") == 1).alias("held_out"),
        F.when(known, pick(langs or ["und"])).otherwise("und").alias("lang_pred"),
        F.when(known, F.col("share")).otherwise(0.0).alias("score"),
        (~known | far).alias("rejected"),
        "entropy",
    )
