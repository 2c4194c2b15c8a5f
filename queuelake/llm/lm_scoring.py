"""Language-model scoring by logistic context mixing.

The text of a document is a sequence of words (lower-case A-Z, split at white space) and one end, which counts as the
empty word. Every word is coded letter by letter up to a closing zero, and a letter by the bits of a prefix code that depends on
the letter before and is short for letters that often follow it: several predictors, each a table of bit counts under
a hash of the last letters, of all letters of the word so far, or of these and the word before, are turned into log
odds and added with weights from a gate, which is chosen by the place in the word and by how many of the contexts have
been seen. An adaptive table refines the sum under the same gate. Code, tables, weights and refinement are learned from
every token of the training documents: code and tables by counting, weights online, each token predicted as if it had
not been counted; parts of the tokens learn apart and are averaged. A block of documents works out each distinct pair
of a word and the word before it once, with the number of its tokens as its weight, and of a pair only what depends on
the word before; all else is worked out once for all pairs of a word. Within a document the mixer's probability of a
word is averaged with the word's share of the document so far.

Counts of all words, for the base, grow with the corpus and are joined to the words of each block. Only the bit
tables have a fixed size.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm import textbytes
from queuelake.llm.shared import id_hash, stored
from queuelake.session import prepare

#: Letters of context of each bit predictor; 0 stands for all letters so far, -1 for those and the word before.
ORDERS = (1, 2, 3, 4, 6, 0, -1)
_CELLS = 1 << 20
#: Parts in which the counts of a predictor are added up.
_PIECES = 8
_PLACES, _LEVELS = 8, len(ORDERS) + 1
_GATES = _PLACES * _LEVELS
_BINS = 33
#: Sums of weighted log odds are rounded to this many steps from -12 to 12.
_STEPS = 1536
#: How many tokens of a document's own the mixer's probability is worth.
_PRIOR = 1000.0
_BLOCK_BYTES = 14 << 20
#: Rows of a block have numbers of two bytes.
_BLOCK_ROWS = 1 << 16
#: The hash of the empty word.
_END = np.uint64(0)
#: Pairs worked out and learned from at once; lessons are shorter until the first pairs are learned.
_CHUNK, _LESSON, _FIRST_LESSON, _FIRST_PAIRS = 16384, 8192, 512, 40_960
#: Log odds are kept in a byte, 0 where nothing was counted; a seen cell's are a multiple of a tenth.
_LEVEL_ODDS = ((np.arange(256) - 128) / 10).astype(np.float32)
_LEVEL_ODDS[[0, 128]] = 0, 1e-6


# --- words of blocks ---------------------------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows, bytes and offsets of blocks of documents. Spark's batches are far smaller: what they share is worked out
    once for all of a block."""
    held, size, rows = [], 0, 0
    for batch in batches:
        for part in (batch.slice(k, _BLOCK_ROWS) for k in range(0, len(batch), _BLOCK_ROWS)):
            more = part.column("text").nbytes
            if held and (size + more > _BLOCK_BYTES or rows + len(part) > _BLOCK_ROWS):
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size, rows = [], 0, 0
                yield from textbytes.slices(whole, _BLOCK_BYTES)
            held, size, rows = [*held, part], size + more, rows + len(part)
    if held:
        yield from textbytes.slices(pa.Table.from_batches(held).combine_chunks().to_batches(), _BLOCK_BYTES)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct value is first, in that order, and which of them each value is."""
    which = pa.array(values).dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.empty(which.max() + 1 if len(which) else 0, np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    return first, which


def _spans(low: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words, by stretches of rows that need little memory."""
    row, out = 0, []
    while row < len(offsets) - 1:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + textbytes.SLICE_BYTES, "right")) - 1)
        a, b = offsets[row], offsets[last]
        here = slice(np.searchsorted(starts, a), np.searchsorted(starts, b) if b < len(low) else len(starts))
        out.append(textbytes.span_hashes(textbytes.prefix_sums(low[a:b]), starts[here] - a, ends[here] - a))
        row = last
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a slice and how often it has them."""
    for _, data, offsets in _blocks(batches):
        data = textbytes.lower(data)
        starts, ends, _ = textbytes.words(data, offsets)
        first, which = _distinct(_spans(data, offsets, starts, ends))
        n = pa.array(np.bincount(which, minlength=len(first)), pa.int64())
        yield pa.RecordBatch.from_arrays([textbytes.gather(data, starts[first], ends[first]), n], names=["word", "n"])


class Tokens:
    """Tokens of a slice in order, ends of documents included: their rows, the distinct words (in `words`, `end` is the
    empty one, `word` for each pair) and the distinct pairs of a word and the word before (the hash of that in
    `before`), those of a word together."""

    def __init__(self, low: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, row = textbytes.words(low, offsets)
        own = _spans(low, offsets, starts, ends)
        rows = np.arange(len(offsets) - 1)
        close = np.searchsorted(row, rows, "right")
        own, self.row = np.insert(own, close, _END), np.insert(row, close, rows)
        starts, ends = np.insert(starts, close, offsets[1:]), np.insert(ends, close, offsets[1:])
        first, self.token = _distinct(own)
        self.words, self.end = textbytes.gather(low, starts[first], ends[first]), self.token[-1]
        hashes = np.append(np.zeros(1, np.uint64), textbytes.mix(own[first] + np.uint64(1)))
        del starts, ends, own
        before = np.zeros(len(self.token), np.int64)
        before[1:] = self.token[:-1] + 1
        before[np.flatnonzero(np.diff(self.row, prepend=-1))] = 0
        self.key = self.token * (len(first) + 1) + before
        key = np.sort(self.key)
        begin, self.n = textbytes.runs(key)
        self.word, before = np.divmod(key[begin], len(first) + 1)
        self.before = hashes[before]

    def pair(self) -> np.ndarray:
        """Which pair each token is."""
        pair = np.empty(len(self.key), np.int64)
        pair[np.argsort(self.key)] = np.repeat(np.arange(len(self.n)), self.n)
        return pair

    def chunks(self, size: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, slice]]:
        """Words, and of each pair its word, the hash of the one before, how many tokens it has, and where it is."""
        for start in range(0, len(self.word), size):
            yield self.chunk(start, size)

    def chunk(self, start: int, size: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, slice]:
        part = slice(start, min(start + size, len(self.word)))
        word = self.word[part]
        return self.words.slice(word[0], word[-1] - word[0] + 1), word - word[0], self.before[part], self.n[part], part


_POSTINGS = "block bigint, word binary, rows binary, times binary, docs binary"


def _postings(table, mixer: Mixer) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    """For each block of documents, a row for each distinct word (in which rows, how often) and one that names the
    rows and has their scores, as one Arrow table in a column: lists would cost every row of a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block = context.partitionId() << 32 if context else 0
        names = [c.split()[0] for c in _POSTINGS.split(", ")]
        for docs, data, offsets in _blocks(batches):
            low = textbytes.lower(data)
            tokens = Tokens(low, offsets)
            pair = tokens.token * len(docs) + tokens.row
            pair.sort()
            begin, times = textbytes.runs(pair)
            word_of, row_of = np.divmod(pair[begin], len(docs))
            inside = word_of != tokens.end
            word_of, row_of, times = word_of[inside], row_of[inside].astype(np.uint16), times[inside]
            words = tokens.words.take(pa.array(np.delete(np.arange(len(tokens.words)), tokens.end)))
            begin, size = textbytes.runs(word_of)
            cut = lambda values, width: pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.append(begin, len(word_of)).astype(np.int32) * np.int32(width)), pa.py_buffer(values.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(size), block)), words, cut(row_of, 2), cut(times.astype(np.uint32), 4), pa.nulls(len(size), pa.binary())], names=names)
            score = document_scores(tokens, len(docs), *table.value, mixer)
            facts = [docs.column("doc_id"), docs.column("held_out"), pa.array(np.diff(offsets)), pa.array(score)]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, (facts := pa.RecordBatch.from_arrays(facts, names=["doc_id", "held_out", "bytes", "score"])).schema) as out:
                out.write_batch(facts)
            none = pa.nulls(1, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([b""], pa.binary()), none, none, pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=names)
            block += 1

    return run


# --- spelling ----------------------------------------------------------------------------------------------------


class Code:
    """A prefix code of letters after each letter (256: none), from how often they follow; even if that is not given.

    `base` and `size` say for each letter before and letter where its bits are in `node` (hashes of the bits before)
    and `value`, and how many there are.
    """

    def __init__(self, follow: np.ndarray | None = None) -> None:
        words = [_prefix_code(row) for row in follow] if follow is not None else [_prefix_code(np.zeros(256))] * 257
        self.size = np.array([n for row in words for n, _ in row], np.int64)
        self.base = np.cumsum(self.size) - self.size
        bits = np.repeat(np.array([b for row in words for _, b in row], np.uint64), self.size)
        left = np.repeat(self.base + self.size, self.size) - np.arange(len(bits))
        node = (bits | np.repeat(np.uint64(1) << self.size.astype(np.uint64), self.size)) >> left.astype(np.uint64)
        self.node = node * np.uint64(0x9E3779B97F4A7C15)
        self.value = ((bits >> (left - 1).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


def _prefix_code(n: np.ndarray) -> list[tuple[int, int]]:
    """Number of bits and bits of each letter, shortest for the most frequent. Letters that are never there count a
    little; lengths stay far below 64 bits, as counts are brought to one scale first."""
    if not n.any():
        return [(8, s) for s in range(256)]
    heap = [(int(c), k, (k,)) for k, c in enumerate(1 + (n.astype(float) * (1 << 24) / n.sum()).astype(np.int64))]
    heapq.heapify(heap)
    size, bits = [0] * len(n), [0] * len(n)
    while len(heap) > 1:
        (a, k, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        for bit, side in enumerate((left, right)):
            for s in side:
                bits[s] |= bit << size[s]
                size[s] += 1
        heapq.heappush(heap, (a + b, k, left + right))
    return list(zip(size, bits, strict=True))


_EVEN = Code()


class Spelled:
    """Letters of words laid end to end, each word closed by a zero, and `pair`, each with the letter before."""

    def __init__(self, column: pa.Array) -> None:
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        body = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.size = np.diff(offsets) + 1
        self.ends = np.cumsum(self.size)
        self.letter = np.zeros(len(body) + len(column), np.uint8)
        solid = np.ones(len(self.letter), bool)
        solid[self.ends - 1] = False
        self.letter[solid] = body
        before = np.full(len(self.letter), 256, np.int64)
        before[1:] = self.letter[:-1]
        before[self.ends - self.size] = 256
        self.pair = before * 256 + self.letter


class Letters(Spelled):
    """Letters with their bits and hashed contexts, as if no word were before."""

    def __init__(self, column: pa.Array, code: Code = _EVEN) -> None:
        super().__init__(column)
        at, first = np.arange(len(self.letter)), np.repeat(self.ends - self.size, self.size)
        self.place = at - first
        self.context, total = [], np.zeros(len(self.letter), np.uint64)
        for back in range(1, max(ORDERS) + 1):
            before = np.zeros(len(self.letter), np.uint64)
            before[back:] = self.letter[:-back]
            before += np.uint64(1)
            before[self.place < back] = 0
            total = total * np.uint64(0x100000001B3) + before
            if back in ORDERS:
                self.context.append(textbytes.mix(total + np.uint64(back << 56)))
        self.context.append(textbytes.span_hashes(textbytes.prefix_sums(self.letter), first, at))
        # Bits of all letters: the letter `of` each, hashes of the bits before, and where those of a word are.
        bits = code.size[self.pair]
        stop = np.cumsum(bits)
        self.of = np.repeat(at, bits)
        self.depth = np.arange(len(self.of)) - (stop - bits)[self.of]
        where = self.depth + code.base[self.pair][self.of]
        self.node, self.value = code.node[where], code.value[where]
        self.stop = stop[self.ends - 1]
        self.start = self.stop - np.diff(self.stop, prepend=0)

    def alone(self) -> Iterator[np.ndarray]:
        """For all bits, the cells of each predictor that depends on the word alone."""
        for context in self.context:
            yield _cell(context[self.of] + self.node)

    def after(self) -> np.ndarray:
        """Hashes of all bits that, with the hash of the word before, are the cells of the other predictor."""
        return textbytes.mix(self.context[-1] + np.uint64(1))[self.of] + self.node

    def cells(self, bit: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Table cells of each predictor for one bit of every letter (7 is the first), and the bits."""
        here = self.depth == 7 - bit
        return [c[here] for c in (*self.alone(), _cell(self.after()))], self.value[here]


def _cell(hashes: np.ndarray) -> np.ndarray:
    """The highest bits of a product; hashes are mixed before, and are overwritten."""
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes >>= np.uint64(65 - _CELLS.bit_length())
    return hashes.view(np.int64)


class Pairs:
    """Bits of words that follow others: `at`, the bit of the word that each is, and the pair's `size`, bits in all.
    What depends on the word alone is worked out once for all its pairs."""

    def __init__(self, letters: Letters, word: np.ndarray, before: np.ndarray) -> None:
        self.letters = letters
        self.size = (letters.stop - letters.start)[word]
        self.stop = np.cumsum(self.size)
        self.at = np.arange(self.stop[-1]) + np.repeat(letters.start[word] - self.stop + self.size, self.size)
        self.before = before

    def cells(self) -> np.ndarray:
        """Cells of the predictor that depends on the word before."""
        hashes = self.letters.after().take(self.at)
        hashes ^= np.repeat(self.before, self.size)
        return _cell(hashes)


def _pieces(table: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
    """The counts of predictors from the `first`, in parts."""
    if table.any():
        parts = np.array_split(table.ravel(), _PIECES * len(table))
        numbers = range(first * _PIECES, first * _PIECES + len(parts))
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], names=["piece", "counts"])


def _count_follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often letters follow letters in counted words."""
    follow = np.zeros(257 * 256, np.int64)
    for batch in batches:
        letters = Spelled(batch.column("word"))
        np.add.at(follow, letters.pair, np.repeat(batch.column("n").to_numpy(), letters.size))
    seen = np.flatnonzero(follow)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(follow[seen], pa.int64())], names=["pair", "n"])


def _count_alone(code) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    """Counts of bits of counted words for the predictors that depend on the word alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(ORDERS) - 1, 2 * _CELLS), np.uint32)
        for batch in batches:
            letters = Letters(batch.column("word"), code.value)
            n = np.repeat(batch.column("n").to_numpy().astype(np.uint32), letters.stop - letters.start)
            side = letters.value * _CELLS
            for o, cell in enumerate(letters.alone()):
                np.add.at(table[o], cell + side, n)
        yield from _pieces(table, 0)

    return run


def _count_after(code) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    """Counts of bits for the predictor that depends on the word before too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((1, 2 * _CELLS), np.uint32)
        for _, data, offsets in _blocks(batches):
            for words, word, before, n, _ in Tokens(textbytes.lower(data), offsets).chunks(_CHUNK):
                pairs = Pairs(Letters(words, code.value), word, before)
                cell = pairs.cells()
                cell += (pairs.letters.value * _CELLS).take(pairs.at)
                np.add.at(table[0], cell, np.repeat(n.astype(np.uint32), pairs.size))
        yield from _pieces(table, len(ORDERS) - 1)

    return run


def _sum_pieces(table: pa.Table) -> pa.Table:
    total: np.ndarray | int = 0
    for counts in table.column("counts"):
        total = total + np.frombuffer(zlib.decompress(counts.as_py()), np.uint32).astype(np.uint64)
    # Beyond the largest value of the type a count says no more about the odds.
    return pa.table({"piece": table.column("piece").slice(0, 1), "counts": pa.array([np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()], pa.binary())})


class Mixer:
    """Gated weights and the refining table; `learn` updates both online."""

    def __init__(self) -> None:
        self.weights = np.full((_GATES, len(ORDERS)), 0.3, np.float32)
        self.hits = np.full((_GATES, _BINS, 2), 0.0, np.float64)

    def mixed(self, pairs: Pairs, odds: list[np.ndarray], last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From the log odds of all predictors, the last of them for the pairs' bits and the others for the words':
        the gates of the words' bits if the last predictor has not seen them, then if it has; which of these each of
        the pairs' bits is; and the step of its weighted sum."""
        letters = pairs.letters
        seen = np.zeros(len(letters.of), np.uint8)
        for o in odds:
            seen += o != 0
        gate = (np.minimum(letters.place, _PLACES - 1) * _LEVELS).take(letters.of) + seen
        gate = np.stack([gate, gate + 1])
        alone = np.zeros(gate.shape, np.float32)
        weights = self.weights.T.copy()
        for w, o in zip(weights, odds, strict=False):
            alone += w.take(gate) * o
        which = pairs.at + (last != 0) * len(seen)
        total = weights[-1].take(gate).take(which, mode="clip")
        total *= last
        total += alone.take(which, mode="clip")
        total += np.float32(12)
        total *= np.float32(_STEPS / 24)
        return gate, which, np.rint(np.clip(total, 0, _STEPS, out=total), out=total).astype(np.int64)

    def table(self) -> np.ndarray:
        middle = 1 / (1 + np.exp(-(np.arange(_BINS) * 24 / (_BINS - 1) - 12)))
        return ((self.hits[..., 1] + 20 * middle) / (self.hits.sum(axis=-1) + 20)).ravel()

    def refined(self, x: np.ndarray, gate: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Probability of a one: the mixer's and, from the neighbouring cells of the table, the refined one, averaged."""
        at = (x + 12) * (_BINS - 1) / 24
        low = np.minimum(at.astype(np.int64), _BINS - 2)
        part = at - low
        low += gate * _BINS
        fine = table.take(low) * (1 - part) + table.take(low + 1) * part
        return 0.5 / (1 + np.exp(-x.astype(np.float64))) + 0.5 * fine

    def logs(self) -> np.ndarray:
        """Natural log probability of a zero and a one at each gate and step."""
        gate = np.repeat(np.arange(_GATES), _STEPS + 1)
        p = self.refined(np.tile(_STEP_ODDS, _GATES), gate, self.table())
        return np.log(np.stack([1 - p, p], axis=1)).astype(np.float32).ravel()

    def learn(self, pairs: Pairs, odds: list[np.ndarray], last: np.ndarray, n: np.ndarray, rate: float) -> None:
        """Learn from pairs that come `n` times each. Sums over the pairs of a word come before those over words."""
        gate, which, at = self.mixed(pairs, odds, last)
        n = np.repeat(n.astype(np.float32), pairs.size)
        near = (gate * (2 * _BINS) + pairs.letters.value).take(which, mode="clip")
        # The bit is the lowest one of its place among the hits.
        error = ((near & 1).astype(np.float32) - _STEP_CHANCES.take(at)) * n
        off = np.bincount(which, weights=error, minlength=gate.size).reshape(gate.shape)
        off_last = np.bincount(which, weights=error * last, minlength=gate.size)
        step = [*((off * o).ravel() for o in odds), off_last]
        step = np.stack([np.bincount(gate.ravel(), weights=s, minlength=_GATES) for s in step], axis=1)
        near += _STEP_BINS.take(at)
        hits = np.bincount(near, weights=n, minlength=self.hits.size).reshape(self.hits.shape)
        self.weights += (rate * step / np.maximum(hits.sum(axis=(1, 2)), 1)[:, None]).astype(np.float32)
        self.hits += hits


_STEP_ODDS = np.arange(_STEPS + 1) * 24 / _STEPS - 12
_STEP_CHANCES = (1 / (1 + np.exp(-_STEP_ODDS))).astype(np.float32)
_STEP_BINS = 2 * np.rint(np.arange(_STEPS + 1) * (_BINS - 1) / _STEPS).astype(np.int64)


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log odds of a one in each cell; only cells that have counts are not 0."""
    odds = np.log((ones + np.float32(0.3)) / (zeros + np.float32(0.3)))
    odds[(odds == 0) & (ones > 0)] = 1e-6
    return odds


def levels(counts: np.ndarray, without: bool = False) -> np.ndarray:
    """Log odds of each predictor's cells in bytes; `without`, for a zero and then for a one that is itself taken out."""
    out = []
    for zeros, ones in counts.astype(np.float32):
        for odds in [log_odds(np.maximum(zeros - 1, 0), ones), log_odds(zeros, np.maximum(ones - 1, 0))] if without else [log_odds(zeros, ones)]:
            out.append(np.where(odds == 0, 0, np.clip(np.rint(odds * 10), -127, 127) + 128).astype(np.uint8))
    return np.stack(out).reshape(len(counts), -1)


def _learn(learning) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, learned, words = Mixer(), 0, 0
        # The token itself is taken out of the counts that predict it.
        table, code = learning.value
        for _, data, offsets in _blocks(batches):
            tokens = Tokens(textbytes.lower(data), offsets)
            words += int(tokens.n.sum())
            # Words with very many pairs fill lessons: in a row they would be all that the weights remember.
            for start in np.random.default_rng(0).permutation(np.arange(0, len(tokens.word), _LESSON)):
                size = _FIRST_LESSON if learned < _FIRST_PAIRS else _LESSON
                for first in range(start, min(start + _LESSON, len(tokens.word)), size):
                    column, word, before, n, _ = tokens.chunk(first, size)
                    pairs = Pairs(Letters(column, code), word, before)
                    side = pairs.letters.value * _CELLS
                    odds = [_LEVEL_ODDS.take(table[o].take(cell + side)) for o, cell in enumerate(pairs.letters.alone())]
                    cell = pairs.cells()
                    cell += side.take(pairs.at)
                    learned += len(n)
                    mixer.learn(pairs, odds, _LEVEL_ODDS.take(table[-1].take(cell)), n, 0.02 if learned > _FIRST_PAIRS else 0.1)
        if words:
            yield pa.RecordBatch.from_arrays([pa.array([words], pa.int64()), pa.array([mixer.weights.tobytes()], pa.binary()), pa.array([mixer.hits.tobytes()], pa.binary())], names=["words", "weights", "hits"])

    return run


def _add_lessons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the lessons of a task's rows come to: their words, and sums of weights (times words) and of hits."""
    words, weights, hits = 0, 0, 0
    for batch in batches:
        for n, w, h in zip(*(batch.column(c).to_pylist() for c in ("words", "weights", "hits")), strict=True):
            words, weights, hits = words + n, weights + n * np.frombuffer(w, np.float32).astype(float), hits + np.frombuffer(h)
    if words:
        yield pa.RecordBatch.from_arrays([pa.array([words], pa.int64()), pa.array([weights.tobytes()], pa.binary()), pa.array([hits.tobytes()], pa.binary())], names=["words", "weights", "hits"])


def pair_cost(pairs: Pairs, table: np.ndarray, mixer: Mixer, logs: np.ndarray) -> np.ndarray:
    """Natural log probability of each pair's letters and their close, from the levels of all cells."""
    odds = [_LEVEL_ODDS.take(t.take(cell)) for t, cell in zip(table, pairs.letters.alone(), strict=False)]
    gate, which, at = mixer.mixed(pairs, odds, _LEVEL_ODDS.take(table[-1].take(pairs.cells())))
    at *= 2
    at += (gate * (2 * _STEPS + 2) + pairs.letters.value).take(which, mode="clip")
    return np.add.reduceat(logs.take(at), pairs.stop - pairs.size, dtype=np.float64)


def spelling_cost(column: pa.Array, counts: np.ndarray, mixer: Mixer) -> np.ndarray:
    """Natural log probability of words at the beginning of a text, each with its close, in the even code."""
    pairs = Pairs(Letters(column), np.arange(len(column)), np.zeros(len(column), np.uint64))
    return pair_cost(pairs, levels(counts), mixer, mixer.logs())


def document_scores(tokens: Tokens, docs: int, table: np.ndarray, code: Code, mixer: Mixer) -> np.ndarray:
    """Log10 probability of each document of a slice."""
    cost, logs = np.empty(len(tokens.word)), mixer.logs()
    for words, word, before, _, part in tokens.chunks(_CHUNK):
        cost[part] = pair_cost(Pairs(Letters(words, code), word, before), table, mixer, logs)
    at = np.arange(len(tokens.row))
    begin, size = textbytes.runs(tokens.row)
    past = at - np.repeat(begin, size)
    # How often the document had the word before.
    same = (tokens.row * len(tokens.words) + tokens.token) * len(at) + at
    same.sort()
    order = same % max(1, len(at))
    begin, size = textbytes.runs(same // max(1, len(at)))
    had = np.empty(len(at))
    had[order] = at - np.repeat(begin, size)
    pair = tokens.pair()
    # The chance of a very long word that the document has not had is too small for a double; its logarithm is not.
    chance = np.log(_PRIOR * np.exp(cost)[pair] + had, out=cost[pair] + np.log(_PRIOR), where=had > 0) - np.log(_PRIOR + past)
    return np.bincount(tokens.row, weights=chance / np.log(10), minlength=docs)


# --- documents ---------------------------------------------------------------------------------------------------


class Corpus:
    """What is learned from training documents: counts of words (a stored table), totals, and the mixing model."""

    def __init__(self, docs: DataFrame) -> None:
        spark = docs.sparkSession
        training = docs.where(id_hash() % 10 != 0).select("text")
        words = training.mapInArrow(_count_words, "word binary, n bigint")
        self.words = stored(words.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
        row = self.words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        self.ends = training.count()
        self.tokens, self.distinct = row[0] + self.ends, row[1] + (self.ends > 0)
        follow = np.zeros((257, 256), np.int64)
        follow[256, 0] = self.ends
        pairs = self.words.mapInArrow(_count_follow, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        for r in pairs.toLocalIterator():
            follow.flat[r.pair] += r.n
        code = spark.sparkContext.broadcast(Code(follow))
        kind = "piece bigint, counts binary"
        pieces = self.words.mapInArrow(_count_alone(code), kind).union(training.mapInArrow(_count_after(code), kind))
        pieces = pieces.groupBy("piece").applyInArrow(_sum_pieces, kind)
        counts = np.zeros((len(ORDERS), 2, _CELLS), np.uint32)
        parts = np.array_split(counts.ravel(), len(ORDERS) * _PIECES)
        for r in pieces.toLocalIterator():
            parts[r.piece][:] = np.frombuffer(r.counts, np.uint32)
        # The counted words have no ends.
        end = Letters(pa.array([b""], pa.binary()), code.value)
        for o, cell in enumerate(end.alone()):
            now = counts[o, end.value, cell].astype(np.int64)
            counts[o, end.value, cell] = np.minimum(now + self.ends, 0xFFFFFFFF)
        tables = spark.sparkContext.broadcast((levels(counts, without=True), code.value))
        self.mixer = Mixer()
        # All parts learn at the same time; their rows of some 40 KB are added up by tasks that read many of them.
        lessons = "words bigint, weights binary, hits binary"
        learned = stored(training.mapInArrow(_learn(tables), lessons), "lessons").mapInArrow(_add_lessons, lessons).collect()
        if learned:
            self.mixer.weights = (sum(np.frombuffer(r.weights) for r in learned) / sum(r.words for r in learned)).astype(np.float32).reshape(_GATES, -1)
            self.mixer.hits = sum(np.frombuffer(r.hits) for r in learned).reshape(self.mixer.hits.shape)
        tables.unpersist()
        self.table = spark.sparkContext.broadcast((levels(counts), code.value))


_RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"


def _flat(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """How many numbers each row has, and all numbers, from a column of their bytes."""
    sizes, body = [np.empty(0, np.int64)], [np.empty(0, kind)]
    for part in column.chunks:
        part = part.cast(pa.large_binary())
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        sizes.append(np.diff(offsets) // np.dtype(kind).itemsize)
        body.append(np.frombuffer((part.buffers()[2] or b"")[offsets[0] : offsets[-1]], kind))
    return np.concatenate(sizes), np.concatenate(body)


def _block_sums(facts: dict) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        named = pc.is_valid(table.column("docs"))
        names, posts = table.filter(named), table.filter(pc.invert(named))
        docs = pa.ipc.open_stream(names.column("docs")[0].as_buffer()).read_all()
        sizes, score = docs.column("bytes").to_numpy(), docs.column("score").to_numpy()
        size, row = _flat(posts.column("rows"), np.uint16)
        _, times = _flat(posts.column("times"), np.uint32)
        sums = lambda values: np.bincount(row, weights=times * np.repeat(values, size), minlength=len(docs))
        n = posts.column("n").to_numpy().astype(float)
        share = lambda n: np.log10((n + 0.1) / (facts["tokens"] + 0.1 * (facts["distinct"] + 1)))
        ends = facts["ends"]
        number, seen, base = sums(np.ones(len(size))), sums((n > 0).astype(float)), sums(share(n)) + share(ends)
        bits = -score / np.log10(2) / np.maximum(1, sizes)
        return pa.table(
            [
                docs.column("doc_id"),
                docs.column("held_out"),
                pa.array(number.astype(np.int64) + 1),
                pa.array(seen.astype(np.int64) + int(ends > 0)),
                pa.array(np.full(len(docs), facts["tokens"])),
                pa.array(base),
                pa.array(score),
                pa.array(bits),
            ],
            names=[c.split()[0] for c in _RESULT.split(", ")],
        )

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from rows whose crc32(doc_id as text) modulo 10 is not 0 (null ids count as empty text); held_out marks the
    others. Null and empty texts are one end. base_score is the smoothed share of each token, summed as log10; score
    the model's log10 probability, and bits_per_byte the same per byte of text (of one byte if the text is empty).
    If no row is there to learn from, counts are 0 and every bit is even. Rows of one id are scored apart;
    columns beyond doc_id and text are not read; no rows give no rows.
    """
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    corpus = Corpus(docs)
    facts = {"tokens": corpus.tokens, "distinct": corpus.distinct, "ends": corpus.ends}
    rows = docs.select("doc_id", "text", (id_hash() % 10 == 0).alias("held_out"))
    posted = rows.mapInArrow(_postings(corpus.table, corpus.mixer), _POSTINGS)
    counted = posted.join(corpus.words.hint("shuffle_hash"), "word", "left").select(*posted.columns[:1], *posted.columns[2:], F.coalesce("n", F.lit(0)).alias("n"))
    return counted.groupBy("block").applyInArrow(_block_sums(facts), _RESULT)
