"""Toxicity by a bidirectional gated recurrent network with attention, over words and their characters.

A word's input is a learned vector of the word (if enough training documents have it) and the sum of learned vectors
of its runs of three and of five bytes, the marks of its begin and end included. Windows of `WINDOW` words, every
`STRIDE` words, cover a text; two recurrent layers read each window in both directions, and attention pools their
states. Weights are trained here with numpy, on a bounded sample of labelled documents: a toxic document teaches
through windows that score highest so far. A document's score weighs its worst window, how many windows are toxic in
all and in what share; these weights are fitted on every fifth document of the sample, which the network does not see:
one odd word means much in a note and little in a book.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm import textbytes
from queuelake.llm.shared import id_hash, stored
from queuelake.session import prepare

WINDOW, STRIDE = 24, 12
#: Labelled documents to learn from: at most so many toxic and others, none longer than so many bytes.
FIT_TOXIC, FIT_OTHER, FIT_BYTES = 1500, 3000, 20_000
CUT = 0.7
_HIDDEN, _WORD, _CHAR = 8, 8, 8
#: Cells of runs of three and of five bytes.
_SHORT_CELLS, _LONG_CELLS = 1 << 12, 1 << 15
_STEPS, _BATCH, _RESCORE = 1800, 192, 150

_LETTERS = np.zeros(256, bool)
_LETTERS[48:58] = _LETTERS[97:123] = _LETTERS[128:] = True


class Words:
    """The words of a slice: a number for each token, and byte runs and hash of each distinct word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        data = textbytes.lower(data)
        starts, ends, self.row = textbytes.words(data, offsets, _LETTERS[data])
        hashes = textbytes.span_hashes(textbytes.prefix_sums(data), starts, ends)
        self.hashes, first, self.token = np.unique(hashes, return_index=True, return_inverse=True)
        starts, sizes = starts[first], ends[first] - starts[first]
        begin = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(begin, sizes)
        at, left = place + np.repeat(starts, sizes), np.repeat(sizes, sizes) - place

        def near(step: int) -> np.ndarray:
            """The byte so far from each; 1 just before the word, 2 just after it, 0 beyond."""
            byte = data[np.clip(at + step, 0, max(0, len(data) - 1))].astype(np.uint64)
            off = -place - step if step < 0 else step - left + 1
            return np.where(off <= 0, byte, np.where(off == 1, np.uint64(1 if step < 0 else 2), np.uint64(0)))

        code = near(-1) << np.uint64(16) | near(0) << np.uint64(8) | near(1)
        short = textbytes.mix(code) % np.uint64(_SHORT_CELLS)
        long = textbytes.mix(code << np.uint64(16) | near(-2) << np.uint64(8) | near(2)) % np.uint64(_LONG_CELLS) + np.uint64(_SHORT_CELLS)
        self.grams = np.stack([short, long], axis=1).ravel().astype(np.int64)
        self.begin, self.sizes = 2 * begin, 2 * sizes
        count = np.bincount(self.row, minlength=len(offsets) - 1)
        first = np.cumsum(count) - count
        # Windows start every STRIDE words as long as one brings words the last did not have.
        number = np.where(count > 0, 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE)), 0)
        self.window_row = np.repeat(np.arange(len(count)), number)
        place = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        self.window_first = np.repeat(first, number) + place * STRIDE
        self.window_size = np.minimum(WINDOW, np.repeat(count, number) - place * STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _added(at: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sums of the rows of `values` by where they go."""
    return np.stack([np.bincount(at, weights=column, minlength=rows) for column in values.T], axis=1).astype(np.float32)


class Network:
    """Weights, scoring, and training by gradients through time."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 5) -> None:
        draw = np.random.default_rng(seed)
        h, x = _HIDDEN, _WORD + _CHAR
        make = lambda *shape, scale: draw.normal(0, scale, shape).astype(np.float32)
        self.vocabulary = vocabulary  # Sorted hashes; number 0 is every other word.
        self.w = {
            "words": make(len(vocabulary) + 1, _WORD, scale=0.1),
            "chars": make(_SHORT_CELLS + _LONG_CELLS, _CHAR, scale=0.2),
            "in_f": make(x, 3 * h, scale=0.4),
            "in_b": make(x, 3 * h, scale=0.4),
            "bias_f": np.zeros(3 * h, np.float32),
            "bias_b": np.zeros(3 * h, np.float32),
            "state_f": make(h, 3 * h, scale=0.3),
            "state_b": make(h, 3 * h, scale=0.3),
            "attend": make(2 * h, scale=0.3),
            "out": make(2 * h, scale=0.3),
            "out_bias": np.zeros(1, np.float32),
        }
        #: Weights of the facts of a document, the last one alone.
        self.pool = np.zeros(_FACTS + 1)

    def numbers(self, words: Words) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(words.hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words.hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words.hashes, at + 1, 0)

    def inputs(self, numbers: np.ndarray, grams: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Input of each distinct word."""
        if not len(begin):
            return np.zeros((0, _WORD + _CHAR), np.float32)
        chars = np.add.reduceat(self.w["chars"][grams], begin, axis=0) / np.sqrt(sizes)[:, None]
        return np.concatenate([self.w["words"][numbers], chars.astype(np.float32)], axis=1)

    def _layer(self, gates: np.ndarray, token: np.ndarray, live: np.ndarray, side: str, keep: dict | None) -> np.ndarray:
        """States (step, window, unit); token and live are (step, window)."""
        h, steps = _HIDDEN, len(token)
        state = np.zeros((token.shape[1], h), np.float32)
        states = np.empty((steps, *state.shape), np.float32)
        weights = self.w[f"state_{side}"]
        saved = []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            x, inner = gates[token[t]], state @ weights
            zr = _sigmoid(x[:, : 2 * h] + inner[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * inner[:, 2 * h :])
            after = np.where(live[t][:, None], new + z * (state - new), state)
            if keep is not None:
                saved.append((t, state, z, r, new, inner[:, 2 * h :]))
            states[t] = state = after
        if keep is not None:
            keep[side] = saved
        return states

    def logits(self, inputs: np.ndarray, token: np.ndarray, live: np.ndarray, keep: dict | None = None) -> np.ndarray:
        sides = {s: self._layer(inputs @ self.w[f"in_{s}"] + self.w[f"bias_{s}"], token, live, s, keep) for s in ("f", "b")}
        h = _HIDDEN
        energy = sides["f"] @ self.w["attend"][:h] + sides["b"] @ self.w["attend"][h:]
        energy = np.where(live, energy, -1e9)
        share = np.exp(energy - energy.max(axis=0))
        share /= share.sum(axis=0)
        pooled = np.concatenate([(share[:, :, None] * sides[s]).sum(axis=0) for s in ("f", "b")], axis=1)
        if keep is not None:
            keep |= {"states": sides, "share": share, "pooled": pooled}
        return pooled @ self.w["out"] + self.w["out_bias"][0]

    def gradients(self, inputs: np.ndarray, token: np.ndarray, live: np.ndarray, label: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean cross-entropy; for the inputs, a row for each distinct word."""
        keep: dict = {}
        error = ((_sigmoid(self.logits(inputs, token, live, keep)) - label) / len(label)).astype(np.float32)
        h, share = _HIDDEN, keep["share"]
        grad = {"out": keep["pooled"].T @ error, "out_bias": error.sum(keepdims=True)}
        both = np.concatenate([keep["states"]["f"], keep["states"]["b"]], axis=2)
        pooled = error[:, None] * self.w["out"]
        along = (both * pooled).sum(axis=2)
        energy = share * (along - (share * along).sum(axis=0))
        grad["attend"] = np.tensordot(energy, both, 2)
        state_grad = share[:, :, None] * pooled + energy[:, :, None] * self.w["attend"]
        to_inputs = np.zeros_like(inputs)
        for s, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            weights, own = self.w[f"state_{s}"], state_grad[:, :, part]
            carry = np.zeros_like(own[0])
            gates = np.zeros((*token.shape, 3 * h), np.float32)
            grad[f"state_{s}"] = np.zeros_like(weights)
            for t, state, z, r, new, inner in reversed(keep[s]):
                after = carry + own[t]
                on = live[t][:, None]
                inside = np.where(on, after, 0)
                d_new = inside * (1 - z) * (1 - new * new)
                d_z = inside * (state - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                gates[t] = np.concatenate([d_z, d_r, d_new], axis=1)
                to_state = np.concatenate([d_z, d_r, d_new * r], axis=1)
                grad[f"state_{s}"] += state.T @ to_state
                carry = np.where(on, inside * z, after) + to_state @ weights.T
            by_word = _added(token.ravel(), gates.reshape(-1, 3 * h), len(inputs))
            grad[f"in_{s}"] = inputs.T @ by_word
            grad[f"bias_{s}"] = by_word.sum(axis=0)
            to_inputs += by_word @ self.w[f"in_{s}"].T
        return grad, to_inputs

    def score_windows(self, words: Words) -> np.ndarray:
        inputs = self.inputs(self.numbers(words), words.grams, words.begin, words.sizes)
        parts = np.array_split(np.arange(len(words.window_row)), max(1, len(words.window_row) // 8192))
        return np.concatenate([self.logits(inputs, *_layout(words, part)) for part in parts]) if len(words.window_row) else np.zeros(0, np.float32)

    def probability(self, logit: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each document from the logits of its windows, and how many windows it has.

        Log odds are rounded: further digits depend on what else is in the slice, and repeated rows score alike.
        """
        number = np.bincount(row, minlength=rows)
        x = np.round(_facts(logit, row, number) @ self.pool[:-1] + self.pool[-1], 5)
        return np.where(number > 0, 1 / (1 + np.exp(-np.clip(x, -60, 60))), 0.0), number


_FACTS = 4


def _facts(logit: np.ndarray, row: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Of each document: the worst window, the log odds of a toxic window, and the logs of toxic and of all windows."""
    worst = np.full(len(number), -15.0)
    np.maximum.at(worst, row, np.clip(logit, -15, 15))
    toxic = np.bincount(row, weights=_sigmoid(logit.astype(float)), minlength=len(number)) + 0.02
    clean = np.bincount(row, weights=_sigmoid(-logit.astype(float)), minlength=len(number)) + 0.02
    return np.stack([worst, np.log(toxic / clean), np.log(toxic), np.log(number + 1)], axis=1)


def _logistic(facts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of logistic regression by Newton steps, with a small penalty on weights of standard facts."""
    middle, spread = facts.mean(axis=0), facts.std(axis=0) + 1e-6
    x = np.concatenate([(facts - middle) / spread, np.ones((len(facts), 1))], axis=1)
    penalty = np.diag([1.0] * facts.shape[1] + [0.0])
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = _sigmoid(x @ weights)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-6 * np.eye(len(weights)), x.T @ (p - labels) + penalty @ weights)
        weights -= step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
    own = weights[:-1] / spread
    return np.append(own, weights[-1] - own @ middle)


def _layout(words: Words, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (step, window) and which of them are there."""
    step = np.arange(WINDOW)[:, None]
    live = step < words.window_size[windows]
    return words.token[np.where(live, words.window_first[windows] + step, 0)] if len(windows) else np.zeros((WINDOW, 0), np.int64), live


def train(texts: list[str], labels: np.ndarray, steps: int = _STEPS, seed: int = 5) -> Network:
    """A network fitted to documents and their labels; without both labels it scores everything alike."""
    column = pa.array(texts, pa.string())
    words = Words(*textbytes.utf8(column))
    pairs = np.unique(words.row * np.int64(len(words.hashes) + 1) + words.token)
    spread = np.bincount(pairs % (len(words.hashes) + 1), minlength=len(words.hashes))
    known = words.hashes[spread >= 4]
    network = Network(np.sort(known), seed)
    window_label = labels[words.window_row] if len(words.window_row) else np.zeros(0, int)
    # Every fifth document of each label only weighs windows; with few documents all do both.
    turn = np.empty(len(labels), np.int64)
    for label in (0, 1):
        turn[labels == label] = np.arange((labels == label).sum())
    apart = turn % 5 == 4 if min((labels == 0).sum(), (labels == 1).sum()) >= 25 else np.zeros(len(labels), bool)
    learns = ~apart[words.window_row] if len(words.window_row) else np.zeros(0, bool)
    toxic, other = np.flatnonzero((window_label == 1) & learns), np.flatnonzero((window_label == 0) & learns)
    if not len(toxic) or not len(other):
        return network
    draw = np.random.default_rng(seed)
    numbers = network.numbers(words)
    of_doc = np.split(toxic, np.flatnonzero(np.diff(words.window_row[toxic])) + 1)
    # Short documents first: most of their windows deserve the label.
    of_doc.sort(key=len)
    short = of_doc[: max(10, len(of_doc) // 3)]
    chosen = np.array([draw.choice(w) for w in short])
    hard = other
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.w.items()}
    part = _BATCH // 3
    for step in range(1, steps + 1):
        if step % _RESCORE == 1:
            if step > 2 * _RESCORE:
                logit = network.score_windows(words)
                # The worst fifth of a toxic document's windows, alike for every document.
                chosen = np.array([draw.choice(w[np.argsort(-logit[w])[: 1 + len(w) // 5]]) for w in of_doc for _ in range(4)])
                hard = other[np.argsort(-logit[other])[: max(256, len(other) // 50)]]
            else:
                chosen = np.array([draw.choice(w) for w in short])
        windows = np.concatenate([draw.choice(chosen, part), draw.choice(hard, part), draw.choice(other, part)])
        token, live = _layout(words, windows)
        distinct, local = np.unique(token, return_inverse=True)
        sizes = words.sizes[distinct]
        begin = np.cumsum(sizes) - sizes
        grams = words.grams[np.arange(sizes.sum()) + np.repeat(words.begin[distinct] - begin, sizes)]
        # Words are hidden at random, so that their characters have to tell as well.
        number = np.where(draw.random(len(distinct)) < 0.3, 0, numbers[distinct])
        inputs = network.inputs(number, grams, begin, sizes)
        grad, to_inputs = network.gradients(inputs, local.reshape(token.shape), live, window_label[windows].astype(np.float32))
        grad["words"] = _added(number, to_inputs[:, :_WORD], len(network.w["words"]))
        grad["chars"] = _added(grams, np.repeat(to_inputs[:, _WORD:] / np.sqrt(sizes)[:, None], sizes, axis=0), len(network.w["chars"]))
        rate = 0.01 * (1 - 0.9 * step / steps)
        for name, g in grad.items():
            g = g + 1e-5 * network.w[name]
            m, v = moments[name]
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            network.w[name] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    judged = apart if apart.any() else np.ones(len(labels), bool)
    number = np.bincount(words.window_row, minlength=len(labels))
    judged &= number > 0
    network.pool = _logistic(_facts(network.score_windows(words), words.window_row, number)[judged], labels[judged])
    return network


def _train(table: pa.Table) -> pa.Table:
    """The network fitted to one table of drawn documents, as bytes."""
    table = table.sort_by([("toxic", "descending"), ("turn", "ascending")])
    network = train(table.column("text").to_pylist(), table.column("toxic").to_numpy())
    return pa.table({"network": pa.array([pickle.dumps(network)], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """Train on labelled documents whose crc32(doc_id as text) modulo 3 is not 1, drawn by a hash of their text.

    Texts are drawn, not rows: a text that many documents have counts once for each label. The draw sees hashes and
    ids; only texts that are drawn travel, to the task that trains. The driver gets the weights.
    """
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    fits = docs.where((id_hash() % 3 != 1) & (F.octet_length("text") <= FIT_BYTES) & (F.octet_length("text") > 0))
    rows = fits.select("doc_id", F.xxhash64("text", F.lit(23)).alias("turn")).join(known, "doc_id")
    texts = stored(rows.groupBy("turn", "toxic").agg(F.min("doc_id").alias("doc_id")), "toxic-texts")
    drawn = [texts.where(F.col("toxic") == toxic).orderBy("turn").limit(most) for toxic, most in ((1, FIT_TOXIC), (0, FIT_OTHER))]
    drawn = stored(drawn[0].union(drawn[1]), "toxic-draw")
    # A repeated doc_id may have several texts; the hash tells which was drawn.
    sample = fits.select("doc_id", F.xxhash64("text", F.lit(23)).alias("turn"), "text").join(F.broadcast(drawn), ["doc_id", "turn"])
    sample = stored(sample.dropDuplicates(["turn", "toxic"]).select("turn", "toxic", "text"), "toxic-sample")
    fitted = sample.groupBy().applyInArrow(_train, "network binary").collect()
    return pickle.loads(fitted[0].network) if fitted else train([], np.zeros(0, int))


def _score(network) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = network.value
        for rows, data, offsets in textbytes.slices(batches):
            words = Words(data, offsets)
            score, number = net.probability(net.score_windows(words), words.window_row, len(rows))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), pa.array(score), pa.array(number, pa.int64())], names=["doc_id", "held_out", "score", "n_windows"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame | None = None, network: Network | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_windows.

    Give labels (doc_id, toxic) to train, or a trained network. held_out marks rows whose crc32(doc_id as text)
    modulo 3 is 1 (null ids count as empty text). Null and empty texts and texts without letters or digits score 0.
    Repeated rows score alike; columns beyond doc_id and text are not read; no rows give no rows.
    """
    prepare(docs.sparkSession)
    network = fit(docs, labels) if network is None else network
    place = docs.sparkSession.sparkContext.broadcast(network)
    rows = docs.select("doc_id", (id_hash() % 3 == 1).alias("held_out"), "text")
    scored = rows.mapInArrow(_score(place), "doc_id bigint, held_out boolean, score double, n_windows bigint")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "n_windows")
