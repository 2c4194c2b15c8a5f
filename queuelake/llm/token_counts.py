"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie over bytes. Longest match from left to right would have to go back whenever a path ends
without a piece; instead each node has a failure link, to where matching goes on once the pieces that are certain at
the node have been taken, and the number of those pieces. Every byte is then read once, and pieces are only counted.
All distinct words of a slice walk the automaton side by side, a byte per step.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from queuelake.llm import textbytes
from queuelake.session import prepare

VOCABULARY = "byte_bpe_50k"
_NONE = -1


def vocabulary(name: str = VOCABULARY) -> list[bytes]:
    """Pieces of a public rank file; a leading space marks the start of a word."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as ranks:
        return [base64.b64decode(line.split()[0]) for line in ranks if line.strip()]


class Automaton:
    """Trie with failure links; `pops` is the number of pieces taken when a node's link is followed."""

    def __init__(self, pieces: list[bytes]) -> None:
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in [*pieces, *(bytes([b]) for b in range(256))]:
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    final.append(False)
                node = children[node][byte]
            final[node] = node > 0
        link, pops = [_NONE] * len(children), [0] * len(children)
        layer = [0]
        while layer:
            below = []
            for node in layer:
                for byte, child in children[node].items():
                    below.append(child)
                    if final[child]:
                        link[child], pops[child] = 0, 1
                        continue
                    # Single bytes are pieces, so the root has every child and the search ends there.
                    at, taken = link[node], pops[node]
                    while byte not in children[at]:
                        at, taken = link[at], taken + pops[at]
                    link[child], pops[child] = children[at][byte], taken
            layer = below
        self.link, self.pops = np.array(link), np.array(pops)
        edges = sorted((node << 8 | byte, child) for node, own in enumerate(children) for byte, child in own.items())
        self.edges, self.targets = (np.array(x) for x in zip(*edges, strict=True))

    def _child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node << 8 | byte
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.targets[at], _NONE)

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word, coded as a space and its bytes."""
        order = np.argsort(starts - ends, kind="stable")
        starts, size = starts[order], (ends - starts)[order]
        node = self._child(np.zeros(len(starts), np.int64), np.full(len(starts), 32))
        count = np.zeros(len(starts), np.int64)
        for step in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -step, "left"))
            byte = data[starts[:live] + step].astype(np.int64)
            target = self._child(node[:live], byte)
            stuck = np.flatnonzero(target == _NONE)
            while len(stuck):
                count[stuck] += self.pops[node[stuck]]
                node[stuck] = self.link[node[stuck]]
                target[stuck] = self._child(node[stuck], byte[stuck])
                stuck = stuck[target[stuck] == _NONE]
            node[:live] = target
        left = np.flatnonzero(node > 0)
        while len(left):
            count[left] += self.pops[node[left]]
            node[left] = self.link[node[left]]
            left = left[node[left] > 0]
        out = np.empty(len(count), np.int64)
        out[order] = count
        return out


_automata: dict[str, Automaton] = {}


def _count(name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _automata:
            _automata[name] = Automaton(vocabulary(name))
        for rows, data, offsets in textbytes.slices(batches, 2 << 20):
            starts, ends, row = textbytes.words(data, offsets)
            _, first, token = np.unique(textbytes.span_hashes(textbytes.prefix_sums(data), starts, ends), return_index=True, return_inverse=True)
            pieces = _automata[name].counts(data, starts[first], ends[first])[token]
            total = np.bincount(row, weights=pieces, minlength=len(rows)).astype(np.int64)
            longest = np.zeros(len(rows), np.int64)
            np.maximum.at(longest, row, pieces)
            number = np.bincount(row, minlength=len(rows))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(v, pa.int64()) for v in (np.diff(offsets), number, total, longest))], names=["doc_id", "n_bytes", "n_words", "n_tokens", "longest_word_tokens"])

    return run


def count_tokens(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_words, n_tokens, longest_word_tokens.

    Words are runs without white space (`[^\\x20\\x09-\\x0D]+`), each coded as a space and its bytes and cut greedily
    into the longest pieces of the vocabulary; single bytes are pieces. Null, empty and blank texts have none. Rows
    that repeat count alike; columns beyond doc_id and text are not read; no rows give no rows.
    """
    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_count(name), "doc_id bigint, n_bytes bigint, n_words bigint, n_tokens bigint, longest_word_tokens bigint")
