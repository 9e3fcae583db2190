"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a byte trie. A node that is a piece fails to the root and
pops one piece; any other node carries the failure link of its longest-match
decomposition: the pieces that greedy matching would emit before the rest of
the node's string, only their number, and the node of that rest. A word is
then one walk over its bytes: on a missing edge add the popped number and
follow the link. No piece is ever built, and no byte is read twice.

A word is matched with a blank in front, so pieces of the vocabulary that
begin with a blank are word starts and the others continue a word. The
vocabulary holds every single byte, so every word has a decomposition.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aevia.llm.common import read_bytes
from aevia.llm.units import Grown, UnitTable, cached, slices


class LongestMatch:
    def __init__(self, pieces: list[bytes]):
        edges: dict[int, int] = {}
        parent, last, is_piece = [-1], [0], [False]
        for piece in pieces:
            node = 0
            for c in piece:
                at = node << 8 | c
                if at not in edges:
                    edges[at] = len(parent)
                    parent.append(node)
                    last.append(c)
                    is_piece.append(False)
                node = edges[at]
            is_piece[node] = node > 0
        n = len(parent)
        self.edges, self.link, self.popped = edges, [-1] * n, [0] * n
        depth = [0] * n
        for v in range(1, n):  # parents come before their children
            depth[v] = depth[parent[v]] + 1
        for v in sorted(range(1, n), key=depth.__getitem__):
            if is_piece[v]:
                self.link[v], self.popped[v] = 0, 1
                continue
            u, c = parent[v], last[v]
            z, pops = self.link[u], self.popped[u]
            while z >= 0 and (z << 8 | c) not in edges:
                pops += self.popped[z]
                z = self.link[z]
            if z >= 0:
                self.link[v], self.popped[v] = edges[z << 8 | c], pops

    def count(self, word: bytes) -> int:
        """Pieces of greedy longest-match-first; -1 if there is no such
        decomposition."""
        edges, link, popped, node, total = self.edges, self.link, self.popped, 0, 0
        for c in word:
            while (nxt := edges.get(node << 8 | c)) is None:
                if link[node] < 0:
                    return -1
                total += popped[node]
                node = link[node]
            node = nxt
        while node:
            if link[node] < 0:
                return -1
            total += popped[node]
            node = link[node]
        return total


def rank_pieces(ranks: bytes) -> list[bytes]:
    """Pieces of a rank file: one base64 piece and its rank a line."""
    return [base64.b64decode(line.split()[0]) for line in ranks.splitlines() if line.strip()]


class WordCounts(UnitTable):
    def __init__(self, ranks: bytes):
        self.automaton = LongestMatch(rank_pieces(ranks))
        super().__init__()

    def reset(self) -> None:
        self.number = Grown(np.int64)

    def compute(self, units: list) -> None:
        count = self.automaton.count
        self.number.add([count(b" " + w) for w in units])


def token_counts(docs: DataFrame, ranks_path: str) -> DataFrame:
    """One row per document of ``docs(doc_id, text)``: doc_id, n_words,
    n_tokens, longest_word (its pieces). Null and empty texts have 0 of
    each; repeated rows are counted each; an empty table gives an empty
    result; further columns are not read. Words are ``[^\\x20\\x09-\\x0D]+``."""
    ranks = read_bytes(ranks_path)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = cached(("op7", hash(ranks)), lambda: WordCounts(ranks))
        for batch in batches:
            n_words, n_tokens, most = [], [], []
            for _, run in slices(batch.column(1).to_pylist()):
                words, counts = [], []
                for t in run:
                    w = t.encode("utf-8", "surrogatepass").split()
                    words += w
                    counts.append(len(w))
                rows = table.rows(words)
                number = table.number.data[rows]
                ends = np.cumsum(counts)
                begin = ends - counts
                total = np.concatenate(([0], np.cumsum(number)))
                n_words += counts
                n_tokens += (total[ends] - total[begin]).tolist()
                most += [int(number[a:b].max(initial=0)) for a, b in zip(begin.tolist(), ends.tolist())]
            yield pa.record_batch([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64()),
                                   pa.array(most, pa.int64())], names=["doc_id", "n_words", "n_tokens", "longest_word"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(counted, f"doc_id {kind}, n_words long, n_tokens long, longest_word long")
