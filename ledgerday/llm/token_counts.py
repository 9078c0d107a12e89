"""Word-piece counts by a linear longest-match automaton.

The vocabulary becomes a trie.  Every node has a failure link and the number of
pieces that greedy longest match has surely cut off when the scan falls back
along it, so a word's piece count comes out of one pass over its bytes: no
piece is built and no byte is read twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerday.llm.common import Memo, blank_separated

_NONE = -1
#: In a word's memo entry, pieces take the low bits and unknown words count from here.
_UNKNOWN = 1 << 32


class PieceAutomaton:
    """Counts the pieces of greedy longest match in a word.

    ``marker`` is put before each word (a byte-level vocabulary's word start);
    ``continuation`` marks the pieces that go on a word ("##"), none if empty:
    then any piece may stand anywhere.
    """

    def __init__(self, pieces: Iterable[bytes], marker: bytes = b"", continuation: bytes = b""):
        self.marker = marker
        self.step: dict[int, int] = {}
        self.fail: list[int] = [_NONE]
        self.pops: list[int] = [0]
        self.root = self.rest = 0
        if continuation:
            self.rest = self._node()
        final, parent = set(), {}
        for piece in pieces:
            goes_on = bool(continuation) and piece.startswith(continuation) and piece != continuation
            node = self.rest if goes_on else self.root
            for byte in piece[len(continuation) * goes_on :]:
                key = node << 8 | byte
                if key not in self.step:
                    self.step[key] = self._node()
                    parent[self.step[key]] = (node, byte)
                node = self.step[key]
            if node not in (self.root, self.rest):
                final.add(node)
        # Nodes by depth: a node's link follows from its parent's.
        level = [self.root, self.rest] if continuation else [self.root]
        children: dict[int, list[int]] = {}
        for node, (up, _) in parent.items():
            children.setdefault(up, []).append(node)
        while level := [c for node in level for c in children.get(node, ())]:
            for node in level:
                if node in final:
                    self.fail[node], self.pops[node] = self.rest, 1
                    continue
                up, byte = parent[node]
                at, popped = self.fail[up], self.pops[up]
                while at != _NONE and (at << 8 | byte) not in self.step:
                    popped, at = popped + self.pops[at], self.fail[at]
                if at != _NONE:
                    self.fail[node], self.pops[node] = self.step[at << 8 | byte], popped

    def _node(self) -> int:
        self.fail.append(_NONE)
        self.pops.append(0)
        return len(self.fail) - 1

    def count(self, word: bytes) -> int | None:
        """Pieces of ``word``; None if the vocabulary can't spell it by greedy match."""
        step, fail, pops = self.step, self.fail, self.pops
        if not (word := self.marker + word):
            return 0
        at, n = self.root, 0
        for byte in word:
            while (to := step.get(at << 8 | byte)) is None:
                n, at = n + pops[at], fail[at]
                if at == _NONE:
                    return None
            at = to
        while at != self.rest:
            n, at = n + pops[at], fail[at]
            if at == _NONE:
                return None
        return n


def token_counts(
    docs: DataFrame, automaton: PieceAutomaton, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_words, n_pieces, n_unknown`` of every row, from its whole text.

    Words are ``[^\\x20\\x09-\\x0D]+``; a word that greedy match can't spell
    counts as one piece and one unknown.  The automaton (the size of the
    vocabulary) is broadcast; there is no shuffle.

    Null or empty text: zeros.  Null or repeated ids: a row for each.  Empty
    table: no rows.  Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    @F.pandas_udf("n_words long, n_pieces long, n_unknown long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces = shared.value

        def of_word(word: bytes) -> int:
            n = pieces.count(word)
            return _UNKNOWN + 1 if n is None else n

        memo = Memo(of_word)
        for texts in batches:
            rows = []
            for text in texts:
                words = blank_separated(text)
                n = sum(map(memo.__getitem__, words))
                rows.append((len(words), n % _UNKNOWN, n // _UNKNOWN))
            yield pd.DataFrame(rows, columns=["n_words", "n_pieces", "n_unknown"])

    return docs.select(F.col(id_col), count(F.col(text_col)).alias("counts")).select(id_col, "counts.*")

