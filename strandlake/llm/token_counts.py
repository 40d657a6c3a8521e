"""Token counts by trie-shared dynamic programming.

A unigram tokenizer over a given vocabulary file (all its pieces, with log probabilities by Zipf's law on their
ranks) segments each pre-token into the pieces of the greatest total. The distinct pre-tokens of a task's texts are
inserted in a trie, level by level in arrays; the forward score of a node is computed once for all pre-tokens that share
that prefix, and the pre-tokens' token counts are stored at their terminal nodes and looked up for every text. Nothing is
shuffled, and a worker keeps a bounded number of pre-tokens.

Defined results: null text is empty text with no tokens; a pre-token is a run of white space, or a word with one space in
front if there is one; a byte that starts no piece is a token of its own with a low score; ties go to the longest last piece;
repeated rows count one by one; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import text_or_empty

PRE_TOKEN = re.compile(rb" ?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
#: Pieces of any length count. Those of up to PACKED bytes are looked up as two 64-bit numbers, longer ones as bytes.
MAX_PIECE, PACKED, UNKNOWN = sys.maxsize, 16, -30.0
#: Longer pre-tokens, which share next to no prefix, are scored one by one: a level of the trie costs too much for one node.
LONG = 2048
#: Known pre-tokens that a worker keeps, and characters that are counted at once.
KNOWN, AT_ONCE = 500_000, 4_000_000


def vocabulary(path: str) -> dict[bytes, float]:
    """Pieces and scores from a file of base64 pieces and ranks; path is a parameter of the operator."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    norm = np.log(np.sum(1 / np.arange(1, len(ranks) + 1)))
    return {piece: float(-np.log(rank + 1) - norm) for piece, rank in ranks.items()}


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of up to 16 bytes, zero-padded, as two 64-bit numbers each."""
    wide = np.zeros((len(data), 16), "u1")
    wide[:, : data.shape[1]] = data
    both = wide.view("<u8")
    return both[:, 0].copy(), both[:, 1].copy()


class Pieces:
    """The vocabulary by length: sorted keys of the bytes and their scores; pieces over PACKED bytes by their last PACKED bytes."""

    def __init__(self, scores: dict[bytes, float]):
        self.by_length, self.scores = {}, scores
        self.longest = max(map(len, scores), default=1)
        self.long: dict[bytes, list[tuple[bytes, float]]] = {}
        for p in sorted((p for p in scores if len(p) > PACKED), key=len, reverse=True):
            self.long.setdefault(p[-PACKED:], []).append((p, scores[p]))
        self.long_ends = np.unique(np.frombuffer(b"".join(p[-8:] for p in self.long), "<u8"))
        for n in sorted({len(p) for p in scores if 0 < len(p) <= PACKED}):
            same = sorted(p for p in scores if len(p) == n)
            low, high = _words(np.frombuffer(b"".join(same), "u1").reshape(-1, n))
            order = np.lexsort((high, low))
            self.by_length[n] = (low[order], high[order], np.array([scores[p] for p in same])[order])

    def long_ones(self, tail: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(row, length, score) of the pieces over PACKED bytes that rows of bytes end with, a row's longest first."""
        if not self.long or tail.shape[1] <= PACKED:
            return
        ends = np.ascontiguousarray(tail[:, -8:]).view("<u8")[:, 0]
        for row in np.flatnonzero(np.isin(ends, self.long_ends)).tolist():
            data = tail[row].tobytes()
            yield from ((row, len(p), score) for p, score in self.long.get(data[-PACKED:], ()) if data.endswith(p))

    def lookup(self, data: np.ndarray) -> np.ndarray:
        """Scores of rows of bytes of one length; minus infinity where there is no such piece."""
        n = data.shape[1]
        if n not in self.by_length:
            return np.full(len(data), UNKNOWN if n == 1 else -np.inf)
        low, high, scores = self.by_length[n]
        a, b = _words(data)
        i = np.searchsorted(low, a)
        found = np.full(len(data), -np.inf)
        open_rows = np.flatnonzero((i < len(low)) & (low[np.minimum(i, len(low) - 1)] == a))
        while len(open_rows):  # pieces with the same first eight bytes stand together
            at = i[open_rows]
            same = high[at] == b[open_rows]
            found[open_rows[same]] = scores[at[same]]
            open_rows = open_rows[~same]
            i[open_rows] += 1
            open_rows = open_rows[(i[open_rows] < len(low)) & (low[np.minimum(i[open_rows], len(low) - 1)] == a[open_rows])]
        return np.maximum(found, UNKNOWN) if n == 1 else found


def long_count(word: bytes, pieces: Pieces) -> int:
    """Token count of one pre-token by the same forward scores, without a trie."""
    lengths = sorted({len(p) for p in pieces.scores if p}, reverse=True)
    get, best, tokens = pieces.scores.get, [0.0], [0]
    for end in range(1, len(word) + 1):
        top, made = -np.inf, 0
        for n in lengths:
            if n <= end and (score := get(word[end - n : end])) is not None and best[end - n] + score > top:
                top, made = best[end - n] + score, tokens[end - n] + 1
        if (score := best[end - 1] + UNKNOWN) > top:
            top, made = score, tokens[end - 1] + 1
        best.append(top)
        tokens.append(made)
    return tokens[-1]


def trie_counts(words: list[bytes], pieces: Pieces) -> np.ndarray:
    """Token counts of distinct pre-tokens. Level d of the trie has the distinct prefixes of d bytes of words that long."""
    counts = np.zeros(len(words), "i8")
    for i, word in enumerate(words):
        if len(word) > LONG:
            counts[i] = long_count(word, pieces)
    words_at = np.array(sorted((i for i, word in enumerate(words) if len(word) <= LONG), key=words.__getitem__), "i8")
    if not len(words_at):
        return counts
    ordered = [words[i] for i in words_at]
    sizes = np.fromiter(map(len, ordered), "i8", len(ordered))
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(ordered), "u1")
    active = np.arange(len(ordered))  # in order, so that words with one prefix stand together
    active = active[sizes > 0]
    node = np.zeros(len(active), "i8")
    scores, tokens = [np.zeros(1)], [np.zeros(1, "i8")]
    reach = max(pieces.longest, 1)
    path = np.zeros((1, 0), "i8")  # node -> its ancestors' numbers on the last levels that a piece reaches back to, nearest last
    tail = np.zeros((1, 0), "u1")  # node -> its last bytes
    depth = 0
    while len(active):
        depth += 1
        byte = data[starts[active] + depth - 1]
        new = np.ones(len(active), bool)
        new[1:] = (node[1:] != node[:-1]) | (byte[1:] != byte[:-1])
        parent, last = node[new], byte[new]
        node = np.cumsum(new) - 1
        path = np.concatenate([path[parent], parent[:, None]], axis=1)[:, -reach:]
        tail = np.concatenate([tail[parent], last[:, None]], axis=1)[:, -reach:]
        best, made = np.full(len(parent), -np.inf), np.zeros(len(parent), "i8")
        for row, n, score in pieces.long_ones(tail):
            here = scores[-n][path[row, -n]] + score
            if here > best[row]:
                best[row], made[row] = here, tokens[-n][path[row, -n]] + 1
        for n in range(min(depth, reach, PACKED), 0, -1):
            here = scores[-n][path[:, -n]] + pieces.lookup(tail[:, -n:])
            better = here > best
            best[better] = here[better]
            made[better] = tokens[-n][path[better, -n]] + 1
        scores, tokens = [*scores, best][-reach:], [*tokens, made][-reach:]
        done = sizes[active] == depth
        counts[words_at[active[done]]] = made[node[done]]
        active, node = active[~done], node[~done]
    return counts


@cache
def _pieces(path: str) -> Pieces:
    return Pieces(vocabulary(path))


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) for each row of docs."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            texts, begin = batch.column(1).to_pylist(), 0
            n_words, n_tokens = [], []
            while begin < len(texts):
                parts, size = [], 0
                while begin + len(parts) < len(texts) and size < AT_ONCE:
                    data = texts[begin + len(parts)].encode("utf-8", "surrogatepass")
                    size += len(data)
                    parts.append(PRE_TOKEN.findall(data))
                if len(known) > KNOWN:
                    known = {}
                new = list(set().union(*parts).difference(known))
                known.update(zip(new, trie_counts(new, _pieces(vocabulary_path)).tolist(), strict=True))
                n_words += map(len, parts)
                n_tokens += (sum(map(known.__getitem__, words)) for words in parts)
                begin += len(parts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, "int64"), pa.array(n_tokens, "int64")], ["doc_id", "n_pretokens", "n_tokens"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, n_pretokens long, n_tokens long")
