"""LM scoring by context-tree weighting over bytes.

A text is its words (A-Z in lower case), each with a space behind it, and an end byte. A byte is eight binary decisions; each
is estimated by Krichevsky-Trofimov counts in the contexts of the 0 to DEPTH bytes before it, across words, and the depths are
mixed by the weights of context-tree weighting. All occurrences in the training texts are counted.

1. Texts are dealt into chunks of about CHUNK bytes. A chunk asks for its distinct words and grams (a byte behind its context),
   with their counts in training texts, packed by hash group: a chunk asks for each once, however often it occurs.
2. Groups (a gram's is told by its bytes furthest back, so that its neighbours compress well) add the counts of all chunks up. They stream: a task holds the distinct grams of one group, not what chunks ask.
3. Grams meet by the subtree of their last TOP bytes. A task weighs one subtree after another and hands its sums to the levels
   above, which have at most 65,793 contexts. With these levels known, each gram gets its log probability. No node is left out.
4. Groups answer the chunks, where texts add up the log probabilities of their bytes.

Defined results: null text is empty text, which is its end byte; at the start of a text the context is end bytes; a null doc_id
counts as an empty one (training part); without training rows every byte costs eight bits; repeated rows count as often as they
occur; an empty table gives no rows; a text of any length is scored whole, in slices; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zstandard import ZstdCompressor, ZstdDecompressor

from strandlake.llm.common import materialize, numbered, text_or_empty
from strandlake.llm.common import slices as small_parts

DEPTH, TOP, END = 5, 3, b"\n"
#: Bytes of the texts of a chunk (one text at least), and bytes that are turned into grams at once.
CHUNK, SLICE = 16 << 20, 1 << 20
#: Hash groups of words and grams. A group's distinct grams fit a task's memory up to some 10**10 of all groups.
GROUPS = 2048
#: Grams of whole subtrees that are weighed at once.
AT_ONCE = 60_000
#: Parts of a chunk's grams, by hash group, that are summed up and packed one at a time.
PARTS = 8


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def slices(texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(grams, numbers of the texts in them, first gram of each) of texts given as words, for about SLICE bytes at once."""
    parts, owner, size = [], [], 0
    for number, found in enumerate(texts):
        body = END * DEPTH + b" ".join([*found, END])  # a space behind each word, then the end
        for begin in range(DEPTH, len(body), SLICE):
            parts.append(body[begin - DEPTH : begin + SLICE])
            owner.append(number)
            size += len(parts[-1])
            if size >= SLICE:
                yield _grams(parts, owner)
                parts, owner, size = [], [], 0
    if parts:
        yield _grams(parts, owner)


def _grams(parts: list[bytes], owner: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, parts), "i8", len(parts))
    first = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(parts), "u1").astype("i8")
    code = data[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        code |= data[DEPTH - back : len(data) - back] << 8 * back
    there = np.ones(len(data), bool)
    there[(first[:, None] + np.arange(DEPTH)).ravel()] = False  # contexts before a part
    return code[there[DEPTH:]], np.array(owner), first - DEPTH * np.arange(len(parts))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x up to 10**30 or so: Stirling's series behind eight steps of the recurrence."""
    shift = x.copy()
    for i in range(1, 8):
        shift *= x + i
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - 2 * log_gamma(np.array([0.5]))[0]


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and where each key has gone; quick for keys that come in sorted runs."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    index = np.empty(len(key), "i8")
    index[order] = np.cumsum(new) - 1
    return key[new], index


class Level:
    """Binary nodes of one depth: sorted keys (context, bits so far behind a one), counts and weighted log probabilities."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None = None):
        self.key, self.index = grouped(key)  # index: where what it is made from has gone
        self.zeros, self.ones = (np.bincount(self.index, x, len(self.key)).astype("f8") for x in (zeros, ones))
        self.weighted = own = log_kt(self.zeros, self.ones)
        self.alpha = np.ones(len(self.key))  # the weight of stopping here
        if below is not None:
            deeper = np.bincount(self.index, below, len(self.key))
            self.weighted = np.logaddexp(own, deeper) - np.log(2)
            self.alpha = np.exp(own - np.log(2) - self.weighted)

    def above(self, depth: int) -> Level:
        """The level with contexts of depth bytes, made from this one."""
        return Level(shortened(self.key, depth), self.zeros, self.ones, self.weighted)

    def mix(self, mixed: np.ndarray, rest: np.ndarray) -> None:
        """Set p, the probability of a one if no deeper context is known, from the mixture of the levels above and what it leaves."""
        one = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        self.p = mixed + rest * one
        self.mixed, self.rest = mixed + rest * self.alpha * one, rest * (1 - self.alpha)


def shortened(key: np.ndarray, depth: int) -> np.ndarray:
    return (key >> 8 & ((1 << 8 * depth) - 1)) << 8 | key & 255


def bits(code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For the eight bits of the next byte: the bits before it behind a one, and the bit."""
    byte = code & 255
    for i in range(8):
        yield (1 << i) | byte >> (8 - i), byte >> (7 - i) & 1


def subtree_levels(code: np.ndarray, n: np.ndarray) -> list[Level]:
    """Levels TOP to DEPTH of grams with counts; the deepest level's index has the grams' nodes, one bit after the other."""
    key, one = (np.concatenate(x) for x in zip(*(((code >> 8) << 8 | node, bit) for node, bit in bits(code)), strict=True))
    n = np.tile(n, 8).astype("f8")
    levels = [Level(key, n * (1 - one), n * one)]
    for depth in range(DEPTH - 1, TOP - 1, -1):
        levels.append(levels[-1].above(depth))
    return levels[::-1]


def top_levels(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray) -> list[Level]:
    """Levels 0 to TOP - 1, mixed, from what the subtrees add to level TOP - 1."""
    levels = [Level(key, zeros, ones, weighted)]
    for depth in range(TOP - 2, -1, -1):
        levels.append(levels[-1].above(depth))
    levels.reverse()
    levels[0].mix(np.zeros(len(levels[0].key)), np.ones(len(levels[0].key)))
    for upper, lower in zip(levels, levels[1:], strict=False):
        lower.mix(upper.mixed[upper.index], upper.rest[upper.index])
    return levels


def log10_grams(code: np.ndarray, n: np.ndarray, top: list[Level]) -> np.ndarray:
    """log10 probability of the last byte of each gram of whole subtrees, with the mixed levels above them."""
    total, known = np.zeros(len(code)), n > 0
    levels = subtree_levels(code[known], n[known])
    at = np.searchsorted(top[-1].key, shortened(levels[0].key, TOP - 1))
    levels[0].mix(top[-1].mixed[at], top[-1].rest[at])
    for upper, lower in zip(levels, levels[1:], strict=False):
        lower.mix(upper.mixed[upper.index], upper.rest[upper.index])
    p = levels[-1].p[levels[-1].index].reshape(8, -1)
    total[known] = sum(np.log10(np.where(bit == 1, p[i], 1 - p[i])) for i, (_, bit) in enumerate(bits(code[known])))
    new = code[~known]  # grams that training texts lack: down to the deepest node that they have
    for node, bit in bits(new):
        p, live = np.full(len(new), 0.5), np.ones(len(new), bool)
        for depth, level in enumerate([*top, *levels]):
            if len(level.key):
                key = shortened(new, depth) & ~255 | node
                at = np.minimum(np.searchsorted(level.key, key), len(level.key) - 1)
                live &= level.key[at] == key
                p = np.where(live, level.p[at], p)
            else:
                live[:] = False
        total[~known] += np.log10(np.where(bit == 1, p, 1 - p))
    return total


def in_chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of a task's rows with chunk, in small parts. Rows must come in the same order each time: a scan of files, or a written table.

    It runs in the worker that uses the chunks: a worker of its own for each task would hold the texts once more.
    """
    before = 0
    for batch in small_parts(batches):
        ends = before + np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype("i8"))
        starts = np.concatenate([[before], ends[:-1]]) if len(ends) else ends
        before = int(ends[-1]) if len(ends) else before
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((TaskContext.get().partitionId() << 32) + starts // size)], [*batch.schema.names, "chunk"])


def squeezed_texts(rows: DataFrame) -> DataFrame:
    """(doc_id, held_out, chunk, text), the text as compressed bytes for the shuffle."""
    size = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, size):
            pack = ZstdCompressor(level=1).compress
            texts = pa.array([pack(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()], "binary")
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "held_out", "chunk")), texts], ["doc_id", "held_out", "chunk", "text"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, chunk long, text binary"
    return rows.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def squeezed(x: np.ndarray, rising: bool = False) -> bytes:
    """Numbers as compressed bytes; rising ones as differences."""
    return ZstdCompressor(level=1).compress((np.diff(x, prepend=x.dtype.type(0)) if rising else x).tobytes())


def numbers(data: bytes, kind: str = "i8", rising: bool = False) -> np.ndarray:
    x = np.frombuffer(ZstdDecompressor().decompress(data), kind)
    return np.cumsum(x) if rising else x


def text_words(data: bytes) -> list[bytes]:
    return ZstdDecompressor().decompress(data).split()


def group_of(code: np.ndarray) -> np.ndarray:
    """Groups by the bytes furthest back, so that a group's grams have much in common."""
    mixed = (code >> 24).astype("u8") * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)).astype("i8") % GROUPS


def summed(code: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, index = grouped(np.concatenate(code))
    return code, np.bincount(index, np.concatenate(n), len(code)).astype("i8")


class Lookup:
    """Values by key in an open table, for many more lookups than keys; every key that is asked for is there.

    Keys are added in parts, so that nothing but the table is held for all of them at once.
    """

    def __init__(self, size: int, kind: str = "f4"):
        self.mask = (1 << max(4, (size * 3 // 2).bit_length())) - 1
        self.key, self.value = np.full(self.mask + 1, -1, "i8"), np.zeros(self.mask + 1, kind)

    def add(self, key: np.ndarray, value: np.ndarray) -> None:
        slot = self._slot(key)
        while len(key):
            free = self.key[slot] == -1
            self.key[slot[free]] = key[free]
            won = self.key[slot] == key
            self.value[slot[won]] = value[won]
            key, value, slot = key[~won], value[~won], (slot[~won] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype("u8") * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(32)).astype("i8") & self.mask

    def __getitem__(self, key: np.ndarray) -> np.ndarray:
        slot = self._slot(key)
        open_places = np.flatnonzero(self.key[slot] != key)
        while len(open_places):
            slot[open_places] = (slot[open_places] + 1) & self.mask
            open_places = open_places[self.key[slot[open_places]] != key[open_places]]
        return self.value[slot]


PACKED = "words binary, n_words binary, codes binary, n_codes binary"


def asked(rows: DataFrame) -> DataFrame:
    """(part, chunk, PACKED): the words and grams of each chunk by hash group, with their counts in its training texts."""
    from zlib import crc32

    names = ["part", "chunk", "words", "n_words", "codes", "n_codes"]

    size = CHUNK

    def packed(chunk: int, train: Counter, seen: set, code: list[list[np.ndarray]], n: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        by_group: list[list[bytes]] = [[] for _ in range(GROUPS)]
        for word in seen.union(train):
            by_group[crc32(word) % GROUPS].append(word)
        pack = ZstdCompressor(level=1).compress
        for k in range(PARTS):
            codes, counts = summed(code[k], n[k])
            code[k] = n[k] = None
            group = group_of(codes)
            order, groups = np.argsort(group, kind="stable"), range(k, GROUPS, PARTS)
            starts, ends = (np.searchsorted(group[order], groups, side) for side in ("left", "right"))
            codes, counts = codes[order], counts[order]
            out = [(g, chunk, pack(b" ".join(found := sorted(by_group[g]))), squeezed(np.array([train[w] for w in found], "i8")), squeezed(codes[a:b], rising=True), squeezed(counts[a:b])) for g, a, b in zip(groups, starts, ends, strict=True)]
            kinds = ("int32", "int64", *["binary"] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def empty() -> list[list[np.ndarray]]:
        return [[np.zeros(0, "i8")] for _ in range(PARTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, train, seen, code, n, held = None, Counter(), set(), empty(), empty(), 0
        for batch in in_chunks(batches, size):
            chunks, held_out = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "held_out"))
            ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype("i8"))
            begin = 0
            while begin < len(chunks):
                if chunks[begin] != chunk:
                    if chunk is not None:
                        yield from packed(chunk, train, seen, code, n)
                    chunk, train, seen, code, n, held = int(chunks[begin]), Counter(), set(), empty(), empty(), 0
                before = ends[begin - 1] if begin else 0
                end = min(max(begin + 1, int(np.searchsorted(ends, before + SLICE, "right"))), int(np.searchsorted(chunks, chunk, "right")))
                texts = batch.column("text").slice(begin, end - begin).to_pylist()
                for kind in (False, True):
                    found = [words(text) for text, out in zip(texts, held_out[begin:end], strict=True) if out == kind]
                    for text in found:
                        (seen if kind else train).update(text)
                    for part, _, _ in slices(found):
                        part, count = np.unique(part, return_counts=True)
                        own = group_of(part) % PARTS
                        for k in range(PARTS):
                            code[k].append(part[own == k])
                            n[k].append(count[own == k] * (not kind))
                        held += len(part)
                if held > 2 * SLICE:
                    for k in range(PARTS):
                        code[k], n[k] = ([x] for x in summed(code[k], n[k]))
                    held = 0
                begin = end
        if chunk is not None:
            yield from packed(chunk, train, seen, code, n)

    return materialize(rows.select("held_out", "text").mapInArrow(run, f"part int, chunk long, {PACKED}"), "asked", compression="zstd")


def vocabulary(wanted: DataFrame) -> DataFrame:
    """(part, PACKED): the words and grams of each hash group over all chunks."""
    names = ["part", "words", "n_words", "codes", "n_codes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, total, code, n, held = None, Counter(), [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if group is not None:
                codes, counts = summed(code, n)
                row = (group, ZstdCompressor(level=1).compress(b" ".join(total)), squeezed(np.fromiter(total.values(), "i8", len(total))), squeezed(codes, rising=True), squeezed(counts))
                yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, ("int32", *["binary"] * 4), strict=True)], names)

        for batch in batches:
            for part, found, spoken, codes, counts in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if part != group:
                    yield from flush()
                    group, total, code, n, held = part, Counter(), [], [], 0
                for word, c in zip(text_words(found), numbers(spoken).tolist(), strict=True):
                    total[word] += c
                code.append(numbers(codes, rising=True))
                n.append(numbers(counts))
                held += len(code[-1])
                if held > 4 * SLICE:
                    merged = summed(code, n)
                    code, n, held = [merged[0]], [merged[1]], 0
        yield from flush()

    rows = wanted.select(*names).repartition("part").sortWithinPartitions("part")
    return materialize(rows.mapInArrow(run, f"part int, {PACKED}"), "vocabulary", compression="zstd")


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, counts) of whole subtrees, about AT_ONCE grams at once; rows come sorted by subtree."""
    code, n = np.zeros(0, "i8"), np.zeros(0, "i8")
    for batch in batches:
        code, n = (np.concatenate([old, batch.column(c).to_numpy()]) for old, c in ((code, "code"), (n, "n")))
        if len(code) >= AT_ONCE:
            subtree = code >> 8 & 0xFFFFFF
            whole = int(np.searchsorted(subtree, subtree[-1]))
            if whole:
                yield code[:whole], n[:whole]
                code, n = code[whole:], n[whole:]
    if len(code):
        yield code, n


def gram_scores(known: DataFrame) -> DataFrame:
    """(part, codes, scores): log10 probabilities of the grams of all groups, packed."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(numbers(codes, rising=True)), pa.array(numbers(counts))], ["code", "n"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _subtrees(batches):
            if (n > 0).any():
                level = subtree_levels(code[n > 0], n[n > 0])[0]
                key, index = grouped(shortened(level.key, TOP - 1))
                yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(np.bincount(index, x, len(key))) for x in (level.zeros, level.ones, level.weighted))], ["key", "zeros", "ones", "weighted"])

    subtree = F.shiftright("code", 8).bitwiseAND(0xFFFFFF)
    grams = known.select("codes", "n_codes").mapInArrow(unpack, "code long, n long")
    grams = grams.repartition(subtree).sortWithinPartitions(subtree)
    found = grams.mapInArrow(sums, "key long, zeros double, ones double, weighted double").groupBy("key").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")))
    table = found.orderBy("key").toArrow()  # 65,536 contexts of 255 nodes at most, whatever the corpus
    shared = known.sparkSession.sparkContext.broadcast(top_levels(*(c.to_numpy() for c in table.columns)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _subtrees(batches):
            scores = log10_grams(code, n, shared.value).astype("f4")
            group = group_of(code)
            order = np.lexsort((code, group))
            code, scores, (there, first) = code[order], scores[order], np.unique(group[order], return_index=True)
            cuts = [*first.tolist(), len(code)]
            columns = ([squeezed(x[a:b], rising) for a, b in zip(cuts, cuts[1:], strict=False)] for x, rising in ((code, True), (scores, False)))
            yield pa.RecordBatch.from_arrays([pa.array(there.astype("i4")), *(pa.array(c, "binary") for c in columns)], ["part", "codes", "scores"])

    return grams.mapInArrow(score, "part int, codes binary, scores binary")


def answers(wanted: DataFrame, known: DataFrame, scored: DataFrame) -> DataFrame:
    """(chunk, words, counts, codes, scores): what each chunk has asked for. A group's words and grams come before those who ask."""
    none = F.lit(None).cast("binary")
    rows = wanted.select("part", "chunk", "words", none.alias("counts"), "codes", none.alias("scores"))
    rows = rows.union(known.select("part", F.lit(None).cast("long"), "words", "n_words", none, none)).union(scored.select("part", F.lit(None).cast("long"), none, none, "codes", "scores"))
    names = ["chunk", "words", "counts", "codes", "scores"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, total, code, score = None, {}, [], []
        for batch in batches:
            out = []
            for part, *row in zip(*(batch.column(c).to_pylist() for c in ["part", *names]), strict=True):
                chunk, found, counts, codes, scores = row
                if part != group:
                    group, total, code, score = part, {}, [np.zeros(0, "i8")], [np.zeros(0, "f4")]
                if scores is not None:
                    code.append(numbers(codes, rising=True))
                    score.append(numbers(scores, "f4"))
                elif chunk is None:
                    total = dict(zip(text_words(found), numbers(counts).tolist(), strict=True))
                else:
                    if len(code) > 1:
                        order = np.argsort(np.concatenate(code))
                        code, score = [np.concatenate(code)[order]], [np.concatenate(score)[order]]
                    at = np.searchsorted(code[0], numbers(codes, rising=True))
                    out.append((chunk, found, squeezed(np.array([total[w] for w in text_words(found)], "i8")), codes, score[0][at].tobytes()))
            kinds = ("int64", *["binary"] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    # Null chunks sort first.
    return rows.repartition("part").sortWithinPartitions("part", "chunk").mapInArrow(run, "chunk long, words binary, counts binary, codes binary, scores binary")


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for each row of docs, learned from rows not held out."""
    docs, _ = numbered(docs)
    rows = docs.select("doc_id", text_or_empty().alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    texts = rows.filter("NOT held_out").count()
    wanted = asked(rows)
    known = vocabulary(wanted)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [numbers(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int(c.sum()) for c in counts], "int64"), pa.array([int((c > 0).sum()) for c in counts], "int64")], ["n", "v"])

    spoken, distinct = known.select("n_words").mapInArrow(totals, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    n, v = (spoken or 0) + texts, (distinct or 0) + (texts > 0)
    low = np.log10(n + v + 1)
    found = answers(wanted, known, gram_scores(known))
    out = [("doc_id", rows.schema["doc_id"].dataType.simpleString()), ("held_out", "boolean"), ("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"), ("score", "double"), ("bits_per_byte", "double")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        counts = {}
        for row, c in zip(right.column("words").to_pylist(), right.column("counts").to_pylist(), strict=True):
            counts.update(zip(text_words(row), numbers(c).tolist(), strict=True))
        scores = Lookup(pc.sum(pc.binary_length(right.column("scores"))).as_py() // 4)
        for part in right.select(["codes", "scores"]).to_batches():
            for codes, score in zip(*part.columns, strict=True):
                scores.add(numbers(codes.as_py(), rising=True), np.frombuffer(score.as_py(), "f4"))
        base, hits, tokens, size, total = ([] for _ in range(5))
        for part in left.column("text").chunks:
            todo, begin = part.to_pylist(), 0
            while begin < len(todo):
                end, room = begin, 0
                split = []
                while end < len(todo) and room < SLICE:
                    text = ZstdDecompressor().decompress(todo[end])
                    room += len(text)
                    split.append(text.lower().split())
                    end += 1
                sums = np.zeros((2, len(split)))
                for grams, owner, first in slices(split):
                    each = np.add.reduceat(scores[grams].astype("f8"), first)
                    np.add.at(sums[0], owner, each)
                    np.add.at(sums[1], owner, np.diff(np.append(first, len(grams))))
                total += sums[0].tolist()
                size += sums[1].tolist()
                for text in split:
                    c = np.fromiter(map(counts.__getitem__, text), "i8", len(text))
                    tokens.append(len(text) + 1)
                    hits.append(int((c > 0).sum()) + (texts > 0))
                    base.append(np.log10(c + 1.0).sum() + np.log10(texts + 1.0) - low * (len(text) + 1))
                begin = end
        total, size = np.array(total, "f8"), np.array(size, "f8")
        arrays = [left.column("doc_id"), left.column("held_out"), pa.array(tokens, "int64"), pa.array(hits, "int64"), pa.array([n] * len(tokens), "int64"), pa.array(base, "float64"), pa.array(total), pa.array(-total / np.log10(2) / np.maximum(size, 1))]
        return pa.table(arrays, names=[name for name, _ in out])

    return squeezed_texts(rows).groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(run, ", ".join(" ".join(x) for x in out))

