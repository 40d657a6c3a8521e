"""Best-fit packing of token sequences by exact-complement hashing.

Documents become token ids and an end id; only longer ones are cut into full pieces, the first piece taking the rest. The
plan is made from the counts by length alone (as many numbers as a sequence has tokens, whatever the corpus): single, pair
and triple length sums that fill a sequence exactly are consumed under the counts of pieces that are left, then best fit
takes the residuals, longest first. Pieces then look up their place by length and rank; ranks are made in salted groups of
(length, bucket), so a length held by a third of all pieces is spread over all tasks.

Defined results: null text is empty text and gives one piece with the end id; repeated rows are packed as often as they
occur; a null doc_id is carried along; an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.common import materialize, slices, text_or_empty

CAPACITY, END = 2048, 0
#: Known parts of texts that a worker keeps before it starts anew.
KNOWN = 200_000
#: A white-space run and the word behind it, or white space at the end. Python's white space is Unicode's and ODD.
PART, ODD = re.compile(r"\s*\S+|\s+"), r"[\x1c-\x1f]"
#: Parts of Latin letters and other characters below this one are cut alike by every version of Unicode.
LATIN_END = "\u0250"


@cache
def _tokenizer(path: str):
    """The tokenizer, a faster encoder of parts, a pattern of what forbids to cut a text into parts (None: nothing may be cut), and the parts' ids known so far.

    GPT-like byte-level pre-tokens hold white space only in front of other characters, so a cut before a white-space run
    changes no pre-token: neither side is read to find the other's. That holds for this pattern only and not around added
    tokens, which are looked for in the whole text first; such texts go to the tokenizer whole. Parts of Latin letters are
    merged by tiktoken with the file's own merges, several times as fast; tests hold both libraries' ids against each other.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    form = json.loads(made.to_str())
    split = form["pre_tokenizer"] or {}
    cuts = form["normalizer"] is None and (split.get("type"), split.get("use_regex"), split.get("add_prefix_space")) == ("ByteLevel", True, False)
    if not cuts:
        return made, None, None, {}
    special = {token.content for token in made.get_added_tokens_decoder().values()}
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    shown = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in printable)}
    ranks = {bytes(shown[c] for c in token): i for token, i in made.get_vocab().items() if token not in special}  # ids follow the order of merges
    encoder = tiktoken.Encoding("ids", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return made, encoder, re.compile("|".join([ODD, *map(re.escape, special)])), {}


def token_bytes(texts: list[str], path: str) -> Iterator[bytes]:
    """Little-endian 32-bit ids of each text, as the tokenizer gives them; a part of a text that has been seen isn't encoded again."""
    made, encoder, odd, known = _tokenizer(path)
    for text in texts:
        if odd is None or odd.search(text):
            yield np.array(made.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            continue
        parts = PART.findall(text)
        if len(known) > KNOWN:
            known.clear()
        for part in set(parts).difference(known):
            ids = encoder.encode_ordinary(part) if max(part) < LATIN_END else made.encode(part, add_special_tokens=False).ids
            known[part] = pack_ids(f"<{len(ids)}I", *ids)
        yield b"".join(map(known.__getitem__, parts))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) for each piece of each document."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    last, step = int(end).to_bytes(4, "little"), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, data in enumerate(token_bytes(batch.column(1).to_pylist(), tokenizer_path)):
                data += last
                begin, stop = 0, len(data) % step or min(step, len(data))
                n = 0
                while begin < len(data):
                    rows.append(row)
                    piece.append(n)
                    start.append(begin // 4)
                    length.append((stop - begin) // 4)
                    crc.append(zlib.crc32(data[begin:stop]))
                    if with_ids:
                        ids.append(np.frombuffer(data[begin:stop], "<u4").astype("i4"))
                    begin, stop, n = stop, stop + step, n + 1
            columns = [batch.column(0).take(pa.array(rows, "int64")), pa.array(piece, "int32"), *(pa.array(x, "int64") for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences), using every length as often as counts says."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] += n
    runs: list[tuple[tuple[int, ...], int]] = []

    def take(*lengths: int) -> None:
        if n := min(left[x] // lengths.count(x) for x in lengths):
            for x in lengths:
                left[x] -= n
            runs.append((lengths, n))

    take(capacity)
    for a in range(capacity - 1, (capacity + 1) // 2 - 1, -1):
        take(a, capacity - a)
    there = [x for x in range(capacity - 2, 0, -1) if left[x]]
    for i, a in enumerate(there):
        for b in there[i:]:
            if not left[a]:
                break
            if left[b] and 1 <= capacity - a - b <= b:
                take(a, b, capacity - a - b)

    open_bins: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]  # by the gap that is left
    for length in range(capacity, 0, -1):
        gap = length
        while left[length]:
            while gap < capacity and not open_bins[gap]:
                gap += 1
            if gap < capacity:
                lengths, n = open_bins[gap].pop()
                used = min(n, left[length])
                if n > used:
                    open_bins[gap].append((lengths, n - used))
            else:
                each = capacity // length
                lengths, used = (length,) * (min(each, left[length]) - 1), max(1, left[length] // each)
                left[length] -= len(lengths) * used
            left[length] -= used
            lengths += (length,)
            open_bins[capacity - sum(lengths)].append((lengths, used))
            gap = min(gap, max(length, capacity - sum(lengths)))
    return runs + [run for group in open_bins for run in group]


def places(runs: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length in each run: the rank of its first piece, the first sequence and the offset, sorted by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in runs:
        offset = 0
        for length in lengths:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + n
            offset += length
        sequence += n
    table = np.array(sorted(rows), "int64").reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T, strict=True))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut (as pieces() gives it) with sequence_id and offset."""
    spark = cut.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(buckets)).cast("int"))
    salted = materialize(salted, "pieces")
    groups = salted.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    table = places(plan(counts, capacity))
    shared = spark.sparkContext.broadcast(table)  # its size depends on the capacity, not on the corpus
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    first = groups.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("rank", rank).join(first, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("first"))

    columns = cut.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        keys = (t["length"] << 44) + t["rank"]
        for batch in batches:
            at = {name: batch.column(name).to_numpy() for name in ("length", "rank")}
            i = np.searchsorted(keys, (at["length"] << 44) + at["rank"], "right") - 1
            arrays = [batch.column(c) for c in columns] + [pa.array(t["sequence"][i] + at["rank"] - t["rank"][i]), pa.array(t["offset"][i])]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return ranked.select(*cut.columns, F.col("rank").cast("long").alias("rank")).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    return pack(pieces(docs, tokenizer_path, capacity, with_ids=with_ids), capacity)
