"""Removal of repeated byte strings by prefix-free parsing.

Rolling hashes trigger phrases: the trigger of a string of LENGTH bytes is its least eight-byte hash among the first SPAN
positions, so equal strings have their trigger at the same place, and a trigger serves a run of neighbouring strings. The
bytes from a trigger that all its strings share are its core. The dictionary has each distinct phrase once: the bytes of
all strings that one trigger serves, at most LENGTH + 2 * SPAN of them; the parse says where phrases occur.

1. Cores are counted (one 64-bit hash per trigger is shuffled). Those that occur twice are kept, by a filter of bounded size or,
   beyond it, by a join.
2. Their triggers are the parse. As phrases overlap, each holds its strings whole, and the order of the parse is needed to one
   phrase only: occurrences are brought together by phrase. All strings of a phrase that occurs twice are repeated.
3. Other phrases can only share strings with phrases of the same core. Where a core has several phrases, two suffix arrays of the
   dictionary are made: its phrases from the trigger on, and backwards from the trigger, both with common prefixes of
   neighbours. A string that starts a bytes before the trigger is shared by phrases that agree in a bytes backwards and in
   LENGTH - a bytes onwards, which are intervals of both arrays; the bytes themselves are compared.
4. Cores never share a string, so tasks take whole cores. One with more than HOT phrases is split down to single strings instead,
   which meet by a 128-bit cryptographic digest.
5. Repeated starts go back to their documents, which are cut.

Phrases are told apart by 128-bit cryptographic digests, texts by 128 bits of their SHA-256.

Defined results: null text is empty text; texts shorter than LENGTH keep all bytes; equal rows repeat each other; a null
doc_id is carried along; an empty table gives no rows; texts of any length are parsed in slices; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import KeyFilter, materialize, text_or_empty

LENGTH, SPAN = 400, 201
CORE = LENGTH - SPAN + 1
#: Up to FILTER_KEYS repeated cores are kept by a bitmap of 2**FILTER_BITS bits (16 MB), more by a join.
FILTER_BITS, FILTER_KEYS = 27, 1 << 24
#: Phrases of one core that one task compares (some 30 MB); and bytes of phrases that are compared at once.
HOT, AT_ONCE = 50_000, 2_000_000
#: Bytes that are parsed at once.
SLICE = 2_000_000


def triggers(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigger, first start, last start) of the strings of LENGTH bytes that start where valid says."""
    n = len(valid)
    wide = np.lib.stride_tricks.as_strided(data, (n + SPAN - 1, 8), (1, 1)).copy().view("<u8").ravel()
    hashes = wide * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype="u8")
    size = 1
    while 2 * size <= SPAN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: n], least[SPAN - size : SPAN - size + n])
    starts = np.flatnonzero(valid)
    trigger = (least[starts] & np.uint64(0xFFFFFFFF)).astype("i8")
    new = np.ones(len(starts), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    return trigger[first], starts[first], starts[np.append(first[1:], len(starts)) - 1]


def parse(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """(text number, offset of the slice, trigger, first, last, bytes) in groups of about SLICE bytes; positions are in the bytes."""
    group, size = [], 0
    for number, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - LENGTH + 1), SLICE):
            part = text if len(text) <= SLICE else text[begin : begin + SLICE + LENGTH - 1]
            if len(part) >= LENGTH:
                group.append((number, begin, part))
                size += len(part)
            if size >= SLICE:
                yield _parsed(group)
                group, size = [], 0
    if group:
        yield _parsed(group)


def _parsed(group: list[tuple[int, int, bytes]]):
    joined = b"".join(part for _, _, part in group)
    sizes = np.array([len(part) for _, _, part in group])
    ends = np.cumsum(sizes)
    valid = np.arange(len(joined) - LENGTH + 1) + LENGTH <= np.repeat(ends, sizes)[: len(joined) - LENGTH + 1]
    trigger, first, last = triggers(np.frombuffer(joined, "u1"), valid)
    owner = np.searchsorted(ends, first, "right")
    number, offset = (np.array(x) for x in list(zip(*group, strict=True))[:2])
    return number[owner], (offset - ends + sizes)[owner], trigger, first, last, joined


def _hashes(joined: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter((xxh3_64_intdigest(joined[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)), "u8", len(begins)).view("i8")


def _digests(joined: bytes, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.array([hashlib.blake2b(joined[a:b], digest_size=16).digest() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], "binary")


def _encoded(column: pa.Array) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def core_counts(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, trigger, _, _, joined in parse(_encoded(batch.column(0))):
                core, n = np.unique(_hashes(joined, trigger, trigger + CORE), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(np.minimum(n, 2).astype("i4"))], ["core", "n"])

    return docs.select("text").mapInArrow(run, "core long, n int").groupBy("core").agg(F.sum("n").alias("n"))


def core_filter(cores: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of 2**bits bits with one for each core."""
    slot = F.col("core").bitwiseAND((1 << bits) - 1) + 1
    rows = cores.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))
    made = np.zeros((1 << bits) // 8, "u1")
    for row in rows.collect():  # 2**bits / 32768 rows of 4 KB at most
        at = (row["bucket"] - 1) * 4096
        made[at : at + 4096] = np.frombuffer(row["bitmap"], "u1")[: len(made) - at]
    return made


def phrases(docs: DataFrame, cores: DataFrame) -> DataFrame:
    """The parse: (text_key, core, phrase, first, at, last) of triggers, at the place at, whose core is in cores; first and last are starts of strings."""
    few = cores.count() <= FILTER_KEYS
    shared = docs.sparkSession.sparkContext.broadcast(core_filter(cores) if few else None)
    names = ["text_key", "core", "phrase", "first", "at", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            for number, offset, trigger, first, last, joined in parse(_encoded(batch.column(1))):
                core = _hashes(joined, trigger, trigger + CORE)
                if bitmap is not None:
                    slot = core & np.int64(len(bitmap) * 8 - 1)
                    keep = (bitmap[slot >> 3] >> (slot & 7).astype("u1")) & 1 == 1
                    number, offset, trigger, first, last, core = (x[keep] for x in (number, offset, trigger, first, last, core))
                places = (pa.array((x + offset).astype("i4")) for x in (first, trigger, last))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(number)), pa.array(core), _digests(joined, first, last + LENGTH), *places], names)

    parsed = docs.select("text_key", "text").mapInArrow(run, "text_key binary, core long, phrase binary, first int, at int, last int")
    return parsed if few else parsed.join(cores, "core", "left_semi").select(*names)


def _by_text(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows of each text in one array, which its length bounds."""
    return materialize(rows.groupBy("text_key").agg(F.collect_set(F.struct(*columns)).alias("found")), "by-text")


def dictionary(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text_key, core, first, at, single, hot, phrase): the bytes of the phrases wanted (text_key, core, first, at, last, single, hot)."""
    by = _by_text(wanted, "core", "first", "at", "last", "single", "hot")
    names = ["text_key", "core", "first", "at", "single", "hot", "phrase"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, found in zip(batch.column(0), _encoded(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                columns = [pa.array([f[k] for f in found], kind) for k, kind in (("core", "int64"), ("first", "int32"), ("at", "int32"), ("single", "bool"), ("hot", "bool"))]
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(found), "binary"), *columns, pa.array([text[f["first"] : f["last"] + LENGTH] for f in found], "binary")], names)

    # One document of each text will do, and only texts that are wanted are shuffled.
    texts = KeyFilter(by, F.col("text_key")).maybe_in(docs.select("text_key", "text"), F.col("text_key")).dropDuplicates(["text_key"])
    return texts.join(by, "text_key").select("text_key", "text", "found").mapInArrow(run, "text_key binary, core long, first int, at int, single boolean, hot boolean, phrase binary")


def _suffix_array(core: np.ndarray, suffixes: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of each suffix in the order of (core, bytes), bytes that it has in common with the one before; below zero for another core)."""
    table = np.zeros((len(core), 8 + width), "u1")
    table[:, :8] = core.astype(">i8").view("u1").reshape(-1, 8)
    for i, suffix in enumerate(suffixes):
        table[i, 8 : 8 + len(suffix)] = np.frombuffer(suffix, "u1")
    order = np.argsort(table.view(f"S{8 + width}").ravel(), kind="stable")
    differ = table[order[1:]] != table[order[:-1]]
    common = np.where(differ.any(1), differ.argmax(1), 8 + width) - 8
    place = np.empty(len(core), "i8")
    place[order] = np.arange(len(core))
    return place, np.concatenate([[-8], common])


def shared_strings(core: np.ndarray, left: np.ndarray, found: list[bytes]) -> np.ndarray:
    """For each phrase and each a below SPAN: whether its string that starts a bytes before the trigger is in another phrase too.

    left is the number of bytes before the trigger. Bytes behind a phrase's end are padded with zeros; a string is only
    compared where both phrases hold it whole.
    """
    onwards = _suffix_array(core, [p[k : k + LENGTH] for p, k in zip(found, left.tolist(), strict=True)], LENGTH)
    backwards = _suffix_array(core, [p[:k][::-1] for p, k in zip(found, left.tolist(), strict=True)], SPAN)
    nearest = left - (np.fromiter(map(len, found), "i8", len(found)) - LENGTH)  # a of the last string
    out = np.zeros((len(core), SPAN), bool)
    for a in range(int(nearest.min()), int(left.max()) + 1):
        rows = np.flatnonzero((nearest <= a) & (a <= left))
        behind, before = (np.cumsum(common < depth)[place[rows]] for (place, common), depth in ((onwards, LENGTH - a), (backwards, a)))
        _, index, n = np.unique(behind * (len(core) + 1) + before, return_inverse=True, return_counts=True)
        out[rows, a] = n[index] > 1
    return out


def _starts(phrase_rows: DataFrame) -> DataFrame:
    """(text_key, first, last): ranges of starts of single phrases' strings that another phrase of the core has too; whole cores meet in one task."""
    def compared(rows: list[tuple]) -> pa.RecordBatch:
        core, left = np.array([r[1] for r in rows], "i8"), np.array([r[3] - r[2] for r in rows], "i8")
        mask = shared_strings(core, left, [r[5] for r in rows]) & np.array([r[4] for r in rows])[:, None]
        edges = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype("i1"), axis=1)
        (row, low), (_, high) = np.nonzero(edges == 1), np.nonzero(edges == -1)
        at = np.array([r[3] for r in rows], "i8")[row]
        return pa.RecordBatch.from_arrays([pa.array([rows[i][0] for i in row.tolist()], "binary"), pa.array((at - high + 1).astype("i4")), pa.array((at - low).astype("i4"))], ["text_key", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= AT_ONCE and row[1] != rows[-1][1]:
                    yield compared(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
        if rows:
            yield compared(rows)

    rows = phrase_rows.select("text_key", "core", "first", "at", "single", "phrase").repartition("core").sortWithinPartitions("core")
    return rows.mapInArrow(run, "text_key binary, first int, last int")


def _hot_starts(phrase_rows: DataFrame) -> DataFrame:
    """The same for cores of any number of phrases: every string is a row of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, core, first, single, phrase in zip(*(batch.column(c).to_pylist() for c in ("text_key", "core", "first", "single", "phrase")), strict=True):
                begins = np.arange(len(phrase) - LENGTH + 1)
                n = len(begins)
                yield pa.RecordBatch.from_arrays([pa.array([key] * n, "binary"), pa.array([core] * n, "int64"), pa.array((begins + first).astype("i4")), pa.array([single] * n), _digests(phrase, begins, begins + LENGTH)], ["text_key", "core", "start", "single", "string"])

    strings = materialize(phrase_rows.mapInArrow(run, "text_key binary, core long, start int, single boolean, string binary"), "hot-strings")
    twice = materialize(strings.groupBy("core", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core", "string"), "hot-strings-twice")
    again = KeyFilter(twice, F.col("string")).maybe_in(strings.filter("single"), F.col("string")).join(twice, ["core", "string"])
    return again.select("text_key", F.col("start").alias("first"), F.col("start").alias("last"))


def repeated_starts(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(text_key, first, last): every start of a string of LENGTH bytes that also starts elsewhere lies in such a range."""
    cores = materialize(core_counts(docs).filter("n > 1").select("core"), "repeated-cores")
    parsed = materialize(phrases(docs, cores), "parse")
    distinct = materialize(parsed.groupBy("core", "phrase").agg(F.count(F.lit(1)).alias("n")), "phrases")
    by_core = distinct.groupBy("core").agg(F.count(F.lit(1)).alias("phrases"), F.bool_or(F.col("n") == 1).alias("open"))
    # A table of its own, so that Spark can split a core with many phrases in the join.
    mixed = materialize(by_core.filter("phrases > 1 AND open").select("core", (F.col("phrases") > hot).alias("hot"), F.lit(True).alias("mixed")), "mixed-cores")
    flagged = distinct.join(mixed, "core", "left").filter("n > 1 OR mixed")
    found = materialize(parsed.join(flagged, ["core", "phrase"]), "found-phrases")
    whole = found.filter("n > 1").select("text_key", "first", "last")
    one = found.filter("mixed").groupBy("core", "phrase", "n", "hot").agg(F.min(F.struct("text_key", "first", "at", "last")).alias("x"))
    wanted = one.select("x.text_key", "core", "x.first", "x.at", "x.last", (F.col("n") == 1).alias("single"), "hot")
    rows = materialize(dictionary(docs, wanted), "dictionary", compression="zstd")
    out = whole.union(_starts(rows.filter("NOT hot")))
    return out if mixed.filter("hot").isEmpty() else out.union(_hot_starts(rows.filter("hot")))


def cut(text: bytes, ranges: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]], bytes]:
    """Removed bytes, maximal removed runs (start, end) and the bytes that stay, for ranges of repeated starts."""
    change = np.zeros(len(text) + 1, "i4")
    if ranges:
        first, last = np.array(ranges, "i8").T
        np.add.at(change, first, 1)
        np.add.at(change, last + LENGTH, -1)
    gone = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
    return int(gone.sum()), list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), np.frombuffer(text, "u1")[~gone].tobytes()


def remove_repeats(docs: DataFrame, with_bytes: bool = False, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept, removed]) for each row of docs; kept are bytes, removed the runs."""
    docs = docs.select("doc_id", text_or_empty().alias("text"))
    docs = docs.select("doc_id", F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("text_key"), "text")
    ranges = _by_text(repeated_starts(docs, hot), "first", "last")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "removed"] * with_bytes
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _encoded(batch.column(1))
            done = [cut(text, [(f["first"], f["last"]) for f in found or ()]) for text, found in zip(texts, batch.column(2).to_pylist(), strict=True)]
            columns = [pa.array([len(t) for t in texts], "int64"), pa.array([d[0] for d in done], "int64"), pa.array([len(d[1]) for d in done], "int64"), pa.array([hashlib.sha256(d[2]).hexdigest() for d in done], "string")]
            if with_bytes:
                columns += [pa.array([d[2] for d in done], "binary"), pa.array([[{"start": a, "end": b} for a, b in d[1]] for d in done], span)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    filters = KeyFilter(ranges, F.col("text_key"))
    there = filters.maybe_in(docs, F.col("text_key")).join(ranges, "text_key", "left").select("doc_id", "text", "found")
    whole = filters.surely_out(docs, F.col("text_key")).select("doc_id", "text", F.lit(None).cast(ranges.schema["found"].dataType).alias("found"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, removed array<struct<start:long,end:long>>" * with_bytes
    return there.mapInArrow(run, schema).union(whole.mapInArrow(run, schema))
