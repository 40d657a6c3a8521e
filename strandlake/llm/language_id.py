"""Language ID: scripts narrow the candidates, Viterbi labels spans of mixed-language text.

The model is fitted on a bounded sample of distinct labelled texts (FIT_ROWS, chosen by a hash of the text): per language the
logarithms of word shares, and of letter trigram shares for words that the sample doesn't hold, and the languages seen in
each script. A word scores only in languages of its script. Viterbi over the words of a text pays SWITCH for each change
of language; its path gives labelled spans, and the language with most letters in the path is the text's.

Defined results: text that is null or has no letter is 'und' with score 0; the score is the share of letters in spans of
the predicted language; ties go to the language that sorts first; repeated rows are predicted one by one; without labelled
rows every text is 'und'; an empty table gives no rows; further columns are ignored here and stay in ``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import slices, text_or_empty

UND = "und"
#: The model is fitted on about this many distinct labelled texts, however many there are.
FIT_ROWS = 3000
SWITCH, FLOOR = 6.0, 0.5
#: First code points of script blocks; a word's script is the block of its first letter.
SCRIPTS = (0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0xE00, 0x1000, 0x1100, 0x1200, 0x2E80, 0x3040, 0x3100, 0xAC00, 0xD7B0)
LETTERS = regex.compile(r"\p{L}+")  # as in fit(): other numerals are no letters
#: Known white-space-separated words that a worker keeps, and words that are labelled at once.
KNOWN, AT_ONCE = 150_000, 300_000


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the trigrams of all words, each between two marks, and the first of each word."""
    points = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    codes = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
    sizes = np.fromiter(map(len, words), "i8", len(words))
    ends = np.cumsum(sizes + 2)
    keep = np.ones(len(points), bool)
    keep[ends - 1] = keep[ends - 2] = False
    return codes[keep[:-2]], np.cumsum(sizes) - sizes


class Model:
    """Word and trigram scores from (lang, word, n) counts of the bounded sample."""

    def __init__(self, counts: list[tuple[str, str, int]]):
        self.langs = sorted({lang for lang, _, _ in counts})
        at = {lang: i for i, lang in enumerate(self.langs)}
        words = [word for _, word, _ in counts]
        lang, n = np.array([at[lang] for lang, _, _ in counts], "i8"), np.array([n for _, _, n in counts], "f8")
        distinct = {word: i for i, word in enumerate(dict.fromkeys(words))}
        self.words, self.word_scores = distinct, self._logs(np.array([distinct[w] for w in words], "i8"), lang, n)
        codes, firsts = trigrams(words) if words else (np.zeros(0, "u8"), np.zeros(0, "i8"))
        owner = np.repeat(np.arange(len(words)), np.diff(np.append(firsts, len(codes))))
        self.grams, index = np.unique(codes, return_inverse=True)
        self.gram_scores = self._logs(index, lang[owner], n[owner], unseen=True)
        self.scripts = np.zeros((len(SCRIPTS) + 1, len(self.langs)), bool)
        self.scripts[self.script(words), lang] = True

    def _logs(self, rows: np.ndarray, lang: np.ndarray, n: np.ndarray, unseen: bool = False) -> np.ndarray:
        table = np.zeros((rows.max(initial=-1) + 1 + unseen, len(self.langs)))
        np.add.at(table, (rows, lang), n)
        return np.log((table + FLOOR) / (table.sum(0) + FLOOR * len(table)))

    @staticmethod
    def script(words: list[str]) -> np.ndarray:
        return np.searchsorted(SCRIPTS, np.fromiter((ord(w[0]) for w in words), "i8", len(words)), "right")

    def scores(self, words: list[str]) -> np.ndarray:
        """Log odds of lower-case words against their best language; languages of other scripts lose by much."""
        if not words:
            return np.zeros((0, len(self.langs)))
        codes, firsts = trigrams(words)
        i = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        got = np.add.reduceat(self.gram_scores[np.where(self.grams[i] == codes, i, len(self.grams))], firsts)
        seen = np.fromiter((self.words.get(w, -1) for w in words), "i8", len(words))
        got[seen >= 0] = self.word_scores[seen[seen >= 0]]
        allowed = self.scripts[self.script(words)]
        got = np.where(allowed | ~allowed.any(1, keepdims=True), got, got.max(1, keepdims=True) - 50)
        return np.maximum(got - got.max(1, keepdims=True), -50)


def viterbi(scores: np.ndarray, starts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of each row of scores (word, language); starts has the first row of each text, and the end.

    All texts advance together, the longest first, so that a step is a few array operations for all texts that still have words.
    """
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = starts[:-1][order], sizes[order]
    small = "i1" if scores.shape[1] < 128 else "i4"
    labels, back = np.zeros(len(scores), small), np.zeros(scores.shape, small)
    running = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")  # texts with at least so many words
    best = np.zeros((len(sizes), scores.shape[1]), "f4")
    for step, n in enumerate(running):
        rows = first[:n] + step
        if step:
            now = best[:n]
            top = now.argmax(1)
            leap = now[np.arange(n), top][:, None] - switch
            stay = now >= leap
            back[rows] = np.where(stay, np.arange(scores.shape[1]), top[:, None])
            best[:n] = np.where(stay, now, leap) + scores[rows]
        else:
            best[:n] = scores[rows]
    last = best.argmax(1)
    for step in range(len(running) - 1, -1, -1):
        n = running[step]
        rows = first[:n] + step
        labels[rows] = last[:n]
        last[:n] = back[rows, last[:n]] if step else last[:n]
    return labels


class Labeller:
    """Words of texts, their scores (kept for words seen before) and their spans."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores, self.letters = np.zeros((0, len(self.model.langs)), "f4"), np.zeros(0, "i8")

    def label(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text: the language number and the letters of each word with letters."""
        if len(self.known) > KNOWN:
            self._forget()
        found, ids, ends, count = [], [], [0], len(self.letters)
        for text in texts:
            words = text.split()
            for word in set(words).difference(self.known):
                parts = LETTERS.findall(word.lower())
                self.known[word] = count if parts else -1
                if parts:
                    found.append(parts)
                    count += 1
            ids += map(self.known.__getitem__, words)
            ends.append(len(ids))
        if found:
            flat, firsts = [p for parts in found for p in parts], np.cumsum([0] + [len(parts) for parts in found[:-1]])
            self.scores = np.concatenate([self.scores, np.add.reduceat(self.model.scores(flat), firsts).astype("f4")])
            self.letters = np.concatenate([self.letters, np.add.reduceat(np.fromiter(map(len, flat), "i8", len(flat)), firsts)])
        ids = np.array(ids, "i8")
        starts = np.concatenate([[0], np.cumsum(ids >= 0)])[ends]
        ids = ids[ids >= 0]
        labels, weights = viterbi(self.scores[ids], starts), self.letters[ids]
        for a, b in zip(starts, starts[1:], strict=False):
            yield labels[a:b], weights[a:b]

    def predict(self, texts: list[str]) -> Iterator[tuple[str, float, list[tuple[str, int, int]]]]:
        """For each text: language, score and spans (language, first word, words), words with letters counted from 0."""
        for labels, letters in self.label(texts) if self.model.langs else ((np.zeros(0, "i1"),) * 2 for _ in texts):
            if not len(labels):
                yield UND, 0.0, []
                continue
            weight = np.bincount(labels, letters, len(self.model.langs))
            cuts = np.flatnonzero(np.diff(labels)) + 1
            firsts, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(labels)]
            yield self.model.langs[weight.argmax()], float(weight.max() / weight.sum()), [(self.model.langs[labels[a]], a, b - a) for a, b in zip(firsts, ends, strict=True)]


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """labelled: (text, lang). About fit_rows distinct ones are used, those whose texts have the smallest hashes; a text that many rows hold counts once."""
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    share = min(1.0, fit_rows / max(1, rows.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0]))
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) or 1)).distinct()
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).toArrow()  # the vocabulary of the bounded sample
    return Model(list(zip(*(c.to_pylist() for c in counts.columns), strict=True)))


def predict_batch(labeller: Labeller, texts: list[str]) -> Iterator[tuple[str, float, list[tuple[str, int, int]]]]:
    """Predictions for all texts, made for a bounded number of words at once (one text at least)."""
    begin = 0
    while begin < len(texts):
        end, size = begin + 1, len(texts[begin])
        while end < len(texts) and size + len(texts[end]) < 6 * AT_ONCE:
            size += len(texts[end])
            end += 1
        yield from labeller.predict(texts[begin:end])
        begin = end


def identify(docs: DataFrame, model: Model, with_spans: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score[, spans]) for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the bounded sample's vocabulary
    span = "array<struct<lang:string,first_word:int,words:int>>"
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for batch in batches:
            out = list(predict_batch(labeller, batch.column(1).to_pylist()))
            langs, scores, spans = zip(*out, strict=True) if out else ((), (), ())
            arrays = [batch.column(0), pa.array(langs, "string"), pa.array(scores, "double")]
            if with_spans:
                arrays.append(pa.array([[dict(zip(("lang", "first_word", "words"), s, strict=True)) for s in x] for x in spans], pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("words", pa.int32())]))))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score"] + ["spans"] * with_spans)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double" + f", spans {span}" * with_spans)


def keep_identified(docs: DataFrame, model: Model, least_share: float) -> DataFrame:
    """The rows of docs whose best language holds at least least_share of their letters, with all their columns; lang is the predicted one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for batch in slices(batches):
            found = list(predict_batch(labeller, [t or "" for t in batch.column("text").to_pylist()]))
            kept = pa.array([i for i, (lang, score, _) in enumerate(found) if lang != UND and score >= least_share], "int64")
            langs = pa.array([lang for lang, _, _ in found], "string")
            yield pa.RecordBatch.from_arrays([(langs if c == "lang" else batch.column(c)).take(kept) for c in columns], columns)

    return docs.mapInArrow(run, docs.schema)
