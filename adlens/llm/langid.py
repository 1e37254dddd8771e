"""Language ID by word-first backoff.

A word seen in training scores its log frequency per language. Any other word
falls back to character n-grams: at each of its characters the longest known
n-gram that starts there (``MAX_GRAM`` characters, then one less, down to one)
gives a log frequency per language, and the word scores their mean.

Counting the training words is a Spark aggregation over a bounded sample of
the labelled rows; the kept tables (bounded by ``max_words`` and ``max_grams``
per language) go to the tasks, which score every row of the input.

Defined cases: a null text or one without a letter gives ``und`` with score
0; rows with a null language teach nothing; an empty training set gives
``und`` everywhere; repeated rows are scored alike; ties between languages
go to the smaller code. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import spread
from .spans import (BYTE_CODE, STEP, PrefixHash, codes_of, lookup, mix, small_batches, steps, text_buffer, words)

UNKNOWN = "und"
MAX_GRAM = 4
# Bytes of a word: ASCII letters and every byte of a non-ASCII character.
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
WORD_PATTERN = "[A-Za-z\\x{80}-\\x{10FFFF}]+"
# How many words' evidence the score counts at most, so that it stays
# comparable between short and long texts.
EVIDENCE = 8.0


class LanguageModel:
    """Sorted hashes of known words and n-grams, log frequencies beside them."""

    def __init__(self, langs, word_keys, word_logs, gram_keys, gram_logs, floor):
        self.langs, self.floor = langs, floor
        self.word_keys, self.word_logs = word_keys, word_logs
        self.gram_keys, self.gram_logs = gram_keys, gram_logs

    def score_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray,
                    hashes: PrefixHash) -> np.ndarray:
        """Log scores per language of the words at the given spans."""
        at = lookup(self.word_keys, codes)
        out = self.word_logs[at]
        new = np.flatnonzero(at < 0)
        if len(new) == 0:
            return out
        # characters of the unseen words: start, end, word
        size = ends[new] - starts[new]
        word = np.repeat(np.arange(len(new)), size)
        byte = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size) + starts[new][word]
        head = (data[byte] & 0xC0) != 0x80
        word, begin = word[head], byte[head]
        n = len(begin)
        end = np.append(begin[1:], 0)
        final = np.append(word[1:] != word[:-1], True)
        end[final] = ends[new][word[final]]
        logs = np.full((n, len(self.langs)), self.floor)
        open_ = np.arange(n)
        for k in range(MAX_GRAM, 0, -1):
            tail = open_ + k - 1
            fits = tail < n
            fits[fits] = word[tail[fits]] == word[open_[fits]]
            at, stop = open_[fits], end[tail[fits]]
            key = mix(hashes.span(begin[at], stop) + (stop - begin[at]).astype(np.uint64))
            found = lookup(self.gram_keys, key)
            hit = found >= 0
            logs[at[hit]] = self.gram_logs[found[hit]]
            done = np.zeros(n, bool)
            done[at[hit]] = True
            open_ = open_[~done[open_]]
        count = np.maximum(np.bincount(word, minlength=len(new)), 1)
        for j in range(len(self.langs)):
            out[new, j] = np.bincount(word, weights=logs[:, j], minlength=len(new)) / count
        return out

    def predict(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language (-1: none) and its score, per text."""
        lower = pc.utf8_lower(column)
        lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        data, off = text_buffer(lower)
        best, score = np.full(len(off) - 1, -1), np.zeros(len(off) - 1)
        if not self.langs:
            return best, score
        for a, b in steps(off, STEP):
            part, o = data[off[a]:off[b]], off[a:b + 1] - off[a]
            starts, ends, rows = words(part, o, LETTER)
            hashes = PrefixHash(BYTE_CODE[part])
            codes = mix(hashes.span(starts, ends) + (ends - starts).astype(np.uint64))
            _, first, same = np.unique(codes, return_index=True, return_inverse=True)
            logs = self.score_words(part, starts[first], ends[first], codes[first], hashes)
            count = np.diff(rows)
            row = np.repeat(np.arange(b - a), count)
            total = np.stack([np.bincount(row, weights=logs[same, j], minlength=b - a)
                              for j in range(len(self.langs))], axis=1)
            total *= (np.minimum(count, EVIDENCE) / np.maximum(count, 1))[:, None]
            top = total.argmax(axis=1)
            share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            ok = lettered[a:b]
            best[a:b], score[a:b] = np.where(ok, top, -1), np.where(ok, share, 0.0)
        return best, score


def fit(labelled: DataFrame, max_docs: int = 3000, max_words: int = 30_000, max_grams: int = 20_000) -> LanguageModel:
    """Learn from rows with ``doc_id``, ``text`` and a non-null ``lang``.

    ``max_docs`` is the expected number of rows per language taken, chosen by
    a hash of doc_id; ``max_words`` and ``max_grams`` bound what is kept of
    each language, most frequent first (ties: smaller string).
    """
    rows = labelled.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return LanguageModel([], np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros(0, np.uint64), np.zeros((0, 0)), 0.0)
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, max_docs / counts[lang]))])
    dice = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = spread(rows).where(dice < share[F.col("lang")])
    tokens = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD_PATTERN), F.lit(0))).alias("token"))
    seen = tokens.groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n"))
    known = _most_frequent(seen, max_words).cache()
    grams = known.select("lang", "n", "token", F.explode(F.sequence(F.lit(1), F.char_length("token"))).alias("at"))
    grams = grams.select("lang", "n", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.lit(MAX_GRAM)), lambda k: F.substr("token", F.col("at"), k)))).alias("token"))
    grams = _most_frequent(grams.groupBy("lang", "token").agg(F.sum("n").alias("n")), max_grams)
    word_keys, word_logs, _ = _table(known, langs)
    gram_keys, gram_logs, floor = _table(grams, langs)
    known.unpersist()
    return LanguageModel(langs, word_keys, word_logs, gram_keys, gram_logs, floor)


def _most_frequent(counted: DataFrame, limit: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "token")
    return counted.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= limit).drop("_r")


def _table(counted: DataFrame, langs: list[str]):
    """Sorted hashes and add-one log frequencies of a bounded count table."""
    pdf = counted.select("lang", "token", "n").toPandas()
    wide = pdf.pivot_table(index="token", columns="lang", values="n", aggfunc="sum", fill_value=0).reindex(columns=langs, fill_value=0)
    keys, counts = codes_of(list(wide.index)), wide.to_numpy(np.float64)
    order = np.argsort(keys)
    total = counts.sum(axis=0) + len(counts) + 1
    logs = np.log(counts + 1) - np.log(total)
    return keys[order], logs[order], float(np.log(1 / total).min())


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row of ``docs``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(parts):
        for part in small_batches(parts):
            best, score = model.predict(part.column("text"))
            names = np.array([*model.langs, UNKNOWN], object)[best]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (all columns) with an identified language; without
    any training row there is nothing to judge by, and all rows stay."""
    if not model.langs:
        return docs

    def run(parts):
        for part in small_batches(parts):
            best, score = model.predict(part.column("text"))
            yield part.filter(pa.array((best >= 0) & (score >= min_score)))

    return spread(docs).mapInArrow(run, docs.schema)
