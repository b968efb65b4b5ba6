"""Language identification as mixture inference.

A language's model is its byte 4-gram frequencies, counted over a bounded sample of labelled
documents. A text is cut into segments of 128 bytes; each has a log likelihood per language.
Expectation-maximisation estimates the proportions in which languages make up the text. The set
of languages grows from the best single one, by the language that raises the likelihood most,
as long as the gain exceeds a penalty (half the logarithm of the number of segments, plus a
margin per added language). The prediction is the language with the largest proportion.

Defined cases: null text, and text without a letter, is `und` with score 0; without labelled
rows everything is `und`; ties go to the language first in code-point order; a null id is not
held out; repeated rows get equal predictions; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retain.llm.words import LOWER, runs, text_bytes

UNKNOWN = "und"
GRAM = 4
BUCKETS = 1 << 16
SEGMENT = 128
PER_LANGUAGE = 4000  # labelled documents that a language's model is counted on, at most about
DRAWS = 1 << 40  # a document's draw lies below this, finer than any share of a corpus
ROUNDS = 25
MARGIN = 12.0  # log likelihood that another language must add besides the penalty

RESULT = "lang string, score double, langs array<string>, shares array<double>"

# Letters and bytes beyond ASCII keep their value, everything else reads as a space.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[65:91] = LOWER[65:91]
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def grams(data: np.ndarray) -> np.ndarray:
    """The bucket of the 4-gram that starts at each byte; the last ones reach into padding."""
    folded = np.concatenate([_FOLD[data], np.full(GRAM - 1, 0x20, np.uint8)]).astype(np.uint32)
    n = len(data)
    value = folded[:n] | folded[1 : n + 1] << 8 | folded[2 : n + 2] << 16 | folded[3 : n + 3] << 24
    bucket = (value * np.uint32(2654435761)) >> np.uint32(16)
    bucket[value == 0x20202020] = BUCKETS  # says nothing about the language
    return bucket


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (BUCKETS + 1, languages): log likelihood, the last row 0
    prior: np.ndarray

    @classmethod
    def from_counts(cls, langs: list[str], counts: np.ndarray, docs: np.ndarray) -> Model:
        """Add-half smoothing over the buckets seen in any language."""
        seen = counts.sum(1) > 0
        smooth = counts + 0.5
        table = np.log(smooth / smooth[seen].sum(0)) if seen.any() else np.zeros_like(smooth)
        table[~seen] = 0
        table -= table.mean(1, keepdims=True)  # only differences between languages matter
        table = np.vstack([table, np.zeros(len(langs))]).astype(np.float32)
        return cls(langs, table, np.log((docs + 1) / (docs + 1).sum()))

    def segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihoods per segment, and the first segment of each text (empty texts have none)."""
        n = -(-np.diff(offsets) // SEGMENT)
        first = np.concatenate([[0], np.cumsum(n)])
        nth = np.arange(first[-1]) - np.repeat(first[:-1], n)
        begin = np.repeat(offsets[:-1], n) + nth * SEGMENT
        if not len(begin):
            return np.zeros((0, len(self.langs))), first
        bucket = grams(data)
        return np.stack(
            [np.add.reduceat(self.table[:, k][bucket], begin, dtype=np.float64) for k in range(len(self.langs))], 1
        ), first

    def shares(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The proportions of each text, one column per language."""
        return self.infer(*self.segments(data, offsets)) if self.langs else np.zeros((len(offsets) - 1, 0))

    def infer(self, like: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The proportions (texts x languages); zero outside the chosen set and for empty texts."""
        n_docs, k = len(first) - 1, len(self.langs)
        shares = np.zeros((n_docs, k))
        docs = np.flatnonzero(np.diff(first) > 0)
        if not len(docs):
            return shares
        single = np.add.reduceat(like, first[docs], 0) + self.prior
        chosen = np.zeros((len(docs), k), bool)
        best = single.argmax(1)
        chosen[np.arange(len(docs)), best] = True
        shares[docs, best] = 1
        score = single.max(1) - self.prior[best]
        price = 0.5 * np.log(np.diff(first)[docs]) + MARGIN
        ceiling = np.add.reduceat(like.max(1), first[docs])
        open_ = np.flatnonzero(ceiling - score > price)  # no set can gain more than the ceiling
        while len(open_):
            rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs[open_]])
            size = np.diff(first)[docs[open_]]
            at = np.concatenate([[0], np.cumsum(size)])[:-1]
            gain = np.full(len(open_), -np.inf)
            pick = np.zeros(len(open_), np.int64)
            found = np.zeros((len(open_), k))
            for extra in range(k):
                allowed = chosen[open_].copy()
                allowed[:, extra] = True
                share, total = self.maximise(like[rows], at, size, allowed)
                better = ~chosen[open_, extra] & (total - score[open_] > gain)
                gain[better], pick[better], found[better] = (total - score[open_])[better], extra, share[better]
            grown = gain > price[open_]
            who = open_[grown]
            chosen[who, pick[grown]] = True
            score[who] += gain[grown]
            shares[docs[who]] = found[grown]
            open_ = who[~chosen[who].all(1)]
        return shares

    @staticmethod
    def maximise(like: np.ndarray, at: np.ndarray, size: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM over the allowed languages: proportions and log likelihood of each text."""
        share = allowed / allowed.sum(1, keepdims=True)
        top = like.max(1, keepdims=True)
        scaled = np.exp(like - top)
        for _ in range(ROUNDS):
            part = scaled * np.repeat(share, size, 0) + 1e-300
            part /= part.sum(1, keepdims=True)
            share = np.add.reduceat(part, at, 0) / size[:, None] * allowed
            share /= share.sum(1, keepdims=True)
        fit = np.log((scaled * np.repeat(share, size, 0)).sum(1) + 1e-300) + top[:, 0]
        return share, np.add.reduceat(fit, at)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    remainder = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
    return F.coalesce(remainder == fold, F.lit(False))


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model of `labelled` (doc_id, text, lang).

    At most about `per_language` documents of each language are counted, drawn by a hash of
    their id and text; what reaches the driver is one number per language and bucket.
    """
    rows = labelled.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(DRAWS))
    quota = rows.sparkSession.createDataFrame(
        [(lang, math.ceil(DRAWS * min(1.0, per_language / n))) for lang, n in sizes.items()], "lang string, quota long"
    )
    sample = rows.join(F.broadcast(quota), "lang").filter(draw < F.col("quota")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, offsets = text_bytes(batch.column(1))
            for i, lang in enumerate(names):
                bucket = grams(data[offsets[i] : offsets[i + 1]])
                totals[lang] = totals.get(lang, 0) + np.bincount(bucket, minlength=BUCKETS + 1)
        for lang, total in totals.items():
            at = np.flatnonzero(total[:BUCKETS])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                ["lang", "bucket", "n"],
            )

    per_task = sample.mapInArrow(count, "lang string, bucket int, n long")
    counts = np.zeros((BUCKETS, len(langs)))
    position = {lang: i for i, lang in enumerate(langs)}
    found = per_task.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    column = np.array([position[x] for x in found.column("lang").to_pylist()], np.int64)
    counts[found.column("bucket").to_numpy(), column] = found.column("n").to_numpy()
    return Model.from_counts(langs, counts, np.array([sizes[x] for x in langs], float))


def identify(model: Model, text: Column) -> Column:
    """A struct of language, its proportion, and the languages and proportions of the mixture."""
    shared = _broadcast(model)

    @F.arrow_udf(RESULT)
    def infer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            data, offsets = text_bytes(texts)
            langs, scores, sets, parts = [], [], [], []
            for a, b in runs(offsets):
                for share in m.shares(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]):
                    order = [int(i) for i in np.argsort(-share, kind="stable") if share[i] > 0]
                    langs.append(m.langs[order[0]] if order else UNKNOWN)
                    scores.append(float(share[order[0]]) if order else 0.0)
                    sets.append([m.langs[i] for i in order])
                    parts.append([float(share[i]) for i in order])
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(sets, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float64()))],
                ["lang", "score", "langs", "shares"],
            )

    found = infer(text)
    nothing = F.from_json(F.lit(f'{{"lang":"{UNKNOWN}","score":0,"langs":[],"shares":[]}}'), RESULT)
    return F.when(has_letter(text), found).otherwise(nothing)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _broadcast(model: Model):
    from pyspark.sql import SparkSession

    return SparkSession.active().sparkContext.broadcast(model)


def predict(docs: DataFrame) -> DataFrame:
    """The contract's row per document: a model of the rows not held out, applied to all."""
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), identify(model, F.col("text")).alias("p"))
    return found.select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
        F.col("p.langs").alias("langs"), F.col("p.shares").alias("shares"),
    )


def accept(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose text has a letter, columns unchanged.

    Inference finds some language in every such text (one that is labelled `und` too), so it
    rejects none of them; without labelled rows there is nothing to infer from and all stay.
    """
    model = train(docs)
    if not model.langs:
        return docs.filter(has_letter(F.col("text")))
    return docs.filter(F.size(identify(model, F.col("text")).getField("langs")) > 0)
