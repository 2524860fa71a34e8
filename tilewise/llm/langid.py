"""Language identification with interpolated Kneser-Ney character models.

Every language has a model of the characters of its words, each word between two boundary marks and with contexts of up
to ``ORDER - 1`` characters within the word. A model is a sorted array of 64-bit n-gram hashes with their discounted
probabilities for each order, and one of contexts with their interpolation weights; a text is scored by binary search in
those arrays. The language with the lowest cross-entropy per character is chosen.

Models are fitted on a bounded sample of labelled rows: at most ``SAMPLE_DOCS`` keys a language, those with the lowest hash
of their key, ``SAMPLE_BYTES`` of text a language (its first row always) and ``SAMPLE_TOTAL`` rows altogether, shared out
evenly; the labels learned are the ``MAX_LANGUAGES`` with the most rows. A fifth of the sample is kept apart; its
cross-entropies set, for each language, the level above which a text is rejected as being in none of the learned languages.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and is rejected; without labelled rows every
text is ``und`` and rejected; of equally good languages the first by name is chosen; repeated rows, and rows with equal or
null keys, are predicted alike and each by itself; rows without a key are not learned from, and of rows that share key and
label the first text is; labels beyond the bound are not learned; other columns and their names do not matter; an empty
table gives an empty result; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, own_worker, text_or_empty

ORDER = 4
DISCOUNT = 0.75
SAMPLE_DOCS = 500
SAMPLE_TOTAL = 20_000
SAMPLE_BYTES = 32 << 20
CALIBRATION_SHARE = 5
#: Candidates for a sample of n: those whose uniform place is among the first NEAR * n + NEAR_LEAST expected.
NEAR, NEAR_LEAST = 2, 200
MAX_LANGUAGES = 1000
#: Rejection: over the mean cross-entropy of held-back documents by this many standard deviations, and by this share of
#: the way to a uniform guess over the known characters; never below the largest held-back one. Short texts get a
#: further allowance in nats over their number of characters.
REJECT_SIGMAS = 6.0
REJECT_TOWARDS_UNIFORM = 2 / 3
SHORT_ALLOWANCE = 20.0
#: Characters that count as independent evidence when cross-entropies become a probability.
EVIDENCE = 20.0
UNKNOWN = "und"
#: Text scored at a time: the working arrays take some fifty times this.
SCORED_BYTES = 2 << 20
#: Languages scored together.
SCORED_LANGUAGES = 32

_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
_BOUNDARY = 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _LETTERS(text.lower())


def _grams(words: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of the words between boundary marks: n-gram hashes by order, at each end position; longest order; word numbers."""
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    n = len(points)
    mark = points == _BOUNDARY
    at = np.where(mark, np.arange(n), 0)
    begin = np.concatenate([[0], np.maximum.accumulate(at)[:-1]])  # the last mark before each position
    longest = np.minimum(ORDER, np.arange(n) - begin + 1)
    hashes = [points]
    for k in range(2, ORDER + 1):
        h = np.zeros(n, dtype=np.uint64)
        h[1:] = (hashes[-1][:-1] * _MIX) ^ (hashes[-1][:-1] >> np.uint64(29))
        h += points
        hashes.append(h * np.uint64(0xD6E8FEB86659FD93) if k == 2 else h)
    word = np.cumsum(mark) - 1
    word[mark] -= 1  # a closing mark belongs to the word before it
    return hashes, longest, word


def _lookup(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in the sorted table, -1 where absent."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


@dataclass
class Model:
    """Arrays by language, then by order."""

    langs: list[str]
    grams: list[list[np.ndarray]]  # sorted n-gram hashes
    probs: list[list[np.ndarray]]  # probability of each n-gram's last character
    contexts: list[list[np.ndarray]]  # sorted hashes of contexts
    weights: list[list[np.ndarray]]  # interpolation weight of each context
    floor: float  # probability of a character never seen
    limits: np.ndarray | None = None

    def _prob(self, j: int, k: int, hashes: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """In language j, of the characters at these places after the k - 1 before them."""
        if k == 0:
            return np.full(len(at), self.floor)
        found = _lookup(self.grams[j][k - 1], hashes[k - 1][at])
        out = self.probs[j][k - 1][np.maximum(found, 0)]
        lack = np.flatnonzero(found < 0)
        if len(lack):
            rest = at[lack]
            lower = self._prob(j, k - 1, hashes, rest)
            if k == 1:
                lower = lower * self.weights[j][0][0]  # the empty context
            else:
                ctx = _lookup(self.contexts[j][k - 1], hashes[k - 2][rest - 1])
                lower = lower * np.where(ctx >= 0, self.weights[j][k - 1][np.maximum(ctx, 0)], 1.0)
            out[lack] = lower
        return out

    def word_scores(self, words: list[str], langs: range) -> np.ndarray:
        """Per word: nats by language, then the number of characters (with the closing mark)."""
        hashes, longest, word = _grams(words)
        out = np.zeros((len(words), len(langs) + 1))
        for k in range(2, ORDER + 1):
            at = np.flatnonzero(longest == k)
            at = at[at > 0]
            if len(at):
                _, first, back = np.unique(hashes[k - 1][at], return_index=True, return_inverse=True)
                for i, j in enumerate(langs):
                    nats = -np.log(self._prob(j, k, hashes, at[first]))
                    out[:, i] += np.bincount(word[at], weights=nats[back], minlength=len(words))
                out[:, -1] += np.bincount(word[at], minlength=len(words))
        return out

    def text_scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character by language, and characters, of each text."""
        cut = [words_of(t) for t in texts]
        number: dict[str, int] = {}
        flat = np.fromiter((number.setdefault(w, len(number)) for ws in cut for w in ws), dtype=np.int64, count=sum(map(len, cut)))
        sums, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        if len(flat):
            sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
            full = np.flatnonzero(sizes)
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            for lo in range(0, max(1, len(self.langs)), SCORED_LANGUAGES):
                some = range(lo, min(lo + SCORED_LANGUAGES, len(self.langs)))
                found = np.add.reduceat(self.word_scores(list(number), some)[flat], starts, axis=0)
                sums[full, lo : some.stop], n[full] = found[:, :-1], found[:, -1]
        return sums / np.maximum(n, 1)[:, None], n


def _counts(words: list[str], times: np.ndarray) -> list[dict[str, np.ndarray]]:
    """By order: n-gram hashes with Kneser-Ney counts, and the hashes of their contexts and suffixes.

    The longest order and n-grams at a word's start have their occurrences as counts, others the number of different
    characters before them.
    """
    hashes, longest, word = _grams(words)
    out: list[dict[str, np.ndarray]] = []
    above: tuple[np.ndarray, np.ndarray] | None = None  # positions of the different n-grams of the order above
    for k in range(ORDER, 0, -1):
        at = np.flatnonzero(longest >= k)
        at = at[at > 0]
        whole = k == ORDER
        counted = at if whole else at[longest[at] == k] if k > 1 else at[:0]
        keys, weight = [hashes[k - 1][counted]], [times[word[counted]].astype(float)]
        if above is not None:
            keys.append(hashes[k - 1][above[0]])
            weight.append(np.ones(len(above[0])))
        key = np.concatenate(keys)
        where = np.concatenate([counted, above[0]]) if above is not None else counted
        gram, first, back = np.unique(key, return_index=True, return_inverse=True)
        pos = where[first]
        out.append({
            "gram": gram,
            "count": np.bincount(back, weights=np.concatenate(weight), minlength=len(gram)),
            "context": hashes[k - 2][pos - 1] if k > 1 else np.zeros(len(gram), dtype=np.uint64),
            "suffix": hashes[k - 2][pos] if k > 1 else np.zeros(len(gram), dtype=np.uint64),
        })
        above = (pos, gram)
    return out[::-1]


def train(words: dict[str, dict[str, int]]) -> Model:
    """Fit the models of all languages from their word counts."""
    langs = sorted(words)
    chars = {c for x in langs for w in words[x] for c in w}
    model = Model(langs, [], [], [], [], 1.0 / (len(chars) + 2))
    for x in langs:
        grams, probs, contexts, weights = [], [], [], []
        for k, c in enumerate(_counts(list(words[x]), np.array(list(words[x].values())))):
            ctx, back = np.unique(c["context"], return_inverse=True)
            total = np.bincount(back, weights=c["count"])
            weight = DISCOUNT * np.bincount(back) / total
            below = probs[-1][_lookup(grams[-1], c["suffix"])] if k else model.floor  # a seen n-gram's suffix was seen
            probs.append(np.maximum(c["count"] - DISCOUNT, 0) / total[back] + weight[back] * below)
            grams.append(c["gram"])
            contexts.append(ctx)
            weights.append(weight)
        model.grams.append(grams)
        model.probs.append(probs)
        model.contexts.append(contexts)
        model.weights.append(weights)
    return model


def may_learn(key: str = "doc_id") -> Column:
    """Rows that a model may learn from: crc32 of the key as text, modulo 4, is not 2."""
    return F.crc32(F.col(key).cast("string")) % 4 != 2


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own_worker("language models")
    for batch in chunks(batches, "text"):
        found: dict[tuple[str, str], int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for w in words_of(text):
                found[lang, w] = found.get((lang, w), 0) + 1
        yield pa.record_batch([pa.array([x for x, _ in found], pa.string()), pa.array([w for _, w in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_worker("language models")
        m: Model = model.value
        for batch in chunks(batches, "text", SCORED_BYTES):
            entropy, n = m.text_scores(batch.column(1).to_pylist())
            if not m.langs:
                best, low = [UNKNOWN] * len(n), np.zeros(len(n))
                score, reject = np.zeros(len(n)), n >= 0
            else:
                pick = entropy.argmin(axis=1)
                low = entropy[np.arange(len(n)), pick]
                score = np.where(n > 0, 1 / np.exp(-EVIDENCE * (entropy - low[:, None])).sum(axis=1), 0.0)
                best = [m.langs[i] if c else UNKNOWN for i, c in zip(pick, n, strict=True)]
                limit = m.limits[pick] if m.limits is not None else np.inf
                reject = (n == 0) | (low > limit + SHORT_ALLOWANCE / np.maximum(n, 1))
            yield pa.record_batch([batch.column(0), pa.array(best, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(low), pa.array(reject)], names=["key", "lang_pred", "score", "cross_entropy", "rejected"])

    return run


def _scored(rows: DataFrame, model: Model, key_type: str) -> DataFrame:
    """rows: key, text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by the sample, not by the table
    return rows.mapInArrow(_scorer(shared), f"key {key_type}, lang_pred string, score double, cross_entropy double, rejected boolean")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE_DOCS, total: int = SAMPLE_TOTAL, languages: int = MAX_LANGUAGES) -> Model:
    """Models and rejection levels from at most ``sample`` labelled rows a language and ``total`` of all."""
    spark = docs.sparkSession
    bounded_batches(spark)
    place = F.pmod(F.xxhash64("k"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    labelled = docs.where(may_learn(key) & F.col(lang).isNotNull()).select(F.col(key).alias("k"), F.col(lang).cast("string").alias("l")).withColumn("place", place)
    sizes = labelled.groupBy("l").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "l").limit(languages).collect()
    each = min(sample, max(CALIBRATION_SHARE, total // max(1, len(sizes))))
    # The lowest places lie, but for odds beyond counting, in a few times their share of the rows; the rest is not sorted.
    below = F.create_map(*[x for r in sizes for x in (F.lit(r.l), F.lit((each * NEAR + NEAR_LEAST) / r.size))]) if sizes else F.create_map().cast("map<string,double>")
    near = labelled.where(F.col("place") < F.element_at(below, F.col("l"))).distinct()
    low = Window.partitionBy("l").orderBy("place", "k")
    chosen = near.withColumn("nth", F.row_number().over(low)).where(F.col("nth") <= each).select("k", "l", "nth")
    rows = docs.where(may_learn(key) & F.col(lang).isNotNull()).select(F.col(key).alias("k"), F.col(lang).cast("string").alias("l"), text_or_empty(text).alias("text"))
    rows = rows.join(F.broadcast(chosen), ["k", "l"]).groupBy("l", "nth").agg(F.min("text").alias("text"))
    size = F.sum(F.octet_length("text")).over(Window.partitionBy("l").orderBy("nth"))
    rows = rows.withColumn("size", size).where((F.col("size") <= SAMPLE_BYTES) | (F.col("nth") == 1)).withColumn("calibrate", F.col("nth") % CALIBRATION_SHARE == 0)
    rows = rows.repartition(8)
    counts = rows.where("not calibrate").select("l", "text").mapInArrow(_word_rows, "lang string, word string, n long")
    words: dict[str, dict[str, int]] = {}
    for r in counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word").toLocalIterator():
        words.setdefault(r.lang, {})[r.word] = r.n
    model = train(words)
    if words:
        held = _scored(rows.where("calibrate").select(F.col("l").alias("key"), "text"), model, "string")
        held = held.where("key = lang_pred").groupBy("key").agg(F.avg("cross_entropy").alias("mean"), F.stddev_pop("cross_entropy").alias("sd"), F.max("cross_entropy").alias("high"))
        uniform = float(-np.log(model.floor))
        level = {r.key: max(r.high, r.mean + REJECT_SIGMAS * r.sd, r.mean + REJECT_TOWARDS_UNIFORM * (uniform - r.mean)) for r in held.collect()}
        model.limits = np.array([level.get(x, np.inf) for x in model.langs])
    return model


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score, cross_entropy, rejected of every row, from its text alone."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    return _scored(rows, model, docs.schema[key].dataType.simpleString()).withColumnRenamed("key", key)


def keep_known(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the rows that the model rejects; columns and names unchanged."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(shared)
        for batch in chunks(batches, plain[at], SCORED_BYTES):
            texts = pa.array([t or "" for t in batch.column(at).to_pylist()], pa.string())
            keys = pa.array(np.arange(batch.num_rows))
            drop = np.concatenate([x.column(4).to_numpy(zero_copy_only=False) for x in score(iter([pa.record_batch([keys, texts], names=["key", "text"])]))])
            yield batch.filter(pa.array(~drop))

    return docs.toDF(*plain).mapInArrow(run, docs.toDF(*plain).schema).toDF(*docs.columns)
