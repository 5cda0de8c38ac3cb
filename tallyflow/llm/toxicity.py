"""Toxicity by class-conditional Kneser-Ney models of character n-grams.

Folded texts are symbols of six bits (letters, blank, other letters hashed), so an
n-gram is one integer, its context and suffix are shifts of it. Per class the top
order has discounted counts; every lower order is *shared*: continuation counts
over the n-grams of both classes. A rare or unseen expression therefore has almost
the same probability in both models, and only what differs between the classes
moves a score:

    P_c(s | h) = max(n_c(hs) - D, 0) / n_c(h) + D * kinds_c(h) / n_c(h) * P_shared(s | h')

An n-gram that neither class has seen leaves log of the two back-off weights, which
needs the context alone; so scoring looks up one table of seen n-grams and one of
contexts. Both are exact, by full key: no two n-grams share a value and an unseen one
is never taken for a seen one. The broadcast model therefore grows with the number of
distinct n-grams and contexts counted (about 16 to 28 bytes each).

A document's length-normalised difference of the two log-likelihoods is taken over
the whole text, and over each word, of which the largest count most: a few toxic
words must show in a long text. A logistic model turns these into a score; it is
fitted on at most ``FIT_ROWS`` labelled documents, of a fold that the n-gram counts
leave out. Folds are crc32(doc_id as text) mod 4: 0 and 1 give the counts, 3 the
fit, and 2 is never learned from.

Defined results: null and empty texts have no n-grams and get the score of a text
without evidence; labels other than 0 and 1, and null labels, are not learned from; several
labels of one document all count; without labels of both classes every score is
0.5 (predicted 1 by the threshold). Long texts are scored whole, in pieces of
bounded size. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm.common import arrow_map, fold, text_chunks, written

ORDER = 6
BITS = 6  # of a symbol
DISCOUNT = 0.75
FIT_ROWS = 20_000
THRESHOLD = 0.3
CHUNK_BYTES = 2_000_000
COUNT_FOLDS, FIT_FOLD = (0, 1), 3
#: a word's evidence is spread over at least so many symbols
WORD_FLOOR = 6


def _symbols() -> np.ndarray:
    """Code of every 16-bit unit: blank 0, a-z 1 to 26, other letters hashed to the rest."""
    codes = np.zeros(1 << 16, np.int64)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            codes[c] = c - 96 if 97 <= c <= 122 else 27 + (c * 40503 >> 4) % 37
    codes[0xD800:0xE000] = 63
    return codes


def symbols_of(texts: list[str | None], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one run of symbols with single blanks, each with ORDER - 1
    leading blanks and one at its end; and the number of symbols of each."""
    parts = []
    for text in texts:
        x = codes[np.frombuffer((text or "").lower().encode("utf-16-le", "replace"), np.uint16)]
        x = x[(x != 0) | np.concatenate(([False], x[:-1] != 0))] if len(x) else x
        parts.append(np.concatenate((np.zeros(ORDER - 1, np.int64), x, np.zeros(1 if len(x) and x[-1] else 0, np.int64))))
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), np.array([len(p) for p in parts], np.int64)


def grams_of(symbols: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each symbol from the order-th on."""
    grams = np.zeros(max(0, len(symbols) - order + 1), np.int64)
    for j in range(order):
        grams = (grams << BITS) | symbols[j : j + len(grams)]
    return grams


def bucket(x: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Keyed:
    """Values by integer key, exact: keys lie by bucket, and a bucket is searched key by key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(1, len(keys).bit_length())
        at = bucket(keys, self.bits)
        order = np.argsort(at, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.starts = np.searchsorted(at[order], np.arange((1 << self.bits) + 1))

    def find(self, keys: np.ndarray, missing: float) -> np.ndarray:
        at = bucket(keys, self.bits)
        place, stop = self.starts[at], self.starts[at + 1]
        out = np.full(len(keys), missing, np.float32)
        rows = np.flatnonzero(place < stop)
        while len(rows):
            hit = self.keys[place[rows]] == keys[rows]
            out[rows[hit]] = self.values[place[rows[hit]]]
            rows = rows[~hit]
            place[rows] += 1
            rows = rows[place[rows] < stop[rows]]
        return out


def features(texts: list[str | None], codes: np.ndarray, gram_llr: Keyed, context_llr: Keyed) -> np.ndarray:
    """Per text: mean over its symbols, largest word, means of the 3 largest words
    and of the largest fiftieth, and the logarithm of its number of words."""
    out = np.zeros((len(texts), 5))
    symbols, sizes = symbols_of(texts, codes)
    ends = np.cumsum(sizes)
    for i, (start, end) in enumerate(zip(ends - sizes, ends)):
        s = symbols[start:end]
        grams = grams_of(s)
        if not len(grams):
            continue
        llr = gram_llr.find(grams, np.nan)
        unseen = np.isnan(llr)
        llr[unseen] = context_llr.find(grams[unseen] >> BITS, 0.0)
        last = s[ORDER - 1 :]
        stops = np.flatnonzero(last == 0)  # a word's n-grams end with its blank
        if not len(stops) or stops[-1] != len(last) - 1:
            stops = np.append(stops, len(last) - 1)
        total = np.add.reduceat(llr, np.concatenate(([0], stops[:-1] + 1)))
        length = np.diff(np.concatenate(([-1], stops)))
        words = np.sort(total / np.maximum(length, WORD_FLOOR))[::-1]
        out[i] = llr.mean(), words[0], words[:3].mean(), words[: max(1, len(words) // 50)].mean(), np.log(len(words))
    return out


def count_grams(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(gram, n0, n1): counts of the top order in ordinary and toxic texts."""
    labels = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__toxic")).where("__toxic in (0, 1)")
    rows = docs.select("doc_id", "text").where(fold("doc_id").isin(*COUNT_FOLDS))
    # sorted and merged at every size: labels may grow with the documents
    rows = rows.join(labels.hint("merge"), F.col("doc_id") == F.col("__id"))

    def run(batches):
        codes = _symbols()
        for batch in text_chunks(batches, CHUNK_BYTES):
            toxic = np.array(batch.column("__toxic").to_pylist())
            texts = batch.column("text").to_pylist()
            for label in (0, 1):
                chosen = [t for t, x in zip(texts, toxic) if x == label and t]
                symbols, sizes = symbols_of(chosen, codes)
                grams = grams_of(symbols)
                inside = np.ones(len(grams), bool)  # not across two texts
                for end in np.cumsum(sizes)[:-1]:
                    inside[max(0, end - ORDER + 1) : end] = False
                values, n = np.unique(grams[inside], return_counts=True)
                yield {"gram": values, "n0": n * (label == 0), "n1": n * (label == 1)}

    counted = arrow_map(rows.select("text", "__toxic"), run, "gram long, n0 long, n1 long")
    return counted.groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def shared_lower(grams: DataFrame) -> DataFrame:
    """(gram, lower): each top-order gram with the shared probability of its last
    symbol after its shortened context, by continuation counts of all lower orders."""
    mask = lambda k: (1 << (BITS * k)) - 1
    kinds = grams.select("gram")
    tables = []
    for k in range(ORDER - 1, 0, -1):  # continuation count: distinct longer grams with this suffix
        kinds = kinds.groupBy(F.col("gram").bitwiseAND(F.lit(mask(k))).alias("gram")).agg(F.count("*").alias("n"))
        tables.append((k, kinds))
    low = None
    for k, table in reversed(tables):
        if k == 1:
            total, kinds_seen = table.agg(F.sum("n"), F.count("*")).first()  # over at most 64 symbols
            total = total or 1
            even = DISCOUNT * kinds_seen / total / (1 << BITS)
            low = table.select("gram", (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / total + even).alias("p"))
            continue
        context = table.groupBy(F.shiftright("gram", BITS).alias("h")).agg(F.sum("n").alias("t"), F.count("*").alias("m"))
        parts = table.withColumn("h", F.shiftright("gram", BITS)).join(context, "h")
        parts = parts.withColumn("suffix", F.col("gram").bitwiseAND(F.lit(mask(k - 1))))
        low = parts.join(low.select(F.col("gram").alias("suffix"), "p"), "suffix").select(
            "gram", (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("t") + DISCOUNT * F.col("m") / F.col("t") * F.col("p")).alias("p")
        )
    return low


class Model:
    """Exact tables of n-grams and contexts, and logistic weights."""

    def __init__(self, gram_llr, context_llr, weights=None, mean=None, scale=None):
        self.gram_llr, self.context_llr = gram_llr, context_llr
        self.weights, self.mean, self.scale = weights, mean, scale

    def features(self, texts, codes):
        return features(texts, codes, self.gram_llr, self.context_llr)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        z = np.column_stack((np.ones(len(x)), (x - self.mean) / self.scale)) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def language_models(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    grams = written(spark, count_grams(docs, labels), "toxic_grams")
    shift = lambda c: F.shiftright(c, BITS)
    context = grams.groupBy(shift("gram").alias("h")).agg(
        F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), F.count_if(F.col("n0") > 0).alias("m0"), F.count_if(F.col("n1") > 0).alias("m1")
    )
    weight = lambda m, t: F.when(F.col(t) > 0, DISCOUNT * F.col(m) / F.col(t)).otherwise(1.0)
    context = written(spark, context.select("*", weight("m0", "t0").alias("w0"), weight("m1", "t1").alias("w1")), "toxic_contexts")
    suffix = (1 << (BITS * (ORDER - 1))) - 1
    low = shared_lower(grams).select(F.col("gram").alias("suffix"), "p")
    joined = grams.withColumn("h", shift("gram")).join(context, "h").withColumn("suffix", F.col("gram").bitwiseAND(F.lit(suffix))).join(low, "suffix")
    p = lambda n, t, w: F.when(F.col(t) > 0, F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) / F.col(t)).otherwise(0.0) + F.col(w) * F.col("p")
    seen = joined.select("gram", F.log(p("n1", "t1", "w1") / p("n0", "t0", "w0")).alias("llr"))
    back = context.select("h", F.log(F.col("w1") / F.col("w0")).alias("llr"))

    def keyed(rows: DataFrame, key: str) -> Keyed:
        found = rows.select(key, F.col("llr").cast("float").alias("llr")).toArrow()  # all that was counted: distinct n-grams, not symbols
        return Keyed(found.column(key).to_numpy(), found.column("llr").to_numpy())

    return Model(keyed(seen, "gram"), keyed(back, "h"))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights (intercept first) by Newton steps."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    spark = docs.sparkSession
    model = language_models(spark, docs, labels)
    rows = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").where(fold("__id") == FIT_FOLD)
    rows = rows.orderBy(F.xxhash64("__id"), "toxic").limit(fit_rows)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        codes = _symbols()
        for batch in text_chunks(batches, CHUNK_BYTES):
            yield {"x": list(shared.value.features(batch.column("text").to_pylist(), codes)), "toxic": batch.column("toxic")}

    # fit_rows rows at most
    sample = docs.select("doc_id", "text").join(F.broadcast(rows), F.col("doc_id") == F.col("__id"))
    found = arrow_map(sample.select("text", "toxic"), run, "x array<double>, toxic int").toPandas()  # fit_rows rows at most
    if found["toxic"].nunique() == 2:
        x = np.array(found["x"].tolist())
        model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        model.weights = logistic((x - model.mean) / model.scale, found["toxic"].to_numpy(float))
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, and llr (the whole text's length-normalised difference)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        codes = _symbols()
        for batch in text_chunks(batches, CHUNK_BYTES):
            x = shared.value.features(batch.column("text").to_pylist(), codes)
            p = shared.value.score(x)
            yield {"doc_id": batch.column("doc_id"), "score": p, "predicted": (p >= threshold).astype(np.int32), "llr": x[:, 0]}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, score double, predicted int, llr double")
