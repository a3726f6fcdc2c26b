"""Quality classifier by co-training of a text view and a metadata view.

Views. The text view sees hashed words (as written, with their signs) and whether a word repeats
the one before; the metadata view sees the document's language, source and layout: length, line
length, share of capitals, digits, signs and distinct words, each in a fixed number of bins. Both
are naive Bayes models of good against junk. All are sums of feature counts per class, so training is one
pass that adds up partial sums per task, over any number of rows, and a model is an array of fixed size.

Toxic texts. A third model tells good from toxic. It sums the words that clearly speak for toxic (twelve
times as frequent there) less what a good text of that many words has by chance, as a few words make a
text toxic; so its words are hashed to a table of its own, over a million wide, where marker words seldom
share a place with ordinary ones. It learns from labelled rows alone, as neither view's pseudo-labels
tell toxic from good.

Rounds. Both views start from the labelled documents (toxic: ``toxic`` is 1; of the others good:
``quality`` is 1, else junk) of the training folds; toxic ones train that second model alone. In each round every view scores all documents that have no label; documents
that it puts beyond ``confident`` become pseudo-labelled rows, with weight ``pseudo_weight``, for the
OTHER view, which is then trained anew. All documents take part, none is sampled.

Calibration. One fold of the labelled documents, seen by no model, gives for each view the share of
good documents among good and junk ones by score bin, made monotone. The two calibrated views are combined as odds over the
prior, and every document gets p_quality: the lower of that and of the share of good documents among good and toxic ones by
toxic score, which has bins of its own. It is kept if that reaches ``threshold``.

Features are computed once and kept in the shared folder (about half a kilobyte per document).
Only arrays of fixed size reach the driver or are sent to tasks.

Labels are grouped by id first (several labels of a document: lowest quality, highest toxicity
count); labels with nulls are ignored. Without any label, or with labels of one class only, every
document gets the prior (1 without labels), and is kept if that reaches the threshold. Null or empty
texts are scored by their metadata and an empty bag; null ids have no label; repeated rows get
equal scores; an empty table gives no rows; extra columns are ignored by :func:`score_documents`
and kept by :func:`keep_good`. Texts of any length are read whole and count as bags, so a task holds
one text's words.
"""

from __future__ import annotations

import itertools
import math
import operator
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.shared import broadcast_if_small, durable, free_scratch, in_python, text_or_empty

JUNK, GOOD, TOXIC = 0, 1, 2
CLASSES = (JUNK, GOOD, TOXIC)
TEXT_BUCKETS = 1 << 15
#: A word's place in the toxic model's table; its text bucket is the remainder by TEXT_BUCKETS - 1.
WIDE = 32 * (TEXT_BUCKETS - 1)
STEP = 0xFFFF
META_SLOTS, META_BINS = 10, 64
FOLDS, HELD_OUT = 5, 4
CALIBRATION_BINS = 40
TOXIC_EDGES = np.linspace(-40, 20, 119)


def text_features(words: list[str], distinct: set[str], known: dict[str, int]) -> np.ndarray:
    """Distinct places of the words of a text, and WIDE if a word often repeats the last one, ascending."""
    for w in distinct.difference(known):
        known[w] = zlib.crc32(w.encode()) % WIDE
    own = np.unique(np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct)))
    if len(words) > 1 and sum(map(operator.eq, words, itertools.islice(words, 1, None))) > 0.2 * (len(words) - 1):
        own = np.append(own, WIDE)
    return own


def packed(places: np.ndarray) -> bytes:
    """Ascending places as 16-bit steps; a STEP goes on in the next."""
    whole, rest = np.divmod(np.diff(places, prepend=0), STEP)
    out = np.full(int(whole.sum()) + len(places), STEP, np.uint16)
    out[np.cumsum(whole + 1) - 1] = rest
    return out.tobytes()


def unpacked(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places of many texts laid end to end, and their number for each text."""
    steps = np.frombuffer(b"".join(bags), np.uint16).astype(np.int64)
    lengths = np.array([len(b) // 2 for b in bags], np.int64)
    sums = np.concatenate(([0], np.cumsum(steps)))
    starts = np.cumsum(lengths) - lengths
    ends = steps != STEP
    owner = np.repeat(np.arange(len(bags)), lengths)[ends]
    return (sums[1:] - np.repeat(sums[starts], lengths))[ends], np.bincount(owner, minlength=len(bags))


def meta_features(text: str, words: list[str], distinct: set[str], lang: str, source: str) -> list[int]:
    """One bin for each of the metadata view's slots."""
    n, many = max(len(text), 1), max(1, len(words))
    signs = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=128)
    total = max(1, int(signs.sum()))
    share = lambda x, scale: min(META_BINS - 1, int(x * scale))
    between = lambda low, high: int(signs[low : high + 1].sum()) / total
    lines = text.count("\n") + 1
    return [
        zlib.crc32(lang.encode()) % META_BINS,
        zlib.crc32(source.encode()) % META_BINS,
        share(math.log2(n), 3),
        share(math.log2(n / lines), 3) if n >= lines else 0,
        share(math.log2(many), 3),
        share(between(33, 47) + between(58, 64) + between(91, 96) + between(123, 126), 60),
        share(between(65, 90), 60),
        share(between(48, 57), 100),
        share(len(distinct) / many, 60),
        share(n / many, 3),
    ]


def _key(text: str, lang: str, source: str) -> Column:
    """Rows that share it share all features and so the score."""
    return F.xxhash64(text_or_empty(text), text_or_empty(lang), text_or_empty(source))


def with_features(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, lang: str, source: str) -> DataFrame:
    """doc_id, key (of text, lang and source), bag, meta (binary), fold, good (one of CLASSES or null) of every document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"), text_or_empty(lang).alias("lang"), text_or_empty(source).alias("source"), _key(text, lang, source).alias("key"))
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            bags, metas = [], []
            for t, lg, s in zip(*(batch.column(k) for k in (1, 2, 3)), strict=True):
                if len(known) > 100_000:
                    known.clear()
                t = t.as_py()
                words = t.split()
                distinct = set(words)
                bags.append(packed(text_features(words, distinct, known)))
                metas.append(bytes(meta_features(t, words, distinct, lg.as_py(), s.as_py())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), pa.array(bags, pa.binary()), pa.array(metas, pa.binary())], names=["doc_id", "key", "bag", "meta"])

    featured = in_python(slim, run, f"doc_id {id_type}, key long, bag binary, meta binary")
    usable = labels.where("doc_id is not null and quality is not null")
    grouped = usable.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("x"))
    grouped = grouped.select(F.col("doc_id").alias("l_id"), F.when(F.col("x") == 1, TOXIC).when(F.col("q") == 1, GOOD).otherwise(JUNK).alias("good"))
    # one plan at every size: features are dealt out by id, never labels broadcast
    joined = featured.join(grouped.hint("merge"), F.col("doc_id") == F.col("l_id"), "left").drop("l_id")
    return joined.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int"))


@dataclass
class View:
    """Log odds per feature; scores are sums, or sums over the root of their number, plus the prior."""

    weights: np.ndarray
    prior: float
    mean: bool

    @classmethod
    def fit(cls, counts: np.ndarray, documents: np.ndarray, mean: bool, smooth: float = 1.0) -> View:
        """counts[junk or good, feature] of documents that hold the feature; documents per class."""
        shares = (counts + smooth) / (documents[:, None] + 2 * smooth)
        weights = np.log(shares[1]) - np.log(shares[0])
        return cls(weights, float(np.log((documents[1] + smooth) / (documents[0] + smooth))), mean)

    def score(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log odds of many documents whose features are laid end to end."""
        sums = _sums(self.weights[features], lengths)
        return (sums / np.sqrt(np.maximum(lengths, 1)) if self.mean else sums) + self.prior


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    edges = np.concatenate(([0], np.cumsum(lengths)))
    return np.diff(np.concatenate(([0.0], np.cumsum(values)))[edges])


@dataclass
class ToxicWords:
    """Log odds of the places that clearly speak for toxic, ascending; all others weigh nothing."""

    LEAST = 5

    places: np.ndarray
    weights: np.ndarray
    prior: float
    by_chance: float

    @classmethod
    def fit(cls, places: np.ndarray, counts: np.ndarray, documents: np.ndarray, good_features: float, least_z: float = 4.0, smooth: float = 1.0) -> ToxicWords:
        """counts[toxic or good, place] of documents for places that LEAST toxic ones hold; documents per class.

        Places weigh that toxic rows hold more often than good rows by ``least_z`` standard errors and twelve
        times as often; what good rows have of them for each of their features is taken off by chance.
        """
        both = (counts.sum(axis=0) + smooth) / (documents.sum() + 2 * smooth)
        shares = (counts + smooth * both) / (documents[:, None] + smooth)
        weights = np.log(shares[1]) - np.log(shares[0])
        error = np.sqrt(both * (1 - both) * (1 / (documents + smooth)).sum())
        clear = (shares[0] - shares[1] >= least_z * error) & (weights <= -np.log(12))
        by_chance = float(counts[1][clear] @ weights[clear] / max(good_features, 1))
        return cls(places[clear], weights[clear], float(np.log((documents[1] + smooth) / (documents[0] + smooth))), by_chance)

    def score(self, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if not len(self.places):
            return np.full(len(lengths), self.prior)
        at = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return _sums(np.where(self.places[at] == places, self.weights[at], 0.0), lengths) - self.by_chance * lengths + self.prior


@dataclass
class Batch:
    """Features of one Arrow batch."""

    wide: np.ndarray
    wide_lengths: np.ndarray
    bags: np.ndarray
    bag_lengths: np.ndarray
    metas: np.ndarray
    meta_lengths: np.ndarray
    good: np.ndarray = field(default_factory=lambda: np.zeros(0))
    fold: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Batch:
        named = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
        wide, lengths = unpacked(named["bag"].to_pylist())
        # two words of a text in one bucket count twice there: too rare to sort for
        bags = np.where(wide == WIDE, TEXT_BUCKETS - 1, wide % (TEXT_BUCKETS - 1))
        metas = np.frombuffer(b"".join(named["meta"].to_pylist()), np.uint8).astype(np.int64).reshape(-1, META_SLOTS)
        good = named["good"].fill_null(-1).to_numpy(zero_copy_only=False)
        fold = named["fold"].fill_null(0).to_numpy(zero_copy_only=False)
        return cls(wide, lengths, bags, lengths, (metas + META_BINS * np.arange(META_SLOTS)).ravel(), np.full(len(lengths), META_SLOTS), good, fold)


SIZES = {"text": TEXT_BUCKETS, "meta": META_SLOTS * META_BINS}


def _totals(featured: DataFrame, models: dict[str, View] | None, confident: float, weight: float) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Counts per view and class: labelled rows, and the other view's confident rows if given."""
    size = sum(SIZES.values()) + len(SIZES)  # per class: features and documents of each view

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(CLASSES), size))
        for raw in batches:
            b = Batch.of(raw)
            if not len(b.good):
                continue
            labelled = (b.good >= 0) & (b.fold != HELD_OUT)
            weights = {(v, c): (labelled & (b.good == c)).astype(float) for v in SIZES for c in CLASSES}
            if models is not None:
                free = b.good < 0
                for v, other in (("text", "meta"), ("meta", "text")):
                    p = 1 / (1 + np.exp(-np.clip(models[other].score(*((b.metas, b.meta_lengths) if other == "meta" else (b.bags, b.bag_lengths))), -50, 50)))
                    weights[v, GOOD] += weight * (free & (p >= confident))
                    weights[v, JUNK] += weight * (free & (p <= 1 - confident))
            at = 0
            for v, (features, lengths) in (("text", (b.bags, b.bag_lengths)), ("meta", (b.metas, b.meta_lengths))):
                for c in CLASSES:
                    sums[c, at : at + SIZES[v]] += np.bincount(features, np.repeat(weights[v, c], lengths), SIZES[v])
                    sums[c, at + SIZES[v]] += weights[v, c].sum()
                at += SIZES[v] + 1
        c, k = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(c * size + k), pa.array(sums[c, k])], names=["slot", "n"])

    added = in_python(featured.select("bag", "meta", "good", "fold"), run, "slot long, n double").groupBy("slot").agg(F.sum("n").alias("n"))
    sums = np.zeros(len(CLASSES) * size)
    rows = added.toArrow()  # at most len(CLASSES) * size rows, whatever the input
    sums[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    sums = sums.reshape(len(CLASSES), size)
    out, at = {}, 0
    for v, n in SIZES.items():
        out[v] = (sums[:, at : at + n], sums[:, at + n])
        at += n + 1
    return out


def _toxic_words(featured: DataFrame, documents: np.ndarray) -> ToxicWords:
    """The model of good against toxic: counts of the training folds' labelled rows, added up in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, WIDE + 1), np.int32)
        for raw in batches:
            b = Batch.of(raw)
            for k, c in enumerate((TOXIC, GOOD)):
                sums[k] += np.bincount(b.wide[np.repeat(b.good == c, b.wide_lengths)], minlength=WIDE + 1).astype(np.int32)
        at = np.nonzero(sums.any(axis=0))[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(s[at].astype(np.int64)) for s in sums)], names=["place", "toxic", "good"])

    rows = featured.where(F.col("good").isin(TOXIC, GOOD) & (F.col("fold") != HELD_OUT)).select("bag", "meta", "good", "fold")
    counts = durable(in_python(rows, run, "place long, toxic long, good long").groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("good").alias("good")))
    # no other place can weigh; at most WIDE + 1 rows, whatever the input
    found = counts.where(F.col("toxic") >= ToxicWords.LEAST).orderBy("place").toArrow()
    both = np.stack([found["toxic"].to_numpy(), found["good"].to_numpy()]).astype(float)
    return ToxicWords.fit(found["place"].to_numpy(), both, documents[[TOXIC, GOOD]], counts.agg(F.sum("good")).first()[0] or 0)


def monotone(good: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Isotonic shares by pooling adjacent bins that fall."""
    pools: list[list[float]] = []
    for g, n in zip(good, total, strict=True):
        pools.append([g, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] > pools[-1][0] * pools[-2][1]:
            g2, n2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + g2, pools[-1][1] + n2, pools[-1][2] + k2]
    return np.concatenate([np.full(int(k), g / max(n, 1e-9)) for g, n, k in pools])


@dataclass
class CoTrained:
    models: dict[str, View]
    edges: dict[str, np.ndarray]
    shares: dict[str, np.ndarray]
    prior: float
    toxic: ToxicWords | None = None
    clean: np.ndarray | None = None

    def predict(self, b: Batch) -> np.ndarray:
        odds = np.full(len(b.good), np.log(self.prior / (1 - self.prior)))
        for v, (f, n) in (("text", (b.bags, b.bag_lengths)), ("meta", (b.metas, b.meta_lengths))):
            p = self.shares[v][np.searchsorted(self.edges[v], self.models[v].score(f, n))]
            odds += np.log(p / (1 - p)) - np.log(self.prior / (1 - self.prior))
        p = 1 / (1 + np.exp(-odds))
        return p if self.toxic is None else np.minimum(p, self.clean[np.searchsorted(TOXIC_EDGES, self.toxic.score(b.wide, b.wide_lengths))])


def _calibrate(featured: DataFrame, models: dict[str, View], toxic: ToxicWords | None) -> CoTrained:
    """Shares of good documents by score bin on the held-out fold: counts of fixed size."""
    bins, toxic_bins = 4 * CALIBRATION_BINS, len(TOXIC_EDGES) + 1
    edges = {"text": np.linspace(-30, 30, CALIBRATION_BINS - 1), "meta": np.linspace(-20, 20, CALIBRATION_BINS - 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 2, CALIBRATION_BINS))
        by_toxic = np.zeros((2, toxic_bins))
        for raw in batches:
            b = Batch.of(raw)
            for k, (v, (f, n)) in enumerate((("text", (b.bags, b.bag_lengths)), ("meta", (b.metas, b.meta_lengths)))):
                at = np.searchsorted(edges[v], models[v].score(f, n)) if len(b.good) else np.zeros(0, int)
                for c in (JUNK, GOOD):
                    sums[k, c] += np.bincount(at[b.good == c], minlength=CALIBRATION_BINS)
            if toxic is not None and len(b.good):
                at = np.searchsorted(TOXIC_EDGES, toxic.score(b.wide, b.wide_lengths))
                for k, c in enumerate((TOXIC, GOOD)):
                    by_toxic[k] += np.bincount(at[b.good == c], minlength=toxic_bins)
        flat = np.concatenate([sums.ravel(), by_toxic.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.nonzero(flat)[0]), pa.array(flat[flat > 0])], names=["slot", "n"])

    held = featured.where((F.col("fold") == HELD_OUT) & F.col("good").isNotNull()).select("bag", "meta", "good", "fold")
    flat = np.zeros(bins + 2 * toxic_bins)
    for r in in_python(held, run, "slot long, n double").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # at most len(flat) rows
        flat[r["slot"]] = r["n"]
    sums, by_toxic = flat[:bins].reshape(2, 2, CALIBRATION_BINS), flat[bins:].reshape(2, toxic_bins)
    total = sums[0].sum()
    prior = min(max((sums[0, 1].sum() + 1) / (total + 2), 0.01), 0.99)
    shares = {}
    for k, v in enumerate(edges):
        good = sums[k, 1] + 2 * prior / CALIBRATION_BINS
        shares[v] = np.clip(monotone(good, sums[k].sum(axis=0) + 2 / CALIBRATION_BINS), 0.002, 0.998)
    if toxic is None:
        return CoTrained(models, edges, shares, prior)
    if by_toxic.sum(axis=1).all():
        seen = np.nonzero(by_toxic.any(axis=0))[0]  # bins that no document fell in go with the next one above
        clean = monotone(by_toxic[1, seen], by_toxic[:, seen].sum(axis=0))
        clean = clean[np.minimum(np.searchsorted(seen, np.arange(toxic_bins)), len(seen) - 1)]
    else:  # nothing to calibrate on: the model's own odds
        clean = 1 / (1 + np.exp(-np.append(TOXIC_EDGES, TOXIC_EDGES[-1])))
    return CoTrained(models, edges, shares, prior, toxic, np.clip(clean, 0.002, 0.998))


def co_train(featured: DataFrame, rounds: int = 3, confident: float = 0.99, pseudo_weight: float = 0.3) -> CoTrained | float:
    """The combined model; the share of good labels if there is only one class."""
    counts = _totals(featured, None, confident, pseudo_weight)
    documents = counts["text"][1]
    if not (documents[GOOD] and documents.sum() > documents[GOOD]):
        return 1.0 if not documents.any() else float(documents[GOOD] > 0)
    toxic = _toxic_words(featured, documents) if documents[TOXIC] else None
    both = [JUNK, GOOD]
    fit = lambda c: {v: View.fit(n[both], d[both], mean=v == "text") for v, (n, d) in c.items()}
    models = fit(counts)
    for _ in range(rounds):
        models = fit(_totals(featured, models, confident, pseudo_weight))
    return _calibrate(featured, models, toxic)


def _scored(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, lang: str, source: str, **training) -> DataFrame:
    """doc_id, key, p_quality of every row."""
    featured = durable(with_features(docs, labels, doc_id, text, lang, source))
    model = co_train(featured, **training)
    if not isinstance(model, CoTrained):
        return featured.select("doc_id", "key", F.lit(float(model)).alias("p_quality"))
    id_type = featured.schema["doc_id"].dataType.simpleString()
    return in_python(featured, _predictor(model), f"doc_id {id_type}, key long, p_quality double")


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", threshold: float = 0.5, **training) -> DataFrame:
    """doc_id, p_quality, kept for every row of ``docs``."""
    scored = _scored(docs, labels, doc_id, text, lang, source, **training)
    return scored.select("doc_id", "p_quality", (F.col("p_quality") >= threshold).alias("kept"))


def _predictor(model: CoTrained) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw in batches:
            p = model.predict(Batch.of(raw)) if raw.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([raw.column(0), raw.column(1), pa.array(np.round(p, 6))], names=["doc_id", "key", "p_quality"])

    return run


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", threshold: float = 0.5, **training) -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose score reaches the threshold (equal rows share a verdict)."""
    free_scratch(docs.sparkSession)
    scored = _scored(docs, labels, doc_id, text, lang, source, **training)
    rejected = broadcast_if_small(scored.where(F.col("p_quality") < threshold).select(F.col("key").alias("__qm_key")).distinct())
    own = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*own, _key(text, lang, source).alias("__qm_hash"))
    return keyed.join(rejected, F.col("__qm_hash") == F.col("__qm_key"), "left_anti").select(*own)
