"""Benchmark decontamination: BM25 over test items with block-max WAND, then an overlap check.

The test items are the index and every passage of every document is a query. Spark counts the
items' terms and document frequencies; postings carry impacts (BM25 share of a term in the item's
score for its own text), so one threshold, ``min_share``, holds for all items. Postings are kept in
blocks of item numbers with the largest impact of each block.

A document is cut into passages of twice the longest item's words, half a passage apart, so every
item lies wholly in some passage. For each passage and block of items the sum of its terms' block
maxima is an upper bound (vectorised over a batch of documents). Blocks below the threshold are
skipped; in the others all items are scored exactly. Every item that reaches the threshold is
retrieved; there is no cap. A retrieved item is a leak if at least ``min_overlap`` of its question's
and of its answer's word n-grams stand in the passage. An item's answer is its last sentence or
line, or its last third if it has only one.

The index is sent to all tasks, ``block_bytes`` of item text at a time: larger item tables take
several passes over the documents, each with an index of bounded size. Document frequencies always
come from all items. Documents are read once a pass, without a shuffle.

Null or blank texts match nothing; items without words are left out; items of equal text are
separate items; ids may be null or repeated; items that tie at the threshold are all retrieved; an empty
item table finds nothing, an empty table of documents gives no rows; texts of any length are searched
whole, and a task holds one text's passages with their bounds (about 25 MB for each MB of one text
beyond the first); extra columns are ignored by :func:`find_leaks` and
kept by :func:`drop_leaking`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyferry.llm.bpe import blocks_of
from tallyferry.llm.shared import broadcast_if_small, durable, in_python, text_or_empty

K1, B = 1.2, 0.75
STRIP = re.compile(r"^\W+|\W+$")
END = re.compile(r"[.!?:;]\W*$")


def terms_of(text: str) -> list[str]:
    return [t for w in text.lower().split() if (t := STRIP.sub("", w))]


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Terms of the question and of the answer of an item."""
    sentences: list[list[str]] = [[]]
    for line in text.lower().split("\n"):
        for w in line.split():
            if t := STRIP.sub("", w):
                sentences[-1].append(t)
            if END.search(w) and sentences[-1]:
                sentences.append([])
        if sentences[-1]:
            sentences.append([])
    sentences = [s for s in sentences if s]
    terms = [t for s in sentences for t in s]
    if len(sentences) > 1 and len(sentences[-1]) >= 3:
        return terms[: -len(sentences[-1])], sentences[-1]
    cut = max(1, len(terms) * 2 // 3)
    return terms[:cut], terms[cut:]


def ngrams(terms: list[str], n: int) -> set[tuple[str, ...]]:
    n = min(n, len(terms))
    return {tuple(terms[i : i + n]) for i in range(len(terms) - n + 1)} if n else set()


class BlockMaxIndex:
    """Postings with impacts in blocks of item numbers."""

    def __init__(self, items: list[tuple], df: dict[str, int], total: int, mean: float, most_blocks: int = 64) -> None:
        self.items = [(item, text, terms_of(text)) for item, text in items]
        self.block = block = max(8, -(-len(self.items) // most_blocks))
        self.longest = max([len(t) for _, _, t in self.items], default=0)
        postings: dict[str, list[tuple[int, float]]] = {}
        for number, (_, _, terms) in enumerate(self.items):
            counts: dict[str, int] = {}
            for t in terms:
                counts[t] = counts.get(t, 0) + 1
            norm = K1 * (1 - B + B * len(terms) / max(mean, 1e-9))
            own = {t: math.log(1 + (total - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + norm) for t, c in counts.items()}
            full = sum(own.values())
            for t, x in own.items():
                postings.setdefault(t, []).append((number, x / full))
        self.term = {t: k for k, t in enumerate(postings)}
        blocks = -(-len(self.items) // block)
        self.block_bounds = np.zeros((len(postings), blocks), np.float32)
        rows: list[list[tuple[int, int, float]]] = [[] for _ in range(blocks)]
        for k, posted in enumerate(postings.values()):
            for n, x in posted:
                self.block_bounds[k, n // block] = max(self.block_bounds[k, n // block], x)
                rows[n // block].append((k, n % block, x))
        self.blocks = []
        for own in rows:  # the terms of a block, ascending, and the impacts of its items
            terms = np.array(sorted({k for k, _, _ in own}), np.int64)
            impacts = np.zeros((len(terms), block))
            for k, n, x in own:
                impacts[np.searchsorted(terms, k), n] = x
            self.blocks.append((terms, impacts))
        self.questions = [question_and_answer(text) for _, text, _ in self.items]

    def search(self, terms: np.ndarray, blocks: np.ndarray, least: float) -> list[tuple[int, float]]:
        """Items of ``blocks`` whose summed impact over the ascending ``terms`` is at least ``least``."""
        out = []
        for b in blocks.tolist():
            own, impacts = self.blocks[b]
            at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
            scores = impacts[at[own[at] == terms]].sum(axis=0)
            out += [(b * self.block + int(n), float(scores[n])) for n in np.nonzero(scores >= least - 1e-9)[0]]
        return out


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple], dict[str, int], int, float]]:
    """Items of at most about ``block_bytes`` of text at a time, with their terms' frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = pa.array([terms_of(t) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, terms], names=["item_id", "text", "terms"])

    # the index looks terms up by the same rule
    shaped = durable(in_python(items.select("item_id", "text"), run, f"item_id {items.schema['item_id'].dataType.simpleString()}, text string, terms array<string>").where(F.size("terms") > 0))
    total, mean, size = shaped.agg(F.count(F.lit(1)), F.avg(F.size("terms")), F.sum(F.octet_length("text"))).first()
    if not total:
        return
    frequency = shaped.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    passes = max(1, math.ceil(size / block_bytes))
    part = F.pmod(F.hash("item_id", "text"), F.lit(passes))
    for k in range(passes):
        own = shaped.where(part == k)
        rows = sorted(((r["item_id"], r["text"]) for r in own.select("item_id", "text").collect()), key=lambda r: (True, "", r[1]) if r[0] is None else (False, *r))
        needed = own.select(F.explode("terms").alias("term")).distinct()
        df = {r["term"]: r["df"] for r in frequency.join(needed, "term").collect()}
        yield rows, df, total, mean


def _matcher(index: BlockMaxIndex, kind: pa.DataType, min_share: float, min_overlap: float, gram: int):
    step = max(index.longest, 1)  # a passage is two steps long and begins one step behind the last

    def likely(ids: list[np.ndarray]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(text, passage, terms, blocks) where the maxima of a block reach the threshold."""
        lengths = np.array([len(x) for x in ids], np.int64)
        passages = np.maximum(-(-lengths // step) - 1, 1)
        first = np.concatenate(([0], np.cumsum(passages)))
        owner = np.repeat(np.arange(len(ids)), lengths)
        at = (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)) // step
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        known = flat >= 0
        owner, at, flat = owner[known], at[known], flat[known]
        codes = []
        for back in (0, 1):
            there = (at >= back) & (at - back < passages[owner])
            codes.append((first[owner[there]] + at[there] - back) * len(index.term) + flat[there])
        codes = np.unique(np.concatenate(codes))
        if not len(codes):
            return []
        passage, term = np.divmod(codes, len(index.term))
        starts = np.nonzero(np.concatenate(([True], passage[1:] != passage[:-1])))[0]
        bounds = np.add.reduceat(index.block_bounds[term], starts, axis=0) >= min_share - 1e-5
        ends = np.append(starts[1:], len(codes))
        out = []
        for k in np.nonzero(bounds.any(axis=1))[0]:
            p = int(passage[starts[k]])
            text = int(np.searchsorted(first, p, side="right")) - 1
            out.append((text, p - int(first[text]), term[starts[k] : ends[k]], np.nonzero(bounds[k])[0]))
        return out

    def verified(words: list[str], items: list[tuple[int, float]]) -> Iterator[tuple[int, float, float, float]]:
        terms = [t for w in words if (t := STRIP.sub("", w))]
        have = {n: ngrams(terms, n) for n in range(1, gram + 1)}
        for item, score in items:
            shares = []
            for part in index.questions[item]:
                grams = ngrams(part, gram)
                shares.append(len(grams & have.get(min(gram, len(part)), set())) / len(grams) if grams else 1.0)
            if min(shares) >= min_overlap:
                yield item, score, *shares

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for a, b in blocks_of(batch.column(1), 1_000_000):
                words = [t.lower().split() for t in batch.column(1).slice(a, b - a).to_pylist()]
                if len(known) > 100_000:
                    known.clear()
                for w in {w for ws in words for w in ws if w not in known}:
                    known[w] = index.term.get(STRIP.sub("", w), -1)
                best: dict[tuple[int, int], tuple] = {}
                for text, p, terms, blocks in likely([np.fromiter(map(known.__getitem__, ws), np.int64, len(ws)) for ws in words]):
                    if found := index.search(terms, blocks, min_share):
                        for item, *figures in verified(words[text][p * step : (p + 2) * step], found):
                            best[text, item] = max(best.get((text, item), ()), tuple(figures))
                if best:
                    keys = sorted(best)
                    columns = [batch.column(0).take(pa.array([a + t for t, _ in keys])), pa.array([index.items[k][0] for _, k in keys], kind)]
                    columns += [pa.array([best[x][k] for x in keys], pa.float64()) for k in range(3)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return run


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", min_share: float = 0.5, min_overlap: float = 0.6, gram: int = 3, block_bytes: int = 2_000_000) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: one row per document and leaked item."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    tests = items.select(F.col(item_id).alias("item_id"), text_or_empty(item_text).alias("text"))
    id_types = [x.schema[c].dataType for x, c in ((slim, "doc_id"), (tests, "item_id"))]
    schema = f"doc_id {id_types[0].simpleString()}, item_id {id_types[1].simpleString()}, score double, question_overlap double, answer_overlap double"
    none = F.lit(None)
    out = slim.limit(0).select("doc_id", none.cast(id_types[1]).alias("item_id"), *[none.cast("double").alias(c) for c in ("score", "question_overlap", "answer_overlap")])
    for rows, df, total, mean in item_blocks(tests, block_bytes):
        index = BlockMaxIndex(rows, df, total, mean)
        out = out.unionByName(in_python(slim, _matcher(index, to_arrow_type(id_types[1]), min_share, min_overlap, gram), schema))
    return out


def drop_leaking(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs``, columns unchanged, without the rows whose text holds a test item (equal texts share a verdict)."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*own, F.xxhash64(text_or_empty(text)).alias("__dc_hash"))
    found = find_leaks(keyed.select("__dc_hash", F.col(text).alias("__dc_text")), items, "__dc_hash", "__dc_text", **settings)
    leaking = broadcast_if_small(found.select(F.col("doc_id").alias("__dc_key")).distinct())
    return keyed.join(leaking, F.col("__dc_hash") == F.col("__dc_key"), "left_anti").select(*own)
