"""Language-model scoring with Katz backoff (bigrams over unigrams).

Counts. Training documents give counts of words, of pairs (previous word, word) and of contexts;
each text begins with a start context and ends with one end token. Pair counts r up to ``k`` are
discounted by Good-Turing: d(r) = (r*/r - a) / (1 - a), r* = (r + 1) n(r+1) / n(r), a = (k + 1)
n(k+1) / n(1), with n(r) the number of pairs seen r times. Greater counts, and those whose d(r) is not
within 0 and 1, lose ``TAIL`` of a count: every seen pair is discounted, so every context has mass for
the words it was not seen with. Unigrams: P(w) = (c(w) + 1) / (N + V + 1); the one left over is for
unseen words.

Backoff. alpha(h) = (1 - sum of seen P(w|h)) / (1 - sum of P(w) over the same words): the
probabilities of every context add up to one exactly. P(w|h) is d c(h,w) / c(h) for a seen pair, else
alpha(h) P(w); a context without training pairs has alpha 1. A text's score is the sum over its
tokens.

Tables. Tasks pack blocks of tokens into one row per block and partition: the block's distinct pairs
with the documents that hold them, dealt by the word. A partition sees every use of its words and
pairs. It works them off in slices of its words, so it holds one slice unpacked, and writes tables of
packed rows, partitioned by kind: what its words and pairs add to each document, what its pairs add to
each context (pairs seen r times, mass of their words), unseen pairs by context, and the totals.
Discounts are known only after that; they multiply the sums of each r. As c(h) is also the count of h
as a word, the sums take it from the word's own partition; unseen pairs (held-out texts alone have
them) meet their context's c(h) alpha(h) in the partition of the context.

Hot words. Words that are at least one token in a thousand (at most a thousand words, whatever the
input) are counted before. Pairs of such a word are dealt by both words, and unseen pairs of such a
context by the document too: its c(h) alpha(h) is sent to all tasks. Words are 64-bit hashes.

Null texts count as empty and hold the end token alone; a null id's text of the digest is empty;
rows that repeat an id and text are scored and counted each; an empty table gives no rows; without
training tokens every word is unseen. Extra columns are ignored. Texts of any length are scored whole: a
block holds one text at least, so a task holds the longest text's tokens.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.shared import durable, free_scratch, in_python, join_counted, remove, shared_dir, text_or_empty

#: Start context and end token: texts with a blank, which no word has; their places in every block's words.
START, END = b"\t s", b"\t e"
DOCUMENT, CONTEXT, HOT, TOTAL = range(4)
#: A word is frequent from this share of all tokens on.
FREQUENT = 1 / 1000
#: What a pair loses that Good-Turing does not discount.
TAIL = 0.5
#: Parts of a partition's words that are worked off one after the other.
SLICES = 8


def signed_hash(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64 if h >> 63 else 0)


def held_out(doc_id: Column, parts: int = 7, held: int = 2) -> Column:
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts) == held


def good_turing(counts: dict[int, int], k: int) -> dict[int, float]:
    """Discount of counts 1 to k from the number of pairs seen r times."""
    usable = counts.get(1) and all(counts.get(r) for r in range(1, k + 2))
    a = (k + 1) * counts[k + 1] / counts[1] if usable else 1.0
    out = {}
    for r in range(1, k + 1):
        d = ((r + 1) * counts[r + 1] / (r * counts[r]) - a) / (1 - a) if a != 1 else 1.0
        out[r] = d if 0 < d < 1 else (r - TAIL) / r
    return out


class WordPlaces(dict):
    """Word -> its place in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


class Block:
    """Tokens of some documents: words as places in ``hashes``, laid end to end without the end tokens."""

    def __init__(self) -> None:
        self.places = WordPlaces({START: 0, END: 1})
        self.keys: list[int] = []
        self.held: list[bool] = []
        self.texts: list[np.ndarray] = []
        self.size = 0

    def add(self, key: int, held: bool, text: bytes) -> None:
        words = text.lower().split()
        self.texts.append(np.fromiter(map(self.places.__getitem__, words), np.int32, len(words)))
        self.keys.append(key)
        self.held.append(held)
        self.size += len(words) + 1

    def hashes(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(w) for w in self.places), np.uint64, len(self.places)).view(np.int64)


def blocks_of(batches: Iterator[pa.RecordBatch], most_tokens: int = 1_200_000) -> Iterator[Block]:
    """Blocks of about ``most_tokens`` tokens from batches of (key, held_out, text as binary)."""
    block = Block()
    for batch in batches:
        for key, held, text in zip(*(batch.column(k) for k in range(3)), strict=True):
            block.add(key.as_py(), held.as_py(), text.as_py())
            if block.size >= most_tokens:
                yield block
                block = Block()
    if block.size:
        yield block


def frequent_words(slim: DataFrame) -> tuple[dict[int, int], int]:
    """Hash -> count in training texts of the words that are FREQUENT; the number of all tokens."""

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks_of(batches):
            n = np.bincount(np.concatenate(b.texts), minlength=len(b.places))
            n[1] += len(b.texts)
            own = n >= FREQUENT / 2 * b.size
            own[0] = True  # its row carries the block's size
            n[0] = b.size
            hashes = b.hashes()
            yield pa.RecordBatch.from_arrays([pa.array(hashes[own]), pa.array(n[own])], names=["w", "n"])

    # a frequent word of the whole passes the halved share in blocks that hold at least half its uses
    start = signed_hash(START)
    sums = durable(in_python(slim, candidates, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")))
    total = sums.where(F.col("w") == start).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = sums.where((F.col("w") != start) & (F.col("n") >= total * FREQUENT / 2)).select("w").collect()  # at most 2 / FREQUENT rows
    hot = np.array(sorted(r["w"] for r in found), np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks_of(batches):
            trained = [t for t, h in zip(b.texts, b.held, strict=True) if not h]
            n = np.bincount(np.concatenate([np.zeros(0, np.int32), *trained]), minlength=len(b.places))
            n[1] += len(trained)
            hashes = b.hashes()
            own = np.isin(hashes, hot)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[own]), pa.array(n[own])], names=["w", "n"])

    if not len(hot):
        return {}, total
    exact = in_python(slim, count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()  # the same rows
    return {r["w"]: r["n"] for r in exact}, total


def pack(arrays: list[np.ndarray], kinds: tuple) -> tuple[int, bytes]:
    """Size before compression, and the arrays' bytes by significance, compressed."""
    arrays = [np.ascontiguousarray(a, t) for a, t in zip(arrays, kinds, strict=True)]
    sizes = np.array([len(a) for a in arrays], np.int64).tobytes()
    raw = sizes + b"".join([a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays])
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def unpack(size: int, data: bytes, kinds: tuple) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, size, codec="zstd", asbytes=True), np.uint8)
    sizes, at, out = raw[: 8 * len(kinds)].view(np.int64), 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds, strict=True):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(kind).ravel())
        at += n * width
    return out


#: Head of a packed row: keys of its documents, whether held out, hashes of its previous words.
HEAD = (np.int64, np.uint8, np.int64)
#: A slice: words' hashes, pairs per word, places of previous words, documents per pair, their places and uses.
SLICE = (np.int64, np.int32, np.int32, np.int32, np.int32, np.int32)


def first_of(*sorted_columns: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before."""
    new = np.ones(len(sorted_columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in sorted_columns], axis=0)
    return new


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number of two hashes, spread over all bits."""
    x = (a.view(np.uint64) >> np.uint64(3)) + b.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(5)


def packed_pairs(slim: DataFrame, parts: int, hot: dict[int, int]) -> DataFrame:
    """part, sizes, blobs (head and slices): one row per block and partition."""
    frequent = np.array(sorted(hot), np.int64)

    def rows_of(b: Block) -> pa.RecordBatch:
        hashes, held, keys = b.hashes(), np.array(b.held, np.uint8), np.array(b.keys, np.int64)
        many = np.array([len(t) + 1 for t in b.texts], np.int64)
        w = np.ones(b.size, np.int64)
        ends = np.cumsum(many) - 1
        inside = np.ones(b.size, bool)
        inside[ends] = False
        w[inside] = np.concatenate(b.texts)
        h = np.concatenate(([0], w[:-1]))
        h[ends[:-1] + 1] = 0
        pairs, which = np.unique(w << 32 | h, return_inverse=True)
        uses, m = np.unique(which * len(keys) + np.repeat(np.arange(len(keys)), many), return_counts=True)
        del which, inside
        of, doc = np.divmod(uses, len(keys))
        w, h = pairs >> 32, pairs & 0xFFFFFFFF
        by = hashes[w].view(np.uint64) >> np.uint64(3)
        if len(frequent):
            by = np.where(np.isin(hashes, frequent)[w], mix(hashes[w], hashes[h]), by)
        sub = (by % np.uint64(parts * SLICES)).astype(np.int64)
        order = np.lexsort((h, w, sub))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        again = np.argsort(place[of], kind="stable")
        of, doc, m = place[of][again], doc[again], m[again]
        sub, w, h = sub[order], w[order], h[order]
        refs = np.bincount(of, minlength=len(sub))
        edges = np.searchsorted(sub, np.arange(parts * SLICES + 1))
        ref_edges = np.concatenate(([0], np.cumsum(refs)))[edges]
        out_parts, out_sizes, out_blobs = [], [], []
        for k in np.nonzero(np.diff(edges[::SLICES]))[0].tolist():
            a, z = edges[k * SLICES], edges[(k + 1) * SLICES]
            docs, local = np.unique(doc[ref_edges[k * SLICES] : ref_edges[(k + 1) * SLICES]], return_inverse=True)
            befores, before = np.unique(h[a:z], return_inverse=True)
            packs = [pack([keys[docs], held[docs], hashes[befores]], HEAD)]
            u0 = ref_edges[k * SLICES]
            for s in range(k * SLICES, (k + 1) * SLICES):
                x, y, u, v = edges[s], edges[s + 1], ref_edges[s], ref_edges[s + 1]
                first = np.nonzero(first_of(w[x:y]))[0]
                packs.append(pack([hashes[w[x:y][first]], np.diff(np.append(first, y - x)), before[x - a : y - a], refs[x:y], local[u - u0 : v - u0], m[u:v]], SLICE))
            out_parts.append(k)
            out_sizes.append([n for n, _ in packs])
            out_blobs.append([d for _, d in packs])
        return pa.RecordBatch.from_arrays([pa.array(out_parts, pa.int32()), pa.array(out_sizes, pa.list_(pa.int64())), pa.array(out_blobs, pa.list_(pa.binary()))], names=["part", "sizes", "blobs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks_of(batches):
            yield rows_of(b)

    return in_python(slim, run, "part int, sizes array<long>, blobs array<binary>")


def added(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys, and each value's sum by key."""
    own, which = np.unique(keys, return_inverse=True)
    return own, [np.bincount(which, v, len(own)) for v in values]


def table_rows(kind: int, parts: int, deal: np.ndarray, kinds: tuple, columns: list[np.ndarray]) -> Iterator[tuple]:
    """One packed row per partition of ``deal``."""
    order = np.argsort(deal, kind="stable")
    edges = np.searchsorted(deal[order], np.arange(parts + 1))
    for p in np.nonzero(np.diff(edges))[0].tolist():
        own = order[edges[p] : edges[p + 1]]
        yield (kind, p, None, None, *pack([c[own] for c in columns], kinds))


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.int64(), pa.binary())
    names = ("kind", "part", "h", "v", "size", "data")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


TABLE = "kind int, part int, h long, v array<double>, size long, data binary"


def document_kinds(k: int) -> tuple:
    """key, tokens, known tokens, unseen pairs, base sum, pair sum, uses of pairs seen 1 .. k times."""
    return (np.int64, np.int32, np.int32, np.int32, np.float64, np.float64, *[np.int32] * k)


def context_kinds(k: int) -> tuple:
    """h, total, mass of its words, its pairs seen more than k times and 1 .. k times."""
    return (np.int64, np.int64, np.int64, *[np.int32] * (k + 1))


UNSEEN_KINDS = (np.int64, np.int64, np.int32)


def deal_keys(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix(keys, np.zeros(1, np.int64)) % np.uint64(parts)).astype(np.int64)


def tables(packed: DataFrame, parts: int, hot: dict[int, int], k: int) -> DataFrame:
    """What every partition's words and pairs add up to: rows of TABLE."""
    end = signed_hash(END)
    frequent = np.array(sorted(hot), np.int64)
    frequent_counts = np.array([hot[x] for x in frequent.tolist()], float)
    # contexts that many pairs share: the frequent words and the start
    wide = np.unique(np.append(frequent, signed_hash(START)))

    def slice_of(heads: list, rows: list, s: int) -> list[np.ndarray] | None:
        """Words, previous words, pair of each use, document and number of uses over all rows of one slice."""
        got: list[list[np.ndarray]] = [[] for _ in range(5)]
        pairs_before = 0
        for (befores, documents), (sizes, blobs) in zip(heads, rows, strict=True):
            words, per_word, before, refs, doc, m = unpack(sizes[s + 1], blobs[s + 1], SLICE)
            new = [np.repeat(words, per_word), befores[before], np.repeat(np.arange(len(before), dtype=np.int32), refs) + np.int32(pairs_before), documents[doc], m]
            pairs_before += len(before)
            for column, value in zip(got, new, strict=True):
                column.append(value)
        return [np.concatenate(c) for c in got] if pairs_before else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, heads, keys, held = [], [], [], []
        n_docs = 0
        for batch in batches:
            for sizes, blobs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own_keys, own_held, befores = unpack(sizes[0], blobs[0], HEAD)
                rows.append((sizes, blobs))
                heads.append((befores, np.arange(n_docs, n_docs + len(own_keys), dtype=np.int32)))
                keys.append(own_keys)
                held.append(own_held)
                n_docs += len(own_keys)
        if not rows:
            return
        docs, of_doc = np.unique(np.concatenate(keys), return_inverse=True)
        held = np.concatenate(held)
        keys.clear()
        sums = np.zeros((5 + k, len(docs)))
        total, distinct = 0.0, 0
        seen_times = np.zeros(k + 2)
        contexts: tuple[np.ndarray, np.ndarray] | None = None
        unseen: list[list[np.ndarray]] = [[], [], []]
        for s in range(SLICES):
            if (got := slice_of(heads, rows, s)) is None:
                continue
            w, h, of, doc, m = got
            del got
            order = np.lexsort((h, w))
            w, h = w[order], h[order]
            new_pair = first_of(w, h)
            group = np.empty(len(order), np.int32)
            group[order] = np.cumsum(new_pair) - 1
            word = (np.cumsum(first_of(w)) - 1)[new_pair]
            w, h, of = w[new_pair], h[new_pair], group[of]
            del order, group, new_pair
            n = np.bincount(of, m * (held[doc] == 0), len(w))
            own = w[first_of(w)]
            c = np.bincount(word, n, len(own))
            is_hot = np.isin(own, frequent)
            c[is_hot] = frequent_counts[np.searchsorted(frequent, own[is_hot])] if len(frequent) else 0
            base = np.log10(c + 1)
            as_context = np.where((c > 0) & (own != end), np.log10(np.maximum(c, 1)), 0.0)
            kept = np.where(n > k, n - TAIL, np.maximum(n, 1))
            pair = np.where(n > 0, np.log10(kept), base[word]) - as_context[word]
            at = of_doc[doc]
            known = (c > 0)[word][of]
            for j, value in enumerate((m, m * known, m * (n == 0)[of], m * base[word][of], m * pair[of])):
                sums[j] += np.bincount(at, value, len(docs))
            times = n[of]
            for r in range(1, k + 1):
                sums[4 + r] += np.bincount(at[times == r], m[times == r], len(docs))
            lost = times == 0
            for column, value in zip(unseen, (h[of[lost]], docs[at[lost]], m[lost]), strict=True):
                column.append(value)
            total += n.sum()
            distinct += np.count_nonzero((c > 0) & ~is_hot)
            seen = n > 0
            seen_times += np.bincount(np.minimum(n[seen], k + 2).astype(np.int64), minlength=k + 3)[1 : k + 3]
            more = added(h[seen], n[seen], c[word][seen] + 1, n[seen] > k, *(n[seen] == r for r in range(1, k + 1)))
            if contexts is not None:
                more = added(np.concatenate((contexts[0], more[0])), *(np.concatenate(x) for x in zip(contexts[1], more[1], strict=True)))
            contexts = more
        del rows, heads
        out = list(table_rows(DOCUMENT, parts, deal_keys(docs, parts), document_kinds(k), [docs, *sums]))
        h, values = contexts if contexts is not None else (np.zeros(0, np.int64), [np.zeros(0)] * (k + 3))
        broad = np.isin(h, wide)
        out += [(HOT, 0, int(x), [float(v[i]) for v in values], None, None) for i, x in zip(np.nonzero(broad)[0].tolist(), h[broad].tolist(), strict=True)]
        narrow = [h[~broad], *(v[~broad] for v in values)]
        out += table_rows(CONTEXT, parts, deal_keys(narrow[0], parts), context_kinds(k), narrow)
        h, key, m = (np.concatenate(c) for c in unseen)
        by = np.where(np.isin(h, wide), mix(h, key), h.view(np.uint64)).view(np.int64)
        out += [(CONTEXT, p + parts, *rest) for _, p, *rest in table_rows(CONTEXT, parts, deal_keys(by, parts), UNSEEN_KINDS, [h, key, m])]
        out.append((TOTAL, 0, None, [total, float(distinct), *seen_times[: k + 1].tolist()], None, None))
        yield as_batch(out)

    return in_python(packed, run, TABLE)


class Discounts:
    """d(1) .. d(k) and what they take from contexts."""

    def __init__(self, times: list[int], k: int) -> None:
        self.k = k
        self.of = good_turing(dict(enumerate(times, 1)), k)
        self.logs = np.log10([self.of[r] for r in range(1, k + 1)])
        #: mass that a pair seen more than k, 1 .. k times leaves
        self.leaves = np.array([TAIL, *[(1 - self.of[r]) * r for r in range(1, k + 1)]])

    def alpha(self, total: np.ndarray, low: np.ndarray, pairs: list[np.ndarray], scale: float) -> np.ndarray:
        removed = sum(n * x for n, x in zip(pairs, self.leaves, strict=True))
        return removed / total / (1 - low / scale)


def train(slim: DataFrame, path: str, k: int = 5, part_tokens: int = 6_000_000, least_parts: int = 64) -> tuple[DataFrame, int, Discounts, int, int]:
    """(the stored tables, their partitions, discounts, N, V)."""
    spark = slim.sparkSession
    hot, tokens = frequent_words(slim)
    # every partition that holds one of a document's words adds a row for it: no more than needed
    parts = max(least_parts, -(-tokens // part_tokens))
    packed = packed_pairs(slim, parts, hot).repartitionById(parts, "part")
    tables(packed, parts, hot, k).write.partitionBy("kind").parquet(path)
    del packed
    free_scratch(spark)
    stored = spark.read.schema("part int, h long, v array<double>, size long, data binary, kind int").parquet(path)
    one = stored.where(F.col("kind") == TOTAL).agg(*(F.coalesce(F.sum(F.col("v")[i]), F.lit(0.0)) for i in range(k + 3))).first()
    free_scratch(spark)  # the packed pairs: Spark holds on to a query until the next one has run
    distinct = int(one[1]) + sum(n > 0 for n in hot.values())
    return stored, parts, Discounts([int(x) for x in one[2:]], k), int(one[0]), distinct


def backed_off(stored: DataFrame, parts: int, discounts: Discounts, scale: float) -> DataFrame:
    """Rows of DOCUMENT whose only sum is that of c(h) alpha(h) over unseen pairs."""
    k = discounts.k
    sums = [F.sum(F.col("v")[i]) for i in range(k + 3)]
    wide = sorted(stored.where(F.col("kind") == HOT).groupBy("h").agg(*sums).collect())  # at most 2 / FREQUENT + 1 rows
    wide_h = np.array([r[0] for r in wide], np.int64)
    wide_v = np.array([list(r)[1:] for r in wide], float).reshape(-1, k + 3).T
    wide_log = np.log10(wide_v[0] * discounts.alpha(wide_v[0], wide_v[1], list(wide_v[2:]), scale))

    def logs_of(h: np.ndarray, known: np.ndarray, logs: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(h))
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        return np.where(known[at] == h, logs[at], 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[list[np.ndarray]] = []
        asked: list[list[np.ndarray]] = []
        for batch in batches:
            for part, size, data in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                (own if part < parts else asked).append(unpack(size, data, context_kinds(k) if part < parts else UNSEEN_KINDS))
        if not asked:
            return
        h, key, m = (np.concatenate(c) for c in zip(*asked, strict=True))
        contexts, (total, low, *pairs) = added(*(np.concatenate(c) for c in zip(*own, strict=True))) if own else (np.zeros(0, np.int64), [np.zeros(0)] * (k + 3))
        logs = np.log10(total * discounts.alpha(total, low, pairs, scale))
        score = logs_of(h, contexts, logs) + logs_of(h, wide_h, wide_log)
        keys, (sums,) = added(key, m * score)
        nothing = np.zeros(len(keys))
        yield as_batch(list(table_rows(DOCUMENT, parts, deal_keys(keys, parts), document_kinds(k), [keys, nothing, nothing, nothing, nothing, sums, *[nothing] * k])))

    rows = stored.where(F.col("kind") == CONTEXT).select("part", "size", "data", F.pmod("part", F.lit(parts)).alias("to"))
    return in_python(rows.repartitionById(parts, "to").drop("to"), run, TABLE)


def document_sums(rows: DataFrame, parts: int, discounts: Discounts) -> DataFrame:
    """key, n_tokens, n_known, n_unseen, base, score of every document key: sums over the packed rows."""
    k = discounts.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: tuple | None = None
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            for n, data in zip(*(batch.column(c).to_pylist() for c in (1, 2)), strict=True):
                held.append(unpack(n, data, document_kinds(k)))
                size += len(held[-1][0])
                if size > 500_000:
                    sums, held, size = merged(sums, held), [], 0
        sums = merged(sums, held)
        if sums is not None:
            keys, (tokens, known, unseen, base, pair, *times) = sums
            score = pair + sum(t * x for t, x in zip(times, discounts.logs, strict=True))
            columns = [pa.array(keys), *(pa.array(x.astype(np.int64)) for x in (tokens, known, unseen)), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_tokens", "n_known", "n_unseen", "base", "score"])

    def merged(sums: tuple | None, held: list) -> tuple | None:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)] if held else None
        if sums is not None:
            columns = [sums[0], *sums[1]] if columns is None else [np.concatenate(x) for x in zip([sums[0], *sums[1]], columns, strict=True)]
        return None if columns is None else added(*columns)

    return in_python(rows.select("part", "size", "data").repartitionById(parts, "part"), run, "key long, n_tokens long, n_known long, n_unseen long, base double, score double")


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, part_tokens: int = 6_000_000, least_parts: int = 64) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    t = text_or_empty(text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), t).alias("key"), held_out(F.col(doc_id)).alias("held_out"), t.cast("binary").alias("text"))
    path = f"{shared_dir(spark)}/katz/{uuid.uuid4().hex}"
    stored, parts, discounts, total, distinct = train(rows.select("key", "held_out", "text"), path, k, part_tokens, least_parts)
    scale = float(total + distinct + 1)
    own = stored.where(F.col("kind") == DOCUMENT).select("part", "size", "data")
    backed = backed_off(stored, parts, discounts, scale).select("part", "size", "data")
    free_scratch(spark)
    per_key = document_sums(own.unionByName(backed), parts, discounts)
    rows = rows.drop("text")
    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    per_key = durable(per_key.join(copies.withColumn("copies", F.col("n")), "key"))
    remove(spark, path)
    free_scratch(spark)
    started = rows.where(~F.col("held_out")).count()
    log = float(np.log10(scale))
    share = lambda x: F.col(x) / F.col("copies")  # noqa: E731  repeated rows share a key: its sums hold every copy
    score = share("score") - share("n_unseen") * log - (float(np.log10(started)) if started else 0.0)
    out = join_counted(rows, per_key, "key")
    return out.select("doc_id", "held_out", share("n_tokens").cast("long").alias("n_tokens"), share("n_known").cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (share("base") - share("n_tokens") * log).alias("base_score"), score.alias("score"))
