"""Exact self-join of shingle sets by Jaccard similarity, without a candidate that can be lost.

1. A text's set holds a 64-bit hash of each run of ``words`` words (ASCII lower case, ASCII white
   space; shorter texts are one run). Rows of one text are one entry.
2. Prefix filter: all sets are put in one order, rare shingles first. Two sets of similarity t share
   one of the first n - ceil(t * n) + 1 shingles of each, so these are posted and nothing else is. The
   order comes from counts in ``SLOTS`` hashed slots; any order gives the same pairs, a coarse one
   only longer lists.
3. Signature filter: a signature has the parities of the shingles in 512 slots and the set's size. Two
   sets differ in at least as many shingles as their parities do, and as their sizes do, so a pair
   that exceeds (1 - t) / (1 + t) of both sizes is none.
4. Check: the sets of the pairs left are compared shingle by shingle.

A list's pairs are not all checked, and none that lies within a component of the links known before
(those of the fingerprints). First each entry of a list (of a long list: of each pair of its blocks)
is paired with the closest one before it; these pairs are checked and joined to components.
Then the other pairs that pass the signature filter are checked if they lie in different components.
Lists with more such pairs than ``CROWDED`` for each entry are not written out before: only where their
entries lie in different components are they gone through again. A pair that is never checked lies
within a component already, so the components are those of all pairs. Nothing is capped or drawn.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.links import components, posting_lists
from tallyferry.llm.shared import broadcast_if_small, durable, free_scratch, in_python, text_or_empty

SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
SIGNATURE = 64  # bytes of parities, before four bytes of size
CROWDED = 4
SCALE = 10_000  # similarities are counted in 1 / SCALE


def shingles(text: bytes, words: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words of a UTF-8 text."""
    tokens = text.lower().split()
    if len(known) > 100_000:
        known.clear()
    for w in set(tokens):
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w, 42)
    hashed = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    n = max(1, len(hashed) - words + 1)
    out = np.full(n, 0x9E3779B97F4A7C15 + len(hashed[:words]), np.uint64)
    for k in range(min(words, len(hashed))):
        out = (out ^ hashed[k : k + n]) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return np.unique(out * np.uint64(0xC4CEB9FE1A85EC53))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def signature(hashes: np.ndarray) -> bytes:
    odd = np.bincount((hashes & np.uint64(8 * SIGNATURE - 1)).astype(np.int64), minlength=8 * SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes() + np.uint32(len(hashes)).tobytes()


def _slot_counts(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """How many shingles of all texts fall in each slot: an array of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        sums = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for t in batch.column(0):
                np.add.at(sums, _slots(shingles(t.as_py(), words, known)), 1)
        at = np.nonzero(sums)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["slot", "n"])

    rows = in_python(docs.select(text_or_empty(text).cast("binary")), run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SLOTS, np.uint32)
    out[rows["slot"].to_numpy()] = np.minimum(rows["n"].to_numpy(), 2**32 - 1)
    return out


def signatures(docs: DataFrame, doc_id: str, text: str, words: int, least: float) -> DataFrame:
    """doc_id, node (of the text), sig and keys (posted shingles) of every row: wide, to be grouped by node at once."""
    counts, share = _slot_counts(docs, text, words), round(least * SCALE)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("node"), text_or_empty(text).cast("binary").alias("__text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            sigs, keys = [], []
            for t in batch.column(2):
                own = shingles(t.as_py(), words, known)
                first = len(own) + (-len(own) * share // SCALE) + 1
                sigs.append(signature(own))
                keys.append(own[np.lexsort((own, counts[_slots(own)]))[:first]].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "node", "sig", "keys"])

    return in_python(slim, run, f"doc_id {id_type}, node long, sig binary, keys array<long>")


class Signatures:
    """Signatures of many rows, and how far pairs of them are from the limit."""

    def __init__(self, sigs: list[bytes], share: int) -> None:
        raw = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(sigs), SIGNATURE + 4)
        self.odd = np.ascontiguousarray(raw[:, :SIGNATURE]).view(np.uint64)
        self.size = np.ascontiguousarray(raw[:, SIGNATURE:]).view(np.uint32)[:, 0].astype(np.int64)
        self.share = share

    def ratio(self, i: np.ndarray | int, j: np.ndarray) -> np.ndarray:
        """Least possible difference of each pair as a part of what is allowed: above 1 no pair is similar."""
        differ = np.maximum(np.bitwise_count(self.odd[i] ^ self.odd[j]).sum(axis=1, dtype=np.int64), abs(self.size[i] - self.size[j]))
        differ, allowed = differ * (SCALE + self.share), (self.size[i] + self.size[j]) * (SCALE - self.share)
        return np.where(differ <= allowed, differ / np.maximum(allowed, 1), np.inf)


CLOSEST, OTHER, LIST = range(3)


def _candidates(share: int, dense: int, across: bool) -> Callable:
    """Pairs (u < v) of each list with their kind; the rows come sorted by list (key, a, b, node, sig, root).

    Each row with the closest one before it is CLOSEST, all other pairs that pass are OTHER; a crowded
    list has a row (key, its blocks) of kind LIST instead of the latter. With ``across`` all pairs that
    pass and whose roots differ are OTHER. Lists of at most ``dense`` rows are worked off together.
    """
    Pairs = list[tuple[np.ndarray, np.ndarray]]

    def together(roots: np.ndarray, sigs: Signatures, rows: np.ndarray, left: np.ndarray, longest: int, best: np.ndarray, closest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Passing pairs of the short lists; ``best`` and ``closest`` are filled for each row."""
        for step in range(1, longest):
            i = rows[left[rows] >= step]
            i = i[roots[i] != roots[i + step]] if across else i
            if len(i):
                ratio = sigs.ratio(i, i + step)
                yield i[ratio <= 1], i[ratio <= 1] + step
                closer = ratio < best[i + step]
                best[i[closer] + step], closest[i[closer] + step] = ratio[closer], i[closer]

    def alone(roots: np.ndarray, sigs: Signatures, a: int, n: int, best: np.ndarray, closest: np.ndarray) -> Pairs | None:
        """Passing pairs of one long list, or none if it is crowded."""
        out: Pairs | None = []
        found = 0
        for r in range(a + 1, a + n):
            j = np.arange(a, r)
            j = j[roots[j] != roots[r]] if across else j
            if not len(j):
                continue
            ratio = sigs.ratio(r, j)
            at = int(np.argmin(ratio))
            best[r], closest[r] = ratio[at], j[at]
            if out is not None:
                own = j[ratio <= 1]
                out.append((own, np.full(len(own), r)))
                found += len(own)
                if not across and found > CROWDED * n:
                    out = None
        return out

    def rows_of(cols: list[np.ndarray], nodes: np.ndarray, roots: np.ndarray, sigs: Signatures, change: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.nonzero(change)[0]
        counts = np.diff(np.append(starts, len(nodes)))
        of = np.repeat(np.arange(len(starts)), counts)
        left = (starts + counts)[of] - np.arange(len(nodes)) - 1  # rows of the same list that follow
        best, closest = np.full(len(nodes), np.inf), np.zeros(len(nodes), np.int64)
        small = np.nonzero(counts[of] <= dense)[0]
        pairs: Pairs = list(together(roots, sigs, small, left, min(dense, int(counts.max(initial=1))), best, closest))
        crowded = []
        for k in np.nonzero(counts > dense)[0].tolist():
            own = alone(roots, sigs, int(starts[k]), int(counts[k]), best, closest)
            if own is None:
                crowded.append(int(starts[k]))
            else:
                pairs += own
        nothing = np.zeros(0, np.int64)
        i, j = (np.concatenate([nothing, *x]) for x in (zip(*pairs, strict=True) if pairs else ((), ())))
        found = np.nonzero(np.isfinite(best))[0] if not across else nothing
        x, y = nodes[np.concatenate((closest[found], i))], nodes[np.concatenate((found, j))]
        kinds = np.concatenate((np.full(len(found), CLOSEST, np.int32), np.full(len(i), OTHER, np.int32), np.full(len(crowded), LIST, np.int32)))
        u, v = np.concatenate((np.minimum(x, y), cols[0][crowded])), np.concatenate((np.maximum(x, y), cols[1][crowded].astype(np.int64) << 32 | cols[2][crowded]))
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(kinds)], names=["u", "v", "kind"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
            if held is None or not held.num_rows:
                continue
            cols = [held.column(c).to_numpy() for c in ("key", "a", "b")]
            change = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in cols], axis=0)))
            # the last list may go on in the next batch
            upto = held.num_rows if batch is None else int(np.nonzero(change)[0][-1])
            if not upto:
                continue
            done, held = held.slice(0, upto), held.slice(upto)
            sigs = Signatures(done.column("sig").to_pylist(), share)
            yield from rows_of(cols, done.column("node").to_numpy(), done.column("root").to_numpy(), sigs, change[:upto])

    return run


def checked(pairs: DataFrame, docs: DataFrame, text: str, words: int, share: int) -> DataFrame:
    """The pairs (u, v) of texts whose sets are similar enough."""
    wanted = broadcast_if_small(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    texts = docs.select(F.xxhash64(text_or_empty(text)).alias("node"), text_or_empty(text).cast("binary").alias("text")).join(wanted, "node", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            own = [shingles(t.as_py(), words, known).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["node", "own"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (a, b))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both * SCALE >= (len(x) + len(y) - both) * share)
            yield batch.filter(pa.array(ok, pa.bool_())).select(["u", "v"])

    # the pairs are kept, so what made them can go before the sets are dealt out
    free_scratch(docs.sparkSession)
    own = durable(in_python(texts.groupBy("node").agg(F.any_value("text").alias("text")), sets, "node long, own binary"))
    free_scratch(docs.sparkSession)
    both = pairs.join(own.select(F.col("node").alias("u"), F.col("own").alias("x")), "u").join(own.select(F.col("node").alias("v"), F.col("own").alias("y")), "v")
    return durable(in_python(both.select("u", "v", "x", "y"), check, "u long, v long"))


def similar_links(entries: DataFrame, docs: DataFrame, text: str, words: int, least: float, known: DataFrame, block: int = 1024, dense: int = 24) -> DataFrame:
    """Links (u < v) between entries (node, sig, keys) that join what all pairs of ``least`` or more join.

    ``known`` are such links that are found already: pairs that they join are not checked again.
    """
    spark, share = docs.sparkSession, round(least * SCALE)
    posted = entries.select("node", F.explode("keys").alias("key"))
    lists = durable(posting_lists(posted, block))
    free_scratch(spark)
    sigs = entries.select("node", "sig")

    def candidates(rows: DataFrame, across: bool) -> DataFrame:
        rows = rows.join(sigs, "node").repartition("key", "a", "b").sortWithinPartitions("key", "a", "b").select("key", "a", "b", "node", "sig", "root")
        return durable(in_python(rows, _candidates(share, dense, across), "u long, v long, kind int").groupBy("u", "v", F.col("kind") == LIST).agg(F.min("kind").alias("kind")).select("u", "v", "kind"))

    found = candidates(lists.withColumn("root", F.lit(0).cast("long")), False)
    pairs = lambda kind: found.where(F.col("kind") == kind).select("u", "v")

    def apart(some: DataFrame, roots: DataFrame) -> DataFrame:
        of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
        return some.join(of("u"), "u", "left").join(of("v"), "v", "left").where(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("u", "v")

    closest = durable(apart(pairs(CLOSEST), durable(components(known))))
    first = durable(known.unionByName(checked(closest, docs, text, words, share)))
    free_scratch(spark)
    roots = durable(components(first))
    again = apart(pairs(OTHER), roots)
    crowded = pairs(LIST).select(F.col("u").alias("key"), F.shiftright("v", 32).cast("int").alias("a"), F.col("v").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"))
    if not crowded.isEmpty():
        rooted = lists.join(crowded, ["key", "a", "b"], "left_semi").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = rooted.groupBy("key", "a", "b").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key", "a", "b")
        mixed = durable(mixed)
        if not mixed.isEmpty():
            more = candidates(rooted.join(mixed, ["key", "a", "b"], "left_semi"), True)
            again = again.unionByName(more.select("u", "v")).distinct()
    again = durable(again)
    if again.isEmpty():
        return first
    links = first.unionByName(checked(again, docs, text, words, share))
    free_scratch(spark)
    return links
