"""SimHash near-dedup with a byte-position inverted index and count filtering.

1. Fingerprint: every text is hashed shingle by shingle (XXH64 of the UTF-8 bytes, seed 42 and
   following); a bit is 1 if it is set in over half of the hashes. A text without words has
   fingerprint zero.
2. Index: documents with one fingerprint are one entry. An entry is posted under keys made of
   byte positions and the bytes there. A single byte has 256 values, so its posting lists grow with
   the square of the table; a posting key therefore takes several positions.
3. Count filter and check: in each posting list the shared positional bytes of a pair are tallied;
   a pair with fewer than ``min_shared`` is dropped, and what remains is kept if its Hamming
   distance is at most ``max_bits``. A pair at distance d shares at least (positions - d) bytes.
4. Links join entries to components; the smallest id of a component is its name.

With 8 positions, 3 bits and :func:`half_triples` the keys are exact: of any 5 shared positions
three lie in one half, and every triple of a half is a key. No fingerprint finds all pairs of a given
similarity, so :func:`keep_one_per_group` checks what they find and joins the shingle sets for the rest.

Posting lists longer than ``block`` are cut into blocks by hash, and each pair of blocks is checked
on its own, so a group of near copies that fills a third of the table is spread over tasks. Within
a block pair of more than ``dense`` entries only links that join parts not yet joined there are
returned: the components are the same and the rows stay in proportion to the entries, so no group
is expanded into all its pairs. Nothing is capped.

Null texts count as empty; null ids keep a row each and take the smallest id of their component
(null if it has none); repeated rows share a fingerprint; an empty table gives no rows; extra
columns are ignored by :func:`simhash_components` and kept by :func:`keep_one_per_group`. Texts of any length are
read whole; a task holds one text's shingle hashes.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.llm import set_join
from tallyferry.llm.links import components, posting_lists
from tallyferry.llm.shared import broadcast_if_small, durable, free_scratch, in_python, join_counted, text_or_empty

SEED = 42


def fingerprint(text: bytes, words: int, blocks: int) -> bytes:
    """SimHash of ``blocks`` x 64 bits of a UTF-8 text, little-endian words."""
    tokens = text.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not tokens:
        return bytes(8 * blocks)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    spans = list(zip(starts[:n].tolist(), ends[min(words, len(tokens)) - 1 :].tolist(), strict=True))
    out = []
    for seed in range(SEED, SEED + blocks):
        ones = np.zeros(64, np.int64)
        for k in range(0, n, 65536):
            hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans[k : k + 65536]], np.uint64)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * ones > n, bitorder="little").tobytes())
    return b"".join(out)


def half_triples(positions: int = 8) -> list[tuple[int, ...]]:
    """All triples within each half of the positions."""
    half = positions // 2
    return [t for part in (range(half), range(half, positions)) for t in itertools.combinations(part, 3)]


def fingerprints(docs: DataFrame, doc_id: str, text: str, words: int, blocks: int) -> DataFrame:
    """doc_id and fp (binary) of every row."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name != "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py(), words, blocks) for t in batch.column(batch.num_columns - 1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fps], names=[*batch.schema.names[:-1], "fp"])

    return in_python(slim, run, f"{schema}, fp binary")


def _roots(n: int, pairs: np.ndarray) -> list[int]:
    """Indices of the pairs that join parts not joined by the pairs before them."""
    parent = list(range(n))
    chosen = []
    for k, (a, b) in enumerate(pairs.tolist()):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a != b:
            parent[max(a, b)] = min(a, b)
            chosen.append(k)
    return chosen


def _pair_checker(width: int, min_shared: int, max_bits: int, dense: int) -> Callable:
    """Links of each posting list; the rows come sorted by list (columns key, a, b, node, fp)."""

    def passing(fps: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        differ = fps[i] ^ fps[j]
        shared = (differ == 0).sum(axis=1)
        return (shared >= min_shared) & (np.bitwise_count(differ).sum(axis=1) <= max_bits) & (shared < width)

    def links(nodes: np.ndarray, fps: np.ndarray, run: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        counts = np.bincount(run)
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        left = (starts + counts)[run] - np.arange(len(run)) - 1  # rows of the same list that follow
        small = counts[run] <= dense
        for step in range(1, int(min(dense, counts.max(initial=1)))):
            i = np.nonzero((left >= step) & small)[0]
            if not len(i):
                break
            ok = passing(fps, i, i + step)
            yield nodes[i[ok]], nodes[i[ok] + step]
        for k in np.nonzero(counts > dense)[0]:
            a, n = starts[k], counts[k]
            own = np.arange(a, a + n)
            found = []
            for r in range(n - 1):
                j = own[r + 1 :]
                ok = passing(fps, np.full(len(j), own[r]), j)
                found.append(np.stack([np.full(int(ok.sum()), r), j[ok] - a], axis=1))
            pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
            pairs = pairs[_roots(int(n), pairs)]
            yield nodes[a + pairs[:, 0]], nodes[a + pairs[:, 1]]

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
            fps = np.frombuffer(b"".join(done.column("fp").to_pylist()), np.uint8).reshape(upto, width)
            nodes = done.column("node").to_numpy()
            for u, v in links(nodes, fps, np.cumsum(change[:upto]) - 1):
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    return run


def near_links(entries: DataFrame, keys: list[tuple[int, ...]], width: int, min_shared: int, max_bits: int, block: int = 512, dense: int = 24) -> DataFrame:
    """Distinct links (u, v) between entries (node long, fp binary) at ``max_bits`` or less."""
    posted = entries.select(
        "node", "fp",
        F.explode(F.array(*[F.xxhash64(F.lit(k), *[F.substring("fp", p + 1, 1) for p in at]) for k, at in enumerate(keys)])).alias("key"),
    )
    return in_python(posting_lists(posted, block), _pair_checker(width, min_shared, max_bits, dense), "u long, v long").distinct()


def _lowest(entries: DataFrame, links: DataFrame) -> DataFrame:
    """``entries`` (node, low and more) with lowest, the least ``low`` of its component under the links (u < v)."""
    roots = durable(components(links))
    tops = roots.select(F.col("root").alias("node")).distinct().withColumn("root", F.col("node"))
    linked = entries.select("node", "low").join(roots.unionByName(tops), "node")
    lowest = linked.groupBy("root").agg(F.min("low").alias("lowest"))
    of_linked = linked.join(lowest, "root").select("node", "lowest")
    return entries.join(of_linked, "node", "left").withColumn("lowest", F.coalesce("lowest", "low"))


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id; exact for ``max_bits`` of 3 or less."""
    if not 0 <= max_bits <= 3:
        raise ValueError("8 byte positions with triple keys find pairs of up to 3 differing bits")
    prints = fingerprints(docs, doc_id, text, words, 1)
    # the bytes are little-endian; the digits show the number
    digits = F.lower(F.concat(*[F.hex(F.substring("fp", k, 1)) for k in range(8, 0, -1)]))
    prints = durable(prints.select("doc_id", "fp", digits.alias("fingerprint"), _as_long(digits).alias("node")))
    entries = durable(prints.groupBy("node").agg(F.min("doc_id").alias("low"), F.min("fp").alias("fp"), F.count(F.lit(1)).alias("n")))
    links = near_links(entries.select("node", "fp"), half_triples(8), 8, 8 - max_bits, max_bits)
    groups = _lowest(entries, links).select("node", "n", "lowest")
    return join_counted(prints.drop("fp"), groups, "node").select("doc_id", "fingerprint", F.col("lowest").alias("component_id"))


def _as_long(digits: Column) -> Column:
    """The 64 bits of 16 hex digits as a (signed) long."""
    high, low = (F.conv(F.substring(digits, a, 8), 16, 10).cast("long") for a in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def print_links(docs: DataFrame, text: str, words: int, least: float, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Links (u < v) between texts (by XXH64) that fingerprints find and whose sets are similar enough.

    Texts of one fingerprint are paired with the first of them, the first ones of fingerprints at
    ``max_bits`` or less with each other; every pair is then checked shingle by shingle.
    """
    spark = docs.sparkSession
    slim = docs.select(F.xxhash64(text_or_empty(text)).alias("node"), F.col(text).alias("text"))
    prints = durable(fingerprints(slim, "node", "text", shingle, 1).groupBy(F.col("doc_id").alias("of")).agg(F.any_value("fp").alias("fp")))
    entries = durable(prints.groupBy("fp").agg(F.min("of").alias("node"), F.count(F.lit(1)).alias("n")))
    near = near_links(entries.select("node", "fp"), half_triples(8), 8, 8 - max_bits, max_bits)
    same = join_counted(prints, entries.select("fp", "node", "n"), "fp").where("of <> node").select(F.col("node").alias("u"), F.col("of").alias("v"))
    pairs = durable(near.unionByName(same))
    free_scratch(spark)
    return set_join.checked(pairs, docs, text, words, round(least * set_join.SCALE))


def keep_one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, least: float = 0.8) -> DataFrame:
    """``docs``, columns unchanged, with one row of each group of near duplicates: the smallest id.

    Two texts are near duplicates if their sets of five-word shingles have a Jaccard similarity of
    ``least`` or more. Fingerprints, their index and the count filter give the first links
    (:func:`print_links`), each checked on the sets; what no fingerprint finds is added by a join of the
    sets between parts not linked yet (:mod:`tallyferry.llm.set_join`), so that no pair is lost. Rows are told
    apart by id and text: of rows that repeat both one stays, a null id stays only where its group
    has no other, and of several texts under one id each is judged by its own group.
    """
    free_scratch(docs.sparkSession)
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("node").alias("node"))
    known = print_links(docs, text, words, least)
    signed = set_join.signatures(docs, doc_id, text, words, least)
    entries = durable(signed.groupBy("node").agg(F.min(row).alias("low"), F.any_value("sig").alias("sig"), F.any_value("keys").alias("keys"), F.count(F.lit(1)).alias("n")))
    links = set_join.similar_links(entries, docs, text, words, least, known)
    lowest = _lowest(entries.drop("sig", "keys"), links).select("node", "n", "lowest")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("node"))
    judged = durable(join_counted(rows, lowest, "node"))
    free_scratch(docs.sparkSession)
    stays = (F.col("node") == F.col("lowest.node")) & F.col("doc_id").eqNullSafe(F.col("lowest.id"))
    dropped = judged.where(~stays).select(F.col("doc_id").alias("__sh_id"), F.col("node").alias("__sh_node")).distinct()
    many = judged.where(stays).groupBy(F.col("doc_id").alias("__sh_id"), F.col("node").alias("__sh_node")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    own = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*own, F.xxhash64(text_or_empty(text)).alias("__sh_hash"))
    same = lambda other: (keyed["__sh_hash"] == other["__sh_node"]) & keyed[f"`{doc_id}`"].eqNullSafe(other["__sh_id"])
    dropped = broadcast_if_small(dropped)
    one = keyed.join(dropped, same(dropped), "left_anti")
    many = durable(many)
    if many.isEmpty():
        return one.select(*own)
    twice = one.join(many, same(many), "left_semi").select(*own).dropDuplicates([doc_id, text])
    return one.join(many, same(many), "left_anti").select(*own).unionByName(twice)
