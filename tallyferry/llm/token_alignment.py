"""Alignment of two tokenizers' tokens over the same bytes, and how often each pair of ids is linked.

A merge of two ascending lists of token ends is a path of len(A) + len(B) steps; the path's point on any
diagonal is found by a binary search that looks at no other part of it. So the merge is divided
into pieces of equally many steps (:func:`merge_path`), which are worked off on their own: each gives its links (an A and a B
token whose bytes overlap; one for each stretch between neighbouring ends of either) and the places
where both end. Where a piece ends inside a group, the next piece's first links belong to it: groups
are stitched from the places where both end, over all pieces.

Texts are cut where neither tokenizer has a token across (``pieces``); a vocabulary that forbids this gets whole
texts. Distinct pieces new to a worker are laid end to end, aligned in one merge, and kept in a cache of bounded size.

How many documents hold a pair linked is known only after the whole table was read, so there are two passes over
a table of blocks in the shared folder. A block has, of about a megabyte of texts, the documents' figures and,
in 16 columns by A id, its pairs and each pair's documents. The first pass adds up documents by pair (partial sums
per task, then a shuffle of pairs). The second takes the columns in turn with their pairs' counts sent
to every task, as many columns at once as together have few enough pairs (``most_pairs``, counted first).

Defined results: null and empty texts, and texts whose bytes either tokenizer changes, have zeros and an empty
digest; ids may be null or repeated; repeated rows each give a row and count as a document each; an empty table
gives no rows; extra columns are ignored. Very long texts go through in parts of a megabyte and are put together
by sums, unions of pairs and a running hash. Lost executors repeat their own blocks.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.bpe import blocks_of
from tallyferry.llm.pieces import MARK, PieceCache, PieceEncoder, cut_after_blank, ids_bytes, marks_lead, segments, word_marked
from tallyferry.llm.shared import in_python, shared_dir, text_or_empty

BUCKETS = 16


def merge_path(a: np.ndarray, b: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending arrays crosses every ``steps``-th diagonal: elements of each before it.

    Equal elements stay in one piece: a crossing between them is moved behind both.
    """
    diagonals = np.append(np.arange(0, len(a) + len(b), steps), len(a) + len(b))
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (low < high).any():
        open_at = low < high
        i = (low + high) // 2
        # the path passes right of (i, d - i) if a[i] comes before b[d - i - 1]
        right = open_at & (a[np.minimum(i, len(a) - 1)] <= b[np.maximum(diagonals - i - 1, 0)])
        low, high = np.where(right, i + 1, low), np.where(open_at & ~right, i, high)
    i, j = low, diagonals - low
    tied = (i > 0) & (j < len(b)) & (a[np.maximum(i - 1, 0)] == b[np.minimum(j, len(b) - 1)])
    return i, j + tied


def align(a: np.ndarray, b: np.ndarray, steps: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers (A, B) of each link of two lists of token ends, and whether its group ends with it."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    ia, ib = merge_path(a, b, steps)
    links = []
    for k in range(len(ia) - 1):
        own_a, own_b = a[ia[k] : ia[k + 1]], b[ib[k] : ib[k + 1]]
        ends = np.union1d(own_a, own_b)
        # a link ends where the first of its two tokens ends; the other may end in a later piece
        in_a, in_b = np.searchsorted(own_a, ends), np.searchsorted(own_b, ends)
        both = (a[np.minimum(ia[k] + in_a, len(a) - 1)] == ends) & (b[np.minimum(ib[k] + in_b, len(b) - 1)] == ends)
        links.append((ia[k] + in_a, ib[k] + in_b, both))
    return tuple(np.concatenate(x) for x in zip(*links, strict=True))


class Aligner:
    """Aligned pieces of two vocabularies.

    A piece's value is (A tokens, B tokens, groups, its links' pairs as ``A << 32 | B``, its groups as text); the text is None
    for pieces whose bytes the second tokenizer changes.
    """

    def __init__(self, byte_path: str, piece_path: str, cache_entries: int = 120_000) -> None:
        self.first, self.second = PieceEncoder(byte_path, 100_000, plain=True), word_marked(piece_path)
        self.cuttable = marks_lead(self.second)
        model = self.second
        self.bytes_of = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(MARK, " ").encode() for i in range(model.get_piece_size())]
        self.widths = np.array([len(x) for x in self.bytes_of], np.int64)
        self.known = PieceCache(cache_entries)
        # an id as text with what follows it: A inside and at the end of its group, B likewise
        n_a, n_b = len(self.first.widths), len(self.bytes_of)
        self.signs = [f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends for i in range(n)]
        self.sign_at = (0, n_a, 2 * n_a, 2 * n_a + n_b)

    def cut(self, text: str) -> list[str]:
        return cut_after_blank(text) if self.cuttable else [text]

    def second_ids(self, words: list[str]) -> list[bytes]:
        """The second tokenizer's ids of each word after a blank, which it adds; nothing if their bytes are not the word's."""
        ids = self.second.encode(words, num_threads=1)
        get = self.bytes_of.__getitem__
        if b"".join(map(get, chain.from_iterable(ids))) == (" " + " ".join(words)).encode() and self._ends(ids) == [1 + len(w.encode()) for w in words]:
            return list(map(ids_bytes, ids))
        return [ids_bytes(own) if b"".join(map(get, own)) == b" " + w.encode() else b"" for w, own in zip(words, ids, strict=True)]

    def _ends(self, ids: list[list[int]]) -> list[int]:
        """Bytes of each word's tokens; no word is without tokens."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        if not sizes.all():
            return []
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum()))
        return np.add.reduceat(self.widths[flat], np.cumsum(sizes) - sizes).tolist()

    def group_texts(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> list[str]:
        """Each token of either side as text with its separator, in the order of groups, A before B."""
        of_a, of_b = (np.searchsorted(g, np.arange(len(x)), "right") for g, x in ((group_a, a), (group_b, b)))
        order = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[group_a - 1] = last_b[group_b - 1] = True
        at = self.sign_at
        order[np.arange(len(a)) + np.append(0, group_b)[of_a]] = a + np.where(last_a, at[1], at[0])
        order[np.arange(len(b)) + group_a[of_b]] = b + np.where(last_b, at[3], at[2])
        return list(map(self.signs.__getitem__, order.tolist()))

    def values(self, words: list[str]) -> list[tuple]:
        coded_a, coded_b = self.first.together(words), self.second_ids(words)
        good = [k for k, ids in enumerate(coded_b) if ids]
        out: list[tuple] = [(0, 0, 0, b"", None)] * len(words)
        if not good:
            return out
        a = np.frombuffer(b"".join([coded_a[k] for k in good]), "<u4").astype(np.int64)
        b = np.frombuffer(b"".join([coded_b[k] for k in good]), "<u4").astype(np.int64)
        of_a, of_b, both = align(np.cumsum(self.first.widths[a]), np.cumsum(self.widths[b]))
        data = (a[of_a] << 32 | b[of_b]).tobytes()
        # groups end at the same links in all: each takes the tokens since the last one
        group_a, group_b = of_a[both] + 1, of_b[both] + 1
        texts = self.group_texts(a, b, group_a, group_b)
        n_a, n_b = np.array([len(coded_a[k]) // 4 for k in good], np.int64), np.array([len(coded_b[k]) // 4 for k in good], np.int64)
        ends_a = np.cumsum(n_a)
        groups = np.diff(np.searchsorted(group_a, ends_a) + 1, prepend=0)
        links, tokens = (8 * np.searchsorted(of_a, ends_a)).tolist(), np.cumsum(n_a + n_b).tolist()
        p = t = 0
        for k, na, nb, ng, link, token in zip(good, n_a.tolist(), n_b.tolist(), groups.tolist(), links, tokens, strict=True):
            out[k] = (na, nb, ng, data[p:link], "".join(texts[t:token])[:-1])
            p, t = link, token
        return out


@functools.lru_cache(maxsize=1)
def aligner_of(byte_path: str, piece_path: str) -> Aligner:
    """One aligner for all tasks of a Python worker."""
    return Aligner(byte_path, piece_path)


def bucket_of(pairs: np.ndarray) -> np.ndarray:
    """A column for each pair; all pairs of one A id have the same."""
    return ((pairs >> 32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % BUCKETS


class Part:
    """Figures of some texts' parts: one row for each text."""

    def __init__(self, aligner: Aligner, pieces: list[list[str]]) -> None:
        words = list(set().union(*pieces))
        values = aligner.known.values(words, aligner.values, 5000)
        place = dict(zip(words, count(), strict=False)).__getitem__
        n = len(pieces)
        sizes = np.array([len(p) for p in pieces], np.int64)
        used = np.fromiter(map(place, chain.from_iterable(pieces)), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(n), sizes)
        *counts, linked, groups = zip(*values, strict=True) if values else [()] * 5
        figures = np.array(counts, np.int64)
        spoilt = np.array([g is None for g in groups], bool)
        self.good = np.bincount(doc, spoilt[used], n) == 0
        self.sums = np.stack([np.bincount(doc, figures[k, used], n).astype(np.int64) for k in range(3)], 1)
        self.texts = [";".join(map(groups.__getitem__, used[e - s : e].tolist())) if ok else "" for ok, s, e in zip(self.good, sizes, np.cumsum(sizes), strict=True)]
        # the pairs of each word, then those of each text, with how often
        widths = np.fromiter(map(len, linked), np.int64, len(linked)) // 8
        pairs, named = np.unique(np.frombuffer(b"".join(linked), np.int64), return_inverse=True)
        keep = self.good[doc]
        used, doc = used[keep], doc[keep]
        many = widths[used]
        self.sums = np.column_stack((self.sums, np.bincount(doc, many, n).astype(np.int64)))
        offsets = np.repeat(np.cumsum(widths)[used] - many - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        keys, self.times = np.unique(named[offsets] * n + np.repeat(doc, many), return_counts=True)
        self.pairs, self.docs = pairs[keys // n] if n else pairs, keys % max(n, 1)


def figures_of(aligner: Aligner, texts: list[str], most: int) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Sums, digests, and (pair, text, times) of some texts; long ones go through in parts."""
    short = Part(aligner, [aligner.cut(t) if 0 < len(t) <= most else [] for t in texts])
    sums = np.where(short.good[:, None], short.sums, 0)
    shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in short.texts]
    pairs, docs, times = [short.pairs], [short.docs], [short.times]
    for i, text in enumerate(texts):
        if len(text) <= most:
            continue
        total, sha, good, own = np.zeros(4, np.int64), hashlib.sha256(), True, [np.zeros((2, 0), np.int64)]
        for k, segment in enumerate(segments(text, most) if aligner.cuttable else [text]):
            part = Part(aligner, [aligner.cut(segment)])
            good &= bool(part.good[0])
            if not good:
                break
            total += part.sums[0]
            sha.update((";" if k else "").encode() + part.texts[0].encode())
            own.append(np.stack((part.pairs, part.times)))
        if good:
            sums[i], shas[i] = total, sha.hexdigest()
            found, named = np.unique(np.concatenate([x[0] for x in own]), return_inverse=True)
            pairs.append(found)
            docs.append(np.full(len(found), i))
            times.append(np.bincount(named, np.concatenate([x[1] for x in own]), len(found)).astype(np.int64))
    return sums, shas, np.concatenate(pairs), np.concatenate(docs), np.concatenate(times)


DIGESTS = ("n_a", "n_b", "n_groups", "n_links")


def write_blocks(docs: DataFrame, byte_path: str, piece_path: str, folder: str, doc_id: str, text: str, most: int) -> None:
    """One row per block: its documents' figures; for each bucket its pairs, their numbers of documents, those documents, and the times."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, part, number = aligner_of(byte_path, piece_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in blocks_of(batch.column(1)):
                sums, shas, pairs, docs, times = figures_of(aligner, batch.column(1).slice(a, b - a).to_pylist(), most)
                ids = batch.column(0).slice(a, b - a)
                names = ["block", "docs", *DIGESTS, "shas"]
                columns = [pa.array([part << 32 | number], pa.int64()), pa.ListArray.from_arrays([0, len(ids)], ids)]
                columns += [pa.array([sums[:, k]], pa.list_(pa.int64())) for k in range(4)] + [pa.array([shas])]
                order = np.lexsort((docs, pairs))
                pairs, docs, times = pairs[order], docs[order], times[order]
                bucket = bucket_of(pairs)
                for k in range(BUCKETS):
                    own = bucket == k
                    found, uses = np.unique(pairs[own], return_counts=True)
                    names += [f"pairs{k}", f"uses{k}", f"docs{k}", f"times{k}"]
                    columns += [pa.array([x.astype(kind).tobytes()], pa.binary()) for x, kind in ((found, "<i8"), (uses, "<u4"), (docs[own], "<u4"), (times[own], "<u4"))]
                number += 1
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"block long, docs array<{id_type}>, {', '.join(f'{c} array<long>' for c in DIGESTS)}, shas array<string>, "
    schema += ", ".join(f"pairs{k} binary, uses{k} binary, docs{k} binary, times{k} binary" for k in range(BUCKETS))
    in_python(rows, blocks, schema).write.option("compression", "zstd").parquet(folder)


def added_up(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, named = np.unique(np.concatenate(pairs), return_inverse=True)
    return found, np.bincount(named, np.concatenate(counts), len(found)).astype(np.int64)


def count_pairs(blocks: DataFrame, at_once: int = 2_000_000) -> DataFrame:
    """pair, n, bucket: how many documents hold each pair linked."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, held = [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in added_up(pairs, counts)], names=["pair", "n"])

        for batch in batches:
            for k in range(0, 2 * BUCKETS, 2):
                pairs += [np.frombuffer(x.as_py(), "<i8") for x in batch.column(k)]
                counts += [np.frombuffer(x.as_py(), "<u4") for x in batch.column(k + 1)]
            held += sum(map(len, pairs[-BUCKETS * len(batch) :]))
            if held > at_once:
                found, sums = added_up(pairs, counts)
                pairs, counts, held = [found], [sums], len(found)
                if held > at_once // 2:
                    yield row()
                    pairs, counts, held = [], [], 0
        if pairs:
            yield row()

    slim = blocks.select(*[f"{c}{k}" for k in range(BUCKETS) for c in ("pairs", "uses")])
    sums = in_python(slim, partial, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))

    def with_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket_of(batch.column(0).to_numpy()), pa.int32())], names=["pair", "n", "bucket"])

    return in_python(sums, with_bucket, "pair long, n long, bucket int")


def groups_of(sizes: dict[int, int], most: int) -> list[list[int]]:
    """Buckets in order, as many together as have ``most`` pairs; a larger one stands alone."""
    out: list[list[int]] = [[]]
    held = 0
    for k in range(BUCKETS):
        if out[-1] and held + sizes.get(k, 0) > most:
            out.append([])
            held = 0
        out[-1].append(k)
        held += sizes.get(k, 0)
    return out


def weigh(blocks: DataFrame, counts: DataFrame, buckets: list[int]) -> DataFrame:
    """block, at, n_best, count_sum of the links in some buckets."""
    spark = blocks.sparkSession
    table = counts.where(F.col("bucket").isin(buckets)).select("pair", "n").toArrow()
    pairs, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    # the pairs of an A id stand together
    starts = np.flatnonzero(np.diff(pairs >> 32, prepend=-1))
    best = n == np.repeat(np.maximum.reduceat(n, starts), np.diff(np.append(starts, len(n)))) if len(n) else n == 0
    shared = spark.sparkContext.broadcast((pairs, n, best))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for batch in batches:
            for row in range(len(batch)):
                size = batch.column(1)[row].as_py()
                totals = np.zeros((2, size), np.int64)
                for k in range(len(buckets)):
                    own, uses, docs, times = (np.frombuffer(batch.column(2 + 4 * k + c)[row].as_py(), kind) for c, kind in enumerate(("<i8", "<u4", "<u4", "<u4")))
                    slot = np.repeat(np.searchsorted(pairs, own), uses)
                    # exact: whole numbers below 2^53
                    totals[0] += np.bincount(docs, times * best[slot], size).astype(np.int64)
                    totals[1] += np.bincount(docs, times * n[slot], size).astype(np.int64)
                at = np.arange(size)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, batch.column(0)[row].as_py())), pa.array(at), pa.array(totals[0]), pa.array(totals[1])], names=["block", "at", "n_best", "count_sum"])

    slim = blocks.select("block", F.size("docs").alias("size"), *[f"{c}{k}" for k in buckets for c in ("pairs", "uses", "docs", "times")])
    return in_python(slim, sums, "block long, at long, n_best long, count_sum long")


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, doc_id: str = "doc_id", text: str = "text", most_pairs: int = 1_000_000, most_chars: int = 1_000_000) -> DataFrame:
    """One row per document: its numbers of tokens, groups and links, its best links, their counts, and the digest of its groups."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/token_alignment/{uuid.uuid4().hex}"
    write_blocks(docs, byte_path, piece_path, f"{folder}/blocks", doc_id, text, most_chars)
    blocks = spark.read.parquet(f"{folder}/blocks")
    count_pairs(blocks).write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    sizes = {r["bucket"]: r["n"] for r in counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    weighed = [weigh(blocks, counts, own) for own in groups_of(sizes, most_pairs)]
    total = functools.reduce(DataFrame.unionByName, weighed)
    fields = ["docs", *DIGESTS, "shas"]
    rows = blocks.select("block", F.posexplode(F.arrays_zip(*fields)).alias("at", "d"))
    rows = rows.select("block", F.col("at").cast("long").alias("at"), F.col("d.docs").alias("doc_id"), *[F.col(f"d.{c}").alias(c) for c in DIGESTS], F.col("d.shas").alias("groups_sha256"))
    if len(weighed) > 1:
        total = total.groupBy("block", "at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.join(total, ["block", "at"]).select("doc_id", *DIGESTS, "n_best", "count_sum", "groups_sha256")
