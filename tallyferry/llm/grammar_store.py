"""Token ids in files of Re-Pair grammars.

Texts are dealt into ranges of document order, encoded, and laid end to end, each with an end id. A
task cuts its stream into blocks of at most ``block_ids`` ids and compresses each on its own: again and again
the frequent pairs of neighbouring symbols are replaced by nonterminals, until no pair is frequent.
A block keeps its terminals, the rules, each rule's expansion length, and the remaining symbols, so
any range of ids is found by the lengths and expanded alone (:meth:`Block.between`).

One file row is a shard: whole documents of together at least one block, its blocks as bytes, and the
documents' ids and lengths. The rows are written by Spark's Parquet writer to the shared folder, so that any store
that Spark reaches holds them; ``bases`` beside them has the ids before each range.

Block format, little-endian: ``RPG1``, symbol width in bytes (u32), counts of terminals, rules,
symbols and ids (u32), then the terminals (u32), the rules (two symbols each), expansion lengths
(u32) and the symbols. Symbols below the number of terminals stand for them, others for rules.

Defined results: a null or empty text has the end id only; rows with equal ids stand in the order of
their texts' hashes, then texts; null ids come first; repeated rows each have their place; an empty
table gives no rows; only the id and text columns are read. Very long texts are encoded and compressed
in parts, so a task holds one text, not its ids' grammar. A lost executor repeats its range.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyferry.llm.pieces import encoder_of
from tallyferry.llm.shared import in_python, shared_dir, text_or_empty

HEAD = struct.Struct("<4s5I")
MAGIC = b"RPG1"


def frequent_pairs(keys: np.ndarray, least: int, most: int) -> np.ndarray:
    """Up to ``most`` of the most frequent keys, ascending: those with at least an eighth of the top count."""
    ordered = np.sort(keys)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(starts, len(ordered)))
    top = int(counts.max())
    if top < least:
        return keys[:0]
    found = np.flatnonzero(counts >= max(least, top // 8))
    if len(found) > most:
        found = np.sort(found[np.argsort(-counts[found], kind="stable")[:most]])
    return ordered[starts[found]]


def every_other(at: np.ndarray) -> np.ndarray:
    """Of each stretch of consecutive positions the first, third, and so on: pairs that don't overlap."""
    new = np.concatenate(([True], at[1:] != at[:-1] + 1))
    order = np.arange(len(at))
    return at[(order - np.maximum.accumulate(np.where(new, order, 0))) % 2 == 0]


def re_pair(ids: np.ndarray, least: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terminals, rules (k x 2) and remaining symbols of a block; pairs rarer than ``least`` stay."""
    top = int(ids.max(initial=0))
    if top < 1 << 22:
        terminals = np.flatnonzero(np.bincount(ids, minlength=top + 1))
        place = np.zeros(top + 1, np.uint32)
        place[terminals] = np.arange(len(terminals))
        seq = place[ids]
    else:
        terminals, seq = np.unique(ids, return_inverse=True)
    # two-byte symbols as long as they last, so that a pair is one 32-bit key
    narrow = len(terminals) <= 60_000
    kind, pair, bits = (np.uint16, np.uint32, 16) if narrow else (np.uint32, np.uint64, 32)
    room = (1 << 16) - len(terminals) if narrow else 1 << 20
    seq = seq.astype(kind)
    rules: list[np.ndarray] = []
    n = 0
    while len(seq) >= 2 and n < room:
        keys = seq[:-1].astype(pair) << pair(bits) | seq[1:]
        chosen = frequent_pairs(keys, least, room - n)
        if not len(chosen):
            break
        lefts = np.zeros(len(terminals) + n, bool)
        rights = lefts.copy()
        lefts[chosen >> pair(bits)] = True
        rights[chosen & pair((1 << bits) - 1)] = True
        at = np.flatnonzero(lefts[seq[:-1]] & rights[seq[1:]])
        slots = np.zeros(len(seq), np.uint32)
        slots[at] = np.minimum(np.searchsorted(chosen, keys[at]), len(chosen) - 1)
        at = every_other(at[chosen[slots[at]] == keys[at]])
        seq[at] = (len(terminals) + n + slots[at]).astype(kind)
        left = np.ones(len(seq), bool)
        left[at + 1] = False
        seq = seq[left]
        rules.append(np.stack((chosen >> pair(bits), chosen & pair((1 << bits) - 1)), 1).astype(kind))
        n += len(chosen)
    return terminals.astype("<u4"), np.concatenate(rules) if rules else np.zeros((0, 2), kind), seq


def rule_lengths(rules: np.ndarray, n_terminals: int) -> np.ndarray:
    """Expansion length of each rule; a rule refers to terminals and earlier rules only."""
    out = [1] * n_terminals
    for a, b in rules.tolist():
        out.append(out[a] + out[b])
    return np.array(out[n_terminals:], "<u4")


def pack_block(ids: np.ndarray) -> bytes:
    terminals, rules, seq = re_pair(ids)
    lengths = rule_lengths(rules, len(terminals))
    head = HEAD.pack(MAGIC, seq.dtype.itemsize, len(terminals), len(rules), len(seq), len(ids))
    return b"".join((head, terminals.tobytes(), rules.tobytes(), lengths.tobytes(), seq.tobytes()))


class Block:
    """A packed block; gives any range of its ids without expanding the rest."""

    def __init__(self, data: bytes) -> None:
        magic, width, n_terminals, n_rules, n_symbols, self.n_ids = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of a grammar store")
        kind, at = f"<u{width}", HEAD.size
        self.terminals = np.frombuffer(data, "<u4", n_terminals, at)
        self.rules = np.frombuffer(data, kind, 2 * n_rules, at := at + 4 * n_terminals).reshape(-1, 2)
        lengths = np.frombuffer(data, "<u4", n_rules, at := at + 2 * width * n_rules)
        self.symbols = np.frombuffer(data, kind, n_symbols, at + 4 * n_rules)
        self.lengths = np.concatenate((np.ones(n_terminals, np.int64), lengths.astype(np.int64)))
        self.ends = np.cumsum(self.lengths[self.symbols])

    def opened(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols; every round opens all nonterminals by one rule."""
        n = len(self.terminals)
        while len(open_at := np.flatnonzero(symbols >= n)):
            rules = self.rules[symbols[open_at].astype(np.int64) - n]
            widths = np.ones(len(symbols), np.int64)
            widths[open_at] = 2
            symbols = np.repeat(symbols, widths)
            at = (np.cumsum(widths) - widths)[open_at]
            symbols[at], symbols[at + 1] = rules[:, 0], rules[:, 1]
        return self.terminals[symbols]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols, each distinct one opened once."""
        kinds = np.flatnonzero(np.bincount(symbols, minlength=len(self.lengths)))
        widths = self.lengths[kinds]
        starts = np.zeros(len(self.lengths), np.int64)
        starts[kinds] = np.cumsum(widths) - widths
        flat = self.opened(kinds.astype(self.symbols.dtype))
        many = self.lengths[symbols]
        return flat[np.repeat(starts[symbols] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]

    def between(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to before ``stop``."""
        if stop <= start:
            return self.terminals[:0]
        a, b = np.searchsorted(self.ends, [start, stop - 1], "right")
        before = int(self.ends[a - 1]) if a else 0
        return self.expand(self.symbols[a : b + 1])[start - before : stop - before]


SHARDS = "part int, shard int, before long, n_ids long, docs array<{}>, lengths array<long>, blocks array<binary>"


class ShardWriter:
    """Takes the ids of one range in order and gives its shards."""

    def __init__(self, part: int, kind: pa.DataType, block_ids: int) -> None:
        self.kind, self.block_ids = kind, block_ids
        self.part, self.shard, self.before = part, 0, 0
        self._begin()

    def _begin(self) -> None:
        self.docs, self.lengths, self.blocks, self.parts, self.held = [], [], [], [], 0

    def add(self, ids: bytes) -> None:
        self.parts.append(ids)
        self.held += len(ids) // 4
        if self.held >= self.block_ids:
            self._pack(self.held // self.block_ids * self.block_ids)

    def _pack(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self.parts), "<u4")
        self.blocks += [pack_block(ids[k : min(k + self.block_ids, n)]) for k in range(0, n, self.block_ids)]
        self.parts, self.held = [ids[n:].tobytes()], len(ids) - n

    def end_document(self, doc, n: int) -> Iterator[pa.RecordBatch]:
        self.docs.append(doc)
        self.lengths.append(n)
        if len(self.blocks) or self.held >= self.block_ids:
            yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.docs:
            self._pack(self.held)
            n_ids = sum(self.lengths)
            values = ((self.part, pa.int32()), (self.shard, pa.int32()), (self.before, pa.int64()), (n_ids, pa.int64()), (self.docs, pa.list_(self.kind)), (self.lengths, pa.list_(pa.int64())), (self.blocks, pa.list_(pa.binary())))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], names=["part", "shard", "before", "n_ids", "docs", "lengths", "blocks"])
            self.shard, self.before = self.shard + 1, self.before + n_ids
            self._begin()


def write_ids(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", ranges: int | None = None, block_ids: int = 500_000) -> None:
    """Write the ids of all texts, each with ``end_id``, in ascending order of document ids to ``folder``."""
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")).withColumn("h", F.xxhash64("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.repartitionByRange(ranges, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = encoder_of(vocabulary), None
        for batch in batches:
            if not len(batch):
                continue
            out = out or ShardWriter(TaskContext.get().partitionId(), batch.schema.field(0).type, block_ids)
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at, n = 0, 0
            for i, coded in encoder.parts(texts):
                if i != at:
                    out.add(end)
                    yield from out.end_document(ids[at], n + 1)
                    at, n = i, 0
                out.add(coded)
                n += len(coded) // 4
            out.add(end)
            yield from out.end_document(ids[at], n + 1)
        if out:
            yield from out.close()

    in_python(rows, compress, SHARDS.format(id_type)).write.option("compression", "zstd").parquet(f"{folder}/shards")
    # a row for each range; ids before a range are those of all ranges before it
    shards = docs.sparkSession.read.parquet(f"{folder}/shards")
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums.select("part", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base")).write.parquet(f"{folder}/bases")


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, and with ``with_ids`` ids: one row per document, from the files alone."""
    shards, bases = spark.read.parquet(f"{folder}/shards"), spark.read.parquet(f"{folder}/bases")
    rows = shards.join(F.broadcast(bases), "part").select((F.col("base") + F.col("before")).alias("start"), "docs", "lengths", "blocks")
    id_type = rows.schema["docs"].dataType.elementType.simpleString()

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field(1).type.value_type
            for row in range(len(batch)):
                start, docs, lengths = (batch.column(k)[row].as_py() for k in (0, 1, 2))
                blocks = batch.column(3)[row].values
                ends = np.cumsum(lengths)
                crcs, ids, at, doc = [0] * len(docs), [[] for _ in docs], 0, 0
                for data in blocks:
                    block = Block(data.as_py())
                    here = block.between(0, block.n_ids)
                    stop = at + block.n_ids
                    while doc < len(docs):
                        own = here[max(int(ends[doc]) - lengths[doc] - at, 0) : int(ends[doc]) - at]
                        crcs[doc] = zlib.crc32(own, crcs[doc])
                        if with_ids:
                            ids[doc].append(own)
                        if ends[doc] > stop:
                            break
                        doc += 1
                    at = stop
                columns = [pa.array(docs, kind), pa.array(start + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
                if with_ids:
                    columns.append(pa.array([np.concatenate(x) for x in ids], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return in_python(rows, expand, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))


def ids_between(spark: SparkSession, folder: str, start: int, stop: int) -> np.ndarray:
    """The ids at ``start`` to before ``stop`` of the whole store; only rules and symbols of that range are expanded."""
    shards, bases = spark.read.parquet(f"{folder}/shards"), spark.read.parquet(f"{folder}/bases")
    first = F.col("base") + F.col("before")
    rows = shards.join(F.broadcast(bases), "part").where((first < stop) & (first + F.col("n_ids") > start)).select(first.alias("first"), "blocks").orderBy("first")
    out = [np.zeros(0, "<u4")]
    for row in rows.toLocalIterator():
        at = row["first"]
        for data in row["blocks"]:
            block = Block(bytes(data))
            out.append(block.between(max(start - at, 0), min(stop - at, block.n_ids)))
            at += block.n_ids
    return np.concatenate(out)


def store_and_read(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the ids of all documents to a new folder of the shared one, and read them back from it."""
    folder = f"{shared_dir(docs.sparkSession)}/token_ids/{uuid.uuid4().hex}"
    write_ids(docs, vocabulary, folder)
    return read_ids(docs.sparkSession, folder)
