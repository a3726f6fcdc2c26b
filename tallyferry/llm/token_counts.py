"""Token counts with a digest cache.

A text's key is the SHA-256 of its normalised content and of the tokenizer's version. The cache is
a Parquet table of (tokenizer, digest, n_tokens) in the shared folder. A run joins the digests of
all documents to the cache, encodes one text for each distinct digest that misses, appends those
counts, and joins again. Copies, in one run or over many, are encoded once.

Normalisation must not change a count: a null text becomes empty. Where the vocabulary's own splitter
drops white space (:func:`drops_white_space`), runs of ASCII white space become one blank, so texts that
share a digest share their tokens, and words are counted on their own and kept in a table of bounded
size per task, as no token spans white space. All other vocabularies get whole texts as they are.

The only wide row that is shuffled is the text of a miss, once, with copies dropped on the map
side; the digests of a group of copies that fills a third of the table meet as one partial row per
task. Ids may be null or repeated (each row gets its count); an empty table gives no rows and
leaves the cache as it is; extra columns are ignored; texts of any length are counted whole. A failed run may leave counts of earlier
batches in the cache: they are right, and later runs use them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyferry.llm.bpe import blocks_of
from tallyferry.llm.shared import BLANK, durable, in_python, join_counted, text_or_empty

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    import sentencepiece
    import tokenizers

    library = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + library.encode()).hexdigest()


def batch_counter(path: str) -> Callable[[list[str]], list[int]]:
    """The library's token counts for a list of texts."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)] if texts else []
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)] if texts else []


def drops_white_space(path: str) -> bool:
    """Whether a vocabulary splits texts at white space and has no token for it.

    So it is where its first splitter removes all but the matches of a pattern, and no match holds
    white space of any kind, alone or beside letters, digits and signs.
    """
    if path.endswith(".model"):
        return False
    with open(path, encoding="utf-8") as f:
        step = json.load(f).get("pre_tokenizer") or {}
    while step.get("type") == "Sequence":
        step = (step.get("pretokenizers") or [{}])[0]
    if step.get("type") == "WhitespaceSplit":
        return True
    if step.get("type") != "Split" or step.get("behavior") != "Removed" or not step.get("invert"):
        return False
    pattern = step["pattern"].get("Regex") or regex.escape(step["pattern"].get("String", ""))
    probes = [f"{a}{w}{b}" for w in (" ", "\t", "\n", "\r\n", "  ", "\x0b", "\x0c") for a in ("", "a", "1", ".", "'") for b in ("", "b", "2", ",", "s")]
    return not any(c.isspace() for p in probes for m in regex.finditer(pattern, p) for c in m[0])


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"[{BLANK}]+", " ")


def _count_misses(path: str, by_word: bool, cache_entries: int = 100_000) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = batch_counter(path)
        known: dict[bytes, int] = {}
        for batch in batches:
            texts = batch.column(1)
            for a, b in blocks_of(texts):
                own = texts.slice(a, b - a).to_pylist()
                if by_word:
                    words = [t.encode().split() for t in own]
                    if len(known) > cache_entries:
                        known.clear()
                    new = list({w for ws in words for w in ws if w not in known})
                    known.update(zip(new, counter([w.decode() for w in new]), strict=True))
                    counts = [sum([known[w] for w in ws]) for ws in words]
                else:
                    counts = counter(own)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return count


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The cached counts of one tokenizer; none if the cache does not exist yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    exists = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    if not exists:
        return spark.createDataFrame([], CACHE_SCHEMA).drop("tokenizer")
    kept = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version)
    return kept.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, cache: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``; fills ``cache``."""
    spark = docs.sparkSession
    version = tokenizer_version(path)
    t = text_or_empty(text)
    by_word = drops_white_space(path)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(t).cast("long").alias("n_bytes"), (normalised(t) if by_word else t).alias("content"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("content", 256)))
    misses = rows.select("digest", "content").join(read_cache(spark, cache, version), "digest", "left_anti").dropDuplicates(["digest"])
    counted = in_python(misses, _count_misses(path, by_word), "digest binary, n_tokens long")
    counted.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    slim = durable(rows.drop("content"))
    uses = slim.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    out = join_counted(slim, uses.join(read_cache(spark, cache, version), "digest"), "digest")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
