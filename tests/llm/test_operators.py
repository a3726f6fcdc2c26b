"""The numbered operators against brute force, on small tables with awkward rows."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

os.environ["TOKENIZERS_PARALLELISM"] = "false"

from tallyferry.llm import bpe, chat, decontam, katz, quality_model, quality_rules, sharding, simhash, token_counts  # noqa: E402
from tallyferry.llm.entries import vocabulary  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, node string, n string"
LONG = " ".join(f"word{i % 700}" for i in range(9000))
PLAIN = " ".join(f"alpha{i} beta{i * 7 % 31} gamma" for i in range(40))


@pytest.fixture(scope="module")
def docs(spark):
    texts = [PLAIN, PLAIN, PLAIN + " tail", "", None, "   \n", "one", "a b c " * 60, LONG, "Licensed under the MIT license. CC BY-NC 4.0", "x <|endoftext|> y", "# * $ % & " * 30]
    rows = [(i, t, "en", "https://Host.example/a" if i % 2 else None, None, "clash", "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[0], (None, "no id at all", None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_simhash_components(spark, docs, nothing):
    def own(t):
        w = (t or "").encode().lower().split()
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = [(r["doc_id"], own(r["text"])) for r in docs.collect()]
    part = list(range(len(rows)))
    for _ in rows:
        for i, (_, a) in enumerate(rows):
            for j, (_, b) in enumerate(rows):
                if (a ^ b).bit_count() <= 3:
                    part[i] = part[j] = min(part[i], part[j])
    low = {}
    for p, (d, _) in zip(part, rows, strict=True):
        if d is not None:
            low[p] = min(low.get(p, d), d)
    want = sorted(((d, f"{f:016x}", low.get(p)) for p, (d, f) in zip(part, rows, strict=True)), key=repr)
    assert sorted((tuple(r) for r in simhash.simhash_components(docs).collect()), key=repr) == want
    assert simhash.simhash_components(nothing).count() == 0


def test_simhash_long_lists_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, 8, dtype=np.uint8)
    fps = {base.tobytes()}
    while len(fps) < 150:
        bits = np.zeros(64, np.uint8)
        bits[rng.choice(64, rng.integers(1, 4), replace=False)] = 1
        fps.add((base ^ np.packbits(bits)).tobytes())
    entries = spark.createDataFrame([(i, bytearray(f)) for i, f in enumerate(sorted(fps))], "node long, fp binary")
    links = simhash.near_links(entries, simhash.half_triples(), 8, 5, 3, block=40, dense=6)
    assert {r["root"] for r in simhash.components(links).collect()} == {0}


def test_keep_one_per_group(docs, nothing):
    kept = [r["doc_id"] for r in simhash.keep_one_per_group(docs).collect()]
    assert 0 in kept and 1 not in kept and kept.count(0) == 1 and None in kept
    assert simhash.keep_one_per_group(docs).columns == docs.columns
    assert simhash.keep_one_per_group(nothing).count() == 0


def jaccard(a, b):
    runs = []
    for t in (a, b):
        w = t.encode().lower().split()
        runs.append({b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    return len(runs[0] & runs[1]) / len(runs[0] | runs[1])


def test_keep_one_per_group_equals_all_pairs(spark):
    """Pairs about a similarity of 0.8, on both sides and at it, and a group of copies longer than a list's dense part."""
    rng = np.random.default_rng(5)
    texts = []
    for k, n in enumerate([12, 40, 40, 90, 90, 90, 200, 200, 400, 400] * 6):
        base = [f"t{k}w{x}" for x in rng.integers(0, 10**6, n)]
        texts.append(" ".join(base))
        for share in (0.1, 0.11, 0.12):
            other = [*base]
            other[: int(n * share)] = [f"n{x}" for x in range(int(n * share))]
            texts.append(" ".join(other))
    exact = [f"e{x}" for x in range(22)]  # 18 runs of five words; two changed ends leave 16 of 20
    texts += [" ".join(exact), " ".join(["x", *exact[1:-1], "y"])]
    base = [f"c{x}" for x in range(100)]
    for _ in range(60):
        other = [*base]
        for x in rng.choice(100, 2, replace=False):
            other[x] = f"z{rng.integers(10**9)}"
        texts.append(" ".join(other))
    part = list(range(len(texts)))
    for i, a in enumerate(texts):
        for j in range(i + 1, len(texts)):
            if (i // 4 == j // 4 or i >= 240) and jaccard(a, texts[j]) >= 0.8:
                low, high = sorted((part[i], part[j]))
                part = [low if x == high else x for x in part]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.keep_one_per_group(table).collect()} == set(part)


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", r"[\INST] [\\/INST] <\s>", "<<SYS>> <<</SYS>>", "ends with <", "[", "", None, "é😀\nx"]
    rows = [(c, k, role, t) for c in range(3) for k, (role, t) in enumerate(zip(["user", "assistant", "system", "tool]x", None] * 2, hard, strict=False))]
    out = chat.format_conversations(spark.createDataFrame([*rows, rows[0]], "conv_id long, turn long, role string, text string")).collect()
    for r in out:
        want = sorted([(k, role or "", t or "") for c, k, role, t in [*rows, rows[0]] if c == r["conv_id"]])
        assert [(t["role"], t["text"]) for t in r["parsed"]] == [(a, b) for _, a, b in want]
    assert chat.chat_digests(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_escapes_every_control_string(spark):
    rows = [(None, 0, "user", "a <s> b [INST] c", "x", "y"), (None, 1, "assistant", "[INST]x <<SYS>>", "x", "y"), (1, None, "system", r"[\\/TURN] [TURN=6A]", None, None), (1, 5, "odd]role", "w" * 300_000 + "[/INST]", None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, parsed string")
    got = {r["conv_id"]: r for r in chat.format_conversations(table).collect()}
    assert got[None]["formatted"] == r"[INST]a <\s> b [\INST] c[/INST]<s>[\INST]x <<\SYS>></s>"
    assert [tuple(t) for t in got[None]["parsed"]] == [("user", rows[0][3]), ("assistant", rows[1][3])]
    assert [tuple(t) for t in got[1]["parsed"]] == [("system", rows[2][3]), ("odd]role", rows[3][3])]


def test_bpe_equals_library(docs, nothing):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = bpe.bpe_round_trip(docs, path, with_ids=True).collect()
    texts = [r["text"] or "" for r in docs.collect()]
    assert [r["ids"] for r in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [r["decoded"] for r in got] == texts
    assert bpe.bpe_round_trip(nothing, path).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_and_cache(spark, docs, nothing, tmp_path, name):
    path, cache = vocabulary(name), f"file://{tmp_path}/cache"
    count = token_counts.batch_counter(path)
    want = sorted(count([r["text"] or "" for r in docs.collect()]))
    for _ in range(2):
        assert sorted(r["n_tokens"] for r in token_counts.count_tokens(docs, path, cache).collect()) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count()
    assert token_counts.count_tokens(nothing, path, cache).count() == 0


def katz_by_hand(rows, k=5):
    """Scores of (doc_id, text) rows from plain counts, and whether each context adds up to one."""
    ids = [str("" if d is None else d) for d, _ in rows]
    held = [zlib.crc32(i.encode()) % 7 == 2 for i in ids]
    texts = [[*(t or "").encode().lower().split(), b"\t e"] for _, t in rows]
    pairs, words = Counter(), Counter()
    for t, out in zip(texts, held, strict=True):
        if not out:
            words.update(t)
            pairs.update(zip([b"\t s", *t], t, strict=False))
    scale = words.total() + len(words) + 1
    d = katz.good_turing(Counter(pairs.values()), k)
    full, mass, low = Counter(), Counter(), Counter()
    part = lambda n: d[n] * n if n in d else n - katz.TAIL
    for (h, w), n in pairs.items():
        full[h] += n
        mass[h] += part(n)
        low[h] += (words[w] + 1) / scale
    alpha = {h: (1 - mass[h] / full[h]) / (1 - low[h]) for h in full}
    # every context: its seen words, and its weight for all others and the unseen one
    assert all(x > 0 for x in alpha.values())
    assert all(abs(mass[h] / full[h] + alpha[h] * (1 - low[h]) - 1) < 1e-9 for h in full)
    p = lambda h, w: part(pairs[h, w]) / full[h] if pairs[h, w] else alpha.get(h, 1.0) * (words[w] + 1) / scale
    scores = [sum(np.log10(p(h, w)) for h, w in zip([b"\t s", *t], t, strict=False)) for t in texts]
    base = [sum(np.log10((words[w] + 1) / scale) for w in t) for t in texts]
    known = [sum(w in words for w in t) for t in texts]
    return [(out, len(t), n, words.total(), b, s) for out, t, n, b, s in zip(held, texts, known, base, scores, strict=True)]


def test_katz_equals_brute_force(spark, docs, nothing):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for table, part in ((docs, 3_000_000), (real, 3_000_000), (real, 20_000)):
        rows = [(r["doc_id"], r["text"]) for r in table.collect()]
        want = sorted(((d, *w) for (d, _), w in zip(rows, katz_by_hand(rows), strict=True)), key=lambda r: (str(r[0]), r[2]))
        got = sorted((tuple(r) for r in katz.score_texts(table, part_tokens=part, least_parts=3).collect()), key=lambda r: (str(r[0]), r[2]))
        assert [r[:5] for r in got] == [r[:5] for r in want]
        np.testing.assert_allclose(np.array([r[5:] for r in got], float), np.array([r[5:] for r in want], float), rtol=1e-9)
    assert katz.score_texts(nothing, least_parts=3).count() == 0


def test_shards(docs, nothing):
    rows = sharding.assign_shards(docs, shards=3).collect()
    assert len(rows) == docs.count()
    for s in range(3):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert len({r["shard"] for r in rows if r["doc_id"] in (0, 1)}) == 1
    assert sharding.assign_shards(nothing).count() == 0
    assert sharding.lpt([(1, 5), (2, 4), (3, 3), (4, 2)], 2) == {1: 0, 2: 1, 3: 1, 4: 0}


def test_leaks(spark, docs, nothing):
    item = "Which river crosses the northern plain before the old stone bridge. The silver river crosses it twice."
    items = spark.createDataFrame([(1, item), (2, "Nothing of this stands anywhere. Not here nor there either."), (3, None)], "item_id long, text string")
    held = spark.createDataFrame([(5, PLAIN + " " + item.upper() + " " + PLAIN), (6, PLAIN), (7, None)], "doc_id long, text string")
    found = decontam.find_leaks(held, items).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(5, 1)] and found[0]["question_overlap"] == 1.0
    assert sorted(r["doc_id"] for r in decontam.drop_leaking(held, items).collect()) == [6, 7]
    assert decontam.find_leaks(nothing, items).count() == 0 and decontam.find_leaks(docs, items.limit(0)).count() == 0


def test_leaks_with_terms_that_java_cuts_otherwise(spark):
    item = "The field north of the mill holds 10\u00a0000 rows of barley. Each row takes 12 m\u00b2 of ground."
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    held = spark.createDataFrame([(5, f"{PLAIN} {item} {PLAIN}"), (6, PLAIN)], "doc_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(held, items).collect()] == [(5, 1)]


def test_host_rules(docs, nothing):
    rows = quality_rules.document_rules(docs).collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert (by[7]["n_words"], by[7]["n_repeat_words"], by[7]["base_failed"]) == (180, 180, True)
    assert by[4]["n_words"] == 0 and by[4]["base_failed"] and by[11]["n_symbols"] == 150
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.keep_good(nothing).count() == 0 and quality_rules.document_rules(nothing).count() == 0


def test_classifier_on_held_out_labels(spark, docs, nothing):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    train = labels.where("doc_id % 5 <> 0")
    scores = {r["doc_id"]: r["kept"] for r in quality_model.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), train).collect()}
    held = [r for r in labels.where("doc_id % 5 = 0 and toxic = 0").collect()]
    assert np.mean([scores[r["doc_id"]] == (r["quality"] == 1) for r in held]) > 0.9
    empty = labels.limit(0)
    assert all(r["kept"] for r in quality_model.score_documents(docs, empty).collect())
    assert quality_model.score_documents(nothing, labels).count() == 0


def test_classifier_rejects_held_out_toxic_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    train = labels.where("doc_id % 5 <> 0")
    scores = {r["doc_id"]: r["kept"] for r in quality_model.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), train).collect()}
    held = labels.where("doc_id % 5 = 0").collect()
    share = lambda rows: np.mean([scores[r["doc_id"]] for r in rows])
    figures = share([r for r in held if r["toxic"] == 1]), share([r for r in held if r["toxic"] == 0 and r["quality"] == 1]), share([r for r in held if r["toxic"] == 0 and r["quality"] == 0])
    print("kept of toxic, good, junk:", figures)
    assert figures[0] < 0.1 and figures[1] > 0.95 and figures[2] < 0.05


def test_bags_are_packed_without_loss():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, quality_model.WIDE + 1, n)) for n in (0, 1, 3, 40, 9000, 0)] + [np.array([0, 65534, 131069, 262139, quality_model.WIDE])]
    places, lengths = quality_model.unpacked([quality_model.packed(x) for x in sets])
    assert lengths.tolist() == [len(x) for x in sets] and places.tolist() == np.concatenate(sets).tolist()
