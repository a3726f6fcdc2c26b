"""Operators and the pipeline against plain versions of their contracts, on small tables with awkward rows."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyferry.llm import decontam, quality_model, quality_rules, sharding
from tallyferry.llm.entries import vocabulary

PROSE = [" ".join(f"{c}{i * k % 97}" for i in range(90)) for k, c in enumerate("abcdefgh", 3)]


# ---- shards


@pytest.mark.parametrize("bundles,heavy", [(16384, 64), (8, 1)])
def test_shards_keep_groups_and_balance(spark, bundles, heavy):
    rows = [(i if i % 9 else None, "x" * (i * 37 % 900) + f"é{i % 60}") for i in range(400)] + [(7, None), (7, ""), (7, "same")] + [(500 + i, "same") for i in range(200)]
    table = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, grp string, slot int")
    got = sharding.assign_shards(table, shards=5, bundles=bundles, heavy_per_shard=heavy).collect()
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    of_text: dict = {}
    for r in got:
        assert of_text.setdefault(r["text_crc32"], r["shard"]) == r["shard"] and r["grown_shard"] is None and r["law"] == "bytes"
    loads = [sum(r["size"] for r in got if r["shard"] == s) for s in range(5)]
    for s in range(5):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    groups = Counter()
    for (_, size, crc), n in want.items():
        groups[crc] += size * n
    # least-loaded scheduling: no shard is above the mean by more than one item
    if bundles > 1000:
        assert max(loads) - sum(loads) / 5 <= max(groups.values())


# ---- decontamination


def leaks_by_hand(docs, items, min_share=0.5, min_overlap=0.6, gram=3):
    """Plain BM25 of every item over every passage of every document, then the overlap check."""
    terms = [(i, t, decontam.terms_of(t or "")) for i, t in items]
    terms = [x for x in terms if x[2]]
    df = Counter(t for _, _, ts in terms for t in set(ts))
    mean = sum(len(ts) for _, _, ts in terms) / max(len(terms), 1)
    step = max((len(ts) for _, _, ts in terms), default=1)
    out = set()
    for doc, text in docs:
        words = (text or "").lower().split()
        for p in range(max(-(-len(words) // step) - 1, 1)):
            passage = decontam.terms_of(" ".join(words[p * step : (p + 2) * step]))
            have = set(passage)
            for item, itext, ts in terms:
                norm = decontam.K1 * (1 - decontam.B + decontam.B * len(ts) / mean)
                own = {t: math.log(1 + (len(terms) - df[t] + 0.5) / (df[t] + 0.5)) * c * (decontam.K1 + 1) / (c + norm) for t, c in Counter(ts).items()}
                if sum(x for t, x in own.items() if t in have) / sum(own.values()) < min_share - 1e-9:
                    continue
                shares = []
                for part in decontam.question_and_answer(itext):
                    n = min(gram, len(part))
                    grams = decontam.ngrams(part, gram)
                    there = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
                    shares.append(len(grams & there) / len(grams) if grams else 1.0)
                if min(shares) >= min_overlap:
                    out.add((doc, item))
    return out


def test_leaks_equal_plain_bm25(spark):
    rng = np.random.default_rng(11)
    word = lambda: f"w{rng.zipf(1.4) % 400}"
    items = [(i, " ".join(word() for _ in range(rng.integers(6, 30))) + ". The answer is " + " ".join(word() for _ in range(5)) + ".") for i in range(60)]
    items += [(60, items[3][1]), (3, items[3][1]), (None, items[4][1]), (61, "..."), (62, None), (63, "one")]  # equal items, a repeated and a null id, none and one term
    docs = []
    for d in range(40):
        words = [word() for _ in range(int(rng.integers(0, 260)))]
        for _ in range(int(rng.integers(0, 4))):
            item = items[int(rng.integers(0, 60))][1].split()
            cut = item[: max(3, int(len(item) * rng.choice([0.6, 1.0, 1.0])))]
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = [w.upper() + "," if rng.random() < 0.2 else w for w in cut]
        docs.append((d, " ".join(words)))
    docs += [docs[1], (None, docs[2][1]), (99, None), (98, "")]
    table = spark.createDataFrame([(d, t, "c", 0.0) for d, t in docs], "doc_id long, text string, item_id string, score double")
    tests = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")
    want = leaks_by_hand(docs, items)
    assert len(want) > 15
    for size in (2_000_000, 1500):  # one pass, several
        assert {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(table, tests, block_bytes=size).collect()} == want
    kept = decontam.drop_leaking(table, tests)
    assert kept.columns == table.columns
    leaking = {d for d, _ in want}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(d for d, _ in docs if d not in leaking)
    names = spark.createDataFrame([("q1", items[0][1])], "item_id string, text string")
    assert {r["item_id"] for r in decontam.find_leaks(spark.createDataFrame([(1, items[0][1])], "doc_id long, text string"), names).collect()} == {"q1"}


# ---- host rules


def test_a_bad_host_loses_its_good_documents(spark):
    bad, good = "a b c " * 60, PROSE[0]
    rows = [(i, bad if i % 10 else good, "https://Bad.example/x") for i in range(60)] + [(100 + h * 20 + i, PROSE[(h + i) % 8], f"h{h}") for h in range(10) for i in range(20)] + [(900, good, None), (901, None, "h0"), (902, bad, "h1")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    hosts = {}
    for _, t, s in rows:
        host = "bad.example" if s and "Bad" in s else s or ""
        n, f = hosts.get(host, (0, 0))
        hosts[host] = n + 1, f + (t == bad)
    rates = [f / n for n, f in hosts.values()]
    m, v = np.mean(rates), np.var(rates)
    k = min(max(m * (1 - m) / v - 1, 1), 1e6)
    rejected = {h for h, (n, f) in hosts.items() if (f + m * k) / (n + k) > 0.5}
    assert rejected == {"bad.example"}
    got = {r["doc_id"]: r for r in quality_rules.document_rules(table).collect()}
    assert {d for d, r in got.items() if r["host_rejected"]} == {d for d, _, s in rows if s and "Bad" in s}
    want = {d for d, t, s in rows if t not in (bad, None) and not (s and "Bad" in s)}
    assert {d for d, r in got.items() if r["kept"]} == want
    assert {r["doc_id"] for r in quality_rules.keep_good(table).collect()} == want


def test_rules_are_kept_without_broadcasting(spark, monkeypatch):
    table = spark.createDataFrame([(1, PROSE[0], "h"), (1, PROSE[0], "h"), (None, PROSE[1], None), (3, "short", "h"), (4, "a b c " * 60, "g"), (5, None, "g")], "doc_id long, text string, source string")
    want = sorted(map(tuple, quality_rules.keep_good(table).collect()), key=repr)
    monkeypatch.setattr(quality_rules, "few", lambda df: False)
    assert sorted(map(tuple, quality_rules.keep_good(table).collect()), key=repr) == want and len(want) == 3


# ---- classifier


AWKWARD = [(i, PROSE[i % 8] + (" spam spam spam" if i % 2 else " kind words here"), "en", "s") for i in range(60)] + [(60, None, None, None), (61, "", "en", "s"), (62, "w " * 60_000, "en", "s"), (None, "no id", "de", "t"), (5, "repeated id", "en", "s")]


def labelled(spark, rows):
    docs = spark.createDataFrame([(*r, "c", "c") for r in AWKWARD], "doc_id long, text string, lang string, source string, key string, bag string")
    return docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_of_the_classifier_equal_plain_counts(spark):
    docs, labels = labelled(spark, [(i, 1 - i % 2, 0) for i in range(63)] + [(5, None, 1), (None, 1, 0)])
    featured = quality_model.with_features(docs, labels, "doc_id", "text", "lang", "source")
    counts = quality_model._totals(featured, None, 0.99, 0.3)
    want = {c: Counter() for c in quality_model.CLASSES}
    documents = Counter()
    folds = {r["doc_id"]: r["fold"] for r in featured.select("doc_id", "fold").collect()}
    for d, text, _, _ in AWKWARD:
        if d is None or folds[d] == quality_model.HELD_OUT:
            continue
        good = quality_model.GOOD if d % 2 == 0 else quality_model.JUNK
        documents[good] += 1
        words = (text or "").split()
        places = quality_model.text_features(words, set(words), {})
        want[good].update(int(p) % (quality_model.TEXT_BUCKETS - 1) if p != quality_model.WIDE else quality_model.TEXT_BUCKETS - 1 for p in places)
    for c in quality_model.CLASSES:
        sums, n = counts["text"][0][c], counts["text"][1][c]
        assert n == documents[c] and {int(k): int(sums[k]) for k in np.nonzero(sums)[0]} == dict(want[c])


def test_training_on_awkward_rows_and_one_class(spark):
    docs, labels = labelled(spark, [(i, 1 - i % 2, 0) for i in range(63)] + [(5, None, 1), (None, 1, 0)])
    rows = quality_model.score_documents(docs, labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["p_quality"] <= 1 for r in rows)
    kept = quality_model.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in rows if r["kept"])
    for q, all_kept in ((1, True), (0, False)):
        one = spark.createDataFrame([(1, q, 0), (2, q, 0)], "doc_id long, quality int, toxic int")
        assert all(r["kept"] is all_kept for r in quality_model.score_documents(docs, one).collect())


# ---- pipeline


def test_pipeline_on_awkward_rows(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline

    item = "Which river crosses the northern plain before the old stone bridge. The silver river crosses it twice."
    near = PROSE[2].split()
    near[40] = "changed"
    rows = [
        (1, PROSE[0]), (2, PROSE[0]), (3, PROSE[1]), (4, PROSE[2]), (5, " ".join(near)), (6, PROSE[3] + " " + item + " " + PROSE[4]), (7, "short"), (8, None), (9, ""),
        (10, "a b c " * 60), (11, PROSE[5] + "\n" + " ".join(f"long{i}" for i in range(40_000))), (12, PROSE[6] + " <|endoftext|> é"), (1, PROSE[0]), (None, PROSE[7]),
    ]
    sf = f"file://{tmp_path}/sf"
    spark.createDataFrame([(d, t, "en", f"s{i % 3}", None, "clash") for i, (d, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, node string").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    texts = {1: rows[0][1], 3: rows[2][1], 4: rows[3][1], 11: rows[10][1], 12: rows[11][1], None: rows[13][1]}
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "node"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where(F.lit(False)), sf).count() == 0
