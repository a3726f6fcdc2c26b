"""Token files, alignment and periodic runs against plain versions, on small tables with awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyferry.llm import grammar_store, pieces, token_alignment
from tallyferry.llm.entries import vocabulary
from tallyferry.llm.periodic_runs import find_runs, planted, word_runs

PATH, PIECES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
TEXTS = [
    "The quick brown fox.", None, "", " ", "  two  blanks ", "tabs\tand\nlines \n\n here ", "x<|endoftext|> y <|endoftext|>", "a\n <|endoftext|>b", "naïve café 東京 emoji 🙂🙂 end", "▁ mark ▁inside",
    "</s> <s> <0x41> [INST]", "word " * 300, "a" * 300, "it's we'll DON'T 'tis", " hard blank   em", "The quick brown fox.", "zero\0byte \x7f", "\nfirst line", "  lead", "trail  ", "\r\n", "1234567890 3.14 x=y;z",
]


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "c", 1) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, block string, start int")


# ---- pieces


def test_pieces_give_the_ids_of_whole_texts():
    rng = random.Random(5)
    bits = ["a", "Zebra", " ", "  ", "\n", "\t", " ", ".", "'s", "é", "12", "<|endoftext|>", "🙂", "▁", "foo bar", "\r\n "]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(1500)]
    encoder, model = pieces.PieceEncoder(PATH), pieces.byte_level(PATH)
    want = [pieces.ids_bytes(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want
    long = " ".join(texts)
    assert b"".join(c for _, c in encoder.parts([long], most=50)) == pieces.ids_bytes(model.encode(long, add_special_tokens=False).ids)
    small = pieces.PieceEncoder(PATH, cache_entries=15)  # drops pieces all the time
    for k in range(0, len(texts), 7):
        assert small.encode(texts[k : k + 7]) == want[k : k + 7]
    assert len(small.known.pieces) == len(small.known.ids) <= 30 + 7 * 30
    second = pieces.word_marked(PIECES)
    assert pieces.marks_lead(second)
    for t in texts:  # a word mark in a text turns into a blank: such texts have no tokens
        assert "▁" in t or sum([second.encode(p) for p in pieces.cut_after_blank(t)], []) == second.encode(t)


# ---- token files


@pytest.mark.parametrize("ids", [np.zeros(5000, "<u4"), np.arange(70_000, dtype="<u4"), np.random.default_rng(1).zipf(1.5, 30_000).astype("<u4") % 5000, np.tile(np.arange(40, dtype="<u4"), 500), np.array([9], "<u4")])
def test_a_block_gives_back_any_range(ids):
    block = grammar_store.Block(grammar_store.pack_block(ids))
    assert (block.between(0, block.n_ids) == ids).all() and block.n_ids == len(ids)
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert (block.between(a, b) == ids[a:b]).all()
    assert len(block.between(3, 3)) == 0


def test_a_block_shrinks_by_its_repeats():
    assert len(grammar_store.pack_block(np.tile(np.arange(40, dtype="<u4"), 5000))) < 4000
    with pytest.raises(ValueError):
        grammar_store.Block(b"XXXX" + bytes(40))


@pytest.mark.parametrize("ranges,block_ids", [(1, 7), (5, 100), (3, 1_000_000)])
def test_files_hold_the_ids_in_order(spark, tmp_path, ranges, block_ids):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    texts = [*TEXTS, "again", "again", "long " + " ".join(f"w{i}" for i in range(3000))]
    ids = [*range(100, 100 + len(TEXTS) - 1), None, 7, 7, 50]
    folder = f"file://{tmp_path}/ids"
    grammar_store.write_ids(table(spark, texts, ids), PATH, folder, ranges=ranges, block_ids=block_ids)
    got = grammar_store.read_ids(spark, folder, with_ids=True).collect()
    stream, want = [], []
    for i, t in sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        own = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, len(stream), len(own), zlib.crc32(np.array(own, "<u4").tobytes()), own))
        stream += own
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    for a, b in ((0, len(stream)), (3, 4), (90, 400), (5, 5)):
        assert grammar_store.ids_between(spark, folder, a, b).tolist() == stream[a:b]


def test_no_documents_give_no_ids(spark):
    empty = table(spark, []).where("false")
    assert grammar_store.store_and_read(empty, PATH).collect() == []
    assert token_alignment.align_documents(empty, PATH, PIECES).collect() == []
    assert word_runs(empty).collect() == []


# ---- alignment


def aligned_by_hand(rows):
    """Plain alignment of whole texts by the libraries, and the counts of pairs."""
    model, second = pieces.byte_level(PATH, True), pieces.word_marked(PIECES)
    width = {i: len(b) for i, b in pieces.token_bytes(model).items()}
    out, held = [], Counter()
    for i, t in rows:
        text = " " + (t or "")
        a, b = model.encode(text, add_special_tokens=False).ids, second.encode(t or "")
        of_b = [bytes([int(second.id_to_piece(x)[3:5], 16)]) if second.is_byte(x) else second.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not t or b"".join(of_b) != text.encode():
            out.append((i, None))
            continue
        ea, eb = np.cumsum([width[x] for x in a]).tolist(), np.cumsum([len(x) for x in of_b]).tolist()
        links = [(p, q) for p in range(len(a)) for q in range(len(b)) if max(ea[p] - width[a[p]], eb[q] - len(of_b[q])) < min(ea[p], eb[q])]
        cuts = sorted({*ea} & {*eb})
        groups, x, y = [], 0, 0
        for c in cuts:
            p, q = ea.index(c) + 1, eb.index(c) + 1
            groups.append(",".join(map(str, a[x:p])) + "|" + ",".join(map(str, b[y:q])))
            x, y = p, q
        held.update({(a[p], b[q]) for p, q in links})
        out.append((i, (len(a), len(b), len(groups), [(a[p], b[q]) for p, q in links], ";".join(groups))))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    done = []
    for i, row in out:
        if row is None:
            done.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_groups, links, text = row
            done.append((i, n_a, n_b, n_groups, len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return done


def test_alignment_equals_plain_alignment(spark):
    texts = [*TEXTS, "some long text with words " + " ".join(f"w{i}é" for i in range(400))]
    ids = [*range(len(TEXTS) - 1), None, 3]
    docs = table(spark, texts, ids).repartition(3)
    want = Counter(aligned_by_hand(zip(ids, texts, strict=True)))
    for most_pairs, most_chars in ((1_000_000, 1_000_000), (300, 100)):  # one pass, several; whole texts, parts
        got = token_alignment.align_documents(docs, PATH, PIECES, most_pairs=most_pairs, most_chars=most_chars)
        assert Counter(map(tuple, got.collect())) == want


def test_the_merge_path_gives_equal_pieces_for_any_length():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 300))
        a = np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n + 1)), n))
        b = np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n + 1)), n))
        whole = token_alignment.align(a, b, 10_000)
        assert whole[0].tolist() == [int(np.searchsorted(a, e)) for e in np.union1d(a, b)] and whole[1].tolist() == [int(np.searchsorted(b, e)) for e in np.union1d(a, b)]
        for steps in (2, 3, 17):
            assert all((x == y).all() for x, y in zip(token_alignment.align(a, b, steps), whole, strict=True))
            i, j = token_alignment.merge_path(a, b, steps)
            assert (i[0], j[0], i[-1], j[-1]) == (0, 0, len(a), len(b)) and (np.diff(i + j) <= steps + 1).all()


# ---- runs


def runs_by_hand(words):
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j + q - i
            own = words[i : i + n]
            if n >= max(6, 4 * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out)


def test_runs_equal_plain_search():
    rng = random.Random(3)
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(1, 6)):
            k = rng.choice([1, 2, 3, 6])
            words = [rng.randrange(k) for _ in range(rng.randint(0, 80))]
            for _ in range(rng.randint(0, 3)):
                unit = [rng.randrange(k) for _ in range(rng.randint(1, 9))]
                at = rng.randint(0, len(words))
                words[at:at] = unit * rng.randint(3, 7) + unit[: rng.randint(0, len(unit))]
            docs.append(words)
        want, at = [], 0
        for words in docs:
            want += [(at + s, n, q) for s, n, q in runs_by_hand(words)]
            at += len(words) + 1
        assert find_runs(np.array(sum(docs, []), np.int64), np.array(list(map(len, docs)))) == want


def test_long_sequences_have_few_levels_to_go_through():
    assert find_runs(np.zeros(200_000, np.int64), np.array([200_000])) == [(0, 200_000, 1)]
    assert find_runs(np.tile(np.arange(9000), 6), np.array([54_000])) == [(0, 54_000, 9000)]


def test_rows_of_runs(spark):
    texts = [*TEXTS, "a b " * 5 + "x " + "y z w " * 6, "one two three four five six seven eight"] + [" ".join(f"t{i % 37}{k}" for i in range(90)) for k in range(60)]
    ids = [*range(len(texts) - 1), None]
    got = Counter(map(tuple, word_runs(table(spark, texts, ids), plant=True, batch_bytes=2000).collect()))
    want, replaced = [], 0
    for i, t in zip(ids, texts, strict=True):
        words = (t or "").encode().split()
        replaced += (own := planted(words, i)) != words
        runs = runs_by_hand(own)
        drop = {k for s, n, q in runs for k in range(s + q, s + n)}
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
        digests = [hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), b" ".join(w for k, w in enumerate(own) if k not in drop))]
        want.append((i, len(runs), *top, 1000 * top[1] // top[2] if runs else None, *digests))
    assert got == Counter(want) and replaced > 3


def test_planted_words_follow_the_rule():
    for i in range(200):
        words = [b"w%d" % k for k in range(i % 50)]
        h, n = zlib.crc32(str(i).encode()), i % 50
        g = h // 10
        want = list(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            want = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        assert planted(words, i) == want


# ---- counts


def test_counts_equal_the_library_for_every_vocabulary(spark, tmp_path):
    from tallyferry.llm import token_counts

    texts = [*TEXTS, "two\t\twords", "two words"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"):
        path = vocabulary(name)
        want = dict(enumerate(token_counts.batch_counter(path)([t or "" for t in texts])))
        for _ in range(2):  # the second run finds all in its cache
            got = token_counts.count_tokens(table(spark, texts), path, f"file://{tmp_path}/{name}").collect()
            assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    assert [token_counts.drops_white_space(vocabulary(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")] == [False, True, False]
