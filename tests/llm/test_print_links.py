"""The near-dedup of the pipeline goes through fingerprints; the join of sets adds what they cannot find."""

from tallyferry.llm import set_join, simhash


def test_fingerprints_give_the_first_links_and_each_is_checked(spark, monkeypatch):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words), " ".join([*words, "end"]), " ".join([*words[:180], "x", *words[180:]]), " ".join(f"v{k}" for k in range(300)), "", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    seen = []
    real = set_join.similar_links
    monkeypatch.setattr(set_join, "similar_links", lambda entries, docs, text, words, least, known: seen.append(known) or real(entries, docs, text, words, least, known))
    assert sorted(r["doc_id"] for r in simhash.keep_one_per_group(docs).collect()) == [0, 3, 4]
    assert len(seen) == 1 and seen[0].count() >= 1  # the copies with one word more or less
    # nothing similar: texts of one fingerprint are paired, but the check of the sets drops them
    blank = spark.createDataFrame([(1, "a b c"), (2, "a b c d e f g")], "doc_id long, text string")
    assert simhash.print_links(blank, "text", 5, 0.8, max_bits=3).count() == 0
