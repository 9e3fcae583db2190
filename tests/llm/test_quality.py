"""Quality classifier and quality rules."""

import re
from collections import Counter

import numpy as np
import pytest

from aevia.llm import quality_classifier, quality_rules
from aevia.llm.queries import op4_quality_classifier, op6_quality_rules

from .conftest import odd_texts

SF = "/root/testdata/sf0.01"


def base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(w[i: i + 8]) for i in range(len(w) - 7))
    again = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i: i + 8])] > 1:
            again.update(range(i, i + 8))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again),
            len(w) < 20 or 100 * len(again) > 30 * len(w))


def test_odd_rules(llm, odd, empty):
    labels = llm.createDataFrame([(23, 1, 0), (None, 1, 0), (25, 0, 0), (31, None, None)], "doc_id long, quality int, toxic int")
    ratios = quality_rules.fit_log_ratios(odd, quality_rules.trusted_ids(labels))
    rows = quality_rules.quality_rules(odd, ratios).collect()
    assert Counter(tuple(r)[:7] for r in rows) == Counter((i, *base(t)) for i, t in odd_texts())
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= quality_rules.MIN_SCORE) for r in rows)
    carried = quality_rules.quality_rules(odd, ratios, carry=True).where("kept").select("doc.*")
    assert carried.columns == odd.columns and carried.count() == sum(r["kept"] for r in rows)
    assert quality_rules.quality_rules(empty, ratios).collect() == []
    nothing = quality_rules.fit_log_ratios(empty, quality_rules.trusted_ids(labels.where("false")))
    assert set(nothing) == {0.0}


def test_log_ratios_count_every_document(llm):
    docs = llm.createDataFrame([(1, "a b"), (2, "a a"), (2, "c")], "doc_id long, text string")
    trusted = llm.createDataFrame([(1,)], "doc_id long")
    ratios = quality_rules.fit_log_ratios(docs, trusted, buckets=1)
    # 5 words with 5 pairs (the last word of a text pairs with nothing), 4 of them trusted
    assert np.allclose(ratios, [np.log((4 + 100 * 0.4) / ((10 + 100) * 0.4))])


def test_scores_against_plain_python(llm, odd):
    """Counts, log ratios, score and verdict, worked out in plain Python from
    the buckets that Spark hashes the n-grams to."""
    from pyspark.sql import functions as F

    from aevia.llm.common import words_of as spark_words

    good = [23, 31, 45]
    trusted = llm.createDataFrame([(i,) for i in good], "doc_id long")
    n_buckets = 512
    ratios = quality_rules.fit_log_ratios(odd, trusted, n_buckets)
    h = quality_rules.hashed(spark_words(F.col("text")))
    grams = odd.select("doc_id", "text", F.transform(h, lambda x: quality_rules.bucket(x, n_buckets)).alias("one"),
                       F.transform(quality_rules.joined(h, 1), lambda x: quality_rules.bucket(x, n_buckets)).alias("two")).collect()
    raw, target = Counter(), Counter()
    for r in grams:
        raw.update(r["one"] + r["two"])
        if r["doc_id"] in good:
            target.update(r["one"] + r["two"])
    share = sum(target.values()) / sum(raw.values())
    plain = [np.log((target[b] + 100 * share) / ((raw[b] + 100) * share)) for b in range(n_buckets)]
    assert np.allclose(ratios, plain)
    got = Counter()
    for r in quality_rules.quality_rules(odd, ratios).collect():
        got[r["doc_id"], r["n_words"], round(r["score"], 9), r["kept"]] += 1
    want = Counter()
    for r in grams:
        hits = r["one"] + r["two"]
        score = sum(plain[b] for b in hits) / len(hits) if hits else 0.0
        want[r["doc_id"], len(r["one"]), round(score, 9), not base(r["text"])[-1] and score >= -0.1] += 1
    assert got == want


@pytest.mark.parametrize("bits", [1 << 15, 1 << 27])
def test_filter_lets_every_trusted_document_through(llm, bits):
    docs = llm.range(3000).selectExpr("id as doc_id", "'t' as text")
    trusted = llm.range(0, 6000, 7).selectExpr("id as doc_id")
    ids = {r["doc_id"] for r in quality_rules.perhaps_trusted(docs, trusted, bits).collect()}
    assert ids >= set(range(0, 3000, 7)) and len(ids) < 600
    assert quality_rules.perhaps_trusted(docs, trusted.where("false"), bits).count() == 0


def test_every_good_label_is_trusted(llm):
    labels = llm.range(30_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert quality_rules.trusted_ids(labels.unionByName(labels)).count() == 30_000


def test_rules_keep_clean_documents(llm):
    labels = {r["doc_id"]: r["quality"] for r in llm.read.parquet(SF + "/labels.parquet").collect()}
    docs = {r["doc_id"]: r["text"] for r in llm.read.parquet(SF + "/documents.parquet").collect()}
    rows = op6_quality_rules(llm, SF).collect()
    assert Counter(tuple(r)[:7] for r in rows) == Counter((i, *base(t)) for i, t in docs.items())
    clean = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    junk = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 0]
    assert np.mean(clean) > 0.99 and np.mean(junk) < 0.4


def test_classifier_on_held_out_rows(llm):
    labels = {r["doc_id"]: r["quality"] for r in llm.read.parquet(SF + "/labels.parquet").collect()}
    rows = op4_quality_classifier(llm, SF).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in held]) > 0.95
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def test_classifier_learns_from_rows_not_held_out(llm, odd):
    labels = llm.createDataFrame([(i, i % 2, 0) for i in range(50)] + [(None, 1, 0), (23, None, 0)],
                                 "doc_id long, quality int, toxic int")
    import zlib

    sample = quality_classifier.sample_features(odd, labels)
    allowed = [i for i, _ in odd_texts() if i is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(sample) == len(allowed)
    assert len(quality_classifier.sample_features(odd, labels, rows=5)) <= 5 + 2  # rows that repeat an id


def test_odd_classifier(llm, odd, empty):
    labels = llm.createDataFrame([(23, 1, 0), (22, 1, 0), (25, 0, 0), (19, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(odd, labels)
    rows = quality_classifier.classify(odd, model).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in odd_texts())
    again = quality_classifier.classify(odd.repartition(1), model).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))  # scores don't depend on the batches
    assert quality_classifier.score(odd, model).select("doc.*").columns == odd.columns
    assert quality_classifier.classify(empty, model).collect() == []
    assert quality_classifier.train([]).weight.any() == False  # noqa: E712


def test_features_and_training():
    good, bad = "plain words of calm prose", "LOUD!! $$$ WORDS!!"
    table = quality_classifier.FeatureTable()
    sample = [(y, *np.unique(table.of(t.split()), return_counts=True)) for y, t in ((1, good), (0, bad)) for _ in range(30)]
    sample = [(y, f.astype(np.int32), c.astype(np.float32)) for y, f, c in sample]
    scores = quality_classifier.WordScores(quality_classifier.train(sample).weight).score([good, "", bad, good + " prose prose"])
    assert scores[0] > 0.9 and scores[2] < 0.1 and 0 < scores[1] < 1
    assert table.of(["a", "a"]).tolist().count(quality_classifier.REPEATED) == 1


def test_sample_is_bounded_whatever_repeats(llm):
    """An id that holds most rows adds no more to the sample than the bound."""
    docs = llm.createDataFrame([(3, f"text {n % 7}") for n in range(500)] + [(n, f"own {n}") for n in range(100, 160)], "doc_id long, text string")
    labels = llm.createDataFrame([(3, 1, 0)] + [(n, n % 2, 0) for n in range(100, 160)], "doc_id long, quality int, toxic int")
    for rows in (1, 20, 300):
        assert len(quality_classifier.sample_features(docs, labels, rows)) <= rows


def test_scores_are_plain_averages(llm):
    """A score is the logistic of the average weight over a text's features,
    counted one by one."""
    rng = np.random.default_rng(2)
    model = quality_classifier.Model(rng.normal(size=quality_classifier.BUCKETS))
    texts = ["one two two three", "", None, "a a a a", "été 中文 x" * 3]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_classifier.classify(docs, model).collect():
        words = (texts[r["doc_id"]] or "").split()
        hits = [f for w in words for f in quality_classifier.word_features(w)]
        hits += [quality_classifier.REPEATED] * sum(a == b for a, b in zip(words, words[1:])) + [quality_classifier.EVERY_TEXT]
        assert abs(r["score"] - 1 / (1 + np.exp(-np.mean(model.weight[hits])))) < 1e-9
