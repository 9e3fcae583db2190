"""The pipeline's stages on a small table against brute force."""

import sys
from collections import Counter

from .conftest import words_of
from .test_dedup import brute_components, brute_dedup
from .test_quality import base

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(llm, scratch):
    import corpus_pipeline
    from aevia.llm import quality_classifier

    docs = llm.read.parquet(SF + "/documents.parquet")
    labels = llm.read.parquet(SF + "/labels.parquet")
    model, kept = quality_classifier.fit(docs, labels), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, SF)
        path = f"{scratch}/{name}"
        out.write.parquet(path)
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        last, docs = docs, llm.read.parquet(path)
        if name != "best-fit packing":
            assert docs.columns == COLUMNS and docs.dtypes == last.dtypes
            after = kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert len(after) == docs.count()
        if name == "quality classifier":
            scores = {r["doc_id"]: r["predicted"] for r in quality_classifier.classify(last, model).collect()}
            assert set(after) == {i for i, p in scores.items() if p}
        elif name == "quality rules":
            assert set(after) <= {i for i, t in before if not base(t)[-1]}
            good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
            assert {i for i, t in before if not base(t)[-1] and i in good} <= set(after)
        elif name == "n-gram Jaccard join":
            assert set(after) == {c for _, _, c in brute_components(before)}
        elif name == "substring dedup":
            import hashlib

            got = Counter((i, len(words_of(t)), hashlib.sha256(b" ".join(words_of(t))).hexdigest()) for i, t in after.items())
            assert got == Counter((i, n - m, h) for i, n, m, h in brute_dedup(before))
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect() if r["text"] != dict(before)[r["doc_id"]])
    pieces = docs.collect()
    assert {r["doc_id"] for r in pieces} == set(kept["substring dedup"])
    import duckdb  # noqa: F401  (the oracle of the pipeline is None: no stage can be said in SQL)

    assert corpus_pipeline.ORACLE_SQL is None
    assert Counter(map(tuple, corpus_pipeline.run(llm, SF).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == \
        Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces)


def test_the_last_stage_leaves_room_for_the_others(llm, monkeypatch):
    """Executors that ran four stages have less memory left than op5's own."""
    import corpus_pipeline
    from aevia.llm import packing

    limits, frame = [], llm.createDataFrame([(1, "a")], "doc_id long, text string")
    monkeypatch.setattr(packing, "encoder", lambda *a: limits.append(a[-1]))
    monkeypatch.setattr(type(frame), "mapInArrow", lambda df, step, schema: list(step(iter([]))))
    monkeypatch.setattr(packing, "saved", lambda rows, name: rows)
    monkeypatch.setattr(packing, "pack", lambda rows, capacity: rows)
    corpus_pipeline.stage_packing(llm, frame, SF)
    assert limits and limits[0] <= packing.TABLE_UNITS // 4


def test_the_size_of_the_table_changes_no_piece(llm):
    from aevia.llm import packing
    from aevia.llm.common import vocabulary_path

    docs = llm.createDataFrame([(k, " ".join(f"word{k}x{j}" for j in range(50))) for k in range(40)], "doc_id long, text string")
    few, many = (Counter(map(tuple, packing.pieces_of(docs, vocabulary_path("word_bpe_49k.json"), 1, 64, n).collect()))
                 for n in (7, 1_000_000))
    assert few == many and len(few) > 40
