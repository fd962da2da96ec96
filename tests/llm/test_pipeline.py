"""The pipeline's stages take effect, and its result is what they say."""

import corpus_pipeline
from barlake.llm import decontamination, pii, quality, queries, simhash
from tests.llm.test_filters import brute_leaks, brute_spans
from tests.llm.test_simhash import brute_fingerprint, brute_roots
from tests.llm.test_tokens import ids_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_over_documents(spark, oracle_sf, tmp_path):
    docs = spark.read.parquet(f"{oracle_sf}/documents.parquet")
    labels = spark.read.parquet(f"{oracle_sf}/labels.parquet")
    kept = [{r["doc_id"]: r["text"] for r in docs.collect()}]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, oracle_sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == COLUMNS
            kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
            assert set(kept[-1]) <= set(kept[-2])
        if name == "quality":
            good = {r["doc_id"] for r in quality.score(before, quality.fit(before, labels)).collect() if r["predicted"]}
            assert set(kept[1]) == good
            wrong = labels.where("quality = 1").select("doc_id").collect()
            assert sum(r["doc_id"] not in good for r in wrong) <= 0.02 * len(wrong)
    marks = {i: simhash._signed(brute_fingerprint(t or "")) for i, t in kept[1].items()}
    roots, least = brute_roots(set(marks.values()), simhash.DISTANCE), {}
    for i, m in marks.items():
        least[roots[m]] = min(i, least.get(roots[m], i))
    assert set(kept[2]) == set(least.values()) and len(kept[2]) < len(kept[1])
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{oracle_sf}/benchmark.parquet").collect()]
    gone = set(kept[2]) - set(kept[3])
    assert gone == {d for d, _ in brute_leaks([(i, kept[2][i]) for i in gone], bench)} and gone
    # No alignment scores more than the item's words that the text has, so most pairs need none.
    words = {i: set(decontamination.words_of(t or "")) for i, t in kept[3].items()}
    for b in bench:
        item = decontamination.words_of(b[1] or "")
        near = [i for i, w in words.items() if sum(x in w for x in item) >= decontamination.LEAST_SCORE * len(item)]
        assert not brute_leaks([(i, kept[3][i]) for i in near], [b])
    changed = 0
    for i, t in kept[4].items():
        spans = brute_spans(kept[3][i])
        assert not brute_spans(t)
        assert spans or pii.candidates(kept[3][i]) or t == kept[3][i]
        changed += bool(spans)
    assert changed
    lengths = {r["doc_id"]: r["doc_tokens"] for r in docs.collect()}
    assert lengths == {i: len(ids_of(t)) + 1 for i, t in kept[4].items()}


def test_run_is_the_stages_in_a_row(spark, small_sf):
    rows = corpus_pipeline.run(spark, small_sf)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert rows.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and set(queries.ORACLE_SQL) <= set(queries.REGISTRY)


def test_empty_documents(spark, docs_of, small_sf):
    docs = docs_of([], extra=False)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small_sf)
        assert docs.count() == 0
