"""The corpus pipeline: every stage on its own input, against brute force."""

import re
from collections import Counter

import corpus_pipeline
from martline.llm import quality
from martline.llm.common import stored
from martline.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL
from tests.llm.test_decontaminate_html import plain_overlaps
from tests.llm.test_mixing_tokens import plain_targets
from tests.llm.test_runindex import plain_word_texts
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    given, results = [docs], []
    for _, stage in corpus_pipeline.STAGES:
        results.append(stored(stage(spark, given[-1], SMALL), "tests-pipeline"))
        given.append(results[-1])
    rows = [{r["doc_id"]: r for r in df.collect()} for df in given]
    assert all(df.columns == columns for df in given[:5])

    # quality: what the operator accepts stays, untouched
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = {r["doc_id"] for r in quality.quality_scores(docs, labels).collect() if r["predicted"]}
    assert set(rows[1]) == good and all(rows[1][i] == rows[0][i] for i in good)

    # near-dedup: the smallest id of each component stays
    ids = sorted(rows[1])
    fps = {i: plain_fingerprint(rows[1][i]["text"]) for i in ids}
    close = [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    assert set(rows[2]) == set(plain_components(ids, close).values()) < set(ids)

    # repeats: every window of 51 words that occurs twice is gone, all else stays
    ids = sorted(rows[2])
    want = plain_word_texts([rows[2][i]["text"] for i in ids], 51)
    assert set(rows[3]) == set(ids) and any(rows[2][i]["text"] != w for i, w in zip(ids, want))
    for i, w in zip(ids, want):
        assert rows[3][i]["text"] == w
        assert rows[3][i]["n_chars"] == (len(w) if w != rows[2][i]["text"] else rows[2][i]["n_chars"])

    # decontamination: what overlaps no item stays
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {r[0] for r in plain_overlaps([(i, r["text"]) for i, r in rows[3].items()], items)}
    assert hit and set(rows[4]) == set(rows[3]) - hit

    # the mix: every source on its target, no document more than three times
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for i, r in rows[4].items()}
    names = sorted({r["source"] for r in rows[4].values()})
    sizes = [sum(size[i] for i, r in rows[4].items() if r["source"] == n) for n in names]
    target = plain_targets(sizes, [(5, 2, 1)[k % 3] for k in range(len(names))])
    taken = Counter()
    for i, r in rows[5].items():
        assert r["size"] == size[i] and r["taken"] <= 3 * size[i]
        taken[rows[4][i]["source"]] += r["taken"]
    assert [taken[n] for n in names] == [round(t) for t in target]


def test_stages_take_awkward_and_empty_documents(spark, awkward, no_docs):
    for given in (awkward, no_docs):
        docs = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SMALL), "tests-pipeline")
            assert docs.columns == given.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_registered_names():
    import __spark_entry__ as e

    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES}
    assert numbers == set(range(1, 14)) and "pipeline" in e.queries()
    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near-dedup", "suffix-array dedup",
                                                      "benchmark decontamination", "mixing to target weights"]
