"""The pipeline stage by stage against brute force, each on the rows its predecessor kept."""
from collections import Counter

import numpy as np
import pytest
from llm_samples import SF, empty, folder, odd, table, words  # noqa: F401
from test_near_dup import groups
from test_text_operators import check_packed, cut, measured, plain, reference_targets  # noqa: F401

import corpus_pipeline
from haulmark.llm import quality_model
from haulmark.llm.common import table as written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, folder):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [[tuple(r) for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name.split()[0])
        out.append([tuple(r) for r in docs.collect()])
        assert name == "best-fit packing" or docs.columns == COLUMNS
    return out


def test_classifier_stage(spark, stages):
    model = quality_model.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = quality_model.score(model, np.stack([quality_model.term_counts(r[1]) for r in stages[0]]))
    assert sorted(stages[1]) == sorted(r for r, s in zip(stages[0], scores) if s >= 0.5)
    truth = {r["doc_id"]: r["quality"] for r in table("labels")}
    left = {r[0] for r in stages[1]}
    assert all(d in left for d, q in truth.items() if q == 1 and any(r[0] == d for r in stages[0]))


def good(text):
    n_words, chars, symbols, dup_lines, repeated = measured(text)
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    upper, lower = sum(c.isupper() for c in text), sum(c.islower() for c in text)
    stutter = sum(a == b for a, b in zip(w, w[1:]))
    return not (n_words < 20 or 100 * repeated > 30 * n_words or 100 * symbols > 25 * n_words or 2 * dup_lines > len(lines)
                or 100 * stutter > 30 * n_words or chars < 2 * n_words or chars > 25 * n_words or upper > lower)


def test_rules_stage(stages):
    assert sorted(stages[2]) == sorted(r for r in stages[1] if good(r[1]))


def test_near_dup_stage(stages):
    rows = [(r[0], r[1]) for r in stages[2]]
    assert sorted(r[0] for r in stages[3]) == sorted({c for _, _, c in groups(rows, 5)})
    assert set(stages[3]) <= set(stages[2])


def test_mixture_stage(stages):
    sizes, taken = Counter(), Counter()
    for r in stages[3]:
        sizes[r[3]] += len(words(r[1]))
    for r in stages[4]:
        taken[r[3]] += len(words(r[1]))
    target = reference_targets(sizes)
    assert set(stages[4]) <= set(stages[3]) and max(Counter(stages[4]).values()) <= 2
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] for s in sizes), (taken, target)


def test_packing_stage(spark, stages, plain):  # noqa: F811
    class Row:
        def __init__(self, r):
            self.doc_id, self.piece, self.start, self.length, self.ids_crc32, self.sequence_id, self.offset = r

    n = check_packed([Row(r) for r in stages[5]], cut([(r[0], r[1]) for r in stages[4]], plain, 1024), 1024)
    assert n <= 1.01 * sum(r[3] for r in stages[5]) / 1024 + 1


def test_run_is_its_stages(spark, stages):
    out = corpus_pipeline.run(spark, SF)
    # Copies of a document are alike, so sequences may swap them; what is packed is the same.
    assert Counter(tuple(r[:5]) for r in out.collect()) == Counter(r[:5] for r in stages[5])


def test_stages_take_odd_and_empty_rows(spark, odd, empty):  # noqa: F811
    for frame in (odd, empty):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), "stage")
        assert {"sequence_id", "offset"} <= set(docs.columns)
    assert corpus_pipeline.ORACLE_SQL is None
