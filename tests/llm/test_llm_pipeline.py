"""The pipeline against plain Python, stage by stage and as a whole."""

import hashlib
from collections import defaultdict

import pytest
from corpus import SF_DIR
from test_llm_dedup import folded, plain_components, plain_fingerprint
from test_llm_models import plain_budgets

import corpus_pipeline
from relocate.llm import piece_codec
from relocate.llm.common import documents
from relocate.llm.queries import QUERIES


def plain_exact(docs):
    best = {}
    for d in docs:
        key = folded(d.text)
        if key not in best or d.doc_id > best[key].doc_id:
            best[key] = d
    return list(best.values())


def plain_near(docs):
    keep = set(plain_components([(d.doc_id, plain_fingerprint(d.text or "", 3)) for d in docs]))
    return [d for d in docs if d.doc_id in keep]


def plain_mix(docs, mix):
    def domain(source):
        digits = source[len(source.rstrip("0123456789")) :]
        return list(mix.weights.domains)[int(digits) % len(mix.weights.domains)] if digits else "other"

    leaves = defaultdict(list)
    for d in docs:
        n = len((d.text or "").encode().split())
        if n:
            leaves[domain(d.source or ""), d.lang or "", d.source or ""].append((d, n))
    sizes = [(*leaf, sum(n for _, n in rows)) for leaf, rows in leaves.items()]
    out = []
    for leaf, given in plain_budgets(sizes, mix).items():
        rows, total = leaves[leaf], sum(n for _, n in leaves[leaf])
        whole, rest = divmod(given, total)
        out += [d for d, _ in rows] * whole
        order = sorted(rows, key=lambda r: (hashlib.md5(f"{mix.seed}:{whole}:{r[0].doc_id}".encode()).hexdigest(), r[0].doc_id))
        taken = 0
        for d, n in order:
            taken += n
            if taken > rest:
                break
            out.append(d)
    return out


@pytest.fixture(scope="module")
def stages(spark):
    """What plain Python keeps after each stage; the verdicts of the classifier are the query's."""
    docs = documents(spark, SF_DIR).collect()
    good = {r.doc_id for r in QUERIES["op10_quality_classifier"](spark, SF_DIR).collect() if r.kept}
    first = [d for d in docs if d.doc_id in good]
    second = plain_exact(first)
    third = plain_near(second)
    return docs, first, second, third, plain_mix(third, corpus_pipeline.MIX)


@pytest.mark.parametrize("number", range(4))
def test_stage(spark, stages, number):
    before = spark.createDataFrame(stages[number], documents(spark, SF_DIR).schema)
    name, stage = corpus_pipeline.STAGES[number]
    found = stage(spark, before, SF_DIR)
    if number == 0:  # fitted on all documents, as the query is
        found = stage(spark, documents(spark, SF_DIR), SF_DIR)
    assert sorted(found.collect()) == sorted(stages[number + 1]), name


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(r.doc_id for r in rows.collect()) == sorted(d.doc_id for d in stages[-1])
    texts = {d.doc_id: d.text for d in stages[-1]}
    for r in piece_codec.decode(rows).collect():
        assert r.decoded == texts[r.doc_id] and r.n_tokens == len(r.piece_ids)
