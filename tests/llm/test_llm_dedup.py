"""Exact, near and passage dedup against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from corpus import LONG, PASSAGE, ROWS, SF_DIR, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from relocate.llm import exact_dedup, simhash, suffix_dedup
from relocate.llm.common import UPPER, documents
from relocate.llm.components import components
from relocate.llm.queries import QUERIES

FOLD = str.maketrans(UPPER, UPPER.lower())


def folded(text):
    return (text or "").translate(FOLD)


# --- exact -------------------------------------------------------------------------


def test_exact_groups_of_odd_documents(spark):
    found = exact_dedup.exact_groups(odd_documents(spark)).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in ROWS:
        groups[folded(text)].append(doc_id)
    assert len(found) == len(ROWS)
    for r in found:
        ids = groups[folded(r.text)]
        keep = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(ids), r.doc_id == keep)
        assert r["count"] == 1  # an input column that is not in the way stays


def test_full_texts_are_hashed_only_where_needed(spark):
    rows = [(1, "same start " * 20 + "a"), (2, "same start " * 20 + "b"), (3, "alone"), (4, "alike"), (5, "Alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in exact_dedup.exact_groups(docs).collect()}
    assert {i for i, r in found.items() if r.full_hash} == {1, 2, 3, 5}
    assert [found[i].group_size for i in range(1, 6)] == [1, 1, 2, 1, 2]


def test_one_document_of_each_group_stays(spark):
    kept = exact_dedup.exact_dedup(odd_documents(spark))
    texts = Counter(folded(r.text) for r in kept.collect())
    assert texts == Counter({folded(t): 1 for _, t, *_ in ROWS})
    assert kept.columns == odd_documents(spark).columns
    assert {r.kept for r in kept.collect()} == {"old"}


def test_exact_of_nothing(spark):
    assert exact_dedup.exact_groups(odd_documents(spark, [])).count() == 0


# --- near --------------------------------------------------------------------------


def plain_fingerprint(text, k):
    words = text.encode().translate(bytes.maketrans(UPPER.encode(), UPPER.lower().encode())).split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(prints):
    """Smallest id reachable, by plain search."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, f) in enumerate(prints):
        for j in range(i):
            if (f ^ prints[j][1]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(prints):
        least[root(i)].append(doc_id)
    return [min((d for d in least[root(i)] if d is not None), default=None) for i in range(len(prints))]


def test_fingerprints_are_those_of_the_engine(spark):
    rows = [(i, " ".join(f"W{i * j}" for j in range(i))) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.fp % 2**64 for r in simhash.fingerprints(docs).collect()}
    assert found == {i: plain_fingerprint(t, 3) for i, t in rows}
    one_shingle = spark.sql("select xxhash64('w0 w2') as h").first().h
    assert found[2] == one_shingle % 2**64


def test_near_groups_of_odd_documents(spark):
    found = simhash.near_groups(odd_documents(spark)).collect()
    prints = [(d, plain_fingerprint(t or "", 3)) for d, t, *_ in ROWS]
    expected = sorted(zip(prints, plain_components(prints), strict=True), key=repr)
    assert sorted((((r.doc_id, r.fp % 2**64), r.component_id) for r in found), key=repr) == expected


@pytest.mark.parametrize(("bits", "segments"), [(3, 2), (1, 2), (5, 3)])
def test_no_pair_is_lost(spark, bits, segments):
    draw = np.random.default_rng(bits)
    centres = draw.integers(0, 2**64, 30, dtype=np.uint64)
    prints = {0, 2**64 - 1}
    for c in centres.tolist():
        for n in range(7):
            for _ in range(4):
                p = c
                for b in draw.choice(64, n, replace=False):
                    p ^= 1 << int(b)
                prints.add(p)
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    links = simhash.segment_links(spark.createDataFrame(signed, "fp long"), bits, segments).collect()
    found = {frozenset((r.a, r.b)) for r in links}
    values = [s for (s,) in signed]
    expected = {
        frozenset((a, b)) for i, a in enumerate(values) for b in values[:i] if ((a ^ b) % 2**64).bit_count() <= bits
    }
    assert found == expected and len(links) == len(found)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 140)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (200, 199), (199, 200), (None, 3)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, 199: 199, 200: 199}


def test_one_of_each_near_group_stays(spark):
    words = [f"word{i}" for i in range(400)]
    near = [*words[:200], "changed", *words[201:]]
    rows = [(4, " ".join(words)), (2, " ".join(near)), (9, "quite another text of some words"), (9, "again"), (None, "x")]
    rows += [(9, "again"), (4, "again")]
    docs = spark.createDataFrame([(*r, "old", 1) for r in rows], "doc_id long, text string, fp string, _near_text int")
    assert (plain_fingerprint(rows[0][1], 3) ^ plain_fingerprint(rows[1][1], 3)).bit_count() <= 3
    kept = simhash.near_dedup(docs)
    # Two texts under one id are two documents, and of rows equal in both one stays.
    assert sorted((str(r.doc_id), r.text[:5]) for r in kept.collect()) == [
        ("2", "word0"), ("4", "again"), ("9", "quite"), ("None", "x")
    ]
    twice = spark.createDataFrame([(9, "again")] * 3 + [(9, "quite another text")], "doc_id long, text string")
    assert sorted(simhash.near_dedup(twice).collect()) == [(9, "again"), (9, "quite another text")]
    assert kept.columns == docs.columns
    assert simhash.near_dedup(docs.limit(0)).count() == 0


def test_near_query(spark):
    found = QUERIES["op5_simhash_near_dedup"](spark, SF_DIR).collect()
    docs = documents(spark, SF_DIR, "doc_id", "text").collect()
    prints = [(d.doc_id, plain_fingerprint(d.text, 3)) for d in docs]
    expected = {d: (f"{f:016x}", c) for (d, f), c in zip(prints, plain_components(prints), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == expected


# --- passages ----------------------------------------------------------------------


def plain_cut(texts, depth):
    """Kept bytes and runs of every text, from a count of all strings of that length."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + depth] for b in raw for i in range(len(b) - depth + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - depth + 1):
            if seen[b[i : i + depth]] > 1:
                gone[i : i + depth] = True
        runs = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]])))
        out.append((len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def removed(df):
    rows = suffix_dedup.remove_repeats(df).collect()
    for r in rows:
        assert sum(x.end - x.start for x in r.removed) == r.n_removed and len(r.removed) == r.n_spans
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in rows)


def expected(rows):
    return sorted((str(r[0]), *x) for r, x in zip(rows, plain_cut([r[1] for r in rows], suffix_dedup.DEPTH), strict=True))


def test_passages_of_odd_documents(spark):
    assert removed(odd_documents(spark)) == expected(ROWS)


def test_passages_of_nothing(spark):
    assert suffix_dedup.remove_repeats(odd_documents(spark, [])).count() == 0


def test_overlaps_borders_and_periods(spark):
    a, b = PASSAGE[:199], PASSAGE[:200]
    rows = [
        (1, a + "|"), (2, a + "!"), (3, "<" + b), (4, b + ">"), (5, b[1:] + "?" + b[:-1]),
        (6, "ab" * 150), (7, "ab" * 99), (8, "abc" * 120), (9, PASSAGE[30:250] + PASSAGE[20:240]),
        (10, "é" * 99 + PASSAGE[:101]), (11, "è" * 99 + PASSAGE[:102]), (12, LONG[:3000]), (13, LONG[1500:4000]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed(docs) == expected(rows)


def test_stretches_meet_without_a_gap(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 512)
    data = np.frombuffer(LONG[:6000].encode(), np.uint8)
    found = suffix_dedup.cells(data)
    windows = np.concatenate([np.arange(a, z + 1) for a, z in zip(found["lo"], found["hi"], strict=True)])
    assert windows.tolist() == list(range(6000 - suffix_dedup.DEPTH + 1))
    assert ((found["anchor"] >= found["hi"]) & (found["anchor"] < found["lo"] + suffix_dedup.SPREAD)).all()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 40), st.integers(1, 12), st.randoms(use_true_random=False))
def test_the_least_of_windows(width, spread, random):
    values = np.array([random.randrange(spread) for _ in range(width + random.randrange(60))], np.uint64)
    found = suffix_dedup._least_in_windows(values, width)
    assert found.tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_judging_does_not_depend_on_batches(spark):
    draw = np.random.default_rng(5)
    n = 600
    digit = np.sort(draw.integers(0, 60, n))
    content = draw.integers(0, 3, n)
    order = np.lexsort((content, digit))
    rows = {
        "digit": digit[order], "content": content[order], "copies": np.ones(n, np.int64), "doc_id": np.arange(n),
        "row": np.zeros(n, np.int64), "anchor": np.zeros(n, np.int64), "lo": np.arange(n), "hi": np.arange(n),
    }
    whole = suffix_dedup._arrow(rows, suffix_dedup.NAMES)

    def run(size):
        out = set()
        for b in suffix_dedup.judge(whole.slice(i, size) for i in range(0, n, size)):
            out |= set(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        return out

    results = [run(size) for size in (n, 1, 7, 100)]
    groups = Counter(zip(rows["digit"].tolist(), rows["content"].tolist(), strict=True))
    pairs = list(zip(rows["digit"].tolist(), rows["content"].tolist(), strict=True))
    repeated = {i for i, p in enumerate(pairs) if groups[p] > 1}
    assert all({d for r, d in result if r} == repeated for result in results)
    contents = Counter(d for d, _ in groups)
    open_pairs = [pairs[d] for r, d in results[0] if not r]
    assert sorted(open_pairs) == sorted(p for p in groups if contents[p[0]] > 1)
    assert all(sorted(pairs[d] for r, d in result if not r) == sorted(open_pairs) for result in results)


    # Of a crowded digit one row of each content goes on, however many contents it has.
    crowded = list(range(0, 60, 7))
    told = [b for b in suffix_dedup.judge((whole.slice(i, 50) for i in range(0, n, 50)), crowded)]
    more = sorted(pairs[d] for b in told for r, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if not r)
    assert more == sorted(p for p in groups if contents[p[0]] > 1 or p[0] in crowded)


def test_a_phrase_among_different_surroundings(spark):
    """One phrase in most texts is a crowded digit, dealt out by content; what repeats is the same."""
    draw = random.Random(4)
    text = lambda n: "".join(draw.choices("abcdefgh ", k=n))
    phrase, whole = text(90), text(260)
    rows = [(i, text(150) + phrase + text(150)) for i in range(60)]
    rows += [(100 + i, text(40) + whole[:130] + phrase + whole[130:] + text(40)) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = docs.selectExpr("doc_id", "0L AS row", "text")
    assert suffix_dedup._crowded(base, suffix_dedup._produce_cells)
    assert removed(docs) == expected(rows)
    assert sum(r[2] > 0 for r in removed(docs)) == 4


def test_passage_query(spark):
    docs = documents(spark, SF_DIR, "doc_id", "text").collect()
    found = {r.doc_id: r for r in QUERIES["op4_suffix_dedup"](spark, SF_DIR).collect()}
    for d, (n, gone, runs, kept) in zip(docs, plain_cut([d.text for d in docs], 200), strict=True):
        r = found[d.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, runs, hashlib.sha256(kept).hexdigest())
