"""The Merkle manifest against plain Python trees."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from corpus import ROWS, SF_DIR, odd_documents

import __spark_entry__ as entry
from compare import connect, differences
from relocate.llm import merkle
from relocate.llm.common import LOWER, UPPER, documents
from relocate.llm.ranks import ranked

FOLD = str.maketrans(UPPER, LOWER)


def plain_hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(d, text):
    fields = (d.doc_id, d.source, d.lang, d.n_chars, text)
    return plain_hash("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def plain_tree(hashes):
    """The root and, per leaf, the siblings left and right of every step."""
    paths, places, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        runs = [level[i : i + 8] for i in range(0, len(level), 8)]
        for j, p in enumerate(places):
            paths[j].append((runs[p // 8][: p % 8], runs[p // 8][p % 8 + 1 :]))
            places[j] = p // 8
        level = [plain_hash("".join(run)) for run in runs]
    return level[0], paths


def plain_manifest(docs):
    trees = defaultdict(list)
    for d in docs:
        picked = zlib.crc32(("" if d.doc_id is None else str(d.doc_id)).encode()) % 3 == 0
        altered = plain_leaf(d, None if d.text is None else d.text.translate(FOLD)) if picked else None
        trees[d.lang].append((d.doc_id, plain_leaf(d, d.text), altered))
    for leaves in trees.values():
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    subs = {lang: plain_tree([x[1] for x in leaves]) for lang, leaves in trees.items()}
    root, above = plain_tree([subs[lang][0] for lang in order]) if order else (None, [])
    out = []
    for lang, top in zip(order, above, strict=True):
        sub, paths = subs[lang]
        for (doc_id, leaf, altered), path in zip(trees[lang], paths, strict=True):
            whole, h = path + top, altered or leaf
            for left, right in whole:
                h = plain_hash("".join(left) + h + "".join(right))
            proof = plain_hash("".join("".join(left + right) for left, right in whole))
            out.append((doc_id, leaf, sub, root, proof, h, h == root))
    return out


def judged(docs):
    found = merkle.proofs(merkle.manifest(docs))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_query_and_its_sql(spark):
    found = entry.queries()["op11_merkle_manifest"](spark, SF_DIR)
    assert sorted(map(tuple, found.collect())) == sorted(plain_manifest(documents(spark, SF_DIR).collect()))
    assert differences(found, connect(SF_DIR), entry.oracle_sql()["op11_merkle_manifest"]) == []


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = judged(docs)
    assert Counter(map(tuple, found.collect())) == Counter(plain_manifest(docs.collect()))
    assert found.count() == len(ROWS)
    assert judged(odd_documents(spark, [])).count() == 0


@pytest.mark.parametrize("rows", [1, 8, 9, 513])
def test_trees_of_every_height(spark, rows):
    """A run of one, a full run, one over, and more than one block; repeated rows and many languages."""
    same = [(7, "Same", "en", "s", 4)] * rows
    langs = [(i, f"T{i}", None if i == 3 else f"l{i}", "s", i) for i in range(rows if rows < 100 else 3)]
    docs = odd_documents(spark, same + langs)
    assert Counter(map(tuple, judged(docs).collect())) == Counter(plain_manifest(docs.collect()))


def test_blocks_above_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    rows = [(i, f"Text {i}", "en" if i % 5 else "de", "s", i) for i in range(700)]
    docs = odd_documents(spark, rows)
    assert sorted(map(tuple, judged(docs).collect())) == sorted(plain_manifest(docs.collect()))


def test_a_changed_row_is_told(spark):
    """Only tampered texts with a capital change the root their proof leads to."""
    rows = [(i, "no capitals" if i % 2 else "Capitals", "en", "s", i) for i in range(60)]
    for r in judged(odd_documents(spark, rows)).collect():
        picked = zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        assert r.verified == (not picked or r.doc_id % 2 == 1)


def test_ranks_of_one_large_group(spark):
    """Equal rows of one group are spread over slices and still get every rank once."""
    rows = spark.range(3000, numPartitions=6).selectExpr("'g' AS g", "id % 2 AS o").unionAll(
        spark.range(3).selectExpr("'h' AS g", "cast(null AS long) AS o")
    )
    found = ranked(rows, ["g"], ["o"]).collect()
    large = sorted((r["rank"], r.o) for r in found if r.g == "g")
    assert large == [(i, i // 1500) for i in range(3000)]
    assert sorted((r["rank"], r.size) for r in found if r.g == "h") == [(0, 3), (1, 3), (2, 3)]
