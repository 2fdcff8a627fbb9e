"""The trie of conversations against plain Python dictionaries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

import __spark_entry__ as entry
from compare import connect, differences
from corpus import SF_DIR
from relocate.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, kind int, `T1` string, pos string"


def plain_rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(turns, key=lambda x: x[0])] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(rows):
    convs = plain_rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(seq[:-1] for seq in members if seq)
    leaves, saved = Counter(), Counter()
    for seq, held in members.items():
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += not children[seq]
            saved[seq[:d]] += (len(held) - 1) * len(seq[-1][1]) if seq else 0
    return Counter(
        (
            min(held),
            len(seq),
            min(members[seq[:-1]]) if seq else None,
            len(held),
            children[seq],
            leaves[seq],
            saved[seq],
            hashlib.sha256(",".join(map(str, sorted(ends[seq]))).encode()).hexdigest(),
        )
        for seq, held in members.items()
    )


def judged(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    return Counter(map(tuple, prefix_trie.prefix_trie(frame).collect()))


def test_query_and_its_sql(spark):
    found = entry.queries()["op13_prefix_trie"](spark, SF_DIR)
    assert differences(found, connect(SF_DIR), entry.oracle_sql()["op13_prefix_trie"]) == []
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()
    assert Counter(map(tuple, found.collect())) == plain_trie([tuple(r) for r in rows])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    """Shared openings, whole repeats, sequences that end inside others, and some over several blocks."""
    draw, rows = random.Random(seed), []
    lines = [("user", "a"), ("user", "bb"), ("assistant", "a"), (None, "ccc"), ("user", None), ("x", "é😀")]
    long = [lines[draw.randrange(3)] for _ in range(150)]
    for c in draw.sample(range(-150, 2500), 220):
        kind = draw.random()
        if kind < 0.3:
            turns = [lines[0]] * draw.choice((1, 2, 31, 32, 33, 64, 65))
        elif kind < 0.5:
            turns = long[: draw.choice((5, 31, 32, 33, 63, 64, 65, 96, 150))]
        else:
            turns = [lines[draw.randrange(draw.choice((2, 6)))] for _ in range(draw.choice((0, 1, 3, 8, 40)))]
        rows += [(c, t, *x) for t, x in enumerate(turns)]
    draw.shuffle(rows)
    assert judged(spark, rows) == plain_trie(rows)


def test_one_conversation_many_times(spark):
    """Most conversations are the same one: its nodes cross every shard."""
    rows = [(100 * i, t, "user", "same words") for i in range(400) for t in range(4)]
    rows += [(100 * i + 50, t, "user", f"own {i}") for i in range(20) for t in range(3)]
    assert judged(spark, rows) == plain_trie(rows)


def test_odd_conversations(spark):
    rows = [
        (0, None, "user", "before all"), (0, 0, None, None), (0, 7, "user", "x" * 5000),
        (3, 5, "user", "late"), (3, -2, "user", "early"), (None, 1, "user", "of no conversation"),
        (205, 0, "user", "gone"), (4, 1, "", ""), (4, 2, "user\x00", "\n"), (300, 1, "u", "t"), (300, 2, "u", "t"),
    ]
    assert judged(spark, rows) == plain_trie(rows)
    tied = [(100, 1, "user", "b"), (100, 1, "user", "a"), (100, 1, "user", "a"), (2**62, 1, "user", "a")]
    found = judged(spark, tied)
    assert sum(found.values()) == 4 + (zlib.crc32(str(2**62).encode()) % 6 == 0)
    assert judged(spark, tied[::-1]) == found
    assert judged(spark, []) == Counter()
    only_null = [(None, 1, "user", "x")]
    assert judged(spark, only_null) == Counter()


def test_marks_of_a_shard():
    """Rows out of order, with the neighbours as ghosts: what a row shares and whether it is a leaf."""
    turn = lambda k, t: {"pos": k, "t1": t, "t2": t, "chars": 10 ** k}
    rows = [([1, 2], 5, 0, 0), ([1], 9, 0, 0), ([1], 8, 0, -1), ([1, 2, 3], 1, 0, 1), ([1, 2], 4, 1, 0)]
    data = {
        "turns": [[turn(k, t) for k, t in enumerate(ids)] for ids, *_ in rows],
        "conv_id": [r[1] for r in rows],
        "more": [r[2] for r in rows],
        "ghost": [r[3] for r in rows],
        **{n: [0] * 5 for n in ("block", "q1", "q2", "deeper_saved", "deeper_leaf")},
    }
    m = prefix_trie.Matrix(pa.table(data))
    assert m.conv_id.tolist() == [8, 9, 5, 4, 1]
    assert m.shared.tolist() == [0, 1, 1, 2, 2]
    assert m.kept.tolist() == [0, 1, 1, 11, 11]
    assert m.leaf.tolist() == [0, 0, 0, 0, 1]
    assert m.starts[2].tolist() == [False, False, True, True]
