"""The conversation prefix trie against a plain trie."""

import hashlib
import random
import zlib
from collections import defaultdict

from ticksmith.llm.prefixes import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, c string, d string, block string, k0 string"


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), tie, role, text))
    ordered = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in turns.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c in sorted(ordered):
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - c % 5 if c >= 0 else c + (-c) % 5
        seq = tuple(ordered.get(donor, [])[:h] + ordered[c][h:])
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
        ends[seq].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in nodes:
        if node:
            children[node[:-1]] += 1
    for node, members in nodes.items():
        worth = (len(members) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += children[node] == 0
    return sorted(
        (m[0], len(n), nodes[n[:-1]][0] if n else None, len(m), children[n], leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, m in nodes.items()
    )


def run(spark, rows):
    df = prefix_trie(spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA))
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def check(spark, rows):
    assert run(spark, rows) == sorted(brute(rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_random_conversations(spark):
    rng = random.Random(4)
    rows = []
    for c in [*range(60), *range(-12, 0), 1000, 1003]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "ünï"])))
    rng.shuffle(rows)
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no id"), (5, None, "user", "null turn first"), (5, 0, None, None), (5, 0, None, None), (5, 1, "", ""),
        (6, 0, "user", "x"), (7, 3, "user", "same"), (7, 3, "user", "other"), (7, 3, "user", "same"), (10, 0, "user", "y" * 50_000),
        (11, 0, "us", "er"), (12, 0, "u", "ser"), (14, None, None, None), (14, None, None, None),
    ]
    check(spark, rows)


def test_copies_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 600, 5) for t in range(3)]
    rows += [(700, t, "user", f"turn {t % 7}") for t in range(9000)]
    got = run(spark, rows)
    copies = [r for r in got if r[1] == 3 and r[3] == 120]
    ids = ",".join(str(c) for c in range(0, 600, 5))
    assert [(r[0], r[5], r[7]) for r in copies] == [(0, 1, hashlib.sha256(ids.encode()).hexdigest())]
    assert len(got) == 1 + 3 + 9000
    assert {r[3] for r in got if r[1] > 3} == {1}
    root = next(r for r in got if r[1] == 0)
    assert root == (0, 0, None, 121, 2, 2, 119 * 18, hashlib.sha256(b"").hexdigest())


def test_empty_table(spark):
    assert run(spark, []) == []
