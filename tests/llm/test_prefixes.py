import hashlib
import random
import zlib

import pytest

from gridwarden.llm import prefixes

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, k1 string, length string"


def plain_trie(turns):
    """From ``(conv, turn, role, text)``."""
    own = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c, _, role, text in sorted(turns, key=order):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    members, ends = {}, {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(own.get(base, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []

    def below(node):
        nodes = [node]
        for n in nodes:
            nodes += children.get(n, [])
        return nodes

    for node, convs in members.items():
        under = below(node)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in under if n)
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        out.append(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
                sum(n not in children for n in under), saved, hashlib.sha256(ids.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def trie(spark, turns, **options):
    df = spark.createDataFrame([(*t, "x", "y", "z") for t in turns], SCHEMA)
    rows = prefixes.prefix_trie(prefixes.rebuilt(df), **options)
    assert rows.columns == COLUMNS
    return sorted(map(tuple, rows.collect()), key=repr)


def made(convs, turns, seed=1):
    rnd = random.Random(seed)
    return [
        (c, t, rnd.choice(["user", "assistant"]), rnd.choice("ab") * rnd.randint(0, 2))
        for c in convs
        for t in range(rnd.randint(1, turns))
    ]


@pytest.mark.parametrize("task_weight", [25, 10**6])
def test_trie_against_brute_force(spark, task_weight):
    turns = made([*range(0, 40), *range(100, 130), *range(-5, 0)], 6)
    assert trie(spark, turns, task_weight=task_weight) == plain_trie(turns)


def test_odd_rows(spark):
    turns = [
        (None, 0, "user", "lost"), (1, None, None, None), (1, None, None, None), (1, 0, "user", "é😀"), (1, 0, "user", "é😀"),
        (1, 5, "user", "a\x1c,\n"), (2, 3, "", ""), (300, 0, "u", "x" * 100_000), (301, 9, "u", "y"), (2**62 + 1, 0, "u", "z"),
        (-(2**62), 0, "u", "z"),
    ]
    assert trie(spark, turns) == plain_trie(turns)
    assert trie(spark, turns, task_weight=1) == plain_trie(turns)
    assert trie(spark, []) == []


def test_one_long_conversation_and_copies(spark):
    """A third of all turns in one conversation, a third in copies of one: split often, and right."""
    long = [(7, t, "user", "ab"[t % 2]) for t in range(400)]
    copies = [(c, t, "user", f"t{t}") for c in range(1000, 1200) for t in range(3)]
    turns = long + copies + [(c, t, "user", f"c{c}") for c in range(10_000, 10_600, 3) for t in range(3)]
    assert trie(spark, turns, task_weight=150) == plain_trie(turns)


def test_runs_join_up(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "RUN_TURNS", 4)
    monkeypatch.setattr(prefixes, "ID_RUN", 2)
    monkeypatch.setattr(prefixes, "HOT_CHILDREN", 2)
    turns = made(range(30), 20, seed=4) + [(c, 0, "user", "same") for c in range(200, 230)]
    assert trie(spark, turns, task_weight=20) == plain_trie(turns)
