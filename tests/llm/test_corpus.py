"""Near copies, contamination, mixing, chat and the classifiers against plain Python."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridwarden.llm import chat, contamination, jaccard, mixing, quality, queries, toxicity
from gridwarden.llm.components import connected_components

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def near_texts(seed=4):
    """Bases, edited copies around the threshold, exact copies, chains, and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(4000)]
    rows, number = [], 0
    for size in (1, 2, 3, 4, 8, 12, 25, 60, 150, 400):
        for _ in range(3):
            base = [rng.choice(vocabulary) for _ in range(size)]
            text = list(base)
            for copy in range(9):
                rows.append((number, " ".join(text), "s"))
                number += 1
                text = list(base if copy % 2 else text)  # copies of the base and copies of copies
                for _ in range(rng.choice([0, 1, 1, max(1, size // 60), max(1, size // 45), max(1, size // 30)])):
                    text[rng.randrange(len(text))] = rng.choice(vocabulary)
    rng.shuffle(rows)
    return rows


def brute_groups(rows, width, numerator, denominator):
    sets, ids = {}, []
    for i, t, _ in rows:
        w = BLANK_WORD.findall((t or "").translate(LOWER))
        size = min(width, len(w))
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if w else set()
        ids.append(i)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(set(ids)), 2):
        both = len(sets[a] & sets[b])
        if both and denominator * both >= numerator * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("width", "numerator"), [(3, 90), (5, 80)])
def test_near_groups(make_docs, width, numerator):
    rows = near_texts()
    docs = make_docs(rows).repartition(4)
    out = jaccard.near_groups(docs, width, jaccard.Threshold(numerator, 100)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute_groups(rows, width, numerator, 100)
    assert len(out) == len(rows)


def test_ids_at_the_ends_of_their_range(make_docs):
    """The same groups under ids from 2^62 on, negative ones among them."""
    places = {0: -(2**63), 1: 2**63 - 1, 2: 2**62, 3: 2**62 + 1, 4: -(2**62) - 3}
    rows = [(places.get(i, 2**63 - 1000 + i if i % 2 else -(2**62) - i), t, s) for i, t, s in near_texts(6) if i < 140]
    out = jaccard.near_groups(make_docs(rows).repartition(3)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute_groups(rows, 3, 90, 100)


def test_one_id_with_two_texts(make_docs):
    """It is one node: what is near either text is near it, and through it both are one group."""
    base = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    near = [t + " more" for t in base]
    rows = [(5, base[0], "s"), (5, base[1], "s"), (9, near[0], "s"), (7, near[1], "s"), (3, base[2], "s"), (8, near[2], "s"), (5, base[0], "s")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_groups(make_docs(rows)).collect()}
    assert got == {5: 5, 9: 5, 7: 5, 3: 3, 8: 3}
    # equal texts under other ids, so that the two classes have other representatives
    rows += [(1, base[0], "s"), (2, base[1], "s")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_groups(make_docs(rows)).collect()}
    assert got == {5: 1, 9: 1, 7: 1, 1: 1, 2: 1, 3: 3, 8: 3}


def test_linked_sets_share_a_probed_key():
    rng = np.random.default_rng(0)
    threshold = jaccard.Threshold()
    for _ in range(400):
        size = int(rng.integers(10, 300))
        a = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
        out, new = rng.integers(0, size // 19 + 2, 2)
        b = np.unique(np.concatenate([a[out:], rng.integers(0, 1 << 62, new).astype(np.uint64)]))
        if not threshold.links(len(np.intersect1d(a, b)), len(a), len(b)) or np.array_equal(a, b):
            continue
        (ia, pa), (ib, pb) = jaccard.keys_of(a, threshold), jaccard.keys_of(b, threshold)
        assert set(pa) & (set(ib) | set(pb)) and set(pb) & (set(ia) | set(pa))


def test_near_groups_of_odd_rows(make_docs, odd_rows):
    out = Counter(
        (r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_groups(make_docs(odd_rows)).collect()
    )
    long = len({tuple(f"w{j % 997}" for j in range(i, i + 3)) for i in range(997)})
    assert out == Counter(
        [(1, 2, 1), (None, 2, None), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 1, 5), (6, long, 6), (7, 2, 1), (7, 2, 1)]
        + [(8, len(BLANK_WORD.findall(odd_rows[-1][1])) - 2, 8)]
    )
    kept = jaccard.one_of_each(make_docs(odd_rows))
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, None, 2, 3, 4, 5, 6, 8])
    assert kept.columns == make_docs([]).columns
    assert jaccard.near_groups(make_docs([])).count() == 0


def test_repeated_rows_without_copies(make_docs):
    docs = make_docs([(5, "p q r s", "a"), (5, "p q r s", "a"), (9, "other words stand here", "a")])
    assert Counter(r["doc_id"] for r in jaccard.one_of_each(docs).collect()) == Counter([5, 9])


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(1, 30)] + [(7, 7)]
    out = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert out == {**{i: 100 for i in range(100, 141)}, **{i: 1 for i in [*range(1, 30), 500]}}


def brute_contamination(rows, items):
    windows: dict = {}
    for item, text in items:
        w = PLAIN_WORD.findall((text or "").translate(LOWER))
        size = min(10, len(w))
        for j in range(len(w) - size + 1 if w and item is not None else 0):
            windows.setdefault(tuple(w[j : j + size]), set()).add(str(item))
    out = []
    for i, t, _ in rows:
        w = PLAIN_WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for j in range(len(w) - size + 1):
                if tuple(w[j : j + size]) in windows:
                    found |= windows[tuple(w[j : j + size])]
                    hit.update(range(j, j + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return Counter(out)


def test_contamination(spark, make_docs, odd_rows):
    rng = random.Random(6)
    few = [f"t{i}" for i in range(12)]  # few words, so that windows repeat and overlap
    items = [(i, " ".join(rng.choice(few[: 2 + i]) for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(9)]
    items += [(20, None), (21, "..."), (None, "t1 t2"), (22, "Never Seen-Anywhere")]
    rows = list(odd_rows)
    for i in range(60):
        words = [rng.choice(few) for _ in range(rng.randrange(40))]
        for _, text in rng.sample(items[:9], 2):
            at = rng.randrange(len(words) + 1)
            words[at:at] = text.upper().split()
        rows.append((100 + i, ", ".join(words), "s"))
    rows = [r for r in rows if r[0] is not None]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = contamination.contamination(make_docs(rows).repartition(3), benchmark)
    assert Counter(map(tuple, out.collect())) == brute_contamination(rows, items)
    assert contamination.contamination(make_docs([]), benchmark).count() == 0
    nothing = contamination.contamination(make_docs(odd_rows), benchmark.limit(0)).collect()
    assert len(nothing) == len(odd_rows) and not any(r["contaminated"] for r in nothing)


def test_proximity(spark, make_docs):
    benchmark = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = make_docs([(1, "alpha beta x gamma delta", "s"), (2, "alpha x y z u v w beta gamma", "s"), (3, "alpha beta gamma delta", "s")])
    exact = {r["doc"] for r in contamination.phrase_matches(docs, benchmark).collect()}
    near = {r["doc"] for r in contamination.proximity_matches(docs, benchmark, slop=1).collect()}
    assert (exact, near) == ({3}, {1, 3})


def brute_targets(sizes, share=1.5, weights=(3, 1, 2), epochs=2):
    sources = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(sources)}
    left, budget, out = set(sources), share * sum(sizes.values()), {}
    while left:
        each = {s: budget * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if each[s] > epochs * sizes[s]]
        if not over:
            return out | each
        for s in over:
            out[s] = epochs * sizes[s]
            budget -= out[s]
            left.remove(s)
    return out


def test_mixing(make_docs, odd_rows):
    rng = random.Random(8)
    rows = [r for r in odd_rows if r[0] != 6]
    rows += [(1000 + i, "w " * rng.randrange(60), rng.choice(["a", "a", "a", "b", "Z", None, "é"])) for i in range(3000)]
    docs = make_docs(rows).repartition(3)
    out = mixing.mixed(docs).collect()
    again = mixing.mixed(make_docs(rows[::-1]).coalesce(1)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again)) and len(out) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(BLANK_WORD.findall(t or ""))
    target, source = brute_targets(size), {}
    taken: Counter = Counter()
    by_id = {i: s for i, _, s in rows if i != 7}
    for r in out:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        if r["doc_id"] in by_id:
            s = by_id[r["doc_id"]]
            source[s] = r["source_size"]
            assert abs(r["target"] - target[s]) < 1e-6
            taken[s] += r["taken"]
    assert source == size
    assert sum(r["taken"] for r in out) <= 1.5 * sum(size.values()) + 1e-6
    for s in ("a", "b", "Z", None, "é"):
        assert abs(taken[s] - target[s]) <= 130
    mixed = mixing.mixed_documents(docs)
    copies = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert mixed.columns == docs.columns
    assert all(copies[r["doc_id"]] * r["size"] == r["taken"] for r in out if r["size"] and r["doc_id"] != 7)
    assert mixing.mixed(make_docs([])).count() == 0


def test_chat(spark):
    turns = [
        (1, 0, "system", "Be <kind> & [calm]"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "a\n&lt;<|end|>\n"),
        (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "last"), (2, 0, "user", "no answer"),
        (3, 0, "assistant", "first"), (3, 0, "assistant", "first"), (None, None, None, None), (4, 1, "assistant", "é漢😀"),
        (4, None, "we\nird<", "x"),
    ]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, example string")
    examples = chat.chat_examples(df)
    out = {r["conv_id"]: r for r in chat.digests(examples).collect()}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        plain = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own)
        loss = "".join(x or "" for _, _, r, x in own if r == "assistant")
        row = out[conv]
        assert (row["n_turns"], row["turns_sha256"]) == (len(own), hashlib.sha256(plain.encode()).hexdigest())
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    rows = examples.where("conv_id = 1").orderBy("example").collect()
    assert [r["loss_length"] > 0 for r in rows] == [True, False, False] and [r["is_last"] for r in rows] == [False, False, True]
    assert rows[1]["text"].startswith(rows[0]["text"]) and rows[2]["text"].startswith(rows[1]["text"])
    assert sum(r["formatted_chars"] for r in out.values()) == sum(len(r["text"]) for r in examples.collect())
    assert chat.digests(chat.chat_examples(df.limit(0))).count() == 0


def test_tree_rules():
    text = """RandomForestClassificationModel: uid=x
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 1 <= 0.25)
      Predict: 0.0
     Else (feature 1 > 0.25)
      Predict: 1.0
    Else (feature 0 > 1.5)
     Predict: 1.0
"""
    a, b = quality.STATISTICS[:2]
    found = {r.terms for r in quality.tree_rules(text)}
    assert found == {
        ((a, False, 1.5),), ((a, True, 1.5),),
        tuple(sorted([(a, False, 1.5), (b, False, 0.25)])), tuple(sorted([(a, False, 1.5), (b, True, 0.25)])),
    }
    assert quality.merged([(a, True, 1.0), (a, True, 3.0), (a, False, 9.0)]).terms == ((a, False, 9.0), (a, True, 3.0))


def test_quality(spark, make_docs, odd_rows, sample_dir):
    out = queries.op1_quality(spark, sample_dir).toPandas()
    labels = spark.read.parquet(f"{sample_dir}/labels.parquet").toPandas()
    held = out[out["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["quality"]).mean() > 0.8 and out["score"].between(0, 1).all()
    model = quality.RuleModel(-1.0, ((quality.Rule((("distinct", False, 0.5),)), 2.0),))
    docs = make_docs([*odd_rows, (30, "again again again again", "s")])
    scores = {r["doc_id"]: r["q"] for r in quality.scored(docs, model, column="q").collect()}
    assert scores[30] == scores[2] == scores[3] > scores[1] and len(scores) > 8
    empty = spark.createDataFrame([], "doc_id long, quality int")
    constant = quality.quality_model(docs, empty)
    assert constant.rules == () and constant.intercept == 0.0


def test_toxicity(spark, make_docs, odd_rows, sample_dir):
    rng = random.Random(0)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        if i % 3 == 0:
            for _ in range(2):
                text.insert(rng.randrange(len(text)), rng.choice(["grob", "grobi", "Groben", "zzfiel"]))
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(i % 3 == 0)))
    docs = make_docs([*rows, *[(5000 + (r[0] or 0), *r[1:]) for r in odd_rows]])
    known = spark.createDataFrame([*labels[:700], (None, 1), (3, None)], "doc_id long, toxic int")
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, toxicity.toxicity_model(docs, known)).collect()}
    assert np.mean([(scores[i] >= 0.3) == bool(y) for i, y in labels[700:]]) > 0.97
    assert all(0 <= s <= 1 for s in scores.values()) and scores[5002] == scores[5003]
    none = toxicity.toxicity_model(docs, known.limit(0))
    assert {r["score"] for r in toxicity.toxicity_scores(docs, none).collect()} == {0.5}


def test_toxicity_counts_what_does_not_calibrate(spark, make_docs):
    """An expression that stands only in the fifth that may calibrate, beyond the rows that do."""
    rng = random.Random(3)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(200)]
    fifth = F.pmod(F.xxhash64("id", F.lit("calibration")), F.lit(5)) == 0
    order = [r[0] for r in spark.range(900).where(fifth).orderBy(F.xxhash64("id"), "id").collect()]
    beyond = set(order[40:])
    rows = []
    for i in range(900):
        text = [rng.choice(words) for _ in range(30)]
        rows.append((i, " ".join([*text, "qqwaxq" if i in beyond else "grob"] if i % 3 == 0 else text), "s"))
    tests = [(1000, "qqwaxq", "s"), (1001, " ".join(words[:20]), "s")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)], "doc_id long, toxic int")
    docs = make_docs([*rows, *tests])
    model = toxicity.toxicity_model(docs, labels, calibration_rows=40)
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, model).collect()}
    assert scores[1000] > 0.5 > 0.3 > scores[1001]


def plain_ratios(counted, asked):
    """Ratios of words by the definition, with plain dictionaries; ``counted`` has word: (ordinary, toxic)."""
    rows = Counter(), Counter()
    cells = lambda w: [0] * 4 + [x + 1 for x in w.encode()] + [257]
    for w, n in counted.items():
        for i in range(4, len(cells(w))):
            for c in (0, 1):
                rows[c][tuple(cells(w)[i - 4 : i + 1])] += n[c]
    kinds = set(rows[0]) | set(rows[1])
    short, single = Counter(g[2:] for g in kinds), Counter(g[-1] for g in {g[2:] for g in kinds})
    st, sk = Counter(g[2:4] for g in kinds), Counter(g[:2] for g in {g[2:] for g in kinds})
    total = [Counter(), Counter()]
    distinct = [Counter(g[:4] for g in r if r[g]) for r in rows]
    for c in (0, 1):
        for g, n in rows[c].items():
            total[c][g[:4]] += n
    out = {}
    for w in asked:
        out[w] = 0.0
        for i in range(4, len(cells(w))):
            g = tuple(cells(w)[i - 4 : i + 1])
            one = (single[g[-1]] + 1) / (sum(single.values()) + 258)
            lower = (max(short[g[2:]] - 0.75, 0) + 0.75 * sk[g[2:4]] * one) / st[g[2:4]] if st[g[2:4]] else one
            for c, sign in ((0, -1), (1, 1)):
                t = total[c][g[:4]]
                p = (max(rows[c][g] - 0.75, 0) + 0.75 * distinct[c][g[:4]] * lower) / t if t else lower
                out[w] += sign * np.log(max(p, 1e-12))
    return out


def test_toxicity_ratios_are_exact(spark, make_docs):
    """More distinct grams than a fixed table would tell apart; words that go by join score the same."""
    rng = random.Random(7)
    word = lambda: "".join(chr(rng.choice([97, 0x3B1, 0x430, 0x4E00]) + rng.randrange(20)) for _ in range(8))
    counted = {word(): (rng.randrange(4), rng.randrange(1, 3)) for _ in range(20_000)}
    schema = "word string, ordinary bigint, toxic bigint"
    toxicity.ship(spark)
    frame = spark.createDataFrame([(w, *n) for w, n in counted.items()], schema)
    model = toxicity.tables(toxicity.cut_lineage(toxicity.gram_counts(frame)))
    asked = [*rng.sample(sorted(counted), 200), *(word() for _ in range(200)), "", "x"]
    expected = plain_ratios(counted, asked)
    vocabulary = spark.createDataFrame([(w, 1) for w in asked], "word string, n bigint")
    got = {r["word"]: r["ratio"] for r in toxicity.word_ratios(vocabulary, model).collect()}
    assert got.keys() == expected.keys() and all(abs(got[w] - expected[w]) < 1e-9 for w in asked)
    model.weights = np.array([0.1, 0.7, 0.2, -0.3])
    texts = [" ".join(rng.choices(asked, k=rng.randrange(12))) for _ in range(60)]
    docs = make_docs([(i % 50, t, "s") for i, t in enumerate([*texts, None])])
    scores = [sorted(map(tuple, toxicity.toxicity_scores(docs, model, driver_words=n).collect())) for n in (0, 100, 10**6)]
    for other in scores[1:]:
        assert [k for k, _ in other] == [k for k, _ in scores[0]]
        assert np.allclose([x for _, x in other], [x for _, x in scores[0]], atol=1e-12)
    assert len(scores[0]) == 61


def test_kneser_ney_sums_to_one():
    """All continuations of a context, over a bucketless vocabulary, share one unit of probability."""
    found = ["abab", "abba", "baab"]
    g = toxicity.grams(found)
    assert len(g.byte) == sum(len(w) + 1 for w in found) and set(g.byte[g.word == 0][-1:]) == {257}
    assert len(set(g.full.tolist())) > len(set(g.short.tolist())) - 1


def test_packing_encodes_each_short_piece_once():
    import numpy as np

    from gridwarden.llm import packing

    asked = []

    def encode(piece):
        asked.append(piece)
        return [ord(c) for c in piece]

    known = packing.PieceIds(encode, packing.id_type(300))
    long = "x" * 60
    got = [np.frombuffer(known.of(t), "<u2").tolist() for t in ("ab cd ab", "", f"cd {long} ab")]
    assert got == [[ord(c) for c in t] for t in ("ab cd ab", "", f"cd {long} ab")]
    assert sorted(asked) == sorted(["ab", " cd", " ab", "cd", f" {long}"]) and f" {long}" not in known
    assert packing.PieceIds(encode, packing.id_type(1 << 20)).of("é") == (233).to_bytes(4, "little")


def test_wide_sketches_rule_out_large_sets_and_no_link(spark, make_docs):
    import numpy as np

    rnd = random.Random(5)
    threshold = jaccard.Threshold()

    def hashes(n):
        return np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], np.uint64))

    for size, apart in ((1100, 40), (2040, 30), (5000, 250), (9000, 20)):
        one = hashes(size)
        other = np.unique(np.concatenate([one[apart:], hashes(apart // 2)]))
        differ = len(np.setxor1d(one, other))
        assert jaccard.wide_difference(jaccard.wide_parities(one), jaccard.wide_parities(other)) <= differ
    far = jaccard.wide_difference(jaccard.wide_parities(hashes(8000)), jaccard.wide_parities(hashes(8400)))
    assert far > threshold.differ(16400) > jaccard.SKETCH * 3 // 4  # a sketch of SKETCH bits differs in about half of them

    words = [f"w{i}" for i in range(6000)]
    alike = words[:5900] + ["x"] * 100
    half = words[:4000] + [f"y{i}" for i in range(2000)]
    rows = [(i, " ".join(t), "s") for i, t in enumerate((words, alike, half, half[:-20]), 1)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_groups(make_docs(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3}
    sets = jaccard.set_rows(make_docs(rows), "doc_id", "text", 3, threshold)
    pairs = spark.createDataFrame([(1, 2, 1), (1, 3, 1), (3, 4, 1), (2, 9, 1)], "a long, b long, split long")
    kept = jaccard._not_ruled_out(pairs, jaccard._wide_sketches(sets), threshold)
    assert sorted((r["a"], r["b"]) for r in kept.collect()) == [(1, 2), (2, 9), (3, 4)]
