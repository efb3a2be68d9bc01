"""Token counts, packing, licences and exact copies against plain Python."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from gridwarden.llm import exact, licenses, packing, pieces, tokens

BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def odd_text(rng):
    alphabet = ["a", "Be", "é", "漢", "9", "!", "'s", " ", "  ", "\n", "\t", " ", "\x1c", " ", "\x0b", "<|endoftext|>", "\r\n"]
    return "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))


def test_pieces_join_and_encode_as_the_whole():
    rng = random.Random(5)
    tokenizer = Tokenizer.from_file(BPE)
    texts = [odd_text(rng) for _ in range(3000)]
    assert all("".join(pieces.cut(t)) == t for t in texts)
    expected = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert tokens.token_lengths(texts, BPE) == expected
    assert tokens.token_lengths([None, ""], BPE) == [0, 0]


def test_token_counts(make_docs, odd_rows):
    out = tokens.count_tokens(make_docs(odd_rows), BPE, limit=3).collect()
    tokenizer = Tokenizer.from_file(BPE)
    sizes = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t, _ in odd_rows]
    expected = [(i, len((t or "").encode()), n, n > 3) for (i, t, _), n in zip(odd_rows, sizes, strict=True)]
    assert Counter(map(tuple, out)) == Counter(expected)
    assert tokens.count_tokens(make_docs([]), BPE).count() == 0


def test_best_fit_decreasing():
    rng = random.Random(3)
    for length in (1, 7, 64, 100):
        sizes = np.array([rng.randrange(length + 1) for _ in range(300)])
        rows = packing.best_fit_decreasing(sizes, length)
        assert sorted(i for row in rows for i in row) == list(range(300))
        # the definition: each size, largest first, into the fullest row that still takes it
        free: list[int] = []
        for size in sorted(sizes.tolist(), reverse=True):
            fits = [c for c in free if c >= size]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - size)
            else:
                free.append(length - size)
        assert sorted(free) == sorted(length - int(sum(sizes[row])) for row in rows)


@pytest.mark.parametrize(("length", "block"), [(16, 50), (128, 1 << 20)])
def test_packing_round_trip(make_docs, odd_rows, length, block):
    out = packing.pack_tokens(make_docs(odd_rows), RANKS, public_tokenizers.PATTERN, length, block).collect()
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = Counter()
    parts: dict = {}
    for r in out:
        ids, positions = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2")
        ends = r["cu_seqlens"]
        assert len(ids) == length and ends[-1] == r["n_tokens"] <= length
        assert (ids[ends[-1] :] == max(ranks.values()) + 1).all()
        assert set(r["position_resets"]) == set(ends[:-1])
        for doc, start, a, b in zip(r["seg_doc"], r["seg_start"], ends, ends[1:], strict=False):
            assert positions[a:b].tolist() == list(range(b - a))
            parts.setdefault(doc, []).append((start, ids[a:b].tolist()))
            got[doc] += b - a
    expected = Counter()
    for i, t, _ in odd_rows:
        expected[i] += len(encoding.encode_ordinary(t or ""))
    assert got == expected and set(parts) == {i for i, _, _ in odd_rows}
    for i, t, _ in odd_rows:
        if i != 7:  # there are two rows of it
            assert sum((x for _, x in sorted(parts[i])), []) == encoding.encode_ordinary(t or "")
    assert packing.pack_tokens(make_docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_cuckoo_index_against_a_dict():
    rng = random.Random(1)
    index, live = exact.CuckooIndex(buckets=4), {}
    for step in range(20_000):
        digest = hashlib.sha256(str(rng.randrange(3000)).encode()).hexdigest()
        if digest in live and rng.random() < 0.5:
            assert index.delete(digest) == live.pop(digest)
        elif digest not in live:
            index.insert(digest, (step, 1))
            live[digest] = (step, 1)
        assert index.get(digest) == live.get(digest)
    assert index.resizes > 3 and index.content == live
    assert all(index.may_hold(d) for d in live)
    assert index.delete("0" * 64) is None
    with pytest.raises(KeyError):
        index.insert(next(iter(live)), (0, 1))


def test_the_filter_spares_reads_of_entries():
    index = exact.CuckooIndex()
    digests = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(20_000)]
    for i, d in enumerate(digests):
        index.insert(d, (i, 1))
    assert index.live == 20_000 and index.reads < 100  # false hits of the filter alone
    index.reads = 0
    assert all(index.get(hashlib.sha256(f"x{i}".encode()).hexdigest()) is None for i in range(20_000)) and index.reads < 100
    index.reads = 0
    index.update(digests[5], (9, 9))
    assert index.get(digests[5]) == (9, 9) and index.reads == 2
    # with every fingerprint gone nothing is found: entries are reached through the filter alone
    index.table = [[] for _ in index.table]
    assert index.get(digests[5]) is None


@pytest.mark.parametrize("shard_keys", [2, 100_000])
def test_exact_copies(make_docs, odd_rows, shard_keys):
    out = exact.exact_copies(make_docs(odd_rows).repartition(3), shard_keys=shard_keys).collect()
    groups: dict = {}
    for i, t, _ in odd_rows:
        groups.setdefault(t or "", []).append(i)
    expected = []
    for i, t, _ in odd_rows:
        ids = groups[t or ""]
        keep = max(x for x in ids if x is not None)
        expected.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert Counter(map(tuple, out)) == Counter(expected)
    assert exact.exact_copies(make_docs([])).count() == 0


def test_live_digests_after_deletions(spark):
    a, b = (hashlib.sha256(x).hexdigest() for x in (b"a", b"b"))
    entries = spark.createDataFrame([(a, 3, 2), (a, 9, 1), (b, 4, 1), (b, 4, -1), (a, 3, -1)], "digest string, doc_id long, n long")
    exact.ship(spark)
    assert [tuple(r) for r in exact.live_digests(entries, 2).collect()] == [(a, 9, 2)]


def dice(a, b):
    a, b = (set(licenses.bigrams(licenses.normalised(x))) for x in (a, b))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def test_licenses(make_docs, odd_rows):
    mit = licenses.TEMPLATES["MIT"]
    wrapped = "\n".join(mit[i : i + 400] for i in range(0, len(mit), 400)).replace("charge", "cost")
    rows = [
        *odd_rows,
        (20, "some prose here\nLicensed under the Apache License, Version 2.0.\nmore prose", "s"),
        (21, "x y z\n" + wrapped + "\nend of it", "s"),
        (22, "THIS WORK is licensed under the GNU General Public License version 3", "s"),
        (23, "The licence of the poet is under no version", "s"),
    ]
    out = {r["doc_id"]: r for r in licenses.license_scan(make_docs(rows)).collect() if (r["doc_id"] or 0) >= 20}
    assert out[20]["license"] == "Apache-2.0 statement" and out[20]["dice"] == 1.0
    match = out[20]["matches"][0]
    assert rows[len(odd_rows)][1][match["start"] : match["end"]] == "Licensed under the Apache License, Version 2.0."
    assert out[21]["license"] == "MIT" and 0.9 < out[21]["dice"] < 1
    assert out[22]["license"] == "GPL-3.0 statement"
    assert (out[23]["license"], out[23]["n_matches"]) == (None, 0)
    assert licenses.license_scan(make_docs(odd_rows)).where("n_matches > 0").count() == 0


def test_license_lines_against_all_templates():
    """Single lines: the best of all templates, without any pruning by size."""
    known = licenses.Templates(licenses.TEMPLATES, 0.8)
    rng = random.Random(2)
    for name, text in licenses.TEMPLATES.items():
        words = text.split()
        for drop in (0, 1, len(words) // 12):
            kept = [w for i, w in enumerate(words) if i not in set(rng.sample(range(len(words)), drop))]
            line = " ".join(kept)
            best = max(dice(line, t) for t in licenses.TEMPLATES.values())
            found = known.find(line)
            assert (len(found) == 1 and abs(found[0].dice - best) < 1e-9) if best >= 0.8 - 1e-12 else not found, name


def test_licenses_inside_lines():
    known = licenses.Templates(licenses.TEMPLATES, 0.8)
    statement = "Licensed under the Apache License, Version 2.0."
    text = f"Copyright (c) 2020 Example Corp. {statement} İ other words of the page"
    (match,) = known.find(text)
    assert (match.license, match.dice, text[match.start : match.end]) == ("Apache-2.0 statement", 1.0, statement)
    rng = random.Random(6)
    prose = lambda n: " ".join(rng.choice(["of", "the", "in", "software", "any", "cat", "tree"]) for _ in range(n))
    flat = f"{prose(900)} {licenses.TEMPLATES['MIT']} {prose(300)} {licenses.TEMPLATES['Zlib']} {prose(200)}"
    assert [m.license for m in known.find(flat)] == ["MIT", "Zlib"]


def test_license_windows_against_all_windows():
    """Brute force over all windows of words of edited statements in prose, repeated words included."""
    rng = random.Random(9)
    for _ in range(150):
        name, template = rng.choice([(n, t) for n, t in licenses.TEMPLATES.items() if "statement" in n])
        target = licenses.normalised(template)
        body = [w for w in target * rng.randrange(1, 3) if rng.random() > 0.07]
        text = [rng.choice(["page", "the", *target]) for _ in range(rng.randrange(8))] + body + ["under", "the", "tree"]
        text += [f"page{i}" for i in range(20)]  # so that the line as a whole is no match
        if rng.random() < 0.3:
            text.insert(rng.randrange(len(text)), "word")
        best = max(dice(" ".join(text[i:j]), template) for i in range(len(text)) for j in range(i + 2, len(text) + 1))
        found = licenses.Templates({name: template}, 0.8).find(" ".join(text))
        assert max((m.dice for m in found), default=0) == pytest.approx(best if best >= 0.8 - 1e-12 else 0), text
        assert all(a.end <= b.start for a, b in zip(found, found[1:], strict=False))


def test_each_license_is_reported_as_itself():
    known = licenses.Templates(licenses.TEMPLATES, 0.8)
    assert {"BSD-3-Clause", "LGPL notice", "AGPL notice", "MPL-2.0 notice", "Unlicense"} <= licenses.TEMPLATES.keys()
    for name, text in licenses.TEMPLATES.items():
        assert [m.license for m in known.find(f"Copyright 2020 Example Corp. {text} And other words.")] == [name]
