import itertools
import random
import zlib
from collections import Counter

from gridwarden.llm import spelling


def plain_words(docs, every, least_length, least_count):
    total = Counter()
    for i, t, _ in docs:
        runs = Counter("".join(c.lower() if c.isascii() else c for c in r) for r in spelling.re.findall(spelling.RUN, t or ""))
        for word, n in runs.items():
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if every and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            total[word] += n
    return {w: n for w, n in total.items() if len(w) >= least_length and n >= least_count}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    out = {}
    around = {w: [x for x in words if near(w, x)] for w in words}
    for w, n in words.items():
        best = min(around[w], key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = [form, w, n, len(around[w]), words[form] if form else None]
    for w in out:
        while out[out[w][1]][0] is not None:
            out[w][1] = out[out[w][1]][0]
    return {w: tuple(x) for w, x in out.items()}


def found(df):
    return {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_variants_against_brute_force(spark):
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(0, 7))): rnd.randint(1, 40) for _ in range(400)}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert found(spelling.spelling_variants(df)) == plain_variants(words)
    # Short lists, so that most go on to finer ones; another dictionary.
    assert found(spelling.spelling_variants(df, long_list=3, frequent=40)) == plain_variants(words)


def test_windows_meet_for_every_edit():
    rnd = random.Random(5)
    frequent = frozenset({"ab", "ba", "aba", "bab", "a\x00"})
    for _ in range(300):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 9)))
        at = rnd.randint(0, len(word))
        for other, role in ((word[:at] + "b" + word[at:], spelling.INSERT), (word[:at] + "c" + word[at + 1 :], spelling.REPLACE)):
            if len(other) - len(word) != (role == spelling.INSERT) or other == word:
                continue
            a, b = word + spelling.END, other + spelling.END
            searched = {(a[:x], w, a[y:]) for r, x, y, w in spelling.windows(a, frequent) if r == role}
            assert searched & {(b[:x], w, b[y:]) for r, x, y, w in spelling.windows(b, frequent) if r == spelling.INDEX}


def test_odd_words(spark):
    long = "abcdefghij" * 3000
    rows = [(None, 5), ("word", 3), ("word", 9), ("ward", 2), ("none", 0), (long, 4), (long[:9] + "x" + long[9:], 1), ("", 1), ("x", 7)]
    got = found(spelling.spelling_variants(spark.createDataFrame(rows, "word string, n bigint")))
    assert got["ward"] == ("word", "word", 2, 1, 9) and got["word"] == (None, "word", 9, 1, None)
    assert got[long[:9] + "x" + long[9:]][:2] == (long, long) and got[""] == ("x", "x", 1, 1, 7) and len(got) == 6
    assert spelling.spelling_variants(spark.createDataFrame([], "word string, n bigint")).collect() == []


def test_chains_and_ties(spark):
    words = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "aaaac": 2, "zzzzz": 1, "zzzzy": 2, "zzzzx": 2}
    got = found(spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n bigint")))
    assert got == plain_variants(words)
    assert got["aaaaa"][:2] == ("aaaab", "aabbb") and got["zzzzz"][0] == "zzzzx"


def test_word_counts(spark, make_docs, odd_rows):
    rows = [*odd_rows, (9, "Straße STRASSE étÉ x×y÷z naïve-naïve", "s"), (10, "straße Straße", None)]
    for every, length, count in ((0, 1, 1), (3, 2, 1), (2, 1, 2)):
        got = {r["word"]: r["n"] for r in spelling.word_counts(make_docs(rows), every, length, count).collect()}
        assert got == plain_words(rows, every, length, count)
    assert spelling.word_counts(make_docs([])).collect() == []


def test_frequent_grams_are_few(spark):
    words = ["".join(w) for w in itertools.product("abcd", repeat=5)]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    grams = spelling.frequent_grams(df, 30)
    letters = sum(len(w) + 1 for w in words)
    counts = Counter((w + spelling.END)[i : i + k] for w in words for k in (2, 3) for i in range(len(w) + 2 - k))
    assert grams == {g for g, n in counts.items() if n * 30 > letters} and grams
