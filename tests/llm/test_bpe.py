import hashlib
import random

import numpy as np
import pytest

from gridwarden.llm import bpe

P = pytest.importorskip("public_tokenizers")
LETTERS = "abcdefghijklmnop thes 's 'll 12 !? ñéßΣΑΣ ́ 　\n\t日本語😀👍\x85 the and ing aaa"


@pytest.fixture(scope="module")
def path():
    return P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def samples():
    rnd = random.Random(1)
    any_point = lambda: chr(rnd.choice([rnd.randint(1, 0x2FF), rnd.randint(1, 0xD7FF), rnd.randint(0xE000, 0x10FFFF)]))
    out = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 200))) for _ in range(300)]
    out += ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    out += ["".join(rnd.choice("aehnrst") for _ in range(rnd.randint(0, 60))) for _ in range(500)]
    out += ["".join(any_point() for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    return [*out, "a" * 50_000, "x<|endoftext|>y <|startoftext|>́", "<|StartOfText|>", "", " ", "don't WE'LL"]


def test_encode_and_decode_as_the_library(spark, path, library):
    texts = [*samples(), None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = bpe.decode(bpe.encode(df, path), path).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_digests(spark, path, library, make_docs, odd_rows):
    from gridwarden.llm.queries import bpe as module

    found = module.digests(module.decode(module.encode(make_docs(odd_rows), path), path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t, _ in odd_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert bpe.encode(make_docs([]), path).collect() == []


def test_sample_documents(spark, path, library, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in bpe.encode(docs, path).collect():
        assert r["ids"] == library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids


def test_pairs_are_what_merging_gives(path):
    """The pair table against merging the two tokens' symbols outright."""
    vocab = bpe.vocabulary(path)
    ids = {f: i for i, f in vocab.form.items()}

    def merged(symbols):
        while True:
            ranks = [(vocab.joins.get(p, bpe.NEVER), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False))]
            rank, at = min(ranks, default=(bpe.NEVER, 0))
            if rank == bpe.NEVER:
                return symbols
            whole = ids[vocab.form[symbols[at]] + vocab.form[symbols[at + 1]]]
            symbols = [*symbols[:at], whole, *symbols[at + 2 :]]

    rnd = random.Random(2)
    tokens = [i for i in vocab.whole.values() if vocab.form[i].isascii()]
    for _ in range(3000):
        a, b = rnd.choice(tokens), rnd.choice(list(vocab.whole.values()))
        symbols = [ids[c] for c in vocab.form[a] + vocab.form[b]]
        assert vocab.compatible(a, b) == (merged(symbols) == [a, b])
    for token, form in rnd.sample(sorted(vocab.form.items()), 500):
        assert (merged([ids[c] for c in form]) == [token]) == (form in vocab.whole)


def test_unknown_ids_and_empty_rows(path):
    vocab = bpe.vocabulary(path)
    got = vocab.decode(np.array([-1, 320, 10**6, 320, 5]), np.array([0, 3, 1, 0, 1, 0])).to_pylist()
    text = lambda i: vocab.text[vocab.offsets[i] : vocab.offsets[i + 1] - 1].tobytes().decode()
    assert got == ["", text(320), text(320), "", text(5), ""]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(P.path("byte_bpe_50k.json"))
