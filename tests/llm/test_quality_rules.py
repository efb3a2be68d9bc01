"""The quality statistics and scores against plain Python."""

import math

import regex

from gridwarden.llm import quality
from gridwarden.llm.common import text_of

WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    """Java's \\s is the ASCII blanks; its \\S all else."""
    t = text or ""
    words = WORD.findall(t)
    chars, each = max(len(t), 1), max(len(words), 1)
    blank = " \t\n\x0b\f\r"
    tokens = regex.findall(r"[^ \t\n\x0b\f\r]+", t)
    lone = sum(1 for w in tokens if regex.fullmatch(r"[^\p{L}\p{N}]+", w))
    ends = sum(1 for i, c in enumerate(t) if c in ".!?" and (i + 1 == len(t) or t[i + 1] in blank))
    return {
        "words": math.log1p(len(words)),
        "word_length": len(t) / each,
        "letters": len(regex.findall(r"\p{L}", t)) / chars,
        "capitals": len(regex.findall(r"\p{Lu}", t)) / chars,
        "digits": sum(c in "0123456789" for c in t) / chars,
        "marks": sum(1 for c in t if not regex.match(r"[\p{L}\p{N}.,;:'\-]", c) and c not in blank) / chars,
        "lone_marks": lone / each,
        "ends": ends / each,
        "lines": t.count("\n") / each,
        "distinct": len(set(words)) / each,
        "repeated": sum(a == b for a, b in zip(words, words[1:], strict=False)) / each,
    }


def plain_score(model, text):
    s = plain_statistics(text)
    total = model.intercept
    for rule, weight in model.rules:
        if all(s[n] > b if above else s[n] <= b for n, above, b in rule.terms):
            total += weight
    return 1 / (1 + math.exp(-total))


def test_statistics(make_docs, odd_rows):
    rows = [*odd_rows, (20, "Ein Satz. Noch einer! ?? !! x, y\n\n- - a-b 'c' 12 12   Ä z.", "s"), (21, "... ...", "s")]
    docs = make_docs(rows)
    found = docs.select("doc_id", "text", quality.measured(text_of()).alias("s")).collect()
    assert len(found) == len(rows)
    for r in found:
        want = plain_statistics(r["text"])
        assert all(abs(r["s"][n] - want[n]) < 1e-9 for n in quality.STATISTICS), (r["doc_id"], r["s"], want)


def test_scores_of_a_fitted_model(spark, sample_dir):
    docs = spark.read.parquet(f"{sample_dir}/documents.parquet")
    model = quality.quality_model(docs, spark.read.parquet(f"{sample_dir}/labels.parquet"))
    assert model.rules
    for r in quality.scored(docs, model, column="q").select("text", "q").collect():
        assert abs(r["q"] - plain_score(model, r["text"])) < 1e-9


def test_empty_table(make_docs):
    model = quality.RuleModel(-1.0, ((quality.Rule((("distinct", False, 0.5),)), 2.0),))
    assert quality.scored(make_docs([]), model).collect() == []
