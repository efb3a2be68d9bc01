"""Spelling variants by a variable-length gram index.

The dictionary holds the grams of SHORTEST code points and, where a gram is frequent, the grams
that go on from it, up to LONGEST. A word is cut from left to right into the longest grams that the
dictionary has. One edit falls into one gram (an insertion: before one of its letters): the grams
left of it are the same in both words, and the text right of it is. So for each gram that an edit
may affect, the lists of all that it leaves alone are merged into one list, whose key is the text
before the gram, the width it has after the edit, and the text behind it. Words that share a list
differ only inside the gram. Long lists are merged further with what the gram itself keeps. What
meets is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ship, slices, small_or_not
from .wordhash import mix, spans_hash

SHORTEST, LONGEST = 2, 4
FREQUENT = 256  # a gram goes on if it begins at more than one in so many letters of the vocabulary
LONG_LIST = 64
ROUND_ROWS = 200  # texts that are Python objects at a time
COUNTED_WORDS = 400_000  # words that a task counts before it passes them on
INDEX, REPLACE, INSERT = 0, 1, 2  # a row of a list; a search for equally long words, for ones longer by one
END = "\x00"  # a word's end mark, which no word holds
FACTOR = np.uint64(0x9FB21C651E98DF25)

# Fixed value: what a word is made of.
RUN = r"[A-Za-zÀ-ÿ]+"


def lower_ascii(text: str) -> str:
    """Only A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def slipped(word: str, seed: int, every: int) -> str:
    """The word, without one letter where its crc32 (continued from ``seed``) is a multiple of ``every``."""
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"), seed)
    if not every or h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame, every: int = 0, least_length: int = 1, least_count: int = 1, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``word, n``: runs of letters of all whole texts, A-Z in lower case, and how often each occurs.

    With ``every``, one code point is left out of a document's word where the crc32 of
    ``<key>:<word>`` is a multiple of it, as slips of the pen. Only words of at least
    ``least_length`` code points and ``least_count`` occurrences are returned. Null and empty texts
    have no words, a null key counts as the empty text, repeated rows count each, other columns are
    ignored, and an empty table gives no rows. Tasks add their own words up before the shuffle.
    """
    ship(docs.sparkSession)
    find = re.compile(RUN).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
            )

        for part in slices(batches, ROUND_ROWS):
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                seed = zlib.crc32(f"{'' if i is None else i}:".encode())
                for word, n in Counter(find(lower_ascii(t or ""))).items():
                    word = slipped(word, seed, every)
                    if len(word) >= least_length:
                        total[word] += n
            if len(total) > COUNTED_WORDS:
                yield result()
                total.clear()
        yield result()

    rows = docs.select(F.col(f"`{key}`").cast("string").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    counted = rows.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def frequent_grams(words: DataFrame, frequent: int = FREQUENT) -> frozenset[str]:
    """The grams that go on: each begins at more than one of ``frequent`` letters of the distinct
    words, so there are fewer than ``frequent`` of each length, however many words there are."""
    letters = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    marked = F.concat("word", F.lit(END))

    def grams(size: int) -> Column:
        begins = F.sequence(F.lit(1), F.length(marked) - size + 1)
        return F.transform(begins, lambda i: F.substring(marked, i, F.lit(size)))

    long_enough = words.where(F.length("word") >= LONGEST - 1)
    counted = long_enough.select(F.explode(F.concat(*map(grams, range(SHORTEST, LONGEST)))).alias("gram")).groupBy("gram").count()
    return frozenset(r["gram"] for r in counted.where(F.col("count") * frequent > letters).collect())


def borders(marked: str, frequent: frozenset[str]) -> list[int]:
    """Where the grams of a word with its end mark begin, and its end."""
    out, at = [0], 0
    while at < len(marked):
        end = min(at + SHORTEST, len(marked))
        while end - at < LONGEST and end < len(marked) and marked[at:end] in frequent:
            end += 1
        out.append(end)
        at = end
    return out


def windows(marked: str, frequent: frozenset[str]) -> Iterator[tuple[int, int, int, int]]:
    """``(role, begin, end, width)`` of all the lists that a word with its end mark stands in or
    searches: the part that an edit may change, and its width after the edit.

    It searches, for each of its grams, the list of equally long words (the gram keeps its width)
    and of words longer by one. It stands in the lists of every width that the gram at that place
    may have in the other word, which shares the grams before it."""
    cuts = borders(marked, frequent)
    for at, end in zip(cuts, cuts[1:], strict=False):
        if marked[at] != END:
            yield REPLACE, at, end, end - at
        yield INSERT, at, end, end - at + 1
        for stop in range(at + SHORTEST, min(at + LONGEST + 1, len(marked)) + 1):
            yield INDEX, at, stop, stop - at


def list_rows(words: DataFrame, frequent: frozenset[str]) -> DataFrame:
    """``key, role, gram, id``: every list's members and searches, by the hash of what the edit leaves
    alone. The gram is all of a word that a row needs, so a long word costs rows, not their square."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 5_000):
            marked = [w + END for w in part.column(1).to_pylist()]
            found = [list(windows(w, frequent)) for w in marked]
            lengths = np.array([len(w) for w in marked], np.int64)
            place = np.repeat(np.arange(len(marked)), [len(f) for f in found])
            role, at, end, width = np.array([x for f in found for x in f], np.int64).reshape(-1, 4).T
            data = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
            stop = np.cumsum(lengths)[place]
            start = stop - lengths[place]
            before, after = spans_hash(data, start, start + at), spans_hash(data, start + end, stop)
            key = mix(before * FACTOR + mix(after + width.astype(np.uint64)))
            grams = [w[b:e] for w, f in zip(marked, found, strict=True) for _, b, e, _ in f]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(role.astype(np.int8)),
                    pa.array(grams, pa.string()),
                    part.column(0).take(pa.array(place)),
                ],
                names=["key", "role", "gram", "id"],
            )

    return words.select("id", "word").mapInArrow(run, "key bigint, role tinyint, gram string, id bigint")


def _finer(rows: DataFrame) -> DataFrame:
    """The rows of long lists under finer keys: what the gram keeps when one letter is taken out.

    Two grams of one width that differ in a letter agree without it; a gram longer by one is the
    shorter one without some letter."""
    places = F.sequence(F.lit(1), F.length("gram"))
    less = lambda i: F.concat(F.substring("gram", F.lit(1), i - 1), F.substring("gram", i + 1, F.length("gram")))
    replaced = F.transform(places, lambda i: F.xxhash64("key", i, less(i)))
    inserted = F.array_distinct(F.transform(places, lambda i: F.xxhash64("key", F.lit(0), less(i))))
    finer = (
        F.when(F.col("role") == INDEX, F.concat(replaced, inserted))
        .when(F.col("role") == REPLACE, replaced)
        .otherwise(F.array(F.xxhash64("key", F.lit(0), F.col("gram"))))
    )
    return rows.select(F.explode(finer).alias("key"), "role", "gram", "id")


def _met(rows: DataFrame) -> DataFrame:
    """``a, b``: ids of words that a search finds in its list and whose grams are one edit apart. Of
    equally long words both search for each other, and the search of the smaller id counts."""
    search, member = rows.where(F.col("role") != INDEX).alias("s"), rows.where(F.col("role") == INDEX).alias("m")
    once = (F.col("s.role") == INSERT) | (F.col("s.id") < F.col("m.id"))
    found = search.join(
        member, (F.col("s.key") == F.col("m.key")) & once & one_edit(F.col("s.gram"), F.col("m.gram"))
    )
    return found.select(F.col("s.id").alias("a"), F.col("m.id").alias("b"))


def one_edit(a: Column, b: Column) -> Column:
    """Whether two texts differ by exactly one inserted, deleted or replaced code point."""
    return F.levenshtein(a, b, 1) == 1


def near_words(words: DataFrame, long_list: int = LONG_LIST, frequent: int = FREQUENT) -> DataFrame:
    """``a, a_n, b, b_n``: all pairs of distinct words that are one edit apart, each once (``a`` the
    shorter of unequally long ones).

    ``words`` has one row for each ``word``, with its ``n`` and a unique ``id``, and should be written.
    Members and searches of a list are brought together by its key. Lists of more than ``long_list``
    rows are counted, small or large, and their rows go on to finer lists, whose length the number
    of letters bounds. Words that meet are verified whole.
    """
    spark = words.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    rows = scratch.write(list_rows(words, frequent_grams(words, frequent)), "lists")
    sizes = rows.groupBy("key").count().where(F.col("count") > long_list)
    long = small_or_not(scratch.write(sizes.select("key"), "long"), 32)
    met = _met(rows.join(long, "key", "left_anti")).unionByName(_met(_finer(rows.join(long, "key", "left_semi"))))
    met = scratch.write(met.distinct(), "met")
    scratch.drop("lists", "long")
    side = lambda x: words.select(F.col("id").alias(f"{x}_id"), F.col("word").alias(x), F.col("n").alias(f"{x}_n"))
    whole = met.toDF("a_id", "b_id").join(side("a"), "a_id").join(side("b"), "b_id")
    return whole.where(one_edit(F.col("a"), F.col("b"))).select("a", "a_n", "b", "b_n")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` of the words that have a form (``word, form``), by doubling the steps that a
    word's link spans. A form is at least as frequent as its word times a ratio over one, so chains
    end, after as many steps as the counts allow."""
    links = scratch.write(forms, "links_0")
    for step in range(1, 64):
        nexts = links.select(F.col("word").alias("form"), F.col("form").alias("next"))
        moved = links.join(nexts, "form", "left").select("word", F.coalesce("next", "form").alias("form"), "next")
        moved = scratch.write(moved, f"links_{step}")
        scratch.drop(f"links_{step - 1}")
        links = moved.select("word", "form")
        if moved.where("next is not null").isEmpty():
            break
    return links.select("word", F.col("form").alias("root"))


def spelling_variants(words: DataFrame, ratio: int = 2, **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (``word, n``).

    Two words are near if they are one edit apart. A word's ``form`` is its most frequent near word
    (of equals the smallest by code point) if that occurs at least ``ratio`` times as often, else
    null; ``root`` is where the forms lead, the word itself without one; ``n_near`` counts near words.
    Null words are left out, of repeated ones the largest count is kept, counts below one and other
    columns are ignored; an empty table gives no rows. Words may be of any length, without the
    character U+0000.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent, or chains might not end")
    scratch = Scratch(words.sparkSession)
    words = words.where("word is not null and n > 0").groupBy("word").agg(F.max("n").alias("n"))
    words = scratch.write(words.withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = near_words(words, **options)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))
    enough = F.col("near_n") >= ratio * F.col("n")
    rated = scratch.write(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("near")).alias("form"),
            F.when(enough, F.col("near_n")).alias("form_n"),
        ),
        "rated",
    )
    roots = _roots(rated.where("form is not null").select("word", "form"), scratch)
    return rated.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
