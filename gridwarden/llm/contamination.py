"""Benchmark decontamination on a distributed positional inverted index, with column functions only.

Inside this module a benchmark item is ``item``, a window's place in it ``w`` and a place in a
document ``pos``. Places count words from 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import small_or_not, text_of, words_of

WINDOW = 10
LISTS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed value: what lies between words once A-Z are lower case.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    return words_of(F.translate(text_of(text), UPPER, LOWER), NOT_WORD)


def windows(benchmark: DataFrame, size: int = WINDOW, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item, w, grams``: every run of ``size`` words of an item; a shorter item is one run.
    Equal runs are kept once for each item."""
    found = benchmark.select(F.col(f"`{key}`").cast("string").alias("item"), words(text).alias("ws")).where("size(ws) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - size, F.lit(0)))
    each = found.select("item", "ws", F.explode(starts).alias("w"))
    return each.select("item", "w", F.slice("ws", F.col("w") + 1, F.lit(size)).alias("grams")).dropDuplicates(
        ["item", "grams"]
    )


def term_rows(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, pos, term`` of the training words that are among ``terms`` (one column ``term``)."""
    each = docs.select(F.col(f"`{key}`").alias("doc"), F.posexplode(words(text)).alias("pos", "term"))
    return each.join(terms, "term", "left_semi")


def rarest_terms(wins: DataFrame, counts: DataFrame, lists: int = LISTS) -> DataFrame:
    """``item, w, grams, probes``: of each window the distinct terms with the shortest posting
    lists, as (frequency, offset, term), rarest first. A window with a term that no document has
    is dropped: it occurs nowhere."""
    terms = wins.select("item", "w", "grams", F.posexplode("grams").alias("off", "term"))
    rated = terms.join(counts, "term", "left")
    probe = F.struct(F.coalesce(F.col("n"), F.lit(0)).alias("n"), F.col("off"), F.col("term"))
    grouped = rated.groupBy("item", "w").agg(
        F.first("grams").alias("grams"), F.sort_array(F.collect_list(probe)).alias("all")
    )
    first_of_term = F.filter("all", lambda x, i: (i == 0) | (F.get("all", i - 1)["term"] != x["term"]))
    return grouped.where(F.element_at("all", 1)["n"] > 0).select(
        "item", "w", "grams", F.slice(first_of_term, F.lit(1), F.lit(lists)).alias("probes")
    )


def build_index(docs: DataFrame, wins: DataFrame, lists: int = LISTS, key: str = "doc_id", text: str = "text"):
    """``(probes, postings)``: the windows with their rarest terms, and the stored posting lists
    ``term, doc, pos`` of those terms over all documents."""
    vocabulary = small_or_not(cut_lineage(wins.select(F.explode("grams").alias("term")).distinct()))
    counts = term_rows(docs, vocabulary, key, text).groupBy("term").agg(F.count("*").alias("n"))
    probes = cut_lineage(rarest_terms(wins, counts, lists))
    wanted = probes.select(F.explode("probes.term").alias("term")).distinct()
    postings = cut_lineage(term_rows(docs, small_or_not(cut_lineage(wanted)), key, text))
    return probes, postings


def candidates(probes: DataFrame, postings: DataFrame, lists: int = LISTS, slop: int = 0) -> DataFrame:
    """``item, w, grams, doc, start``: where all of a window's probed terms stand at their offsets
    from ``start``, or at most ``slop`` words off. The rarest list is read first and the others are
    intersected with it, shifted by their offsets."""
    first = F.get("probes", F.lit(0))
    found = (
        probes.select("item", "w", "grams", "probes", first["term"].alias("term"), first["off"].alias("off"))
        .join(postings, "term")
        .select("item", "w", "grams", "probes", "doc", (F.col("pos") - F.col("off")).alias("start"))
    )
    if not slop:
        found = found.where("start >= 0")
    for i in range(1, lists):
        probe = F.get("probes", F.lit(i))
        left = found.select("*", probe["term"].alias("t"), (F.col("start") + probe["off"]).alias("at"))
        other = postings.select(F.col("term").alias("t2"), F.col("doc").alias("d2"), "pos")
        near = (F.col("pos") == F.col("at")) if not slop else F.abs(F.col("pos") - F.col("at")) <= slop
        same = (F.col("t") == F.col("t2")) & F.col("doc").eqNullSafe(F.col("d2"))
        kept = left.where("t is not null").join(other, same & near, "left_semi")
        found = kept.unionByName(left.where("t is null")).select("item", "w", "grams", "probes", "doc", "start")
    return found


def phrase_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    lists: int = LISTS,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc, item, w, start, length``: every place of every document where a window occurs exactly.

    The places come from intersecting the posting lists of each window's rarest terms; the other
    words are then compared in the document. Documents meet their candidates by id: the candidates
    are broadcast if their counted rows allow, else both sides are shuffled.
    """
    wins = cut_lineage(windows(benchmark, size, item_key, item_text))
    probes, postings = build_index(docs, wins, lists, key, text)
    places = candidates(probes, postings, lists).select("doc", "item", "w", "grams", "start")
    at = cut_lineage(places.distinct())
    wanted = at.groupBy("doc").agg(F.lit(1).alias("_one")).select(F.col("doc").alias("_wanted"))
    texts = docs.select(F.col(f"`{key}`").alias("d"), F.col(f"`{text}`").alias("t"))
    wanted = small_or_not(cut_lineage(wanted), 32)
    texts = texts.join(wanted, texts["d"].eqNullSafe(wanted["_wanted"]), "left_semi")
    read = texts.select("d", words("t").alias("ws"))
    same = F.slice("ws", F.col("start") + 1, F.size("grams")) == F.col("grams")
    # The windows' places go to the documents in one row for each, so that its words move once.
    grouped = at.groupBy("doc").agg(F.collect_set(F.struct("start", "item", "w", "grams")).alias("places"))
    both = read.join(grouped, read["d"].eqNullSafe(grouped["doc"]))
    return (
        both.select("doc", "ws", F.explode("places").alias("p"))
        .select("doc", "ws", "p.*")
        .where(same)
        .select("doc", "item", "w", "start", F.size("grams").alias("length"))
        .distinct()
    )


def proximity_matches(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, lists: int = LISTS, slop: int = 3,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc, item, w, start``: places where a window's ``lists`` rarest terms stand in the training
    text as they stand in the window, each at most ``slop`` words off its place."""
    wins = cut_lineage(windows(benchmark, size, item_key, item_text))
    probes, postings = build_index(docs, wins, lists, key, text)
    return candidates(probes, postings, lists, slop).select("doc", "item", "w", "start").distinct()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    lists: int = LISTS,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    A word is hit if any occurrence of a window covers it. Null and empty texts have no words and
    no hits; without hits ``items_sha256`` is the digest of the empty text. Repeated rows of one id
    are read as separate texts only if equal; rows of one id with different texts share a result
    over both, so ids should be unique. Null ids are one document. Items with a null id, and items
    without words, match nothing.
    """
    hits = phrase_matches(docs, benchmark.where(F.col(f"`{item_key}`").isNotNull()), size, lists, key, text, item_key, item_text)
    # Covered words: places in order, each adding what lies beyond the furthest end before it.
    spans = hits.select("doc", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    before = F.max("end").over(
        Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    )
    added = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce(F.col("before"), F.lit(0))), F.lit(0))
    covered = spans.withColumn("before", before).groupBy("doc").agg(F.sum(added).alias("n_hit"))
    items = hits.groupBy("doc").agg(F.collect_set("item").alias("items"))
    found = (
        covered.alias("c")
        .join(items.alias("i"), F.col("c.doc").eqNullSafe(F.col("i.doc")))
        .select(F.col("c.doc").alias("doc"), "n_hit", "items")
    )
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.size(words(text)).cast("bigint").alias("n_words"))
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["doc"]), "left")
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    listed = F.array_join(F.sort_array(items), ",")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("bigint")
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
