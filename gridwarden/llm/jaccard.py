"""Documents whose shingle sets are alike, by an exact partition-based similarity join.

Sets are compared within size bands. If the Jaccard similarity of two sets reaches the threshold,
they differ in at most H elements, H following from the band's largest size. The universe is dealt
by hash into more than H segments. By the pigeonhole principle two such sets have the same elements
in some segment, or differ by a single one in a segment that counts twice. So segment subsets are
index keys, and the subsets with one element taken out are further keys for the segments that need
them. The sum of an element hash over a subset is its key, so taking one out is a subtraction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import Scratch, ship, slices, small_or_not, without_ids
from .components import connected_components
from .wordhash import mix, word_hashes

WORDS = 3
NUMERATOR, DENOMINATOR = 90, 100
BAND_RATIO = 1.5
SPARE = 2  # segments beyond H + 1, so that few sets must use a poor one
SKETCH = 1024  # bits that tell how many elements two sets differ in at least, for sets up to twice as large
BITS = [f"s{i}" for i in range(SKETCH // 64)]
MOST_WIDE = 1 << 20  # bits of the widest sketch of a set that has more elements than SKETCH
KEY_BITS = 44  # of a key that are kept: what meets by chance under shorter keys is checked as well
TALLIES = 1 << 18  # counts by which elements are ordered from rare to frequent, however many there are
HUB_SPLIT = 50_000
MOST_SIZE = 1 << 40
ROUND_ROWS = 200  # texts that are Python objects at a time
SEEN_SETS = 100_000  # digests that a task remembers, so as not to emit equal sets' keys again

D_SPACE = np.uint64(0xA24BAED4963EE407)


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; of the whole if it has fewer words."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words
    size = min(width, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + words[i : len(words) - size + 1 + i])
    return np.unique(out)


@dataclass(frozen=True)
class Threshold:
    """Two sets link when DENOMINATOR * intersection >= NUMERATOR * union."""

    numerator: int = NUMERATOR
    denominator: int = DENOMINATOR

    def differ(self, sizes: int) -> int:
        """The most elements in which two linked sets of ``sizes`` elements together differ."""
        return sizes * (self.denominator - self.numerator) // (self.denominator + self.numerator)

    def largest_partner(self, size: int) -> int:
        return size * self.denominator // self.numerator

    def links(self, common: int, a: int, b: int) -> bool:
        return self.denominator * common >= self.numerator * (a + b - common) and common > 0


def band_starts(ratio: float = BAND_RATIO) -> np.ndarray:
    starts = [1]
    while starts[-1] < MOST_SIZE:
        starts.append(max(starts[-1] + 1, int(starts[-1] * ratio) + 1))
    return np.array(starts)


BANDS = band_starts()


def allocate(counts: np.ndarray, units: int) -> tuple[np.ndarray, bool]:
    """Which segments a set probes, and whether it probes the one-deletion neighbourhood of segment 0.

    A segment with its subset counts one unit, segment 0 with its neighbourhood two, and ``units``
    are needed. The cost of probing is the number of sets expected under a key, which falls with
    the subset's size: so the largest subsets are taken first, then the neighbourhood, which costs
    a probe for each element, and the empty subsets, which many sets share, come last.
    """
    probed = np.zeros(len(counts), bool)
    order = np.argsort(-counts, kind="stable")
    filled = int((counts > 0).sum())
    deep = filled < units and counts[0] >= 2
    take = units - deep
    probed[order[:take]] = True
    return probed, bool(deep)


@dataclass(frozen=True)
class Segments:
    """A set dealt into the segments of one join band, the band of the larger set of a pair."""

    band: int
    units: int  # how many a probing set needs: one more than linked sets can differ in
    place: np.ndarray
    counts: np.ndarray
    order: np.ndarray
    sums: np.ndarray
    seeds: np.ndarray

    @property
    def whole(self) -> np.ndarray:
        """A key for each segment: its subset."""
        return mix(self.sums + self.seeds)


def dealt(elements: np.ndarray, scrambled: np.ndarray, threshold: Threshold) -> Iterator[Segments]:
    """The set's segments in its own size band and, if partners reach it, the next. Bands in which
    only equal sets link are left out."""
    size = len(elements)
    own = int(np.searchsorted(BANDS, size, "right")) - 1
    most = threshold.largest_partner(size)
    for band in (own, own + 1):
        high = int(BANDS[band + 1]) - 1
        if band > own and most < BANDS[band]:
            continue
        differ = threshold.differ(2 * high)
        if not differ:
            continue
        segments = differ + 1 + SPARE
        place = (mix(elements ^ mix(np.uint64([band * 7919 + 13]))) % np.uint64(segments)).astype(np.int64)
        counts = np.bincount(place, minlength=segments)
        order = np.argsort(place, kind="stable")
        running = np.zeros(size + 1, np.uint64)
        np.cumsum(scrambled[order], out=running[1:])
        ends = np.cumsum(counts)
        seeds = mix(np.uint64(band << 32) + np.arange(segments, dtype=np.uint64))
        units = threshold.differ(size + min(high, most)) + 1
        yield Segments(band, units, place, counts, order, running[ends] - running[ends - counts], seeds)


def scramble(elements: np.ndarray) -> np.ndarray:
    return mix(elements + np.uint64(0x51ED270B))


def keys_of(elements: np.ndarray, threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """``(index keys, probe keys)`` of a set. Two sets that link share a key that is a probe key of
    at least one of them."""
    index, probe = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    scrambled = scramble(elements)
    for s in dealt(elements, scrambled, threshold):
        probed, deep = allocate(s.counts, s.units)
        whole = s.whole
        index.append(whole[~probed])
        probe.append(whole[probed])
        # Segment 0: every set's one-deletion keys are indexed apart, for the few that look there.
        less = mix(s.sums[0] - scrambled[s.order[: s.counts[0]]] + s.seeds[0])
        index.append(mix(less ^ D_SPACE))
        if deep:
            probe += [mix(whole[:1] ^ D_SPACE), less]
    return np.concatenate(index), np.concatenate(probe)


def set_rows(docs: DataFrame, key: str, text: str, width: int, threshold: Threshold) -> DataFrame:
    """``id, n, d1, d2, s0.., wide, index_keys, probe_keys`` per row of ``docs``: the set's size, its
    digest, its sketch (large sets have a wide one as well) and its keys. Of equal sets one task emits
    keys once."""
    unused = np.uint64(64 - KEY_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for part in slices(batches, ROUND_ROWS):
            sizes, low, high, bits, wide, index, probe = [], [], [], [], [], [], []
            for i, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                elements = shingles(value, width)
                digest = hashlib.blake2b(elements.tobytes(), digest_size=16).digest()
                sizes.append(len(elements))
                low.append(int.from_bytes(digest[:8], "little", signed=True))
                high.append(int.from_bytes(digest[8:], "little", signed=True))
                bits.append(parities(elements))
                wide.append(wide_parities(elements) if len(elements) > SKETCH else None)
                if not len(elements) or i is None or digest in seen:
                    index.append(None)
                    probe.append(None)
                    continue
                if len(seen) < SEEN_SETS:
                    seen.add(digest)
                a, b = keys_of(elements, threshold)
                index.append((a >> unused).view(np.int64))
                probe.append((b >> unused).view(np.int64))
            found = np.array(bits, np.int64).reshape(-1, len(BITS))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(high, pa.int64()),
                    *(pa.array(found[:, i]) for i in range(len(BITS))),
                    pa.array(wide, pa.binary()),
                    pa.array(index, pa.list_(pa.int64())),
                    pa.array(probe, pa.list_(pa.int64())),
                ],
                names=["id", "n", "d1", "d2", *BITS, "wide", "index_keys", "probe_keys"],
            )

    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    numbers = ", ".join(f"{c} bigint" for c in ("id", "n", "d1", "d2", *BITS))
    return rows.mapInArrow(run, f"{numbers}, wide binary, index_keys array<bigint>, probe_keys array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, width: int, threshold: Threshold) -> DataFrame:
    """Of ``a, b, split``, the pairs ``a, b`` that link by their whole texts (``id, t``).

    ``split`` says over how many tasks the pairs of one ``b`` are dealt; its text goes to each.
    ``pairs`` should be written. Where rows of one id have different texts, any of them may link."""
    wanted = small_or_not(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), 32)
    texts = texts.join(wanted, F.col("id") == F.col("_id"), "left_semi").select("id", "t").distinct()
    sides = pairs.groupBy("b").agg(F.max("split").alias("split"))
    right = (
        texts.select(F.col("id").alias("b"), F.col("t").alias("tb"))
        .join(sides, "b")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("split").cast("int") - 1)))
        .drop("split")
    )
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a")
    left = left.withColumn("salt", F.pmod(F.xxhash64("a"), F.col("split")).cast("int"))
    both = left.join(right, ["b", "salt"]).select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for part in slices(batches, ROUND_ROWS):
            keep = []
            for b, ta, tb in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if (b, tb) != last:
                    last, known = (b, tb), shingles(tb, width)
                own = shingles(ta, width)
                common = len(np.intersect1d(own, known, assume_unique=True))
                keep.append(threshold.links(common, len(own), len(known)))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def near_groups(
    docs: DataFrame,
    width: int = WORDS,
    threshold: Threshold | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, is_class`` for every row of ``docs``.

    The component is the smallest id reachable by links. Null and empty texts, and texts without
    words, have the empty set and are linked with nothing; rows with a null id are linked with
    nothing and have a null component. Rows of one id are one node. Shingles are compared by 64-bit
    hashes; ids are whole numbers. An empty table gives no rows; other columns are ignored.

    Equal sets are one class, represented by its smallest id; under keys it goes by half of its digest. Classes that share a key first meet
    the key's hub, the class with the most shared keys: in a large group of near copies that is
    its origin, so the group becomes one component in a number of checks that is linear in its
    size. Classes that share a key and are still in different components are then joined once more,
    by single elements, of which each probes its rarest. So every link between components is found,
    but no pair inside one needs a check, and few that are alike but not enough.
    """
    ship(docs.sparkSession)
    threshold = threshold or Threshold()
    scratch = Scratch(docs.sparkSession)
    sets = scratch.write(set_rows(docs, key, text, width, threshold), "sets")
    nodes = sets.where("n > 0 and id is not null")
    classes = scratch.write(nodes.groupBy("d1", "d2").agg(F.min("id").alias("rep")), "classes")
    class_of = scratch.write(
        sets.select("id", "n", "d1", "d2").join(classes, ["d1", "d2"], "left").select(
            "id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("rep")).alias("rep")
        ),
        "class_of",
    )
    sketches = scratch.write(_sketches(nodes), "sketches")
    wides = scratch.write(_wide_sketches(nodes), "wides")
    met = _meetings(scratch, sets)
    scratch.drop("sets")
    texts = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    links = _links(scratch, texts, met, classes, sketches, wides, width, threshold)
    scratch.drop("classes", "sketches", "wides")
    # An id whose rows have different texts is in several classes, and joins them.
    of_id = class_of.where("rep is not null").groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    several = of_id.where("a <> b").select("id", "a")
    roots = connected_components(links.union(class_of.join(several, "id").select("a", F.col("rep").alias("b"))))
    scratch.drop("links", "links_apart")
    found = class_of.join(roots, class_of["rep"] == roots["node"], "left")
    kind = docs.schema[key].dataType
    return found.select(
        F.col("id").cast(kind).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("root", "rep", "id").cast(kind).alias("component_id"),
        F.coalesce(F.col("id") == F.col("rep"), F.lit(True)).alias("is_class"),
    )


def _sketches(nodes: DataFrame) -> DataFrame:
    """``id, n, s0..`` once for each id; null where rows of one id have different sets."""
    same = (F.min("d1") == F.max("d1")) & (F.min("d2") == F.max("d2"))
    return nodes.groupBy("id").agg(*(F.when(same, F.min(c)).alias(c) for c in ("n", *BITS)))


def _may_link(a: str, b: str, threshold: Threshold) -> str:
    """Whether sizes and sketches of the aliases ``a`` and ``b`` allow a link; true where one is not known."""
    short, whole = threshold.numerator, threshold.denominator
    differ = " + ".join(f"bit_count({a}.{c} ^ {b}.{c})" for c in BITS)
    alike = f"({differ}) * {whole + short}L <= ({a}.n + {b}.n) * {whole - short}L"
    sizes = f"least({a}.n, {b}.n) * {whole}L >= greatest({a}.n, {b}.n) * {short}L"
    return f"({a}.n is null or {b}.n is null or ({sizes} and {alike}))"


def _wide_sketches(nodes: DataFrame) -> DataFrame:
    """``id, n, wide`` once for each id that has a wide sketch; null where rows of one id have different sets."""
    same = (F.min("d1") == F.max("d1")) & (F.min("d2") == F.max("d2"))
    large = nodes.groupBy("id").agg(F.when(same, F.min("n")).alias("n"), F.when(same, F.max("wide")).alias("wide"))
    return large.where("wide is not null")


def _not_ruled_out(pairs: DataFrame, wides: DataFrame, threshold: Threshold) -> DataFrame:
    """The ``pairs`` (``a, b, split``) whose wide sketches allow a link, and those of which one has none."""
    x, y = (wides.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"w{c}")) for c in "ab")
    both = pairs.join(x, "a", "left").join(y, "b", "left").select("a", "b", "split", "na", "wa", "nb", "wb")
    short, whole = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, ROUND_ROWS):
            keep = []
            for na, wa, nb, wb in zip(*(part.column(i).to_pylist() for i in range(3, 7)), strict=True):
                known = wa is not None and wb is not None
                keep.append(not known or wide_difference(wa, wb) * (whole + short) <= (na + nb) * (whole - short))
            yield part.select(["a", "b", "split"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint, split bigint")


def _meetings(scratch: Scratch, sets: DataFrame) -> DataFrame:
    """``key, d1, probe, c``: the classes under each key that several share and one probes, by the
    first half of their digest, and how many they are."""
    # The most rows there are, so they are dealt by key once, and each sees what its key holds.
    index = sets.select(F.explode("index_keys").alias("key"), "d1", F.lit(0).cast("tinyint").alias("probe"))
    probes = sets.select(F.explode("probe_keys").alias("key"), "d1", F.lit(1).cast("tinyint").alias("probe"))
    of_key = Window.partitionBy("key")
    several = F.min("d1").over(of_key) < F.max("d1").over(of_key)
    shared = index.union(probes).select("key", "d1", "probe", several.alias("several"), F.max("probe").over(of_key).alias("p"))
    shared = shared.where("several and p = 1")
    # Of a class one row per key stays; rows still lie together by key, so this takes no further shuffle.
    met = shared.groupBy("key", "d1").agg(F.max("probe").alias("probe"))
    return scratch.write(met.withColumn("c", F.count("*").over(of_key)), "met")


def _links(
    scratch: Scratch,
    texts: DataFrame,
    met: DataFrame,
    classes: DataFrame,
    sketches: DataFrame,
    wides: DataFrame,
    width: int,
    threshold: Threshold,
) -> DataFrame:
    weight = met.groupBy("d1").agg(F.sum(F.col("c") - 1).alias("w")).join(classes.select("d1", "rep"), "d1")
    rows = scratch.write(met.join(weight, "d1").select("key", "rep", "probe", "w"), "weighed")
    scratch.drop("met")
    hub = F.max(F.struct("w", F.negative("rep").alias("minus"), "probe")).over(Window.partitionBy("key"))
    rows = rows.withColumn("hub", hub).select(
        "key", "rep", "probe", "w", (-F.col("hub.minus")).alias("b"), F.col("hub.w").alias("bw"), F.col("hub.probe").alias("bp")
    )
    # A hub has then met all of its key, so of the key the others remain.
    rows = scratch.write(rows.where("rep <> b"), "others")
    scratch.drop("weighed")
    pairs = (
        rows.where("probe + bp > 0")
        .groupBy(F.col("rep").alias("a"), "b")
        .agg((F.floor(F.max("bw") / HUB_SPLIT) + 1).alias("split"))
    )
    # Sizes and sketches rule most pairs out before any text is read.
    x, y = sketches.alias("x"), sketches.alias("y")
    pairs = pairs.join(x, F.col("a") == F.col("x.id")).join(y, F.col("b") == F.col("y.id"))
    pairs = scratch.write(pairs.where(_may_link("x", "y", threshold)).select("a", "b", "split"), "alike")
    pairs = scratch.write(_not_ruled_out(pairs, wides, threshold), "pairs")
    links = scratch.write(verified(pairs, texts, width, threshold), "links")
    roots = connected_components(links)
    named = rows.select("key", "rep", "probe").join(roots, rows["rep"] == roots["node"], "left")
    named = scratch.write(named.select("key", "rep", "probe", F.coalesce("root", "rep").alias("comp")), "named")
    split = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("probe").alias("p"))
    split = split.where("lo <> hi and p = 1").select("key")
    apart = scratch.write(named.join(split, "key", "left_semi").select("rep", "comp").distinct(), "apart")
    scratch.drop("others", "alike", "pairs", "named")
    rest = scratch.write(_rarest_meetings(scratch, texts, apart, sketches, width, threshold), "alike_apart")
    rest = scratch.write(_not_ruled_out(rest, wides, threshold), "pairs_apart")
    more = scratch.write(verified(rest, texts, width, threshold), "links_apart")
    scratch.drop("apart", "rarest", "sketches_apart", "alike_apart", "pairs_apart")
    return links.union(more)


def parities(elements: np.ndarray) -> np.ndarray:
    """SKETCH bits as 64-bit words: whether an odd number of elements hashes to each bit. An element
    that only one of two sets has changes one bit, so they differ in at least as many elements as
    their sketches differ in bits."""
    place = (mix(elements ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(SKETCH)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=SKETCH).astype(np.uint8) & 1).view(np.int64)


def wide_parities(elements: np.ndarray) -> bytes:
    """As ``parities``, with a power of two of bits that is at least the set's size, up to MOST_WIDE."""
    bits = min(MOST_WIDE, 1 << (len(elements) - 1).bit_length())
    place = (mix(elements ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits).astype(np.uint8) & 1).tobytes()


def wide_difference(one: bytes, other: bytes) -> int:
    """In how many bits two wide sketches differ. The longer is folded: its halves are added up."""
    x, y = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _tallies(read: DataFrame, width: int) -> np.ndarray:
    """How many elements of the sets of ``read`` (``rep, comp, t``) hash to each of TALLIES counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(TALLIES, np.int64)
        for part in slices(batches, ROUND_ROWS):
            elements = np.concatenate([scramble(shingles(t, width)) for t in part.column(2).to_pylist()])
            found += np.bincount(_tally_of(elements), minlength=TALLIES)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["tally", "often"])

    sums = read.mapInArrow(run, "tally bigint, often bigint").groupBy("tally").agg(F.sum("often").alias("often"))
    table = sums.toArrow()  # TALLIES rows at most
    out = np.zeros(TALLIES, np.int64)
    out[table["tally"].to_numpy()] = table["often"].to_numpy()
    return out


def _tally_of(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(11)).astype(np.int64) % TALLIES


def _rarest_meetings(
    scratch: Scratch, texts: DataFrame, apart: DataFrame, sketches: DataFrame, width: int, threshold: Threshold
) -> DataFrame:
    """``a, b, split``: pairs of classes ``rep`` in different components ``comp`` that may link.

    The finest partition of the universe has an element in each segment. Of two linked sets either
    lacks at most ``differ`` of the other's elements, so each takes one more than that of its own as
    keys, allocated by cost: those in the fewest components first, as far as a fixed number of
    counts can tell them apart. As both allocate in the same order, the first common element is a
    key of both, whatever the counts say. Where sets that are alike but not enough meet all the
    same, sizes and sketches rule most pairs out before they leave the join.
    """
    # One class stands for its component in the counts: what only its copies share is rare.
    leads = apart.groupBy("comp").agg(F.min("rep").alias("rep"))
    often = _tallies(_texts_of(texts, leads), width)
    short, whole = threshold.numerator, threshold.denominator

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, ROUND_ROWS):
            chosen = []
            for t in part.column(2).to_pylist():
                elements = scramble(shingles(t, width))
                order = np.lexsort((elements, often[_tally_of(elements)]))
                differ = len(elements) - -(-len(elements) * short // whole)
                chosen.append(elements[order[: differ + 1]])
            lengths = np.array([len(x) for x in chosen])
            columns = [np.repeat(part.column(i).to_numpy(), lengths) for i in (0, 1)]
            keys = (np.concatenate(chosen) >> np.uint64(64 - KEY_BITS)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, *columns)], names=["key", "rep", "comp"])

    keyed = _texts_of(texts, apart).mapInArrow(rarest, "key bigint, rep bigint, comp bigint")
    of_key = Window.partitionBy("key")
    split = keyed.select("*", (F.min("comp").over(of_key) < F.max("comp").over(of_key)).alias("split")).where("split")
    # Rows of one id are one class; they still lie together by key, so this takes no further shuffle.
    # What is dealt by key is narrow; the sketches come to it there, if they fit a broadcast.
    rows = scratch.write(split.select("key", "rep", "comp").distinct(), "rarest").repartition("key")
    known = sketches.join(apart.select("rep").distinct(), F.col("id") == F.col("rep"), "left_semi")
    known = small_or_not(scratch.write(known, "sketches_apart"), SKETCH // 8 + 40)
    met = rows.join(known, F.col("rep") == known["id"]).select("key", "rep", "comp", "n", *BITS)
    p, q = met.alias("p"), met.alias("q")
    alike = F.expr(f"p.comp <> q.comp and p.rep < q.rep and {_may_link('p', 'q', threshold)}")
    found = p.join(q, (F.col("p.key") == F.col("q.key")) & alike)
    pairs = found.select(F.col("p.rep").alias("a"), F.col("q.rep").alias("b")).distinct()
    return pairs.withColumn("split", F.lit(1).cast("bigint"))


def _texts_of(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """``rep, comp, t`` of the rows whose id is one of the written ``classes``."""
    return texts.join(small_or_not(classes, 32), F.col("id") == F.col("rep")).select("rep", "comp", "t")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id. Of repeated rows with
    that id one stays (the first by text); rows without id, or without words, all stay."""
    groups = cut_lineage(near_groups(docs, key=key, text=text, **options))
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    kept = without_ids(docs, cut_lineage(gone), key)
    again = cut_lineage(
        groups.where("component_id = doc_id and n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id")
    )
    if again.isEmpty():
        return kept
    small = small_or_not(again.toDF("_again"), 32)
    repeated = kept.join(small, kept[key] == small["_again"], "left_semi")
    picked = repeated.groupBy(F.col(f"`{key}`").alias("_k")).agg(
        F.min(F.struct(F.col(f"`{text}`").alias("_first"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))).alias("_m")
    )
    return without_ids(kept, again, key).unionByName(picked.select("_m._row.*"))
