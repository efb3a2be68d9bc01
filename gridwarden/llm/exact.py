"""Exact copies through a cuckoo-filter index of live digests, split by digest into shards."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_of

SLOTS = 4
MOST_KICKS = 200
SHARD_KEYS = 100_000
MASK = (1 << 64) - 1


def _mix(x: int) -> int:
    x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & MASK
    return x ^ (x >> 29)


class CuckooIndex:
    """Fingerprints of live digests in buckets of four, and the digests' entries in buckets beside them.

    A digest's fingerprint sits in one of two buckets; either is found from the other and the
    fingerprint. The filter is asked first: a miss is final, and what is new goes in without a look
    at any entry. A hit is only a hint and is verified against the one bucket of entries that the
    digest belongs to. When an insertion finds no place, filter and entries double and are filled
    again from the stored digests. ``reads`` counts the buckets of entries that were looked into.
    """

    def __init__(self, buckets: int = 64):
        self.resizes = self.reads = self.live = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.n = buckets
        self.table: list[list[int]] = [[] for _ in range(buckets)]
        self.entries: list[list[tuple[str, tuple]]] = [[] for _ in range(buckets)]

    def _places(self, digest: str) -> tuple[int, int, int]:
        value = int(digest[:32], 16)
        print_ = (value & 0xFFFF) or 1
        first = (value >> 16) & (self.n - 1)
        return print_, first, first ^ (_mix(print_) & (self.n - 1))

    def items(self) -> Iterator[tuple[str, tuple]]:
        for bucket in self.entries:
            yield from bucket

    @property
    def content(self) -> dict[str, tuple]:
        return dict(self.items())

    def may_hold(self, digest: str) -> bool:
        print_, a, b = self._places(digest)
        return print_ in self.table[a] or print_ in self.table[b]

    def _find(self, digest: str) -> tuple[list, int] | None:
        """The verified place of a live digest's entry."""
        if not self.may_hold(digest):
            return None
        self.reads += 1
        bucket = self.entries[self._places(digest)[1]]
        return next(((bucket, i) for i, (d, _) in enumerate(bucket) if d == digest), None)

    def get(self, digest: str) -> tuple | None:
        found = self._find(digest)
        return found and found[0][found[1]][1]

    def insert(self, digest: str, value: tuple) -> None:
        if self._find(digest):
            raise KeyError(f"{digest} is live already")
        self._add(digest, value)
        self.live += 1

    def update(self, digest: str, value: tuple) -> None:
        """Another value for a live digest; the filter stays as it is."""
        found = self._find(digest)
        if not found:
            raise KeyError(f"{digest} is not live")
        found[0][found[1]] = (digest, value)

    def _add(self, digest: str, value: tuple) -> None:
        self.entries[self._places(digest)[1]].append((digest, value))
        if not self._place(digest):
            stored = list(self.items())
            while True:  # a whole refill may need another doubling
                self.resizes += 1
                self._clear(2 * self.n)
                for d, v in stored:
                    self.entries[self._places(d)[1]].append((d, v))
                if all(self._place(d) for d, _ in stored):
                    break

    def _place(self, digest: str) -> bool:
        print_, a, b = self._places(digest)
        for bucket in (a, b):
            if len(self.table[bucket]) < SLOTS:
                self.table[bucket].append(print_)
                return True
        bucket = a
        for kick in range(MOST_KICKS):
            slot = kick % SLOTS
            print_, self.table[bucket][slot] = self.table[bucket][slot], print_
            bucket ^= _mix(print_) & (self.n - 1)
            if len(self.table[bucket]) < SLOTS:
                self.table[bucket].append(print_)
                return True
        return False

    def delete(self, digest: str) -> tuple | None:
        """Take a live digest out; None if it isn't there."""
        found = self._find(digest)
        if not found:
            return None
        bucket, i = found
        value = bucket.pop(i)[1]
        print_, a, b = self._places(digest)
        self.table[a if print_ in self.table[a] else b].remove(print_)
        self.live -= 1
        return value


def shards_for(rows: int, shard_keys: int = SHARD_KEYS) -> int:
    """A power of two, so that a shard holds about ``shard_keys`` digests at most."""
    return 1 << max(0, -(-max(rows, 1) // shard_keys) - 1).bit_length()


def live_digests(entries: DataFrame, shards: int) -> DataFrame:
    """``digest, keep_id, group_size`` of the digests that are live after all ``entries``.

    ``entries`` has ``digest`` (lowercase hex), ``doc_id`` and ``n``: the number of rows it stands
    for. Negative ``n`` takes rows away, and a digest with none left is deleted. A shard is a range
    of digests, so one hot digest meets the others of its shard only as entries, not as rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, last = CuckooIndex(), None

        def result() -> Iterator[pd.DataFrame]:
            items = list(index.items())
            for at in range(0, len(items), 10_000):
                yield pd.DataFrame(
                    [(d, k, n) for d, (k, n) in items[at : at + 10_000]], columns=["digest", "keep_id", "group_size"]
                ).astype({"keep_id": "Int64"})

        for batch in batches:
            for shard, digest, doc_id, n in zip(
                batch["shard"], batch["digest"], batch["doc_id"], batch["n"], strict=True
            ):
                if shard != last:
                    yield from result()
                    index, last = CuckooIndex(), shard
                keep = None if pd.isna(doc_id) else int(doc_id)
                live = index.get(digest)  # most digests are new: the filter says so
                if live is None:
                    if n > 0:
                        index.insert(digest, (keep, int(n)))
                    continue
                keep = max((k for k in (keep, live[0]) if k is not None), default=None)
                if n + live[1] > 0:
                    index.update(digest, (keep, int(n + live[1])))
                else:
                    index.delete(digest)
        yield from result()

    # In the order of a digest's entries additions come first, so that a deletion finds its digest.
    shard = F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint") % shards
    dealt = entries.select(shard.alias("shard"), "digest", F.col("doc_id").cast("bigint").alias("doc_id"), "n")
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", F.desc("n"), "doc_id")
    return dealt.mapInPandas(run, "digest string, keep_id bigint, group_size bigint")


def exact_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shard_keys: int = SHARD_KEYS
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row; the largest id of equal texts stays.

    Texts are equal when identical; null counts as empty. ``kept`` marks the rows whose id is the
    group's largest (repeated rows of that id all carry it; a null id is below all others). Copies
    that one task reads are added up before the shuffle, so a text that a third of all rows share
    reaches its shard as one entry for each task. Only digests and ids move, never texts.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.sha2(text_of(text).cast("binary"), 256).alias("digest")
    )
    shards = shards_for(docs.count(), shard_keys)
    live = live_digests(_entries(rows), shards)
    found = rows.join(live, "digest")
    return found.select(
        "doc_id",
        F.col("keep_id").cast(docs.schema[key].dataType).alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _entries(rows: DataFrame) -> DataFrame:
    """Each digest once for each batch that a task reads, with its largest id and the number of its rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grouped = batch.astype({"doc_id": "Int64"}).groupby("digest", sort=False)["doc_id"]
            yield pd.DataFrame({"doc_id": grouped.max(), "n": grouped.size().astype("int64")}).reset_index()

    return rows.select("digest", F.col("doc_id").cast("bigint")).mapInPandas(
        run, "digest string, doc_id bigint, n bigint"
    )
