"""Token counts: batch encoding inside Arrow functions that returns lengths only."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, ship
from .pieces import PieceCache, cut

# Characters that one call of the tokenizer gets, and one round of texts.
BATCH_CHARS = 256 << 10
ROUND_CHARS = 4 << 20

_counters: dict[str, PieceCache] = {}


def _counter(path: str) -> PieceCache:
    """One cache for each worker and tokenizer file."""
    if path not in _counters:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()

        def lengths(texts: list[str]) -> Iterator[int]:
            texts_by_call = ([texts[i] for i in run] for run in by_bytes(texts, BATCH_CHARS))
            for batch in texts_by_call:
                yield from map(len, tokenizer.encode_batch_fast(batch, add_special_tokens=False))

        _counters[path] = PieceCache(lengths)
    return _counters[path]


def token_lengths(texts: list[str | None], path: str) -> list[int]:
    """Tokens of each text as the tokenizer in ``path`` gives them, without added special tokens;
    special strings in a text count as the library counts them. Null counts as empty."""
    counter = _counter(path)
    out: list[int] = []
    plain = [t or "" for t in texts]
    for run in by_bytes(plain, ROUND_CHARS):
        out += map(sum, counter.values([cut(plain[i]) for i in run]))
    return out


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``path`` names a byte-level BPE file of the tokenizers library, present on every executor. Rows
    are encoded where they are read; nothing is shuffled. Texts are cut at safe boundaries, equal
    pieces are encoded once for a round, and rounds and calls are bounded in characters, so a long
    text costs no more memory than its own size. Null and empty texts have 0 bytes and tokens;
    repeated rows and null keys each give a row; other columns, whatever their names, are ignored.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = token_lengths(texts, path)
            sizes = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=["k", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    counted = rows.mapInArrow(run, f"k {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return counted.withColumnRenamed("k", key)
