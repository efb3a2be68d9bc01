"""Byte pair encoding by backtracking over longest matches, and decoding through an offset table.

A sequence of tokens is what the merges give exactly if every token encodes to itself and no two
neighbours would be joined or cut otherwise by the merges of the two together. So a piece needs no
merging: from left to right the longest token that fits its left neighbour is taken; where none
fits, the last one gives way to its longest prefix that is a token. A place that led nowhere is
marked and never entered again, which makes the whole linear in the piece's length.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, slices

ROUND_ROWS = 200  # texts that are Python objects at a time
CACHED_PIECES = 400_000
CACHED_LENGTH = 64
CACHED_PAIRS = 1_000_000
BLOCK_TOKENS = 1 << 20  # tokens decoded at once
NEVER = 1 << 62

#: The last character of a word carries the end mark as another character, this far away.
ENDING = 0x1000
BETWEEN = "\n"  # no token holds it: byte-level characters are all visible

# The pieces of this family of tokenizers, after these normalisers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

#: Latin texts without other white space or control characters, which need no normalising but lower
#: case: the pattern's classes are spelled out for them and one pass finds the pieces.
LATIN = re.compile("[\\t\\n\\r -~\xa1-\u012f\u0131-\u024f]*")
LATIN_END = 0x250


def _latin_class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(LATIN_END) if unicodedata.category(chr(c))[0] == kind)


LATIN_PIECES = re.compile(
    PATTERN.replace(r"\s", " \t\n\r").replace(r"\p{L}", _latin_class("L")).replace(r"\p{N}", _latin_class("N"))
)
#: Each byte as the visible character that byte-level pieces have for it: itself where it is one.
VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTES = dict(zip([b for b in range(256) if b not in VISIBLE], map(chr, range(256, 512)), strict=False))


class Vocabulary:
    """The tables of one tokenizer file: tokens, their parts, ranks, shorter prefixes and texts.

    Takes files of the tokenizers library with a BPE model on byte-level pieces, with or without an
    end-of-word suffix. What this encoder doesn't do (dropout, byte fallback, prefixes inside words,
    added tokens that strip blanks or look at normalised text) raises a ValueError.
    """

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        odd = [k for k in ("dropout", "byte_fallback", "continuing_subword_prefix", "ignore_merges") if model.get(k)]
        added = spec["added_tokens"]
        if model["type"] != "BPE" or odd or spec["decoder"] or spec["post_processor"]:
            raise ValueError(f"{path}: not a plain BPE file ({', '.join(odd) or model['type']})")
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: added tokens that look at their surroundings")
        library = Tokenizer.from_file(path)
        self.normalized = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in added}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if added else None
        names = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.latin = names == NORMALIZERS and splits[0].get("pattern") == {"Regex": PATTERN}
        self.latin_known: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self._merges(model)
        self._automaton(ahocorasick)
        self._texts(model["vocab"], self.special)
        self.pairs: dict[tuple[int, int], bool] = {}

    def _merges(self, model: dict) -> None:
        suffix = model.get("end_of_word_suffix") or ""
        self.ends_words = bool(suffix)

        def form(token: str) -> str:
            if suffix and token.endswith(suffix) and token != suffix:
                token = token[: -len(suffix)]
                return token[:-1] + chr(ord(token[-1]) + ENDING)
            return token

        vocab = model["vocab"]
        self.form = {i: form(t) for t, i in vocab.items()}
        self.rank = dict.fromkeys(vocab.values(), -1)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.joins: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            x, y, whole = vocab[a], vocab[b], vocab[a + b]
            if self.rank[whole] >= 0 or whole in (x, y):
                raise ValueError(f"two merges make {a + b!r}")
            self.rank[whole], self.left[whole], self.right[whole] = rank, x, y
            self.joins[x, y] = rank
        for whole, x in self.left.items():
            if max(self.rank[x], self.rank[self.right[whole]]) > self.rank[whole]:
                raise ValueError("a merge stands before one that makes its part")

    def _automaton(self, ahocorasick) -> None:
        """An Aho-Corasick automaton of the tokens that encode to themselves, and for each of them
        the longest such token that is a proper prefix of it."""
        self.whole: dict[str, int] = {}
        good: dict[int, bool] = {}
        for i in sorted(self.rank, key=self.rank.__getitem__):  # parts come before what they make
            rank = self.rank[i]
            good[i] = rank < 0 or (
                good[self.left[i]] and good[self.right[i]] and self._apart(self.left[i], self.right[i], rank, rank)
            )
            if good[i] and (rank >= 0 or len(self.form[i]) == 1):
                self.whole[self.form[i]] = i
        self.length = {i: len(f) for f, i in self.whole.items()}
        self.shorter: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for f, i in self.whole.items():
            self.automaton.add_word(f, i)
            for size in range(len(f) - 1, 0, -1):
                if f[:size] in self.whole:
                    self.shorter[i] = self.whole[f[:size]]
                    break
        self.automaton.make_automaton()

    def _texts(self, vocab: dict[str, int], special: dict[str, int]) -> None:
        """The offset table: every token's text and the blank after it, end to end."""
        self.size = max([*vocab.values(), *special.values()]) + 1
        texts = [b""] * self.size
        for t, i in [*vocab.items(), *special.items()]:
            texts[i] = t.encode() + b" "
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)

    def _apart(self, x: int, y: int, x_until: int, y_until: int) -> bool:
        """Whether the border between two tokens outlives all merges before the given ranks.

        Merges go by rank, so what stands beside the border at any time follows from undoing them,
        the later first. A merge over the border takes place if both its sides are there before
        their own next merges; of equal ranks the left one is done first."""
        while True:
            rank = self.joins.get((x, y))
            if rank is not None and rank < x_until and rank <= y_until:
                return False
            if self.rank[x] > self.rank[y]:
                x_until, x = self.rank[x], self.right[x]
            elif self.rank[y] >= 0:
                y_until, y = self.rank[y], self.left[y]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether two tokens that encode to themselves stay as they are side by side."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._apart(a, b, NEVER, NEVER)
        return known

    def encode_forms(self, forms: list[str]) -> list[list[int]]:
        """The tokens of each of the pieces, all found by one pass of the automaton."""
        text = BETWEEN.join(forms)
        longest: list[int | None] = [None] * (len(text) + 1)
        length = self.length
        for end, token in self.automaton.iter(text):  # by growing end, so the longest comes last
            longest[end - length[token] + 1] = token
        out, at = [], 0
        for form in forms:
            out.append(self._walk(longest, at, at + len(form)))
            at += len(form) + len(BETWEEN)
        return out

    def _walk(self, longest: list[int | None], start: int, end: int) -> list[int]:
        tokens: list[int] = []
        dead: set[int] = set()
        at, token = start, longest[start]
        while at < end:
            while token is not None:
                after = at + self.length[token]
                if after not in dead and (not tokens or self.compatible(tokens[-1], token)):
                    break
                token = self.shorter.get(token)
            if token is not None:
                tokens.append(token)
                at, token = after, longest[after]
            elif tokens:
                dead.add(at)
                last = tokens.pop()
                at -= self.length[last]
                token = self.shorter.get(last)
            else:
                raise ValueError("a byte has no token")
        return tokens

    def pieces(self, text: str) -> Iterator[str | int]:
        """A text as byte-level pieces and the ids of special strings, by the library."""
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.special:
                yield self.special[part]
            elif part:
                yield from (piece for piece, _ in self.split(self.normalized(part)))

    def add(self, known: dict[str, bytes], new: list[str], byte_level: list[str]) -> None:
        """The ids of pieces, packed, under the given names."""
        forms = [p[:-1] + chr(ord(p[-1]) + ENDING) for p in byte_level] if self.ends_words else byte_level
        apart = [f for f in forms if f not in self.whole]
        found = iter(self.encode_forms(apart))
        for name, form in zip(new, forms, strict=True):
            ids = [self.whole[form]] if form in self.whole else next(found)
            known[name] = np.array(ids, np.int32).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The packed ids of each text. Equal pieces are encoded once and kept while they fit."""
        out: list[bytes] = [b""] * len(texts)
        latin, others = {}, {}
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.latin and LATIN.fullmatch(text) and not (self.specials and self.specials.search(text)):
                latin[i] = LATIN_PIECES.findall(text.lower())
            else:
                others[i] = list(self.pieces(text))
        new = [*set().union(*latin.values()) - self.latin_known.keys()]
        self.add(self.latin_known, new, [p.encode().decode("latin-1").translate(BYTES) for p in new])
        for i, pieces in latin.items():
            out[i] = b"".join(map(self.latin_known.__getitem__, pieces))
        more = [*{p for each in others.values() for p in each if isinstance(p, str)} - self.known.keys()]
        self.add(self.known, more, more)
        for i, pieces in others.items():
            out[i] = b"".join(self.known[p] if isinstance(p, str) else np.int32(p).tobytes() for p in pieces)
        for known, names in ((self.latin_known, new), (self.known, more)):
            if len(known) > CACHED_PIECES:
                known.clear()
            for name in names:
                if len(name) > CACHED_LENGTH:
                    known.pop(name, None)
        return out

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> pa.Array:
        """The texts of tokens, ``rows`` giving how many belong to each: token texts with blanks
        between them. An id that isn't in the vocabulary has no text."""
        known = np.where((ids >= 0) & (ids < self.size), ids, 0)
        starts = self.offsets[known]
        sizes = np.where(known == ids, self.offsets[known + 1] - starts, 0)
        ends = np.cumsum(rows)
        row = np.repeat(np.arange(len(rows)), rows)
        filled = np.flatnonzero(sizes)
        last = np.unique(row[filled][::-1], return_index=True)[1] if len(filled) else np.zeros(0, np.int64)
        sizes[filled[::-1][last]] -= 1  # no blank after a text's last token
        upto = np.concatenate([[0], np.cumsum(sizes)])
        blocks = []
        for at in range(0, len(ids), BLOCK_TOKENS):
            end = min(at + BLOCK_TOKENS, len(ids))
            shift = np.repeat(starts[at:end] - upto[at:end], sizes[at:end])
            blocks.append(self.text[np.arange(upto[at], upto[end]) + shift])
        data = np.concatenate(blocks) if blocks else np.zeros(0, np.uint8)
        offsets = np.concatenate([[0], upto[ends]]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One for each Python worker and file."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids`` for every row of ``docs``: the tokens of the whole text as the tokenizers library
    gives them for the file ``path``, without added begin and end tokens; special strings in a text
    become their ids, as there.

    The file must be present on every executor; its tables (bounded by the file) are built once for
    each worker. Rows are encoded where they are read and nothing is shuffled. Null, empty and blank
    texts have no tokens; repeated rows and null keys each give a row; other columns, whatever their
    names, are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for part in slices(batches, ROUND_ROWS):
            found = vocab.encode(part.column(1).to_pylist())
            ends = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["k", "ids"])

    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    return rows.mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode(tokens: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, ids, decoded`` for every row of ``tokens``: the text that the tokenizers library decodes
    from the ids, special tokens included. Null ids count as none, and none give the empty text."""
    ship(tokens.sparkSession)
    kind = tokens.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for part in slices(batches, ROUND_ROWS):
            lists = part.column(1)
            rows = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            columns = [part.column(0), lists, vocab.decode(flat, rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["k", "ids", "decoded"])

    rows = tokens.select(F.col(f"`{key}`").alias("k"), F.col(f"`{ids}`").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"k {kind}, ids array<int>, decoded string").withColumnRenamed("k", key)


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of encoded and decoded rows."""
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        key,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
