"""Byte-level BPE encoding and decoding with a public vocabulary.

Encoding pops the lowest merge rank from a priority queue over a doubly linked list of symbols; an entry whose symbols
have changed since it was pushed is stale and skipped. That is n log n in a word's length. Decoding concatenates
vocabulary strings. The vocabulary file is read by each Python worker from ``path``; texts never leave their task.

Defined results: a null or empty text has no ids and decodes to the empty text; strings of added tokens become their
ids, as the tokenizers library does; every text decodes to itself.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edilake.llm.tokens import chunks

# fixed values: the split pattern of the vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# bytes of ids and words, with what Python adds to each, that a worker remembers
CACHED_BYTES, ENTRY_BYTES = 72_000_000, 170
GROUP_BYTES, WORDS_AT_ONCE = 1_000_000, 1 << 16


def printable_bytes() -> list[str]:
    """The character that stands for each byte in vocabulary files: itself if printable, else the next one from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        chars = printable_bytes()
        byte_of = {c: b for b, c in enumerate(chars)}
        self.byte_ids = [vocab[c] for c in chars]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items()}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings.update((i, s.encode()) for s, i in added.items())
        self.added = {s: np.array([i], "<u4").tobytes() for s, i in added.items()}
        self.split_added = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(added, key=len, reverse=True)) + ")")
        self.words = regex.compile(PATTERN)
        self.forget()

    def forget(self) -> None:
        self.cache: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.cached = 0

    def encode_word(self, word: str) -> bytes:
        """Ids of one word as packed little-endian unsigned 32-bit integers."""
        ids = [self.byte_ids[b] for b in word.encode()]
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            found = merges.get((ids[i], ids[i + 1]))
            if found:
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, merged = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the symbols has been merged since
            ids[i], ids[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get((merged, ids[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, merged, ids[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((ids[h], merged))
                if found:
                    heapq.heappush(queue, (found[0], h, ids[h], merged, found[1]))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def encode_words(self, words: list[str]) -> bytes:
        for w in set(words).difference(self.cache):
            ids = self.cache[w] = self.before.get(w) or self.encode_word(w)
            self.cached += 2 * len(w) + len(ids) + ENTRY_BYTES
        out = b"".join(map(self.cache.__getitem__, words))
        if self.cached > CACHED_BYTES // 2:
            # words that come again within the next half are kept
            self.before, self.cache, self.cached = self.cache, {}, 0
        return out

    def encode(self, text: str) -> bytes:
        out = []
        for piece in self.split_added.split(text) if self.added else [text]:
            if piece in self.added:
                out.append(self.added[piece])
            elif len(piece) < GROUP_BYTES:
                out.append(self.encode_words(self.words.findall(piece)))
            else:
                found = self.words.finditer(piece)
                while words := [m.group() for m in itertools.islice(found, WORDS_AT_ONCE)]:
                    out.append(self.encode_words(words))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@functools.cache
def load(path: str) -> Bpe:
    return Bpe(path)


def _mapped(docs: DataFrame, path: str, source: str, made: dict[str, T.DataType], convert) -> DataFrame:
    """``docs`` with the columns ``made``, which ``convert`` gives for each value of ``source``; columns of those names
    are replaced. One Python worker a task, which handles about ``GROUP_BYTES`` at a time and forgets its words after
    the partition."""
    rest = [c for c in docs.columns if c not in made]
    schema = T.StructType([f for f in docs.schema.fields if f.name not in made] + [T.StructField(k, t) for k, t in made.items()])
    kinds = [pa.binary() if isinstance(t, T.BinaryType) else pa.string() for t in made.values()]

    def run(batches):
        bpe = load(path)
        for batch in batches:
            values = batch.column(batch.num_columns - 1)
            lengths = pc.fill_null(pc.binary_length(values), 0).to_pylist()
            at = 0
            for group in chunks(lengths, int, GROUP_BYTES):
                own = values.slice(at, len(group)).to_pylist()
                columns = zip(*(convert(bpe, v) for v in own), strict=True)
                part = batch.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                                                 [*rest, *made])
        bpe.forget()

    return docs.select(*(F.col(f"`{c}`") for c in rest), F.col(f"`{source}`").alias("__source")).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the packed ids (little-endian unsigned 32-bit) of column ``text`` as binary column ``ids``."""
    return _mapped(docs, path, text, {ids: T.BinaryType()}, lambda bpe, t: (bpe.encode(t or ""),))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of packed ``ids``; null ids are no ids."""
    return _mapped(docs, path, ids, {text: T.StringType()}, lambda bpe, p: (bpe.decode(p or b""),))


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and then ``decode`` in one pass."""
    def convert(bpe, t):
        packed = bpe.encode(t or "")
        return packed, bpe.decode(packed)

    return _mapped(docs, path, text, {ids: T.BinaryType(), decoded: T.StringType()}, convert)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: token count, digest of the ids, digest of the text decoded from them."""
    coded = round_trip(docs.select("doc_id", "text"), path)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
