"""Token ids as compressed binary files, in ascending doc_id order.

Method: the library's model encodes the distinct pre-tokens that a worker has not
met before, and each document's ids, closed by an end id, follow one another. A segment holds
about ``SEGMENT_BYTES`` of text: its documents' ids and lengths, and the ids in
independently reset, checksummed blocks of a context-mixing range coder
(``range_coder``).

File format of a segment, little endian: 4 bytes ``RLT1``, u32 documents, for
each document an i64 doc_id, for each one byte (1: the doc_id is null), for each
a u32 number of ids, then the coded segment. Segments are rows of Parquet files
(part, before, n_tokens, payload): Spark writes them with its commit protocol to
any store; ``before`` counts the ids of the part's earlier segments.

Distribution: one range shuffle of the texts by doc_id, and by a hash of the text
and a row tag, so that one doc_id (or none) with very many rows does not make one
range; each task writes its range. Places in the whole stream come from the token counts of the parts, one
for each writing task.

Edge cases: null and empty text hold the end id alone; null doc_ids come first;
rows that repeat a doc_id stand next to each other, ordered by a hash of the text;
an empty table gives an empty file; other columns are ignored."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ridelens.llm import range_coder
from ridelens.llm.hashing import mix64
from ridelens.llm.pretokens import SHORT, Words, gather, words_of
from ridelens.llm.shared import id_and_text, pieces
from ridelens.llm.token_counts import byte_letters

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Text bytes of a segment, about; a task's last one may have half as many to twice as many.
SEGMENT_BYTES = 8 << 20
#: Words whose ids a worker keeps, about, before it starts anew.
KEPT_WORDS = 1_000_000

_MAGIC = b"RLT1"
_SEGMENT = "part int, before long, n_tokens long, payload binary"


class _Known:
    """Ids of the words that a worker has met: a number for each word, found by
    its key in an open table and told by its bytes, and for each number the span
    of its ids in one flat array."""

    def __init__(self) -> None:
        self.n, self.n_bytes, self.n_ids = 0, 0, 0
        self.slots = np.full(1 << 16, -1, np.int32)
        self.keys, self.at, self.lengths = np.empty(1, np.uint64), np.empty(1, np.int64), np.empty(1, np.int64)
        self.data = np.empty(1, np.uint8)
        self.starts, self.sizes = np.empty(1, np.int64), np.empty(1, np.int64)
        self.flat = np.empty(1, np.uint32)

    def find(self, cuts: Words) -> np.ndarray:
        """The number of each distinct word of ``cuts``, -1 for unknown ones."""
        out = np.full(len(cuts.keys), -1, np.int32)
        todo, slot = np.arange(len(out)), self._slot(cuts.keys)
        while len(todo):
            number = self.slots[slot]
            used = number >= 0
            same = used & (self.keys[number] == cuts.keys[todo])
            out[todo[same]] = number[same]
            todo, slot = self._further(todo, slot, used & ~same)
        sizes = cuts.ends - cuts.starts
        own = np.flatnonzero((out >= 0) & (sizes > SHORT))  # a short word is its key
        wrong = self.lengths[out[own]] != sizes[own]
        out[own[wrong]] = -1
        own = own[~wrong]
        found = out[own]
        other = gather(self.data, self.at[found], sizes[own]) != gather(cuts.data, cuts.starts[own], sizes[own])
        if other.any():  # another word has the key
            found[np.repeat(np.arange(len(own)), sizes[own])[other]] = -1
        out[own] = found
        return out

    def add(self, cuts: Words, some: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The new numbers of some words of ``cuts``, whose ids are given."""
        n, lengths = self.n + len(some), (cuts.ends - cuts.starts)[some]
        numbers = np.arange(self.n, n, dtype=np.int32)
        self.keys = _joined(self.keys, self.n, cuts.keys[some])
        self.at = _joined(self.at, self.n, self.n_bytes + np.cumsum(lengths) - lengths)
        self.lengths = _joined(self.lengths, self.n, lengths)
        self.data = _joined(self.data, self.n_bytes, gather(cuts.data, cuts.starts[some], lengths))
        self.starts = _joined(self.starts, self.n, self.n_ids + np.cumsum(sizes) - sizes)
        self.sizes = _joined(self.sizes, self.n, sizes)
        self.flat = _joined(self.flat, self.n_ids, flat)
        self.n, self.n_bytes, self.n_ids = n, self.n_bytes + int(lengths.sum()), self.n_ids + len(flat)
        placed = numbers
        if 2 * n > len(self.slots):
            self.slots = np.full(1 << (4 * n - 1).bit_length(), -1, np.int32)
            placed = np.arange(n, dtype=np.int32)
        todo, slot = placed, self._slot(self.keys[placed])
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]
            todo, slot = self._further(todo, slot, self.slots[slot] != todo)
        return numbers

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _further(self, todo: np.ndarray, slot: np.ndarray, go: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return todo[go], (slot[go] + 1) & (len(self.slots) - 1)


def _joined(values: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """The first n values and then more ones, with room that doubles."""
    if n + len(more) > len(values):
        values = np.concatenate([values[:n], np.empty(n + 2 * len(more), values.dtype)])
    values[n : n + len(more)] = more
    return values


@cache
def _library(path: str) -> tuple[Tokenizer, tuple[bytes, ...], _Known]:
    tokenizer = Tokenizer.from_file(path)
    specials = tuple(t.content.encode() for t in tokenizer.get_added_tokens_decoder().values())
    return tokenizer, specials, _Known()


@cache
def _letters(path: str) -> np.ndarray | None:
    """The letters of the bytes, for a library whose words are told to its model
    byte by byte and unchanged."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    cutter = model.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and not model.get("normalizer")
    return np.array([ord(c) for c in byte_letters()], "<u2") if plain else None


def library_ids(words: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of pre-tokens by the library, and how many each has."""
    tokenizer, specials, _ = _library(path)
    raw, letters = b"".join(words), _letters(path)
    try:
        raw.decode()
    except UnicodeDecodeError:
        words = [w.decode("utf-8", "replace").encode() for w in words]
        raw = b"".join(words)
    if letters is None or not set(words).isdisjoint(specials):
        ids = [tokenizer.encode(w.decode(), add_special_tokens=False).ids for w in words]
        return np.array([*chain.from_iterable(ids)], np.uint32), np.array([*map(len, ids)], np.int64)
    # a pre-token needs the library's model only
    text, tokenize = letters[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le"), tokenizer.model.tokenize
    ends = [0, *accumulate(map(len, words))]
    found = [tokenize(text[a:b]) for a, b in pairwise(ends)]
    return np.array([t.id for tokens in found for t in tokens], np.uint32), np.array([*map(len, found)], np.int64)


def word_ids(cuts: Words, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat ids, and where the ids of each distinct word start and how many
    they are."""
    known = _library(path)[2]
    if known.n > KEPT_WORDS:  # start anew
        known.__init__()
    at = known.find(cuts)
    new = np.flatnonzero(at < 0)
    if len(new):
        at[new] = known.add(cuts, new, *library_ids(cuts.bytes(new), path))
    return known.flat, known.starts[at], known.sizes[at]


def document_ids(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts, each closed by the end id, and how many each has."""
    cuts = words_of(texts, _library(path)[1])
    flat, starts, sizes = word_ids(cuts, path)
    starts, each = starts[cuts.index], sizes[cuts.index]
    ends = np.concatenate([[0], np.cumsum(each)])[cuts.at]
    return np.insert(gather(flat, starts, each), ends[1:], end_id), np.diff(ends) + 1


def segment(doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    null = np.asarray(doc_ids.is_null().to_numpy(zero_copy_only=False), np.uint8)
    numbers = doc_ids.fill_null(0).to_numpy().astype("<i8")
    head = _MAGIC + np.array([len(numbers)], "<u4").tobytes()
    return head + numbers.tobytes() + null.tobytes() + lengths.astype("<u4").tobytes() + range_coder.encode(ids)


def open_segment(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """doc_ids, the number of ids of each, and all ids."""
    if data[:4] != _MAGIC:
        raise ValueError("not a token segment")
    n = int(np.frombuffer(data, "<u4", 1, 4)[0])
    numbers = np.frombuffer(data, "<i8", n, 8)
    null = np.frombuffer(data, np.uint8, n, 8 + 8 * n).astype(bool)
    lengths = np.frombuffer(data, "<u4", n, 8 + 9 * n).astype(np.int64)
    return pa.array(numbers, mask=null), lengths, range_coder.decode(data[8 + 13 * n :])


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of every row of ``docs`` to the folder ``path``."""
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        earlier: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        n_bytes = 0

        def written(own: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            nonlocal before
            doc_ids, lengths, ids = pa.concat_arrays([h[0] for h in own]), *(np.concatenate([h[i] for h in own]) for i in (1, 2))
            row = [[part], [before], [len(ids)], [segment(doc_ids, lengths, ids)]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            before += len(ids)
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=["part", "before", "n_tokens", "payload"])

        for batch in pieces(batches):
            size = batch.column("text").nbytes
            if held and n_bytes + size > SEGMENT_BYTES:
                if earlier:
                    yield written(earlier)
                earlier, held, n_bytes = held, [], 0
            ids, lengths = document_ids(batch.column("text"), tokenizer, end_id)
            held.append((batch.column("doc_id"), lengths, ids))
            n_bytes += size
        if n_bytes < SEGMENT_BYTES // 2:  # a short one costs the coder as many steps as a long one
            earlier, held = earlier + held, []
        for own in (earlier, held):
            if own:
                yield written(own)

    # rows that share a doc_id, or none, are dealt over ranges by their text and a tag
    keyed = id_and_text(docs).withColumn("tie", F.xxhash64("text")).withColumn("tag", F.monotonically_increasing_id())
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, so that small ranges are not joined again
    ordered = keyed.repartitionByRange(parts, "doc_id", "tie", "tag").sortWithinPartitions("doc_id", "tie", "tag")
    ordered.select("doc_id", "text").mapInArrow(encode, _SEGMENT).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids
    (little-endian unsigned 32-bit integers) of every document of the files."""
    files = spark.read.schema(_SEGMENT).parquet(path)
    # a row for each part, that is for each task of the writing job
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = files.join(F.broadcast(parts), "part").select((F.col("base") + F.col("before")).alias("base"), "payload")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch.column("base").to_pylist(), batch.column("payload")):
                doc_ids, lengths, ids = open_segment(payload.as_py())
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                each = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(base + ends - lengths), pa.array(lengths), pa.array(each, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
