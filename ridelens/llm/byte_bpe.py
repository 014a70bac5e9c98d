"""Byte-level BPE encoding and decoding by ranks.

Method: texts are cut into pre-tokens, and blocks of texts carry each distinct
pre-token once. Such a word starts as an array of symbols, one per byte, and
Spark higher-order functions fold merges over it: each step takes the least
rank of all neighbouring pairs, joins the leftmost pair that has it, and looks up
the ranks of the two pairs that this makes, until no pair has one. Decoding looks
up the binary piece of every id and concatenates them.

In a table of more than ``KNOWN_FROM`` text bytes, the words of a sample of rows
are folded once beforehand and given to all tasks (``known_words``); blocks then
carry only the words that are not among them. The sample decides what is folded
twice and nothing else.

The ranks of pairs are literals, two flat lists (``PairTable``): a pair's place is
worked out from the ids of its two symbols, so that a look-up reads two entries.

Blocks of at most ``BLOCK_BYTES`` text bytes (one longer text stands alone) are
made and taken apart within a task; only the sample's words are shuffled. Between
the steps a block travels as short rows in order, some words or some documents each.

Edge cases: null and empty text have no tokens and decode to no bytes; repeated
rows are encoded each; a null doc_id is kept; other columns of the input are
ignored; an empty table gives an empty table."""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelens.llm.hashing import word_hashes
from ridelens.llm.pretokens import Words, blocks, gather, words_of
from ridelens.llm.shared import id_and_text, materialise, pieces, release
from ridelens.llm.token_counts import Merges, merged_sizes

RANKS = "byte_bpe_50k.tiktoken"
#: Text bytes of the documents that share one set of distinct words.
BLOCK_BYTES = 16 << 20
#: Text bytes of a table from which words are folded beforehand; the share of its
#: rows that they are taken from, and the bytes of these at most; the longest of them.
KNOWN_FROM = 8 * BLOCK_BYTES
KNOWN_SHARE, KNOWN_BYTES, KNOWN_LENGTH = 1 / 24, 32 << 20, 48
#: Known words that the driver puts in order at a time.
KNOWN_STEP = 1 << 15
#: Distinct words, and pre-tokens of documents, that a row between the steps
#: holds, so that the JVM never holds a block but only such rows.
WORDS_ROW, DOCS_ROW = 64, 8192
#: Bits of an id, and of a place in a word.
SHIFT, PLACE = 20, 23
_NO_ID = (1 << SHIFT) - 1
_PLACES = (1 << PLACE) - 1 << SHIFT
_NO_PAIR = _NO_ID << SHIFT + PLACE


@cache
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 token, rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@dataclass(frozen=True)
class PairTable:
    """The ranks of pairs of symbols in two flat lists: the pair (left, right)
    stands, if it merges, in ``entries`` at ``first[key % len(first)] + right``,
    as key << SHIFT | rank, where key is left << SHIFT | right."""

    first: list[int]
    entries: list[int | None]
    apart: dict[bytes, int]  # tokens that the merges do not make


def _prime_above(n: int) -> int:
    while any(n % d == 0 for d in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


@cache
def pair_table(path: str) -> PairTable:
    ids = ranks(path)
    if max(ids.values()) >= _NO_ID or any(bytes([i]) not in ids for i in range(256)):
        raise ValueError(f"{path}: ranks for every byte, below {1 << SHIFT}, are needed")
    cuts = ((ids.get(token[:i]), ids.get(token[i:]), rank) for token, rank in ids.items() for i in range(1, len(token)))
    pairs = np.array([c for c in cuts if c[0] is not None and c[1] is not None], np.int64).reshape(-1, 3)
    keys = pairs[:, 0] << SHIFT | pairs[:, 1]
    # two pairs of one bucket never share the right symbol, so that some shift always finds free places
    buckets = _prime_above(max(ids.values()) + 1)
    members: dict[int, list[int]] = {}
    for i, bucket in enumerate((keys % buckets).tolist()):
        members.setdefault(bucket, []).append(i)
    room = 2 * len(pairs) + 1
    first, entries = [0] * buckets, [None] * (room + buckets)
    right, packed = pairs[:, 1].tolist(), (keys << SHIFT | pairs[:, 2]).tolist()
    at = 0
    for bucket, own in sorted(members.items(), key=lambda x: -len(x[1])):
        while any(entries[at + right[i]] is not None for i in own):
            at = (at + 1) % room
        first[bucket] = at
        for i in own:
            entries[at + right[i]] = packed[i]
        at = (at + 7919) % room
    tokens = list(ids)
    order = np.argsort(keys)
    alone = np.array([ids[bytes([i])] for i in range(256)], np.int64)
    left = merged_sizes(tokens, Merges(alone, keys[order] >> SHIFT << 32 | pairs[order, 1], pairs[order, 2].astype(np.int32), pairs[order, 2], ()))
    return PairTable(first, entries, {tokens[i]: ids[tokens[i]] for i in np.flatnonzero(left > 1)})


@cache
def _token_hex(path: str) -> list[str]:
    """The bytes of each id, in hexadecimal digits."""
    out = [""] * (max(ranks(path).values()) + 1)
    for token, rank in ranks(path).items():
        out[rank] = token.hex()
    return out


def _given(spark: SparkSession, values: list, kind: pa.DataType) -> Column:
    """A list as a column, by a subquery of one row: a literal would stand with all
    its values in every text of a plan, and the driver keeps those of many queries."""
    return spark.createDataFrame(pa.table({"list": pa.array([values], pa.list_(kind))})).scalar()


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@dataclass(frozen=True)
class Start:
    """What words start from: the ids of the 256 bytes, the ranks of their pairs,
    and the tokens that the merges do not make."""

    letters: np.ndarray
    pairs: np.ndarray
    apart: dict[bytes, int]

    def symbols(self, words: list[bytes]) -> pa.ListArray:
        """Each word as ``encode_symbols`` takes it."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        rank, own = np.full(len(data), _NO_ID, np.int64), self.letters[data].astype(np.int64)
        rank[:-1] = self.pairs[data[:-1], data[1:]]
        rank[ends - 1] = _NO_ID
        place = np.arange(1, len(data) + 1) - np.repeat(ends - sizes, sizes)
        if self.apart:
            alone = [(i, self.apart[w]) for i, w in enumerate(words) if w in self.apart]
            at = np.array([i for i, _ in alone], np.int64)
            own[ends[at] - 1] = [rank for _, rank in alone]
            stays = ~np.isin(np.repeat(np.arange(len(words)), sizes), at)
            stays[ends[at] - 1] = True
            rank, place, own = rank[stays], place[stays], own[stays]
            sizes[at] = 1
            ends = np.cumsum(sizes)
        behind = 2 * np.arange(len(words))
        out = np.full(len(own) + 2 * len(words), _NO_PAIR | _NO_ID, np.int64)
        out[np.arange(1, len(own) + 1) + np.repeat(behind, sizes)] = rank << SHIFT + PLACE | place << SHIFT | own
        out[ends + behind + 1] |= _PLACES
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends + behind + 2).astype(np.int32)), pa.array(out))


@cache
def start_of(path: str) -> Start:
    ids = ranks(path)
    single = [bytes([i]) for i in range(256)]
    pairs = np.array([[ids.get(a + b, _NO_ID) for b in single] for a in single], np.int32)
    return Start(np.array([ids[a] for a in single], np.int32), pairs, pair_table(path).apart)


def encode_symbols(words: Column, first: Column, entries: Column, buckets: int) -> Column:
    """The ids of each of an array of words as ``Start.symbols`` has them, by the
    lists of a pair table."""
    one = lambda first, entries: F.transform(words, lambda word: _encode_word(word, first, entries, buckets))
    # a lambda's variable is one copy of a list
    return _let(first, lambda first: _let(entries, lambda entries: one(first, entries)))


def _encode_word(word: Column, first: Column, entries: Column, buckets: int) -> Column:
    """The ids of one pre-token: merges of the lowest rank, leftmost first,
    folded over its symbols. A symbol is one number, the rank of its pair with the
    next symbol, its first byte in the word and its id, so that the least number
    is the next merge; the rank of a pair is the id that it becomes. A symbol
    that makes no pair stands at either end."""
    none, no_pair, places = F.lit(_NO_ID).cast("long"), F.lit(_NO_PAIR), F.lit(_PLACES)

    def rank(left: Column, right: Column) -> Column:
        """The rank of a pair, where it stands in a symbol."""
        key = F.shiftleft(left, SHIFT).bitwiseOR(right)
        entry = F.get(entries, (F.get(first, (key % buckets).cast("int")) + right).cast("int"))
        # an entry of another key leaves more than an id has; least() passes over nulls
        return F.shiftleft(F.least(entry.bitwiseXOR(F.shiftleft(key, SHIFT)), none), SHIFT + PLACE)

    def step(state: Column, _: Column) -> Column:
        def merge(low: Column) -> Column:
            def at_place(at: Column) -> Column:
                made = F.shiftright(low, SHIFT + PLACE)
                before = F.get(state, at - 2).bitwiseAND(F.lit(_PLACES | _NO_ID))
                after = F.get(state, at + 1).bitwiseAND(none)
                both = F.array(
                    rank(before.bitwiseAND(none), made).bitwiseOR(before),
                    rank(made, after).bitwiseOR(low.bitwiseAND(places)).bitwiseOR(made),
                )
                return F.concat(F.slice(state, F.lit(1), at - 2), both, F.slice(state, at + 2, F.size(state)))

            # symbols are in the order of their places
            earlier = F.filter(state, lambda x: x.bitwiseAND(places) < low.bitwiseAND(places))
            return F.when(low < no_pair, _let(F.size(earlier) + 1, at_place)).otherwise(state)

        return _let(F.array_min(state), merge)

    # a word of n symbols, with the two at its ends, merges n - 1 times at most
    left = F.aggregate(F.slice(word, F.lit(4), F.size(word)), word, step)
    return _let(left, lambda state: F.transform(F.slice(state, F.lit(2), F.size(state) - 2), lambda x: x.bitwiseAND(none).cast("int")))


def decode_each(words: Column, token_hex: Column) -> Column:
    """The bytes of each of an array of arrays of ids, by the list of all tokens."""
    one = lambda ids, of: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(of, i)), ""))
    return _let(token_hex, lambda of: F.transform(words, lambda ids: one(ids, of)))


@dataclass(frozen=True)
class Known:
    """Words that were encoded beforehand, in the order of their hashes; where
    the bytes of each begin in ``data``."""

    hashes: np.ndarray
    data: np.ndarray
    at: np.ndarray

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, cuts: Words) -> np.ndarray:
        """The number of each distinct word of ``cuts``, -1 for unknown ones."""
        out = np.full(len(cuts.hashes), -1, np.int32)
        at = np.minimum(np.searchsorted(self.hashes, cuts.hashes), len(self) - 1)
        sizes = cuts.ends - cuts.starts
        own = np.flatnonzero((self.hashes[at] == cuts.hashes) & (self.at[at + 1] - self.at[at] == sizes))
        out[own] = at[own]
        other = gather(self.data, self.at[at[own]].astype(np.int64), sizes[own]) != gather(cuts.data, cuts.starts[own], sizes[own])
        if other.any():  # another word has the hash
            out[np.repeat(own, sizes[own])[other]] = -1
        return out


_WORDS = "words array<binary>, symbols array<array<long>>"
_BLOCK = f"{_WORDS}, doc_ids array<long>, counts binary, index binary"


def _word_rows(words: list[bytes], start: Start) -> list[pa.Array]:
    """The columns of ``_WORDS``, WORDS_ROW words a row."""
    at = pa.array(np.append(np.arange(0, len(words), WORDS_ROW), len(words)).astype(np.int32))
    return [pa.ListArray.from_arrays(at, x) for x in (pa.array(words, pa.binary()), start.symbols(words))]


def _to_blocks(batches: Iterator[pa.RecordBatch], start: Start | None = None, known: Known | None = None) -> Iterator[pa.RecordBatch]:
    """The blocks as short rows: first the distinct pre-tokens of a block that
    are not known, WORDS_ROW a row, then its documents in runs of about DOCS_ROW
    pre-tokens: doc_ids, the number of pre-tokens of each, and for each pre-token
    the number of its distinct one, after the known ones."""
    start = start or start_of(public_tokenizers.path(RANKS))
    kinds = [pa.list_(pa.binary()), pa.list_(pa.list_(pa.int64())), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    for block in blocks(batches, BLOCK_BYTES, known=known):
        if block.words:
            for a in range(0, len(block.words), 64 * WORDS_ROW):
                words = _word_rows(block.words[a : a + 64 * WORDS_ROW], start)
                yield pa.RecordBatch.from_arrays([*words, *(pa.nulls(len(words[0]), k) for k in kinds[2:])], names=names)
        counts, index = np.diff(block.at).astype("<i4"), block.index.astype("<i4", copy=False)
        cuts = [0, *(np.flatnonzero(np.diff(block.at[:-1] // DOCS_ROW)) + 1), len(block.doc_ids)]
        for a, b in zip(cuts, cuts[1:]):
            row = [None], [None], [block.doc_ids.slice(a, b - a)], [counts[a:b].tobytes()], [index[block.at[a] : block.at[b]].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=names)


class _Pieces:
    """What each distinct pre-token of a block became, filled row by row:
    its values end to end, where they start, and how many they are."""

    def __init__(self, kind: type, before: _Pieces | None = None):
        self.kind = kind
        self.parts, self.sizes = ([], []) if before is None else ([*before.parts], [*before.sizes])

    def add(self, row: pa.Array) -> None:
        if pa.types.is_list(row.type):
            sizes, flat = np.diff(row.offsets.to_numpy()), row.flatten().to_numpy(zero_copy_only=False)
        else:  # binaries
            sizes, flat = pc.binary_length(row).to_numpy(), np.frombuffer(b"".join(row.to_pylist()), np.uint8)
        self.parts.append(flat.astype(self.kind))
        self.sizes.append(sizes)

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, self.kind), np.empty(0, np.int64), np.empty(0, np.int32)
        sizes = np.concatenate(self.sizes).astype(np.int32, copy=False)
        return np.concatenate(self.parts), np.cumsum(sizes, dtype=np.int64) - sizes, sizes


_KINDS = np.dtype("<u4"), np.dtype(np.uint8)  # of ids and bytes


def _to_documents(batches: Iterator[pa.RecordBatch], known: tuple[_Pieces, _Pieces] | None = None) -> Iterator[pa.RecordBatch]:
    """Documents from the rows of ``_to_blocks`` in their order, with the ids
    and bytes of each pre-token filled in."""
    fresh = lambda: [_Pieces(*x) for x in zip(_KINDS, known or (None, None))]
    (tokens, letters), tables = fresh(), None
    for whole in batches:
        is_words = whole.column("doc_ids").is_null().to_numpy(zero_copy_only=False)
        for k in range(whole.num_rows):
            if is_words[k]:
                if tables is not None:  # the next block begins
                    (tokens, letters), tables = fresh(), None
                tokens.add(whole.column("words_ids").slice(k, 1).flatten())
                letters.add(whole.column("words_bytes").slice(k, 1).flatten())
                continue
            if tables is None:
                tables = [tokens.table(), letters.table()]
                tokens.parts, letters.parts = [], []
            index = np.frombuffer(whole.column("index")[k].as_py(), "<i4")
            at = np.concatenate([[0], np.cumsum(np.frombuffer(whole.column("counts")[k].as_py(), "<i4"), dtype=np.int64)])
            out = []
            for flat, starts, sizes in tables:
                each = sizes[index].astype(np.int64)
                value = gather(flat, starts[index], each).tobytes()
                ends = np.concatenate([[0], np.cumsum(each)])[at] * flat.itemsize
                out.append(pa.array([value[x:y] for x, y in zip(ends, ends[1:])], pa.binary()))
            n_tokens = pa.array([len(x) // 4 for x in out[0].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [whole.column("doc_ids").slice(k, 1).flatten(), n_tokens, *out], names=["doc_id", "n_tokens", "ids", "decoded"]
            )
            # a block without words has no row that begins it
            if not len(tables[0][2]):
                tables = None


def known_words(docs: DataFrame, path: str) -> tuple[Known, tuple[_Pieces, _Pieces]] | None:
    """The words of a sample of ``docs`` (doc_id, text), and their ids and bytes;
    nothing for a table that is too small to repay them."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= KNOWN_FROM:
        return None
    start, parts = start_of(path), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: set[bytes] = set()
        for batch in pieces(batches):
            words.update(w for w in words_of(batch.column("text")).bytes() if len(w) <= KNOWN_LENGTH)
        yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary())], names=["word"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(_word_rows(batch.column("word").to_pylist(), start), names=["words", "symbols"])

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = [_Pieces(k) for k in _KINDS]
            for piece, column in zip(filled, ("words_ids", "words_bytes")):
                piece.add(batch.column(column).flatten())
            (ids, _, ids_sizes), (data, starts, sizes) = (piece.table() for piece in filled)
            values = word_hashes(data, starts, starts + sizes), ids, ids_sizes, data, sizes
            row = [pa.array([v.astype(k).tobytes()], pa.binary()) for v, k in zip(values, kinds)]
            yield pa.RecordBatch.from_arrays(row, names=names)

    kinds, names = ("<u8", "<u4", "u1", "u1", "u1"), ["hashes", "ids", "ids_sizes", "data", "sizes"]
    sample = docs.select("text").sample(min(KNOWN_SHARE, KNOWN_BYTES / total), 1)
    words = sample.mapInArrow(distinct, "word binary").repartition(parts, "word").dropDuplicates(["word"])
    got = _filled(materialise(words, "known-words").mapInArrow(rows, _WORDS), path).mapInArrow(flat, ", ".join(f"{x} binary" for x in names)).collect()
    if not got:
        return None
    hashes, ids, ids_sizes, data, sizes = (np.concatenate([np.frombuffer(r[i], k) for r in got]) for i, k in enumerate(kinds))
    del got
    hashes, order = np.unique(hashes, return_index=True)  # one word of a hash
    out = []
    for flat_, each in ((ids, ids_sizes), (data, sizes)):
        starts, each = (np.cumsum(each, dtype=np.int64) - each)[order], each[order].astype(np.int32)
        out.append(_Pieces(flat_.dtype))
        some = [slice(a, a + KNOWN_STEP) for a in range(0, len(each), KNOWN_STEP)]  # the driver is small
        out[-1].parts.append(np.concatenate([gather(flat_, starts[x], each[x].astype(np.int64)) for x in some]))
        out[-1].sizes.append(each)
    known = Known(hashes, out[1].parts[0], np.append(0, np.cumsum(each, dtype=np.int64)).astype(np.int32))
    del ids, data
    release()
    return known, (out[0], out[1])


def _filled(rows: DataFrame, path: str, *also: str) -> DataFrame:
    """Rows with symbols, and the ids and bytes of their words."""
    table = pair_table(path)
    lists = {"first": (table.first, pa.int32()), "entries": (table.entries, pa.int64()), "token_hex": (_token_hex(path), pa.string())}
    given = rows.select(*also, "symbols", *(_given(rows.sparkSession, *x).alias(name) for name, x in lists.items()))
    ids = encode_symbols(F.col("symbols"), F.col("first"), F.col("entries"), len(table.first))
    # each list stands once in one expression, into which the optimizer puts its subquery, so that no row holds a list
    words = _let(ids, lambda ids: F.struct(ids.alias("ids"), decode_each(ids, F.col("token_hex")).alias("bytes")))
    return given.select(*also, words.alias("words")).select(*also, F.col("words.ids").alias("words_ids"), F.col("words.bytes").alias("words_bytes"))


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids (little-endian unsigned 32-bit
    integers) and decoded (the bytes that the ids stand for)."""
    path = path or public_tokenizers.path(RANKS)
    docs, context = id_and_text(docs), docs.sparkSession.sparkContext
    start, found = start_of(path), known_words(docs, path)
    words, filled = (context.broadcast(x) for x in found or (None, None))
    blocks = docs.mapInArrow(lambda batches: _to_blocks(batches, start, words.value), _BLOCK)
    rows = _filled(blocks, path, "doc_ids", "counts", "index")
    return rows.mapInArrow(lambda batches: _to_documents(batches, filled.value), "doc_id long, n_tokens long, ids binary, decoded binary")


def digests(encoded: DataFrame, *also: str) -> DataFrame:
    """doc_id, n_tokens, the columns ``also``, ids_sha256 and decoded_sha256 of
    encoded documents."""
    return encoded.select(
        "doc_id", "n_tokens", *also, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
