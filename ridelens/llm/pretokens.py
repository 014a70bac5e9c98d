"""Byte-level pre-tokens of whole batches of texts, as spans of flat arrays.

The pattern of the rank files (``public_tokenizers.PATTERN``) cuts a text into
contractions, runs of letters, numbers or other characters with one space
before them, and white space. Its cuts follow from the classes of neighbouring
characters, so whole batches are cut by array operations instead of a regular
expression per text. The classes of all code points are asked once per worker
from the library's own pattern engine, so that its Unicode version holds."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken

from ridelens.llm.hashing import rows_of, word_hashes
from ridelens.llm.shared import pieces, text_buffer

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    for pattern, kind in ((r"\s", SPACE), (r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        engine = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        taken = engine.decode(engine.encode_ordinary(chars))
        out[np.frombuffer(taken.encode("utf-32-le"), np.uint32)] = kind
    return out


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte at which each starts."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    code = lead.astype(np.int32)
    if len(at) == len(data):
        return code, at
    for least, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        some = np.flatnonzero((lead >= least) & (lead < (0xE0, 0xF0, 0x100)[more - 1]))
        value = lead[some].astype(np.int32) & mask
        for j in range(1, more + 1):
            value = value << 6 | (data[at[some] + j] & 0x3F)
        code[some] = value
    return code, at


def cut(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte starts of all pre-tokens, in order; they cover every byte."""
    n = data.size
    if not n:
        return np.empty(0, np.int64)
    code, at = code_points(data)
    kind = classes()[code]
    head = np.zeros(len(at), bool)  # first characters of texts
    first = np.searchsorted(at, offsets)
    head[first[:-1][first[:-1] < len(at)]] = True
    begins = np.ones(len(at), bool)
    begins[1:] = kind[1:] != kind[:-1]
    begins |= head
    tail = np.append(head[1:], True)  # last characters of texts
    space = kind == SPACE
    # the last white-space character before other characters stands alone, or joins them if it is a plain space
    last = np.append(space[:-1] & ~space[1:], False) & ~tail
    begins |= last
    joined = np.append(False, (last & (code == 0x20))[:-1])
    begins &= ~joined
    # contractions: an apostrophe that begins a token, and the letters after it
    mark = np.flatnonzero((code == 0x27) & begins & ~tail)
    mark = mark[kind[np.minimum(mark + 1, len(at) - 1)] == LETTER]
    if len(mark):
        one = code[mark + 1]
        two = np.where(tail[mark + 1], -1, code[np.minimum(mark + 2, len(at) - 1)])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        begins[mark[short | long] + 1] = False
        for ends, size in ((mark[short], 2), (mark[long], 3)):
            after = ends + size
            after = after[after < len(at)]
            begins[after] = True
            # a space that the pattern would have joined to the next run keeps doing so
    return at[begins]


def specials_in(data: np.ndarray, specials: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the special strings in the bytes."""
    spans = []
    if specials:
        pattern = b"|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
        spans = [m.span() for m in re.finditer(pattern, data.tobytes())]
    both = np.array(spans, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _first_of(index: np.ndarray, n: int) -> np.ndarray:
    """Where each of the n numbers comes first."""
    first = np.empty(n, np.int64)
    first[index[::-1]] = np.arange(len(index))[::-1]
    return first


def same_spans(a: np.ndarray, a_starts, a_ends, b: np.ndarray, b_starts, b_ends) -> bool:
    """Whether all spans of ``a`` have the bytes of those of ``b``."""
    sizes = a_ends - a_starts
    if not np.array_equal(sizes, b_ends - b_starts):
        return False
    other = np.flatnonzero(a_starts != b_starts) if a is b else np.arange(len(sizes))
    step = 1 << 15
    at = np.cumsum(sizes[other]) // step
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1), len(other)]
    for x, y in zip(cuts, cuts[1:]):
        some = other[x:y]
        if not np.array_equal(gather(a, a_starts[some], sizes[some]), gather(b, b_starts[some], sizes[some])):
            return False
    return True


#: Spans of up to so many bytes are their own key.
SHORT = 7


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit key of each span: its bytes and size if it is short, else a hash
    with the highest bit set."""
    sizes = ends - starts
    raw = np.zeros((data.size >> 3) + 2 << 3, np.uint8)
    raw[: data.size] = data
    eight = raw.view("<u8")
    at, shift = starts >> 3, (starts & 7).astype(np.uint64) << np.uint64(3)
    bits = np.minimum(sizes, SHORT).astype(np.uint64) << np.uint64(3)
    # the eight bytes from the start on, from two neighbours
    key = eight[at] >> shift | eight[at + 1] << np.uint64(1) << np.uint64(63) - shift
    key = key & (np.uint64(1) << bits) - np.uint64(1) | bits << np.uint64(53)
    long = np.flatnonzero(sizes > SHORT)
    key[long] = word_hashes(data, starts[long], ends[long]) | np.uint64(1 << 63)
    return key


class Words:
    """The pre-tokens of a batch: ``data`` and the byte spans and keys of the
    distinct ones, and for each pre-token the number of its distinct one;
    ``at`` has the n + 1 places where the texts begin among the pre-tokens."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, specials: tuple[bytes, ...] = ()):
        self.data = data
        from_, to = specials_in(data, specials)
        inside = np.searchsorted(offsets, from_, side="right") == np.searchsorted(offsets, to, side="left")
        from_, to = from_[inside], to[inside]  # none across two texts
        # a special string stands alone, and the text ends before it and begins after it
        starts = cut(data, np.unique(np.concatenate([offsets, from_, to])) if len(from_) else offsets)
        if len(from_):
            before = np.searchsorted(from_, starts, side="right") - 1
            starts = starts[(before < 0) | (starts == from_[before]) | (starts >= to[before])]
        ends = np.append(starts[1:], data.size)
        self.at = rows_of(starts, offsets)
        self.n_bytes = np.diff(offsets)
        index, self.keys = pd.factorize(word_keys(data, starts, ends))
        first = _first_of(index, len(self.keys))
        long = np.flatnonzero(ends - starts > SHORT)
        other = first[index[long]]
        if not same_spans(data, starts[long], ends[long], data, starts[other], ends[other]):
            # two words share a hash: tell them by their bytes
            index, distinct = pd.factorize(np.array([data[a:b].tobytes() for a, b in zip(starts, ends)], object))
            first = _first_of(index, len(distinct))
            self.keys = word_keys(data, starts[first], ends[first])
        self.index = index.astype(np.int32)
        self.starts, self.ends = starts[first], ends[first]

    @cached_property
    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)

    def bytes(self, some: np.ndarray | slice = slice(None)) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts[some].tolist(), self.ends[some].tolist())]


def words_of(column, specials: tuple[bytes, ...] = ()) -> Words:
    return Words(*text_buffer(column), specials)


@dataclass
class Block:
    """Documents that share one list of distinct pre-tokens: doc_ids, the bytes
    of each text, the n + 1 places where the texts begin among the pre-tokens,
    the number of the word of each pre-token, and the words; known words have the
    first numbers and are not among these."""

    doc_ids: pa.Array
    n_bytes: np.ndarray
    at: np.ndarray
    index: np.ndarray
    words: list[bytes]


def blocks(batches: Iterator[pa.RecordBatch], limit: int, specials: tuple[bytes, ...] = (), known=None) -> Iterator[Block]:
    """Blocks of about ``limit`` text bytes; one longer text stands alone.
    ``known`` tells the numbers of the words that it has (``find``)."""
    before = len(known) if known else 0
    numbers: dict[bytes, int] = {}  # of the block's words, in the order in which they come
    parts: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def block() -> Block:
        ids, n_bytes, counts, index = zip(*parts)
        at = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return Block(pa.concat_arrays(ids), np.concatenate(n_bytes), at, np.concatenate(index), list(numbers))

    for batch in pieces(batches):
        cuts = words_of(batch.column("text"), specials)
        if held and held + cuts.data.size > limit:
            yield block()
            parts.clear()
            numbers = {}
            held = 0
        number = known.find(cuts) if before else np.full(len(cuts.starts), -1, np.int32)
        new = np.flatnonzero(number < 0)
        number[new] = np.fromiter((before + numbers.setdefault(w, len(numbers)) for w in cuts.bytes(new)), np.int32, len(new))
        parts.append((batch.column("doc_id"), cuts.n_bytes, np.diff(cuts.at), number[cuts.index]))
        held += max(1, cuts.data.size)
    if parts:
        yield block()


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The spans of ``values`` end to end."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]
