"""Token counts by rank-synchronous array merging.

Method: a block's distinct pre-tokens become one ragged numpy array of byte
symbols. Each round looks up the merge rank of every neighbouring pair, takes
the lowest rank of each word, and applies that pair at once wherever it stands
in the word (of overlapping places, the left one). A word without a pair is
done; its surviving symbols are its token count. A text's count is the sum over
its pre-tokens.

Special strings inside a text are one token each, as the library has it by
default. Blocks are made within a task; nothing is shuffled.

Edge cases: null and empty text have 0 bytes and 0 tokens; repeated rows are
counted each; a null doc_id is kept; other columns are ignored."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm.pretokens import blocks
from ridelens.llm.shared import id_and_text

TOKENIZER = "byte_bpe_50k.json"
#: A document is over the limit with more tokens than this.
LIMIT = 1024
#: Text bytes whose distinct words are merged together.
BLOCK_BYTES = 16 << 20
_NONE = np.int32((1 << 31) - 1)


@dataclass(frozen=True)
class Merges:
    """Symbols of the 256 bytes; keys, ranks and results of the merges, by key."""

    byte_symbols: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    joined: np.ndarray
    specials: tuple[bytes, ...]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself
    where it prints, else the next free one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(256 + others.index(b)) for b in range(256)]


@cache
def merges_of(path: str) -> Merges:
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    vocab = model["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    left, right, joined = (np.array([vocab[x] for x in xs], np.int64) for xs in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
    keys = left << 32 | right
    order = np.argsort(keys)
    added = model.get("added_tokens") or []
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: added tokens that take in what stands around them")
    return Merges(
        np.array([vocab[c] for c in byte_letters()], np.int64),
        keys[order],
        order.astype(np.int32),
        joined[order],
        tuple(t["content"].encode() for t in added),
    )


def merged_sizes(words: list[bytes], model: Merges) -> np.ndarray:
    """How many symbols are left of each word when no pair merges any more."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    symbol = model.byte_symbols[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), sizes)
    for special in model.specials:
        sizes[[i for i, w in enumerate(words) if w == special]] = 1
    alone = sizes[word] > 1
    symbol, word = symbol[alone], word[alone]
    while len(symbol):
        key = symbol[:-1] << 32 | symbol[1:]
        at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
        rank = np.where((model.keys[at] == key) & (word[:-1] == word[1:]), model.ranks[at], _NONE)
        rank = np.append(rank, _NONE)
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        counts = np.diff(np.append(starts, len(word)))
        lowest = np.repeat(np.minimum.reduceat(rank, starts), counts)
        here = np.flatnonzero((rank == lowest) & (rank < _NONE))
        # neighbouring places of one pair overlap: every other one, from the left
        run = np.append(True, np.diff(here) != 1)
        place = np.arange(len(here)) - np.flatnonzero(run)[np.cumsum(run) - 1] if len(here) else here
        here = here[place % 2 == 0]
        symbol[here] = model.joined[at[here]]
        keep = np.ones(len(symbol), bool)
        keep[here + 1] = False
        sizes -= np.bincount(word[here], minlength=len(sizes))
        keep &= lowest < _NONE  # words without a pair are done
        symbol, word = symbol[keep], word[keep]
    return sizes


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``."""
    path = path or public_tokenizers.path(TOKENIZER)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges_of(path)
        for block in blocks(batches, BLOCK_BYTES, model.specials):
            sums = np.concatenate([[0], np.cumsum(merged_sizes(block.words, model)[block.index])])
            yield pa.RecordBatch.from_arrays(
                [block.doc_ids, pa.array(block.n_bytes), pa.array(np.diff(sums[block.at]))], names=["doc_id", "n_bytes", "n_tokens"]
            )

    counted = id_and_text(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
