import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ridelens.llm import byte_bpe, pretokens, range_coder, token_files
from ridelens.llm.byte_bpe import digests, encode_and_decode
from ridelens.llm.hashing import mul61, word_hashes
from ridelens.llm.pretokens import words_of
from ridelens.llm.shared import ARROW_BYTES, fresh_path, id_and_text
from ridelens.llm.token_counts import count_tokens
from ridelens.llm.token_files import read_token_files, write_token_files
from tests.conftest import plan_of

PIECES = ["a", "B", "'s", "'", "'ll", "'t", "re", " ", "  ", "\n", "\t", " ", "1", "٠", "é", "ñ", "!", "?", "字", "😀", " ", "\r\n",
          "the", " and", "tion", "'ve", "\x1c", "́"]


def texts(seed, n=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(n)]


ODD = [None, "", " ", "a" * 700, "<|endoftext|>", "x <|endoftext|> y<|endoftext|><|endoftext", "\n\n  x", "the the the " * 300]


def frame(spark, values):
    rows = [(i if i else None, t, -1) for i, t in enumerate(values)]
    return spark.createDataFrame([*rows, rows[-1]], "doc_id long, text string, n_tokens int")


def test_pretokens_are_those_of_the_pattern():
    own = texts(5, 3000)
    cut = words_of(pa.array(own))
    words = cut.bytes()
    pattern = regex.compile(public_tokenizers.PATTERN)
    for i, text in enumerate(own):
        assert [words[j].decode() for j in cut.index[cut.at[i] : cut.at[i + 1]]] == pattern.findall(text)


def test_byte_bpe_is_the_librarys(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    values = [*texts(1), *ODD]
    encoded = encode_and_decode(frame(spark, values))
    got = digests(encoded).collect()
    assert len(got) == len(values) + 1
    for r in got:
        text = values[r.doc_id or 0] or ""
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_and_decode(frame(spark, values).limit(0)).count() == 0


def test_token_counts_are_the_librarys(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    values = [*texts(2), *ODD]
    got = count_tokens(frame(spark, values), limit=20).collect()
    assert len(got) == len(values) + 1
    for r in got:
        text = values[r.doc_id or 0] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 20)
    assert count_tokens(frame(spark, values).limit(0)).count() == 0


def test_token_files_round_trip_in_order(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    values = [*texts(3), *ODD]
    docs = frame(spark, values).repartition(5)
    path = fresh_path(spark, "test")
    write_token_files(docs, path)
    start = 0
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *range(1, len(values)), len(values) - 1]
    for r in got:
        ids = [*library.encode(values[r.doc_id or 0] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert zlib.crc32(bytes(r.ids)) == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    path = fresh_path(spark, "test")
    write_token_files(docs.limit(0), path)
    assert read_token_files(spark, path).count() == 0


@pytest.mark.parametrize("n", [0, 1, range_coder.BLOCK, range_coder.BLOCK + 1, 5000])
def test_range_coder_round_trips_and_learns(n):
    rng = np.random.Generator(np.random.PCG64(n))
    for ids in (rng.integers(0, 50_257, n), rng.integers(0, 1 << 28, n), np.resize([7, 8, 9], n), np.zeros(n, int)):
        assert (range_coder.decode(range_coder.encode(ids)) == ids).all()
    if n > 1000:
        assert len(range_coder.encode(np.resize([7, 8, 9], n))) < n / 4


def test_a_damaged_block_is_noticed():
    data = bytearray(range_coder.encode(np.arange(2000)))
    data[-900] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        range_coder.decode(bytes(data))


def thue_morse(n, a="a", b="b"):
    """Words of regular letters, for which every polynomial hash modulo 2^64 is the same when a and b swap."""
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_equal_hashes_of_regular_words_do_not_join_them(spark, monkeypatch):
    values = [thue_morse(n, *ab) for n in (1024, 4096) for ab in ("ab", "ba")]
    rows = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in encode_and_decode(rows).collect():
        assert (list(np.frombuffer(r.ids, "<u4")), r.decoded.decode()) == (library.encode_ordinary(values[r.doc_id]), values[r.doc_id])
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: other.encode(v, add_special_tokens=False).ids for i, v in enumerate(values)}
    assert {r.doc_id: r.n_tokens for r in count_tokens(rows).collect()} == {i: len(x) for i, x in want.items()}
    path = fresh_path(spark, "thue-morse")
    write_token_files(rows, path)
    assert {r.doc_id: list(np.frombuffer(r.ids, "<u4"))[:-1] for r in read_token_files(spark, path).collect()} == want
    assert len(set(word_hashes_of(values))) == 4


def word_hashes_of(values):
    data = np.frombuffer("".join(values).encode(), np.uint8)
    ends = np.cumsum([len(v) for v in values])
    return word_hashes(data, ends - [len(v) for v in values], ends).tolist()


def test_words_are_told_apart_by_bytes_whatever_their_hash(monkeypatch):
    monkeypatch.setattr(pretokens, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3))
    own = texts(9, 200)
    pattern = regex.compile(public_tokenizers.PATTERN)
    batches = [pa.record_batch({"doc_id": pa.array([2 * i, 2 * i + 1]), "text": pa.array(own[2 * i : 2 * i + 2])}) for i in range(100)]
    (block,) = pretokens.blocks(iter(batches), 1 << 20)
    for i, text in enumerate(own):
        assert [block.words[j].decode() for j in block.index[block.at[i] : block.at[i + 1]]] == pattern.findall(text)
    assert len(set(block.words)) == len(block.words)


def test_hashes_modulo_the_prime_are_those_of_plain_integers():
    rng = np.random.Generator(np.random.PCG64(2))
    a, b = (rng.integers(0, (1 << 61) - 1, 1000, np.uint64) for _ in range(2))
    a[:3] = b[:3] = (1 << 61) - 2
    assert [int(x) for x in mul61(a, b)] == [int(x) * int(y) % ((1 << 61) - 1) for x, y in zip(a, b)]
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    one = word_hashes(data, np.array([7, 4000]), np.array([900, 4000]))
    other = word_hashes(np.concatenate([data[100:200], data[7:900]]), np.array([100, 3]), np.array([993, 3]))
    assert one.tolist() == other.tolist()


def test_texts_longer_than_a_block_and_many_small_rows(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(byte_bpe, "WORDS_ROW", 5)
    monkeypatch.setattr(byte_bpe, "DOCS_ROW", 40)
    values = [*texts(11, 80), "", "x y " * 5000, "z" * 9000, "", *texts(12, 20), None]
    rows = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(2)
    batches = rows.toArrow().combine_chunks().to_batches()
    names = ["words", "doc_ids", "counts", "index"]
    through = [pa.record_batch([b.column(n) for n in names], names=names) for b in byte_bpe._to_blocks(iter(batches))]
    filled = [
        pa.record_batch(
            [
                b.column("doc_ids"), b.column("counts"), b.column("index"),
                pa.array([w and [list(x) for x in w] for w in b.column("words").to_pylist()], pa.list_(pa.list_(pa.int32()))), b.column("words"),
            ],
            names=["doc_ids", "counts", "index", "words_ids", "words_bytes"],
        )
        for b in through
    ]
    got = {}
    for out in byte_bpe._to_documents(iter(filled)):
        for r in out.to_pylist():
            got[r["doc_id"]] = (r["decoded"].decode(), bytes(np.frombuffer(r["ids"], "<u4").astype(np.uint8)).decode())
    assert got == {i: (v or "", v or "") for i, v in enumerate(values)}


def test_rows_that_share_a_doc_id_or_have_none_are_dealt_out(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(None if i % 3 else 7, f"text {i % 50}") for i in range(600)] + [(3, "first"), (9, "last")]
    path = fresh_path(spark, "hot-ids")
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 400 + [3] + [7] * 200 + [9]
    coded = lambda text: np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4").tobytes()
    assert sorted((r.doc_id or 0, bytes(r.ids)) for r in got) == sorted((i or 0, coded(text)) for i, text in rows)
    ends = [0, *np.cumsum([r.n_tokens for r in got])]
    assert [r.start for r in got] == ends[:-1]
    parts = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    assert parts.count() > 3  # 400 rows without an id are not one range


def test_the_pair_table_has_every_pair_and_no_other():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids, table, shift = byte_bpe.ranks(path), byte_bpe.pair_table(path), byte_bpe.SHIFT

    def found(left, right):
        key = left << shift | right
        entry = table.entries[table.first[key % len(table.first)] + right]
        return entry & (1 << shift) - 1 if entry is not None and entry >> shift == key else None

    cuts = [(ids.get(t[:i]), ids.get(t[i:]), rank) for t, rank in ids.items() for i in range(1, len(t))]
    cuts = [c for c in cuts if c[0] is not None and c[1] is not None]
    assert all(found(left, right) == rank for left, right, rank in cuts)
    assert sum(e is not None for e in table.entries) == len(cuts)
    tokens, rng = list(ids), random.Random(4)
    for a, b in (rng.sample(tokens, 2) for _ in range(2000)):
        assert found(ids[a], ids[b]) == ids.get(a + b)


def test_texts_go_to_python_in_small_batches(spark):
    own = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("text "), 2000).alias("text"))  # 30 MB

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.nbytes])})

    most = id_and_text(own).mapInArrow(sizes, "n long").agg(F.max("n"), F.sum("n")).first()
    assert most[0] < 1.1 * ARROW_BYTES < most[1]


def test_words_folded_beforehand_change_nothing_but_what_blocks_carry(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN_FROM", 0)
    monkeypatch.setattr(byte_bpe, "KNOWN_SHARE", 0.4)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    values = [*texts(21, 300), *ODD]
    docs = frame(spark, values).repartition(3)
    known, _ = byte_bpe.known_words(id_and_text(docs), path)
    batches = [pa.record_batch({"doc_id": pa.array(range(len(values))), "text": pa.array(values, pa.string())})]
    every, rest = (
        {w for b in byte_bpe._to_blocks(iter(batches), known=k) for words in b.column("words").to_pylist() for w in words or ()}
        for k in (None, known)
    )
    own = known.data.tobytes()
    given = {own[a:b] for a, b in zip(known.at, known.at[1:])}
    assert given and rest and rest == every - given
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(path), special_tokens={})
    got = encode_and_decode(docs).collect()
    assert len(got) == len(values) + 1
    for r in got:
        text = values[r.doc_id or 0] or ""
        assert (list(np.frombuffer(r.ids, "<u4")), r.decoded.decode()) == (library.encode_ordinary(text), text)


def test_an_unknown_word_with_a_known_hash_is_not_taken_for_it(monkeypatch):
    monkeypatch.setattr(pretokens, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    known = byte_bpe.Known(np.array([3, 4], np.uint64), np.frombuffer(b"abcabcd", np.uint8), np.array([0, 3, 7], np.int32))
    assert known.find(words_of(pa.array(["abd", None, "abcd", "abcde"]))).tolist() == [-1, 1, -1]


def test_a_token_that_merges_do_not_make_starts_whole():
    start = byte_bpe.start_of(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain, whole = start.symbols([b"xyz", b"ab"]).to_pylist(), byte_bpe.Start(start.letters, start.pairs, {b"xyz": 7}).symbols([b"xyz", b"ab"]).to_pylist()
    assert plain[1] == whole[1] and len(plain[0]) == 5 and len(whole[0]) == 3
    assert whole[0][1] & byte_bpe._NO_ID == 7 and min(whole[0]) >= byte_bpe._NO_PAIR


def test_plans_do_not_hold_the_tables_of_the_tokenizer(spark):
    encoded = encode_and_decode(frame(spark, texts(31, 20)))
    assert len(plan_of(encoded)) < 50_000  # the driver keeps such texts of a thousand queries
    assert encoded.count() == 21


def test_ids_that_no_context_predicts_stand_in_full():
    ids = np.random.Generator(np.random.PCG64(6)).permutation(3000)
    assert range_coder.encode(ids).endswith(ids.astype("<u2").tobytes())
    ids[7] = 1 << 16
    assert range_coder.encode(ids).endswith(ids.astype("<u4").tobytes())


def test_carries_go_through_all_words_of_a_block():
    rng = np.random.Generator(np.random.PCG64(7))
    for n in (2, 3, 5):  # many coded bits, hits and misses
        ids = rng.integers(0, n, 40_000)
        assert (range_coder.decode(range_coder.encode(ids)) == ids).all()


def test_keys_of_short_words_are_their_bytes():
    data = np.frombuffer(bytes(range(97, 122)) + b"abcdefg" + b"abcdefgh\0\0", np.uint8)
    starts = np.array([0, 1, 3, 25, 0, 25, 32, 40, 40, 41, 42])
    ends = np.array([7, 8, 3, 32, 8, 27, 40, 41, 42, 42, 42])
    words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    keys = pretokens.word_keys(data, starts, ends).tolist()
    assert [keys.index(k) for k in keys] == [words.index(w) for w in words]
    assert [int.from_bytes(w, "little") | len(w) << 56 for w in words if len(w) < 8] == [k for k, w in zip(keys, words) if len(w) < 8]


@pytest.mark.parametrize("kept", [1_000_000, 40])
def test_words_met_before_have_the_librarys_ids_whatever_their_key(monkeypatch, kept):
    monkeypatch.setattr(pretokens, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3))
    monkeypatch.setattr(token_files, "KEPT_WORDS", kept)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    token_files._library.cache_clear()
    own = [*texts(41, 150), *ODD, "long words, longer words: abcdefghij abcdefghik", "abcdefghij bcdefghijk abcdefghi"]
    calls = []
    by_library = token_files.library_ids
    monkeypatch.setattr(token_files, "library_ids", lambda words, path: calls.extend(words) or by_library(words, path))
    for a in [*range(0, len(own), 9), 0, 9]:
        some = own[a : a + 9]
        ids, lengths = token_files.document_ids(pa.array(some, pa.string()), path, 2)
        want = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in some]
        assert (ids.tolist(), lengths.tolist()) == (sum(want, []), [*map(len, want)])
    assert calls and (kept == 40 or len([w for w in calls if len(w) < 8]) == len({w for w in calls if len(w) < 8}))
    token_files._library.cache_clear()


def test_bytes_that_are_no_text_are_replaced_as_before():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    words = [b"ab\xff", b" caf\xc3\xa9", b"\xe2\x82", b"<|endoftext|>", b"word"]
    for some in (words, [w for w in words if w[:1] != b"<"]):
        flat, sizes = token_files.library_ids(some, path)
        want = [library.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids for w in some]
        assert (flat.tolist(), sizes.tolist()) == (sum(want, []), [*map(len, want)])


def test_a_short_last_segment_joins_the_one_before(spark):
    n = token_files.SEGMENT_BYTES // 5
    docs = spark.createDataFrame([(0, "word " * n), (1, "a b c " * (n // 9)), (2, "last words")], "doc_id long, text string")
    path, parts = fresh_path(spark, "short"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        write_token_files(docs, path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert [r.before for r in spark.read.parquet(path).collect()] == [0]
    got = [(r.doc_id, r.start, r.n_tokens) for r in read_token_files(spark, path).orderBy("doc_id").collect()]
    assert got == [(0, 0, n + 2), (1, n + 2, n // 9 * 3 + 2), (2, n + n // 9 * 3 + 4, 3)]
