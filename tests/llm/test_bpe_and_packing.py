import base64
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gradientlab.llm import REGISTRY, bpe, packing, pieces
from gradientlab.llm.common import prepare, table
from gradientlab.session import scratch_path

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["'s", "'re", "'", " ", "  ", "\n", "\t ", "a", "É", "1", "²", "Ⅷ", "中", "!", "_", "\xa0", "\x1c", "é", "😀", "x" * 40]


@pytest.fixture(scope="module")
def oracle():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return tokenizer


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randint(0, 12))) for _ in range(n)]


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id bigint, text string" + more)


def test_pattern_is_that_of_the_vocabulary():
    assert pieces.PATTERN == public_tokenizers.PATTERN


def test_borders_are_the_matches_of_the_pattern():
    find = regex.compile(pieces.PATTERN).findall
    for t in texts(3000, 1):
        assert pieces.split(t) == find(t)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_borders_of_any_text(t):
    assert pieces.split(t) == regex.compile(pieces.PATTERN).findall(t)


def test_segment_tree_merges_as_the_library(oracle):
    merge = bpe.vocabulary(RANKS).merge
    rng = random.Random(2)
    for n in (1, 2, 3, 7, 8, 9, 40, 300, 5000):
        for letters in (b"a", b"ab", bytes(range(256)), "éü中".encode()):
            piece = bytes(rng.choices(letters, k=n))
            assert merge(piece) == oracle._core_bpe.encode_single_piece(piece)


def test_memory_of_pieces_may_fill_up(oracle):
    memo = pieces.Memo(lambda new: [oracle.encode_ordinary(p) for p in new], bits=6)
    for k in range(20):
        batch = texts(30, 100 + k)
        ids, offsets = memo.lookup(batch)
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [oracle.encode_ordinary(t) for t in batch]


def test_pieces_that_share_a_hash_are_told_apart(oracle, monkeypatch):
    monkeypatch.setattr(pieces, "slice_hashes", lambda data, starts, ends: ((ends - starts) % 3).astype(np.uint64))
    memo = pieces.Memo(lambda new: [oracle.encode_ordinary(p) for p in new])
    for k in range(5):
        batch = [*texts(30, k), "one two six ten", "six one", "aaaa bbbb cccc"]
        ids, offsets = memo.lookup(batch)
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [oracle.encode_ordinary(t) for t in batch]


def test_memory_of_pieces_is_packed():
    memo = pieces.Memo(lambda new: [[len(p)] * 3 for p in new])
    for k in range(40):
        memo.lookup([" ".join(f"wörd{chr(97 + i % 26)}{letters(i)}" for i in range(5000 * k, 5000 * k + 5000))])
    assert memo.count > 150_000
    assert sum(x.nbytes for x in vars(memo).values() if isinstance(x, np.ndarray)) < 25_000_000


def letters(i):
    return "".join(chr(97 + int(d)) for d in str(i))


def test_memory_of_pieces_is_bounded_in_bytes(oracle):
    memo = pieces.Memo(lambda new: [oracle.encode_ordinary(p) for p in new], most=4000)
    for k in range(20):
        batch = [f"{chr(97 + k) * 1500} {chr(98 + k) * 900} end", *texts(5, k)]
        ids, offsets = memo.lookup(batch)
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [oracle.encode_ordinary(t) for t in batch]
    assert memo.spelled <= max(4000, sum(len(t.encode()) for t in batch))


def test_decoding_many_ids_takes_little_more_than_their_bytes():
    book = bpe.vocabulary(RANKS)
    ids = np.random.default_rng(3).integers(256, 50_000, 1_000_000)
    tracemalloc.start()
    out, ends = book.decode(ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * (out.nbytes + ends.nbytes)
    assert out[ends[70_000] : ends[70_005]].tobytes() == b"".join(
        book.data[book.starts[i] : book.starts[i] + book.lengths[i]].tobytes() for i in ids[70_000:70_005])


@pytest.mark.parametrize("length", [64, 1024, 4096])
def test_words_whose_polynomials_agree(oracle, library, length):
    word = "a"
    while len(word) < length:
        word += word.translate({97: "b", 98: "a"})
    batch = [word, word.translate({97: "b", 98: "a"})]
    ids, offsets = bpe.encode_texts(batch, RANKS)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [oracle.encode_ordinary(t) for t in batch]
    ids, offsets = packing.encode_texts(batch, TOKENIZER)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [library.encode(t, add_special_tokens=False).ids for t in batch]


def test_texts_longer_than_a_run(oracle):
    long = "the quick brown fox " * 60_000 + "x" * 3000
    blank_free = "ab1" * 250_000  # no place to be cut
    ids, offsets = bpe.encode_texts([long, "", None, blank_free], RANKS)
    assert ids[: offsets[1]].tolist() == oracle.encode_ordinary(long)
    assert offsets[1] == offsets[2] == offsets[3]
    assert ids[offsets[3] :].tolist() == oracle.encode_ordinary(blank_free)


def test_encode_and_decode(spark, oracle):
    prepare(spark)
    rows = [(k, t, "old") for k, t in enumerate(texts(200, 3))] + [(None, "a b", "x"), (7, None, None), (7, "again", "y"), (7, "again", "y")]
    df = frame(spark, rows, ", IDS string")
    back = bpe.decode(bpe.encode(df, RANKS), RANKS).collect()
    assert back[0].asDict().keys() == {"doc_id", "text", "ids", "decoded"}  # a column of the same name is replaced
    assert sorted((str(r.doc_id), r.text or "") for r in back) == sorted((str(a), b or "") for a, b, _ in rows)
    for r in back:
        assert r.ids == oracle.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()


def test_one_pass_gives_the_same(spark):
    prepare(spark)
    df = frame(spark, [(k, t) for k, t in enumerate(texts(100, 6))] + [(None, None)])
    two = bpe.decode(bpe.encode(df, RANKS), RANKS)
    assert sorted(map(str, bpe.encode_and_decode(df, RANKS).collect())) == sorted(map(str, two.collect()))


def test_empty_tables(spark):
    prepare(spark)
    empty = frame(spark, [])
    assert bpe.decode(bpe.encode(empty, RANKS), RANKS).count() == 0
    folder = scratch_path(spark, "test_ids")
    packing.write_ids(empty, folder, TOKENIZER)
    assert packing.read_documents(spark, folder).count() == 0


def test_query_op4(spark, oracle):
    docs = {r.doc_id: r.text or "" for r in table(spark, FOLDER, "documents").collect()}
    got = REGISTRY["op4_byte_bpe"](spark, FOLDER).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    for r in got:
        ids = oracle.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.data())
def test_pack_round_trip_and_random_access(width, data):
    ids = np.array(data.draw(st.lists(st.integers(0, (1 << width) - 1), max_size=200)), dtype=np.int64)
    packed = packing.pack(ids, width, block=data.draw(st.integers(1, 50)))
    assert packing.unpack(packed).tolist() == ids.tolist()
    a, b = sorted(data.draw(st.tuples(st.integers(0, 210), st.integers(0, 210))))
    assert packing.unpack(packed, a, b).tolist() == ids[a:b].tolist()


def test_width_is_the_least():
    assert [packing.width_of(n) for n in (1, 2, 3, 4, 5, 50_257, 65_536, 65_537)] == [1, 1, 2, 2, 3, 16, 16, 17]
    with pytest.raises(ValueError):
        packing.pack(np.array([8]), 3)


def ordered(rows, library):
    out, start = [], 0
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_op10(spark, library):
    docs = sorted((r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect())
    got = REGISTRY["op10_token_files"](spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == ordered(docs, library)


def test_files_with_odd_rows_and_small_segments(spark, library):
    prepare(spark)
    rows = [(k * 3, t) for k, t in enumerate(texts(150, 4))] + [(5, None), (6, ""), (None, "null id"), (9, "same"), (9, "same"), (9, "other")]
    folder = scratch_path(spark, "test_ids")
    packing.write_ids(frame(spark, [(*r, "s") for r in rows], ", start string"), folder, TOKENIZER, segment_ids=64, block=16, partitions=3)
    got = packing.read_documents(spark, folder).collect()
    by_start = sorted(map(tuple, got), key=lambda r: r[1])
    assert [r[0] for r in by_start] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    ends = np.cumsum([r[2] for r in by_start]).tolist()
    assert [r[1] for r in by_start] == [0, *ends[:-1]]
    wanted = sorted((str(i), n, c) for i, _, n, c in ordered(rows, library))
    assert sorted((str(i), n, c) for i, _, n, c in by_start) == wanted


def test_special_token_strings_are_ordinary_text(library):
    ids, _ = packing.encode_texts(["a <|endoftext|> b"], TOKENIZER)
    assert ids.tolist() == library.encode("a <|endoftext|> b", add_special_tokens=False).ids and 50256 not in ids
