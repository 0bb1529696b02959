import base64
import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_perfect_hash_is_minimal_and_perfect():
    keys = [f"key {i}".encode() for i in range(5000)]
    h = bpe.PerfectHash.build(keys)
    assert h.probe(keys).tolist() == list(range(5000))
    assert sorted(h.slot_key.tolist()) == list(range(5000))


def test_round_trip_matches_the_library(spark, odd, empty, texts):
    ranks = bpe.load_ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = sorted((tuple(r) for r in bpe.digests(bpe.round_trip(odd, PATH, public_tokenizers.PATTERN)).collect()), key=repr)
    want = []
    for i, t, _ in texts:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe.round_trip(empty, PATH, public_tokenizers.PATTERN).count() == 0
    # the same ids and bytes from the two steps apart
    ids = bpe.encode_documents(odd, PATH, public_tokenizers.PATTERN)
    apart = bpe.decode_tokens(ids, PATH, ["doc_id"]).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.decoded)) for r in apart) == sorted((i is None, i or 0, (t or "").encode()) for i, t, _ in texts)


def test_merge_order_and_long_pieces():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaaa": 257, b"ab": 258}
    assert bpe.merge_bytes(b"aaaaa", ranks) == [257, 97]
    assert bpe.merge_bytes(b"aab", ranks) == [256, 98]
    assert bpe.merge_bytes(b"a" * 40000, ranks) == [257] * 10000
    assert base64.b64encode(b"a")  # the rank file's encoding


def test_decode_null_and_cut_ids(spark):
    tokens = spark.createDataFrame([(1, None), (2, bytearray(np.array([64, 65], "<u4").tobytes()))], "k int, token_ids binary")
    got = {r.k: r.decoded for r in bpe.decode_tokens(tokens, PATH, ["k"]).collect()}
    table = {i: k for k, i in bpe.load_ranks(PATH).items()}
    assert got[1] is None and bytes(got[2]) == table[64] + table[65]
