from __future__ import annotations

import base64
import random
import zlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodgeframe.llm import bpe, pretoken, tokenfile
from lodgeframe.llm.queries import vocabulary
from lodgeframe.session import scratch_path
from tests.llm.cases import DOCS, documents, empty, prose

PATH = vocabulary("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def cache():
    ranks = bpe.read_ranks(PATH)
    return bpe.PieceCache(lambda new: [bpe.merge(p.encode(), ranks) for p in new], most=500)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab'strevlmd \n\t\u0085 \x1c12é.,-中😀\0", max_size=40), max_size=6))
def test_ids_match_the_library(library, cache, texts):
    ids, counts = cache.encode_texts(texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(t) for t in texts] or not texts


def test_every_class_of_code_points(library, cache):
    points = [chr(c) for c in [*range(0x3000), *range(0xA000, 0xA100), *range(0x1D400, 0x1D480)]]
    texts = [f"x{c}x {c}1{c}" for c in points]
    ids, counts = cache.encode_texts(texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(t) for t in texts]


def test_long_pieces(library, cache):
    texts = ["a" * 4000, "-" * 3001, " " * 900 + "x", "\n" * 300, "ab" * 1500 + "'s", "é" * 600]
    ids, counts = cache.encode_texts(texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(t) for t in texts]


def test_scan_is_the_sequential_fold():
    numbers, table, start, _ = pretoken._functions()
    rng = random.Random(2)
    for n in (1, 2, 3, 17, 1000):
        f = np.array([numbers[rng.randrange(10)] for _ in range(n)], dtype=np.uint8)
        held, want = None, []
        for x in f:
            held = x if held is None else table[held, x]
            want.append(held)
        assert pretoken.compose_scan(f, table).tolist() == want


def test_round_trip_keeps_rows_and_columns(spark, library):
    df = documents(spark).withColumn("ids", F.lit("clash"))
    got = bpe.round_trip(df, PATH)
    assert got.columns == ["doc_id", "text", "lang", "source", "kept", "quality", "ids", "ends", "bytes"]
    table = got.collect()
    assert len(table) == len(DOCS)
    for r in table:
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.bytes) == (r.text or "").encode()
    again = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted(bytes(r.bytes) for r in again) == sorted(bytes(r.bytes) for r in table)
    assert bpe.round_trip(empty(spark), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**31 - 1)), min_size=1, max_size=2500), st.sampled_from([50, 90, 100]))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, dtype=np.int64)
    packed = tokenfile.pack_blocks(ids, percentile)
    sizes = [min(tokenfile.BLOCK, len(ids) - i * tokenfile.BLOCK) for i in range(len(packed))]
    back = np.concatenate([tokenfile.unpack_block(memoryview(b), n) for b, n in zip(packed, sizes)])
    assert (back == ids).all()


def test_outliers_do_not_widen_a_block():
    ids = np.full(1024, 100, dtype=np.int64)
    ids[::2] = 107
    narrow = len(tokenfile.pack_blocks(ids)[0])
    ids[5] = 1 << 30
    assert len(tokenfile.pack_blocks(ids)[0]) == narrow + 6


def test_token_files(spark):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    known = Tokenizer.from_file(path)
    more = [(9, "a <|endoftext|> b"), (-(1 << 63), "smallest"), ((1 << 62) + 1, "no floating-point number")] + [(1000 - i, prose(i, 900)) for i in range(60)]
    df = documents(spark).unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    # small shards and files, so that several of both are made
    base = scratch_path(spark, "tokens")
    manifest = tokenfile.write_tokens(df, base, path, shard_bytes=100_000, roll_bytes=20_000)
    assert manifest.count() > 3
    got = sorted(tokenfile.read_tokens(manifest, base).collect(), key=lambda r: r.start)
    rows = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in df.collect())
    assert [r.key for r in got] == [k if known_key else None for known_key, k, _ in rows]
    at = 0
    for r, (_, _, text) in zip(got, rows):
        ids = known.encode(text, add_special_tokens=False).ids + [0]
        assert (r.start, r.ids) == (at, ids) and r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        at += len(ids)
    nothing = scratch_path(spark, "tokens")
    assert tokenfile.read_tokens(tokenfile.write_tokens(empty(spark), nothing, path), nothing).count() == 0
