"""Token files: codes against plain ones, pieces against whole texts, and whole round trips."""

import heapq
import itertools
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kaigi.llm import huffman, queries, token_files
from kaigi.staging import new_folder

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, at long, part int, file string, tie long"


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def huffman_cost(counts):
    heap, cost = [c for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


def test_lengths_are_the_shortest():
    r = random.Random(2)
    for n in (2, 3, 5, 40, 700):
        counts = np.array([r.choice([0, 1, 1, 2, r.randrange(1, 1000), 3**n if n < 30 else 10**9]) for _ in range(n)] + [1, 2])
        lengths = huffman.code_lengths(counts, 30).astype(int)
        assert (lengths * counts).sum() == huffman_cost(counts.tolist())
        assert sum(2.0 ** -b for b in lengths if b) == 1 and ((lengths > 0) == (counts > 0)).all()


def test_limited_lengths_against_all_others():
    for counts in ([1, 1, 2, 4, 8, 16], [1, 3, 9, 27, 81], [5, 5, 5, 5, 5], [1, 1, 1, 100, 100]):
        for limit in (3, 4):
            best = min(sum(a * b for a, b in zip(counts, bits)) for bits in itertools.product(range(1, limit + 1), repeat=len(counts)) if sum(2.0 ** -b for b in bits) <= 1)
            lengths = huffman.code_lengths(np.array(counts), limit)
            assert (lengths * counts).sum() == best and lengths.max() <= limit


def test_codes_are_canonical_and_prefix_free():
    lengths = huffman.code_lengths(np.random.default_rng(1).integers(0, 9, 300) ** 5, 12)
    codes = huffman.canonical_codes(lengths)
    words = [(int(lengths[i]), i, format(int(codes[i]), f"0{lengths[i]}b")) for i in np.flatnonzero(lengths)]
    in_order = [w for _, _, w in sorted(words)]
    assert in_order == sorted(in_order)
    assert not any(b.startswith(a) for a, b in itertools.pairwise(in_order))


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 100_000])
@pytest.mark.parametrize("top", [1, 2, 50_257])
def test_round_trip_of_codes(n, top):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n) - 1, top - 1).astype(np.uint32)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=top))
    payload, checkpoints = huffman.pack(ids, huffman.canonical_codes(lengths), lengths)
    table = huffman.decoding_table(lengths)
    assert (huffman.unpack(payload, n, checkpoints, table) == ids).all()
    if n > 256:  # a stretch can be read from its checkpoint alone
        assert (huffman.unpack(payload, 1, checkpoints[1:2], table) == ids[256:257]).all()


@given(st.text(alphabet=st.sampled_from(list("ab'sltvemrdS 1.,\n\t\r\x1c\x85\xa0　é日²½ªµ×’–\u200b\U0001f600<|>")), max_size=40) | st.text(max_size=40) | st.text(alphabet=st.characters(max_codepoint=255), max_size=40))
@settings(max_examples=1500, deadline=None)
def test_pieces_are_encoded_as_in_whole_texts(text):
    text = text.encode("utf-8", "replace").decode()
    assert ENCODER.encode([text])[0].tolist() == WHOLE.encode(text, add_special_tokens=False).ids


ENCODER, WHOLE = token_files.Encoder(PATH), Tokenizer.from_file(PATH)


def test_encoder_with_a_small_memory(monkeypatch, whole):
    monkeypatch.setattr(token_files, "PLACES", 8)
    encoder = token_files.Encoder(PATH)
    texts = ["a b c d e f g h", "a b <|endoftext|> c", "i j k a b c", "x" * 5000 + " y", "", " ", "  a  b", "日本 a b  ’s", "it's we'll they're 'll I'dx 've '", "\n\nfoo \n bar\n", "'s", "日" * 300 + " " + "é" * 300]
    expected = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(3):
        assert [encoder.encode([t])[0].tolist() for t in texts] == expected
        assert [x.tolist() for x in encoder.encode(texts)] == expected
    assert not any(len(p) > token_files.PIECE_CHARS for p in encoder.known)


def plain(rows, whole):
    at, out = 0, []
    for doc_id, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query(spark, whole):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = queries.queries()["op12_token_files"](spark, SF)
    assert sorted(map(tuple, found.collect())) == plain(sorted(map(tuple, docs)), whole)


def test_odd_rows(spark, whole, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 500)
    rows = [(1, None), (2, ""), (-5, "a b\n c"), (7, " ".join(f"w{i}" for i in range(50_000))), (8, "<|endoftext|> and !"), (9, "x" * 100_000), (10, "日本語 テキスト"), *((i, f"n {i} " * 9) for i in range(20, 90))]
    docs = spark.createDataFrame([(i, t, "i", 1, 2, "f", 3) for i, t in rows], SCHEMA)
    folder = new_folder(spark, "tokens")
    files = token_files.encode_corpus(docs, PATH, folder)
    named = [f for f in os.listdir(folder.removeprefix("file:")) if not f.startswith(".")]
    assert len(named) == files
    decoded = token_files.decode_corpus(spark, folder)
    assert sorted(map(tuple, token_files.digest(decoded).collect())) == plain(sorted(rows), whole)
    text = {r.doc_id: whole.decode(np.frombuffer(r.ids, "<u4")[:-1].tolist(), skip_special_tokens=False) for r in decoded.collect()}
    assert text == {i: t or "" for i, t in rows}


def test_equal_and_missing_ids(spark, whole):
    rows = [(3, "b"), (3, "a"), (3, "a"), (None, "c"), (None, None), (1, "d")]
    folder = new_folder(spark, "tokens")
    token_files.encode_corpus(spark.createDataFrame(rows, "doc_id long, text string"), PATH, folder)
    found = sorted(map(tuple, token_files.digest(token_files.decode_corpus(spark, folder)).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [1, 3, 3, 3, None, None]
    one = {t: plain([(0, t)], whole)[0][2:] for _, t in rows}
    assert sorted(r[2:] for r in found) == sorted(one[t] for _, t in rows)
    assert [r[1] for r in found] == list(itertools.accumulate([r[2] for r in found[:-1]], initial=0))


def test_empty_table(spark):
    folder = new_folder(spark, "tokens")
    assert token_files.encode_corpus(spark.createDataFrame([], "doc_id long, text string"), PATH, folder) == 0
    assert token_files.decode_corpus(spark, folder).collect() == []


def test_damage_is_an_error(spark):
    folder = new_folder(spark, "tokens")
    token_files.encode_corpus(spark.createDataFrame([(1, "some text of this document")], "doc_id long, text string"), PATH, folder)
    (block,) = token_files.scan_blocks(spark, folder).collect()
    path = block.file.removeprefix("file:")
    with open(path, "r+b") as f:
        f.seek(block.offset + block.size - 1)
        last = f.read(1)
        f.seek(block.offset + block.size - 1)
        f.write(bytes([last[0] ^ 255]))
    with pytest.raises(Exception, match="damaged"):
        token_files.decode_corpus(spark, folder).agg(F.sum("start")).collect()
