import heapq
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import llm_cases as cases
from engage.llm import huffman as H
from engage.llm.common import new_path
from engage.llm import tokens
from engage.llm.tokens import default_tokenizer


def brute(rows):
    tok = Tokenizer.from_file(default_tokenizer())
    out, start = [], 0
    enc = [(d, tok.encode(t or "", add_special_tokens=False).ids + [0]) for d, t in rows]
    for d, ids in sorted(enc, key=lambda x: (x[0] is not None, x[0] or 0, len(x[1]), np.array(x[1], "<u2").tobytes())):
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("which", ["documents", "small"])
def test_round_trip_equals_brute_force(spark, which):
    docs = getattr(cases, which)(spark)
    got = sorted(map(tuple, H.round_trip(docs).collect()), key=lambda r: r[1])
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_special_tokens_in_a_text_are_their_ids(spark):
    rows = [(1, "hello <|endoftext|> world"), (2, "<|endoftext|>"), (3, "a\n<|endoftext|>b <|endoftext|")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, H.round_trip(docs).collect()), key=lambda r: r[1])
    assert got == brute(rows) and got[0][2] == 5


def test_empty_table(spark):
    assert H.round_trip(cases.no_documents(spark)).collect() == []


def test_many_shards_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_IDS", 64)
    docs = cases.small(spark)
    path = new_path(spark, "t")
    H.encode_table(docs, path, shards=17)
    assert spark.read.parquet(f"{path}/blocks").count() > 50
    got = sorted(map(tuple, H.decode_table(spark, path).collect()), key=lambda r: r[1])
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 100, 1000):
        counts = rng.zipf(1.3, n).clip(1, 10**9)
        free = H.code_lengths(counts, 60)
        heap = [int(c) for c in counts]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            s = heapq.heappop(heap) + heapq.heappop(heap)
            cost += s
            heapq.heappush(heap, s)
        if n > 1:
            assert int((counts * free).sum()) == cost
        for limit in (12, 16):
            lim = H.code_lengths(counts, limit)
            assert lim.max() <= limit and lim.min() >= 1
            assert (2.0 ** -lim).sum() <= 1
            assert (counts * lim).sum() >= (counts * free).sum()


def test_codes_are_a_prefix_code_and_pack_unpacks():
    rng = np.random.default_rng(2)
    counts = np.zeros(5000, np.int64)
    counts[rng.choice(5000, 900, replace=False)] = rng.zipf(1.2, 900).clip(1, 10**8)
    lengths = H.code_lengths(counts, 14)
    codes = H.canonical(lengths)
    words = sorted(format(int(codes[i]), f"0{lengths[i]}b") for i in np.flatnonzero(lengths))
    assert all(not b.startswith(a) for a, b in zip(words, words[1:]))
    coder = H.Coder(lengths)
    for n in (1, 127, 128, 129, 5000):
        ids = rng.choice(np.flatnonzero(lengths), n)
        offsets, bits = coder.pack(ids)
        assert (coder.unpack(bits, offsets, n) == ids).all()


def test_blocks_unpack_at_once():
    rng = np.random.default_rng(3)
    lengths = H.code_lengths(rng.zipf(1.3, 700).clip(1, 10**6))
    coder = H.Coder(lengths)
    blocks = [rng.choice(700, n) for n in (1, 128, 5000, 127, 129, 3000)]
    packed = [(*reversed(coder.pack(ids)), len(ids)) for ids in blocks]
    got = coder.unpack_blocks(packed)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(got, blocks, strict=True))


def test_chunks_end_where_the_kind_changes():
    """So that few chunks are new, and few of these need the regular expression."""
    enc = tokens.Encoder(default_tokenizer())
    texts = ["Ab12.5, don't\nwell-known été. x×y", "a<|endoftext|>b"]
    chunks, plain, codes, first = enc._chunks(pa.array([t.encode() for t in texts], pa.binary()))
    found = [chunks[i].decode() for i in codes]
    assert found == ["Ab", "12", ".", "5", ",", " don't", "\n", "well", "-", "known", " été", ".", " x×y",
                     "a", "<|endoftext|>", "b"]
    assert [c for c, p in zip(map(bytes.decode, chunks), plain) if not p] == [" don't", "\n", " x×y", "<|endoftext|>"]
    assert first.tolist() == [0, 13, 16]


def test_changes_of_kind_encode_like_whole_texts():
    parts = ["'", "s", "re", "A", "z", "é", "É", "×", "÷", "0", "42", ".", "-", "<", "|", ">", "endoftext", "<|endoftext|>",
             " ", "  ", "\n", "\t", "\u0301", "²", "½", "ß", "日", "\xa0", "_", "@", "\u200b", "\x00", "\x7f", "ª", "е", '"']
    draw = random.Random(3)
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(20_000)]
    want = Tokenizer.from_file(default_tokenizer()).encode_batch(texts, add_special_tokens=False)
    got = []
    for ids, ends in tokens.Encoder(default_tokenizer()).encode(pa.array([t.encode() for t in texts], pa.binary())):
        got += [ids[s:e].tolist() for s, e in zip([0, *ends[:-1]], ends)]
    assert got == [e.ids for e in want]


def test_chunks_encode_like_whole_texts(monkeypatch):
    parts = ["a", "b", "Z", " ", "  ", "\n", "\n\n", "\t", "\u2003", "\x1f", "'s", "é", "1", ".", "<|endoftext|>",
             "\r", "word", " x y ", "\u3000", "\x85", "\xa0", "’", " été,", " Ïle.", " a×b", "word;", " naïve!?", " ÿ",
             " x÷", " the.", " the", "日本", " 😀", "\x1c", " »"]
    draw = random.Random(1)
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(20_000)]
    plain = Tokenizer.from_file(default_tokenizer())
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    array = pa.array([t.encode() for t in texts], pa.binary())
    for size, kept in ((1 << 22, 500_000), (700, 50)):      # many slices, generations that pass often
        monkeypatch.setattr(tokens, "SLICE", size)
        monkeypatch.setattr(tokens, "CACHE", kept)
        enc = tokens.Encoder(default_tokenizer())
        got = []
        for ids, ends in enc.encode(array.slice(3)):
            got += [ids[s:e].tolist() for s, e in zip([0, *ends[:-1]], ends)]
        assert got == want[3:]
        assert enc.lengths(array).tolist() == [len(w) for w in want]
    assert enc.lengths(pa.array([], pa.binary())).tolist() == []
    assert enc.lengths(pa.array([b"", b""], pa.binary())).tolist() == [0, 0]
