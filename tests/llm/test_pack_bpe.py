import functools
import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docloom.llm import bpe, encoding, packing

VOCABULARY, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "", " ", "  two  spaces ", "don't we've I'LL 123 4567", "a\r\n\r\n\tb\n ", "naïve ☃ 漢字 \U0001f600 é", "<|endoftext|> x", "a<|endoftext|>b <|endoftext|>.  <|endoftext|>  c\n<|endoftext|>", "word " * 50, "x" * 500, " x y\xa0z ", "tab\there", "!!! ... ??", "\n\n a",
]


@functools.cache
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_by_tokenizers(text):
    return library().encode(text, add_special_tokens=False).ids


def test_piece_cache_gives_the_library_s_ids():
    rng = random.Random(3)
    pieces = [" ", "  ", "\n", "a", "Bc", "'s", "12", ".", "é", "word", "\xa0", "\t", ",", "<|endoftext|>"]
    texts = TEXTS + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    cache = bpe.by_tokenizers(VOCABULARY)
    for group in (texts, texts[::-1]):
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in cache.ids(group)] == [ids_by_tokenizers(t) for t in group]


def check_packing(rows, ids, size):
    """Every id in one piece, sequences gapless from 0; returns the padding's share."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for key, own in by_doc.items():
        data = b"".join(r.ids for r in sorted(own, key=lambda r: r.start))
        assert np.frombuffer(data, dtype="<u4").tolist() == ids[key] and all(r.doc_tokens == len(ids[key]) and len(r.ids) == 4 * r.length for r in own)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert own[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(own, own[1:], strict=False)) and own[-1].offset + own[-1].length <= size
    return 1 - sum(r.length for r in rows) / (size * len(by_sequence))


def test_pack(spark):
    rng = random.Random(5)
    texts = dict(enumerate(TEXTS + [None] + [" ".join(rng.choice(["alpha", "be", "c", "delta"]) for _ in range(rng.choice([3, 20, 60, 400]))) for _ in range(300)]))
    docs = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "doc_id long, text string, part string").repartition(5)
    rows = packing.pack(docs, VOCABULARY, size=64).collect()
    assert set(r.doc_id for r in rows) == set(texts)
    waste = check_packing(rows, {k: ids_by_tokenizers(v or "") + [1] for k, v in texts.items()}, 64)
    assert waste < 0.02
    assert packing.pack(docs.limit(0), VOCABULARY).collect() == []


def test_pack_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = packing.pack(docs, VOCABULARY, size=8).collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [(False, 3), (False, 3), (True, 2)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3


def test_pack_histogram_bounds():
    rng = random.Random(9)
    for _ in range(30):
        counts = {rng.randint(1, 99): rng.randint(1, 10**6) for _ in range(rng.randint(1, 60))}
        patterns = packing.pack_histogram(dict(counts), 100)
        assert len(patterns) <= 300 and all(sum(n * times for n, times in p) <= 100 for _, p in patterns)
        for length, n in counts.items():
            assert sum(c * times for c, p in patterns for x, times in p if x == length) == n


@pytest.mark.parametrize("size", [(40, 16), (64, 8)])
def test_chunked_encoding_is_the_library_s(spark, size):
    rng = random.Random(11)
    pieces = ["a", " b", "  ", "\n", "'s", " don't", "123", "é", "!?", "\t", "longerword", " ", "\r\n", "漢"]
    texts = dict(enumerate([*TEXTS, None, *("".join(rng.choice(pieces) for _ in range(rng.randint(1, 300))) for _ in range(150))]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    coded = encoding.encode(docs, RANKS, chunk=size[0], overlap=size[1])
    rows = encoding.decode(coded, RANKS).collect()
    library = bpe.by_ranks(RANKS)
    assert {r.doc_id: np.frombuffer(r.ids, dtype="<u4").tolist() for r in rows} == {k: library.encode_ordinary(v or "") for k, v in texts.items()}
    assert all(bytes(r.bytes) == (texts[r.doc_id] or "").encode() for r in rows)


def test_nothing_goes_on_from_another_character_to_white_space():
    """What ``CERTAIN`` rests on, for every pre-token of random texts."""
    rng, pattern = random.Random(2), regex.compile(P.PATTERN)
    pieces = ["a", "Zé", "'", "'ll", "12", "!", " ", "  ", "\n", "\t", "\xa0", "\x1c", "\u2028", "漢", "\u0301", "\U0001f600", "\x00"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 30)))
        for begin in range(min(len(text), 4)):
            ends = {m.end() + begin for m in pattern.finditer(text[begin:])}
            assert {m.start() for m in regex.finditer(encoding.CERTAIN, text) if m.start() > begin} <= ends


def test_cut_again_behind_a_long_pre_token(spark):
    """A pre-token longer than the overlap joins its own chunks alone; a text without any boundary stays one piece."""
    plain = "some words, it's 12 o'clock " * 40
    texts = {1: plain + "x" * 100 + plain, 2: "漢" * 300, 3: "!" * 90 + plain + " " * 70 + plain, 4: plain + "漢" * 90 + "。漢字" * 60 + "\n" + plain}
    long = spark.createDataFrame([(k, k, v) for k, v in texts.items()], "id long, row long, text string")
    found = {}
    for r in encoding.pieces_of(long, 40, 16).collect():
        found.setdefault(r.id, []).append((r["from"], r.text))
    pattern = regex.compile(P.PATTERN)
    for key, text in texts.items():
        pieces = [t for _, t in sorted(found[key])]
        assert "".join(pieces) == text and [m[0] for t in pieces for m in pattern.finditer(t)] == [m[0] for m in pattern.finditer(text)]
    longest = {key: max(len(t) for _, t in found[key]) for key in texts}
    assert longest[1] <= 100 + 4 * 40 and longest[3] <= 90 + 4 * 40 and len(found[2]) == 1 and longest[4] <= 90 + 180 + 4 * 40


def test_whole_chunks_of_the_real_size(spark):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdeé'12") for _ in range(rng.randint(1, 12))) for _ in range(60_000)) + "y" * 5000 + " the end" * 30_000
    rows = encoding.decode(encoding.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS), RANKS).collect()
    assert np.frombuffer(rows[0].ids, dtype="<u4").tolist() == bpe.by_ranks(RANKS).encode_ordinary(text) and bytes(rows[0].bytes) == text.encode()


def test_encoding_keeps_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (1, "b " * 60), (1, "b " * 60)], "doc_id long, text string")
    rows = encoding.encode(docs, RANKS, chunk=20, overlap=8).select("doc_id", F.octet_length("ids").alias("n")).collect()
    assert sorted((r.doc_id is None, r.n) for r in rows)[0] == (False, rows[-1].n) and len(rows) == 3
    assert encoding.encode(docs.limit(0), RANKS).count() == 0


def test_words_are_encoded_together():
    """Words encoded as one text get the ids they have by themselves, also beside a special token, inner line ends and many stops."""
    cache = bpe.by_tokenizers(VOCABULARY)
    asked = []
    both = bpe.PieceCache(lambda texts: asked.append(len(texts)) or cache.encode(texts), set(np.flatnonzero(cache.spaced).tolist()))
    single = bpe.PieceCache(cache.encode)
    texts = [" ".join(f"w{k}x" for k in range(3000)), "a <|endoftext|> b<|endoftext|>c \u0120x d", "one\ntwo three\u00a0four 'll x's 12345,6.7 \u6f22\u5b57 \U0001f600\u200d end.", "a  b\t c", "", " x "]
    assert both.ids(texts) == single.ids(texts) == [np.array(x, dtype="<u4").tobytes() for x in cache.encode(texts)]
    assert sum(asked) < 100
