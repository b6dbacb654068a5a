"""BPE, packed id files and token counts against the libraries."""
import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from llm_data import edge_docs, EDGE_TEXTS, no_docs, SMALL, texts_of  # noqa: F401
from tokenizers import Tokenizer

from logonlens.llm import byte_bpe, packed_ids, token_counts
from logonlens.llm.queries import MULTI_RANKS, QUERIES
from logonlens.session import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = "  \n\taabbcÄéß'stre1209.,;|-–—漢字か😀 ​▁\x00\x1c"


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(MULTI_RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_transducer_equals_library_on_odd_pieces(ranks, library):
    small = byte_bpe.Transducer(ranks, max_states=300)       # starts anew many times
    rnd, tokens = random.Random(2), list(ranks)
    for _ in range(3000):
        piece = b"".join(rnd.choice(tokens) for _ in range(rnd.randint(1, 5)))
        assert small.encode(piece) == library._core_bpe.encode_single_piece(piece)
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for t in [*odd_texts(3000), "a" * 3000, "ab" * 999, "=-" * 700]:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == library.encode_ordinary(t)


def test_pairs_kept_are_bounded_and_ids_the_same(ranks, library):
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN, max_memo=20, max_states=50, max_pairs=40)
    for t in odd_texts(300, seed=4):
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == library.encode_ordinary(t)
        assert len(encoder.transducer.pairs) <= 41


def test_memory_is_given_back_when_the_last_rows_are_gone(monkeypatch):
    held = []

    def work(batches):
        for batch in batches:
            made = pa.array([b"x" * (1 << 20)] * 8)
            yield made

    monkeypatch.setattr(byte_bpe, "give_back", lambda: held.append(pa.total_allocated_bytes()))
    before = pa.total_allocated_bytes()
    for made in byte_bpe.giving_back(work)([1, 2]):
        assert pa.total_allocated_bytes() - before >= 8 << 20
        del made
    assert held == [before]


def test_stream_decoder_equals_codec():
    rnd = random.Random(1)
    odd = [0x41, 0x80, 0xBF, 0xC3, 0xE0, 0xA0, 0xED, 0xF0, 0x9F, 0xF4, 0xFF, 0xC0]
    for step in (1, 2, 3, 5):
        for _ in range(800):
            raw = bytes(rnd.choice(odd) for _ in range(rnd.randint(0, 12)))
            stream = byte_bpe.Utf8Stream()
            got = "".join(stream.feed(raw[k:k + step]) for k in range(0, len(raw), step)) + stream.close()
            assert got == raw.decode("utf-8", "replace")


def test_bpe_query_and_edge_cases(spark, library, edge_docs, no_docs):
    def want(docs):
        out = []
        for i, t in docs:
            ids = library.encode_ordinary(t)
            out.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                        hashlib.sha256(t.encode()).hexdigest()))
        return sorted(out, key=str)

    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(map(tuple, QUERIES["op1_byte_bpe"](spark, SMALL).collect()), key=str) == want(texts_of(small))
    run = byte_bpe.digests(edge_docs, MULTI_RANKS, public_tokenizers.PATTERN)
    assert sorted(map(tuple, run.collect()), key=str) == want(texts_of(edge_docs))
    assert byte_bpe.digests(no_docs, MULTI_RANKS, public_tokenizers.PATTERN).count() == 0
    back = byte_bpe.decode(byte_bpe.encode(edge_docs, MULTI_RANKS, public_tokenizers.PATTERN), MULTI_RANKS)
    assert sorted((r.doc_id, r.text) for r in back.collect() if r.doc_id is not None) == \
        sorted(x for x in texts_of(edge_docs) if x[0] is not None)


@pytest.mark.parametrize("bits", [1, 7, 15, 16, 17, 31, 32])
def test_packed_file_round_trip_and_random_access(bits, monkeypatch):
    monkeypatch.setattr(packed_ids, "WRITE_IDS", 256)
    rng = np.random.default_rng(bits)
    docs = [(k if k % 5 else None, rng.integers(0, 1 << bits, rng.integers(0, 300)).astype("<u4")) for k in range(60)]
    sink = io.BytesIO()
    writer = packed_ids.Writer(sink, bits, block_ids=128)
    for doc in docs:
        writer.add(*doc)
    writer.close()
    reader = packed_ids.Reader(io.BytesIO(sink.getvalue()))
    assert [(i, x.tolist()) for i, _, x in reader.documents()] == [(i, x.tolist()) for i, x in docs]
    for k in (0, 7, 59, 31):
        assert reader.document(k).tolist() == docs[k][1].tolist()
    every = np.concatenate([x for _, x in docs])
    for a, b in ((0, 1), (127, 129), (500, 500), (1000, 3000)):
        assert reader.span(a, b).tolist() == every[a:b].tolist()
    assert sink.tell() < len(every) * bits / 8 + 17 * 60 + 8 * len(reader.offsets) + 8 * bits + 100


def test_packed_query_and_edge_cases(spark, edge_docs, no_docs):
    tokenizer = Tokenizer.from_file(BYTES)

    def want(docs):
        start, out = 0, []
        for i, t in docs:
            ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
            out.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
            start += len(ids)
        return out

    small = sorted(texts_of(spark.read.parquet(f"{SMALL}/documents.parquet")))
    assert sorted(map(tuple, QUERIES["op5_packed_ids"](spark, SMALL).collect())) == sorted(want(small))
    unique = edge_docs.dropDuplicates(["doc_id"])
    docs = sorted(texts_of(unique), key=lambda x: (x[0] is not None, x[0]))
    got = packed_ids.write_and_read(spark, unique, scratch_path(spark, "idpk-test"), BYTES, 2).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want(docs), key=str)
    twice = packed_ids.write_and_read(spark, edge_docs, scratch_path(spark, "idpk-test"), BYTES, 2).collect()
    assert len(twice) == edge_docs.count()
    assert packed_ids.write_and_read(spark, no_docs, scratch_path(spark, "idpk-test"), BYTES, 2).count() == 0


def test_new_pieces_go_to_the_library_in_lines():
    plain = Tokenizer.from_file(BYTES)
    calls = []

    class Counting:
        def __init__(self, library):
            self.library = library

        def __getattr__(self, name):
            calls.append(name)
            return getattr(self.library, name)

    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdeéß漢'’.,-1") for _ in range(rnd.randint(1, 12))) for _ in range(4000)]
    texts = [" ".join(rnd.choice(words) for _ in range(200)) for _ in range(60)]
    texts += [*EDGE_TEXTS, *odd_texts(2000, 8), "a" * 200 + " " + "b" * 200 + "  c d\n", " x ", "x\n y\n", "end<|endoftext|> of it"]
    texts = [t for t in texts if t is not None]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for bound in (700_000, 100):                         # the smaller one starts anew many times
        encoder = packed_ids.LibraryEncoder(BYTES, bound)
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_all(texts)] == want
        assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in texts] == want
        assert max(map(len, encoder.known), default=0) <= byte_bpe.MAX_MEMO_CHARS
    encoder = packed_ids.LibraryEncoder(BYTES)
    encoder.library = Counting(encoder.library)
    list(encoder.encode_all(texts[:60]))
    assert len(calls) < 200                              # not one for each of about 3,800 words


def test_pre_token_counts_equal_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    length = token_counts.length_of(PIECES)
    for t in [*odd_texts(4000, 5), *(t for t in EDGE_TEXTS if t)]:
        assert sum(map(length, token_counts.pre_tokens(t))) == len(library.encode(t)), repr(t)


def test_summaries_keep_frequent_entries():
    counts = token_counts.Counter({"a": 50, "b": 40, **{f"x{k}": 1 + k % 3 for k in range(200)}})
    small = token_counts.shrink(counts, 10)
    assert len(small) <= 10 and {"a", "b"} <= set(small)
    assert token_counts._unpack_summary(token_counts._pack_summary(counts)) == counts


def test_count_query_and_edge_cases(spark, edge_docs, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def want(docs, limit):
        return sorted(((i, len(t.encode()), len(library.encode(t)), len(library.encode(t)) > limit) for i, t in docs), key=str)

    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(map(tuple, QUERIES["op7_token_counts"](spark, SMALL).collect()), key=str) == want(texts_of(small), 4096)
    for frequent in (2, 1000):
        got = token_counts.token_counts(edge_docs, PIECES, 3, frequent=frequent)
        assert sorted(map(tuple, got.collect()), key=str) == want(texts_of(edge_docs), 3)
    assert token_counts.token_counts(no_docs, PIECES, 3).count() == 0
