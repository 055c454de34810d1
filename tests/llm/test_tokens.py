"""Packing, bit packing and byte-level BPE against the libraries themselves."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from samples import planted
from tokenizers import Tokenizer

from tableflow.llm import bitpack, bpe, packing
from tableflow.llm.tokens import Encoder, regular_runs

BPE = public_tokenizers.path("byte_bpe_50k.json")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

ODD = ["", " ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "\n\n a", "it's  we'll  ", "x  y",
       "x  y", " 　 ", "1 2  3", "<|endoftext|> a", "a <|endoftext|>", "\U0001f600 é",
       "tab\t tab \t", "a\x1c b", "\x85 \x85", "don 't 'll", "▁ ▁x", "\x00 \x00",
       "<unused 1> <unk> <s>", "a b.\nC d,\n\ne f\n g\nh. i.\n", "\na b", "é.\nÉ!? x.y a.\n.b '\nc", "a" * 3000 + " " + "é" * 500]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_encoder_equals_the_library(library):
    own = Encoder(BPE)
    for text in ODD + [text or "" for _, text in planted()]:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == \
            library.encode(text, add_special_tokens=False).ids, text
        assert "".join(regular_runs(text)) == text


def test_word_tokenizer_is_left_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, other = Encoder(path), Tokenizer.from_file(path)
    other.encode_special_tokens = True
    for text in ODD:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == \
            other.encode(text, add_special_tokens=False).ids


def test_added_tokens_equal_the_unchanged_library(spark):
    other = Tokenizer.from_file(BPE)
    texts = [*ODD, "one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b.\n <|endoftext|>",
             "<|endoftext|", " ".join(["de la"] * 300) + "\n<|endoftext|><|endoftext|> x  y"]
    ids = [other.encode(text, add_special_tokens=False).ids for text in texts]
    assert ids[len(ODD)] == [505, 220, 50256, 734]
    own = Encoder(BPE, added=True)
    assert [np.frombuffer(own.ids(text), "<u4").tolist() for text in texts] == ids
    docs = spark.createDataFrame([(i, text, "en", "src", len(text)) for i, text in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    held = {row["doc_id"]: tuple(row)[1:] for row in
            bitpack.read_images(bitpack.write_images(docs, BPE, 2)).collect()}
    found = defaultdict(list)
    for row in packing.sequences(packing.packed(docs, BPE, with_ids=True), pad_id=0).collect():
        found[row["sequence_id"]] = row["ids"][:row["n_tokens"]]
    start = 0
    for i, one in enumerate(ids):
        one = one + [2]
        assert held[i] == (start, len(one), zlib.crc32(np.array(one, "<u4").tobytes()))
        start += len(one)
    stream = [one for number in sorted(found) for one in found[number]]
    assert sorted(stream) == sorted(sum(ids, []) + [0] * len(ids))


@pytest.fixture(scope="module")
def rank_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=bpe.read_ranks(MULTI), special_tokens={})


def test_codec_equals_tiktoken(rank_encoding):
    own = bpe.Codec(MULTI, public_tokenizers.PATTERN)
    for text in ODD + [text or "" for _, text in planted()]:
        ids = own.encode(text)
        assert ids == rank_encoding.encode_ordinary(text), text
        assert own.decode(ids) == text.encode()


def test_small_vocabularies_and_gaps():
    ranks = {bytes([byte]): byte for byte in range(256)} | {b"ab": 300, b"bc": 299}
    model = bpe.serialised(ranks)
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    assert processor.get_piece_size() == 302
    assert processor.encode("abcab") == [97, 299, 300]


def test_bpe_digests(documents, rank_encoding):
    found = bpe.digests(documents, MULTI, public_tokenizers.PATTERN)
    rows = [(row["row"]["doc_id"], row["n_tokens"], row["ids_sha256"], row["decoded_sha256"])
            for row in found.collect()]
    wanted = []
    for doc_id, text in planted():
        ids = rank_encoding.encode_ordinary(text or "")
        wanted.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode())
                       .hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)
    assert bpe.encoded(documents, MULTI, public_tokenizers.PATTERN).columns == ["row", "ids"]
    assert bpe.digests(documents.limit(0), MULTI, public_tokenizers.PATTERN).collect() == []


@pytest.mark.parametrize("bits", [1, 5, 11, 16, 17, 31])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype("<u4")
    data = bitpack.pack(ids, bits)
    assert len(data) == -(-1000 * bits // 8)
    assert (bitpack.unpack(data, 1000, bits) == ids).all()
    with pytest.raises(ValueError):
        bitpack.pack(np.array([1 << bits], "<u4"), bits)
    counts = np.array([0, 400, 600])
    held = bitpack.Image(bitpack.image([5, None, 7], counts, ids, bits, block_ids=64))
    assert held.doc_ids == [5, None, 7] and held.counts.tolist() == counts.tolist()
    for start, count in [(0, 1000), (63, 2), (64, 64), (990, 50), (1000, 5), (500, 0)]:
        assert (held.ids(start, count) == ids[start:start + count]).all()


def test_bits_of_vocabularies():
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65537)] == \
        [1, 1, 2, 8, 9, 16, 17]


@pytest.mark.parametrize("image_bytes", [500, 1 << 22])
def test_token_files(documents, library, image_bytes):
    found = bitpack.read_images(bitpack.write_images(documents, BPE, 2, image_bytes=image_bytes))
    rows = sorted(map(tuple, found.collect()), key=lambda row: row[1])
    ids = {}
    start, wanted = 0, []
    for doc_id, text in sorted(planted(), key=lambda row: (row[0] is not None, row[0] or 0)):
        own = library.encode(text or "", add_special_tokens=False).ids + [2]
        wanted.append((doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
        ids[doc_id] = own
    assert rows == wanted


def test_token_files_of_an_empty_table(documents):
    assert bitpack.read_images(bitpack.write_images(documents.limit(0), BPE, 2)).collect() == []


def checked_pieces(pieces, library, sequence=1024):
    """Every id of every document in one piece; sequences without gaps; only the last is short."""
    texts = defaultdict(list)
    for doc_id, text in planted():
        texts[doc_id].append(library.encode(text or "", add_special_tokens=False).ids + [0])
    by_document = defaultdict(list)
    for piece in pieces:
        by_document[piece["doc_id"]].append(piece)
    assert set(by_document) == set(texts)
    for doc_id, own in by_document.items():
        if len(texts[doc_id]) > 1:  # two rows of one id: as many ids
            assert sum(piece["length"] for piece in own) == sum(map(len, texts[doc_id]))
            continue
        own.sort(key=lambda piece: piece["start"])
        ids, at = texts[doc_id][0], 0
        for piece in own:
            part = ids[at:at + piece["length"]]
            assert piece["start"] == at and piece["doc_tokens"] == len(ids)
            assert piece["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += piece["length"]
        assert at == len(ids)
    held = defaultdict(list)
    for piece in pieces:
        held[piece["sequence_id"]].append((piece["offset"], piece["length"]))
    assert sorted(held) == list(range(len(held)))
    for number, own in held.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == sequence or number == len(held) - 1


def test_packing_is_whole_and_mixed(documents, library):
    pieces = packing.packed(documents, BPE).collect()
    checked_pieces(pieces, library)
    totals = Counter()
    for piece in pieces:
        totals[piece["source"]] += piece["length"]
    every = sum(totals.values())
    windows = defaultdict(Counter)
    for piece in pieces:
        windows[piece["sequence_id"]][piece["source"]] += piece["length"]
    for number in range(len(windows) - 1):
        for source, count in totals.items():
            # the first and the last round of a window can be cut: a quantum and the deficits
            assert abs(windows[number][source] - 1024 * count / every) <= len(totals) + 2


def test_packing_follows_a_mixture(documents, library):
    mixture = {"src0": 0.75, "src1": 0.25}
    pieces = packing.packed(documents, BPE, mixture=mixture, sequence=128).collect()
    checked_pieces(pieces, library, 128)
    windows = defaultdict(Counter)
    for piece in pieces:
        windows[piece["sequence_id"]][piece["source"]] += piece["length"]
    for number in range(20):
        assert abs(windows[number]["src0"] - 96) <= 4 and abs(windows[number]["src1"] - 32) <= 4
    assert packing.packed(documents.limit(0), BPE).collect() == []


def test_packed_sequences(documents):
    pieces = packing.packed(documents, BPE, with_ids=True)
    rows = packing.sequences(pieces, pad_id=9).collect()
    assert all(len(row["ids"]) == 1024 for row in rows)
    assert sum(row["n_tokens"] for row in rows) == sum(p["length"] for p in pieces.collect())


def test_rounds_by_play():
    """The closed form against rounds that are played one after the other."""
    totals, sequence = np.array([700, 90, 3, 1500]), 64
    quantum = packing.quanta(totals, sequence)
    stream, left, credit = [], totals.copy(), np.zeros(4, np.int64)
    while left.sum():
        for queue in range(4):
            if left[queue]:
                credit[queue] += quantum[queue]
                count = min(credit[queue] // packing.PARTS, left[queue])
                credit[queue] -= count * packing.PARTS
                first = totals[queue] - left[queue]
                stream += [(queue, first + i) for i in range(count)]
                left[queue] -= count
    run, begin, size, position = packing.place(
        np.arange(4), np.zeros(4, np.int64), totals, quantum, totals, sequence)
    found = {}
    for queue, first, count, at in zip(run, begin, size, position):
        found.update({at + i: (queue, first + i) for i in range(count)})
    assert [found[i] for i in range(len(stream))] == stream
