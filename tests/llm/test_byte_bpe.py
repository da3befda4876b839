import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from tablekit.llm import byte_bpe as B
from tablekit.llm.common import table
from tablekit.llm.queries import public_vocabulary
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def vocabulary():
    return public_vocabulary()


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(vocabulary.tokens)})


def test_perfect_hash_is_minimal_and_exact(vocabulary):
    codec = B.Codec(vocabulary)
    assert sorted(vocabulary.lookup.slots.tolist()) == list(range(len(vocabulary.tokens)))
    assert all(codec.whole(t) == i for i, t in enumerate(vocabulary.tokens))
    assert codec.whole(b"zqzqzqzqzqzq") == -1 and codec.whole(b"") == -1


def test_random_texts_equal_the_library(vocabulary, library):
    codec, rng = B.Codec(vocabulary, remembered=50), random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("abe thé ß中🙂\n\t'12 .,#ll") for _ in range(rng.randint(0, 80)))
        ids = codec.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_long_run_without_blanks(vocabulary, library):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh") for _ in range(200_000))
    ids = B.Codec(vocabulary).encode(text)
    assert len(ids) // 4 == len(library.encode_ordinary(text))


def test_odd_rows_and_clashing_columns(spark, vocabulary, library):
    rows = [(1, None, "x", 7), (1, None, "x", 7), (None, "", "y", 8), (2, "<|endoftext|> hé  \n", "z", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    out = sorted(map(tuple, B.digests(df, vocabulary).collect()), key=repr)
    assert len(out) == 4 and [r[1] for r in out if r[0] != 2] == [0, 0, 0]
    encoded = B.encode(df, vocabulary).where("doc_id = 2").first()
    assert encoded.ids == struct.pack(f"<{len(encoded.ids) // 4}I", *library.encode_ordinary("<|endoftext|> hé  \n"))
    assert encoded.n_tokens == 9
    assert B.digests(spark.createDataFrame([], "doc_id long, text string"), vocabulary).count() == 0


def test_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError, match="lacks"):
        B.Vocabulary.of({b"a": 0}, ".")


def test_vocabulary_with_gaps():
    ranks = {bytes([b]): 2 * b for b in range(256)} | {b"ab": 700, b"abc": 900, b"bc": 901}
    own = B.Vocabulary.of(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("gaps", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=ranks)
    codec = B.Codec(own)
    for text in ("abc ab xbc aabcc", "", "\x00ab"):
        ids = codec.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    with pytest.raises(ValueError, match="different"):
        B.Vocabulary.of(ranks | {b"zz": 700}, ".")


def test_both_engines_cut_alike(vocabulary):
    codec, rng = B.Codec(vocabulary), random.Random(8)
    assert codec.plain_pieces and B.plain_pattern(r"\p{Lu}+") is None
    for _ in range(2000):
        text = "".join(rng.choice("aZé½²ªß'sl 12\n\t\r-_]^\\#×") for _ in range(rng.randint(0, 40)))
        assert codec.plain_pieces(text) == codec.pieces(text)


def test_pieces_merged_together_equal_the_heap(vocabulary):
    codec, rng = B.Codec(vocabulary), random.Random(5)
    pieces = ["".join(rng.choice("abe thé ß中🙂\n\t'12 .,#lltionre") for _ in range(rng.randint(1, 30))).encode()[:B.SHORT] for _ in range(5000)]
    assert codec.merged_together(pieces) == [b"".join(codec.packed[i] for i in codec.merged(p)) for p in pieces]
    assert codec.merged_together([]) == [] and codec.merged_together([b"a"]) == [codec.packed[codec.ranks[b"a"]]]
    # A merge may make a pair of lower rank; a vocabulary may have no pair at all.
    ranks = {bytes([b]): b for b in range(256)}
    for own in (ranks, ranks | {b"bc": 300, b"abc": 260, b"aa": 270, b"abcabc": 257}):
        codec = B.Codec(B.Vocabulary.of(own, "."))
        pieces = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 32))).encode() for _ in range(2000)]
        assert codec.merged_together(pieces) == [b"".join(codec.packed[i] for i in codec.merged(p)) for p in pieces]


def test_texts_of_a_slice_equal_the_library(vocabulary, library):
    codec, rng = B.Codec(vocabulary, remembered=50), random.Random(6)
    texts = ["".join(rng.choice("abe thé ß中🙂\n\t'12 .,#ll") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += ["", "x" * 5000, texts[0], "\n" * 200]
    packed = codec.encode_all(texts)
    assert [list(struct.unpack(f"<{len(p) // 4}I", p)) for p in packed] == [library.encode_ordinary(t) for t in texts]
    assert codec.encode_all([]) == []


def test_each_new_piece_of_a_slice_is_merged_once(vocabulary, monkeypatch):
    codec, alone = B.Codec(vocabulary), []
    monkeypatch.setattr(B.Codec, "merged", lambda self, piece: alone.append(piece) or [0])
    codec.encode_all(["zqxjw vkqzx"] * 20)
    assert not alone and len(codec.memory) == 2


def test_table_equals_the_library(spark, vocabulary, library):
    docs = table(spark, SF_SMALL, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in B.digests(docs, vocabulary).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
