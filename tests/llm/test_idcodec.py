from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hitloom.llm import idcodec

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
with open(VOCABULARY) as f:
    ENCODER = idcodec._Encoder(f.read())
BLOCKS = st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 9), min_size=1, max_size=400), min_size=1, max_size=6)


@settings(max_examples=40, deadline=None)
@given(BLOCKS)
def test_round_trip(blocks):
    blocks = [np.array(b, np.uint32) for b in blocks]
    for a, b in zip(idcodec.decode_blocks(idcodec.encode_blocks(blocks)), blocks):
        assert a.tolist() == b.tolist()


def test_blocks_do_not_depend_on_their_company():
    random = np.random.default_rng(1)
    blocks = [random.zipf(1.3, n).clip(0, m).astype(np.uint32) for n, m in ((3000, 900), (10, 5), (8192, 40000), (1, 1))]
    together = idcodec.encode_blocks(blocks)
    assert together == [idcodec.encode_blocks([b])[0] for b in blocks]
    assert [idcodec.decode_blocks([c])[0].tolist() for c in together] == [b.tolist() for b in blocks]


def test_repeats_cost_less_than_noise():
    noise = np.random.default_rng(2).integers(0, 40000, 4096).astype(np.uint32)
    repeats = np.tile(noise[:64], 64)
    coded = idcodec.encode_blocks([noise, repeats])
    assert len(coded[1]) < len(coded[0]) / 10 and len(coded[0]) < 4 * len(noise)


def test_damage_is_found():
    coded = idcodec.encode_blocks([np.arange(500, dtype=np.uint32)])[0]
    broken = coded[:-40] + bytes([coded[-40] ^ 1]) + coded[-39:]
    with pytest.raises((ValueError, IndexError)):
        idcodec.decode_blocks([broken])


def expected(rows, end_id):
    library, start, out = Tokenizer.from_file(VOCABULARY), 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_files(spark, tmp_path):
    rows = [(i, "word's, Token! <|endoftext|> é\x1cß 12 " * (i % 7)) for i in range(60)] + [(60, None), (61, ""), (62, "long text " * 30000)]
    docs = spark.createDataFrame([(b, a, "x") for a, b in rows], "text string, doc_id long, ids string").repartition(5)
    idcodec.write_ids(docs, str(tmp_path / "ids"), VOCABULARY, 2)
    found = idcodec.read_ids(spark, str(tmp_path / "ids")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) for r in found] == expected(rows, 2)
    index = idcodec.read_index(spark, str(tmp_path / "ids")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.ids_crc32) for r in index] == [(r.doc_id, r.ids_crc32) for r in found]


def test_null_and_repeated_ids_and_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a"), (3, "b"), (3, "b"), (None, None)], "doc_id long, text string")
    idcodec.write_ids(docs, str(tmp_path / "odd"), VOCABULARY, 2)
    found = idcodec.read_ids(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, 3, 3] and sum(r.n_tokens for r in found) == 7
    idcodec.write_ids(docs.limit(0), str(tmp_path / "none"), VOCABULARY, 2)
    assert idcodec.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_blocks_are_decoded_in_any_company():
    random = np.random.default_rng(3)
    blocks = [random.zipf(1.2, n).clip(0, 30000).astype(np.uint32) for n in (1, 4096, 700, 2, 130, 4096, 129)]
    coded = [idcodec.encode_blocks([b])[0] for b in blocks]
    for some in ([0, 1], [1, 2, 3], list(range(7)), [6, 5, 4]):
        assert [x.tolist() for x in idcodec.decode_blocks([coded[i] for i in some])] == [blocks[i].tolist() for i in some]


def test_plain_words_are_asked_without_the_splits_of_the_library():
    with open(VOCABULARY) as f:
        encoder = idcodec._Encoder(f.read())
    library, asked = encoder.library, []

    class Counting:
        def encode_batch_fast(self, strings, **options):
            asked.extend(strings)
            return library.encode_batch_fast(strings, **options)

    encoder.library = Counting()
    texts = ["Größe, ÉTÉ! don't x<|endoftext|>y été 12 $$$", "", " a\x1cb c\x85 ", "word(s) 'll Straße## µ ª İstanbul ΑΣ", "Größe; éTé?! DON'T"]
    flat, sizes = encoder.ids(pa.array(texts))
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    encoder.words, encoder.pieces = None, idcodec._Memory()
    assert encoder.ids(pa.array(texts))[0].tolist() == flat.tolist()
    asked = asked[: asked.index("Größe,")]
    assert not {"größe", "été", "Größe,", "ÉTÉ!", "straße"} & set(asked) and len(asked) == len(set(asked))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aZé ÀßÿŸ'<|>.,!$_-9́ \x1c\x85ſıK", max_size=30), min_size=1, max_size=5))
def test_ids_are_the_librarys(texts):
    flat, sizes = ENCODER.ids(pa.array(texts))
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [ENCODER.library.encode(t, add_special_tokens=False).ids for t in texts]
