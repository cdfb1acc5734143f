import zlib

import numpy as np
import public_tokenizers
from flowlens.llm.packing import WordTokens, curve_keys, hilbert, pack_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from .data import awkward, empty

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
MODEL = WordTokens(PATH, True)


def whole_ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def check_pieces(rows, want, size):
    """Every document's ids once, gapless sequences, full or a power of two."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert sorted(docs, key=repr) == sorted(want, key=repr)
    for i, pieces in docs.items():
        pieces.sort(key=lambda r: (r.start, r.sequence_id))
        ids = [x for p in pieces for x in p.ids]
        copies = len(ids) // len(want[i])
        if copies == 1:
            assert ids == want[i] and [p.start for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1].tolist()]
        for p in pieces:
            assert p.ids == want[i][p.start : p.start + p.length] and p.doc_tokens == len(want[i])
            assert p.ids_crc32 == zlib.crc32(np.array(p.ids, dtype="<u4").tobytes())
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        total = sum(p.length for p in pieces)
        assert [p.offset for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1].tolist()]
        assert total <= size and total & (total - 1) == 0


def test_round_trip(spark):
    docs = awkward(spark, "key string, ids int, n int", ("k", 1, 2))
    want = {r.doc_id: whole_ids(r.text) + [1] for r in docs.collect() if r.doc_id is not None}
    check_pieces(pack_documents(docs.filter("doc_id IS NOT NULL")).collect(), want, 2048)
    assert pack_documents(docs).agg({"length": "sum"}).first()[0] == sum(len(whole_ids(r.text)) + 1 for r in docs.collect())


def test_empty_table(spark):
    assert pack_documents(empty(spark)).count() == 0


PARTS = ["Don't", "it's", "e.g.", "...", "İ", "ß", "ﬁ", "é", "Σας", "日本語", "<|endoftext|>", "<|ENDOFTEXT|>", "a,b", "x.", "é.", "🙂", "１２", " ", " ", "\x1c", "12.5%", "'S", "Å"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=6), st.sampled_from([" ", "\n", "\t", "\x0b"])), max_size=20))
def test_word_by_word_is_the_whole_text(parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    assert np.frombuffer(MODEL.ids([text])[0], dtype=MODEL.kind).tolist() == whole_ids(text)


def test_hilbert_is_a_curve():
    """Every point once; neighbours on the curve are neighbours in space."""
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        keys = hilbert(points, bits)
        assert sorted(keys.tolist()) == list(range(len(points)))
        path = points[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_equal_documents_have_equal_keys():
    a, b = np.array([5, 9, 9], dtype=np.uint16), np.array([9, 5, 9], dtype=np.uint16)
    keys = curve_keys([a, b, a, np.array([7], dtype=np.uint16)], 4, 12, 1024)
    assert keys[0] == keys[1] == keys[2]
