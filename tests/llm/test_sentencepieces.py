from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from faultline.llm import sentencepieces as SP
from faultline.llm.memory import WordMemory
from faultline.llm.queries import piece_model_path

ODD = ["a", "b", " ", "  ", "▁", "é", "ü", "\n", "1", "23", "the", " the", "ing", "🙂", "́", "中", "\t", "xxxxx", "<s>", "</s>",
       "<0x41>", "Ω", "ß", "\x00", " ", "def ", "return", "    ", " ", "ﬁ", "Å", "�"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


@pytest.fixture(scope="module")
def model():
    return SP.PieceModel(piece_model_path())


def odd_text(r, n):
    return "".join(r.choice(ODD) for _ in range(r.randrange(n)))


def test_ids_and_text_are_the_librarys(spark, edge_docs, edge_rows, library, no_docs):
    got = SP.encode(edge_docs.repartition(3), piece_model_path()).collect()
    want = [(i, library.encode(t or "")) for i, t, _, _ in edge_rows]
    assert sorted([(str(g["doc_id"]), g["ids"], g["decoded"]) for g in got]) == sorted((str(i), x, library.decode(x)) for i, x in want)
    assert all(len(g["begins"]) == len(g["ends"]) == len(g["ids"]) for g in got)
    assert SP.encode(no_docs, piece_model_path()).count() == 0


def test_odd_texts(model, library):
    r = random.Random(1)
    for _ in range(3000):
        t = odd_text(r, 30)
        ids = model.encode([t.encode()])[0][0].tolist()
        assert ids == library.encode(t) and model.decode(ids) == library.decode(ids), t


def test_any_ids_decode_like_the_library(model, library):
    r = random.Random(2)
    for _ in range(3000):
        ids = [r.randrange(270 if r.random() < 0.5 else 32000) for _ in range(r.randrange(9))]
        assert model.decode(ids) == library.decode(ids), ids


def test_spans_are_the_librarys(model, library):
    """In bytes; the last byte piece of an unknown character carries its span."""
    r = random.Random(3)
    for _ in range(500):
        t = odd_text(r, 20)
        _, begins, ends = model.encode([t.encode()])[0]
        want = library.encode(t, return_type="proto").pieces
        assert [(int(b), int(e)) for b, e in zip(begins, ends)] == [(p.begin, p.end) for p in want], t
        assert begins[1:].tolist() == ends[:-1].tolist() and (not t or (begins[0], ends[-1]) == (0, len(t.encode())))


def test_long_and_short_segments_merge_alike(model):
    r = random.Random(4)
    for _ in range(300):
        t = "▁" + "".join(r.choice("etaoinshr") for _ in range(r.randrange(1, SP.SHORT)))
        assert model.merge(t) == model._merge_long(t)
    assert "".join(model.merge("ab" * 5000)) == "ab" * 5000


@pytest.mark.parametrize("remove_extra", [False, True])
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_normalising_by_a_compiled_map_keeps_offsets(rule, remove_extra):
    """Ligatures, full-width letters, marks that combine and characters that vanish, against the library."""
    theirs = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=remove_extra, escape_whitespaces=True
    )
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(theirs.serialized_model_proto())
    own = SP.Normalizer(proto.normalizer_spec.precompiled_charsmap, True, remove_extra)
    r = random.Random(5)
    for _ in range(400):
        t = "".join(r.choice([*ODD, "Ａ", "①", "㍿", "é", "​", "　", "İ", "Σ", "ﷺ"]) for _ in range(r.randrange(12)))
        text, starts = own(t.encode())
        want, offsets = theirs.normalize(t, with_offsets=True)
        at = np.cumsum([0] + [len(c.encode()) for c in t])
        assert text == want, t
        assert starts.tolist() == [int(at[o]) for o in offsets][: len(starts)], t


def test_bytes_that_are_no_text_count_one_by_one():
    text, starts = SP.characters(b"a\xff\xe4\xb8b\xe4\xb8\xad\x80")
    assert text == "a���b中�" and starts.tolist() == [0, 1, 2, 3, 4, 5, 8, 9]


def test_memory_keeps_frequent_words_and_stays_bounded():
    asked = []

    def encode(words):
        asked.extend(words)
        return [np.array([len(w) for w in words for _ in w], np.int32)], np.array([len(w) for w in words], np.int32)

    memory = WordMemory(encode, 1, max_words=20)
    r = random.Random(6)
    for _ in range(50):
        texts = [["often", "x" * r.randrange(9), f"w{r.randrange(10**6)}"] for _ in range(5)]
        for words, (column,) in zip(texts, memory(texts)):
            assert column.tolist() == [len(w) for w in words for _ in w]
        assert len(memory.numbers) <= 20 + 15
    assert asked.count("often") == 1


def test_query_digests(spark, library, tmp_path, edge_docs, edge_rows):
    from faultline.llm.queries import op12_sentencepiece

    edge_docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(g) for g in op12_sentencepiece(spark, str(tmp_path)).collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t, _, _ in edge_rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), len((t or "").encode())))
    assert sorted(map(str, got)) == sorted(map(str, want))
