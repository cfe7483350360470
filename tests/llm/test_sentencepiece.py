import random
from pathlib import Path

import pytest
import sentencepiece

from llm_support import docs_of  # noqa: F401
from tidemark.llm import sentencepiece_fst as op

pytestmark = pytest.mark.skipif(not Path(op.DEFAULT_MODEL).exists(), reason="the public vocabulary is not here")


@pytest.fixture(scope="module")
def both():
    content = Path(op.DEFAULT_MODEL).read_bytes()
    return op.Transducer(op.read_model(content)), sentencepiece.SentencePieceProcessor(model_proto=content)


ODD = ["", " ", "  ", "a", " a  b\n", "\n\n \t x", "▁a ▁", "<s>hi</s> <unk> <0x41>", "ﬁ①Ａ\u3000中文字", "é\u0301 \x00 🎉👩‍👩‍👧", "aaaaaaaaaaaaaaaaaaaaa", "ababababab", "======----====", "http://a.b/c?d=e&f=1234567890", "x" * 3000, "Straße ÀÉÎ ñandú"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_equal_the_library(both, text):
    assert both[0].encode(text).tolist() == both[1].encode(text)
    assert both[0].decode(both[1].encode(text)) == both[1].decode(both[1].encode(text))


def test_runs_of_spaces(both):
    for n in range(1, 70):
        for text in (" " * n, " " * n + "the", "a" + " " * n + "b"):
            assert both[0].encode(text).tolist() == both[1].encode(text), n


def test_random_texts_equal_the_library(both):
    rnd = random.Random(3)
    vocabulary = [p.replace("▁", " ") for p in both[0].vocabulary.pieces]
    for _ in range(400):
        text = "".join(rnd.choices(vocabulary, k=rnd.randint(1, 40)))
        if rnd.random() < 0.3:
            text = "".join(rnd.choices("abcdeéth \nñ0123.,", k=80))
        assert both[0].encode(text).tolist() == both[1].encode(text)
        assert both[0].decode(both[0].encode(text)) == text.replace("▁", " ")


def test_columns(spark, docs_of, both):
    rows = [(None, "hello there"), (1, None), (2, ""), (3, "same"), (3, "same"), (4, "long text " * 20_000), (5, "a▁b")]
    df = op.encode(docs_of(rows).withColumnRenamed("anchor", "ids")).withColumn("back", op.decode(spark, "ids"))
    for r in df.collect():
        text = r.text or ""
        assert list(r.ids) == both[1].encode(text) and r.back == text.replace("▁", " ") and r.round_trip == ("▁" not in text)
        assert r.component_id == "y"
    assert op.encode(docs_of([])).count() == 0


def test_remembered_words_are_bounded(both, monkeypatch):
    monkeypatch.setattr(op, "WORDS", 10)
    monkeypatch.setattr(op, "PAIRS", 10)
    machine = op.Transducer(both[0].vocabulary)
    text = " ".join(f"word{k % 37}x" for k in range(400))
    assert machine.encode(text).tolist() == both[1].encode(text)
    assert len(machine.paths) <= 10 and len(machine.older) <= 10 and len(machine.stable) <= 11


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    with open(op.DEFAULT_MODEL, "rb") as f:
        content = f.read()
    op.check_supported(content)
    for change in (
        lambda m: setattr(m.trainer_spec, "model_type", m.trainer_spec.UNIGRAM),
        lambda m: setattr(m.normalizer_spec, "precompiled_charsmap", b"nfkc"),
        lambda m: setattr(m.normalizer_spec, "remove_extra_whitespaces", True),
        lambda m: setattr(m.normalizer_spec, "add_dummy_prefix", False),
    ):
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(content)
        change(model)
        with pytest.raises(ValueError):
            op.read_model(model.SerializeToString())
