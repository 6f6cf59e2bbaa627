import json

import numpy as np
import pytest

from pricelane.llm import bpe_reuse
from test_llm_helpers import ODD, docs

TEXTS = [
    "", " ", "a", "<|endoftext|>", "a<|endoftext|> b <|endoftext", " \n \n x" * 700, "a" * 30000, "　x y " * 900,
    "éà " * 3000 + "🙂" * 50, "x  \n\n  y 's 'll  " * 500, "\x1c a\x85b \xa0" * 400, "1234 5678  " * 500 + " " * 2000 + "end",
]


@pytest.fixture(scope="module")
def codec():
    return bpe_reuse.Codec(bpe_reuse.default_tokenizer())


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_ids_and_texts_are_the_librarys(codec, text):
    ids = codec.library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == ids
    assert codec.decode(ids) == codec.library.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("setting", [{"add_prefix_space": True}, {"use_regex": False}])
def test_other_splits_are_refused(tmp_path, setting):
    said = json.loads(open(bpe_reuse.default_tokenizer(), encoding="utf-8").read())
    said["pre_tokenizer"].update(setting)
    (tmp_path / "other.json").write_text(json.dumps(said), encoding="utf-8")
    with pytest.raises(ValueError):
        bpe_reuse.Codec(str(tmp_path / "other.json"))


def test_random_texts(codec):
    rng = np.random.default_rng(3)
    words = np.array(["the", " ", "  ", "\n", "naïve", "42", "'s", "!", "ß", "un", "re"])
    for _ in range(60):
        text = "".join(rng.choice(words, rng.integers(1, 4000)))
        assert codec.encode(text) == codec.library.encode(text, add_special_tokens=False).ids


def test_shared_passages_give_shared_chunks(codec):
    rng = np.random.default_rng(5)
    def prose(n):
        return " ".join("".join(rng.choice(list("abcdefg"), 5)) for _ in range(n))
    shared = prose(3000)
    first, second = bpe_reuse.cut_text(prose(500) + " " + shared), bpe_reuse.cut_text(prose(700) + " " + shared)
    assert len(set(first) & set(second)) >= len(first) // 2
    codec.encode(shared)
    before = codec.encoded
    codec.encode(shared)
    assert codec.encoded == before


def test_operator_on_odd_rows(spark):
    rows = docs(spark, ODD)
    back = bpe_reuse.decode_documents(bpe_reuse.encode_documents(rows)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(k), t or "") for k, t in ODD)
    assert bpe_reuse.encode_documents(rows.limit(0)).count() == 0
