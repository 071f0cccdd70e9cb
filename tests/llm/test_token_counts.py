"""Token counts against the tokenizers library."""

import random

import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from corvane.llm import token_counts as tc  # noqa: E402

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def whole():
    return tc.WholeTokens.load(PATH)


def test_proven_strings_are_one_token(library, whole):
    sample = random.Random(1).sample(sorted(whole.whole), 3000)
    alone = [s for s in sample if len(library.pre_tokenizer.pre_tokenize_str(s)) == 1]
    assert len(alone) > 2000
    assert all(len(e.ids) == 1 for e in library.encode_batch(alone, add_special_tokens=False))
    assert 45_000 < len(whole.whole) < 50_257


def test_random_texts(library, whole):
    rng = random.Random(2)
    parts = [*"abcdeTHE  \t\n\r\x1c\x85\xa0 　'sé日本語12٣!?<|>_-’\U0001f600́", "<|endoftext|>", "'ll", "  ", "the ", " of", "ing", "<|endof"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 80))) for _ in range(4000)]
    count = whole.counter()
    assert [count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("text", ["ab" * 3000, "x" * 1000, "é" * 700, "<|endoftext|>" * 5, "a<|endoftext|>b ", "qzj" * 200])
def test_long_pre_tokens(library, whole, text):
    assert whole.counter()(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_rows(spark, library):
    long = "many words here, " * 40000
    rows = [(1, "Hello world", "x"), (1, "Hello world", "x"), (2, None, "y"), (None, "", None), (3, long, "z")]
    out = tc.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), PATH).collect()
    assert [(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out[:4]] == [(11, 2, False), (11, 2, False), (0, 0, False), (0, 0, False)]
    assert out[4]["n_tokens"] == len(library.encode(long, add_special_tokens=False).ids) and out[4]["over_limit"]
    assert tc.token_counts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"model": {"ignore_merges": True}}, {"added_tokens": [{"content": "x", "lstrip": True}]}])
def test_settings_that_are_not_followed_raise(change):
    plain = {"model": {"ignore_merges": False}, "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}, "added_tokens": [{"content": "x"}]}
    tc.check_definition(plain)
    with pytest.raises(ValueError):
        tc.check_definition(plain | change)
