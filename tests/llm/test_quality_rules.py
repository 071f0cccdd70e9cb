"""Quality measures and verdict against a plain restatement."""

import random

import pytest

from corvane.llm import quality_rules as q
from tests.llm import plain


def make_texts():
    rng = random.Random(5)
    out = [None, "", " \n\t", "one", "a b c", "é ß " * 40, "#$% " * 60, "x" * 5000, "word " * 30000, "a\x0bb\x0cc\x1cd e", "\n".join(["the same line here"] * 20), "l\n l\nl \nl"]
    for _ in range(120):
        v = [f"w{i}" for i in range(rng.choice([3, 30, 400]))] + ["naïve", "&", "|x|"]
        lines = [" ".join(rng.choice(v) for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 12))]
        lines += [rng.choice(lines) for _ in range(rng.randint(0, 4))]
        out.append("\n".join(lines))
    return out


def test_equals_brute_force(spark):
    texts = make_texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    got = {r["doc_id"]: r for r in q.quality_rules(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, chars, symbols, dup, repeat, base, kept, cover = plain.quality(t, q.NGRAM_LIMITS)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat), i
        assert (r["base_failed"], r["kept"]) == (base, kept), i
        assert {k: r[f"dup_chars_{k}"] for k in q.NGRAM_LIMITS} == cover, i


def test_keeps_text_and_repeated_rows(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, None)], "doc_id long, text string")
    out = q.quality_rules(docs, keep_text=True).collect()
    assert [r["kept"] for r in out] == [True, True, True, False] and [r["text"] for r in out] == [text, text, text, None]


@pytest.mark.parametrize("schema", ["doc_id long, text string"])
def test_empty_table(spark, schema):
    assert q.quality_rules(spark.createDataFrame([], schema)).count() == 0
