"""The pipeline's stages against a plain composition, and the registry without the corpus operators."""

import random
import shutil
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from corvane.llm import quality_rules, suffix_dedup
from tests.llm import plain
from tests.llm.test_mixing import plain_targets

ROOT = Path(__file__).resolve().parents[2]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def made():
    rng = random.Random(9)
    item, passage = prose(rng, 30), prose(rng, 70)
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(30)]
    texts += [texts[0], texts[1] + " more", texts[2].replace(" ", "  ", 1)]  # copies
    texts += [f"{prose(rng, 60)} {passage} {prose(rng, 60)}" for _ in range(3)]  # a shared passage
    texts += [f"{prose(rng, 40)} {item} {prose(rng, 40)}", "too short", None, "spam " * 200, prose(rng, 70) + " #|$" * 30]
    docs = [(i, t, "en", rng.choice(["a", "b", None]), len(t) if t else 0) for i, t in enumerate(texts)]
    docs.append(docs[5])  # a repeated row
    docs.append((None, prose(rng, 80), None, None, None))
    return docs, [(1, item)], passage


@pytest.fixture(scope="module")
def stages(spark, made, tmp_path_factory):
    """What each stage returns, written and reread."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs, items, _ = made
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out, at = [], spark.read.parquet(f"{folder}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(folder)).write.parquet(f"{folder}/{i}")
        at = spark.read.parquet(f"{folder}/{i}")
        out.append(at)
    return str(folder), out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_shapes(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "decontamination", "mixing"]
    for df in stages[1][:4]:
        assert df.columns == corpus_pipeline.COLUMNS


def test_quality_stage(stages, made):
    want = [d for d in made[0] if plain.quality(d[1], quality_rules.NGRAM_LIMITS)[6]]
    assert rows(stages[1][0]) == sorted(want, key=repr) and len(want) == len(made[0]) - 4


def test_near_duplicate_stage(stages):
    before = [tuple(r) for r in stages[1][0].collect()]
    groups = plain.jaccard_components([r[1] for r in before], list(range(len(before))))
    best = {}
    for i, r in enumerate(before):
        key = (r[0] is None, r[0] or 0)
        best[groups[i]] = min(best.get(groups[i], (key, r)), (key, r), key=lambda x: x[0])
    after = rows(stages[1][1])
    assert after == sorted((r for _, r in best.values()), key=repr) and len(after) < len(before)


def test_repeat_stage(stages, made):
    before, after = {r["doc_id"]: r for r in stages[1][1].collect()}, {r["doc_id"]: r for r in stages[1][2].collect()}
    assert before.keys() == after.keys()
    length, first = suffix_dedup.LENGTH, {}
    order = sorted(before, key=lambda i: (i is None, i or 0))
    for i in order:
        t = before[i]["text"].encode()
        for p in range(len(t) - length + 1):
            first.setdefault(t[p : p + length], i)
    shortened = 0
    for i in order:
        t = before[i]["text"]
        gone = np.zeros(len(t.encode()), bool)
        for p in range(len(t.encode()) - length + 1):
            if first[t.encode()[p : p + length]] != i:
                gone[p : p + length] = True
        at, kept = 0, ""
        for c in t:
            size = len(c.encode())
            kept += "" if gone[at : at + size].all() else c
            at += size
        assert after[i]["text"] == kept and after[i]["n_chars"] == (len(kept) if kept != t else before[i]["n_chars"])
        shortened += kept != t
    assert shortened == 2 and sum(made[2][60:-60] in r["text"] for r in after.values()) == 1


def test_decontamination_stage(stages, made):
    before = [tuple(r) for r in stages[1][2].collect()]
    bad = [i for i, r in enumerate(plain.contamination([(d[0], d[1]) for d in before], made[1])) if r[5]]
    assert rows(stages[1][3]) == sorted((d for i, d in enumerate(before) if i not in bad), key=repr) and len(bad) == 1


def test_mixing_stage_and_run(spark, stages):
    before = [tuple(r) for r in stages[1][3].collect()]
    sizes = {}
    for r in before:
        sizes[r[3]] = sizes.get(r[3], 0) + len(plain.split(r[1]))
    targets = plain_targets(sizes)
    source = {r[0]: r[3] for r in before}
    mixed = stages[1][4].collect()
    assert len(mixed) == len(before)
    for r in mixed:
        assert r["target"] == pytest.approx(targets[source[r["doc_id"]]]) and r["taken"] == r["size"] * r["repeats"] and r["repeats"] in (0, 1, 2)
    assert rows(corpus_pipeline.run(spark, stages[0])) == rows(stages[1][4])


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    shutil.copytree(ROOT / "corvane", tmp_path / "corvane", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'candidates' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
