"""Text and similarity functions against plain restatements."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from corvane.functions import similarity, text

WORDS = ["Alpha", "alpha", "Ltd", "Company", "कंपनी", "राम", "Ünïcode", "straße", "ＦＵＬＬ", "a1", "x", "Zhejiang", "Zejgang", "Ashcraft", "Tymczak", "O'Neil", "№5", "née", "  ", "\t", "", "-", "12-34", "LLC", "Services", "ﬁne", "ªº"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return [None, "", "   "] + [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 6))) for _ in range(150)]


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


def column(frame, expression):
    return [r["x"] for r in frame.select("i", expression.alias("x")).orderBy("i").collect()]


def test_normalize(frame, texts):
    def plain(t):
        t = unicodedata.normalize("NFKC", t or "").casefold()
        return " ".join("".join(" " if unicodedata.category(c)[0] in "PS" or c.isspace() else c for c in t).split())

    assert column(frame, text.normalize_text("t")) == [plain(t) for t in texts]


def test_fingerprint(frame, texts):
    want = ["".join(c for c in t or "" if unicodedata.category(c)[0] in "LMN") for t in texts]
    assert column(frame, text.fingerprint_text("t")) == want


def plain_tokens(t, least):
    return [w for w in re.findall(r"[^\W_]+", (t or "").strip()) if len(w) >= least]


def by_length(words):
    return sorted(set(words), key=lambda w: (-len(w), w))


def test_tokens_and_signatures(frame, texts):
    assert column(frame, text.tokens("t", 2)) == [plain_tokens(t, 2) for t in texts]
    assert column(frame, text.token_signatures("t")) == [by_length(plain_tokens(t, 3))[:3] for t in texts]
    assert column(frame, text.token_signature("t")) == [(by_length(plain_tokens(t, 3)) or [""])[0] for t in texts]
    assert column(frame, text.prefix_signature("t")) == [(by_length(plain_tokens(t, 3)) or [""])[0][:4] for t in texts]
    pair = [by_length([w for w in plain_tokens(t, 2) if w.lower() not in text.STOPWORDS])[:2] for t in texts]
    assert column(frame, text.token_pair_signature("t")) == ["\x1e".join(sorted(p)) if len(p) == 2 else "" for p in pair]


def plain_soundex(word):
    codes = {c: d for d, group in {"1": "BFPV", "2": "CGJKQSXZ", "3": "DT", "4": "L", "5": "MN", "6": "R"}.items() for c in group}
    letters = [c for c in word.upper() if "A" <= c <= "Z"]
    if not letters:
        return ""
    out, last = letters[0], codes.get(letters[0], "0")
    for c in letters[1:]:
        code = codes.get(c, "0")
        if code != last and code != "0":
            out += code
        last = code
    return (out + "000")[:4]


def test_soundex(spark):
    words = ["Ashcraft", "Tymczak", "Zhejiang", "Zejgang", "Services", "Seraices", "Clean", "", "कंपनी", "Pfister", "a", "llama"]
    df = spark.createDataFrame(list(enumerate(words)), "i int, t string")
    got = column(df, text.soundex("t"))
    assert got == [plain_soundex(w) for w in words]
    assert got[0] == "A226" and got[2] == got[3] == "Z252"


def test_recovery_forms(frame, texts):
    def plain(t):
        t = unicodedata.normalize("NFKD", (t or "").strip().lower())
        t = "".join(c for c in t if not unicodedata.combining(c))
        return re.sub("[^a-z0-9]+", " ", t).strip()

    assert column(frame, text.recovery_normalize("t")) == [plain(t) for t in texts]
    ascii_form = [re.sub("[^a-z0-9]+", " ", unicodedata.normalize("NFKD", t or "").encode("ascii", "ignore").decode().lower()).strip() for t in texts]
    assert column(frame, text.ascii_encode_normalize("t")) == ascii_form
    assert [sorted(x) for x in column(frame, text.char_ngrams("t"))] == [
        sorted({s} if s and len(s) < 3 else {s[i : i + 3] for i in range(len(s) - 2)}) for s in ((t or "").replace(" ", "") for t in texts)
    ]


def test_match_ids(spark):
    df = spark.createDataFrame([(0, " S2-10 ,S3-7,,S2-10"), (1, None), (2, "")], "i int, t string")
    assert column(df, text.match_ids("t")) == [["S2-10", "S3-7", "S2-10"], [], []]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_ratio(spark):
    rng = random.Random(9)
    pairs = [("", "a"), (None, None), ("abc", "abc"), ("कंपनी", "कंपन")] + [("".join(rng.choices("abcé ", k=rng.randint(0, 12))), "".join(rng.choices("abcé ", k=rng.randint(0, 12)))) for _ in range(60)]
    want = [2 * plain_lcs(a, b) / (len(a) + len(b)) if a and b else 0.0 for a, b in pairs]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    assert column(df, similarity.ratio("a", "b")) == pytest.approx(want)
    assert column(df, similarity.ratio_expression("a", "b")) == pytest.approx(want)


@pytest.mark.parametrize(
    ("a", "b", "score"),
    [("a b c", "c b a", 1.0), ("fuzzy was a bear", "fuzzy fuzzy was a bear", 1.0), ("alpha beta", "alpha gamma", 1 - 5 / 15), ("abc", "abd", 2 / 3), ("", "x", 0.0), ("x y", "x y z", 1.0)],
)
def test_set_ratio(a, b, score):
    assert similarity.set_ratio(a, b) == pytest.approx(score)


def test_other_measures(spark):
    df = spark.createDataFrame([(0, "alpha beta 12", "beta gamma 12 34"), (1, "", "x"), (2, None, None)], "i int, a string, b string")
    assert column(df, similarity.token_jaccard("a", "b")) == pytest.approx([2 / 5, 0, 0])
    assert column(df, similarity.token_containment("a", "b")) == pytest.approx([2 / 3, 0, 0])
    assert column(df, similarity.number_overlap("a", "b")) == pytest.approx([1 / 2, 0, 0])
    assert column(df, similarity.length_difference("a", "b")) == [3, 1, 0]
    assert column(df, similarity.token_overlap("a", "b")) == [2, 0, 0]
    assert column(df, similarity.token_sort_ratio("a", "b"))[1] == 0.0
    assert similarity.weighted_ratio("alpha beta", "beta alpha") == pytest.approx(0.95)
    assert similarity.partial_ratio("beta", "alpha beta gamma") == 1.0


def test_batched_edit_measures_equal_single_ones():
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdé \U0001f600", k=rng.choice([0, 1, 5, 20, 63, 64, 65, 130])))
    pairs = [(word(), word()) for _ in range(400)] + [("a b", "a b"), ("", "x"), ("x" * 64, "x" * 64)]
    assert similarity.common_subsequences(pairs).tolist() == [similarity.common_subsequence(a, b) for a, b in pairs]
    assert similarity.indel_ratios(pairs).tolist() == [similarity.indel_ratio(a, b) for a, b in pairs]
    assert similarity.indel_ratios([]).tolist() == []


def test_common_subsequence_equals_the_table():
    import random

    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rng = random.Random(4)
    pairs = [("".join(rng.choices("abc", k=rng.randint(0, 70))), "".join(rng.choices("abc", k=rng.randint(0, 70)))) for _ in range(60)]
    assert similarity.common_subsequences(pairs).tolist() == [table(a, b) for a, b in pairs]
