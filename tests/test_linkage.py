"""Blocking, features, decisions, output and workflows on small fixtures."""

import pytest
from pyspark.sql import functions as F

from corvane.operators import blocking, contracts, decisions, evaluation, matcher, recovery
from corvane.operators.blocking import BlockingConfig
from corvane.operators.features import FEATURE_COLUMNS, FeatureEngineer, get_feature_columns
from corvane.plans import linkage
from corvane.sources import tsv

SOURCE = "entity_id string, business_name string, business_address string, country string"
CANDIDATE = "source1_entity_id string, candidate_entity_id string, candidate_source string, blocker_sources string, num_blockers long"


def source(spark, *rows):
    return spark.createDataFrame(list(rows), SOURCE)


@pytest.fixture(scope="module")
def sources(spark):
    s1 = source(spark, ("S1_1", "alpha", "addr1", "india"), ("S1_2", "beta", "addr2", "india"), ("S1_3", "gamma", "addr3", "usa"), ("S1_4", "no_match", "addr4", "france"))
    s2 = source(spark, ("S2_1", "alpha", "different1", "india"), ("S2_2", "different", "addr2", "india"), ("S2_3", "gamma", "addr3", "usa"), ("S2_4", "irrelevant", "different4", "france"))
    s3 = source(spark, ("S3_1", "something", "something_else", "india"), ("S3_2", "gamma", "addr3", "usa"), ("S3_3", "another", "another_address", "france"))
    return [blocking.prepare(s) for s in (s1, s2, s3)]


def test_four_blockers(sources):
    out = blocking.generate_candidate_pairs(*sources, BlockingConfig.exact_only())
    got = {(r["source1_entity_id"], r["candidate_entity_id"]): r for r in out.collect()}
    assert set(got) == {("S1_1", "S2_1"), ("S1_2", "S2_2"), ("S1_3", "S2_3"), ("S1_3", "S3_2")}
    assert got["S1_3", "S2_3"]["blocker_sources"] == "address_country,address_exact,name_country,name_exact"
    assert got["S1_3", "S2_3"]["num_blockers"] == 4
    contracts.validate_candidate_pairs(out)
    contracts.validate_candidate_ids(out, *sources)


def test_caps_drop_the_whole_key_per_source(spark):
    s1 = blocking.prepare(source(spark, ("S1-1", "Same Name", "", "x")))
    s2 = blocking.prepare(source(spark, *[(f"S2-{i}", "Same Name", "", "x") for i in range(3)]))
    s3 = blocking.prepare(source(spark, *[(f"S3-{i}", "Same Name", "", "x") for i in range(2)]))
    name = lambda cap: BlockingConfig(max_exact_key_frequency=cap).only("name_exact")
    sizes = [blocking.generate_candidate_pairs(s1, s2, s3, name(cap)).count() for cap in (1, 2, 3, 0)]
    assert sizes == [0, 2, 5, 5]  # zero: no limit
    signature = lambda b, cap: blocking.generate_candidate_pairs(s1, s2, s3, BlockingConfig(max_signature_frequency=cap).only(b)).count()
    assert [signature("name_token_country", c) for c in (0, 2, 3)] == [0, 2, 5]
    one = blocking.prepare(source(spark, ("S2-9", "Same Name", "", "x")))
    assert blocking.generate_candidates_for_target(s1, one, "S2", BlockingConfig(max_signature_frequency=0).only("name_token")).count() == 1
    assert blocking.run_single_key_block(s1, s2, "S2", "name_fingerprint", "name_exact", 2).count() == 0
    assert blocking.run_composite_block(s1, s2, "S2", "name_fingerprint", "country_fingerprint", "name_country", 3).count() == 3


def test_empty_keys(spark):
    s1 = blocking.prepare(source(spark, ("S1-1", "Alpha Beta", None, None), ("S1-2", None, "", "")))
    s2 = blocking.prepare(source(spark, ("S2-1", "Alpha Beta", "", ""), ("S2-2", "", None, "")))
    out = blocking.generate_candidates_for_target(s1, s2, "S2")
    (row,) = out.collect()
    assert (row["source1_entity_id"], row["candidate_entity_id"]) == ("S1-1", "S2-1")
    assert row["blocker_sources"] == "name_exact,name_prefix_country,name_soundex_country,name_token,name_token_country,name_token_pair_country"


def test_fusion(spark):
    rows = [("S1-1", "S2-1", "S2", "name_exact", 1), ("S1-1", "S2-1", "S2", "address_exact,name_exact", 2), ("S1-1", "S2-1", "S3", "name_token", 1)]
    out = blocking.fuse_candidate_pairs([spark.createDataFrame(rows[:1], CANDIDATE), spark.createDataFrame(rows[1:], CANDIDATE)])
    got = {r["candidate_source"]: (r["blocker_sources"], r["num_blockers"]) for r in blocking.fuse_candidate_pairs(out).collect()}
    assert got == {"S2": ("address_exact,name_exact", 2), "S3": ("name_token", 1)}
    for bad in ("", "nobody"):
        with pytest.raises(ValueError):
            blocking.fuse_candidate_pairs([spark.createDataFrame([("a", "b", "S2", bad, 1)], CANDIDATE)])


@pytest.mark.parametrize("change", [{"candidate_source": "S9"}, {"source1_entity_id": " "}, {"num_blockers": 0}, {"candidate_entity_id": None}])
def test_candidate_contract(spark, change):
    row = {"source1_entity_id": "S1-1", "candidate_entity_id": "S2-1", "candidate_source": "S2", "blocker_sources": "name_exact", "num_blockers": 1}
    contracts.validate_candidate_pairs(spark.createDataFrame([tuple(row.values())], CANDIDATE))
    with pytest.raises(ValueError):
        contracts.validate_candidate_pairs(spark.createDataFrame([tuple((row | change).values())], CANDIDATE))
    with pytest.raises(ValueError):
        contracts.validate_candidate_pairs(spark.createDataFrame([tuple(row.values())] * 2, CANDIDATE))


def test_features(spark):
    s1 = source(spark, ("S1-001", "ABC Electronics", "MG Road Bangalore", "India"), ("S1-002", "राम इलेक्ट्रॉनिक्स", "Delhi India", "India"), ("S1-003", "Paris Bakery", "12 Rue Paris", "France"), ("S1-004", "No Match Company", "Unknown Road", "India"))
    s2 = source(spark, ("S2-001", "ABC Electronics", "MG Road Bangalore", "India"), ("S2-002", "ABC Electronic", "MG Road Bengaluru", "India"), ("S2-003", "राम इलेक्ट्रॉनिक्स", None, "India"), ("S2-004", "Completely Different", "Different Road", "India"))
    s3 = source(spark, ("S3-001", "Paris Bakery", "12 Rue Paris", "France"), ("S3-002", "Paris Bakerie", None, "France"))
    pairs = spark.createDataFrame(
        [("S1-001", "S2-001", "S2", ["name_exact", "address_exact"], 2), ("S1-001", "S2-002", "S2", ["name_block"], 1), ("S1-002", "S2-003", "S2", ["name_exact"], 1), ("S1-003", "S3-001", "S3", ["name_exact", "country_exact"], 2), ("S1-004", "S2-004", "S2", ["country_block"], 1)],
        "source1_entity_id string, candidate_entity_id string, candidate_source string, blocker_sources array<string>, num_blockers long",
    )
    out = FeatureEngineer().transform(s1, s2, s3, pairs)
    assert out.columns == [*contracts.CANDIDATE_KEY, *FEATURE_COLUMNS] and len(get_feature_columns()) == 25
    got = {r["candidate_entity_id"]: r for r in out.collect()}
    assert len(got) == 5
    first = got["S2-001"]
    for c in ("name_exact", "address_exact", "country_exact", "was_name_block", "was_address_block", "multiple_independent_blockers", "name_ratio", "name_jaccard", "combined_name_address_score"):
        assert first[c] == 1.0, c
    assert first["num_blockers"] == 2.0
    third = got["S2-003"]
    assert (third["address_available_both"], third["address_missing_source2"], third["name_exact"], third["name_address_agreement"]) == (0, 1, 1, 0)
    assert third["combined_name_address_score"] == third["name_token_similarity"]
    assert got["S2-004"]["was_country_block"] == 1.0 and got["S3-001"]["country_exact"] == 1.0
    unknown = spark.createDataFrame([("S1-999", "S2-001", "S2", "name_exact", 1)], CANDIDATE)
    with pytest.raises(Exception, match="lacks"):
        FeatureEngineer().transform(s1, s2, s3, unknown).collect()


SCORED = "source1_entity_id string, candidate_entity_id string, candidate_source string, score double"


def decided(spark, rows, **kw):
    out = decisions.ConflictEngine(**kw).decide(spark.createDataFrame(rows, SCORED))
    return {r["source1_entity_id"]: r for r in out.collect()}


def test_decisions(spark):
    rows = [("A", "S2-101", "S2", 0.98), ("A", "S2-102", "S2", 0.96), ("A", "S3-201", "S3", 0.30), ("B", "S2-301", "S2", 0.95), ("B", "S3-302", "S3", 0.40), ("C", "S2-401", "S2", 0.49), ("D", "S3-501", "S3", 0.20)]
    got = decided(spark, rows, threshold=0.90)
    assert (got["A"]["candidate_count"], got["A"]["accepted_count"], got["A"]["matched_entity_ids"], got["A"]["has_conflict"]) == (3, 2, ["S2-101", "S2-102"], True)
    assert (got["B"]["accepted_count"], got["B"]["best_score"], got["B"]["second_best_score"], got["B"]["has_conflict"]) == (1, 0.95, 0.40, False)
    assert (got["C"]["accepted_count"], got["C"]["matched_entity_ids"], got["C"]["score_gap"]) == (0, [], 0.49)
    wide = decided(spark, [("A", "x", "S2", 0.99), ("A", "y", "S2", 0.70)], threshold=0.60)["A"]
    assert wide["accepted_count"] == 2 and not wide["has_conflict"] and wide["score_gap"] == pytest.approx(0.29)
    ties = decided(spark, [("A", i, "S2", 0.95) for i in ("S3-C", "S2-B", "S2-A")], threshold=0.9)["A"]
    assert ties["matched_entity_ids"] == ["S2-A", "S2-B", "S3-C"]
    assert decided(spark, [], threshold=0.5) == {}
    for bad in ([("A", "x", "S2", 1.5)], [("A", "x", "S2", float("nan"))], [(None, "x", "S2", 0.5)]):
        with pytest.raises(ValueError):
            decided(spark, bad, threshold=0.5)
    with pytest.raises(ValueError):
        decisions.ConflictEngine(1.5)


def test_output(spark, tmp_path):
    s1 = source(spark, *[(f"S1-{c}", "", "", "") for c in "ABCD"])
    pairs = spark.createDataFrame([("S1-A", "S2-101", "S2", "name_exact", 1), ("S1-A", "S3-201", "S3", "name_exact", 1), ("S1-B", "S2-301", "S2", "name_exact", 1), ("S1-B", "S3-302", "S3", "name_exact", 1), ("S1-C", "S2-401", "S2", "name_exact", 1)], CANDIDATE)
    chosen = spark.createDataFrame([("S1-A", "S2-101, S3-201,S2-999"), ("S1-B", "S2-301"), ("S1-C", ""), ("S1-D", None)], "source1_entity_id string, matched_entity_ids string")
    generator = decisions.OutputGenerator(str(tmp_path / "out"))
    paths = generator.generate(s1, pairs, chosen)
    results = {r["source1_entity_id"]: r["matched_entity_ids"] for r in tsv.read_tsv(spark, paths[0]).collect()}
    assert results == {"S1-A": "S2-101,S3-201", "S1-B": "S2-301", "S1-C": "", "S1-D": ""}
    assert tsv.load_candidate_pairs(spark, paths[1]).count() == 5
    with pytest.raises(ValueError):
        generator.generate(s1, pairs.withColumn("candidate_source", F.lit("S9")), chosen)
    best = {r[0]: r[1] for r in decisions.best_candidate(s1, pairs).collect()}
    assert best == {"S1-A": "S2-101", "S1-B": "S2-301", "S1-C": "S2-401", "S1-D": ""}
    wide = decisions.long_to_wide(s1, pairs)
    assert decisions.wide_to_long(wide).count() == 5


def test_sources(spark, tmp_path):
    root = tmp_path / "data" / "train"
    root.mkdir(parents=True)
    for i in (1, 2, 3):
        (root / f"train_source{i}.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS%d-1\tNA\t"quoted\t\nS%d-2\tnull\n' % (i, i), encoding="utf-8")
    s1, *_ = tsv.load_training_sources(spark, str(tmp_path / "data"))
    assert [tuple(r) for r in s1.orderBy("entity_id").collect()] == [("S1-1", "NA", '"quoted', ""), ("S1-2", "null", "", "")]
    with pytest.raises(FileNotFoundError):
        tsv.load_source(spark, str(tmp_path / "none.tsv"))
    twice = tmp_path / "twice.tsv"
    twice.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\na\t\t\t\na\t\t\t\n")
    with pytest.raises(ValueError):
        tsv.load_source(spark, str(twice))
    assert [r[0] for r in tsv.sample_rows(s1, 1).collect()] == [r[0] for r in tsv.sample_rows(s1, 1).collect()]


def test_ground_truth(spark, tmp_path):
    path = tmp_path / "gt.tsv"
    path.write_text("source1_entity_id\tmatched_entity_ids\nS1-A\tS2-1,S3-7\nS1-B\tS2-2\n\nS1-C\t\nS1-D\tS2-5,S2-5, S3-9\nS1-B\tS2-3\n")
    entities, pairs = tsv.parse_ground_truth(spark, str(path))
    assert sorted(r[0] for r in entities.collect()) == ["S1-A", "S1-B", "S1-C", "S1-D"]
    assert sorted(map(tuple, pairs.collect())) == [("S1-A", "S2-1"), ("S1-A", "S3-7"), ("S1-B", "S2-3"), ("S1-D", "S2-5"), ("S1-D", "S3-9")]
    for text in ("wrong\theader\n", "source1_entity_id\tmatched_entity_ids\nS1-A\n", "source1_entity_id\tmatched_entity_ids\n \tS2-1\n"):
        path.write_text(text)
        with pytest.raises(ValueError):
            tsv.parse_ground_truth(spark, str(path))
    wide = spark.createDataFrame([("S1-A", "S2-1;S3-2", "x,S2-4", None)], "source1_entity_id string, a string, b string, c string")
    assert sorted(r[1] for r in tsv.explode_ground_truth(wide).collect()) == ["S2-1", "S2-4", "S3-2"]


def test_training_and_inference(spark, tmp_path):
    rows = lambda p: [(f"{p}-{i}", f"Company number {i * 7919}", f"{i} Main Street", "x") for i in range(1, 11)]
    s1, s2, s3 = source(spark, *rows("S1")), source(spark, *rows("S2")), source(spark, *rows("S3"))
    pairs, truth = [], []
    for i in range(1, 11):
        pairs += [(f"S1-{i}", f"S2-{i}", "S2", "name_exact,address_exact", 2), (f"S1-{i}", f"S2-{i % 10 + 1}", "S2", "name_token", 1), (f"S1-{i}", f"S3-{i}", "S3", "name_exact,address_exact", 2), (f"S1-{i}", f"S3-{(i + 1) % 10 + 1}", "S3", "name_token", 1)]
        truth += [(f"S1-{i}", f"S2-{i}"), (f"S1-{i}", f"S3-{i}")]
    candidates = spark.createDataFrame(pairs, CANDIDATE)
    gt = spark.createDataFrame(truth, "source1_entity_id string, matched_id string")
    trainer = linkage.MatcherTrainer(matcher.EntityMatcher(max_iter=3, max_depth=2), validation_fraction=0.3)
    result = trainer.train(s1, s2, s3, candidates, gt)
    assert (result.train_source1_entities, result.validation_source1_entities, result.train_rows, result.validation_rows) == (7, 3, 28, 12)
    assert result.validation_positive_rows == 6 and result.threshold_result.f05 == 1.0
    result.matcher.save(str(tmp_path / "model"))
    matcher.save_threshold(spark, str(tmp_path / "threshold"), 0.123456789)
    assert matcher.load_threshold(spark, str(tmp_path / "threshold")) == 0.123457 and matcher.load_threshold(spark, str(tmp_path / "none")) == matcher.DEFAULT_THRESHOLD
    pipeline = linkage.InferencePipeline(matcher=matcher.EntityMatcher.load(str(tmp_path / "model")), threshold=result.threshold_result.threshold)
    out = pipeline.run(s1, s2, s3, candidates, str(tmp_path / "out"))
    results = {r[0]: r[1] for r in tsv.read_tsv(spark, out["matching_results"]).collect()}
    assert len(results) == 10 and set(results["S1-3"].split(",")) == {"S2-3", "S3-3"}
    none = pipeline.run(s1, s2, s3, spark.createDataFrame([], CANDIDATE))
    assert none["matching_results"].filter("matched_entity_ids = ''").count() == 10
    with pytest.raises(ValueError):
        linkage.InferencePipeline()
    with pytest.raises(RuntimeError):
        matcher.EntityMatcher().predict_scores(candidates)
    with pytest.raises(ValueError):
        matcher.EntityMatcher(features=["num_blockers"]).fit(candidates.withColumn("label", F.lit(1)))


def test_split(spark):
    ids = spark.createDataFrame([(f"S1-{i}",) for i in range(100)] * 2, "source1_entity_id string")
    first = {r[0]: r[1] for r in matcher.split_source1_entities(ids).collect()}
    assert len(first) == 100 and sum(first.values()) == 20
    assert first == {r[0]: r[1] for r in matcher.split_source1_entities(ids.repartition(5)).collect()}
    assert sum(r[1] for r in matcher.split_source1_entities(ids.limit(2), 0.01).collect()) == 1


def test_threshold_optimizer(spark):
    df = spark.createDataFrame([(1, 0.95), (1, 0.80), (0, 0.70), (0, 0.10)], "label int, score double")
    opt = matcher.ThresholdOptimizer(min_threshold=0.1, max_threshold=0.9, num_thresholds=9)
    best = opt.optimize(df)
    assert (best.precision, best.recall, best.true_positives) == (1.0, 1.0, 2) and best == opt.get_best_result()
    one = opt.evaluate_threshold(df, 0.75)
    assert (one.true_positives, one.true_negatives) == (2, 2)
    none = opt.evaluate_threshold(df.withColumn("score", F.lit(0.5)), 0.90)
    assert (none.precision, none.recall, none.f05) == (0.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        opt.optimize(df.withColumn("label", F.lit(2)))


def test_metrics(spark):
    ents = spark.createDataFrame([("A",), ("B",), ("C",), ("D",), ("E",)], "source1_entity_id string")
    gt = spark.createDataFrame([("A", "S2-10"), ("A", "S3-20"), ("B", "S2-10"), ("C", "S2-1")], "source1_entity_id string, matched_id string")
    pred = spark.createDataFrame([("A", "S2-10"), ("B", "S2-10"), ("B", "S2-99"), ("D", "S2-1"), ("Z", "S2-1")], "source1_entity_id string, candidate_entity_id string")
    got = {r["source1_entity_id"]: (r["tp"], r["fp"], r["fn"], r["precision"], r["recall"]) for r in evaluation.entity_metrics(ents, gt, pred).collect()}
    assert got == {"A": (1, 0, 1, 1.0, 0.5), "B": (1, 1, 0, 0.5, 1.0), "C": (0, 0, 1, 0.0, 0.0), "D": (0, 1, 0, 0.0, 0.0), "E": (0, 0, 0, 1.0, 1.0)}
    macro = evaluation.macro_metrics(ents, gt, pred).first()
    assert macro["precision"] == pytest.approx(0.5) and macro["recall"] == pytest.approx(0.5)
    recall = evaluation.candidate_recall(gt, pred).first()
    assert (recall["total_true_matches"], recall["retrieved_true_matches"], recall["candidate_recall"]) == (4, 2, 0.5)
    assert evaluation.candidate_recall(gt.limit(0), pred).first()["candidate_recall"] == 1.0
    dist = evaluation.candidate_distribution(ents, pred).first()
    assert (dist["num_source1_entities"], dist["total_candidate_pairs"], dist["max_candidates_per_s1"]) == (5, 4, 2)
    report = evaluation.retrieval_report(ents, gt, pred.union(pred)).first()
    assert (report["total_candidate_pairs"], report["candidate_count_max"], report["s2_true_matches"], report["s2_missed"], report["s3_recall"]) == (10, 4, 3, 1, 0.0)
    assert (report["no_match_s1_entities"], report["no_match_s1_entities_with_candidates"], report["multi_match_s1_entities"], report["multi_match_fully_retrieved_entities"]) == (2, 1, 1, 0)
    assert report["s1_entities_with_completely_missed_true_matches"] == 1
    pairs = pred.withColumn("candidate_source", F.lit("S2"))
    labels = {(r[0], r[1]): r["label"] for r in evaluation.label_candidate_pairs(pairs, gt).collect()}
    assert sum(labels.values()) == 2 and len(labels) == 5
    errors = evaluation.classify_candidate_errors(pairs, gt, pairs.withColumn("prediction", (F.col("candidate_entity_id") != "S2-1").cast("int")))
    counts = {r[0]: r[1] for r in errors.groupBy("error_class").count().collect()}
    assert counts == {"TP": 2, "FP": 1, "BLOCKING_FAILURE": 2}
    with pytest.raises(Exception, match="prediction"):
        evaluation.classify_candidate_errors(pairs, gt, pairs.withColumn("prediction", F.lit(7))).collect()
    y = spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, score double")
    assert tuple(evaluation.binary_metrics(y, 0.5).select("tp", "fp", "fn", "tn").first()) == (1, 1, 0, 0)


def test_curve_equals_brute_force(spark):
    import random

    rng = random.Random(1)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(300)] + [(1, 1.0), (0, 0.0)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in evaluation.precision_recall_curve(df).collect()}
    for t in {s for _, s in rows}:
        want = [sum(1 for y, s in rows if (s >= t) == yes and y == true) for yes, true in ((True, 1), (True, 0), (False, 1), (False, 0))]
        assert got[t] == tuple(want)


def test_recovery(spark):
    rows = [("STRONG", 0.85, 0.1, 0.0, 0.1, True), ("STRONG", 0.5, 0.66, 0.0, 0.8, True), ("ADDRESS_STRONG", 0.1, 0.75, 0.6, 0.1, True), ("NAME_STRONG", 0.75, 0.1, 0.0, 0.7, True), ("COMBINED", 0.75, 0.7, 0.0, 0.1, True), ("COMBINED", 0.61, 0.61, 0.3, 0.1, True), ("REVIEW", 0.56, 0.1, 0.0, 0.1, True), ("WEAK", 0.1, 0.1, 0.0, 0.1, True), ("WEAK", 1.0, 1.0, 1.0, 1.0, False)]
    df = spark.createDataFrame(rows, "want string, name_score double, address_score double, address_number_overlap double, name_token_set double, country_match boolean")
    assert df.withColumn("got", recovery.recovery_class()).filter("want <> got").count() == 0
    s1 = source(spark, ("S1-1", "Alpha Bakery", "12 Rue", "FR"), ("S1-2", "Alpha Bakery", "", ""))
    targets = source(spark, ("S2-1", "Alpha Bakerie", None, "fr"), ("S2-2", "Zzz", "12 Rue", "DE"), ("S2-3", "Q", "12, rue", "fr")).withColumn("candidate_source", F.lit("S2"))
    got = {r["candidate_entity_id"]: (r["name_hit"], r["address_hit"]) for r in recovery.fuzzy_pairs(s1, targets).collect()}
    assert got == {"S2-1": (True, False), "S2-3": (False, True)}
    assert {r["candidate_entity_id"] for r in recovery.fuzzy_pairs(s1, targets, max_gram_frequency=5).collect()} == set(got)
    base = spark.createDataFrame([("S1-1", "S2-1", "S2", "name_soundex_country", 1)], CANDIDATE)
    fused = {r["candidate_entity_id"]: (r["blocker_sources"], r["is_fuzzy"]) for r in recovery.fuse_with_fuzzy(base, recovery.fuzzy_pairs(s1, targets)).collect()}
    assert fused == {"S2-1": ("name_soundex_country,fuzzy_name_address", True), "S2-3": ("fuzzy_name_address", True)}


def test_negatives_avoid_truth(spark):
    s1 = source(spark, *[(f"S1-{i}", "", "", "") for i in range(30)])
    targets = source(spark, *[(f"S2-{i}", "", "", "") for i in range(30)]).withColumn("candidate_source", F.lit("S2"))
    gt = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(30)], "source1_entity_id string, matched_id string")
    out = [tuple(r) for r in matcher.random_negatives(s1, targets, gt).collect()]
    assert 60 < len(out) <= 90 and len(set(out)) == len(out) and not any(a[3:] == b[3:] for a, b, _ in out)
