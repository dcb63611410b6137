import random
from decimal import Decimal

from pyspark.sql import functions as F

from millrace.functions.profile import ENGLISH, FILIPINO
from millrace.operators import contracts, generate, replay, select, splits


def _made(spark, text):
    df = spark.createDataFrame([("s", text)], "clean_id string, text string")
    return [(r.tag, r.source_text, r.position, r.confidence) for r in generate.generate(df, FILIPINO).collect()]


def _of(made, tag):
    return [m[1] for m in made if m[0] == tag]


def test_generators(spark):
    cases = [
        ("Kumain ng isda.", "$REPLACE_ng", ["Kumain nang isda."]),
        ("Pumunta ako rin.", "$REPLACE_rin", ["Pumunta ako din."]),
        ("Aalis rin.", "$REPLACE_rin", []),
        ("Maayos.", "$ADD_PUNC_PERIOD", ["Maayos"]),
        ("Umalis siya kahapon.", "$REPLACE_siya", ["Umalis niya kahapon."]),
        ("Ang bata.", "$APPEND_t1", ["bata."]),
        ("Nakita ang bata.", "$APPEND_t1", ["Nakita bata."]),
        ("Nakita ang bata.", "$DELETE", ["Nakita ang ang bata."]),
        ("Nakita bata.", "$DELETE", []),
        ("Bata.", "$TRANSFORM_CASE_CAPITAL", ["bata."]),
        ("Ikaw rin.", "$REPLACE_rin", ["Ikaw din."]),
        ("Okey raw.", "$REPLACE_raw", ["Okey daw."]),
        ("Maaari din.", "$REPLACE_din", ["Maaari rin."]),
        ("Kapara daw.", "$REPLACE_daw", ["Kapara raw."]),
        ("Araw daw.", "$REPLACE_daw", ["Araw raw."]),
        ("Biray din.", "$REPLACE_din", ["Biray rin."]),
        ("Ikaw din.", "$REPLACE_din", []),
        ("Okey daw.", "$REPLACE_daw", []),
        ("Maaari rin.", "$REPLACE_rin", []),
    ]
    df = spark.createDataFrame([(t, t) for t in dict.fromkeys(c[0] for c in cases)], "clean_id string, text string")
    made = generate.generate(df, FILIPINO).collect()
    for text, tag, wanted in cases:
        assert [r.source_text for r in made if r.clean_id == text and r.tag == tag] == wanted, (text, tag)
    assert {r.confidence for r in made if r.tag == "$REPLACE_siya"} == {"medium"}


def test_reviewed_generators(spark):
    df = spark.createDataFrame([("1", "sumulat."), ("2", "Masaya."), ("3", "Ako pa rin ito, parin pa rina.")], "clean_id string, text string")
    verbs = spark.createDataFrame([("sulat", "sumulat", "COMPACT"), ("sulat", "magsusulat", "CONTACT")], "lemma string, surface string, state string")
    assert [(r.tag, r.source_text) for r in generate.verb_states(df, verbs).collect()] == [("$TRANSFORM_VERB_COMPACT", "magsusulat.")]
    marks = spark.createDataFrame([("Masaya", ".", "?", "$CHANGE_PUNC_PERIOD")], "context string, correct string, wrong string, tag string")
    assert [r.source_text for r in generate.changed_marks(df, marks).collect()] == ["Masaya?"]
    built = spark.createDataFrame([("pa rin", "parin", "$MERGE_SPACE", "space")], "correct string, wrong string, tag string, family string")
    assert [r.source_text for r in generate.constructions(df, built).collect()] == ["Ako parin ito, parin pa rina."]


def test_replay(spark):
    df = spark.createDataFrame([("1", "Sabi niya ang (bata) rin ay kumain ng isda at siya.")], "clean_id string, text string")
    made = generate.with_replay(generate.generate(df, FILIPINO))
    assert made.count() >= 5 and made.where(~F.col("again").eqNullSafe(F.col("target_text"))).isEmpty()


def test_constructions_end_at_word_characters_and_long_words_stay_whole(spark):
    df = spark.createDataFrame([("1", "ako pa rin_ito at pa rin.")], "clean_id string, text string")
    built = spark.createDataFrame([("pa rin", "parin", "$MERGE_SPACE", "space")], "correct string, wrong string, tag string, family string")
    assert [r.source_text for r in generate.constructions(df, built).collect()] == ["ako pa rin_ito at parin."]
    word = "Ab" + "c" * 1_200_000
    made = generate.generate(spark.createDataFrame([("1", word)], "clean_id string, text string"), FILIPINO).where("kind = 'case_capital'").first()
    assert (made.wrong, made.correct, made.source_text) == ("a" + word[1:], word, "a" + word[1:])


def test_allocation():
    splits3 = [Decimal("0.70"), Decimal("0.15"), Decimal("0.15")]
    got = select.composition(1_000_000, Decimal("0.83"), splits3)
    assert got == {"errorful": 830_000, "identity": 170_000, "errorful_by_split": [581_000, 124_500, 124_500], "identity_by_split": [119_000, 25_500, 25_500]}
    assert select.largest_remainder(10, splits3) == [7, 2, 1]
    assert select.bounded_quotas({"common": 10_000, "rare": 1}, 2)["rare"] == 1
    assert select.shard_quotas([0, 120], 100) == [0, 100]
    assert sum(select.shard_quotas([50, 50, 50], 101)) == 101
    assert select.equal_quotas({"a": 3, "b": 100}, 50) == {"a": 3, "b": 47}


def test_greedy_split():
    counts = {"a": 10, "b": 7, "c": 3, "d": 2}
    got = splits.assign(counts, 20260905)
    assert set(got.values()) == set(splits.RATIOS) and got == splits.assign(dict(reversed(counts.items())), 20260905)


def test_selection_ignores_input_order(spark):
    rows = [(f"c{i}", "train", f"t{i % 3}", f"s{i % 20}", f"g{i % 20}") for i in range(60)]
    quotas = spark.createDataFrame([("train", f"t{k}", 4) for k in range(3)], "split string, tag string, quota int")
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = select.ranked(spark.createDataFrame(rows, "clean_id string, split string, tag string, source_text string, target_text string"), 5)
        taken, left = select.quota_select(df, quotas, 4)
        results.append((sorted(r.pair_id for r in select.fetch(df, taken).collect()), sorted(r.pair_id for r in select.fetch(df, select.refill(left, spark.createDataFrame([("train", 3)], "split string, gap int"), 3)).collect())))
        greedy = select.greedy_quota_select(df, {("train", f"t{k}"): 4 for k in range(3)}, ["rank", "pair_id"])
        assert greedy.count() == 12
    assert results[0] == results[1] and len(results[0][0]) <= 12 and len(results[0][1]) == 3


def test_greedy_quotas_are_filled_past_any_number_of_collisions(spark):
    """Two groups of the same pairs: the second one's best rows are all taken, and it is filled from far down its order."""
    rows = [("train", tag, f"{k:04d}", f"p{tag}{k}", f"s{k}", f"t{k}") for tag in ("a", "b") for k in range(120)] + [("train", "c", "0", "pc", "s0", "t0")]
    df = spark.createDataFrame(rows, "split string, tag string, rank string, pair_id string, source_text string, target_text string")
    got = select.greedy_quota_select(df, {("train", "a"): 50, ("train", "b"): 50, ("train", "c"): 5}, ["rank", "pair_id"], spare=2).collect()
    assert sorted((r.tag, r["rank"]) for r in got) == [("a", f"{k:04d}") for k in range(50)] + [("b", f"{k:04d}") for k in range(50, 100)]


def test_reserves_hold_the_least_ranks_of_distinct_pairs(spark):
    assert [select.reserve_of(q) for q in (0, 5, 100, 40_000)] == [8, 13, 125, 41_000]
    rng = random.Random(2)
    rows = [(rng.choice(["train", "dev"]), rng.choice(["a", "b"]), f"{k:05d}", f"p{k}", "x") for k in range(300) for _ in range(rng.randint(1, 3))]
    rng.shuffle(rows)
    quotas = {("train", "a"): 5, ("dev", "b"): 40}
    got = select.ranked_reserve(spark.createDataFrame(rows, "split string, tag string, rank string, pair_id string, more string"), quotas).collect()
    wanted = [(*g, *p) for g, q in quotas.items() for p in sorted({r[2:4] for r in rows if r[:2] == g})[: select.reserve_of(q)]]
    assert sorted((r.split, r.tag, r["rank"], r.pair_id) for r in got) == sorted(wanted)


def test_wrong_sentences_are_not_made_for_counting_and_compile_small(spark):
    """Counting candidates builds no text, and no step of the gate over them is a method that the JVM is too large to compile (8000 bytes)."""
    rows = spark.createDataFrame([("1:0", "1", "p", "He is in the house of the man, as it is.", "train")], "clean_id string, source_doc_id string, publisher string, text string, split string")
    made = generate.generate(rows, FILIPINO)
    counted = made.groupBy("tag").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" not in counted
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        judged = contracts.candidate_codes(generate.with_replay(made).withColumn("pair_id", F.col("clean_id")), [t for t, _ in FILIPINO.tags], F.col("again")).groupBy("reject_code").count()
        stages = judged._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) < 8000


def test_operations_beyond_the_words_have_no_place(spark):
    rows = [(kind, at, "a", "a", text) for text in ("a b", "a", "") for at in (0, 1, 2, 3, 9) for kind in ("swap", "duplicate", "missing")]
    df = spark.createDataFrame(rows, "kind string, position long, correct string, wrong string, source_text string")
    for r in replay.with_operation(df).collect():
        words, i, o = r.source_text.split(" ") if r.source_text else [], r.position, r.operation
        left = " ".join(words[:i])
        assert o.anchor_surface == (words[i - 1] if r.kind == "missing" and 0 < i <= len(words) else None)
        assert o.start == (None if r.kind == "missing" or i >= len(words) else len(left) + (i > 0) + (len(words[i]) if r.kind == "duplicate" else 0))
        assert r.kind != "duplicate" or o.source_surface == (" " + words[i + 1] if i + 1 < len(words) else None)


def test_accents_are_folded_by_profile(spark):
    df = spark.createDataFrame([("1", "Si oié raw as at.")], "clean_id string, text string")
    assert [r.tag for r in generate.generate(df, FILIPINO).where("kind = 'contextual'").collect()] == ["$REPLACE_raw"]
    assert [r.position for r in generate.generate(spark.createDataFrame([("1", "Si oié as oie as x.")], "clean_id string, text string"), ENGLISH).where("kind = 'contextual'").collect()] == [4]


def test_pairs_are_told_by_whole_numbers_up_to_any_number_of_groups(spark, monkeypatch):
    """First pairs are aggregated by hash, not sorted, and are the same where groups are too many for one whole number."""
    rows = [(f"c{i}", "train", f"t{i % 5}", f"s{i % 20}", f"g{i % 20}") for i in range(60)]
    df = select.ranked(spark.createDataFrame(rows, "clean_id string, split string, tag string, source_text string, target_text string"), 5)
    wanted = {}
    for r in df.collect():
        pair = (r.source_text, r.target_text)
        wanted[pair] = min(wanted.get(pair, ("~",)), (r.split, r.tag, int(r["rank"][:14], 16)))
    found = select.first_pairs(df)
    assert sorted((r.split, r.tag, r.r) for r in found.collect()) == sorted(wanted.values())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    monkeypatch.setattr(select, "BEGINNING", 61)
    assert sorted((r.split, r.tag) for r in select.first_pairs(select.keyed(df)).collect()) == sorted(w[:2] for w in wanted.values())


def test_sentences_are_cut_by_bytes_at_either_end(spark):
    """Words of several bytes on both sides of a rule's word, near the beginning and near the end."""
    text = "é nang 漢字 ññ ü ang ö 漢 nang 字"
    assert sorted(_of(_made(spark, text), "$REPLACE_nang")) == sorted([text.replace("nang", "ng", 1), "ng".join(text.rsplit("nang", 1))])
    assert "é 漢字 ññ ü ang ö 漢 nang 字" in _of(_made(spark, text), "$APPEND_t1")
