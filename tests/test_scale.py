"""What the larger tables asked of the queries: nothing is shuffled, hashed or judged for each word or candidate that can be told for each sentence, document or pair."""

import hashlib
import random
import time
from difflib import SequenceMatcher
from itertools import zip_longest

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.functions.profile import ENGLISH
from millrace.operators import diagnostics, evaluate, first_come, quality, replay, select
from millrace.plans import common, corpus, evaluation, pairs, records

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_states_are_asked_of_distinct_words(spark):
    """Above the grouping by word, not of every word said."""
    above, below = _plan(evaluation.resource_freeze_checks(spark, SMALL)).rsplit("Aggregate [surface", 1)
    assert "lambda" in above and "lambda" not in below


def test_tokens_are_counted_where_sentences_are(spark, tmp_path):
    """No row per token and sentence is grouped; sentences that share an id, as those of repeated documents do, count once all the same."""
    assert "clean_id" not in _plan(corpus.token_explode(spark, SMALL))
    rows = [(1, "a b a\nb c", "en", "x"), (1, "a a\nc d", "en", "x"), (2, "a\n\nd d d", "de", None), (None, "z a", "en", "x"), (None, "z", "en", "x"), (3, None, "en", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in corpus.token_explode(spark, str(tmp_path)).collect()}
    assert got == {("a", 6, 3, 0), ("b", 2, 2, 0), ("c", 2, 1, 0), ("d", 4, 2, 0), ("z", 2, 1, 0)}


def test_review_sample_reads_the_texts_of_few_documents(spark):
    query = pairs.review_sample(spark, SMALL)
    assert "LeftSemi" in _plan(query)
    ranked = select.ranked(pairs._candidates(spark, SMALL), common.SEED)
    whole = select.top_k(ranked, ["split", "tag"], pairs.SAMPLE, ["clean_id", "pair_id", "position"]).select("split", "tag", "clean_id", "pair_id")
    assert sorted(query.collect()) == sorted(whole.collect()) != []


def test_greedy_names_is_the_greedy_selection(spark):
    """One fold over narrow rows takes what the widening fold over texts takes, however much collides."""
    dice = random.Random(5)
    rows = [(f"c{i}", s, t, f"s{dice.randrange(12)}", "t", f"{dice.getrandbits(256):064x}") for i in range(600) for s in ("dev", "train") for t in ("a", "b") if dice.random() < 0.5]
    df = spark.createDataFrame(rows, "clean_id string, split string, tag string, source_text string, target_text string, rank string").withColumn("pair_id", F.col("clean_id"))
    quotas = {(s, t): 4 for s in ("dev", "train") for t in ("a", "b", "never")}
    keyed = select.keyed(df)
    got = {(r.split, r.tag, r.r) for r in select.greedy_names(keyed, quotas).collect()}
    want = {(r.split, r.tag, int(r["rank"][:14], 16)) for r in select.greedy_quota_select(df, quotas, ["rank", "pair_id"], spare=1).collect()}
    assert got == want and len(got) == 12
    assert select.greedy_names(keyed.limit(0), quotas).isEmpty()


def test_provenance_is_counted_by_sentence(spark):
    from millrace.operators import contracts

    clean = spark.createDataFrame([("1:0", "A b.", "p", "1"), ("1:1", "C.", None, "1"), ("2:0", "D.", "p", "2")], "clean_id string, text string, publisher string, source_doc_id string")
    rows = [("1:0", "A b.", "p", "1")] * 3 + [("1:0", "A c.", "p", "1"), ("1:1", "C.", None, "1"), ("1:1", "C.", "p", "1"), ("2:0", None, "p", "2"), ("2:0", "D.", "p", "1"), ("9:9", "X", "p", "9"), ("9:9", "X", "p", "9")]
    made = spark.createDataFrame(rows, "clean_id string, target_text string, publisher string, source_doc_id string")
    assert tuple(contracts.provenance_counts(made, clean).first()) == (10, 2, 6)
    assert tuple(contracts.provenance_counts(made.limit(0), clean).first()) == (0, 0, 0)
    assert "target_text" not in _plan(pairs.provenance_mismatch(spark, SMALL)).split("Join LeftOuter")[0]


def test_ordered_ranks_are_kept_as_bytes(spark):
    """Half as long as their digits, in the same order."""
    query = records.ordered_output(spark, SMALL)
    assert "lower(hex(rank" in _plan(query)
    keys = [(r.split, r.tag, r["rank"], r.clean_id, r.spot) for r in sorted(query.collect(), key=lambda r: r.position)]
    assert keys == sorted(keys) and len(keys[0][2]) == 64


def test_first_come_takes_the_first_rows_of_each_group(spark):
    """Against a fold in order; a file may have no name, and rows of one file and row many places."""
    dice = random.Random(3)
    rows = sorted({(dice.choice([None, "a", "b"]), dice.randrange(4), dice.randrange(5), dice.choice("xy"), f"s{dice.randrange(60)}") for _ in range(300)}, key=lambda r: (r[0] or "", *r[1:4]))
    rows = list({r[:3]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "file string, row int, line int, tag string, source_text string").withColumns({"split": F.lit("train"), "target_text": F.lit("t")})
    found = first_come.select_first_come(df, order=["file", "row", "line"], quotas={("train", "x"): 6, ("train", "y"): 3})
    seen, want = set(), {"x": [], "y": []}
    for r in rows:
        if r[4] not in seen:
            seen.add(r[4])
            want[r[3]].append(r[:3])
    got = {t: [(r.file, r.row, r.line) for r in sorted(found.selected.where(F.col("tag") == t).collect(), key=lambda r: r.taken)] for t in "xy"}
    assert got == {"x": want["x"][:6], "y": want["y"][:3]}


def test_telemetry_is_counted_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(diagnostics, "PLACES_A_TASK", 7)
    rows = [(f"c{i % 40}", "$A", i % 3, None if i % 2 else "odd") for i in range(400)]
    sentences = spark.createDataFrame([(f"c{i}",) for i in range(50)], "clean_id string")
    got = {r.outcome: r for r in diagnostics.telemetry(spark.createDataFrame(rows, "clean_id string, tag string, position int, reason string"), sentences, ["$A"]).collect()}
    for outcome, odd in (("selected", 1), ("odd", 0)):
        places = sorted({(c, p) for (c, _, p, _), i in zip(rows, range(400), strict=True) if i % 2 == odd})
        assert (got[outcome].n, got[outcome].positions) == (200, len(places)) and [tuple(s) for s in got[outcome].samples] == places[:25]
    assert got["not_applicable"].n == 10


def test_gate_of_ascii_and_other_texts(spark):
    """Tests that ask less of ASCII text, and look for signs before they match, find what the plain ones find."""
    words = ["lol", "LoL,", "xd", "éxd", "xdé", "www.x.org", "WWW.", "a@b.co", "é@b.co", "HTTP://x", "://", "@", "(a)", "(é]", "Ã©", "é", "1234567", "…", "Omg!", "K", "word"]
    df = spark.createDataFrame([(f"{a} {b}", "EN", 1.0, False) for a in words for b in words] + [("", "EN", 1.0, False)], "text string, language string, language_confidence double, is_duplicate boolean")
    t, rules = F.col("text"), ENGLISH.rules
    letters = F.length(F.regexp_replace(t, "\\P{L}", "")) / F.greatest(F.length(F.replace(t, F.lit(" "), F.lit(""))), F.lit(1))
    informal = t.rlike(f"(?U){rules.informal[0]}") | t.rlike(f"(?U){rules.informal[1]}")
    want = {"url_or_email": t.rlike(quality.URL_OR_EMAIL), "informal_marker": informal, "low_alphabetic_ratio": (t != "") & (letters < rules.min_alphabetic_ratio), "suspicious_encoding": t.contains("Ã©"), "sentence_integrity_too_short": t == "", "unbalanced_bracket": t.contains("]")}
    judged = quality.with_reasons(df, rules)
    assert len(quality.URL_SIGNS) == 3
    for code, test in want.items():
        assert judged.where(F.array_contains("reason_codes", code) != test).isEmpty(), code
        assert not judged.where(test).isEmpty(), code


def test_samples_are_numbered_in_order_however_partitions_are_merged(spark):
    """A plan that reads ids alone shuffles less, and small partitions are merged by their size: places were counted over other partitions than those that were offset."""
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(6000).select(F.col("id").cast("string").alias("sample_id"), *[F.xxhash64("id", F.lit(k)).alias(k) for k in evaluate.COUNTS])
        got = {r.tp_a: r.i for r in evaluate._numbered(df).collect()}
        wanted = {r.tp_a: i for i, r in enumerate(sorted(df.collect()))}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == wanted


def test_hashes_of_many_numbers_at_once():
    for head in (b"7:0:", b"-12:1999:", b"x" * 47, b"x" * 53, b"x" * 70):
        for first, last in ((0, 1203), (99_998, 100_003), (4, 4)):
            digests = [hashlib.md5(head + str(k).encode()).hexdigest() for k in range(first, last)]
            assert evaluate.md5_words(head, first, last).tolist() == [[int(h[j : j + 8], 16) for h in digests] for j in (0, 8, 16, 24)]


def test_words_are_counted_by_place(spark):
    dice = random.Random(2)
    said = lambda: " ".join(dice.choice("ab") for _ in range(dice.randint(1, 5)))
    rows = [(i, said(), said(), said()) for i in range(400)] + [(400, None, "a", "a"), (401, "", "a", "")]
    want = {}
    for i, *texts in rows:
        words = list(zip_longest(*[(t or "").split(" ") for t in texts]))
        want[i] = None if None in texts else tuple(sum(kind(x, y, z) for x, y, z in words) for kind in (lambda x, y, z: x != y == z, lambda x, y, z: x == y != z, lambda x, y, z: x != y != z))
    got = spark.createDataFrame(rows, "i int, x string, y string, z string").select("i", evaluate.word_counts("x", "y", "z").alias("n")).collect()
    assert {r.i: r.n and tuple(r.n) for r in got} == want


def test_draws_over_more_vectors_than_are_named(spark, monkeypatch):
    rows = [(i, *[(i * k) % 7 for k in range(1, 7)]) for i in range(120)]
    numbered = spark.createDataFrame(rows, "i long, " + ", ".join(f"{k} long" for k in evaluate.COUNTS))
    named = sorted(evaluate._drawn_sums(numbered, 9, 7).collect())
    monkeypatch.setattr(evaluate, "VECTORS", 3)
    monkeypatch.setattr(evaluate, "CHUNK", 16)
    assert sorted(evaluate._drawn_sums(numbered, 9, 7).collect()) == sorted(evaluate._drawn_sums(numbered, 9, 7, 50).collect()) == named


def test_word_changes_are_those_of_longest_blocks():
    """Told by places, by windows, or through the automaton: always what SequenceMatcher says; a long text that repeats itself is told in time, not in the square of its words."""
    plain = lambda x, y: [o for o in SequenceMatcher(None, x, y, autojunk=False).get_opcodes() if o[0] != "equal"]
    dice = random.Random(6)
    for k in range(4000):
        words = "abcdefgh"[: dice.randint(1, 8)]
        x = [dice.choice(words) for _ in range(dice.randint(0, 14))] * (20 if k % 100 == 0 else 1)
        y = [dice.choice(words) if dice.random() < 0.2 else w for w in x]
        y = y[1:] + y[: dice.randint(0, 3)] if k % 5 == 0 else y
        assert evaluate.word_changes(x, y) == plain(x, y), (x, y)
        longest = SequenceMatcher(None, x, y, autojunk=False).find_longest_match()
        assert longest.size == 0 or evaluate._longest_passage(x, y) == tuple(longest)
    x = [dice.choice("abcdefghi") for _ in range(70)] * 70
    y, began = [w if i % 17 else "z" for i, w in enumerate(x)], time.time()
    changes, made = evaluate.word_changes(x, y), list(x)
    assert time.time() - began < 3
    for _, i, j, k, m in reversed(changes):
        made[i:j] = y[k:m]
    assert made == y


def test_distances_that_bounds_tell():
    """Where the sum over words is as large as the difference in characters, it is the distance; elsewhere nothing is told."""
    dice, told = random.Random(8), 0
    word = lambda: "".join(dice.choice("abc") for _ in range(dice.randint(0, 3)))
    for _ in range(3000):
        x = [word() for _ in range(dice.randint(1, 6))]
        a, b = " ".join(x), " ".join(word() if dice.random() < 0.4 else w for w in x)
        for swaps in (False, True):
            found = text.told_distance(a, b, swaps)
            told += found is not None
            assert found in (None, text.distance(a, b, swaps)), (a, b)
    assert told > 1000 and text.told_distance("a b", "ab") is None and text.told_distance("ab", "ba", True) is None
    long = "the house of the man " * 4000
    began = time.time()
    assert text.told_distance(long, long.replace("the", "da")) == 24000 and time.time() - began < 1


def test_words_of_an_operation_are_cut_once(spark):
    """A word is cut out by its spaces; each was cut again for every field that asks for it."""
    df = spark.createDataFrame([("duplicate", 1, "b", "", "a b b c")], "kind string, position long, correct string, wrong string, source_text string")
    made = replay.with_operation(df)
    cuts = _plan(made).count("substring_index")
    assert cuts < 40, cuts
    assert tuple(made.first().operation)[:5] == ("duplicate", 3, 5, " b", "")
