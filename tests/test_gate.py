from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace.functions.profile import FILIPINO
from millrace.functions.text import collapse, core, osa, prefix, shard_of, suffix, with_normalised
from millrace.operators import quality
from millrace.streaming import gate

RULES = replace(FILIPINO.rules, required_language=None, min_language_confidence=None)
CASES = [
    ("The plan is in the city and it is for the people.", ["language_code_switch_ratio"]),
    ("And to hold them responsible sa lahat ng epektong idinulot nito sa climate change ng ating bansang Pilipinas.", ["language_code_switch_clause"]),
    ("The plan is for the city and local teams.", ["language_code_switch_borderline"]),
    ("Naglaro ang football team sa National Stadium kahapon.", []),
    ("José ang coach.", []),
    ("JosÃ© ang coach.", ["suspicious_encoding"]),
    ("Masaya ang bata lol.", ["informal_marker"]),
    ("Masaya ang bata (LOL)!", ["informal_marker"]),
    ("Masaya ang bata omg!", ["informal_marker"]),
    ("Masaya ang bata lola.", []),
    ("Masaya ang bata Lolita.", []),
    ("a(b)", []),
    ("a(b", ["unbalanced_bracket"]),
    ("a)b", ["unbalanced_bracket"]),
    ("([)]", ["no_letter", "low_alphabetic_ratio", "unbalanced_bracket"]),
    ("", ["empty_text", "sentence_integrity_too_short"]),
    ("Read More", ["boilerplate"]),
    ("Ano ba ito!!!!!", ["repeated_punctuation"]),
    ("Sumulat sa a.b@example.com po", ["url_or_email"]),
]


def _frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string").withColumns({"language": F.lit(None).cast("string"), "language_confidence": F.lit(None).cast("double"), "is_duplicate": F.lit(None).cast("boolean")})


def test_reasons(spark):
    got = {r.text: r.reason_codes for r in quality.with_reasons(_frame(spark, [t for t, _ in CASES]), RULES).collect()}
    assert got == dict(CASES)


def test_language_rules(spark):
    df = spark.createDataFrame([('Kumusta � mundo ("', "ENGLISH", 0.5, False)], "text string, language string, language_confidence double, is_duplicate boolean")
    assert quality.with_reasons(df, FILIPINO.rules).first().reason_codes == ["language_mismatch", "low_language_confidence", "unbalanced_bracket", "unbalanced_quote", "suspicious_encoding"]


def test_normalisation(spark):
    df = spark.createDataFrame([("  á\n b ",), ("  á \x1c b ",), (None,)], "line string")
    assert [r.text for r in with_normalised(df, "line", "text").collect()] in (["á b", None, "á b"], ["á b", "á b", None], [None, "á b", "á b"])
    assert df.select(collapse(F.lit("  x\x85y ")).alias("t")).first().t == "x y"


def test_token_parts(spark):
    row = spark.range(1).select(*[f(F.lit(t)).alias(f"{f.__name__}{i}") for i, t in enumerate(("“bata,”", "...", "x")) for f in (core, prefix, suffix)]).first()
    assert list(row) == ["bata", "“", ",”", "", "...", "", "x", "", ""]


def test_shards(spark):
    import hashlib

    keys = [f"k{i}" for i in range(50)]
    got = {r.k: r.s for r in spark.createDataFrame([(k,) for k in keys], "k string").select("k", shard_of(F.col("k"), 7).alias("s")).collect()}
    assert got == {k: int(hashlib.sha256(k.encode()).hexdigest(), 16) % 7 for k in keys}


@pytest.mark.parametrize(("a", "b", "n"), [("ca", "abc", 3), ("ab", "ba", 1), ("", "abc", 3), ("abcdef", "abcdfe", 1), ("xabx", "xbax", 1), ("aab", "aba", 1), ("kitten", "sitting", 3)])
def test_osa(a, b, n):
    assert osa(a, b) == osa(b, a) == n


def test_stream_matches_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    _frame(spark, [t for t, _ in CASES]).write.parquet(source)
    stream = gate.gate(gate.read_sentences(spark, source, "text string, language string, language_confidence double, is_duplicate boolean"), RULES)
    gate.write(stream, out, str(tmp_path / "cp")).awaitTermination(120)
    assert {r.text: r.reason_codes for r in spark.read.parquet(out).collect()} == dict(CASES)
