import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import ann, entry, line_dedup, mixing, near_dedup
from millrace.llm.components import components
from millrace.llm.workspace import Workspace

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _brute(rows, k, percent):
    """(shingles, component) by comparing all pairs."""
    sets = {i: near_dedup.shingle_set(t, k) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {i: (len(sets[i]), root(i)) for i in sets}


def _near_texts():
    rng = random.Random(5)
    texts = [None, "", "one", "One", "one two", "ONE  two\n", "three four five", " \t"]
    for _ in range(12):
        base = [f"w{rng.randint(0, 200)}" for _ in range(rng.randint(8, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 9))):
                copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 999)}"
            texts.append(" ".join(copy))
    return texts


def test_near_duplicates_match_brute_force(spark):
    rows = list(enumerate(_near_texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kept": F.lit("clash"), "digest": F.lit(1), "rep": F.lit(2)})
    for k in (2, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, shingle_words=k).collect()}
        assert got == _brute(rows, k, 80)


def test_near_duplicate_edges(spark):
    df = spark.createDataFrame([(None, "a b c"), (7, "a b c"), (7, "a b c"), (3, "A b\tc"), (9, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, shingle_words=2).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (7, 2, 3, False), (7, 2, 3, False), (3, 2, 3, True), (9, 0, 9, True)], key=str)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components_of_long_paths(spark):
    order = list(range(60))
    random.Random(2).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(59)] + [(100, 101), (102, 101)]
    got = {r.vertex: r.root for r in components(Workspace(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(60)} == {0} and {got[i] for i in (100, 101, 102)} == {100}


def test_line_dedup(spark):
    rows = [(i, f"  everywhere  \nown {i}\n\nshared by few" if i < 3 else f"everywhere\nown {i}", "en", f"s{i}", 0) for i in range(12)]
    rows += [(50, None, "en", None, 0), (51, "", None, "s1", 0), (None, "everywhere\nx", "en", "s1", 0), (1, rows[1][1], "en", "s1", 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"x": F.lit(1), "n": F.lit(2)})
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(df, min_sites=10).collect()]
    wanted = [(i, f"own {i}\n\nshared by few" if i < 3 else f"own {i}", 4 if i < 3 else 2, 1) for i in range(12)]
    wanted += [(50, None, 0, 0), (51, "", 1, 0), (None, "x", 2, 1), wanted[1]]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert {r.exact for r in line_dedup.boilerplate(line_dedup._lines(df, "doc_id", "text", "source"), Workspace(spark, "t"), min_sites=10).collect()} == {True}
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_stage_leaves_copied_documents(spark):
    body = [f"a long line {k} of the copied article" for k in range(8)]
    rows = [(i, "\n".join(body), "en", f"s{i % 12}", 0) for i in range(24)]
    rows += [(100 + i, "\n".join([*[f"{x} on the same pages" for x in body], f"edited {i}", "the footer"]), "en", f"s{i}", 0) for i in range(15)]
    rows += [(200 + i, f"its own words {i} and more of them {i}\nthe footer", "en", f"s{i}", 0) for i in range(10)]
    rows += [(300, "the footer\n\nthe footer", "en", "s1", 0), (301, " ", "en", "s1", 0)]
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    wanted = {i: t if i in (300, 301) else t.replace("\nthe footer", "") for i, t, *_ in rows}
    assert got == wanted


def test_mixing(spark):
    rows = [(i, "a b c d", "en", "big" if i < 800 else f"small{i % 4}" if i < 990 else None, 0) for i in range(1000)] + [(None, "a b", "en", "big", 0), (5, None, "en", "big", 0), (5, None, "en", "big", 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"p": F.lit(1), "rows": F.lit(2)})
    plan, a = mixing.budgets(df.select("source", mixing.n_tokens(F.col("text")).alias("n")), Workspace(spark, "t"), max_epochs=2.0, block_rows=64)
    held = {r.source: r for r in plan.collect()}
    shares = np.array([r.p for r in held.values()])
    weights = shares**a / (shares**a).sum()
    assert np.allclose(weights, [r.weight for r in held.values()])
    assert abs(max(r.epochs for r in held.values()) - 2.0) < 1e-6 and min(r.epochs for r in held.values()) == 1.0
    mixed = mixing.mix(df, max_epochs=2.0, block_rows=64)
    tokens = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    for source, r in held.items():
        assert r.tokens * r.epochs - 4 * r.blocks <= tokens[source] <= r.tokens * r.epochs + 1e-6
    assert mixed.where("epoch = 0").count() == len(rows)
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mix(df.where("source = 'big'")).count() == 803


def test_mixing_splits_rows_that_repeat(spark):
    rows = [(None, "the same text", "en", "hot", 0)] * 6000 + [(i, f"text {i} of its own", "en", "hot", 0) for i in range(2000)] + [(None, f"no id {i}", "en", "b", 0) for i in range(900)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(8), block_rows=256)
    sizes = mixed.where("epoch = 0").groupBy("source", "block").agg(F.count("*").alias("n"), F.max("position").alias("last")).collect()
    assert sum(r.n for r in sizes) == len(rows) and all(r.n == r["last"] for r in sizes)
    assert max(r.n for r in sizes) < 3 * 256


def test_block_permutations_match_a_plain_reading(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 40), "en", rng.choice(["a", "a", "a", "a", "a", "b", None]), 0) for i in range(1500)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA), block_rows=200, max_epochs=1.7).select("doc_id", "source", "n_tokens", "weight", "epoch", "block", "position").collect()
    tokens, blocks = {}, {}
    for i, t, _, source, _ in rows:
        tokens[source] = tokens.get(source, 0) + len(t.split())
        blocks[source] = blocks.get(source, 0) + 1
    weights, total = {r.source: r.weight for r in mixed}, sum(tokens.values())
    ratio = {s: weights[s] / (tokens[s] / total) for s in tokens}
    wanted = []
    groups = {}
    for i, t, _, source, _ in rows:
        d = hashlib.md5(f"42:{i}:{t}".encode()).hexdigest()
        groups.setdefault((source, int(d[:15], 16) % -(-blocks[source] // 200)), []).append((int(d[15:30], 16), i, len(t.split())))
    for (source, block), held in groups.items():
        epochs, through, everything = ratio[source] / min(ratio.values()), 0, sum(n for *_, n in held)
        for position, (_, i, n) in enumerate(sorted(held), 1):
            through += n
            copies = int(epochs + 1e-9) + (n > 0 and through <= (epochs - int(epochs + 1e-9)) * everything)
            wanted += [(i, source, n, e, block, position) for e in range(copies)]
    assert sorted(((r.doc_id, r.source, r.n_tokens, r.epoch, r.block, r.position) for r in mixed), key=str) == sorted(wanted, key=str)


def test_workspace_refuses_a_cluster_without_a_shared_folder():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError):
        Workspace(Session(), "t")
    Context.master = "local-cluster[2,1,512]"
    with pytest.raises(RuntimeError):
        Workspace(Session(), "t")


def test_line_dedup_of_rows_without_id_and_long_texts(spark):
    rows = [(None, f"everywhere\nonly {i}", "en", f"s{i}", 0) for i in range(12)] + [(None, None, "en", "s1", 0), (3, "\n".join(["everywhere"] * 20_000 + ["end"]), "en", "s3", 0)]
    rows += [(4, "nine only", "en", f"s{i}", 0) for i in range(9)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.doc_id), str(r.text), r.n_removed) for r in got) == sorted([("None", f"only {i}", 1) for i in range(12)] + [("None", "None", 0), ("3", "end", 20_000)] + [("4", "nine only", 0)] * 9)


def test_sample_of_the_index_ignores_repeats_and_lengths(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5, x[5].tolist())] * 3000 + [(9000 + i, [1.0] * 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df, F.col("vec_id") < 20, k=5, sample_rows=100, per_list=1).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    scores = x @ x.T
    hits = sum(len({i for i in scores[q].argsort()[::-1][:6] if i != q} & set(found.values())) for q, found in got.items())
    assert set(got) == set(range(20)) and all(sorted(f) == [1, 2, 3, 4, 5] for f in got.values()) and hits >= 90


def test_temperature_meets_the_entropy(spark):
    p = np.array([0.5, 0.3, 0.15, 0.05])
    sources = spark.createDataFrame([(float(x),) for x in p], "p double")
    a = mixing.temperature(sources, entropy=0.95, max_epochs=1e9)
    w = p**a / (p**a).sum()
    assert abs(-(w * np.log(w)).sum() - 0.95 * np.log(4)) < 1e-6
    assert mixing.temperature(sources.limit(1)) == 1.0 and mixing.temperature(sources.limit(0)) == 1.0


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 16))) * rng.uniform(0.5, 2, (1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, x[0].tolist()) for i in range(40)]
    rows += [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] * 16), (3060, [None] * 16), (3080, [1.0] * 3), (None, x[1].tolist()), (20, rows[20][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"list": F.lit(1), "v": F.lit(2)})
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    held = {i: np.array(v) for i, v in rows if i is not None and i < 3000}
    ids, matrix = np.array(sorted(held)), np.stack([held[i] for i in sorted(held)])
    assert set(got) == {i for i in held if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        assert [f[0] for f in found] == list(range(1, 21)) and [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        scores = (matrix * held[q]).sum(1)
        best = [i for i in ids[np.lexsort((ids, -scores))] if i != q][:20]
        hits += len(set(best) & {f[1] for f in found})
    assert hits >= 0.9 * 20 * len(got)
    few = ann.search(df.where("vec_id < 5"), F.col("vec_id") == 0, k=20).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4] and ann.search(df.limit(0), F.lit(True)).count() == 0


def test_the_centroid_graph_measures_few_centroids():
    """A search opens fewer centroids than there are, at every size, measures a small share of many, and finds most of the nearest."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 12))[rng.integers(0, 40, 12_000)] + 0.7 * rng.normal(size=(12_000, 12))
    shares = []
    for lists in (1, 2, 16, 64, 1200):
        index = ann.Index.build(x[:6000] if lists > 1 else x[:1], lists, float(np.sqrt((x * x).sum(1).max())))
        k, queries = len(index.centres), ann.lift(x[:400], float(np.sqrt((x * x).sum(1).max())))
        assert index.beam(3) < max(k, 4) or k < 16
        near, far = index.search(queries, 3)
        shares.append(index.measured / (len(queries) * k))
        plain = ann._distances(queries, index.centres)
        for i in range(0, 400, 40):
            met = near[i][near[i] >= 0]
            assert len(set(met.tolist())) == len(met) and np.allclose(plain[i, met], far[i][: len(met)], atol=1e-6) and (np.diff(far[i][: len(met)]) >= 0).all()
        assert (near[:, 0] == plain.argmin(1)).mean() > 0.9
    assert shares[-1] < 1 / 3 and max(shares) <= 1


def test_nearest_neighbours_with_repeated_ids(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8)) + 5
    rows = [(i, v.tolist()) for i, v in enumerate(x) for _ in range(2)] + [(1, (x[0] * 1.5).tolist())] * 400
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=20).orderBy("rank").collect()
    scores = {i: float(v @ x[0]) for i, v in enumerate(x)} | {1: float(1.5 * x[0] @ x[0])}
    assert [r.vec_id for r in got] == sorted(set(scores) - {0}, key=lambda i: -scores[i])[:20]


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(8)
    words = [a + b for a in ("the", "an", "er", "on") for b in ("st", "nd", "ing", "ed", "or")]
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(words) + str(rng.randint(0, 50)) for _ in range(60))
        bad = i % 6 == 0
        rows.append((i, ("everywhere the same\n" if i % 2 else "") + (text.upper().replace(" ", "!! ") if bad else text), "en", f"s{i % 15}", 0))
    rows += [(200, rows[1][1], "en", "s1", 0), (1, rows[1][1], "en", "s1", 0), (201, None, None, None, None), (None, "alone here", "en", "s2", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 6 != 0), 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = Workspace(spark, "t").save(stage(spark, docs, str(tmp_path)), "s")
        assert docs.columns == corpus_pipeline.COLUMNS
        seen.append(docs.collect())
    good = {i for i in range(120) if i % 6}
    assert good <= {r.doc_id for r in seen[0]} and not {r.doc_id for r in seen[0]} & {i for i in range(120) if i % 6 == 0}
    assert not any("everywhere" in (r.text or "") for r in seen[1]) and all(r.text is None or r.n_chars in (0, len(r.text)) for r in seen[1])
    ids = [r.doc_id for r in seen[2]]
    assert len(ids) == len(set(ids)) and 200 not in ids and good <= set(ids) and None in ids
    assert set(ids) == {r.doc_id for r in seen[3]}
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == len(set(ids))


def test_near_duplicates_of_many_copies_and_stragglers(spark):
    """Near copies of one text, one straggler that only some of them reach, a second family: links are kept, and what is compared stays linear."""
    rng = random.Random(31)
    base = [f"w{i}" for i in range(120)]

    def edited(words, n):
        out = list(words)
        for _ in range(n):
            out[rng.randrange(len(out))] = f"e{rng.randint(0, 10**9)}"
        return " ".join(out)

    texts = [edited(base, 2) for _ in range(2500)]
    straggler = edited(base, 24)  # about 0.6 similar to the copies
    bridge = edited(straggler.split(), 4)
    texts += [straggler, bridge, *[edited([f"v{i}" for i in range(60)] + base[60:], 1) for _ in range(30)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near_dedup_across, seen = near_dedup._across, []
    try:
        near_dedup._across = lambda *a, **k: seen.append(near_dedup_across(*a, **k)) or seen[-1]
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, shingle_words=2).collect()}
    finally:
        near_dedup._across = near_dedup_across
    sets = [near_dedup.shingle_set(t, 2) for t in texts]
    near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert all(got[i] == 0 for i in range(2500))  # all within reach of a common centre
    for i in range(2500, len(texts)):
        linked = {j for j in range(len(texts)) if j != i and near(i, j)}
        assert all(got[j] == got[i] for j in linked) and (linked or got[i] == i)
    assert got[2501] == got[2500] and got[2502] == min(got[i] for i in range(2502, 2532))


def test_across_compares_in_proportion_to_the_rows(spark):
    """5000 members of one component and one straggler in a bucket: each member is dealt once, not once per chunk."""
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 16, 160).astype(np.uint16)
    other = np.where(np.arange(160) < 100, common, rng.integers(0, 1 << 16, 160)).astype(np.uint16)
    classes = spark.createDataFrame([(i, bytearray((other if i == 5000 else common).tobytes())) for i in range(5001)], "rep long, signature binary")
    members = spark.createDataFrame([(1, i) for i in range(5001)], "key long, rep long")
    labels = spark.createDataFrame([(i, 0) for i in range(5000)], "vertex long, root long")
    dealt = []
    grouped = near_dedup._grouped
    try:
        near_dedup._grouped = lambda units, *a: dealt.append(units.count()) or grouped(units, *a)
        found = near_dedup._across(members, labels, classes, 160, 0.6, 1e-4, chunk=512).collect()
    finally:
        near_dedup._grouped = grouped
    touched, pairs = {r.a for r in found if r.a == r.b}, [r for r in found if r.a != r.b]
    assert touched == set(range(5001)) and 1 <= len(pairs) <= 10 and all(5000 in (r.a, r.b) for r in pairs)
    assert dealt == [5000 + 10]  # the straggler goes to each of the ten chunks


def test_pipeline_stages_on_empty_tables_and_odd_rows(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA + ", score double, kept string")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, str(tmp_path))
        assert out.columns == corpus_pipeline.COLUMNS and out.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicate_stage_takes_one_row_of_a_repeated_id(spark):
    rows = [(1, f"one of several texts of an id, number {k}", "en", f"s{k}", 0) for k in range(4)] + [(2, "its own words and nothing else at all", "en", "a", 0), (None, "same", "en", "a", 0), (None, "same", "en", "a", 0), (3, None, None, None, None), (3, None, None, None, None)]
    rows += [(10 + k, "a long enough text that is there again and again", "en", "a", 0) for k in range(50)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"__id": F.lit(1), "kept": F.lit("x")})
    got = [[(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, df.repartition(n).select(corpus_pipeline.COLUMNS), "").collect()] for n in (1, 3)]
    assert sorted(got[0], key=str) == sorted(got[1], key=str)
    assert sorted((str(i) for i, _ in got[0])) == sorted(["1", "2", "3", "10", "None", "None"])


def test_every_registered_query(spark, tmp_path):
    """The thin queries: their columns, and the digests they derive from what the operators return."""
    rng, words = random.Random(4), [a + b for a in ("the", "an", "er", "on") for b in ("st", "nd", "ing", "ed", "or")]
    rows = [(i, " ".join(rng.choice(words) + str(rng.randint(0, 30)) for _ in range(40)) + (" token = abcdef0123456789abcd" if i % 7 == 0 else ""), "en", f"s{i % 4}", 0) for i in range(150)] + [(150, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 3 and 1, int(i % 5 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(100)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(1, "u", "<article><p>a b c d e f</p></article>"), (2, "v", None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    turns = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No, it is", "Well!"]) + str(t % 3)) for c in range(20) for t in range(6)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = {name: query(spark, str(tmp_path)).collect() for name, query in entry.QUERIES.items()}
    assert len(out["op11_whitening"]) == 400 and {r.component for r in out["op11_whitening"]} == {1, 2, 3, 4} and out["op11_whitening"][0].identity_error < 1e-4
    assert isinstance(out["op11_whitening"][0].deviation, int) and {r.n for r in out["op11_whitening"]} == {100}
    assert {r.conv_id for r in out["op12_conversation_repair"]} == set(range(20)) and all(len(r.repaired_sha256) == 64 and set(r.audit) <= set("DIKR") for r in out["op12_conversation_repair"])
    assert len(out["op13_simhash"]) == 151 and all(len(r.fingerprint) == 16 for r in out["op13_simhash"]) and [r.fingerprint for r in out["op13_simhash"] if r.doc_id == 150] == ["0" * 16]
    texts, fold = {i: t or "" for i, t, *_ in rows}, lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    for r in out["op1_packing"]:
        ids = np.array([*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 2], dtype="<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in out["op1_packing"]) == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts.values())
    for name, least in (("op4_toxicity", 0.5), ("op8_quality_classifier", 0.3)):
        assert {r.doc_id for r in out[name]} == set(texts)
        assert all(r.held_out == fold(r.doc_id) and r.predicted == int(r.score >= least) and 0 <= r.score <= 1 for r in out[name])
    for r in out["op10_secret_scan"]:
        base = ((r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 12, re.IGNORECASE | re.ASCII), (r"AKIA[A-Z0-9]+()", 18, 0), (r"[0-9a-f]+()", 16, 0))
        spans = [(m.start(), m.end(), k) for k, (p, least, flags) in enumerate(base) for m in re.finditer(p, texts[r.doc_id], flags) if len(m[2] if k == 0 else m[0]) >= least]
        said = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2])))
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest() and (r.n_assign, r.n_hex) == (sum(k == 0 for *_, k in spans), sum(k == 2 for *_, k in spans))
    assert [(r.query_id, r["rank"]) for r in sorted(out["op5_nearest_neighbours"], key=lambda r: (r.query_id, r["rank"]))] == [(q, k) for q in range(0, 100, 20) for k in range(1, 21)]
    assert sorted((r.page_id, r.text, r.n_chars) for r in out["op6_html_extraction"]) == [(1, "a b c d e f", 11), (2, "", 0)]
    sets = {i: near_dedup.shingle_set(t, 2) for i, t in texts.items()}
    assert {r.doc_id: r.n_shingles for r in out["op3_near_dedup"]} == {i: len(x) for i, x in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in out["op3_near_dedup"])
    for name in ("op2_line_dedup", "op9_quality_rules"):
        assert sorted(r.doc_id for r in out[name]) == sorted(texts)
    assert {r.doc_id for r in out["op7_mixing"]} == set(texts)
