import hashlib
import itertools
import random
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from millrace.llm import conversation_repair as cr
from millrace.llm import entry, simhash, whitening
from millrace.llm.components import components
from millrace.llm.workspace import Workspace

EMBEDDINGS = "vec_id long, embedding array<double>"
TURNS = "conv_id long, turn long, role string, text string"


def _plain_fingerprint(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _plain_components(prints, max_bits=3):
    """{id: least id reachable} of {id: fingerprints} by all pairs."""
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if any((f ^ g).bit_count() <= max_bits for f in prints[a] for g in prints[b]):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: find(i) for i in prints}


def test_simhash_matches_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "One", "one", "one two", "ONE two three", "x " * 70_000]
    for _ in range(10):
        base = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(5, 260))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 9)}"
            texts.append(" ".join(copy))
    rows = [*enumerate(texts), (5, texts[20]), (None, "one two"), (30, texts[30]), (30, texts[30])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"f": F.lit(1), "mask": F.lit("x"), "fingerprint": F.lit(0)})
    prints = {}
    for i, t in rows:
        prints.setdefault(i, set()).add(_plain_fingerprint(t))
    wanted = _plain_components({i: p for i, p in prints.items() if i is not None})
    got = simhash.near_duplicates(df).collect()
    expected = [(i, f"{_plain_fingerprint(t):016x}", wanted.get(i)) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert len({r.component_id for r in got}) < len(wanted)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_simhash_units_lose_no_link(spark):
    """Dense clusters whose buckets are split many times; every split and both ways to compare are used."""
    rng = random.Random(8)
    prints = set()
    for size, spread in ((500, 9), (120, 5), (60, 64)):
        centre, bits = rng.getrandbits(64), rng.sample(range(64), spread)
        for _ in range(size):
            f = centre
            for b in rng.sample(bits, rng.randint(0, min(4, spread))):
                f ^= 1 << b
            prints.add(f)
    prints |= {rng.getrandbits(64) for _ in range(200)}
    ids = {i: {f} for i, f in enumerate(sorted(prints))}
    wanted = _plain_components(ids)
    signed = {simhash._signed(f): i for i, (f,) in ids.items()}
    classes = spark.createDataFrame([(f,) for f in signed], "f long")
    for unit_rows in (8, 40, 512):
        ws = Workspace(spark, "t")
        units = simhash._buckets(ws, classes, 3, unit_rows)
        assert units.distinct().groupBy("mask", "key").count().agg(F.max("count")).first()[0] <= unit_rows
        links = simhash._links(units, 3, 32).collect()
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in links)
        groups = {}
        for r in components(ws, spark.createDataFrame(links, "a long, b long")).collect():
            groups.setdefault(r.root, set()).add(signed[r.vertex])
        plain = {}
        for i, r in wanted.items():
            plain.setdefault(r, set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in plain.values() if len(g) > 1)


def test_pivots_discard_pairs():
    rng = np.random.default_rng(4)
    f = rng.integers(0, 1 << 64, 600, dtype=np.uint64)
    table = simhash.distances(f, simhash.references(32))
    near = [abs(table[i] - table[j]).max() <= 3 for i, j in itertools.combinations(range(600), 2)]
    assert sum(near) < len(near) / 1000
    g = f ^ np.uint64(0b10101)
    assert (np.abs(table - simhash.distances(g, simhash.references(32))) <= 3).all()


def test_digit_slices_are_exact():
    rng = np.random.default_rng(7)
    for reach in (1 << 8, 1 << 19, 1 << 40, 1 << 62):
        y = rng.integers(-reach, reach, (5000, 3))
        y[0] = [reach - 1, -reach, 0]
        assert np.array_equal(sum(l.astype(object) * (1 << whitening.LIMB * k) for k, l in enumerate(map(lambda l: l.astype(np.int64), whitening.limbs(y)))), y.astype(object))
        plain = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j], strict=True)) for j in range(3)] for i in range(3)]
        assert whitening.gram(y).tolist() == plain
    wide = np.array([[1 << 80, -(1 << 70) - 1], [5, 1 << 66]], dtype=object)
    assert whitening.gram(wide).tolist() == (wide.T @ wide).tolist()


def _plain_whitening(rows, d):
    """Fit list, sums and covariance in exact arithmetic; the components by a plain eigendecomposition."""
    from fractions import Fraction

    x = {i: tuple(int(np.floor(256 * c)) for c in v) for i, v in rows}
    fitted = sorted(set(x.values()))
    n, sums = len(fitted), [sum(v[k] for v in fitted) for k in range(d)]
    means = [Fraction(s, n) for s in sums]
    cov = [[sum((v[i] - means[i]) * (v[j] - means[j]) for v in fitted) / n for j in range(d)] for i in range(d)]
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    return x, n, sums, cov, values[::-1], vectors[:, ::-1]


def test_whitening_matches_plain_arithmetic(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 6)) * np.array([3, 2, 1, 0.5, 0.2, 0.1]) + 1000
    good = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, base[0].tolist()) for i in range(50)] + [(5, base[6].tolist())]
    bad = [(200, None), (201, []), (202, [None] * 6), (203, [float("nan")] + [0.0] * 5), (204, [float("inf")] * 6), (205, [1.0])]
    df = spark.createDataFrame(good + bad, EMBEDDINGS).withColumns({"x": F.lit(1), "w": F.lit("a"), "n": F.lit(3)}).repartition(7)
    x, n, sums, cov, values, vectors = _plain_whitening(list(enumerate(v for _, v in good)), 6)
    got = whitening.whiten(df).collect()
    assert len(got) == 4 * len(good) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    by_row = sorted(((good[i][0], sum((n * c - s) ** 2 for c, s in zip(x[i], sums, strict=True))) for i in x), key=str)
    assert sorted(((r.vec_id, int(r.deviation)) for r in got if r.component == 1), key=str) == by_row
    trace = float(sum(cov[k][k] for k in range(6)))
    for k in range(4):
        plain = sorted((good[i][0], (np.array(x[i]) - np.array(sums) / n) @ vectors[:, k] / np.sqrt(values[k])) for i in x)
        found = sorted((r.vec_id, r.whitened) for r in got if r.component == k + 1)
        turned = sorted((i, -w) for i, w in found)
        assert min(max(abs(a[1] - b[1]) for a, b in zip(side, plain, strict=True)) for side in (found, turned)) < 1e-8
        assert all(abs(r.explained - values[k] / trace) < 1e-9 for r in got if r.component == k + 1)


def test_whitening_edges(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [1.0, 2.0])], EMBEDDINGS)
    got = whitening.whiten(one).collect()
    assert sorted(((r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in got), key=str) == sorted([(i, k, 1, 0, None, 0.0, None) for i in (1, 1, None) for k in (1, 2)], key=str)
    flat = spark.createDataFrame([(i, [float(i), 1.0, 2.0 * i]) for i in range(9)], EMBEDDINGS)
    got = whitening.whiten(flat).collect()
    assert all((r.whitened is not None) == (r.component == 1) and abs(r.explained - (r.component == 1)) < 1e-12 and r.identity_error < 1e-12 for r in got)
    huge = spark.createDataFrame([(i, [1e30 * (i - 1), float(i), 0.0]) for i in range(3)], EMBEDDINGS)
    got = whitening.whiten(huge).collect()
    assert len(got) == 9 and max(r.identity_error for r in got) < 1e-4
    x = [(v, 256 * i) for i, v in enumerate((-(1 << 63), 0, (1 << 63) - 1))]
    assert {r.vec_id: None if r.deviation is None else int(r.deviation) for r in got}[1] == sum((3 * c - s) ** 2 for c, s in zip(x[1], map(sum, zip(*x, strict=True)), strict=True))
    assert whitening.whiten(flat.limit(0)).count() == 0 and whitening.whiten(spark.createDataFrame([(1, None)], EMBEDDINGS)).count() == 0
    assert whitening.whiten(flat.limit(0)).columns == whitening.whiten(flat).columns


def _plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(cr.BLANKS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _plain_repair(rows):
    """(cost, audit, lines) by trying every sequence of edits, inserts up to two in a row at any place."""
    faults, best = _plain_faults(rows), None
    runs = [("", []), *[("I" * k, list(r)) for k in (1, 2) for r in itertools.product(("user", "assistant"), repeat=k)]]

    def legal(roles):
        word = "".join(r[:1] for r in roles)
        word = word[1:] if word[:1] == "s" and len(word) > 1 else word
        return len(word) % 2 == 0 and word == "ua" * (len(word) // 2)

    def walk(i, cost, audit, lines):
        nonlocal best
        for more, roles in runs:
            c, a, li = cost + 3 * len(more), audit + more, lines + [(r, "") for r in roles]
            if best is not None and c > best[0]:
                continue
            if i == len(rows):
                if legal([r for r, _ in li]) and (best is None or (c, a) < best[:2]):
                    best = (c, a, [f"{r}:{t}" for r, t in li])
                continue
            role, text = rows[i]
            walk(i + 1, c + 4, a + "D", li)
            if faults[i] not in ("blank", "duplicate"):
                late = 3 if faults[i] else 0
                if role[:1] in ("s", "u", "a") and role:
                    walk(i + 1, c + late, a + "K", [*li, (role, text)])
                for new in ("user", "assistant"):
                    walk(i + 1, c + 3 + late, a + "R", [*li, (new, text)])

    walk(0, 0, "", [])
    return best


def _plain_row(held):
    held = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in held), key=lambda h: (h[0] is not None, h[0] or 0, h[1], h[2]))
    rows = [(r, x) for _, r, x in held]
    faults, (cost, audit, lines) = _plain_faults(rows), _plain_repair(rows)
    known = [t for t, *_ in held if t is not None]
    pairs = [(a[:1], b[:1]) for (a, _), (b, _) in itertools.pairwise(rows)]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), sum(p not in (("s", "u"), ("u", "a"), ("a", "u")) for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _conversations(rng, n, longest):
    out = []
    for conv in range(n):
        for k in range(rng.randint(1, longest)):
            turn = None if rng.random() < 0.08 else k + rng.choice([0, 0, 0, 5])
            out.append((conv, turn, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "sup"]), rng.choice(["Yes.", "No?", "cut off", "", None, f"é {k}.", " \t", "x.\n"])))
    return out


def test_repairs_match_every_sequence_of_edits(spark):
    rng = random.Random(12)
    rows = _conversations(rng, 40, 5) + [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi.")]
    df = spark.createDataFrame(rows, TURNS).withColumns({"n": F.lit(1), "part": F.lit(2), "open": F.lit("x")}).repartition(5)
    every = spark.createDataFrame([(i,) for i in [*range(42), None]], "conv_id long")
    wanted = {}
    for conv, *held in rows:
        wanted.setdefault(conv, []).append(held)
    wanted = {conv: _plain_row(held) for conv, held in wanted.items()} | {i: (0, 0, 0, 0, 0, 0, "", cr.NOTHING) for i in (40, 41)}
    for segment_rows in (1, 2, 1024):
        got = cr.repair(df, every, segment_rows=segment_rows).collect()
        assert {r.conv_id: tuple(r)[1:] for r in got} == wanted and len(got) == len(wanted)
    assert cr.repair(df.limit(0)).count() == 0


def test_long_conversations_in_parts(spark):
    """One conversation of many segments and tasks, with a text that makes up most of its rows, equals the same solved whole."""
    rng = random.Random(5)
    rows = [(7, rng.randint(0, 900), rng.choice(["user", "assistant", "system"]), rng.choice(["Thanks.", f"Text {rng.randint(0, 99)}.", "cut", ""])) for _ in range(3000)] + [(7, 3, "user", "Thanks.")] * 2000
    rows += [(k, 0, "user", "Hello.") for k in range(5)]
    df = spark.createDataFrame(rows, TURNS)
    whole, parts = (sorted(map(tuple, cr.repair(df, segment_rows=n).collect())) for n in (1 << 20, 37))
    assert whole == parts and len(whole) == 6
    turns = cr.repaired(df, segment_rows=37).where("conv_id = 7").orderBy("part", "seg", "position").collect()
    text = "\n".join(f"{r.role}:{r.text}" for r in turns)
    assert hashlib.sha256(text.encode()).hexdigest() == whole[-1][-1]
    assert sum(r.edit != "I" for r in turns) + whole[-1][-2].count("D") == 5000


def test_macro_codes_are_prefix_free():
    for state, initial in itertools.product(range(4), ("s", "u", "a", "")):
        codes = [c for _, _, c in cr.macros(state, initial)]
        assert not any(a != b and b.startswith(a) for a in codes for b in codes) and len(codes) == len(set(codes))


def test_damage(spark):
    rows = [(c, t, None if t % 5 == 0 else "assistant", "A. b! c?" if t % 3 else None) for c in (None, 1, 2) for t in range(30)] + [(3, None, "system", "x.")]
    wanted = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            x = "" if kind == 1 else x.translate({ord(m): None for m in ".!?"}) if kind == 2 else x
            wanted += [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    got = cr.damage(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)


def test_bytes_that_are_not_utf8(spark):
    spoil = F.expr("concat(text, cast(x'FF' AS string), ' more words here.')")
    docs = spark.createDataFrame([(1, "some words"), (2, "some words"), (3, "")], "doc_id long, text string").withColumn("text", spoil)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert got[1].fingerprint == got[2].fingerprint and got[2].component_id == 1
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], TURNS).withColumn("text", spoil)
    row = cr.repair(turns).first()
    lines = b"\n".join(f"{r}:{t}".encode() + b"\xff more words here." for r, t in (("user", "a"), ("assistant", "b")))
    assert row.audit == "KK" and row.repaired_sha256 == hashlib.sha256(lines).hexdigest()


def test_registered(spark):
    assert {"op11_whitening", "op12_conversation_repair", "op13_simhash"} <= set(entry.QUERIES)
