"""Suffix-array deduplication, periodic runs and whitening, against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunesmith.llm import catalog, periods, suffixes, whitening

SF = "/root/testdata/sf0.001"


def by_key(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- suffix arrays --------------------------------------------------------------------


@pytest.mark.parametrize("letters", [1, 2, 3, 200])
def test_suffix_order(letters):
    rng = np.random.default_rng(letters)
    for _ in range(60):
        text = rng.integers(1, 1 + letters, rng.integers(0, 90)).astype(np.uint8)
        raw = text.tobytes()
        assert suffixes.suffix_order(text, 100).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def repeated(rows, length):
    """``(key, text)`` to (removed, runs, kept bytes): all strings in corpus order, in a dictionary."""
    first, out = {}, {}
    for key, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first.setdefault(raw[i : i + length], (key, i)) != (key, i):
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out[key, text] = gone.count(1), len([r for r in bytes(gone).split(b"\0") if r]), kept
    return out


def test_suffixes_brute_force(spark):
    rng = random.Random(1)
    voc = ["".join(rng.choices("abcdé", k=rng.randint(1, 4))) for _ in range(40)]
    base = [" ".join(rng.choices(voc, k=60)) for _ in range(6)]
    rows = []
    for i in range(120):
        a, b = sorted(rng.choices(range(200), k=2))
        tail = rng.choice(["", "x" * rng.randint(0, 90), "ab" * 60])
        rows.append((i, " ".join(rng.choices(voc, k=rng.randint(0, 20))) + rng.choice(base)[a:b] + tail))
    rows += [(200, None), (201, ""), (202, rows[5][1]), (203, "z" * 400), (204, "z" * 400), (205, rows[3][1]), (205, rows[3][1]), (None, rows[7][1] + "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for length, gram, most in ((40, 16, 10**6), (40, 16, 3), (100, 32, 5), (20, 16, 1)):
        want = repeated(rows, length)
        got = suffixes.deduplicate(df, length=length, gram=gram, most=most).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_removed, len(r.removed), bytes(r.kept)) == want[r.doc_id, r.text], (length, r.doc_id)


def test_suffixes_edges(spark):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(1, words, 7, "x"), (None, words, 8, "y"), (None, words, 8, "y"), (2, None, 9, None), (2, words + "!", 1, ""), (2, words + "?", 2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Kept int, `a.b` string")
    got = suffixes.deduplicate(df)
    assert [c.lower() for c in got.columns] == ["doc_id", "text", "a.b", "kept", "n_bytes", "n_removed", "removed"]
    sizes = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.n_bytes - r.n_removed) for r in got.collect())
    assert sizes == sorted([(False, 1, words, len(words)), *[(True, 0, words, 0)] * 2, (False, 2, "", 0), (False, 2, words + "!", 1), (False, 2, words + "?", 1)]) or sizes == sorted(
        [(False, 1, words, len(words)), *[(True, 0, words, 0)] * 2, (False, 2, "", 0), (False, 2, words + "!", 0), (False, 2, words + "?", 0)]
    )
    assert suffixes.deduplicate(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffixes.deduplicate(df, gram=24)


def test_suffixes_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 150)
    rng = random.Random(4)
    text = "".join(rng.choices("abc ", k=2000))
    rows = [(1, text), (2, "q" * 30 + text[400:1300] + "r" * 30)]
    data = [np.frombuffer(t.encode(), np.uint8) for _, t in rows]
    small = [suffixes.snippets(d, 100, 32) for d in data]
    strings = [np.concatenate([np.arange(a, b + 1) for a, b in zip(s[2], s[3])]).tolist() for s in small]
    assert strings == [list(range(len(d) - 99)) for d in data]  # each string in one snippet
    got = by_key(suffixes.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [(r.start, r.end) for r in got[2].removed] == [(30, 930)] and got[1].n_removed == 0


def test_op11_against_all_strings(spark):
    rows = [(r.doc_id, r.text) for r in catalog.table(spark, SF, "documents").collect()]
    want = repeated(rows, 100)
    got = by_key(catalog.op11_suffix_dedup(spark, SF))
    assert len(got) == len(rows) and sum(w[0] for w in want.values()) > 10_000
    for key, text in rows:
        removed, runs, kept = want[key, text]
        r = got[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len((text or "").encode()), removed, runs, sha(kept))


# --- periodic runs --------------------------------------------------------------------


def all_runs(words, least=24, repeats=3):
    number = {w: i for i, w in enumerate(words)}
    w = np.array([number[x] for x in words], np.int64)
    out = []
    for q in range(1, len(w) // repeats + 1):
        same = np.concatenate([[0], (w[q:] == w[:-q]).astype(np.int8), [0]])
        edges = np.flatnonzero(np.diff(same))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e - s + q >= max(least, repeats * q):
                stretch = w[s : e + q]
                if all((stretch[d:] != stretch[:-d]).any() for d in range(1, q)):
                    out.append((s, e - s + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def made_words(rng):
    words = []
    for _ in range(rng.randint(1, 6)):
        unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, rng.choice([2, 5, 40, 150])))]
        if rng.random() < 0.4:
            unit *= rng.randint(1, 4)
        n = rng.randint(0, rng.choice([20, 200, 600]))
        words += (unit * (n // len(unit) + 1))[:n]
    return words


def test_z_function():
    rng = random.Random(0)
    for _ in range(200):
        words = [rng.randrange(2) for _ in range(rng.randint(0, 30))]
        z = periods.z_function(words)
        for i in range(1, len(words)):
            assert z[i] == next((k for k in range(len(words) - i) if words[k] != words[i + k]), len(words) - i)


def test_blocks_and_tiles_hold_every_run():
    for least, repeats in ((24, 3), (6, 2), (10, 4)):
        for octave in range(12):
            block = periods.block_of(1 << octave, least, repeats)
            for q in range(1 << octave, 2 << octave):
                assert max(least, repeats * q) - q >= 2 * block - 1
    for n in (0, 23, 24, 100, 5000, 100_000):
        for tile in (64, 1000, 1 << 16):
            tiles = periods.tiles_of(n, tile, 24, 3)
            octaves = {o for *_, low, high in tiles for o in range(low, high + 1)}
            assert octaves == (set(range((n // 3).bit_length())) if n >= 24 else set())
            for o in octaves:
                mine = sorted(t for t in tiles if t[2] <= o <= t[3])
                assert mine[0][0] == 0 and mine[-1][1] == n
                assert all(a[1] - b[0] >= min(4 * (2 << o), n) for a, b in zip(mine, mine[1:]))


def test_periods_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{x}" for x in made_words(rng))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, " \t\n"), (153, "a " * 3000), (154, "a b " * 700 + "c"), (155, "A a " * 12), (155, "B " * 30), (None, "x y z " * 8), (156, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for tile, least, repeats in ((1 << 16, 24, 3), (100, 24, 3), (32, 6, 2)):
        got = {(r.doc_id, r.text): r for r in periods.periodic_runs(df, tile=tile, least=least, repeats=repeats).collect()}
        assert len(got) == len(rows)
        for key, text in rows:
            words = (text or "").encode().split()
            want, r = all_runs(words, least, repeats), got[key, text]
            assert ([tuple(x) for x in r.runs], r.n_words) == (want, len(words)), (tile, key)
            best = max(want, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
            assert (best is None and r.strongest is None) or tuple(r.strongest) == best
            gone = {i for s, n, q in want for i in range(s + q, s + n)}
            assert r.collapsed == " ".join(w.decode() for i, w in enumerate(words) if i not in gone)


def test_periods_edges(spark):
    df = spark.createDataFrame([(1, "a " * 30, 1, 2)] * 2, "doc_id long, text string, Runs int, `n.words` int")
    got = periods.periodic_runs(df)
    assert got.columns == ["doc_id", "text", "n.words", "n_words", "runs", "strongest", "collapsed"]
    assert [[tuple(x) for x in r.runs] for r in got.collect()] == [[(0, 30, 1)]] * 2
    assert periods.periodic_runs(df.limit(0)).count() == 0


def test_op12_against_brute_force(spark):
    got = by_key(catalog.op12_periodic_runs(spark, SF))
    for key, text in [(r.doc_id, r.text) for r in catalog.table(spark, SF, "documents").collect()]:
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(key).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        want, r = all_runs(words), got[key]
        best = max(want, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        assert r.n_runs == len(want)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in want))
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        assert r.collapsed_sha256 == sha(b" ".join(w for i, w in enumerate(words) if i not in gone))


# --- whitening ------------------------------------------------------------------------


def turned(values, seed=0):
    """A symmetric matrix with these eigenvalues, and its eigenvectors."""
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(4):
        q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    a = (q * np.array(values, np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize("step", [1.0, 1e-4, 1e-7, 1e-9, 0.0])
def test_eigen_clusters(step):
    values = np.r_[100.0, 90.0, 80.0, 2 + step * np.arange(30, 0, -1), 1 + step * np.arange(31, 0, -1)] if step < 1 else np.arange(64.0, 0, -1)
    a, q = turned(values)
    found, x = whitening.eigen(a)
    assert np.abs(found - np.array(values)).max() < 1e-14
    assert np.abs(x.T @ x - np.eye(64)).max() < 1e-17 and np.abs(a @ x - x * found).max() < 1e-16
    some = slice(None) if step else slice(3)  # equal eigenvalues have no vectors of their own
    assert np.abs(np.abs(x) - np.abs(q))[:, some].max() < 1e-17 * 100 / (step or 10) + 1e-16


def test_eigen_of_nothing():
    for a in (np.zeros((0, 0)), np.zeros((3, 3)), np.full((1, 1), 4.0)):
        values, x = whitening.eigen(a)
        assert np.allclose(values, np.diag(a).astype(float)) and np.allclose((x.T @ x).astype(float), np.eye(len(a)))


def test_limbs():
    whole = np.array([0, 1, -1, 2**62, -(2**62), 2**120 + 5, -(2**120) - 7], object)
    assert whitening.from_limbs(whitening.to_limbs(whole)) == whole.tolist()
    x = np.array([[2**40, -3], [2**50, 2**54]], np.int64)
    assert whitening.exact_product(x).tolist() == (x.astype(object).T @ x.astype(object)).tolist()


def brute_whitening(rows, components):
    """Exact sums and moments in fractions, eigenvectors by 80-bit Jacobi rotations."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    cov = [[Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x), n**3) for j in range(d)] for i in range(d)]
    a = np.array([[np.longdouble(c.numerator // c.denominator) + np.longdouble(float(c % 1)) for c in row] for row in cov])
    trace, q = float(sum(cov[i][i] for i in range(d))), np.eye(d, dtype=np.longdouble)
    for _ in range(30):
        for i in range(d):
            for j in range(i + 1, d):
                if abs(a[i, j]) > 1e-25:
                    turn = np.arctan2(2 * a[i, j], a[i, i] - a[j, j]) / 2
                    g = np.eye(d, dtype=np.longdouble)
                    g[i, i] = g[j, j] = np.cos(turn)
                    g[j, i], g[i, j] = np.sin(turn), -np.sin(turn)
                    a, q = g.T @ a @ g, q @ g
    order = np.argsort(-np.diag(a))[:components]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(r, sums)] for r in x], np.longdouble)
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    return deviation, centred @ q[:, order] / np.sqrt(np.diag(a)[order]), np.diag(a)[order] / trace


def test_whitening_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((60, 6)) * [1, 2, 3, 4, 5, 6]).tolist()
    good = [(i, v) for i, v in enumerate(vectors)] + [(100, vectors[0]), (100, vectors[0])]
    bad = [(200, None), (201, []), (202, [None] + vectors[0][1:]), (203, [float("nan")] + vectors[0][1:]), (204, [float("inf")] * 6), (205, [1e300] * 6), (206, [1.0, 2.0])]
    df = spark.createDataFrame([(k, v, 1, 2) for k, v in good + bad], "vec_id long, embedding array<double>, N int, `a.b` int").repartition(4)
    done = whitening.whitened(df, components=4)
    assert done.columns == ["vec_id", "embedding", "a.b", "n", "deviation", "whitened", "explained", "identity_error"]
    got = sorted(done.collect(), key=lambda r: r.vec_id)
    deviation, z, explained = brute_whitening([v for _, v in sorted(good)], 4)
    assert [r.vec_id for r in got] == sorted(k for k, _ in good)
    sign = np.sign([float(a * b) for a, b in zip(got[0].whitened, z[0])])
    for r, d, want in zip(got, deviation, z):
        assert (r.n, r.deviation) == (62, d)
        assert np.allclose(np.array(r.whitened) * sign, want.astype(float), rtol=1e-12, atol=1e-12)
        assert np.allclose(r.explained, explained.astype(float), rtol=1e-12) and r.identity_error < 1e-12


def test_whitening_edges(spark):
    kind = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [])]):
        assert whitening.whitened(spark.createDataFrame(rows, kind)).count() == 0
    one = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0])], kind)).first()
    assert (one.n, one.deviation, one.whitened, one.explained, one.identity_error) == (1, 0, [0.0, 0.0], [0.0, 0.0], 0.0)
    flat = whitening.whitened(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], kind)).collect()
    assert all(r.whitened[1:] == [0.0, 0.0] and r.explained[0] == 1.0 and r.identity_error < 1e-12 for r in flat)
    wide = spark.createDataFrame([(i, [(-1.0) ** i * 2.0**50, float(i)]) for i in range(8)], kind)
    wide = sorted(whitening.whitened(wide).collect(), key=lambda r: r.vec_id)
    assert [r.deviation for r in wide] == [None] * 8 and all(abs(abs(r.whitened[0]) - 1) < 1e-9 for r in wide)


def test_op13_rows(spark):
    got = catalog.op13_whitening(spark, SF)
    kept = catalog.table(spark, SF, "embeddings").count()
    stats = got.agg(F.count("*").alias("rows"), F.max("identity_error").alias("error"), F.max("n").alias("n"), F.max("component").alias("top")).first()
    assert (stats.rows, stats.n, stats.top) == (32 * kept, kept, 32) and stats.error < 1e-10
    shares = [r.explained for r in got.where("vec_id = 0").orderBy("component").collect()]
    assert shares == sorted(shares, reverse=True) and 0 < sum(shares) < 1
