"""Training-data operators on hand-made rows and against brute-force versions."""

import base64
import gzip
import hashlib
import html
import itertools
import math
import random
import re
import zlib
from urllib.parse import quote, quote_plus

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tunesmith.llm import (
    catalog,
    common,
    decontaminate,
    jaccard,
    language,
    pages,
    pieces,
    secrets,
    sentences,
    sharding,
    toxicity,
    vectors,
)

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 40_000  # 720 kB
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, hits int, score string, words int"


def docs(spark, rows):
    """Documents with nulls and with columns named like those the operators add."""
    return spark.createDataFrame([(k, t, "en", "s", 1, "n", 1, "x", 2) for k, t in rows], DOCS)


def by_key(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# --- pages --------------------------------------------------------------------------

PAGE = (
    "<html><head><title>t t</title><script>if (a<b) {'</p>'}</script></head><body><nav><a href=x>menu one two</a></nav>"
    "<div class='ad'>buy this now</div><article><h1>Head&amp;line</h1><p>One <b>t</b>wo&nbsp;three\n four</p><!-- c -->"
    "<div class='comments'><p>reader words here</p></div><p>last &lt;par&gt; &am</p></article><footer>foot er</footer></body></html>"
)


def test_page_parts(spark):
    rows = [(1, "u", PAGE), (2, "u", None), (3, "u", ""), (4, "u", "<p>unclosed <i>text"), (5, "u", "<nav>only menu</nav><!-- open"),
            (6, "u", PAGE), (None, None, "<article><p>" + LONG + "</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = by_key(pages.page_report(df), "page_id")
    assert got[1].text == got[6].text == "Head&line One two three four last <par> &am"
    assert (got[2].text, got[2].n_chars, got[3].text, got[5].text) == ("", 0, "", "")
    assert got[4].text == "unclosed text"
    assert got[None].text == LONG.strip() and got[None].n_chars == len(LONG.strip())
    assert pages.page_report(df.limit(0)).count() == 0


def test_pages_against_marked_article(spark):
    for r in catalog.op1_main_text(spark, SF).join(catalog.table(spark, SF, "pages"), ["page_id", "url"]).collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:h1|p|br)>", inner))
        assert r.text == " ".join(b for b in blocks if b)


@pytest.mark.parametrize("markup", ['<img alt="a < b" src=x>', "<img alt='1 <2, 3< 4' src=x>", "<svg/>", '<svg class="i" />',
                                    "<math/>", "<svg><path d='M0'/><text>no</text></svg>", '<a title="x > y" href="#"></a>'])
def test_markup_inside_of_the_article(spark, markup):
    page = "<html><body><nav>menu</nav><article><p>first words here " + markup + " and last words</p></article><footer>end</footer></body></html>"
    other = "<html><body><nav>menu</nav><article><p>one two three four five</p></article><footer>end</footer></body></html>"
    df = spark.createDataFrame([(1, "u", page), (2, "v", other)], "page_id long, url string, html string")
    assert by_key(pages.page_report(df), "page_id")[1].text == "first words here and last words"


# --- vectors ------------------------------------------------------------------------


def test_vectors_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 16))
    rows = [(i, (centres[i % 6] + 0.1 * rng.standard_normal(16)).tolist(), int(i % 6 % 3)) for i in range(300)]
    rows += [(300 + i, rows[i][1], rows[i][2]) for i in range(20)]  # copies
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] + [1.0] * 15, 1), (403, [None] + [1.0] * 15, 1),
             (404, rows[0][1], None), (405, [], 1), (406, [1.0, 2.0], 1), (407, [2.0, 4.0], 1), (408, [1e300] * 16, 2), (409, [1e-300] * 16, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1))
    got = by_key(vectors.near_vectors(df, window=4, passes=6, block=32), "vec_id")
    ok = {k: np.array(v) for k, v, l in rows if v and l is not None and None not in v and np.isfinite(v).all() and any(v)}
    unit = {k: (v / abs(v).max()) / np.linalg.norm(v / abs(v).max()) for k, v in ok.items()}
    label = {k: l for k, _, l in rows}
    links = {k: set() for k, *_ in rows}
    for a, b in itertools.combinations(ok, 2):
        if label[a] == label[b] and len(ok[a]) == len(ok[b]) and unit[a] @ unit[b] >= 0.93:
            links[a].add(b)
            links[b].add(a)
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (len(links[k]), min(seen), k == min(seen)), k
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_passes_grow_with_the_largest_label():
    sizes = [0, 1, 24, 1_000, 100_000, 10_000_000]
    assert [vectors.passes_for(n) for n in sizes] == sorted(vectors.passes_for(n) for n in sizes)
    for n in sizes[3:]:
        bits = np.log2(n / vectors.WINDOW)
        together = (1 - np.arccos(0.93) / np.pi) ** bits
        assert (1 - together) ** vectors.passes_for(n) <= vectors.MISS


def crowded_vectors(n, planted, mutual, dim=64, seed=5):
    """One label around a common direction, with ``planted`` partners of cosine 0.94."""
    rng = np.random.default_rng(seed)
    shared = np.zeros(dim)
    shared[0] = 1.0
    noise = rng.standard_normal((n, dim))
    noise[:, 0] = 0
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    base = np.sqrt(mutual) * shared + np.sqrt(1 - mutual) * noise
    other = rng.standard_normal((planted, dim))
    other -= (other * base[:planted]).sum(axis=1, keepdims=True) * base[:planted]
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    return np.concatenate([base, 0.94 * base[:planted] + np.sqrt(1 - 0.94**2) * other])


@pytest.mark.parametrize("n, planted, mutual", [(20_000, 500, 0.8), (20_000, 500, 0.5), (3_000, 300, 0.9), (3_000, 300, 0.0)])
def test_links_of_crowded_labels(spark, n, planted, mutual):
    vectors_ = crowded_vectors(n, planted, mutual)
    rows = [(i, v.tolist(), "one") for i, v in enumerate(vectors_)]
    frame = pd.DataFrame(rows, columns=["vec_id", "embedding", "label"])
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(spark.createDataFrame(frame)).collect()}
    unit = vectors_ / np.linalg.norm(vectors_, axis=1, keepdims=True)
    want = np.concatenate([(unit[i : i + 2000] @ unit.T >= 0.93).sum(axis=1) - 1 for i in range(0, len(unit), 2000)])
    assert len(got) == len(want) and all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.99 * want.sum() >= 2 * planted * 0.99


def test_labels_beyond_all_passes_are_compared_exactly(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MOST_PASSES", 30)
    vectors_ = crowded_vectors(900, 100, 0.85, dim=24)
    frame = pd.DataFrame([(i, v.tolist(), "one") for i, v in enumerate(vectors_)], columns=["vec_id", "embedding", "label"])
    items = vectors.items_of(vectors.with_node(spark.createDataFrame(frame), "vec_id", "embedding", "label"))
    needed = vectors.passes_needed(vectors.with_mean(items), 0.93, vectors.WINDOW, vectors.LEAST_PASSES).first()
    assert needed.passes is None
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(spark.createDataFrame(frame), block=256).collect()}
    unit = vectors_ / np.linalg.norm(vectors_, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    for i in range(len(unit)):
        seen, todo = {i}, [i]
        while todo:
            new = set(np.flatnonzero(near[todo.pop()]).tolist()) - seen
            seen |= new
            todo += new
        assert got[i] == (near[i].sum() - 1, min(seen)), i


# --- toxicity and language ----------------------------------------------------------


def test_toxicity_learns_misspellings(spark):
    rng = random.Random(5)
    plain = ["house", "river", "garden", "window", "summer", "letter", "yellow", "market"]
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = [rng.choice(plain) for _ in range(40)] + (["horribleword", "nastyfellow"] if toxic else [])
        rows.append((i, " ".join(rng.sample(text, len(text)))))
        marks.append((i, int(toxic)))
    rows += [(1000, "house river horriblewrd garden nastyfelow"), (1001, "house river garden"), (1002, None), (1003, ""),
             (1004, LONG), (None, "x"), (1001, "house river garden")]
    marks += [(5, None), (None, 1), (7, 9)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    found = toxicity.toxicity_report(docs(spark, rows), labels).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and got[1000].predicted == 1 and got[1001].predicted == 0
    assert got[1002].score == got[1003].score and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out and r.doc_id < 400]
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.9
    none = toxicity.toxicity_report(docs(spark, rows), labels.limit(0)).collect()
    assert len(none) == len(rows)
    assert toxicity.toxicity_report(docs(spark, rows).limit(0), labels).count() == 0


def test_language_held_out(spark):
    got = catalog.op9_language(spark, "/root/testdata/sf0.01").join(catalog.table(spark, "/root/testdata/sf0.01", "documents"), "doc_id")
    held = [r for r in got.collect() if r.held_out]
    assert held and np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in held)


def test_language_of_long_texts(spark):
    rows = catalog.table(spark, "/root/testdata/sf0.1", "documents").where("lang IS NOT NULL AND text IS NOT NULL").orderBy("doc_id").collect()
    known = [r for n in ("de", "en", "es", "fr") for r in [r for r in rows if r.lang == n and r.doc_id % 4 != 2][:400]]
    model = language.fit([r.lang for r in known], [r.text for r in known])
    learnt = {r.doc_id for r in known}
    for name in model["names"]:
        text = " ".join(r.text for r in rows if r.lang == name and r.doc_id not in learnt)
        for long in (text[:1_000_000], text):
            column = language.pa.array([long])
            assert len(long) >= 1_000_000 and len(language.presence(column)[0]) < language.WIDTH / 4
            assert language.score_batch(model, column)[0] == [name]


def test_language_edges(spark):
    base = catalog.table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "123 - !"), (9004, LONG), (None, "the and of")], "doc_id long, text string")
    both = base.unionByName(odd, allowMissingColumns=True).withColumn("score", F.lit("x"))
    got = by_key(language.language_report(both))
    assert [got[k].lang_pred for k in (9001, 9002, 9003)] == ["und"] * 3 and got[9001].score == 0
    assert got[9004].lang_pred in {"en", "de", "fr", "es"} and got[None].held_out is False
    assert {r.lang_pred for r in language.language_report(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.language_report(both.limit(0)).count() == 0


# --- n-gram Jaccard join ------------------------------------------------------------


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def classes_of(rows):
    sets = [(k, shingles(t)) for k, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(sets), 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            up[top(i)] = top(j)
    low = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            low[top(i)] = min(k, low.get(top(i), k))
    return sorted(((k, len(s), low.get(top(i))) for i, (k, s) in enumerate(sets)), key=str)


def near_copies(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(60)]
    rows, key = [], 0
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(text))
            text[at:at] = passage
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(text)
            for _ in range(rng.choice([0, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((key, " ".join(copy)))
            key += 1
    return rows


@pytest.mark.parametrize("block", [8, 2048])
def test_jaccard_brute_force(spark, block, monkeypatch):
    rows = near_copies(60, block) + [(900, None), (901, ""), (902, " \n"), (903, "A b"), (904, "a B"), (904, "a B"), (None, "a b"), (None, "q r"), (905, LONG), (906, LONG + "x")]
    monkeypatch.setattr(jaccard, "SAMPLE_HITS", 10)  # frequent shingles are dealt out
    got = jaccard.jaccard_classes(docs(spark, rows), block=block).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == classes_of(rows)
    kept = jaccard.keep_first(docs(spark, rows), block=block)
    assert kept.columns == docs(spark, rows).columns
    expected = {(k, t) for (k, t), (_, n, c) in zip(sorted(rows, key=lambda r: str((r[0], len(shingles(r[1]))))), classes_of(rows)) if not n or k == c}
    assert {(r.doc_id, r.text) for r in kept.collect()} >= {e for e in expected if e[0] is not None}
    assert {r.doc_id for r in kept.collect()} - {None} == {k for k, n, c in classes_of(rows) if k is not None and (not n or k == c)}
    assert jaccard.jaccard_classes(docs(spark, rows).limit(0)).count() == 0


def texts_with_common_lines():
    """Texts of which many share a line, and few are near copies of each other."""
    rng = random.Random(11)
    lines = [" ".join(f"l{k}w{i}" for i in range(14)) for k in range(13)]
    rows = []
    for i in range(240):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(30, 45))]
        at = rng.randrange(len(own))
        own[at:at] = lines[0 if i % 2 else 1 + i % 12].split()
        rows.append((len(rows), " ".join(own)))
        if i % 24 == 0:
            rows += [(len(rows) + k, " ".join([*own, "tail", f"t{k}"])) for k in range(3)]
    return rows


def copied_rows(monkeypatch):
    """Counts of the rows that are compared in blocks, one entry per call."""
    counts, pairs = [], jaccard.block_pairs

    def counted(*args, **kw):
        done = pairs(*args, **kw)
        counts.append(done.count())
        return done

    monkeypatch.setattr(jaccard, "block_pairs", counted)
    return counts


def test_jaccard_common_lines_join_no_groups(spark, monkeypatch):
    """Texts that only share a line are not copied to the blocks of one large group."""
    rows, counts = texts_with_common_lines(), copied_rows(monkeypatch)
    got = jaccard.jaccard_classes(docs(spark, rows), block=8).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == classes_of(rows)
    assert sum(r.doc_id != r.component_id for r in got) == 30
    assert counts == [40]


def test_near_duplicate_stage_copies_near_copies_only(spark, monkeypatch):
    """The pipeline's stage keeps every text that only shares a line, and one of each class."""
    rows, counts = texts_with_common_lines(), copied_rows(monkeypatch)
    monkeypatch.setattr(jaccard.keep_first, "__defaults__", (*jaccard.keep_first.__defaults__[:-1], 8))
    got = corpus_pipeline.near_duplicate_stage(spark, docs(spark, rows), SF)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(k, t) for k, t in rows if k in {c for *_, c in classes_of(rows)}]
    assert counts == [40]


def test_parities_bound_the_difference():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in (0, 1, 5, 60, 300, 2000)]
    marks = [np.array(x, np.int64).view(np.uint64) for x in zip(*jaccard.parities(sets))]
    for a, x in zip(sets, marks):
        for b, y in zip(sets, marks):
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
    assert len(jaccard.parities([])) == jaccard.PARITIES


@pytest.mark.parametrize("few", [1, 3, 256])
def test_jaccard_lists_of_every_length(spark, few, monkeypatch):
    """The same classes however long a list may be whose pairs are looked at one by one."""
    rows = near_copies(40, few)
    monkeypatch.setattr(jaccard, "FEW", few)
    got = jaccard.jaccard_classes(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == classes_of(rows)


def test_keep_first_with_repeated_keys(spark):
    w, v = "a b c d e f g h i j k l m n o p", "q r s t u v w x y z aa bb cc dd ee ff"
    tail = " and and some other words"
    rows = [(0, w), (1, w + " tail"), (1, v), (3, v + " tail"), (None, w + tail * 9), (None, None)]
    got = sorted(((r.doc_id, r.text) for r in jaccard.keep_first(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(0, w), (1, v), (None, w + tail * 9), (None, None)], key=str)


def test_columns_with_dots_and_other_case(spark):
    """Every operator keeps columns that Spark would resolve otherwise, and replaces its own."""
    df = spark.createDataFrame([(1, "some text here", 1, 2, 3, 4), (2, None, 1, 2, 3, 4)], "doc_id long, text string, `a.b` int, Depth int, CLEAN int, Hits int")
    items = spark.createDataFrame([(1, "some text here")], "item_id long, text string")
    for done in (secrets.scanned(df), secrets.redacted(df), decontaminate.contamination(df, items), sharding.shard(df), sentences.deduplicate(df)):
        rows = done.collect()
        assert len(rows) == 2 and all(r["a.b"] == 1 for r in rows)
        assert len({c.lower() for c in done.columns}) == len(done.columns)
    assert secrets.redacted(df).columns == df.columns


def test_divide_skip_probes_long_lists():
    rng = np.random.default_rng(1)
    common_part = np.arange(1, 41, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common_part, rng.integers(100, 10**6, 12).astype(np.uint64)])) for _ in range(80)]
    sets += [np.unique(np.concatenate([s[:-1], [np.uint64(7 + 10**7)]])) for s in sets[:10]]
    index = jaccard.Sets(sets)
    for i, a in enumerate(sets):
        want = [j for j, b in enumerate(sets) if j != i and 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))]
        assert sorted(index.partners(i, 80).tolist()) == want


# --- secrets ------------------------------------------------------------------------


def test_secret_layers():
    plain = "x password=hunter2hunter2 y"
    for coded in (quote(plain, safe=""), quote(quote(plain, safe=""), safe=""), base64.b64encode(plain.encode()).decode(),
                  base64.urlsafe_b64encode(gzip.compress(plain.encode(), mtime=0)).decode(), "".join(f"\\u{ord(c):04x}" for c in plain),
                  base64.b64encode(zlib.compress(base64.b64encode(plain.encode()))).decode(), plain.encode().hex(), "".join(f"&#{ord(c)};" for c in plain)):
        text = f"é {coded} é"
        base, found = secrets.scan(text)
        start, end = next((a, b) for k, a, b, _ in found if k == "assign")
        assert 2 <= start < end <= len(text) - 2, coded
        assert not [b for b in base if b[0] == "assign"]
    base, found = secrets.scan("a%3D " + quote("token") + ": " + "q" * 9)
    assert [(k, a, b) for k, a, b, _ in found] == [("assign", 5, 21)] == base
    _, found = secrets.scan("k password%3Dabcdefgh9 z")
    assert found == [("assign", 2, 22, "u")]
    assert secrets.scan("%2525252525") == ([], [])
    coded = base64.b64encode(b"password=hunter2hunter22").decode()
    nested = base64.b64encode(f"see {coded} and {coded}".encode()).decode()
    _, found = secrets.scan(f"{coded} {nested} {coded}")
    assert len([f for f in found if f[3] == "b"]) == 2 and len([f for f in found if f[3] == "bb"]) == 2
    assert "[SECRET] " in (left := secrets.redact(f"{coded} {coded}", [{"start": a, "end": b} for _, a, b, _ in secrets.scan(f"{coded} {coded}")[1]])) and coded not in left


def test_secret_streams():
    plain = b"x password=hunter2hunter2 y"
    packed, rng = gzip.compress(plain, mtime=0), random.Random(5)
    deep = packed
    for _ in range(3):
        deep = gzip.compress(zlib.compress(deep), mtime=0)
    escaped = lambda raw: "".join(f"\\x{c:02x}" for c in raw)
    members = gzip.compress(bytes(rng.randrange(256) for _ in range(40_000)), mtime=0) + gzip.compress(b"", mtime=0) + packed
    for raw in (gzip.compress(packed), zlib.compress(packed), deep, packed + gzip.compress(b"y" * 50), members, b"\x00\xff head" + packed + b"tail", packed[:-5], zlib.compress(plain)):
        for coded in (base64.b64encode(raw).decode(), raw.hex().upper(), quote(raw, safe=""), "".join(f"%{c:02x}" for c in raw), quote_plus(raw),
                      escaped(raw), repr(raw)[2:-1], "".join(f"\\u{c:04x}" for c in raw), "".join(f"&#{c};" for c in raw), quote(escaped(raw))):
            text = f"é {coded} é"
            assert [(2 <= a < b <= len(text) - 2) for k, a, b, w in secrets.scan(text)[1] if k == "assign" and "z" in w], (raw[:20], coded[:40])
    split = gzip.compress(b"one password=hunt", mtime=0) + gzip.compress(b"er2hunter2 two", mtime=0)  # a member ends anywhere
    assert [f for f in secrets.scan(base64.b64encode(split).decode())[1] if f[0] == "assign"]


def test_secret_stretches():
    plain = b"some words before it, then password=hunter2hunter2 and some words behind it, so that it takes three lines of base64"
    assigns = lambda text: [(a, b) for k, a, b, _ in secrets.scan(text)[1] if k == "assign"]
    for raw in (plain, gzip.compress(plain, mtime=0), b"\x00" + plain + b"\xff\xfe", b"x" * 20 + b"\x01" + plain):
        coded = base64.b64encode(raw).decode()
        for glued in ("blob/" + coded, "key_" + coded, "id-" + coded, "a+b-" + coded, "/" * 7 + coded, coded.rstrip("=") + "-tail"):
            assert assigns(f"see {glued} end"), glued
        for width in (16, 60, 64, 76):
            lines = [coded[i : i + width] for i in range(0, len(coded), width)]
            for text in ("\n".join(lines), "data:\r\n" + "\r\n".join(lines) + "\r\nend", "    " + "\n    ".join(lines) + " end", "blob/" + "\n".join(lines), "\\n".join(lines), "> " + "\n> ".join(lines)):
                assert assigns(text), (width, text)
    coded = base64.b64encode(plain).decode()
    start, end = plain.index(b"password"), plain.index(b" and some")
    text = "\n".join(coded[i : i + 76] for i in range(0, len(coded), 76))
    place = lambda i: i + i // 76
    assert assigns(text) == [(place(start * 8 // 6), place((end * 8 - 1) // 6) + 1)]
    assert assigns("password%00%ff token%3Dabcdefgh9%00 z") and assigns("\\x00\\xfftoken\\x3dabcdefgh9")
    word = base64.b64encode(b"token=abcdefgh9").decode().rstrip("=")
    assert secrets.scan(f"{word}\nHello world")[1] == [("assign", 0, 20, "b")]


def base_findings(text):
    rules = {"assign": (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 8),
             "access": ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), "hex": ("[0-9a-f]+", lambda m: len(m[0]) >= 32)}
    found = [(m.start(), i, m.end(), kind) for i, (kind, (rule, ok)) in enumerate(rules.items()) for m in re.finditer(rule, text, re.A) if ok(m)]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def test_secret_report(spark):
    rows = [(1, None), (2, ""), (3, "TOKEN = 'abcd.efgh' AKIA" + "Q" * 12 + " " + "a1" * 20), (3, "secret:short"), (4, LONG + "api_key=" + "Z" * 8), (None, "passwd: 12345678")]
    rows += [(r.doc_id + 100, r.text) for r in catalog.table(spark, SF, "documents").collect()]
    got = secrets.report(secrets.scanned(docs(spark, rows))).collect()
    assert len(got) == len(rows)
    want = sorted(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_findings(t or "")).encode()).hexdigest() for _, t in rows)
    assert sorted(r.base_sha256 for r in got) == want
    three = [r for r in got if r.doc_id == 3]
    assert sorted((r.n_assign, r.n_access, r.n_hex) for r in three) == [(0, 0, 0), (1, 1, 1)]
    clean = secrets.redacted(docs(spark, [(1, "a password%3Dabcdefgh9 z"), (2, None)]))
    assert [r.text for r in clean.orderBy("doc_id").collect()] == ["a [SECRET] z", None] and clean.columns == docs(spark, []).columns
    assert secrets.report(secrets.scanned(docs(spark, rows).limit(0))).count() == 0


# --- sentence spans -----------------------------------------------------------------


def test_sentence_passages_vanish_whole(spark):
    rng = random.Random(11)
    sentence = lambda n: " ".join(f"v{rng.randrange(10**9)}" for _ in range(n)) + ". "
    lengths = [[40, 12], [25, 5, 5, 5], [12, 40], [5, 5, 5, 25], [30, 3, 30, 3], [3, 50, 3, 3], [19, 19, 19]]
    lengths += [[rng.randint(1, 45) for _ in range(rng.randint(2, 7))] for _ in range(60)]
    rows, want = [], {}
    for i, ns in enumerate(lengths):
        passage = [sentence(n) for n in ns]
        before, behind = sentence(15) + sentence(35), sentence(15) + sentence(3)
        rows += [(2 * i, "".join(passage) + sentence(18)), (2 * i + 1, before + "".join(passage) + behind)]
        rows.append((1000 + i, before.upper().replace("V", "w") + "".join(passage) + sentence(9) + "".join(passage) + "\n\n. "))
        want[2 * i] = []
        want[2 * i + 1] = list(range(2, 2 + len(ns)))
        want[1000 + i] = [*range(2, 2 + len(ns)), *range(3 + len(ns), 3 + 2 * len(ns))]
    own = "".join(sentence(n) for n in (25, 4, 4))
    rows += [(5000, own + sentence(22) + own), (5001, "\n\n" + sentence(25) + "\n\n" + sentence(2) + "\n")]
    want |= {5000: [4, 5, 6], 5001: []}
    got = {r.doc_id: r.removed for r in sentences.deduplicate(docs(spark, rows)).select("doc_id", "removed").collect()}
    assert {k: [i for i in v] for k, v in got.items()} == want


def test_sentence_spans(spark):
    rng = random.Random(2)
    sentence = lambda: " ".join(f"v{rng.randrange(10**6)}" for _ in range(12)) + ". "
    shared = sentence() + sentence() + sentence() + sentence()
    rows = [(1, sentence() + shared + sentence()), (2, sentence() + shared.replace("v", "u") + sentence()), (3, sentence() + shared + sentence()), (4, None), (5, ""),
            (6, "short. short. short. " * 2), (7, shared.upper()), (None, shared), (3, sentence()), (8, LONG), (9, "a " * 35), (10, "a " * 35)]
    done = sentences.deduplicate(docs(spark, rows))
    found = done.collect()
    assert len(found) == len(rows) and "lang" in done.columns
    got = {(r.doc_id, r.text): r for r in found}
    assert got[rows[0]].clean == rows[0][1] and got[rows[1]].clean == rows[1][1]  # first, other words
    assert got[rows[2]].clean == rows[2][1].replace(shared, "") and got[rows[2]].n_removed == 4
    assert got[rows[6]].clean == "" and got[rows[7]].clean == ""
    assert got[rows[8]].n_removed == 0 and got[rows[3]].clean is None and got[rows[4]].clean == ""
    assert got[rows[10]].clean == rows[10][1] and got[rows[11]].clean == rows[11][1]  # one sentence is no run
    assert got[rows[5]].removed == [1, 2, 3, 4, 5]
    assert all("".join(sentences.sentences(t)) == t for _, t in rows if t)
    assert sentences.deduplicate(docs(spark, rows).limit(0)).count() == 0


def test_sentence_scripts_without_spaces(spark):
    rng = random.Random(12)
    rows, want = [], {}
    for i, (low, high, end, gap) in enumerate([(0x4E00, 0x9F00, "\u3002", ""), (0x3041, 0x3096, "\uff01", ""), (0x4E00, 0x9F00, "\uff1f", "\u3000"),
                                               (0x0E01, 0x0E2E, "", " "), (0x1780, 0x17B3, "\u17d4", ""), (0x1000, 0x1020, "\u104b", " ")]):
        sentence = lambda n: "".join(chr(rng.randint(low, high)) for _ in range(n)) + end + gap  # noqa: E731, B023
        passage = [sentence(n) for n in (30, 12, 70, 8, 25)]
        rows += [(2 * i, sentence(20) + "".join(passage) + sentence(50)), (2 * i + 1, sentence(55) + "".join(passage) + sentence(9) + passage[1])]
        want |= {2 * i: [], 2 * i + 1: [1, 2, 3, 4, 5]}
    done = sentences.deduplicate(docs(spark, rows)).collect()
    assert {r.doc_id: r.removed for r in done} == want
    assert all("".join(sentences.sentences(t)) == t for _, t in rows)
    assert "".join(sentences.sentences(t := "ก  ข. ค \n\u3000ง abc  ")) == t


def covered_sentences(rows, longest):
    """Sentences of every run of 2 to ``longest`` sentences with words that is not the first of its kind."""
    first, want = {}, {}
    for key, text in sorted(rows):
        cut = [re.findall(r"[^\x20\x09-\x0D]+", s.translate({c: c + 32 for c in range(65, 91)})) for s in sentences.sentences(text)]
        said = [i for i, words in enumerate(cut) if words]
        gone = set()
        for a in range(len(said)):
            for b in range(a + 2, min(a + longest, len(said)) + 1):
                run = tuple(tuple(cut[i]) for i in said[a:b])
                if first.setdefault(run, (key, a)) != (key, a):
                    gone |= set(range(said[a], said[b - 1] + 1))
        want[key] = sorted(gone)
    return want


def test_sentence_runs_of_every_length(spark):
    rng = random.Random(8)
    said = ["Yes. ", "no! ", "one two? ", "a b c.", "\n\n", "... ", "Long one with several words\n"]
    rows = [(i, "".join(rng.choice(said) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    want = covered_sentences(rows, 99)
    assert want == covered_sentences(rows, 2) and sum(map(len, want.values())) > 50  # runs of two stand for all
    assert {r.doc_id: r.removed for r in sentences.deduplicate(docs(spark, rows)).collect()} == want
    three = sentences.deduplicate(docs(spark, rows), span=3)
    assert {r.doc_id: r.n_removed for r in three.collect()} != {k: len(v) for k, v in want.items()}


def test_sentence_short_runs(spark):
    rows = [(1, "Only here. One two three. Four five six seven."), (2, "And here. One two three. Four five six seven. End.")]
    got = by_key(sentences.deduplicate(docs(spark, rows)))
    assert (got[1].n_removed, got[2].removed, got[2].clean) == (0, [1, 2], "And here. End.")


def test_sentence_spans_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in catalog.table(spark, SF, "documents").collect()]
    want = covered_sentences(rows, 4)
    assert {r.doc_id: r.removed for r in catalog.op6_sentence_dedup(spark, SF).collect()} == want


# --- decontamination ----------------------------------------------------------------


@pytest.mark.parametrize("part_words", [100_000, 7])
def test_decontamination_brute_force(spark, part_words):
    rng = random.Random(8)
    word = lambda: rng.choice("abcde")
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 9, 10, 14, 25])))) for i in range(12)] + [(50, None), (51, ""), (52, "ü-Ä"), (53, "ü-Ä")]
    rows = [(i, " ".join(word() for _ in range(rng.choice([0, 2, 60, 300])))) for i in range(40)]
    rows += [(i + 100, "zz " + t.upper() + "!yy") for i, t in items if t] + [(200, None), (201, ""), (202, "x Ü ä ü Ä"), (None, "q"), (203, LONG)]
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    windows = [(str(i), tuple(w[j : j + 10])) for i, t in items for w in [split(t)] if w for j in range(max(1, len(w) - 9))]
    scanned = decontaminate.contamination(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), part_words=part_words)
    got = by_key(decontaminate.report(scanned))
    for key, text in rows:
        words, hit, names = split(text), set(), set()
        for name, w in windows if len(words) < 10_000 else ():
            for j in range(len(words) - len(w) + 1):
                if tuple(words[j : j + len(w)]) == w:
                    hit |= set(range(j, j + len(w)))
                    names.add(name)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        r = got[key]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(words), len(hit), len(names), digest, bool(hit)), key
    cut = by_key(decontaminate.remove_spans(scanned, min_length=1))
    assert cut[100].text in ("zz yy", "zz !yy") and cut[203].text == LONG
    nothing = decontaminate.contamination(docs(spark, rows), spark.createDataFrame([], "item_id long, text string"))
    assert nothing.where("n_hit > 0").count() == 0 and nothing.count() == len(rows)


# --- pieces -------------------------------------------------------------------------


def test_pieces_equal_the_library(spark):
    import sentencepiece

    rng = random.Random(4)
    model = pieces.load_model(catalog.TOKENIZER)
    library = sentencepiece.SentencePieceProcessor(model_file=catalog.TOKENIZER)
    rows = [(i, "".join(rng.choice("aeintshorld  \n\té123._😀THEing") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "    "), (903, LONG), (None, "a"), (904, "▁ x"), (901, "")]
    coded = pieces.encoded(docs(spark, rows), model)
    for r in pieces.decoded(coded, model).collect():
        assert r.ids == (None if r.text is None else library.encode(r.text))
        assert r.round_trip == (r.text is not None and "▁" not in r.text)
        assert r.decoded == r.text or not r.round_trip
        assert r.n_tokens == len(r.ids or ())
    assert pieces.encoded(docs(spark, []), model).count() == 0


def test_unigram_walk_is_the_best_path():
    vocab = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.5, "▁a": -3.1, "aba": -5.0, "ba": -3.2, "▁ab": -6.0, "c": -4.0}
    model = pieces.Model("unigram", ["<unk>", *vocab], [0.0, *vocab.values()], {0}, [], 0, True)
    encoder = pieces.Encoder(model)

    def best(word):
        if not word:
            return 0.0
        return max(vocab[word[:i]] + best(word[i:]) for i in range(1, len(word) + 1) if word[:i] in vocab)

    for n in range(1, 7):
        for letters in itertools.product("abc", repeat=n):
            word = "".join(letters)
            ids = encoder.encode([word])[0]
            assert encoder.decode(ids) == word
            assert math.isclose(sum(model.scores[i] for i in ids), best("▁" + word))
    assert encoder.encode(["axx"])[0][-1] == 0  # no piece for x


# --- sharding -----------------------------------------------------------------------


def test_shards_split_until_they_fit(spark):
    base = catalog.table(spark, SF, "documents").select("doc_id", "text")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    limit = 6000
    got = sharding.shard(base, limit=limit, step=3)
    want = con.execute(catalog.OP10_SQL.replace(str(sharding.LIMIT_BYTES), str(limit))).fetchall()
    assert sorted(tuple(r) for r in got.drop("text").collect()) == sorted(want)
    assert max(r.depth for r in got.collect()) > 3
    assert all(r.shard_docs == 1 for r in got.collect() if r.oversized)


def test_shards_of_repeated_rows(spark, tmp_path):
    rows = [(1, "same text")] * 50 + [(None, None), (None, ""), (2, "y" * 100), (3, LONG)] + [(4, f"t{i}") for i in range(20)]
    got = sharding.shard(docs(spark, rows), limit=40)
    found = got.collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(rows, key=str)
    total, number = {}, {}
    for r in found:
        total[r.shard] = total.get(r.shard, 0) + r.n_bytes
        number[r.shard] = number.get(r.shard, 0) + 1
    for r in found:
        assert (r.shard_bytes, r.shard_docs, r.oversized) == (total[r.shard], number[r.shard], total[r.shard] > 40)
        assert not r.oversized or r.shard_docs == 1
    sharding.write_shards(got.select("doc_id", "shard"), str(tmp_path / "shards"))
    assert len(list((tmp_path / "shards").glob("shard=*"))) == len(total)
    assert sharding.shard(docs(spark, rows).limit(0)).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- helpers, whole pipeline --------------------------------------------------------


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(50)] + [(5, 5), (7, 6)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_brute_force(spark):
    table = catalog.table(spark, SF, "documents")
    odd = docs(spark, [(9001, None), (9002, "12 34"), (9003, "A b c."), (9004, "a B C."), (9005, "the key password%3Dabcdefgh9 of that"), (9006, LONG),
                       (9008, "这是一个关于语言的很长的句子,没有别的。" * 5), (9015, "Η γλώσσα είναι ελληνική και μεγάλη")])  # keys that are not learnt from
    current = table.unionByName(odd.select(*table.columns))
    item = catalog.table(spark, SF, "benchmark").first().text
    current = current.unionByName(docs(spark, [(9007, "the thing and " + item)]).select(*table.columns))
    rows = {r.doc_id: r.text for r in current.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = common.store(stage(spark, current, SF), "test_stage")
        assert current.columns == table.columns, name
        found = {r.doc_id: r.text for r in current.collect()}
        if name == "language":
            want = {k: t for k, t in rows.items() if t and any(c.isalpha() for c in t) and k not in (9008, 9015)}
        elif name == "near_duplicates":
            want = {k: rows[k] for k, n, c in classes_of(list(rows.items())) if k == c}
        elif name == "decontaminate":
            items = [secrets_words(r.text) for r in catalog.table(spark, SF, "benchmark").collect()]
            windows = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9))}
            want = {k: t for k, t in rows.items() if not any(tuple(w[i : i + 10]) in windows for w in [secrets_words(t)] for i in range(len(w) - 9))}
            assert 9007 in rows and 9007 not in want
        else:
            want = {k: secrets.redact(t, [{"start": a, "end": b} for _, a, b, _ in secrets.scan(t)[1]]) for k, t in rows.items()}
            assert want[9005] == "the key [SECRET] of that"
            bare = {k: t for k, t in rows.items() if not re.search(r"[%\\&]|[A-Za-z0-9+/_-]{16}", t)}
            assert len(bare) > 50 and all(found[k] == redact_base(t) for k, t in bare.items())
        assert found == want, name
        rows = found
    last = corpus_pipeline.STAGES[-1][1](spark, current, SF).collect()
    assert {r.doc_id for r in last} == set(rows) and all(r.round_trip for r in last)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, current.limit(0), SF).count() == 0


def redact_base(text):
    """Spans of the base rules masked, for texts that nothing can be decoded from."""
    out, done = [], 0
    for _, a, b in sorted(base_findings(text), key=lambda f: (f[1], f[2])):
        out += [text[done:a], "[SECRET]"] if a >= done else []
        done = max(done, b)
    return "".join([*out, text[done:]])


def secrets_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate({i: i + 32 for i in range(65, 91)}))
