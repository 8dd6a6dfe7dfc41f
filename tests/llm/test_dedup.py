"""SimHash, vector near-duplicates and decontamination against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from cyclemart.llm import decontaminate, simhash, vectors
from cyclemart.llm.common import components

TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def reachable(ids, linked):
    """Smallest id reachable for each place, by plain search."""
    out = {}
    for start in range(len(ids)):
        if start in out:
            continue
        seen, front = {start}, [start]
        while front:
            at = front.pop()
            new = [k for k in range(len(ids)) if k not in seen and linked(at, k)]
            seen.update(new)
            front += new
        known = [ids[k] for k in seen if ids[k] is not None]
        for k in seen:
            out[k] = min(known) if known else None
    return out


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TO_LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = ["", None, "A b", "a B", "a b c d", "a\tb\x0bc d", "É e f g", "é e f g", "x\xa0y z w", "\x1cq r s", "one two three " * 3000, "  "]


def test_fingerprints():
    for text in TEXTS:
        assert simhash.fingerprint(text) == plain_fingerprint(text), text


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_difference(radius):
    for level in range(3):
        masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(radius, level)]
        assert len(masks) == 2 ** (radius + 1) - 1
        r = random.Random(level)
        for bits in [r.sample(range(64), radius) for _ in range(4000)]:
            difference = sum(1 << b for b in bits)
            assert any(not m & difference for m in masks)


@pytest.mark.parametrize("bucket", [2, 512])
def test_links_join_what_is_near(spark, bucket):
    r = random.Random(5)
    prints = set()
    for _ in range(25):
        centre = r.getrandbits(64)
        for _ in range(12):
            centre ^= sum(1 << b for b in r.sample(range(64), r.randint(0, 4)))
            prints.add(centre)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.component for r in components(simhash.links(nodes, bucket=bucket)).collect()}
    expected = reachable(signed, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert [found.get(p, p) for p in signed] == [expected[k] for k in range(len(signed))]


def test_near_duplicate_documents(spark):
    r = random.Random(2)
    base = [" ".join(r.choices(["ab", "cd", "ef", "gh", "ij", "kl", "mn"], k=400)) for _ in range(6)]
    texts = TEXTS + base + base[:3] + [b.replace("ab", "zz", 1) for b in base] + [b + " tail" for b in base]
    rows = [(100 - i, t, i) for i, t in enumerate(texts)] + [(100, "", 0), (None, base[0], 0), (None, "alone in the world here", 0)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    of = reachable([i for i, _, _ in rows], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    expected = sorted((str(i), p - (1 << 64) if p >> 63 else p, str(of[k])) for k, ((i, _, _), p) in enumerate(zip(rows, prints, strict=True)))
    assert sorted((str(x.doc_id), x.fp, str(x.component_id)) for x in found) == expected
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_long_chains_and_stars(spark):
    r = random.Random(1)
    names = r.sample(range(10**6), 300)
    edges = [(names[i], names[i + 1]) for i in range(120)] + [(names[150], names[150 + k]) for k in range(1, 100)] + [(names[299], names[299])]
    edges += [(b, a) for a, b in edges[:10]]
    found = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {n: min(names[:121]) for n in names[:121]} | {n: min(names[150:250]) for n in names[150:250]}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vector_rows(seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, 16))
    near = [b + rng.normal(size=16) * s for b, s in zip(base[:40], np.linspace(0.05, 0.35, 40), strict=True)]
    v = [*base, *near, *base[:5], *(base[:3] * 1e30), *(base[3:5] * 1e-30)]
    rows = [(i * 7 % 1000, x.astype(np.float32).tolist()) for i, x in enumerate(v)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    return rows + [(2000 + i, x) for i, x in enumerate(odd)] + [(2000, None), (None, base[0].astype(np.float32).tolist())]


@pytest.mark.parametrize("block", [3, 1024])
def test_vectors_link_by_cosine(spark, block):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, n int")
    found = vectors.near_duplicates(df, vectors.VectorSettings(block=block)).collect()
    fine = [x is not None and len(x) == 16 and all(c is not None and np.isfinite(c) for c in x) and any(x) for _, x in rows]
    unit = [np.array(x, dtype=float) / np.linalg.norm(np.array(x, dtype=float)) if ok else None for (_, x), ok in zip(rows, fine, strict=True)]
    linked = lambda a, b: a != b and fine[a] and fine[b] and unit[a] @ unit[b] >= 0.9
    links = sum(linked(a, b) for a, b in itertools.permutations(range(len(rows)), 2))
    got = sum(x.n_links for x in found)
    assert len(found) == len(rows) and 0.9 * links <= got <= links
    of = reachable([i for i, _ in rows], linked)
    exact = sorted((str(rows[k][0]), sum(linked(k, j) for j in range(len(rows))), str(of[k])) for k in range(len(rows)))
    ours = sorted((str(x.vec_id), x.n_links, str(x.component_id)) for x in found)
    assert sum(a == b for a, b in zip(exact, ours, strict=True)) >= 0.9 * len(rows)
    assert all(x.kept == (x.vec_id == x.component_id) for x in found)
    assert [x.n_links for x in found if x.vec_id is not None and x.vec_id >= 2000] == [0] * 8
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_recall_just_above_the_threshold(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    v = np.vstack([a, 0.905 * a + np.sqrt(1 - 0.905**2) * b])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v.astype(np.float32))], "vec_id long, embedding array<float>")
    found = vectors.near_duplicates(df).selectExpr("sum(n_links)").first()[0]
    assert found / 3000 >= 0.9


def test_codes_estimate_without_bias():
    s = vectors.VectorSettings()
    rng = np.random.default_rng(4)
    x, y = vectors.unit(rng.normal(size=(2, 64)))
    guesses = []
    for seed in range(300):
        q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(s.bits, 64)))
        rotated, signs, factor = vectors.encode(np.stack([x, y]), q.T.copy())
        guesses.append(rotated[0] @ np.where(signs[1], 1, -1) / np.sqrt(s.bits) / factor[1])
    assert abs(np.mean(guesses) - x @ y) < 4 * np.std(guesses) / np.sqrt(300)


def plain_report(docs, items, size=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(TO_LOWER))
    windows = {}
    for name, text in items:
        w = split(text)
        for i in range(max(len(w) - size + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(name)
    out = []
    for doc, text in docs:
        w, hit, names = split(text), set(), set()
        for k, of in windows.items():
            for i in range(len(w) - len(k) + 1):
                if tuple(w[i:i + len(k)]) == k:
                    hit.update(range(i, i + len(k)))
                    names |= of
        names = sorted(map(str, names - {None}))
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("limit", [500_000, 0])
def test_decontamination(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    passage = "Alpha, beta gamma; delta EPSILON zeta-eta theta iota kappa lambda mu nu xi omicron pi rho"
    items = [(10, passage), (9, passage), (2, "short One"), (3, "é É x"), (4, None), (5, "..."), (6, "solo"), (None, "nameless item here"), (7, "w1 w2 w3 w4 w5")]
    docs = [
        (1, passage), (2, "before " * 400 + passage.lower() + " after"), (3, "x" + passage), (4, "short one short ONE"), (5, "é É x"), (6, "É É x"), (7, None), (8, ""),
        (9, "..!"), (10, "a solo b"), (10, "a solo b"), (10, "other"), (None, "nameless item here"), (11, "w1 w2 w3 w4"), (12, "w0 w1 w2 w3 w4 w5 " * 3),
        (13, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu omicron"), (14, "pad " * 20000 + "solo"), (15, "short one_short one"),
    ]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, at int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.report(d, b).collect()]
    assert sorted(got, key=str) == sorted(plain_report(docs, items), key=str)
    kept = [r.doc_id for r in decontaminate.remove_documents(d, b).select("doc_id").collect()]
    assert sorted(kept, key=str) == sorted([x[0] for x in plain_report(docs, items) if not x[-1]], key=str)
    assert decontaminate.report(d, b.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.report(d.limit(0), b).count() == 0


@pytest.mark.parametrize("limit", [500_000, 0])
def test_long_windows_are_the_same_on_both_ways(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    item = " ".join(f"w{k}" for k in range(30))
    docs = [(1, f"a {item} b"), (2, " ".join(f"w{k}" for k in range(19)) + " x"), (3, " ".join(f"w{k}" for k in range(5, 26)))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.report(d, b, size=20).collect()]
    assert sorted(got) == sorted(plain_report(docs, [(7, item)], 20)) and max(r[2] for r in got) == 30


def test_vectors_of_several_lengths(spark):
    """Every length has its own links, whatever length most vectors have."""
    rng = np.random.default_rng(8)
    rows = []
    for dims, n in ((64, 200), (3, 60), (300, 20), (5, 1)):
        base = rng.normal(size=(max(n // 4, 1), dims))
        rows += [base[k % len(base)] + rng.normal(size=dims) * rng.choice([0.0, 0.05, 0.3]) for k in range(n)]
    order = rng.permutation(len(rows))
    rows = [rows[k] for k in order]

    def cosine(i, j):
        a, b = rows[i], rows[j]
        return len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9

    df = spark.createDataFrame([(k, [float(x) for x in v], "z") for k, v in enumerate(rows)], "vec_id long, embedding array<double>, dims string")
    found = {r.vec_id: r for r in vectors.near_duplicates(df.repartition(3), vectors.VectorSettings(recall=0.9999, block=16)).collect()}
    ids = list(range(len(rows)))
    expected = reachable(ids, cosine)
    links = {i: sum(cosine(i, j) for j in ids if j != i) for i in ids}
    assert {k: r.n_links for k, r in found.items()} == links and {k: r.component_id for k, r in found.items()} == expected
    assert any(links[k] and len(rows[k]) == 3 for k in ids) and any(links[k] and len(rows[k]) == 300 for k in ids)


@pytest.mark.parametrize("rows", [3_000, 50_000, 2_000_000])
def test_tables_reach_their_recall(rows):
    """Pairs whose code bits agree as those of a pair at the threshold do are brought together often enough."""
    s = vectors.VectorSettings()
    width, tables = vectors.table_plan(rows, s)
    rng = np.random.default_rng(1)
    keys = [rng.choice(s.bits, width, replace=False) for _ in range(tables)]
    same = rng.random((20_000, s.bits)) < 1 - np.arccos(s.threshold) / np.pi
    met = np.zeros(len(same), dtype=bool)
    for bits in keys:
        met |= same[:, bits].all(axis=1)
    assert tables < vectors.MOST_TABLES and s.recall - 0.02 < met.mean() < s.recall + 0.02


def test_spans_are_cut_out(spark):
    d = spark.createDataFrame([(1, "Keep, solo (this) SOLO!"), (2, "nothing"), (3, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "Solo")], "item_id long, text string")
    assert {r.doc_id: r.text for r in decontaminate.remove_spans(d, b).collect()} == {1: "Keep (this!", 2: "nothing", 3: None}
