"""Quality rules, source divergences and exact clustering against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from cyclemart.llm import centroids, divergence, queries, rules
from cyclemart.llm.common import held_out
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.ship(spark)


# rules ------------------------------------------------------------------------------------------

def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(grams)
    hit = {p for i, g in enumerate(grams) if seen[g] > 1 for p in range(i, i + 5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            n < 10 or 100 * len(hit) > 20 * n)


ODD = [None, "", "  \t\n", "a", "\x1c \x85 \xa0", "é" * 9, "x " * 9, "x " * 10, "a b c d e " * 2, "a b c d e f a b c d e", "a\nb\na\n \n \nb\r",
       "one two three four five six seven eight nine ten one two three four five", "# * $ % & | < >", "w" * 1_200_000, "ab cd\n" * 60_000,
       "a b c d a b c d a b c d a b c d", "😀 𝄞 é " * 5, " ".join(str(k) for k in range(150_000))]


def test_measures(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(0, "again a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = rules.measures(docs, ["doc_id"]).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(tuple(r) for r in found.collect()) == sorted((k, *plain_measures(t)) for k, t in rows)


@pytest.mark.parametrize("p", [0.005, 0.2])
def test_binomial_tail(spark, p):
    cases = [(0, 1), (0, 30), (3, 40), (5, 25), (19, 20), (0, 1153), (2, 3000), (40, 12_000), (900, 200_000)]
    rows = spark.createDataFrame(cases, "k long, n long").select("k", "n", rules.binomial_tail(F.col("k"), F.col("n"), p).alias("p")).collect()
    q = Fraction(p)
    for k, n, found in rows:
        if k >= n * p:
            assert found == 1.0
        elif n <= 3000:
            exact = sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
            assert found == pytest.approx(float(exact), rel=1e-8)
        else:
            plain = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
            assert found == pytest.approx(plain, rel=1e-6)


def labelled(spark, n, seed=1):
    """Good documents with few symbols, bad ones with many; in language b nothing tells them apart. Every third row is of one source."""
    r = random.Random(seed)
    rows = []
    for k in range(n):
        lang, good = r.choice("aab"), r.random() < 0.8
        few = good or lang == "b"
        words = [r.choice("abcdefghij") * r.randint(2, 6) + ("#" if r.random() < (0.02 if few else 0.6) else "") for _ in range(40)]
        rows.append((k, " ".join(words), lang, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")


def test_cutoffs_keep_their_promise(spark):
    data = labelled(spark, 4000)
    s = rules.RuleSettings(risk=0.2)
    docs, labels = data.select("doc_id", "text", "lang"), data.select("doc_id", "quality")
    measured = rules.measures(docs, ["doc_id", "lang"], s).withColumns(rules.statistics())
    found = {(r.lang, r.rule): r for r in rules.cutoffs(measured, labels, ["lang"], s).collect()}
    assert ("a", "symbols") in found and found[("a", "symbols")].bad_rejected > 0.9 * found[("a", "symbols")].n_bad
    for row in found.values():
        q = Fraction(s.risk / 4)
        tail = sum(math.comb(row.n_good, i) * q**i * (1 - q) ** (row.n_good - i) for i in range(row.good_rejected + 1))
        assert float(tail) * 8 <= s.failure * (1 + 1e-6)
        assert row.bad_rejected / row.n_bad > s.harm * row.good_rejected / row.n_good
    judged = rules.apply_rules(docs, labels, s).join(data.select("doc_id", "lang", "quality"), "doc_id").withColumn("held", held_out("doc_id"))
    held = {(r.lang, r.quality): r.share for r in judged.where("held AND NOT base_failed").groupBy("lang", "quality").agg(
        F.avg((~F.col("kept")).cast("double")).alias("share")).collect()}
    assert held[("a", 1)] <= s.risk and held[("b", 1)] <= s.risk and held[("a", 0)] > 0.9


def test_cutoffs_equal_brute_force(spark):
    data = labelled(spark, 1500, 2).collect()
    s = rules.RuleSettings(risk=0.3, harm=3.0)
    docs = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in data], "doc_id long, text string, lang string")
    labels = [(r.doc_id, r.quality) for r in data] + [(None, 1), (3, None), (data[0].doc_id, 0)]
    measured = rules.measures(docs, ["doc_id", "lang"], s).withColumns(rules.statistics())
    learned = {r.doc_id for r in docs.where(~held_out("doc_id")).collect()}
    good = {}
    for k, q in labels:
        if k in learned and q is not None:
            good[k] = min(good.get(k, 1), q)
    values = defaultdict(list)
    for r in measured.where("NOT base_failed").collect():
        if r.doc_id in good:
            for rule in rules.RULES:
                values[r.lang, rule].append((r[rule], good[r.doc_id]))
    tests, expected = len(values), {}
    for key, pairs in values.items():
        n, bad = sum(g for _, g in pairs), sum(1 - g for _, g in pairs)
        best = None
        for cut in {v for v, _ in pairs}:
            k, kb = sum(g for v, g in pairs if v > cut), sum(1 - g for v, g in pairs if v > cut)
            p = s.risk / 4
            tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if k < n * p else 1
            gain = kb / bad - s.harm * k / n
            if tail * tests <= s.failure and gain > 0 and (best is None or (gain, cut) > best):
                best = (gain, cut)
        if best:
            expected[key] = best[1]
    found = rules.cutoffs(measured, spark.createDataFrame(labels, "doc_id long, quality int"), ["lang"], s)
    assert {(r.lang, r.rule): r.cutoff for r in found.collect()} == expected and expected


def test_rules_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, kept string, n_words string, h int, _text string, _keep_0 int"
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(None, long, None, "x", "y", 1, "t", 2), (1, None, "a", None, None, None, None, None), (1, long, "a", None, None, None, None, None), (1, long, "a", None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(None, None), (1, 1)], "doc_id long, quality int")
    out = rules.apply_rules(docs, labels)
    assert sorted((r.doc_id is None, r.n_words, r.kept) for r in out.collect()) == [(False, 0, False), (False, 40, True), (False, 40, True), (True, 40, True)]
    assert rules.apply_rules(docs.limit(0), labels).count() == 0
    assert rules.apply_rules(docs, labels.limit(0)).where("kept").count() == 3


def test_rules_run_no_python(spark, plan):
    text = plan(queries.QUERIES["op11_rules"](spark, FOLDER))
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text


# divergences ------------------------------------------------------------------------------------

def plain_divergences(rows, least=3, ranks=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for lang in {r[1] for r in rows}:
        mine = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(fold)), s) for t, lg, s in rows if lg == lang]
        docs = Counter(w for ws, _ in mine for w in set(ws))
        kept = sorted(w for w, n in docs.items() if n >= least)
        counts = defaultdict(Counter)
        for ws, s in mine:
            counts[s].update(w for w in ws if docs[w] >= least)
        whole = sum(counts.values(), Counter())

        def p(c, w):
            return 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))

        def far(x, y):
            return (x - y) ** 2 // y

        for s in counts:
            parts = {"pair": [(o, sum(far(p(counts[s], w), p(counts[o], w)) for w in kept)) for o in counts if o != s],
                     "term": [(w, far(p(counts[s], w), p(whole, w))) for w in kept if counts[s][w] and p(counts[s], w) > p(whole, w)]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items, 1) if part == "pair" or k <= ranks]
    return sorted(out)


@pytest.mark.parametrize("s", [divergence.AuditSettings(), divergence.AuditSettings(ranks=2, cells=3, block=2), divergence.AuditSettings(spill_bytes=1)])
def test_divergences(spark, s):
    r = random.Random(7)
    words = ["a", "B", "b", "É", "é", "ñu", "ź", "x1y", "don't", "😀", "ß", "longer"]
    rows = [(" ".join(r.choices(words, range(12, 0, -1), k=r.randint(0, 30))), r.choice(["en", "de", None]), r.choice(["s0", "s0", "s1", "s2", "ü", None])) for _ in range(80)]
    rows += [(None, "fr", "s1"), ("only one", "fr", "s2"), (None, None, None), ("x" * 1_100_000, "en", "s9"), ("", "xx", "lonely")] + rows[:5]
    docs = spark.createDataFrame([(*x, k, "clash") for k, x in enumerate(rows)], "text string, lang string, source string, term int, value string")
    found = divergence.divergences(docs.repartition(3), s)
    assert sorted(tuple(x) for x in found.collect()) == plain_divergences(rows, ranks=s.ranks)
    assert divergence.divergences(docs.limit(0), s).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(0, 1), (5, 7), (8_999_999_999, 10**10), (9_000_000_000, 10**10), (9 * 10**17, 9 * 10**18)]
    found = spark.createDataFrame(cases, "n long, d long").select("n", "d", divergence.share(F.col("n"), F.col("d")).alias("p")).collect()
    assert all(p == 1 + 10**9 * (n + 1) // d for n, d, p in found)


# clusters ---------------------------------------------------------------------------------------

def plain_clusters(rows, s):
    import hashlib
    x = [[math.floor(s.scale * c) for c in v] for _, v in rows]
    seeds = sorted(range(len(rows)), key=lambda k: (hashlib.sha256(f"{s.salt}{'' if rows[k][0] is None else rows[k][0]}".encode()).hexdigest(), rows[k][1]))[:s.k]
    c = [x[k] for k in seeds]
    for done in range(s.rounds + 1):
        near = [min((sum((p - q) ** 2 for p, q in zip(v, y, strict=True)), j) for j, y in enumerate(c)) for v in x]
        if done < s.rounds:
            for j in range(len(c)):
                mine = [v for v, (_, a) in zip(x, near, strict=True) if a == j]
                if mine:
                    c[j] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    return sorted((str(rows[k][0]), near[k][1], near[k][0]) for k in range(len(rows))), c


@pytest.mark.parametrize("seed,scale", [(1, 1024), (2, 1), (3, 2)])
def test_clusters(spark, seed, scale):
    """Coarse scales give many ties and equal vectors."""
    r = np.random.default_rng(seed)
    s = centroids.ClusterSettings(k=6, dims=4, rounds=5, scale=scale)
    rows = [(int(k), [float(c) for c in r.normal(0, 3, 4)]) for k in range(300)] + [(None, [1.0, 2.0, 3.0, 4.0]), (5, [0.0] * 4)]
    rows += rows[:40]
    bad = [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0, None, 1.0, 1.0]), (904, [math.nan, 1.0, 1.0, 1.0]), (905, [math.inf, 1.0, 1.0, 1.0])]
    data = spark.createDataFrame([(*x, "clash", 1.0) for x in rows + bad], "vec_id long, embedding array<double>, a string, distance double").repartition(3)
    found = centroids.cluster(data, s)
    expected, final = plain_clusters(rows, s)
    assert sorted((str(x.vec_id), x.cluster, x.distance) for x in found.rows.collect()) == expected
    assert found.centroids.tolist() == final
    assert found.totals == {c: (sum(x[1] == c for x in expected), sum(x[2] for x in expected if x[1] == c)) for c in range(6)}
    row = centroids.with_totals(found).where("cluster = 1").first()
    assert (row.cluster_inertia, row.inertia) == (found.totals[1][1], sum(x[2] for x in expected))
    assert row.centroid_sha256 == centroids.centroid_hash(found.centroids[1])


def test_bounds_spare_distances(spark):
    r = np.random.default_rng(4)
    middles = r.normal(0, 10, (8, 64))
    rows = [(k, [float(c) for c in middles[k % 8] + r.normal(0, 1, 64)]) for k in range(2000)]
    found = centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert len(found.measured) == 11 and sum(found.measured[1:]) < 0.4 * 10 * 8 * 2000


def test_clusters_of_few_or_no_vectors(spark):
    s = centroids.ClusterSettings(dims=2, rounds=2)
    schema = "vec_id long, embedding array<double>"
    none = centroids.with_totals(centroids.cluster(spark.createDataFrame([(1, None)], schema), s))
    assert none.count() == 0 and none.columns[-1] == "centroid_sha256"
    one = centroids.with_totals(centroids.cluster(spark.createDataFrame([(1, [0.5, -0.5]), (2, None)], schema), s)).collect()
    assert [(x.vec_id, x.cluster, x.distance, x.inertia) for x in one] == [(1, 0, 0, 0)]
    two = centroids.cluster(spark.createDataFrame([(1, [0.5, 1.0]), (1, [0.5, 1.0])], schema), s)
    assert sorted(x.cluster for x in two.rows.collect()) == [0, 0] and two.totals[1] == (0, 0)
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(spark.createDataFrame([(1, [1e300, 0.0])], schema), s)
