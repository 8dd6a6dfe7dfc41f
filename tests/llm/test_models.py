"""Fitted models on held-out rows, packing against the tokenizer, and the pipeline against its stages done by hand."""

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from compare import differences
from cyclemart.llm import decontaminate, langid, packing, quality, simhash
from cyclemart.llm.common import held_out, table
from cyclemart.llm.queries import ORACLE, QUERIES, packing_settings
from pyspark.sql import functions as F
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.01"
TEXTS = [None, "", " ", "a", "###!!", "日本語 テキスト", "Der Der Der Der", "word " * 30000, "a", "\x00퟿", "ALL CAPS!! NOW!!"]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(None, "x y", "clash", 1)], "doc_id long, text string, score string, predicted int")


def test_held_out_rule(spark):
    rows = spark.createDataFrame([(i,) for i in [*range(200), None]], "doc_id long").select("doc_id", held_out("doc_id").alias("h")).collect()
    assert all(r.h == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


@pytest.fixture(scope="module")
def quality_model(spark, docs):
    return quality.fit(docs, table(spark, FOLDER, "labels"))


def test_quality_ranks_held_out_documents(spark, docs, quality_model):
    scored = quality.score(docs, quality_model, keep=["doc_id"]).where(held_out("doc_id")).join(table(spark, FOLDER, "labels"), "doc_id").collect()
    good = np.array([r.score for r in scored if r.quality == 1])
    bad = np.array([r.score for r in scored if r.quality == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.9
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in scored)


def test_quality_of_odd_texts(odd, quality_model):
    rows = quality.score(odd, quality_model).collect()
    assert len(rows) == len(TEXTS) + 1 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[3] == by[8] and by[0] == by[1] == by[2]
    assert quality.score(odd.limit(0), quality_model).count() == 0


def test_word_vectors_add_up_over_partitions(docs):
    s = quality.QualitySettings(buckets=256, dims=8)
    one, many = (quality.word_vectors(docs.limit(300).repartition(n), s) for n in (1, 5))
    assert (one[1] == many[1]).all() and np.allclose(one[0], many[0])
    sample = [r.text for r in docs.limit(300).select("text").collect()]
    assert one[1].sum() == sum(len(quality.word_ids(t, 256)) for t in sample)
    position, sign = quality.index_vectors(s)
    expected = np.zeros((256, 8))
    for t in sample:
        ids = quality.word_ids(t, 256)
        for i in range(len(ids)):
            for j in range(max(0, i - 2), min(len(ids), i + 3)):
                if i != j:
                    np.add.at(expected[ids[i]], position[ids[j]], sign[ids[j]])
        if expected.any():
            break
    partial = np.zeros(256 * 8)
    ids = quality.word_ids(t, 256)
    quality._accumulate(ids, np.zeros(len(ids)), s, position, sign, partial)
    assert np.allclose(partial.reshape(256, 8), expected)


def test_quality_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(odd, quality.fit(odd, none)).collect()} == {0.5}
    same = spark.createDataFrame([(i, 1) for i in range(9)] + [(None, 0), (3, None)], "doc_id long, quality int")
    assert {r.score for r in quality.score(odd, quality.fit(odd, same)).collect()} == {1.0}


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = (rng.random(3000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    layers, t = quality.fit_network(x, y, quality.QualitySettings())
    p = 1 / (1 + np.exp(-quality._logits(x, layers) / t))
    for low in (0.2, 0.4, 0.6):
        inside = (p >= low) & (p < low + 0.2)
        assert abs(p[inside].mean() - y[inside].mean()) < 0.1


@pytest.fixture(scope="module")
def language_model(docs):
    return langid.fit(docs)


def test_languages_of_held_out_documents(docs, language_model):
    assert language_model.languages == ["de", "en", "es", "fr"] and len(language_model.families) == 2
    found = langid.identify(docs, language_model, keep=["doc_id", "lang"]).where(held_out("doc_id")).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97 and all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_texts(odd, language_model):
    rows = {r.doc_id: r for r in langid.identify(odd, language_model).collect()}
    assert {i for i, r in rows.items() if r.lang_pred == "und"} == {0, 1, 2, 4, 9} and rows[0].score == 0
    assert rows[3].lang_pred == rows[8].lang_pred and rows[7].lang_pred in language_model.languages
    assert langid.identify(odd.limit(0), language_model).count() == 0


def test_language_model_without_or_with_few_languages(spark):
    empty = spark.createDataFrame([(1, "a b", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(empty, langid.fit(empty)).collect()} == {"und"}
    one = spark.createDataFrame([(i, "some words here", "en") for i in range(20)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in langid.identify(one, langid.fit(one)).collect()} == {("en", 1.0)}


def test_families_join_the_closest():
    means = np.array([[1, 0, 0.1], [0.9, 0.1, 0], [0, 1, 0], [0.1, 1, 0.1]], dtype=float)
    assert langid.find_families(means, 2) == [[0, 1], [2, 3]]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD_TOKENS = ["a<|endoftext|>b", "  two  blanks ", "tab\tand\r\nline\n \nend ", "it's 'll we'Ve 12a3 ½x", " nb sp", "x\0y z", "don't.", "a.b,c. d,", "é́ ǅ",
              "one two", "", None, "\n", " ", "." * 3000, "<| x"]


def test_encoder_gives_the_tokenizers_ids(tokenizer):
    encoder = packing.Encoder(packing_settings(), limit=50)
    for text in [*ODD_TOKENS, *TEXTS]:
        expected = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text or ""), dtype=np.uint16).tolist() == expected, text


def check_packing(rows, texts, tokenizer):
    """Every id of every document in one piece, sequences without gaps and of 1024 ids at most."""
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for d, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == ids.keys()
    for whole, groups in ((lambda k, n: n == len(ids[k]), by_doc), (lambda _, n: n <= 1024, by_sequence)):
        for key, parts in groups.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert whole(key, at)
    return len(by_sequence), sum(map(len, ids.values()))


def test_packing_covers_all_tokens(docs, tokenizer):
    rows = packing.pack(docs, packing_settings()).collect()
    sequences, tokens = check_packing(rows, {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}, tokenizer)
    assert tokens / (1024 * sequences) > 0.98


def test_packing_of_odd_texts(spark, tokenizer):
    texts = dict(enumerate([*ODD_TOKENS, *TEXTS]))
    rows = spark.createDataFrame([(i, t, 3) for i, t in texts.items()], "doc_id long, text string, start int")
    check_packing(packing.pack(rows, packing_settings()).collect(), texts, tokenizer)
    assert packing.pack(rows.limit(0), packing_settings()).count() == 0
    twice = packing.pack(rows.where("doc_id = 9").unionAll(rows.where("doc_id = 9")), packing_settings()).collect()
    assert len({(r.sequence_id, r.offset) for r in twice}) == len(twice) and sum(r.length for r in twice) == 2 * twice[0].doc_tokens


def test_related_tails_of_distant_rows_share_a_sequence(spark):
    """Topics of four documents each, of which no two lie within a shard of the input's rows."""
    r = random.Random(9)
    words = [["".join(r.choices("bcdfgklmnprstaeiou", k=9)) for _ in range(12)] for _ in range(400)]
    rows = [(k * 400 + t, " ".join(r.choices(words[t], k=40))) for k in range(4) for t in range(400)]
    sequence = {}
    for x in packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), packing_settings()).collect():
        sequence.setdefault(x.doc_id, set()).add(x.sequence_id)
    met = [bool(sequence[a] & sequence[b]) for t in range(400) for a in range(t, 1600, 400) for b in range(t, a, 400)]
    assert np.mean(met) > 0.2


def test_index_scores_are_bm25():
    s = packing_settings()
    r = np.random.default_rng(3)
    tails = [r.integers(0, 30, r.integers(0, 40)).astype(np.uint16) for _ in range(20)]
    frequency = np.bincount(np.concatenate([np.unique(t) for t in tails]), minlength=s.ids)
    idf = np.maximum(0, np.log((len(tails) - frequency + 0.5) / (frequency + 0.5)))
    mean = np.mean([len(t) for t in tails])
    index = packing.ShardIndex([t.tobytes() for t in tails], idf, mean, s)
    for seed, query in enumerate(tails):
        scores = index.scores(seed)
        for k, t in enumerate(tails):
            if k != seed:
                tf = np.array([(t == q).sum() for q in np.unique(query)])
                expected = (idf[np.unique(query)] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean) + 1e-300)).sum()
                assert scores[k] == pytest.approx(expected)


def test_windows_take_the_best_neighbours_first():
    s = packing_settings()
    text = {0: [1, 2, 3, 4], 1: [7, 8, 9, 10], 2: [1, 2, 3, 5], 3: [7, 8, 9, 11]}
    tails = [np.array(t, dtype=np.uint16).tobytes() for t in text.values()]
    index = packing.ShardIndex(tails, np.ones(s.ids), 4, s)
    assert packing.pack_shard(tails, index, 8) == [[(0, 0, 4), (2, 0, 4)], [(1, 0, 4), (3, 0, 4)]]
    assert packing.pack_shard(tails, index, 6) == [[(0, 0, 4), (2, 0, 2)], [(1, 0, 4), (2, 2, 2)], [(3, 0, 4)]]


def test_pipeline_equals_its_stages_by_hand(spark, docs, quality_model):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "decontaminate", "pack"]
    kept = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, kept = kept, stage(spark, kept, FOLDER).cache()
        assert kept.columns == docs.columns
        a, b = {r.doc_id for r in before.select("doc_id").collect()}, [r.doc_id for r in kept.select("doc_id").collect()]
        assert len(b) == len(set(b)) and set(b) <= a
        if k == 0:
            expected = {r.doc_id for r in quality.score(docs, quality_model, keep=["doc_id"]).where("score >= 0.3").collect()}
            assert set(b) == expected
        if k == 1:
            assert a - set(b) == {r.doc_id for r in before.where("NOT text RLIKE '\\\\p{L}'").collect()}
        if k == 2:
            prints = {r.doc_id: simhash.fingerprint(r.text) for r in before.select("doc_id", "text").collect()}
            for lost in a - set(b):
                assert any(other != lost and (prints[other] ^ prints[lost]).bit_count() <= 3 for other in prints)
            v = np.array([prints[d] for d in b], dtype=np.uint64)
            assert all((np.bitwise_count(v ^ x) <= 3).sum() == 1 for x in v)
        if k == 3:
            found = decontaminate.report(before, table(spark, FOLDER, "benchmark"))
            assert a - set(b) == {r.doc_id for r in found.where("contaminated").collect()}
    texts = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    check_packing(rows, texts, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def test_language_stage_drops_what_is_no_learned_language(spark, docs):
    """Gibberish, symbol soup and other languages go; every document of the corpus with a letter stays."""
    r = random.Random(1)
    mixed = lambda letters, n: " ".join("".join(r.choices(letters, k=r.randint(2, 9))) for _ in range(n))
    bad = [mixed("abcdefghijklmnopqrstuvwxyz", n) for n in (30, 200, 2000)] + [mixed("abcxyz{}();=+-*/<>[]#!$%&0123456789", n) for n in (30, 200, 2000)] + [
        "Szybki brązowy lis przeskakuje nad leniwym psem, gdy słońce zachodzi za wzgórzami, a ludzie wracają do domu z pól",
        "Nopea ruskea kettu hyppää laiskan koiran yli auringon laskiessa kukkuloiden taakse ja miesten palatessa kotiin",
        "Быстрая коричневая лиса перепрыгивает через ленивую собаку, пока солнце садится за холмами",
        "素早い茶色の狐がのろまな犬を飛び越えるとき、太陽は丘の後ろに沈み、人々は畑から家に帰ります"]
    added = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(bad)], "doc_id long, text string")
    kept = corpus_pipeline.keep_language(spark, docs.unionByName(added, allowMissingColumns=True), FOLDER)
    assert {x.doc_id for x in kept.select("doc_id").collect()} == {x.doc_id for x in docs.where("text RLIKE '\\\\p{L}'").select("doc_id").collect()}


def test_near_duplicates_with_null_and_repeated_ids(spark):
    """One row of each group of like texts, whatever the ids: those without one and those that share one stay apart."""
    r = random.Random(4)
    a, b, c, d, e = (" ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(40)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (3, c), (7, d), (7, c), (7, d), (None, c), (9, e), (8, e), (None, None), (None, ""), (11, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((x.doc_id, x.text) for x in corpus_pipeline.drop_near_duplicates(spark, df, FOLDER).collect()), key=str)
    assert kept == sorted([(None, a), (None, b), (3, c), (7, d), (8, e), (11, " ")], key=str)


def test_stages_take_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars int, score string, lang_pred int, key int"
    rows = [(i, t, "en", None, 0, "own", 1, 2) for i, t in enumerate(TEXTS)] + [(None, "no id but words", None, None, None, None, None, None), (3, "a", "en", None, 0, "own", 1, 2)]
    for table_rows in (rows, []):
        df = spark.createDataFrame(table_rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, FOLDER)
            assert out.schema.names == df.schema.names
            assert out.count() <= len(table_rows)
        assert corpus_pipeline.STAGES[-1][1](spark, df, FOLDER).select(F.sum("length")).first()[0] == (None if not table_rows else pytest.approx(60000, rel=1))


def test_queries_are_registered():
    assert sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0]))[0] == "op1_quality" and len(QUERIES) == 10


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert differences(QUERIES[name](spark, folder), ORACLE[name], folder) is None


def test_only_letters_make_a_language():
    assert not any(map(langid.has_letter, ["", "²½Ⅳ", "12 ٣", "_-!", "①"])) and all(map(langid.has_letter, ["1a", "é", "中", "ª"]))


def test_long_words_are_not_remembered():
    from cyclemart.llm import token_counts

    counts = token_counts._Counts(public_tokenizers.path("piece_bpe_32k.model"))
    units, encoder = quality._Units(1 << 14), packing.Encoder(packing_settings())
    long = "ab" * 500_000
    assert counts[long] > 0 and units[long] and len(encoder.ids(long)) > 0
    assert counts["ab"] and units["ab"] and encoder["ab"]
    assert set(counts) == {"ab"} and set(units) == {"ab"} and long not in encoder
