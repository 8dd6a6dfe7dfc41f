"""Registered queries of the text operators: each applies one operator, with production parameters, to its table."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import cyclemart
from cyclemart.llm import (centroids, chat, decontaminate, divergence, extract, langid, packing, quality, rules, simhash, token_counts,
                           vectors, warc)
from cyclemart.llm.common import held_out, materialise, table

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, once per application, wherever they start."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(cyclemart.__file__))
    # The driver serves the file as long as the application lives.
    path = os.path.join(tempfile.mkdtemp(prefix="cyclemart-code-"), "cyclemart.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    archive.write(full, os.path.join("cyclemart", os.path.relpath(full, root)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def packing_settings() -> packing.PackingSettings:
    return packing.PackingSettings(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels").select("doc_id", "quality"))
    return quality.score(docs, model, keep=["doc_id"]).withColumn("held_out", held_out("doc_id"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), packing_settings())


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with an assistant turn against itself with another reply, and conversations that open alike."""
    whole = materialise(chat.conversations(table(spark, folder, "conversations")), "chat-conversations")
    siblings = chat.named_pairs(whole, chat.pair_by_opening(whole))
    return chat.preference_examples(chat.reply_swaps(whole).unionByName(siblings))


def op9_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    return langid.identify(docs, model, keep=["doc_id"]).withColumn("held_out", held_out("doc_id"))


def op10_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(table(spark, folder, "pages"), keep=["page_id", "url"])


def op11_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.apply_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergences(table(spark, folder, "documents"))


def op13_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.with_totals(centroids.cluster(table(spark, folder, "embeddings")))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: _shipped(q) for q in (
        op1_quality, op2_token_counts, op3_packing, op4_simhash, op5_vectors, op6_decontaminate, op7_warc, op8_chat, op9_langid,
        op10_extract, op11_rules, op12_divergence, op13_clusters)
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op6_decontaminate": r"""WITH texts AS (SELECT doc_id, row_number() OVER () AS r,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    cuts AS (SELECT DISTINCT item_id, w[i:i + 12] AS k FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
    lengths AS (SELECT DISTINCT len(k) AS n FROM cuts),
    places AS (SELECT r, i, n, w[i:i + n - 1] AS k FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, lengths WHERE len(w) >= n)),
    found AS (SELECT r, i, n, item_id FROM places JOIN cuts USING (k)),
    hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r),
    named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM texts LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
    "op11_rules": r"""WITH texts AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
    cut AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
    grams AS (SELECT r, i, w[i:i + 4] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM cut WHERE len(w) >= 5)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
    hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
    base AS (SELECT r, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
             FROM cut LEFT JOIN hit USING (r)),
    judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             unnest([{'rule': 1, 'v': least(1000, 1000 * n_symbols // greatest(word_chars, 1))}, {'rule': 2, 'v': least(1000, 1000 * n_dup_lines // greatest(n_lines, 1))},
                     {'rule': 3, 'v': least(1000, 1000 * n_repeat_words // greatest(n_words, 1))}, {'rule': 4, 'v': least(1000, 10 * word_chars // greatest(n_words, 1))}], recursive := true)
             FROM base),
    labelled AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL AND {learned} GROUP BY doc_id),
    counted AS (SELECT stratum, rule, v, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad FROM judged JOIN labelled USING (doc_id) WHERE NOT base_failed GROUP BY ALL),
    tests AS (SELECT count(*) AS m FROM (SELECT DISTINCT stratum, rule FROM counted WHERE good > 0)),
    tried AS (SELECT stratum, rule, v, sum(good) OVER w AS n_good, sum(bad) OVER w AS n_bad, coalesce(sum(good) OVER a, 0) AS k, coalesce(sum(bad) OVER a, 0) AS kb
              FROM counted WINDOW w AS (PARTITION BY stratum, rule), a AS (PARTITION BY stratum, rule ORDER BY v DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    tails AS (SELECT stratum, rule, v, n_good, n_bad, k, kb, list_sum(list_transform(range(0, CAST(k + 1 AS BIGINT)), lambda i: CASE WHEN n_good = 0 THEN 1 ELSE
              exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln(0.005) + (n_good - i) * ln(0.995)) END)) AS p FROM tried WHERE k < n_good * 0.005),
    allowed AS (SELECT stratum, rule, v, kb / n_bad - 10 * k / n_good AS gain FROM tails, tests WHERE p * m <= 0.05 AND n_bad > 0),
    cutoffs AS (SELECT stratum, rule, max({'gain': gain, 'v': v}).v AS cutoff FROM allowed WHERE gain > 0 GROUP BY ALL)
SELECT any_value(doc_id) AS doc_id, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols, any_value(n_dup_lines) AS n_dup_lines,
    any_value(n_repeat_words) AS n_repeat_words, any_value(base_failed) AS base_failed, NOT any_value(base_failed) AND NOT bool_or(coalesce(j.v > c.cutoff, false)) AS kept
FROM judged j LEFT JOIN cutoffs c USING (stratum, rule) GROUP BY r""",
    "op12_divergence": r"""WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    found AS (SELECT lang, source, r, unnest(w) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS total FROM found GROUP BY ALL HAVING count(DISTINCT r) >= 3),
    v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    cells AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    sizes AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM groups LEFT JOIN cells USING (lang, source) GROUP BY ALL),
    dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n::HUGEINT + v.v) AS p,
              1 + 1000000000::HUGEINT * (k.total + 1) // (v.n::HUGEINT + v.v) AS q
              FROM sizes g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
              FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
              FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
              UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM dense WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 200""",
}


def _cluster_sql(s: centroids.ClusterSettings = centroids.ClusterSettings()) -> str:
    """Each round as two tables: the nearest centroid of every vector, then the centroids of the next round."""
    steps = [
        f"""vectors AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({s.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = {s.dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {s.dims})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{s.salt}' || vec_id), v) - 1 AS c, v FROM vectors QUALIFY c < {s.k})",
    ]
    for k in range(s.rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT r, c, CAST(list_sum(list_transform(range(1, {s.dims + 1}),
            lambda i: (x.v[i] - y.v[i]) * (x.v[i] - y.v[i]))) AS BIGINT) AS d FROM vectors x, c{k} y) GROUP BY r)""")
        if k < s.rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{k} o LEFT JOIN (SELECT c, list((t - ((t % n) + n) % n) // n ORDER BY i) AS v FROM
            (SELECT c, i, sum(v[i]) AS t, count(*) AS n FROM a{k} JOIN vectors USING (r), range(1, {s.dims + 1}) g(i) GROUP BY ALL) GROUP BY c) m USING (c))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(list_transform(z.v, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM a{s.rounds} JOIN vectors USING (r) JOIN c{s.rounds} z USING (c)"""

#: crc32 of an id as text, bit by bit: rows no model may learn from have a remainder of 0.
_HELD_OUT = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 5 = 0"""
ORACLE["op11_rules"] = ORACLE["op11_rules"].replace("{learned}", f"NOT {_HELD_OUT}")

ORACLE["op13_clusters"] = _cluster_sql()
