"""Benchmark decontamination with DataFrame functions only.

Texts become words: A-Z in lower case, everything else but digits, letters a-z and characters beyond ASCII
separates. A window is ``size`` consecutive words of a benchmark item; an item of fewer words is one window. The
windows are cut down to the hash of their first words, which is the broadcast set the training text is scanned
against: each word position is one row inside a single generated loop, and all but the hits are gone before
anything is shuffled. Hits are verified word by word; a document word inside an occurrence is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemart.llm.common import materialise

WINDOW = 13
ANCHOR = 4
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A benchmark of more windows than this is joined by a shuffle. A window takes some 200 bytes.
BROADCAST_WINDOWS = 500_000


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() would also change letters beyond ASCII.
    plain = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(plain, SEPARATOR), "")


def windows(benchmark: DataFrame, text: str = "text", item_id: str = "item_id", size: int = WINDOW) -> DataFrame:
    """Distinct windows with the items they come from: ``(anchor, n, window, items)``.

    ``n`` is the number of words, ``window`` the words themselves and ``anchor`` the hash of its first few.
    Items without words have none. A null item id is not listed, its windows are.
    """
    items = benchmark.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = items.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))).alias("start"))
    cut = starts.select("item", F.slice("w", F.col("start"), F.least(F.size("w"), F.lit(size))).alias("window"))
    return cut.groupBy("window").agg(F.collect_set("item").alias("items")).select(
        _anchor("window", F.lit(0), F.least(F.size("window"), F.lit(ANCHOR))).alias("anchor"),
        F.size("window").alias("n"), "window", "items")


def _anchor(array: str, at: Column, n: Column) -> Column:
    """Hash of the ``n`` words from ``at``."""
    return F.xxhash64(*[F.when(F.lit(k) < n, F.get(array, at + k)) for k in range(ANCHOR)])


def occurrences(docs: DataFrame, found: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Rows ``(*keys, same, n_words, at, n, items)``: one with ``at`` -1 for every document, and one for every place
    where a window occurs. ``same`` is a hash of the text, which tells repeated ids apart.

    The benchmark is broadcast as long as it holds at most ``BROADCAST_WINDOWS`` windows; beyond that the
    positions, each with its next few words, are shuffled by their hash.
    """
    size, few, longest = found.agg(F.count("*").alias("n"), F.collect_set(F.least("n", F.lit(ANCHOR))).alias("k"), F.max("n")).first()
    texts = docs.select(*keys, F.xxhash64(F.col(text).cast("string")).alias("same"), words(F.col(text)).alias("w"))
    places = texts.select(*keys, "same", "w", F.size("w").alias("n_words"), F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at"))
    # Windows shorter than an anchor are hashed over fewer words: each such length has its own probe.
    probes = [F.when(F.col("at") >= 0, _anchor("w", F.col("at"), F.lit(k))) for k in sorted(few)]
    if len(probes) > 1:
        rest = F.when(F.col("at") >= 0, F.array(*probes)).otherwise(F.array(F.lit(None).cast("long")))
        places = places.withColumn("probe", F.explode(rest))
    else:
        places = places.withColumn("probe", probes[0] if probes else F.lit(None).cast("long"))
    if size <= BROADCAST_WINDOWS:
        joined = places.join(F.broadcast(found), (F.col("probe") == F.col("anchor"))
                             & (F.slice("w", F.col("at") + 1, F.col("n")) == F.col("window")), "left")
    else:
        narrow = places.withColumn("w", F.slice("w", F.greatest("at", F.lit(0)) + 1, F.lit(longest or 0)))
        hits = narrow.where("at >= 0").join(found, (F.col("probe") == F.col("anchor")) & (F.slice("w", F.lit(1), F.col("n")) == F.col("window")))
        joined = narrow.where("at = -1").unionByName(hits, allowMissingColumns=True)
    return joined.where("at = -1 OR n IS NOT NULL").select(*keys, "same", "n_words", "at", "n", "items")


def report(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
           item_text: str = "text", item_id: str = "item_id", size: int = WINDOW) -> DataFrame:
    """Per document: ``doc_id, same, n_words, n_hit, n_items, items_sha256, contaminated``, next to ``spans``, the hit
    word ranges ``(at, stop)``, merged, first word 0.

    Null, empty and wordless texts have no words and no hits. Repeated rows give a row each. An
    empty benchmark hits nothing. Other columns are ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = materialise(windows(benchmark, item_text, item_id, size), "decontaminate-windows")
    rows = occurrences(source, found, ["doc_id"])
    hit = F.col("at") >= 0
    per = rows.groupBy("doc_id", "same").agg(
        F.count_if(~hit).alias("copies"), F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set(F.when(hit, F.struct(F.col("at").alias("at"), (F.col("at") + F.col("n")).alias("stop"))))).alias("places"),
        F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("items"))))).alias("items"))
    merged = F.aggregate(
        "places", F.expr("CAST(array() AS array<struct<at:int,stop:int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= x["at"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(
                F.try_element_at(done, F.lit(-1))["at"].alias("at"),
                F.greatest(F.try_element_at(done, F.lit(-1))["stop"], x["stop"]).alias("stop")))),
        ).otherwise(F.concat(done, F.array(x))))
    out = per.withColumn("spans", merged)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda t, x: t + (x["stop"] - x["at"]).cast("long"))
    out = out.withColumn("n_hit", n_hit).withColumn("names", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return out.select(
        "doc_id", "same", F.col("n_words").cast("long").alias("n_words"), "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("names", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "spans",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept."""
    bad = report(docs, benchmark, text, doc_id, **how).where("contaminated").select(
        F.col("doc_id").alias("_bad_id"), F.col("same").alias("_bad_same")).distinct()
    return docs.join(bad, docs[doc_id].eqNullSafe(F.col("_bad_id")) & (F.xxhash64(docs[text].cast("string")) == F.col("_bad_same")), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """``docs`` with every hit word, and the separators before it, cut out of the text."""
    hit = report(docs, benchmark, text, doc_id, **how).where("n_hit > 0").select(
        F.col("doc_id").alias("_bad_id"), F.col("same").alias("_bad_same"), F.col("spans").alias("_spans")).dropDuplicates(["_bad_id", "_bad_same"])
    joined = docs.join(hit, docs[doc_id].eqNullSafe(F.col("_bad_id")) & (F.xxhash64(docs[text].cast("string")) == F.col("_bad_same")), "left")
    gap, word = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    chunks = F.regexp_extract_all(text, F.lit(f"{gap}*{word}+"), F.lit(0))
    kept = F.filter(chunks, lambda c, i: ~F.exists("_spans", lambda x: (x["at"] <= i) & (i < x["stop"])))
    tail = F.regexp_extract(text, f"({gap}*)$", 1)
    cleaned = F.when(F.col("_spans").isNull(), F.col(text)).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.withColumn(text, cleaned).select(*docs.columns)
