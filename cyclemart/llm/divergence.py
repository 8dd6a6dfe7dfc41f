"""How the sources of a language differ in their words, by in-mapper stripes.

Each partition folds whole documents into stripes: for every term of a language a hash of its sources, with the number
of documents and occurrences in each. A task whose stripes hold too many cells or bytes spills them as rows and starts anew. Rows are
merged by (language, term) in one shuffle; rare terms end there. A merged stripe holds all that is known of its
term, so the divergences are added up from stripes alone. Only terms' best ranks are ordered, after a cut in each task.

With ``count`` occurrences of a term and ``N`` of all ``V`` kept terms, its smoothed share is
``p = 1 + floor(10**9 * (count + 1) / (N + V))``, and ``floor((p - q)**2 / q)`` is how far share p lies from share q.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemart.llm.common import materialise

#: Terms are runs of letters a-z and characters beyond ASCII, of which every UTF-8 byte is 128 or more.
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
UNIT = 1_000_000_000


@dataclass(frozen=True)
class AuditSettings:
    """``least_docs`` documents keep a term; ``ranks`` terms are listed per group. ``cells`` and ``spill_bytes`` bound the
    stripes a task holds, ``block`` the numbers compared at a time."""

    least_docs: int = 3
    ranks: int = 200
    cells: int = 250_000
    spill_bytes: int = 32 << 20
    block: int = 1 << 20


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in order."""
    return (text or b"").translate(_FOLDED).split()


def _folded(s: AuditSettings):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[str, dict[bytes | None, dict[str, list[int]]]] = {}
        cells = size = 0

        def spill() -> Iterator[pa.RecordBatch]:
            for lang, mine in stripes.items():
                rows = [(term, source, *cell) for term, stripe in mine.items() for source, cell in stripe.items()]
                columns = list(zip(*rows, strict=True))
                kinds = (pa.binary(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(rows), pa.string()), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                    names=["lang", "term", "source", "docs", "n"])

        for batch in batches:
            # Documents of one group are counted together before their terms are looked up in the stripes.
            found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
            for lang, source, text in zip(*[batch.column(c).to_pylist() for c in ("lang", "source", "text")], strict=True):
                occurrences, documents = found.setdefault((lang, source), (Counter(), Counter()))
                words = terms(text)
                occurrences.update(words)
                documents.update(set(words))
                # The stripe of no term lists the sources, those without terms included.
                documents[None] += 1
            for (lang, source), (occurrences, documents) in found.items():
                mine = stripes.setdefault(lang, {})
                for term, docs in documents.items():
                    stripe = mine.get(term)
                    if stripe is None:
                        stripe = mine[term] = {}
                        size += len(term or b"")
                    cell = stripe.get(source)
                    if cell is None:
                        stripe[source] = [docs, occurrences[term]]
                        cells += 1
                    else:
                        cell[0] += docs
                        cell[1] += occurrences[term]
                if cells > s.cells or size > s.spill_bytes:
                    yield from spill()
                    stripes, cells, size = {}, 0, 0
        yield from spill()

    return fold


def stripes(docs: DataFrame, s: AuditSettings = AuditSettings(), text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Merged stripes ``(lang, term, docs, sources)`` of the terms in at least ``least_docs`` documents of their language,
    and for each language one of term null with all its sources. ``sources`` holds ``(source, n)``, ``n`` the occurrences."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))],
                        F.col(text).cast("string").cast("binary").alias("text"))
    spilled = plain.mapInArrow(_folded(s), "lang string, term binary, source string, docs long, n long")
    # Both groupings run on the rows as they were dealt out once.
    dealt = spilled.withColumn("term", F.col("term").cast("string")).repartition("lang", "term")
    merged = dealt.groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return merged.where(F.col("term").isNull() | (F.col("docs") >= s.least_docs))


def share(count: Column, whole: Column) -> Column:
    """Smoothed share of ``count`` occurrences, ``whole`` being N + V: exact for counts of any size."""
    wide = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)"), whole.cast("decimal(19,0)"))
    short = F.call_function("div", UNIT * (F.least(count, F.lit(9_000_000_000)) + 1), whole)
    return 1 + F.when(count < 9_000_000_000, short).otherwise(wide)


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(s: AuditSettings):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each language the sum over terms of the distance of every source from every other."""
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            shares = batch.column("shares")
            lengths = np.diff(shares.offsets.to_numpy())
            flat, start = shares.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
            for lang in set(langs):
                rows = np.flatnonzero(langs == lang)
                width = lengths[rows[0]]
                total = sums.setdefault(lang, np.zeros((width, width), dtype=np.int64))
                step = max(1, s.block // max(width, 1))
                for k in range(0, len(rows), step):
                    p = flat[start[rows[k:k + step]][:, None] + np.arange(width)]
                    for i in range(width):
                        away = p[:, i, None] - p
                        total[i] += (away * away // p).sum(axis=0)
        for lang, total in sums.items():
            width = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * width * width, pa.string()), pa.array(np.repeat(np.arange(width), width), pa.int32()),
                 pa.array(np.tile(np.arange(width), width), pa.int32()), pa.array(total.ravel())], names=["lang", "a", "b", "value"])

    return add


def divergences(docs: DataFrame, s: AuditSettings = AuditSettings(), text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets a source apart from others of its language (part ``pair``,
    item the other source) and from the language as a whole (part ``term``, item a term more frequent in the source).

    Null texts, languages and sources count as empty. Repeated rows count as often as they stand there. Ties
    rank by the item's UTF-8 bytes. A source without terms, or a language without kept terms, has its pairs all the
    same. Other columns are ignored. An empty table gives an empty result. Arithmetic is in whole numbers throughout.
    """
    merged = materialise(stripes(docs, s, text, lang, source), "divergence-stripes")
    kept = merged.where("term IS NOT NULL")
    cells = kept.select("lang", "term", F.inline("sources"))
    # One row per group and per language: small beside the output, which has a row for every two groups of a language.
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept_terms = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = merged.where("term IS NULL").select("lang", F.inline("sources")).drop("n").join(totals, ["lang", "source"], "left").join(
        kept_terms, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"),
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("at"))
    groups = materialise(groups, "divergence-groups")
    whole = groups.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("at", "source", (F.col("total") + F.col("v")).alias("d")))).alias("all"),
        (F.sum("total") + F.max("v")).alias("d"))

    stripe = F.map_from_entries("sources")
    shares = F.transform("all", lambda g: share(F.coalesce(F.try_element_at("_stripe", g["source"]), F.lit(0).cast("long")), g["d"]))
    rows = kept.withColumn("_stripe", stripe).join(whole.select("lang", "all"), "lang").select("lang", shares.alias("shares"))
    sums = rows.mapInArrow(_pair_sums(s), "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    one, other = (groups.select("lang", F.col("source").alias(name), F.col("at").alias(at)) for name, at in (("source", "a"), ("item", "b")))
    pairs = one.join(other, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    counts = kept.select("lang", "term", F.aggregate("sources", F.lit(0).cast("long"), lambda t, x: t + x["n"]).alias("count"), F.inline("sources"))
    placed = counts.join(groups.select("lang", "source", (F.col("total") + F.col("v")).alias("own")), ["lang", "source"]).join(
        whole.select("lang", "d"), "lang").select(
        "lang", "source", "term", share(F.col("n"), F.col("own")).alias("p"), share(F.col("count"), F.col("d")).alias("q"))
    named = placed.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    best = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.ranks)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
