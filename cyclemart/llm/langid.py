"""Language identification in two steps: the family first, then the language within it.

Features are hashed byte n-grams of the letters. Families are found from the languages themselves: the two
groups of mean profiles that are closest join until the number of families is reached. A linear
one-versus-rest separator picks the family; within it one-versus-one linear support vector machines vote.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclemart.llm.common import held_out, map_columns

UNDETERMINED = "und"
_TO_SPACE = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


@dataclass(frozen=True)
class LanguageSettings:
    """``sample_per_language`` and ``sample`` bound the rows the separators learn from; ``slack`` is how far below nearly
    all learned rows of its length the similarity of a text may lie, and ``enough`` the rows that set a floor."""

    dims: int = 2048
    sample_per_language: int = 1000
    sample: int = 8000
    families: int | None = None
    epochs: int = 30
    penalty: float = 1e-4
    seed: int = 11
    slack: float = 0.15
    enough: int = 5


def has_letter(text: str) -> bool:
    """Whether a character is of a Unicode letter category: superscripts, fractions and Roman number signs are not."""
    return any(map(str.isalpha, text))


def profile(text: str, dims: int) -> np.ndarray:
    """Square roots of hashed 1- to 4-byte counts of the lower-cased letters, at unit length."""
    data = np.frombuffer(b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_TO_SPACE).split()) + b" ", dtype=np.uint8).astype(np.uint32)
    counts = _slot(data, dims)
    code = data
    for n in range(1, 4):
        if len(data) <= n:
            break
        code = code[:-1] * np.uint32(257) + data[n:]
        counts += _slot(code + np.uint32(n << 28), dims)
    counts = np.sqrt(counts)
    length = np.linalg.norm(counts)
    return counts / length if length else counts


def _slot(code: np.ndarray, dims: int) -> np.ndarray:
    return np.bincount(((code * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(dims), minlength=dims).astype(np.float32)


def find_families(means: np.ndarray, number: int) -> list[list[int]]:
    """Join the two closest groups of languages, by the cosine of their mean profiles, until ``number`` are left."""
    groups = [[i] for i in range(len(means))]
    while len(groups) > number:
        centre = [means[g].mean(axis=0) for g in groups]
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: float(
            centre[p[0]] @ centre[p[1]] / (np.linalg.norm(centre[p[0]]) * np.linalg.norm(centre[p[1]]) + 1e-12)))
        groups[a] += groups.pop(b)
    return [sorted(g) for g in sorted(groups)]


def linear_svm(x: np.ndarray, sign: np.ndarray, s: LanguageSettings) -> np.ndarray:
    """Weights and offset (last) of a linear support vector machine: averaged stochastic subgradient steps on the
    hinge loss, both sides weighing the same."""
    rng = np.random.default_rng(s.seed)
    z = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    side = np.where(sign > 0, len(x) / max(2 * (sign > 0).sum(), 1), len(x) / max(2 * (sign < 0).sum(), 1))
    w, mean, step = np.zeros(z.shape[1]), np.zeros(z.shape[1]), 0
    for _ in range(s.epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(order), 32):
            rows = order[at:at + 32]
            step += 1
            rate = 1 / (s.penalty * step + 1)
            wrong = sign[rows] * (z[rows] @ w) < 1
            w = w * (1 - rate * s.penalty) + rate * ((side[rows] * sign[rows] * wrong) @ z[rows]) / len(rows) * 8
            mean += (w - mean) / step
    return mean


@dataclass
class LanguageModel:
    """``languages`` sorted; without any, every text is undetermined with score 0."""

    settings: LanguageSettings
    languages: list[str] = field(default_factory=list)
    families: list[list[int]] = field(default_factory=list)
    family_weights: np.ndarray | None = None
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    means: np.ndarray | None = None
    floors: tuple[np.ndarray, np.ndarray] | None = None

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.assess(text)[:2]

    def assess(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and likeness. The score only compares the learned languages; likeness is the similarity to the
        nearest of them over the floor for texts of this length: below 1, the text is unlike all that was learned."""
        if not self.languages or text is None or not has_letter(text):
            return UNDETERMINED, 0.0, 0.0
        own = profile(text, self.settings.dims)
        return *self._vote(np.append(own, 1.0)), self._likeness(own)

    def _likeness(self, own: np.ndarray) -> float:
        if self.floors is None:
            return 1.0
        size, floor = self.floors
        filled = np.log2(max(np.count_nonzero(own), 1))
        # Parts that hit the mean alike make the cosine grow as the root of their number.
        least = np.interp(filled, size, floor) * 2 ** (min(filled - size[0], 0) / 2)
        return float((self.means @ own).max() / max(least, 1e-9))

    def _vote(self, x: np.ndarray) -> tuple[str, float]:
        family, score = 0, 1.0
        if len(self.families) > 1:
            margins = self.family_weights @ x
            family = int(np.argmax(margins))
            score = _certainty(margins[family] - np.partition(margins, -2)[-2])
        members = self.families[family]
        if len(members) == 1:
            return self.languages[members[0]], score
        votes = dict.fromkeys(members, 0.0)
        for a, b in combinations(members, 2):
            p = _certainty(self.pairs[a, b] @ x)
            votes[a] += p
            votes[b] += 1 - p
        best = max(members, key=lambda m: (votes[m], -m))
        return self.languages[best], score * votes[best] / (len(members) - 1)


def _certainty(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(2 * margin, -30, 30))))


def similarity_floors(x: np.ndarray, means: np.ndarray, s: LanguageSettings) -> tuple[np.ndarray, np.ndarray] | None:
    """Least similarity to the nearest mean, by the binary logarithm of the slots a profile fills: of the learned rows of
    each half octave all but a hundredth lie ``slack`` above it. None if no half octave has ``enough`` rows."""
    nearest, half = (x @ means.T).max(axis=1), np.floor(2 * np.log2(np.maximum(np.count_nonzero(x, axis=1), 1)))
    known = [h for h in np.unique(half) if (half == h).sum() >= s.enough]
    if not known:
        return None
    return np.array([h / 2 + 0.25 for h in known]), np.array([max(np.quantile(nearest[half == h], 0.01) - s.slack, 0) for h in known])


def train(x: np.ndarray, y: Sequence[str], s: LanguageSettings = LanguageSettings()) -> LanguageModel:
    languages = sorted(set(y))
    model = LanguageModel(s, languages)
    if not languages:
        return model
    code = np.searchsorted(np.array(languages), np.array(y))
    means = np.array([x[code == i].mean(axis=0) for i in range(len(languages))])
    model.means = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    model.floors = similarity_floors(x, model.means, s)
    number = s.families or max(1, int(np.ceil(np.sqrt(len(languages)))))
    model.families = find_families(means, number)
    of = np.empty(len(languages), dtype=int)
    for f, members in enumerate(model.families):
        of[members] = f
    family = of[code]
    if len(model.families) > 1:
        model.family_weights = np.array([linear_svm(x, np.where(family == f, 1.0, -1.0), s) for f in range(len(model.families))])
    for members in model.families:
        for a, b in combinations(members, 2):
            rows = (code == a) | (code == b)
            model.pairs[a, b] = linear_svm(x[rows], np.where(code[rows] == a, 1.0, -1.0), s)
    return model


def fit(docs: DataFrame, s: LanguageSettings = LanguageSettings(), text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> LanguageModel:
    """Learn from rows that are not held out and whose text and language are known.

    At most ``sample_per_language`` rows of a language and ``sample`` in all, those of smallest hash of the id, are
    turned into profiles and collected. Of each language only the part of the hash range that holds four times as many is
    ordered, so a language with most of the rows is no large group.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(doc_id)).select(
        F.col(lang).cast("string").alias("_lang"), F.col(text).cast("string").alias("_text"), F.xxhash64(doc_id).alias("_order"))
    # The cut is decided on hashes alone; only the texts it keeps are read again.
    ids = known.select("_lang", "_order").distinct()
    share = ids.groupBy("_lang").agg((F.lit(4.0 * s.sample_per_language) / F.count("*")).alias("_share"))
    near = ids.join(share, "_lang").where(F.shiftrightunsigned("_order", 11) < F.col("_share") * float(1 << 53))
    first = F.shiftrightunsigned("_order", 11)
    ranked = near.withColumn("_n", F.row_number().over(Window.partitionBy("_lang").orderBy(first, "_order"))).where(F.col("_n") <= s.sample_per_language)
    chosen = ranked.orderBy("_n", "_lang").limit(s.sample).select("_lang", "_order")
    few = known.join(F.broadcast(chosen), ["_lang", "_order"])

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"profile": pa.array([profile(v.as_py(), s.dims).astype(np.float16).tobytes() for v in batch.column("_text")], pa.binary())}

    rows = map_columns(few, compute, [T.StructField("profile", T.BinaryType())], ["_lang", "_order"]).groupBy("_lang", "_order").agg(F.max("profile").alias("profile")).collect()
    rows.sort(key=lambda r: (r._lang, r._order))
    x = np.array([np.frombuffer(r.profile, dtype=np.float16) for r in rows], dtype=np.float32).reshape(len(rows), s.dims)
    return train(x, [r._lang for r in rows], s)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None, likeness: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), and ``likeness`` if asked for; columns of these names are replaced.

    Null texts and texts without a letter are ``und`` with score and likeness 0. Whole texts are read; each row stands for itself.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # (families + pairs) * dims weights

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = [shared.value.assess(v.as_py()) for v in batch.column(text)]
        kinds = (pa.string(), pa.float64(), pa.float64())
        return {f.name: pa.array([row[k] for row in found], kinds[k]) for k, f in enumerate(fields)}

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if likeness:
        fields.append(T.StructField("likeness", T.DoubleType()))
    return map_columns(docs, compute, fields, docs.columns if keep is None else keep)
