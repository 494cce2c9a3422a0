"""Language identification by hierarchical discrimination.

First the language family is predicted, then one-versus-one linear support
vector machines separate the languages inside that family. Both levels use
the same features: hashed byte trigrams of the words of the whole lower-cased
text, digits and ASCII punctuation read as blanks. A word that stands n times
counts floor(log2(n)) + 1 times, so a line repeated a thousand times does not
outweigh the rest, and a text is normalised by its number of trigrams. A linear score is then the mean weight of a text's trigrams, so a
prediction is one table look-up per byte, in Arrow batches, with no shuffle;
texts of any length are read whole (some 20 bytes of memory per byte of text).

Training texts are featurised on the executors; of each language about
``per_language`` different texts are used (all, if it has no more), chosen by a
hash over all labelled rows. Each machine is fitted in a task of its own on at
most about ``SIDE`` texts of either side, again chosen by hash; the driver
holds the languages' names and the fitted weights, no training text or feature. Families come from
``FAMILIES``; a language that is not listed is a family of its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm.common import materialize, quoted

#: Trigram buckets.
DIM = 1 << 13
#: Different training texts of each language, about (a documented bound, by hash).
PER_LANGUAGE = 400
#: Training texts on either side of one machine, about (a documented bound, by hash).
SIDE = 2000
UNDETERMINED = "und"

#: Families of common ISO 639-1 languages.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
}
_FAMILY_OF = {lang: name for name, langs in FAMILIES.items() for lang in langs}

#: Bytes as features see them: letters and multi-byte sequences stay, the rest is blank.
_BYTES = np.array([b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256)], np.uint32)
_PIECE = 1 << 20
_GRAIN = 1 << 30  # of shares chosen by hash


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a text's words, blanks on either side of
    a word; no trigram spans two words, so order has no say."""
    words = Counter(text.lower().encode("utf-8", "replace").split())
    damped = [w if n == 1 else b"  ".join([w] * n.bit_length()) for w, n in words.items()]
    raw = np.frombuffer(b"  " + b"  ".join(damped) + b"  ", np.uint8)
    b = _BYTES[raw]
    codes = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    codes = codes[codes != 0x202020]
    return ((codes * np.uint32(2654435761)) >> np.uint32(32 - 13)).astype(np.int32)


def features(text: str) -> np.ndarray:
    """Share of each bucket among the trigrams of a text."""
    counts = np.zeros(DIM)
    places = trigrams(text)
    for at in range(0, len(places), _PIECE):
        counts += np.bincount(places[at : at + _PIECE], minlength=DIM)
    return (counts / max(1, len(places))).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def with_letter(text: Column) -> Column:
    """Whether a text has a letter, by the rule of :func:`identify`."""

    @F.pandas_udf("boolean")
    def told(texts):
        import pandas as pd

        return pd.Series([has_letter(t) for t in texts], dtype=bool)

    return told(text)


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear support vector machine (squared hinge loss, classes of equal
    weight) by dual coordinate descent; ``y`` holds 1 and -1. Returns weights
    and bias. ``x`` is not copied."""
    share = {s: len(y) / (2.0 * max(1, (y == s).sum())) for s in (1, -1)}
    extra = np.array([0.5 / (c * share[int(s)]) for s in y])
    diagonal = np.einsum("ij,ij->i", x, x, dtype=np.float64) + 1.0 + extra
    alpha, w, bias = np.zeros(len(y)), np.zeros(x.shape[1]), 0.0
    rng = np.random.default_rng(3)
    for _ in range(rounds):
        change = 0.0
        for i in rng.permutation(len(y)):
            row = x[i].astype(np.float64)
            gradient = y[i] * (row @ w + bias) - 1.0 + alpha[i] * extra[i]
            step = max(alpha[i] - gradient / diagonal[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * row
                bias += step * y[i]
                change = max(change, abs(step))
        if change < 1e-3:
            break
    return w, bias


@dataclass
class LanguageModel:
    """Weights of all machines, a row each, and what they decide between."""

    families: list[list[str]]
    pairs: list[tuple[int, str, str]] = field(default_factory=list)  # (family, a, b): positive says a
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, DIM), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    scale: float = 1.0

    def scores(self, text: str) -> np.ndarray:
        """Margins of all machines on the whole text."""
        places = trigrams(text)
        total = np.zeros(len(self.weights))
        for at in range(0, len(places), _PIECE):
            counts = np.bincount(places[at : at + _PIECE], minlength=DIM)
            total += self.weights @ counts
        return self.scale * (total / max(1, len(places)) + self.bias)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score (0 to 1) of a text."""
        if not has_letter(text) or not self.families:
            return UNDETERMINED, 0.0
        margin = self.scores(text)
        n = len(self.families)
        family, sure = 0, 1.0
        if n > 1:
            family = int(np.argmax(margin[:n]))
            rest = np.delete(margin[:n], family).max()
            sure = 1.0 / (1.0 + np.exp(-np.clip(margin[family] - rest, -30, 30)))
        langs = self.families[family]
        votes = dict.fromkeys(langs, 0.0)
        belief = dict.fromkeys(langs, 1.0)
        for k, (f, a, b) in enumerate(self.pairs):
            if f != family:
                continue
            m = margin[n + k]
            votes[a if m >= 0 else b] += 1
            p = 1.0 / (1.0 + np.exp(-np.clip(2 * m, -30, 30)))
            belief[a] = min(belief[a], p)
            belief[b] = min(belief[b], 1.0 - p)
        best = max(langs, key=lambda lang: (votes[lang], belief[lang]))
        return best, float(min(1.0, max(0.0, sure * belief[best])))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for t in batch.column(2).to_pylist()]
        places = [np.flatnonzero(x) for x in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([at.astype(np.int32) for at in places], pa.list_(pa.int32())),
                pa.array([x[at] for x, at in zip(rows, places, strict=True)], pa.list_(pa.float32())),
            ],
            ["lang", "h", "places", "shares"],
        )


def training_sample(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang``, text hash ``h`` and sparse features (``places``, ``shares``) of
    about ``per_language`` different texts of each language, chosen by hash."""
    usable = labelled.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).select("lang", "text", F.xxhash64(F.lit(5), "text").alias("h"))
    different = usable.select("lang", "h").distinct()  # copies must not thin out the other texts
    below = F.least(F.lit(_GRAIN).cast("long"), F.floor(F.lit(float(_GRAIN * per_language)) / F.count(F.lit(1))))
    # Written, so its size is known and texts meet it without a shuffle.
    shares = materialize(different.groupBy("lang").agg(below.alias("below")), "language_shares")
    chosen = usable.join(shares, "lang").where(F.pmod("h", F.lit(_GRAIN)) < F.col("below"))
    once = chosen.groupBy("lang", "h").agg(F.first("text").alias("text"))
    rows = once.mapInArrow(_feature_batches, "lang string, h long, places array<int>, shares array<float>")
    return materialize(rows, "language_sample")


def _fit(group: pa.Table) -> pa.Table:
    """One machine from its texts, in an order that does not depend on the shuffle."""
    group = group.sort_by([("lang", "ascending"), ("h", "ascending")])
    x = np.zeros((group.num_rows, DIM), np.float32)
    for i, (at, values) in enumerate(zip(group.column("places"), group.column("shares"), strict=True)):
        x[i, at.values.to_numpy()] = values.values.to_numpy()
    norm = 1.0 / float(np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64)).mean())
    x *= np.float32(norm)
    w, bias = linear_svm(x, group.column("side").to_numpy())
    weights = pa.array([(w * norm).astype(np.float32).tobytes()], pa.binary())
    return pa.table({"machine": group.column("machine").slice(0, 1), "weights": weights, "bias": [float(bias)]})


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, side: int = SIDE) -> LanguageModel:
    """Fit the hierarchy on ``labelled (text, lang)``.

    Rows without a language, or whose text is null or has no letter, teach
    nothing. Languages are whatever values ``lang`` holds; with one
    language everything is that language, with none everything is undetermined.
    Equal texts of a language are learned once, so a text that a third of all
    rows repeat neither fills the sample nor is learned more than once,
    and the share of texts that is chosen is one of different texts, not of rows.
    The model has 32 KB for each family and for each two languages of one.
    """
    sample = training_sample(labelled, per_language)
    texts = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_family: dict[str, list[str]] = {}
    for lang in sorted(texts):
        by_family.setdefault(_FAMILY_OF.get(lang.lower().split("-")[0], f"only {lang}"), []).append(lang)
    model = LanguageModel([by_family[k] for k in sorted(by_family)])
    n = len(model.families)
    model.pairs = [(f, a, b) for f, members in enumerate(model.families) for a, b in combinations(members, 2)]
    model.weights = np.zeros((n + len(model.pairs), DIM), np.float32)
    model.bias = np.zeros(n + len(model.pairs))
    if len(texts) < 2:
        return model
    machines: list[tuple[int, list[str], list[str]]] = [(n + k, [a], [b]) for k, (_, a, b) in enumerate(model.pairs)]
    if n > 1:
        for f, members in enumerate(model.families):
            machines.append((f, members, [lang for lang in texts if lang not in members]))
    roles = []
    for machine, *sides in machines:
        for sign, langs in zip((1, -1), sides, strict=True):
            below = min(_GRAIN, int(_GRAIN * side / sum(texts[lang] for lang in langs)))
            roles += [(lang, machine, sign, below) for lang in langs]
    role = labelled.sparkSession.createDataFrame(roles, "lang string, machine int, side int, below long")
    rows = sample.join(role, "lang").where(F.pmod(F.xxhash64("h", "machine"), F.lit(_GRAIN)) < F.col("below"))
    fitted = rows.groupBy("machine").applyInArrow(_fit, "machine int, weights binary, bias double")
    for r in fitted.toLocalIterator():
        model.weights[r["machine"]] = np.frombuffer(r["weights"], np.float32)
        model.bias[r["machine"]] = r["bias"]
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    A null text, or one without a letter, is ``und`` with score 0. Only the
    text decides. Rows and other columns pass through; input columns named
    like the outputs are replaced; an empty table gives an empty result.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predict(text):
        import pandas as pd

        return pd.DataFrame([model.predict(t) for t in text], columns=["lang_pred", "score"])

    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    found = docs.select(*quoted(names), predict(F.col("text")).alias("__p"))
    return found.select(*quoted(names), "__p.lang_pred", "__p.score")


def held_out(doc_id: str = "doc_id"):
    """Rows that no model learns from: crc32 of the id as text, modulo 4, is 2.
    A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
