"""Hierarchical language identification.

A text is a vector of hashed character n-grams of its letters.  Linear support vector machines
first tell the language families apart; within the winning family one-versus-one machines vote
on the language.  The machines are fitted on a bounded hash sample of labelled rows; counts,
features and predictions run over all rows and whole texts.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.text import map_texts
from panelcast.sources.sinks import materialize

UNDETERMINED = "und"

# Families of common language codes; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "gd", "cy", "br"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "gu", "pa", "ne", "si"),
    "iranian": ("fa", "ps", "ku", "tg"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tt"),
    "semitic": ("ar", "he", "am", "mt"),
    "dravidian": ("ta", "te", "kn", "ml"),
    "austronesian": ("id", "ms", "tl", "jv", "mg"),
    "sinitic": ("zh", "yue"),
}

# Parameters of the fit: labelled rows per language and of all languages, at most, and the
# feature space.  Every label is learned; with many of them each has fewer rows, LEAST_ROWS at least.
PER_LANGUAGE, ALL_ROWS, LEAST_ROWS, DIMENSIONS = 600, 15_000, 8, 4096

# A-Z to a-z; other ASCII but letters to a space
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_LETTER = re.compile(r"[^\W\d_]")


def family(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


def has_letter(text: str | None) -> bool:
    """Whether a text has a Unicode letter."""
    return text is not None and any(m.group().isalpha() for m in _LETTER.finditer(text))


def features(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Square roots of the shares of hashed byte 2- to 4-grams within and around words, of unit length."""
    folded = b" " + b" ".join(text.encode().translate(_FOLD).split()) + b" "
    b = np.frombuffer(folded, np.uint8).astype(np.uint32)
    counts = np.zeros(dimensions)
    code = b
    for n in range(1, 4):
        if len(b) <= n:
            break
        code = code[: len(b) - n] * np.uint32(257) + b[n:]
        mixed = (code ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(2654435761)
        counts += np.bincount((mixed >> np.uint32(16)) % np.uint32(dimensions), minlength=dimensions) / (len(b) - n)
    out = np.sqrt(counts)
    return out / (np.linalg.norm(out) or 1.0)


def fit_machine(x: np.ndarray, sign: np.ndarray, cost: float = 10.0, rounds: int = 60) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss; the last column of ``x`` is 1, for the offset.

    Newton steps on the primal: each solves a ridge system over the rows inside the margin.  The
    classes weigh the same, however many rows they have.
    """
    weight = cost * np.where(sign > 0, len(x) / (2 * max(1, (sign > 0).sum())), len(x) / (2 * max(1, (sign < 0).sum())))
    w, inside = np.zeros(x.shape[1]), None
    for _ in range(rounds):
        now = sign * (x @ w.astype(x.dtype)) < 1
        if inside is not None and np.array_equal(now, inside):
            break
        inside = now
        at = np.flatnonzero(inside)
        if len(at) > x.shape[1]:
            # the primal form, as large as the dimensions however many rows there are
            hess, right = np.eye(x.shape[1]), np.zeros(x.shape[1])
            for i in range(0, len(at), 4096):
                a, c = x[at[i : i + 4096]], weight[at[i : i + 4096]].astype(x.dtype)[:, None]
                hess += a.T @ (a * c)
                right += (sign[at[i : i + 4096]].astype(x.dtype) @ (a * c)).astype(np.float64)
            w = np.linalg.solve(hess, right)
        elif len(at):
            # the dual form: rows inside the margin are fewer than dimensions
            a = x[at]
            gram = (a @ a.T).astype(np.float64)
            gram[np.diag_indices_from(gram)] += 1.0 / weight[at]
            w = (np.linalg.solve(gram, sign[at]).astype(x.dtype) @ a).astype(np.float64)
    return w


@dataclass
class Model:
    """Machines of the families (one against the rest) and of each family's pairs of languages."""

    families: dict[str, list[str]]
    top: np.ndarray  # families x (dimensions + 1)
    pairs: dict[str, np.ndarray]  # family -> pairs x (dimensions + 1)
    dimensions: int = DIMENSIONS

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and a score from 0 to 1; ``und`` and 0 for null, for no letter, and for an empty model."""
        if not self.families or not has_letter(text):
            return UNDETERMINED, 0.0
        x = np.append(features(text, self.dimensions), 1.0)
        names = list(self.families)
        margins = self.top @ x if len(names) > 1 else np.array([np.inf])
        best = int(margins.argmax())
        score = float(1.0 / (1.0 + np.exp(-2.0 * margins[best])))
        languages = self.families[names[best]]
        if len(languages) == 1:
            return languages[0], score
        votes, total = np.zeros(len(languages)), np.zeros(len(languages))
        for (i, j), m in zip(itertools.combinations(range(len(languages)), 2), self.pairs[names[best]] @ x):
            votes[i if m >= 0 else j] += 1
            total[i] += m
            total[j] -= m
        # most votes, then the larger sum of margins, then the order of the names
        won = max(range(len(languages)), key=lambda k: (votes[k], total[k], -k))
        pull = total[won] / (len(languages) - 1)
        return languages[won], score * float(1.0 / (1.0 + np.exp(-2.0 * pull)))


def _vectors(rows: list[bytes], dimensions: int) -> np.ndarray:
    """Feature vectors with a last column of 1."""
    x = np.ones((len(rows), dimensions + 1), np.float32)
    for i, r in enumerate(rows):
        x[i, :-1] = np.frombuffer(r, np.float32)
    return x


def _pair_machines(sample: DataFrame, families: dict[str, list[str]], dimensions: int) -> dict[str, np.ndarray]:
    """The machines of each family's pairs of languages, one group of a Spark task each."""
    machines = {f: list(itertools.combinations(members, 2)) for f, members in families.items()}
    # a language meets the other members of its family only, which are few
    sides = [(a if k == 0 else b, f, n, 1.0 - 2 * k) for f, pairs in machines.items() for n, (a, b) in enumerate(pairs) for k in (0, 1)]
    if not sides:
        return {f: np.zeros((0, dimensions + 1)) for f in families}
    sides = sample.sparkSession.createDataFrame(sides, "lang string, family string, n int, sign double")

    def solve(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values(["lang", "drawn"])
        w = fit_machine(_vectors(list(pdf["vector"]), dimensions), pdf["sign"].to_numpy())
        return pd.DataFrame({"family": [key[0]], "n": [key[1]], "w": [w.tobytes()]})

    rows = sample.join(sides, "lang").groupBy("family", "n").applyInPandas(solve, "family string, n int, w binary")
    found = {(r.family, r.n): np.frombuffer(r.w) for r in rows.collect()}
    return {f: np.array([found[f, n] for n in range(len(pairs))]) for f, pairs in machines.items()}


def fit(
    labelled: DataFrame, key: Column, per_language: int = PER_LANGUAGE, all_rows: int = ALL_ROWS,
    dimensions: int = DIMENSIONS,
) -> Model:
    """Fit on (``text``, ``lang``) rows: distinct texts of each language by the hash of ``key`` and text.

    Texts without letters teach nothing, and equal texts of a language teach once, however many
    rows share them.  Every language is learned: each has at most ``per_language`` rows, or its
    share of ``all_rows`` if that is less (``LEAST_ROWS`` at least), so the sample never exceeds
    the larger of ``all_rows`` and ``LEAST_ROWS`` for each language.  Other columns are not read.
    The sample's vectors come from whole texts, computed on the executors.
    """
    taught = labelled.where("lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    teaching = taught.select("lang", "text", F.xxhash64("text").alias("same"), F.xxhash64(key).alias("by_key"))
    # one row of equal texts, combined before the shuffle; the least draw of its ids
    one = teaching.groupBy("lang", "same").agg(F.min("by_key").alias("by_key"))
    one = one.select("lang", "same", "by_key", F.xxhash64("by_key", "same", F.lit(3)).alias("drawn"))
    u = F.pmod("drawn", F.lit(1 << 30)) / float(1 << 30)
    one = materialize(one.withColumn("u", u), "language_rows")
    # two numbers per language
    counts = one.groupBy("lang").agg(F.count("*").alias("n"), F.min("u").alias("least")).collect()
    if not counts:
        return Model({}, np.zeros((0, dimensions + 1)), {}, dimensions)
    per = max(LEAST_ROWS, min(per_language, all_rows // len(counts)))
    # about twice the rows wanted, of which the first by the draw are taken exactly
    shares = [(r.lang, max(2 * per / r.n, r.least)) for r in counts]
    bounds = labelled.sparkSession.createDataFrame(shares, "lang string, share double")
    some = one.join(bounds, "lang").where(F.col("u") <= F.col("share"))
    by_draw = Window.partitionBy("lang").orderBy("u", "drawn", "same", "by_key")
    picked = some.withColumn("rank", F.row_number().over(by_draw)).where(F.col("rank") <= per).select("lang", "same", "by_key", "drawn")
    picked = materialize(picked, "language_picked")
    # repeated rows of a picked text are one row again
    drawn = teaching.join(picked, ["lang", "same", "by_key"]).groupBy("lang", "same", "drawn").agg(F.first("text").alias("text"))

    def vector(texts: list) -> list[list]:
        return [[features(t, dimensions).astype(np.float32).tobytes() if has_letter(t) else None for t in texts]]

    sample = map_texts(drawn, "text", ["lang", "drawn"], "vector binary", vector).where("vector IS NOT NULL")
    sample = materialize(sample, "language_sample")
    # one copy of the sample, filled as it arrives and then ordered by the draw
    keys = sorted((r.lang, r.drawn) for r in sample.select("lang", "drawn").collect())
    if not keys:
        return Model({}, np.zeros((0, dimensions + 1)), {}, dimensions)
    lang = np.array([k[0] for k in keys])
    families: dict[str, list[str]] = {}
    for name in sorted(set(lang)):
        families.setdefault(family(name), []).append(str(name))
    tops = np.zeros((len(families), dimensions + 1))
    if len(families) > 1:
        x = np.ones((len(keys), dimensions + 1), np.float32)
        places: dict[tuple, list[int]] = {}
        for i in reversed(range(len(keys))):
            places.setdefault(keys[i], []).append(i)
        for r in sample.toLocalIterator():
            x[places[r.lang, r.drawn].pop(), :-1] = np.frombuffer(r.vector, np.float32)
        of = np.array([family(v) for v in lang])
        for i, f in enumerate(families):
            tops[i] = fit_machine(x, np.where(of == f, 1.0, -1.0))
        del x
    return Model(families, tops, _pair_machines(sample, families, dimensions), dimensions)


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` and ``lang_pred``, ``score`` of every row; only the text is looked at."""

    def predict(texts: list) -> list[list]:
        found = [model.predict(t) for t in texts]
        return [[f[0] for f in found], [f[1] for f in found]]

    return map_texts(docs, "text", keep, "lang_pred string, score double", predict)


def held_out(doc_id: Column) -> Column:
    """Documents that the machines never see: crc32 of the id as text leaves 2 modulo 4.  A null id is not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def fit_documents(docs: DataFrame) -> Model:
    return fit(docs.where(~held_out(F.col("doc_id"))), F.col("doc_id"))


def document_languages(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row of ``docs``."""
    found = identify(docs, fit_documents(docs), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
