"""Language identification by hierarchical discrimination.

A text is a vector of hashed byte trigrams (letters folded, everything that is
no letter is a blank; square roots of the counts, length one). One linear
support vector machine per language family finds the family; within it, one
machine per pair of languages votes. All machines are fitted here, on a
bounded sample of labelled rows, and applied to whole texts.

Whether a text is in its language at all is a question of its own: the mean log
ratio of its trigrams' shares in that language to even shares is 0 for noise and
does not depend on how many languages were learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import flat

#: Labelled rows per language that the fit may use (by id hash); prediction covers all rows.
SAMPLE_PER_LANGUAGE = 500
DIMS = 4096
MAX_ROWS = 256
#: A language with so many learned rows has a least likeness: this share of what all but 1% of those rows reach.
PROFILE_ROWS, LIKENESS_SHARE = 30, 0.2

#: Language families by ISO 639-1 code; a code not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "turkic": "az kk ky tk tr tt ug uz",
    "uralic": "et fi hu",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "austronesian": "id jv mg ms su tl",
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

_FOLD = np.full(256, 0x20, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def family(code: str) -> str:
    return _FAMILY_OF.get(code.lower().split("-")[0], code)


@dataclass
class LanguageModel:
    """Families with their machines, and per family its languages with pair machines."""

    families: list[str] = field(default_factory=list)
    family_weight: np.ndarray | None = None
    languages: dict[str, list[str]] = field(default_factory=dict)
    pair_weight: dict[str, np.ndarray] = field(default_factory=dict)
    profile: dict[str, np.ndarray] = field(default_factory=dict)
    least: dict[str, float] = field(default_factory=dict)


def vectors(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Unit trigram vectors of texts laid end to end (a row of zeros without letters)."""
    code = _FOLD[raw]
    n = len(off) - 1
    if len(code) >= 3:
        gram = code[:-2] * np.uint32(0x9E3779B1) ^ code[1:-1] * np.uint32(0x85EBCA77) ^ code[2:] * np.uint32(0xC2B2AE3D)
        gram = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(20)
        doc = flat.spread(off)
        inside = (doc[:-2] == doc[2:]) & ((code[:-2] != 32) | (code[1:-1] != 32) | (code[2:] != 32))
        x = np.bincount(doc[:-2][inside] * DIMS + gram[inside], minlength=n * DIMS).reshape(n, DIMS)
    else:
        x = np.zeros((n, DIMS))
    x = np.sqrt(x).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def has_letter(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    ascii_letter = np.zeros(len(raw) + 1, np.int64)
    low = raw | 0x20
    np.cumsum((low >= 97) & (low <= 122) & (raw < 0x80), out=ascii_letter[1:])
    out = ascii_letter[off[1:]] > ascii_letter[off[:-1]]
    for i in np.flatnonzero(~out & (np.diff(off) > 0)):
        out[i] = any(c.isalpha() for c in raw[off[i] : off[i + 1]].tobytes().decode("utf-8"))
    return out


def _pieces(column: pa.Array):
    """Chunks of whole texts, at most MAX_ROWS rows each."""
    for first, raw, off in flat.text_chunks(column):
        for a in range(0, len(off) - 1, MAX_ROWS):
            o = off[a : a + MAX_ROWS + 1]
            yield first + a, raw[o[0] : o[-1]], o - o[0]


def fit_machine(x: np.ndarray, y: np.ndarray, cost: float = 20.0, steps: int = 60) -> np.ndarray:
    """Weights (last: bias) of a linear SVM with squared hinge loss for y in {-1, 1},
    classes weighed evenly, by accelerated gradient steps from zero."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, look, t = np.zeros(x.shape[1] + 1, np.float32), np.zeros(x.shape[1] + 1, np.float32), 1.0
    rate = np.float32(1 / (1e-2 + 2 * cost * 2))
    for _ in range(steps):
        gap = np.maximum(0, 1 - y * (x @ look[:-1] + look[-1])) * y * share * 2 * cost
        grad = np.float32(1e-2) * look - np.append(x.T @ gap, gap.sum()).astype(np.float32)
        new = look - rate * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + np.float32((t - 1) / t_new) * (new - w), new, t_new
    return w


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """A model from the rows where `usable` holds and text, language and id are not
    null. Rows are taken by id hash, about `per_language` of each language; the
    total is bounded by `per_language` times the number of languages. Without
    such rows the model is empty and predicts `und`."""
    known = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), usable.alias("ok"))
    known = known.where("ok and id is not null and text is not null and lang is not null").select("id", "lang", "text")
    # The sample is chosen from ids and languages alone; no text is shuffled.
    narrow = known.select("id", "lang")
    count = narrow.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    languages = count.count()
    draw = F.pmod(F.xxhash64("id", F.lit("language sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = (
        narrow.join(count, "lang").where(draw * F.col("n") < float(per_language)).select("id").distinct()
        .orderBy(F.xxhash64("id"), "id").limit(per_language * max(languages, 1))
    )
    # At most per_language ids per language: a bound that does not grow with the data.
    rows = known.join(F.broadcast(chosen), "id").select("id", "lang", "text")

    def features(batches):
        for rb in batches:
            for first, raw, off in _pieces(rb.column(2)):
                n = len(off) - 1
                x = vectors(raw, off).astype(np.float16)
                yield pa.RecordBatch.from_arrays([rb.column(0).slice(first, n), rb.column(1).slice(first, n), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "lang", "x"])

    got = rows.mapInArrow(features, "id string, lang string, x binary").orderBy(F.xxhash64("id"), "id", "x").limit(per_language * max(languages, 1)).collect()
    if not got:
        return LanguageModel()
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in got]).astype(np.float32)
    lang = np.array([r["lang"] for r in got])
    fam = np.array([family(c) for c in lang])
    model = LanguageModel(families=sorted(set(fam)))
    if len(model.families) > 1:
        model.family_weight = np.stack([fit_machine(x, np.where(fam == f, 1, -1).astype(np.float32)) for f in model.families])
    for f in model.families:
        codes = sorted(set(lang[fam == f]))
        model.languages[f] = codes
        pairs = []
        for i, a in enumerate(codes):
            for b in codes[i + 1 :]:
                own = (lang == a) | (lang == b)
                pairs.append(fit_machine(x[own], np.where(lang[own] == a, 1, -1).astype(np.float32)))
        if pairs:
            model.pair_weight[f] = np.stack(pairs)
    for code in sorted(set(lang)):
        own = x[(lang == code) & x.any(axis=1)] ** 2  # shares of the trigrams
        if len(own) >= PROFILE_ROWS:
            model.profile[code] = np.log((own.mean(axis=0) * DIMS + 0.1) / 1.1).astype(np.float32)
            model.least[code] = LIKENESS_SHARE * float(np.quantile(own @ model.profile[code], 0.01))
    return model


def resembles(model: LanguageModel, x: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """True where trigram vectors are like the learned rows of their language (always,
    where it had fewer than PROFILE_ROWS)."""
    out = np.ones(len(x), bool)
    for code, profile in model.profile.items():
        rows = np.flatnonzero(lang == code)
        out[rows] = x[rows] ** 2 @ profile >= model.least[code]
    return out


def predict(model: LanguageModel, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language, score) of trigram vectors; the score is the family's share of
    the family margins times the language's share of the pair votes."""
    def squash(m):
        return 1 / (1 + np.exp(-3.0 * np.clip(m, -10, 10)))

    n = len(x)
    if model.family_weight is None:
        which, score = np.zeros(n, np.int64), np.ones(n)
    else:
        p = squash(x @ model.family_weight[:, :-1].T + model.family_weight[:, -1])
        which = p.argmax(axis=1)
        score = p.max(axis=1) / np.maximum(p.sum(axis=1), 1e-12)
    lang = np.empty(n, object)
    for f, name in enumerate(model.families):
        rows = np.flatnonzero(which == f)
        codes = model.languages[name]
        if len(codes) == 1:
            lang[rows] = codes[0]
        elif len(rows):
            w = model.pair_weight[name]
            p = squash(x[rows] @ w[:, :-1].T + w[:, -1])
            vote = np.zeros((len(rows), len(codes)))
            k = 0
            for i in range(len(codes)):
                for j in range(i + 1, len(codes)):
                    vote[:, i] += p[:, k]
                    vote[:, j] += 1 - p[:, k]
                    k += 1
            best = vote.argmax(axis=1)
            lang[rows] = np.array(codes, object)[best]
            score[rows] *= vote.max(axis=1) / (len(codes) - 1)
    return lang, np.clip(score, 0.0, 1.0)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score", like_name: str | None = None) -> DataFrame:
    """`docs` with the predicted language and its score (0 to 1) as two more columns;
    `like_name` names a third one, whether the text is like that language's learned rows.

    A null text, or one without a letter, is `und` with score 0 and like none. Repeated rows,
    nulls in other columns and empty tables need no special case; a column that
    already has one of the two names is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded: DIMS weights per machine
    keep = [c for c in docs.columns if c not in (lang_name, score_name, like_name)]
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("like", pa.bool_())])

    # Only the text goes to Python; the rest of the row waits in the JVM.
    @F.arrow_udf("lang string, score double, like boolean")
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        for texts in batches:
            lang, score, like = np.full(len(texts), "und", object), np.zeros(len(texts)), np.zeros(len(texts), bool)
            for first, raw, off in _pieces(texts):
                some = np.flatnonzero(has_letter(raw, off))
                if len(some) and model.families:
                    x = vectors(raw, off)[some]
                    a, b = predict(model, x)
                    lang[first + some], score[first + some], like[first + some] = a, b, resembles(model, x, a)
            yield pa.StructArray.from_arrays([pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(like)], fields=list(kind))

    # Marked so that a filter on the result is not answered by a second run.
    named = docs.select(*keep, guess.asNondeterministic()(F.col(text_col).cast("string")).alias("__guess"))
    pairs = [("lang", lang_name), ("score", score_name)] + [("like", like_name)] * bool(like_name)
    return named.select(*keep, *[F.col("__guess")[c].alias(name) for c, name in pairs])
