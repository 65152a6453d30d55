"""Quality rules with a linear-chain CRF over lines.

Every line that holds a word is a node with the states content and boilerplate.
Emissions are linear in a few line features, transitions are a 2 x 2 table;
Viterbi decoding gives the most likely labelling of the whole text, and the
share of words in content lines decides whether the document stays. Base
counts (words, symbols, repeated lines and 3-word windows) reject a document
before that.

The weights are fitted here, by gradient ascent on the regularised
log-likelihood, on lines of a bounded sample of labelled documents: lines of
good documents count as content, lines of bad ones as boilerplate, and spliced
sequences of both teach the transitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strata.llm import flat

#: Documents of each class that the fit may use; counts, features and decoding always cover all rows.
SAMPLE_PER_CLASS = 400
SAMPLE_LINES = 4000
FEATURES = ("bias", "symbols", "upper", "digits", "pipes", "marks", "short", "long_words", "repeated_line", "repeated_words", "no_stop", "few_words")
MIN_WORDS, MAX_REPEAT_PERCENT, CONTENT_SHARE = 50, 50, 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;\"')]")] = True


@dataclass
class LineModel:
    """Boilerplate-against-content emission weights, transition scores [from, to] and start score."""

    weight: np.ndarray
    move: np.ndarray
    start: float


#: Used when no labelled document exists: marks lines of symbols, pipes and capitals.
PRIOR = LineModel(np.array([-2.0, 12, 3, 3, 12, 6, 0.5, 0.5, 2, 3, 0.5, 0.5]), np.array([[1.0, -1.0], [-1.0, 1.0]]), 0.0)


def _sums(flag: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=total[1:])
    return total[end] - total[start]


def _later_equal(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """True for items whose key occurred earlier in the same group (items are in order)."""
    order = np.lexsort((key, group))
    again = np.zeros(len(key), bool)
    again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
    return again


def measure(raw: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts per text; then per line with a word: text number, word count, features, [start, end)."""
    n_docs = len(off) - 1
    start, end, word_off = flat.words(raw, off)
    _, word = flat.equal_segments(raw, start, end)
    lead = (raw & 0xC0) != 0x80
    per = np.maximum(np.diff(word_off) - 2, 0)
    gram_off = np.concatenate([[0], np.cumsum(per)])
    owner = flat.spread(gram_off)
    at = word_off[owner] + (np.arange(len(owner)) - gram_off[owner])
    back = flat.equal_rows(owner, word[at], word[at + 1], word[at + 2]) if len(at) else at
    seen = np.bincount(back)
    covered = np.zeros(len(word) + 3, bool)
    for i in range(3):
        covered[at[seen[back] > 1] + i] = True
    covered = covered[: len(word)]

    newline = np.flatnonzero(raw == 0x0A)
    line_start = np.unique(np.concatenate([off[:-1][np.diff(off) > 0], newline + 1]))
    line_start = line_start[line_start < len(raw)]
    line_end = np.append(line_start[1:], len(raw))
    line_end = line_end - (raw[line_end - 1] == 0x0A) if len(line_start) else line_end
    doc = np.searchsorted(off, line_start, side="right") - 1
    at, to = np.searchsorted(start, line_start), np.searchsorted(start, line_end)
    with_word = to > at
    line_start, line_end, doc, at, to = (x[with_word] for x in (line_start, line_end, doc, at, to))
    repeated = _later_equal(doc, flat.equal_segments(raw, line_start, line_end)[1])
    words = to - at
    chars = np.maximum(_sums(lead, line_start, line_end), 1)
    in_words = np.zeros(len(word) + 1, np.int64)
    if len(word):
        np.cumsum(_sums(lead, start, end), out=in_words[1:])
    letters = np.maximum(_sums(((raw | 0x20) >= 97) & ((raw | 0x20) <= 122), line_start, line_end), 1)
    rate = lambda flag: _sums(flag, line_start, line_end)
    feature = np.empty((len(words), len(FEATURES)))
    feature[:, 0] = 1
    feature[:, 1] = rate(_SYMBOL[raw]) / chars
    feature[:, 2] = rate((raw >= 65) & (raw <= 90)) / letters
    feature[:, 3] = rate((raw >= 48) & (raw <= 57)) / chars
    feature[:, 4] = np.minimum(rate(raw == 0x7C) / words, 1)
    feature[:, 5] = np.minimum(rate(raw == 0x21) / words, 1)
    feature[:, 6] = 1 / words
    feature[:, 7] = np.minimum((in_words[to] - in_words[at]) / words / 20, 1)
    feature[:, 8] = repeated
    feature[:, 9] = _sums(covered, at, to) / words
    last = raw[end[to - 1] - 1] if len(words) else np.zeros(0, np.uint8)
    feature[:, 10] = ~_STOP[last]
    feature[:, 11] = words < 4
    counts = {
        "n_words": np.diff(word_off),
        "word_chars": in_words[word_off[1:]] - in_words[word_off[:-1]],
        "n_symbols": _sums(_SYMBOL[raw], off[:-1], off[1:]),
        "n_dup_lines": np.bincount(doc[repeated], minlength=n_docs),
        "n_repeat_words": _sums(covered, word_off[:-1], word_off[1:]),
    }
    return counts, doc, words, feature, np.stack([line_start, line_end], axis=1)


def viterbi(model: LineModel, score: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The best labelling (True: boilerplate) of sequences laid end to end.

    `score` is each node's boilerplate score against content; with two states the
    path scores reduce to their difference, stepped for all sequences at once.
    """
    size = np.diff(off)
    order = np.argsort(-size, kind="stable")
    longest = int(size.max(initial=0))
    active = np.searchsorted(-size[order], -np.arange(longest), side="left")
    at = off[:-1][order]
    back = np.zeros((2, len(score)), bool)
    gap = np.zeros(len(size))
    (a00, a01), (a10, a11) = model.move
    for t in range(longest):
        k = active[t]
        i = at[:k] + t
        if t == 0:
            gap[:k] = model.start + score[i]
            continue
        g = gap[:k]
        back[0, i], back[1, i] = g + a10 > a00, g + a11 > a01
        gap[:k] = score[i] + np.maximum(a01, g + a11) - np.maximum(a00, g + a10)
    label = np.zeros(len(score), bool)
    state = np.zeros(len(size), bool)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        i = at[:k] + t
        last = size[order[:k]] == t + 1
        state[:k] = np.where(last, gap[:k] > 0, state[:k])
        label[i] = state[:k]
        state[:k] = np.where(state[:k], back[1, i], back[0, i])
    return label


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], steps: int = 120, rate: float = 0.3, decay: float = 1e-3) -> LineModel:
    """CRF weights from (features, labels) sequences: exact gradients by the
    forward-backward recursions, Adam steps, fixed start; the same input gives
    the same weights."""
    size = np.array([len(y) for _, y in sequences])
    order = np.argsort(-size, kind="stable")
    sequences, size = [sequences[i] for i in order], size[order]
    off = np.concatenate([[0], np.cumsum(size)])
    x, y = np.concatenate([s[0] for s in sequences]), np.concatenate([s[1] for s in sequences]).astype(np.int64)
    longest, at = int(size[0]), off[:-1]
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    inner = np.ones(len(y), bool)
    inner[at] = False
    here = np.flatnonzero(inner)
    seen_move = np.bincount(y[here - 1] * 2 + y[here], minlength=4).reshape(2, 2).astype(float)
    seen_x, seen_start = x.T @ y, float(y[at].sum())
    theta = np.zeros(x.shape[1] + 5)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n = len(y)

    def lse(a, b):
        return np.logaddexp(a, b)

    for step in range(1, steps + 1):
        w, move, start = theta[:-5], theta[-5:-1].reshape(2, 2), theta[-1]
        u = np.stack([np.zeros(n), x @ w], axis=1)
        alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
        for t in range(longest):
            i = at[: active[t]] + t
            if t == 0:
                alpha[i] = u[i] + np.array([0.0, start])
            else:
                p = alpha[i - 1]
                alpha[i] = u[i] + np.stack([lse(p[:, 0] + move[0, s], p[:, 1] + move[1, s]) for s in (0, 1)], axis=1)
        for t in range(longest - 2, -1, -1):
            i = at[: active[t + 1]] + t
            q = beta[i + 1] + u[i + 1]
            beta[i] = np.stack([lse(q[:, 0] + move[s, 0], q[:, 1] + move[s, 1]) for s in (0, 1)], axis=1)
        z = np.repeat(lse(*alpha[off[1:] - 1].T), size)
        p1 = np.exp(alpha[:, 1] + beta[:, 1] - z)
        pair = alpha[here - 1][:, :, None] + move[None] + (u + beta)[here][:, None, :] - z[here][:, None, None]
        grad = np.concatenate([seen_x - x.T @ p1, (seen_move - np.exp(pair).sum(axis=0)).ravel(), [seen_start - p1[at].sum()]]) / n - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return LineModel(theta[:-5], theta[-5:-1].reshape(2, 2), float(theta[-1]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality",
          per_class: int = SAMPLE_PER_CLASS) -> LineModel:
    """A model from documents labelled 1 (good) or 0 (bad). At most `per_class`
    documents of each class are used: those of smallest id hash, of rows that share an id
    the one of smallest text hash; of these, texts of more than SAMPLE_LINES lines are
    left out. Rows with a null label, id or text are not used; without both classes
    the prior model returns."""
    known = labels.where(F.col(quality_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(quality_col).cast("int")).alias("good"))
    chosen = None
    for good in (0, 1):
        part = known.where(F.col("good") == good).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null").join(chosen, "id")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"]
    rows = rows.groupBy("id", "good").agg(one.alias("text")).where(F.regexp_count("text", F.lit("\n")) < SAMPLE_LINES).select("id", "good", "text")

    def features(batches):
        for rb in batches:
            out = {"id": [], "good": [], "x": []}
            for first, raw, off in flat.text_chunks(rb.column(2)):
                _, doc, _, x, _ = measure(raw, off)
                cut = np.searchsorted(doc, np.arange(len(off)))
                for i in range(len(off) - 1):
                    if cut[i] < cut[i + 1]:
                        out["id"].append(str(rb.column(0)[first + i].as_py()))
                        out["good"].append(rb.column(1)[first + i].as_py())
                        out["x"].append(x[cut[i] : cut[i + 1]].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out["id"], pa.string()), pa.array(out["good"], pa.int32()), pa.array(out["x"], pa.binary())], ["id", "good", "x"])

    got = sorted((r["id"], r["good"], bytes(r["x"])) for r in rows.mapInArrow(features, "id string, good int, x binary").collect())
    by = {g: [np.frombuffer(x, np.float32).reshape(-1, len(FEATURES)).astype(float) for _, good, x in got if good == g] for g in (0, 1)}
    if not by[0] or not by[1]:
        return PRIOR
    sequences = [(x, np.full(len(x), 1 - g)) for g in (0, 1) for x in by[g]]
    for i, bad in enumerate(by[0]):
        good = by[1][i % len(by[1])]
        half = len(good) // 2
        sequences.append((np.concatenate([good[:half], bad, good[half:]]), np.concatenate([np.zeros(half), np.ones(len(bad)), np.zeros(len(good) - half)])))
    return fit(sequences)


def assess(docs: DataFrame, model: LineModel, id_col: str = "doc_id", text_col: str = "text", min_share: float = CONTENT_SHARE, with_text: bool = False) -> DataFrame:
    """One row per row of `docs`: the id, the base counts, `base_failed`, `n_lines`
    (lines with a word), `content_lines`, `content_share` (words in content lines
    against all words, 0 without words), `kept`, and with `with_text` also
    `content` (the content lines, newline-joined).

    A null or empty text has no words and fails the base rules. Repeated rows and
    null ids stay rows; an empty table gives an empty result; columns other than
    the two named are not read.
    """
    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    kind = src.schema[0].dataType.simpleString()
    schema = StructType.fromDDL(
        f"id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
        "n_lines bigint, content_lines bigint, content_share double, kept boolean" + (", content string" if with_text else ""))
    arrow = to_arrow_schema(schema)

    def run(batches):
        for rb in batches:
            for first, raw, off in flat.text_chunks(rb.column(1)):
                n = len(off) - 1
                c, doc, words, x, span = measure(raw, off)
                content = ~viterbi(model, x @ model.weight, np.searchsorted(doc, np.arange(n + 1)))
                kept_words = np.bincount(doc[content], weights=words[content], minlength=n)
                share = np.where(c["n_words"] > 0, kept_words / np.maximum(c["n_words"], 1), 0.0)
                failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
                col = c | {"base_failed": failed, "n_lines": np.bincount(doc, minlength=n), "content_lines": np.bincount(doc[content], minlength=n),
                           "content_share": share, "kept": ~failed & (share >= min_share)}
                arrays = {k: pa.array(v, arrow.field(k).type) for k, v in col.items()} | {"id": rb.column(0).slice(first, n)}
                if with_text:
                    data = raw.tobytes()
                    lines: list[list[bytes]] = [[] for _ in range(n)]
                    for d, (a, b) in zip(doc[content].tolist(), span[content].tolist()):
                        lines[d].append(data[a:b])
                    arrays["content"] = pa.array([b"\n".join(z).decode("utf-8") for z in lines], pa.string())
                yield pa.RecordBatch.from_arrays([arrays[f.name] for f in arrow], schema=arrow)

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)
