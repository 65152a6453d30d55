import collections
import itertools

import numpy as np
import pyarrow as pa
from conftest import WORD, thue_morse

from strata.llm import flat, line_crf


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = list(zip(w, w[1:], w[2:]))
    many = collections.Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if many[g] > 1 for j in range(3)}
    lines, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_base_counts_and_edge_cases(documents):
    rows = [(1, None), (2, ""), (3, "a b c a b c a"), (4, "x\nx\n\nx y\n \nx"), (5, "ein Wörtchen # | <é>\r\nzwei"), (5, "x\n"), (None, "q " * 60_000), (6, "\n\n"), (7, "\x0b\x0cA\x85B C")]
    a, b = thue_morse()
    rows += [(8, f"{a}\n{b}\n{a}"), (9, f"{a} x y\n{b} x y\n{a} x y")]
    df = documents(*[(d, t, "l", "s", 1, 9) for d, t in rows], extra=", kept int")
    got = line_crf.assess(df, line_crf.PRIOR, with_text=True).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r["doc_id"]), tuple(r[n] for n in names)) for r in got) == sorted((str(d), counts(t)) for d, t in rows)
    assert line_crf.assess(df.limit(0), line_crf.PRIOR).count() == 0


def test_whole_table_counts_and_labels(spark, small_docs, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    model = line_crf.train(small_docs, labels)
    got = {r["doc_id"]: r for r in line_crf.assess(small_docs, model).collect()}
    for r in small_docs.collect():
        g = got[r["doc_id"]]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) == counts(r["text"])
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good = [got[d]["kept"] for d, q in quality.items() if q == 1 and d in got and not got[d]["base_failed"]]
    bad = [got[d]["kept"] for d, q in quality.items() if q == 0 and d in got]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(2)
    model = line_crf.LineModel(np.zeros(1), r.normal(size=(2, 2)), float(r.normal()))
    sizes = [1, 5, 3, 0, 8, 2]
    off = np.concatenate([[0], np.cumsum(sizes)])
    score = r.normal(size=off[-1])
    label = line_crf.viterbi(model, score, off)
    for a, b in zip(off[:-1], off[1:]):
        def total(y):
            s = model.start * y[0] + sum(score[a + i] * v for i, v in enumerate(y))
            return s + sum(model.move[p, q] for p, q in zip(y, y[1:]))
        if a < b:
            best = max(itertools.product((0, 1), repeat=int(b - a)), key=total)
            assert tuple(label[a:b].astype(int)) == best


def test_fit_separates_lines_and_learns_switches():
    r = np.random.default_rng(3)
    def lines(y):
        return np.stack([np.ones(len(y)), np.array(y) * 1.0 + r.normal(0, 0.4, len(y))], axis=1)
    seqs = [(lines(y), np.array(y)) for y in ([0] * 6 + [1] * 5 + [0] * 4 for _ in range(40))]
    model = line_crf.fit(seqs)
    x, y = seqs[0]
    assert (line_crf.viterbi(model, x @ model.weight, np.array([0, len(y)])) == y).mean() > 0.9
    assert model.move[0, 0] > model.move[0, 1] and model.move[1, 1] > model.move[1, 0]


def test_without_labels_the_prior_serves(spark, documents):
    labels = spark.createDataFrame([(1, None, 0)], "doc_id bigint, quality int, toxic int")
    assert line_crf.train(documents((1, "a b")), labels) is line_crf.PRIOR


def test_lines_with_content_are_returned(documents):
    text = "\n".join(["A plain sentence goes on for a while, as prose does.", "Another one follows and says something else.", "The third closes this short paragraph of text."] + ["Home | About | ### | %%% | $$$ |"])
    r = line_crf.assess(documents((1, text)), line_crf.PRIOR, with_text=True).first()
    assert r["n_lines"] == 4 and "Home" not in r["content"] and r["content"].startswith("A plain")


def test_no_text_spans_two_rows():
    off = flat.words(*list(flat.text_chunks(pa.array(["ab", "cd", None, " e"])))[0][1:])[2]
    assert off.tolist() == [0, 1, 2, 2, 3]


def test_one_labelled_id_in_most_rows_does_not_fill_the_sample(spark, documents):
    rows = [(1, f"bad | line {i} !\nmore ! {i}") for i in range(300)] + [(i, f"A clean sentence with several words number {i}.\nAnother one follows here.") for i in range(2, 40)]
    labels = spark.createDataFrame([(1, 0, 0)] + [(i, 1, 0) for i in range(2, 40)], "doc_id bigint, quality int, toxic int")
    model = line_crf.train(documents(*rows), labels)
    assert model is not line_crf.PRIOR
    again = line_crf.train(documents(*rows[::-1]).repartition(5), labels)
    assert np.array_equal(model.weight, again.weight)
