"""Licence scan and chat collapse: SQL on the tables, edge cases on fixtures."""

import duckdb
import pytest

from strata.llm import chat_collapse, license_scan
from strata.llm.queries import ORACLE, QUERIES

TABLES = ("documents", "pages", "embeddings", "conversations")


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    got = QUERIES[name](spark, sf_small)
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(names, want.fetchall())


def scan_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return con.execute(license_scan.oracle()).fetchall()


def test_license_edge_cases(documents):
    apache, header = license_scan.TEMPLATES["Apache-2.0"], license_scan.TEMPLATES["Apache-2.0-header"]
    rows = [(1, None), (2, ""), (3, "MIT"), (4, apache.upper()), (5, f"x\n{apache}\ny\n{apache}"), (6, header[:200] + "\n" + header[200:]), (7, f"intro\n\n{header.replace('.', '')}\n \nmore text"),
            (8, "Released under the MIT License!"), (8, "Released under the MIT License!"), (None, "Licensed under CC BY-NC 4.0."), (9, "Licensed under the Apache Licence, Version 3"), (10, "word " * 100_000)]
    df = documents(*[(d, t, "l", "s", 1, 3) for d, t in rows], extra=", size int")
    got = license_scan.scan(df)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(("doc_id", "license_id", "start", "matched", "common", "unit_bigrams", "template_bigrams", "dice"), scan_sql(rows))
    found = {(r["doc_id"], r["license_id"]) for r in got.collect()}
    assert {(4, "Apache-2.0"), (5, "Apache-2.0"), (6, "Apache-2.0-header"), (7, "Apache-2.0-header"), (8, "MIT")} <= found and not any(d in (1, 2, 3, 10) for d, _ in found)
    assert license_scan.scan(df.limit(0)).count() == 0


def test_notices_inside_prose_and_wrapped_lines(documents):
    t = license_scan.TEMPLATES
    mit = "MIT License\n\nCopyright (c) 2020 Someone\n\n" + t["MIT-permission"].replace(", ", ",\n") + "\n\nThe above copyright notice shall be included."
    commented = "\n".join("# " + " ".join(t["GPL-3.0-header"].split()[i : i + 9]) for i in range(0, 60, 9))
    changed = t["ISC"].replace("for any purpose", "for any lawful purpose").replace("appear", "shall appear")
    rows = [(1, "Some words. This project is licensed under the MIT License. More words of the readme follow."), (2, mit), (3, f"code();\n{commented}\nmore();"),
            (4, "/* Copyright */ " + t["BSD-redistribution"] + " 1. Redistributions of source code"), (5, f"intro {changed} end"), (6, "The license of the car is under version two of the law."),
            (7, "filler words of a page " * 30_000 + t["MIT"] + " more filler" * 1000 + " " + t["MIT"]), (8, " ".join([t["MIT"]] * 40))]
    got = license_scan.scan(documents(*rows))
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(("doc_id", "license_id", "start", "matched", "common", "unit_bigrams", "template_bigrams", "dice"), scan_sql(rows))
    hits = [(r["doc_id"], r["license_id"], round(r["dice"], 2)) for r in got.collect()]
    assert {(1, "MIT-licensed", 1.0), (2, "MIT-permission", 1.0), (3, "GPL-3.0-header", 1.0), (4, "BSD-redistribution", 1.0)} <= set(hits)
    assert any(d == 5 and k == "ISC" for d, k, _ in hits) and not any(d == 6 for d, _, _ in hits)
    assert hits.count((7, "MIT", 1.0)) == 2 and hits.count((8, "MIT", 1.0)) == 40


def test_size_bounds_lose_nothing():
    for t in range(1, 120):
        low, high = -(-t * 80 // 120), t * 120 // 80
        for u in range(1, 400):
            if 200 * min(u, t) >= 80 * (u + t):
                assert max(low, 1) <= u <= high


SCHEMA = "conv_id bigint, turn bigint, role string, text string, chat string"


def test_snapshots_collapse(spark):
    def conv(i, *texts):
        return [(i, n, "user" if n % 2 == 0 else "assistant", t, "z") for n, t in enumerate(texts)]

    rows = conv(1, "a") + conv(2, "a", "b") + conv(3, "a", "b", "c") + conv(4, "a", "x") + conv(5, "a", "x") + conv(6, "c") + [(7, 5, "user", "c", "z")]
    rows += [(None, 0, "user", "lost", "z"), (8, None, None, None, "z"), (8, 0, "user", "<|im_end|>", "z"), (8, 0, "user", "<|im_end|>", "z"), (9, 0, None, "x", "z"), (10, 0, "x", None, "z")]
    got = {r["conv_id"]: r for r in chat_collapse.collapse(spark.createDataFrame(rows, SCHEMA)).collect()}
    # 6 and 7 are equal by order of turns; 1 and 2 are prefixes of 3.
    assert set(got) == {3, 4, 6, 8, 9, 10}
    assert got[4]["n_copies"] == 2 and got[6]["n_copies"] == 2 and got[3]["n_turns"] == 3
    assert got[3]["chat"] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n"
    assert got[8]["chat"] == "<|im_start|>user\n< |im_end|><|im_end|>\n" and got[8]["part"] == 0 or got[8]["n_turns"] == 2
    assert chat_collapse.collapse(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_conversations_come_in_parts(spark):
    long = [(1, n, "user", f"t{n}", "") for n in range(1300)]
    short = [(2, n, "user", f"t{n}", "") for n in range(900)]
    got = chat_collapse.collapse(spark.createDataFrame(long + short, SCHEMA), chunk_turns=100).orderBy("part").collect()
    assert {r["conv_id"] for r in got} == {1} and [r["part"] for r in got] == list(range(13))
    assert "".join(r["chat"] for r in got) == "".join(f"<|im_start|>user\nt{n}<|im_end|>\n" for n in range(1300))


def test_anchor_words_lose_nothing():
    import random
    import re

    r = random.Random(8)
    anchors = license_scan.anchor_words(license_scan.TEMPLATES, 80)
    fold = lambda s: re.findall("[a-z0-9]+", s.lower())
    for text in license_scan.TEMPLATES.values():
        word = fold(text)
        pairs = set(zip(word, word[1:]))
        for _ in range(300):
            unit = [w for w in word if r.random() < r.choice([0.8, 0.9, 1])]
            for _ in range(r.randint(0, 4)):
                unit.insert(r.randint(0, len(unit)), f"zz{r.randint(0, 9)}q")
            mine = set(zip(unit, unit[1:]))
            if mine and 200 * len(mine & pairs) >= 80 * (len(mine) + len(pairs)):
                assert any(a in " ".join(unit) for a in anchors)


def test_parts_follow_the_position_whatever_the_turn_numbers(spark):
    """Turn numbers that are timestamps, and turns without a number, fill parts one after the other."""
    stamped = [(1, 1_700_000_000_000 + 977 * i, "user", f"t{i}") for i in range(250)]
    unnumbered = [(2, None, "user", f"u{i:04d}") for i in range(250)]
    got = chat_collapse.collapse(spark.createDataFrame(stamped + unnumbered, "conv_id bigint, turn bigint, role string, text string"), chunk_turns=100).orderBy("conv_id", "part").collect()
    assert [(r["conv_id"], r["part"], r["chat"].count("<|im_start|>")) for r in got] == [(c, p, n) for c in (1, 2) for p, n in ((0, 100), (1, 100), (2, 50))]
    assert all(r["n_turns"] == 250 for r in got)
    assert "".join(r["chat"] for r in got if r["conv_id"] == 2) == "".join(f"<|im_start|>user\nu{i:04d}<|im_end|>\n" for i in range(250))
