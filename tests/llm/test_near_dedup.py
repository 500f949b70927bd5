import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA

from llm import near_dedup as nd
from llm.textkernel import shingle_sets

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORDS.findall((text or "").translate(str.maketrans(UPPER, UPPER.lower())))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(rows))


def found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def texts(n, rnd):
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([2, 4, 5, 30, 120]))]
        out.append(base)
        for _ in range(rnd.choice([0, 0, 1, 6])):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 60))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            out.append(copy)
    return [" ".join(x) for x in out]


def test_equals_brute_force_on_random_groups(spark):
    rnd = random.Random(1)
    rows = list(enumerate(texts(60, rnd)))
    rows += [(9000, ""), (9001, None), (9002, " \t\n"), (9003, rows[3][1].upper()), (9004, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 85):
        assert found(nd.near_duplicates(df, percent)) == brute([(d, t) for d, t in rows], percent)


def test_equals_brute_force_on_the_table(spark):
    from llm.session import table

    rows = [(r.doc_id, r.text) for r in table(spark, DATA, "documents").select("doc_id", "text").collect()]
    assert found(nd.op1_minhash_near_dedup(spark, DATA)) == brute(rows, 85)


def test_chunked_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_ROWS", 8)
    monkeypatch.setattr(nd, "WHOLE_BLOCK", 4)
    rnd = random.Random(2)
    base = [f"a{i}" for i in range(80)]
    rows = []
    for d in range(60):  # one long chain of near copies around a common passage
        copy = list(base)
        copy[rnd.randrange(80)] = f"x{d}"
        rows.append((d, " ".join(copy)))
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(100 + d, passage + " " + " ".join(f"q{d}_{i}" for i in range(20))) for d in range(40)]
    # pairs around a passage that is most of them: no component holds most of their list
    for d in range(30):
        own = [f"r{d}_{i}" for i in range(8)]
        rows += [(200 + 2 * d + k, " ".join([f"s{i}" for i in range(30)] + own[: 8 - k])) for k in (0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = nd.near_duplicates(df, 85, common=16)
    assert found(got) == brute(rows, 85)


def test_null_ids_repeated_rows_clashing_columns_and_empty_tables(spark):
    kind = "doc_id long, text string, node long, kept boolean, v string, n_shingles string"
    a = "one two three four five six seven"
    rows = [(None, a), (2, a), (2, a), (1, a), (3, "other words stand in this text here"), (None, None)]
    df = spark.createDataFrame([(d, t, 1, False, "x", "y") for d, t in rows], kind)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in nd.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, None, True), (2, 1, False), (2, 1, False), (1, 1, True), (3, 3, True), (None, None, True)], key=str)
    left = nd.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(1, a), (3, rows[4][1]), (None, None)], key=str)
    assert nd.near_duplicates(df.limit(0)).count() == 0 and nd.drop_near_duplicates(df.limit(0)).count() == 0


def test_rows_that_share_an_id_stay_apart(spark):
    df = spark.createDataFrame([(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "h i j k l m n"), (5, "z z z"), (5, "z z z")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text[0]) for r in nd.drop_near_duplicates(df).collect()) == [(1, "a"), (1, "h"), (5, "z")]


def test_rows_without_an_id_are_copies_too(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    df = spark.createDataFrame([(None, a), (None, a), (None, b), (7, b), (7, a)], "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in nd.drop_near_duplicates(df).collect()), key=str) == sorted([(7, a), (7, b)], key=str)


def test_columns_of_any_name_are_kept(spark):
    names = ["doc_id", "text", "_id", "_rows", "_stays", "nul", "id", "th", "stays", "n", "root", "NODE"]
    rows = [(d, "one two three four five six seven", *[f"{c}{d}" for c in names[2:]]) for d in (4, 3)]
    left = nd.drop_near_duplicates(spark.createDataFrame(rows, names))
    assert left.columns == names and [tuple(r) for r in left.collect()] == [rows[1]]


def test_a_group_larger_than_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_ROWS", 100)
    base = [f"a{i}" for i in range(60)]
    rows = [(d, " ".join([*base[: d % 60], f"x{d}", *base[d % 60 + 1 :]])) for d in range(700)]
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 70, common=16).collect()
    assert {r.component_id for r in got} == {r[2] for r in brute(rows[:120], 70)} == {0}


def test_very_long_texts(monkeypatch):
    import llm.textkernel as tk

    monkeypatch.setattr(tk, "SEGMENT", 1000)
    text = " ".join(f"word{i % 700}" for i in range(5000)) + " " + "x" * 3000 + " end"
    short = " ".join(text.split()[:50])
    (a, b, c) = list(shingle_sets(pa.array([text, short, None])))
    assert len(a) == len(shingles(text)) and len(b) == len(shingles(short)) and len(c) == 0
    assert set(b.tolist()) <= set(a.tolist())


@pytest.mark.parametrize("share", [0.5, 0.85])
def test_union_estimate(share):
    rnd = np.random.default_rng(3)
    errors = []
    for _ in range(100):
        pool = rnd.integers(0, 1 << 63, 1000).astype(np.uint64)
        n = int(1000 * share)
        a, b = np.unique(pool[: n + (1000 - n) // 2]), np.unique(np.concatenate([pool[:n], pool[n + (1000 - n) // 2 :]]))
        errors.append(float(nd.union_estimates(nd._padded([a, b], 48), np.array([0]), np.array([1]))[0]) - share)
    assert abs(np.mean(errors)) < 0.03
