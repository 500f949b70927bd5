import random
import re

import numpy as np
import pyarrow as pa
from conftest import DATA

from llm import decontamination as dc
from llm.session import table


def corpus(seed=1, n=300):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice(["th", "er", "on", "an", "re", "he"]) for _ in range(rnd.randint(2, 5))) for _ in range(3000)] + ["the", "of", "and"] * 200
    text = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    items = [(i, text(rnd.randint(10, 60)) + ".") for i in range(25)]
    docs = [(d, text(rnd.randint(5, 400))) for d in range(n)]
    return rnd, text, items, docs


def edited(rnd, item, share):
    out = []
    for w in item.split():
        r = rnd.random()
        if r < share / 2:
            continue
        out.append("zzz" + w if r < share else w)
    return " ".join(out)


def find(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in dc.find_leaks(d, b).collect()}


def test_exact_and_edited_passages_are_found_and_clean_texts_are_not(spark):
    rnd, text, items, docs = corpus()
    want = set()
    for k, (i, item) in enumerate(items):
        docs.append((1000 + k, f"{text(150)} {item.upper()} {text(90)}"))
        docs.append((2000 + k, f"{text(50)} {edited(rnd, item, 0.2)} {text(40)}"))
        docs.append((3000 + k, item))
        want |= {(1000 + k, i), (3000 + k, i)}
    got = find(spark, docs, items)
    assert want <= got
    edits = {(2000 + k, i) for k, (i, _) in enumerate(items)}
    assert len(edits & got) >= 0.9 * len(edits)
    assert not {d for d, _ in got if d < 1000}


def test_lcs_equals_dynamic_programming():
    rnd = random.Random(2)
    for _ in range(200):
        a, b = [[rnd.randint(0, 6) for _ in range(rnd.randint(1, 30))] for _ in range(2)]
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], (last + 1 if x == y else max(row[j], row[j - 1]))
        assert dc.lcs_length(dc._masks(np.array(a)), len(a), b) == row[-1]


def test_passages_and_svd_equal_dense_algebra(spark):
    _, _, _, docs = corpus(3, 80)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    idf = dc.term_weights(df)
    rows = np.concatenate(list(dc.passages(pa.array([t for _, t in docs]))))
    assert len(rows) == sum(-(-len(t.split()) // dc.PASSAGE) for _, t in docs)
    seen = np.array([len({r for r in range(len(rows)) if t in rows[r]}) for t in range(0, 200)])
    assert np.allclose(idf[:200], np.log((1 + len(rows)) / (1 + seen)) + 0.01, atol=1e-5)
    dense = np.zeros((len(rows), dc.TERMS), dtype=np.float32)
    w = np.where(rows >= 0, idf[rows], 0)
    w /= np.maximum(np.sqrt((w * w).sum(axis=1, keepdims=True)), 1e-6)
    for i, r in enumerate(rows):
        np.add.at(dense[i], r[r >= 0], w[i][r >= 0])
    basis = dc.latent_basis(df, idf)
    assert np.allclose(basis.T @ basis, np.eye(dc.RANK), atol=1e-4)
    s = np.linalg.svd(dense, compute_uv=False)
    kept = np.linalg.norm(dense @ basis) ** 2
    assert kept >= 0.7 * (s[: dc.RANK] ** 2).sum()


def test_nulls_empties_repeats_and_blocks(spark, monkeypatch):
    rnd, text, items, _ = corpus(4, 0)
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 7)
    docs = [(1, None), (2, ""), (3, " ., "), (4, items[0][1]), (4, items[0][1]), (None, items[1][1]), (5, text(30000) + " " + items[2][1])]
    got = find(spark, docs, [*items, (90, None), (91, ""), (92, "..."), (93, items[0][1])])
    assert got == {(4, items[0][0]), (4, 93), (None, items[1][0]), (5, items[2][0])}
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame(items, "item_id long, text string")
    left = dc.drop_leaks(d, b)
    assert left.columns == d.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 3]
    assert dc.find_leaks(d.limit(0), b).count() == 0 and dc.find_leaks(d, b.limit(0)).count() == 0
    assert dc.drop_leaks(d, b.limit(0)).count() == len(docs)


def test_query_finds_what_a_search_of_all_windows_finds(spark):
    """Every window of every text against every item, by the plain common subsequence, without the latent space."""
    docs, items = (table(spark, DATA, t).collect() for t in ("documents", "benchmark"))
    words = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower())
    parts = [(i.item_id, words(i.text)) for i in items]
    want = set()
    for d in docs:
        w = words(d.text)
        have = set(w)
        for item, own in parts:
            if not own or len(have & set(own)) < 0.5 * len(set(own)):
                continue
            masks, n = dc._masks(np.array([hash(x) for x in own])), len(own)
            for at in range(0, max(1, len(w) - n // 2), max(1, n // 2)):
                if dc.lcs_length(masks, n, [hash(x) for x in w[at : at + 2 * n]]) >= 0.6 * n:
                    want.add((d.doc_id, item))
                    break
    got = {(r.doc_id, r.item_id) for r in dc.op9_decontamination(spark, DATA).collect()}
    assert want and len(want & got) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(want) + 1


def test_answer_words_confirm_a_shorter_subsequence():
    idf, basis = np.ones(dc.TERMS, dtype=np.float32), np.eye(dc.TERMS, dc.RANK, dtype=np.float32)
    text = [f"word{i}" for i in range(24)]
    block = dc.Items([1], [" ".join(text)], idf, basis)
    rare = set(block.answers[0].tolist())
    ((_, _, h, _),) = dc.word_hashes(pa.array([" ".join(text)]), dc.PLAIN)
    is_answer = np.isin(h, list(rare))
    with_answers = np.concatenate([h[is_answer], h[~is_answer][:1]])
    without = h[~is_answer]
    assert dc.matches(block, 0, h, 0.6, 0.5) == 1.0
    assert dc.matches(block, 0, with_answers[np.argsort([h.tolist().index(x) for x in with_answers])], 0.6, 0.5) is not None
    assert dc.matches(block, 0, without, 0.6, 0.5) is None and dc.matches(block, 0, h[:8], 0.6, 0.5) is None


def test_columns_of_any_name_are_kept(spark):
    _, text, items, _ = corpus(5, 0)
    names = ["doc_id", "text", "key", "_key", "_k", "KEY_"]
    df = spark.createDataFrame([(1, items[0][1], "a", "b", "c", "d"), (2, text(40), "e", "f", "g", "h")], names)
    left = dc.drop_leaks(df, spark.createDataFrame(items, "item_id long, text string"))
    assert left.columns == names and [tuple(r)[2:] for r in left.collect()] == [("e", "f", "g", "h")]


def test_paraphrases_with_every_rare_word_replaced_are_found(spark):
    rnd = random.Random(11)
    common = [f"c{i}" for i in range(40)]
    topics = [[f"t{k}w{i}" for i in range(600)] for k in range(12)]
    text = lambda own, n: " ".join(rnd.choice(common) if rnd.random() < 0.5 else rnd.choice(own) for _ in range(n))
    docs = [(d, text(topics[d % 12], rnd.randint(50, 400))) for d in range(400)]
    items, want = [], set()
    for i in range(24):
        own, mixed = rnd.sample(topics[i % 12], 9), rnd.sample(common, 15)
        words = own + mixed
        rnd.shuffle(words)
        items.append((i, " ".join(words)))
        other = [w for w in topics[i % 12] if w not in own]
        reworded = [rnd.choice(other) if w in own else w for w in words]
        docs.append((1000 + i, f"{text(other, 100)} {' '.join(reworded)} {text(other, 100)}"))
        want.add((1000 + i, i))
    got = find(spark, docs, items)
    assert len(want & got) >= 16
    assert len({x for x in got if x[0] < 1000}) <= 0.01 * 400 * 24


def test_threshold_is_that_of_unrelated_windows():
    rnd, text, items, docs = corpus(6)
    idf = np.ones(dc.TERMS, dtype=np.float32)
    basis = np.linalg.qr(np.random.default_rng(1).standard_normal((dc.TERMS, dc.RANK)))[0].astype(np.float32)
    weighted = np.concatenate([idf[:, None] * basis, np.zeros((1, dc.RANK), dtype=np.float32)])
    block = dc.Items([i for i, _ in items], [t for _, t in items], idf, basis)
    texts = [text(400) for _ in range(300)]
    block.calibrate(texts, weighted, 0.3, 0.6)
    before = block.least.copy()
    assert (before >= 0.3).all() and (before > 0.3).any()
    # many windows that hold an item do not raise its threshold beyond a little
    block.calibrate(texts + [items[0][1]] * 1500, weighted, 0.3, 0.6)
    assert block.least[0] < before[0] + 0.15
    block.calibrate([], weighted, 0.3, 0.6)
    assert (block.least == 0.3).all()


def heads_near_items(seed=13, texts=100, n_items=12):
    """(docs, items): the first 2,000 characters of every text are of the items' topic, a long rest is of others; ids from 1000 on reword an item."""
    rnd = random.Random(seed)
    common = [f"c{i}" for i in range(40)]
    near, far = [f"n{i}" for i in range(400)], [[f"f{k}w{i}" for i in range(400)] for k in range(20)]
    text = lambda own, n: " ".join(rnd.choice(common) if rnd.random() < 0.5 else rnd.choice(own) for _ in range(n))
    docs = [(d, f"{text(near, 700)[:2000]} {text(far[d % 20], 12000)}") for d in range(texts)]
    items = []
    for i in range(n_items):
        own, mixed = rnd.sample(near, 9), rnd.sample(common, 15)
        words = own + mixed
        rnd.shuffle(words)
        items.append((i, " ".join(words)))
        reworded = [rnd.choice(near) if w in own else w for w in words]
        docs.append((1000 + i, f"{text(far[i], 100)} {' '.join(reworded)} {text(far[i], 100)}"))
    return docs, items


def test_thresholds_are_those_of_all_windows_of_whole_texts(spark, monkeypatch):
    docs, items = heads_near_items()
    docs += [(5000, None), (5001, ""), (5002, "c1 c2"), (5003, items[0][1])]
    made, init = [], dc.Items.__init__
    monkeypatch.setattr(dc.Items, "__init__", lambda self, *a: (init(self, *a), made.append((self, *a[2:])))[0])
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {(r.doc_id, r.item_id) for r in dc.find_leaks(d, spark.createDataFrame(items, "item_id long, text string")).collect()}
    ((block, idf, basis),) = made
    rows = [(np.concatenate(list(z)) >> dc._TERM_SHIFT).astype(int) for _, t in docs if (z := [h for _, _, h, _ in dc.word_hashes(pa.array([t or ""]), dc.PLAIN)])]
    wide = 3  # blocks of 8 words: the items have 24 words
    spots, cosines = block.spots.astype(float), []
    for terms in rows:
        blocks = -(-len(terms) // 8)
        for at in range(max(1, blocks - wide + 1) if blocks else 0):
            part = terms[at * 8 : (at + wide) * 8]
            x = (idf[part, None] * basis[part]).sum(axis=0, dtype=float)
            held = block.holds[:, part].sum(axis=1) >= 0.6 * 24
            cosines.append(np.where(held, -1, spots @ x / max(1e-9, np.linalg.norm(x))))
    exact = np.maximum(0.3, -np.sort(-np.array(cosines), axis=0)[int(dc.UNRELATED * len(cosines))])
    assert (exact > 0.3).any()
    assert (block.least <= exact + 1e-4).all() and (block.least >= exact - 0.7 / 256 - 1e-4).all()
    assert (5003, 0) in got and len([x for x in got if x[0] == 1000 + x[1]]) >= 11


def common_topic(seed=17, texts=200, n_items=12):
    """(docs, items): most windows are of the items' topic; ids from 1000 on hold 15 of an item's 24 words in order amid another topic."""
    rnd = random.Random(seed)
    near, far = [f"n{i}" for i in range(60)], [[f"f{k}w{i}" for i in range(60)] for k in range(5)]
    docs = [(d, " ".join(rnd.choices(near if d < 0.7 * texts else far[d % 5], k=300))) for d in range(texts)]
    items = []
    for i in range(n_items):
        words, own = rnd.sample(near, 24), far[i % 5]
        items.append((i, " ".join(words)))
        lost = set(rnd.sample(range(24), 9))
        reworded = [rnd.choice(own) if k in lost else w for k, w in enumerate(words)]
        docs.append((1000 + i, " ".join(rnd.choices(own, k=80) + reworded + rnd.choices(own, k=80))))
    return docs, items


def test_query_finds_items_among_many_windows_of_their_topic(spark, tmp_path):
    """More windows than the share that an item's own threshold lets through are nearer to it than the text that holds it."""
    docs, items = common_topic()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in dc.op9_decontamination(spark, str(tmp_path)).collect()}
    assert {(1000 + i, i) for i, _ in items} <= got and len(got) <= 2 * len(items)


def test_candidates_leave_out_no_window_that_holds_an_item():
    """Short items, items of one word many times, and one of more than 256 words, against every window by itself."""
    rnd, text, items, docs = corpus(9, 40)
    long = text(600)
    items = [*items, (30, "the"), (31, "the of"), (32, "the " * 30), (33, "zz " * 9 + "yy"), (34, long), (35, text(20) + " the" * 12)]
    docs = [t for _, t in docs] + ["", "the", "zz zz yy " * 6, "of the " * 300, *(f"{text(60)} {edited(rnd, i, 0.3)} {text(60)}" for _, i in items)]
    ((_, _, hashes, counts),) = dc.word_hashes(pa.array(docs), dc.PLAIN)
    idf = np.random.default_rng(2).uniform(0.1, 3, dc.TERMS).astype(np.float32)
    basis = np.linalg.qr(np.random.default_rng(3).standard_normal((dc.TERMS, dc.RANK)))[0].astype(np.float32)
    weighted = np.concatenate([idf[:, None] * basis, np.zeros((1, dc.RANK), dtype=np.float32)])
    block = dc.Items([i for i, _ in items], [t for _, t in items], idf, basis)
    begins, want = np.cumsum(counts) - counts, set()
    sums = dc._block_sums((hashes >> dc._TERM_SHIFT).astype(np.int16), counts, weighted)
    for wide, ks in block.groups:
        x, at, first = dc._windows(sums, counts, wide)
        for w in range(len(x)):
            a = first[w] * dc.BLOCK - wide * dc.BLOCK // 2
            part = hashes[begins[at[w]] + max(0, a) : begins[at[w]] + min(counts[at[w]], a + wide * dc.BLOCK + 2 * (wide * dc.BLOCK // 2))]
            want |= {(at[w], k) for k in ks if x[w] @ block.spots[k] >= 0.3 and dc.matches(block, k, part, 0.6, 0.5) is not None}
    found = dc._candidates(block, weighted, 0.6, 0.5, hashes, counts)
    got = {(t, k) for t, k, _, a, b in found if dc.matches(block, k, hashes[begins[t] + a : begins[t] + b], 0.6, 0.5) is not None}
    assert got == want and len(want) > 40
