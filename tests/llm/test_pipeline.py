import re
from collections import Counter

import public_tokenizers
from conftest import DATA
from test_decontamination import common_topic, heads_near_items
from test_near_dedup import shingles

import corpus_pipeline as cp
from llm import sentencepiece_unigram as su
from llm import toxicity
from llm.session import table


def line_dedup(docs):
    seen, gone = set(), {d: set() for d, _ in docs}
    for d, t in docs:
        lines = t.split("\n")
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if not "".join(w).strip():
                continue
            if w in seen:
                gone[d] |= {i, i + 1, i + 2}
            seen.add(w)
    out = []
    for d, t in docs:
        lines = t.split("\n")
        kept = [x for i, x in enumerate(lines) if i not in gone[d]]
        if kept:
            out.append((d, "\n".join(kept)))
    return out


def near_dedup(docs, percent):
    sets, up = [shingles(t) for _, t in docs], list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return [d for i, d in enumerate(docs) if root(i) == i]


def leaks(text, items):
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    doc = plain(text)
    return any(plain(i) in doc for i in items)


def test_pipeline_equals_brute_force(spark):
    docs = table(spark, DATA, "documents")
    model = toxicity.fit(docs, toxicity.training_labels(spark, DATA))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    rows = [(d, t) for d, t in rows if model.score(t) < 0.7]
    rows = near_dedup(line_dedup(rows), 80)
    items = [r.text for r in table(spark, DATA, "benchmark").collect()]
    rows = [(d, t) for d, t in rows if not leaks(t, items)]
    enc = su.Encoder(su.load(public_tokenizers.path("piece_bpe_32k.model")))
    want = {d: enc.encode(t) for d, t in rows}
    got = cp.run(spark, DATA).collect()
    assert {r.doc_id: list(r.ids) for r in got} == want
    assert all(r.round_trip for r in got)


def test_stages_keep_the_columns(spark):
    docs = table(spark, DATA, "documents")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "sentencepiece"]
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, DATA).columns == docs.columns


def test_stages_on_null_repeated_and_empty_rows(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string, covered string"
    a = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, a), (3, a), (None, a), (None, None), (4, "x\ny\nz"), (5, "x\ny\nz")]
    df = spark.createDataFrame([(d, t, None, None, None, "s", "c") for d, t in rows], kind)
    counts = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, df, DATA)
        assert out.columns == df.columns
        counts[name] = Counter(str(r.doc_id) for r in out.collect())
        assert stage(spark, df.limit(0), DATA).count() == 0
    assert sum(counts["toxicity"].values()) == len(rows) == sum(counts["benchmark_decontamination"].values())
    assert counts["line_dedup"] == Counter({"1": 1, "2": 1, "3": 2, "None": 2, "4": 1})
    assert counts["minhash_near_dedup"] == Counter({"1": 1, "2": 1, "3": 1, "None": 1, "4": 1})
    assert cp.STAGES[-1][1](spark, df, DATA).count() == len(rows)


def test_decontamination_stage_looks_at_whole_texts_for_its_thresholds(spark, tmp_path):
    docs, items = heads_near_items()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {r.doc_id for r in cp.decontamination_stage(spark, spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path)).collect()}
    assert set(range(100)) <= left and len(left) <= 101


def test_decontamination_stage_drops_items_among_many_windows_of_their_topic(spark, tmp_path):
    docs, items = common_topic()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = cp.decontamination_stage(spark, spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path))
    kept = {r.doc_id for r in left.collect()}
    assert not {d for d in kept if d >= 1000} and len(kept) >= 0.95 * len([d for d, _ in docs if d < 1000])
