import random

import public_tokenizers
from conftest import DATA

from llm import token_counts as tc
from llm.session import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_counts(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    return [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_query_equals_the_library(spark):
    rows = {r.doc_id: r for r in tc.op5_token_counts(spark, DATA).collect()}
    docs = table(spark, DATA, "documents").select("doc_id", "text").collect()
    for d, n in zip(docs, library_counts([d.text for d in docs]), strict=True):
        r = rows[d.doc_id]
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(d.text.encode()), n > 512)


def test_odd_texts(spark):
    rnd = random.Random(1)
    common = list(" \n\t abcdeé'stre\x1c\x1d\x85\u00a0\u200b\u0661234!?") + ["<|endoftext|>", "  ", "'ll"]
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(rnd.choice(common) if rnd.random() < 0.8 else rnd.choice(chars) for _ in range(rnd.randint(0, 50))) for _ in range(1500)]
    texts += [None, "", "a<|endoftext|>b", " " * 5000, "x" * 20000, "\u088fa", "word " * 40000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.n_tokens for r in tc.count_tokens(df, PATH).orderBy("doc_id").collect()]
    assert got == library_counts(texts)


def test_cache_eviction(monkeypatch):
    monkeypatch.setattr(tc, "CACHE", 50)
    raw = open(PATH, "rb").read()
    counter = tc.Counter(raw, tc.frequent_lengths(raw))
    rnd = random.Random(2)
    texts = [" ".join("".join(rnd.choice("abcdefgh") for _ in range(9)) for _ in range(40)) for _ in range(20)]
    assert [counter.counts([t])[0] for t in texts] == library_counts(texts)
    assert len(counter.known) <= len(counter.frequent) + 100


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "hello", 7, "z"), (1, "hello", 7, "z"), (None, None, 7, "z")], "doc_id long, text string, n_bytes long, n_tokens string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in tc.count_tokens(df, PATH).collect()), key=str)
    assert got == sorted([(1, 5, 1), (1, 5, 1), (None, 0, 0)], key=str)
    assert tc.count_tokens(df.limit(0), PATH).count() == 0


def test_other_tokenizer_files(spark):
    import sentencepiece
    from tokenizers import Tokenizer

    texts = ["hello World 123", "", None, "  a  b\n", "Ünïcode ▁ <|startoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words, pieces = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
    tok, sp = Tokenizer.from_file(words), sentencepiece.SentencePieceProcessor(model_file=pieces)
    count = lambda path: [r.n_tokens for r in tc.count_tokens(df, path).orderBy("doc_id").collect()]
    assert count(words) == [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert count(pieces) == [len(sp.encode(t or "")) for t in texts]
