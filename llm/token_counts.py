"""Token counts by a two-tier lookup of pre-token lengths, without any shuffle.

Tier one is a compact table of frequent pre-tokens and their lengths in tokens.  Its entries are the
vocabulary's own whole pre-tokens (what a byte-pair vocabulary holds is what was frequent), each
verified by the library, so its size is bounded by the vocabulary and it is broadcast once.  A text is
split into pre-tokens in the worker; those that the table lacks are encoded by the library and kept in
a bounded cache that lives as long as the worker.  Counts are sums of lengths.

Whole texts go to the library instead where a text holds an added token's string, where it holds a
code point that is not assigned in the Unicode tables of the standard library, and for tokenizers of another kind.

Defined results: a null or empty text has no bytes and no tokens; repeated rows are counted alike; an
empty table gives an empty table; the length of a text is not limited; other columns play no part.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.session import table

#: The byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 300_000
LONGEST_CACHED = 64
LIMIT = 512
_STATE: dict[str, object] = {}


def _byte_letters() -> dict[str, int]:
    """The printable letter of every byte in a byte-level vocabulary, by the public rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    for i, b in enumerate(x for x in range(256) if x not in set(plain)):
        letters[chr(256 + i)] = b
    return letters


def unassigned_search():
    """A test for code points that the standard library's (older) Unicode tables leave open.

    Most texts end at the first, single-range test; the plane that has most characters is looked up in
    a bitmap, and only texts with characters beyond it meet the list of ranges.
    """
    import re
    import sys
    import unicodedata

    runs: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)) == "Cn":
            if runs and runs[-1][1] == c - 1 and c != 0x10000:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    ranges = lambda low, high: "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs if low <= a < high)
    some = re.compile(f"[\\U{runs[0][0]:08x}-\U0010ffff]").search
    plane = re.compile(f"[{ranges(0, 0x10000)}]").search
    beyond = re.compile("[\U00010000-\U0010ffff]").search
    rest = re.compile(f"[{ranges(0x10000, 0x110000)}]").search

    def search(text: str) -> bool:
        return bool(some(text)) and bool(plane(text) or (beyond(text) and rest(text)))

    return search


def two_tier(spec: dict) -> bool:
    """Whether the tokenizer splits by the pattern alone, so that lengths of pre-tokens add up."""
    pre = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space")
        and pre.get("use_regex", True)
        and spec["model"].get("dropout") is None
    )


def library(raw: bytes):
    from tokenizers import Tokenizer

    found = Tokenizer.from_str(raw.decode())
    found.no_truncation()
    found.no_padding()
    return found


def lengths(tok, texts: list[str]) -> list[int]:
    encode = getattr(tok, "encode_batch_fast", tok.encode_batch)
    return [len(e) for e in encode(texts, add_special_tokens=False)]


def frequent_lengths(raw: bytes) -> dict[str, int]:
    """Tier one: each vocabulary entry that is a whole pre-token, with the length the library gives it."""
    import regex

    spec, letters, tok = json.loads(raw), _byte_letters(), library(raw)
    if not two_tier(spec):
        return {}
    pattern, found = regex.compile(PATTERN), []
    for piece in spec["model"]["vocab"]:
        try:
            text = bytes(letters[c] for c in piece).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if text and len(text) <= LONGEST_CACHED and (m := pattern.match(text)) and m.end() == len(text):
            found.append(text)
    return dict(zip(found, lengths(tok, found), strict=True))


class Counter:
    """Counts texts in one worker."""

    def __init__(self, raw: bytes, frequent: dict[str, int]) -> None:
        import regex

        spec = json.loads(raw)
        self.tok, self.frequent, self.known = library(raw), frequent, dict(frequent)
        self.split = regex.compile(PATTERN).findall if two_tier(spec) else None
        self.added = [t["content"] for t in spec.get("added_tokens", []) if t["content"]]
        self.odd = unassigned_search()

    def whole(self, text: str) -> bool:
        """Whether the library has to see the whole text."""
        return any(a in text for a in self.added) or self.odd(text)

    def counts(self, texts: list[str | None]) -> list[int]:
        out, whole, parts = [0] * len(texts), [], []
        for i, t in enumerate(texts):
            if not t:
                continue
            if self.split is None or self.whole(t):
                whole.append(i)
            else:
                parts.append((i, self.split(t)))
        if whole:
            for i, n in zip(whole, lengths(self.tok, [texts[i] for i in whole]), strict=True):
                out[i] = n
        known = self.known
        seen = set().union(*(p for _, p in parts))
        missing = [p for p in seen if p not in known]
        extra = {}
        if missing:
            if len(known) - len(self.frequent) + len(missing) > CACHE:
                known = self.known = dict(self.frequent)
                missing = [p for p in seen if p not in known]
            for p, n in zip(missing, lengths(self.tok, missing), strict=True):
                (known if len(p) <= LONGEST_CACHED else extra)[p] = n
        for i, p in parts:
            out[i] = sum(map(known.__getitem__, p)) if not extra else sum(extra[x] if x in extra else known[x] for x in p)
        return out


class PieceCounter:
    """Counts texts by a SentencePiece model; its pieces do not add up by words, so texts go to the library whole."""

    def __init__(self, raw: bytes) -> None:
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=raw)

    def counts(self, texts: list[str | None]) -> list[int]:
        return [len(ids) for ids in self.sp.encode([t or "" for t in texts], num_threads=1)]


def is_json(raw: bytes) -> bool:
    return raw[:64].lstrip()[:1] == b"{"


def counter(key: str, raw: bytes, frequent: dict[str, int]) -> Counter | PieceCounter:
    """The worker's counter; it outlives the task."""
    if _STATE.get("key") != key:
        _STATE.update(key=key, counter=Counter(raw, frequent) if is_json(raw) else PieceCounter(raw))
    return _STATE["counter"]


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_bytes, n_tokens, over_limit); a .json or a SentencePiece .model file."""
    import hashlib

    with open(tokenizer_path, "rb") as f:
        raw = f.read()
    key = hashlib.sha256(raw).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((key, raw, frequent_lengths(raw) if is_json(raw) else {}))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = counter(*shared.value)
        for b in batches:
            got = []
            for at in range(0, b.num_rows, 64):
                got += count.counts(b.column("text").slice(at, 64).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(got, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sized = slim.select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    counted = sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` under the byte-level vocabulary."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
