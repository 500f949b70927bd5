"""SentencePiece unigram encoding and decoding.

Pieces and their log scores are held in a double-array trie.  A text is prefixed with the whitespace
marker and its spaces become markers; Viterbi finds the segmentation with the largest total score, where
a character that no piece covers costs ten below the smallest score and is written as its UTF-8 bytes.
No piece of a usable vocabulary has a marker after another character, and some characters stand in no
longer piece, so a text falls into units that are segmented on their own; a bounded cache in each worker
keeps the segmentation of recent short units.

Scores are log scores of a unigram model where the file holds one; the scores of a byte-pair model (its
merge ranks, negated) are taken as they are.

Defined results: a null or empty text has no pieces and decodes to an empty text; a marker character
that stands in a text itself is written as its bytes, so decoding gives every text back exactly; repeated
rows are encoded alike; an empty table gives an empty table; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.session import table

MARK = "▁"
CACHE = 200_000
LONGEST_CACHED = 40
UNKNOWN_PENALTY = 10.0
_STATE: dict[str, object] = {}


class DoubleArray:
    """A trie over character codes: the child of node s by code c is base[s] + c if check there is s."""

    def __init__(self, words: list[str]) -> None:
        """Value of a word: its place in ``words``."""
        often = Counter(ch for w in words for ch in w)
        self.code = {ch: i for i, ch in enumerate(sorted(often, key=lambda ch: (-often[ch], ch)), 1)}
        tree: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for value, w in enumerate(words):
            at = 0
            for ch in w:
                c = self.code[ch]
                if c not in tree[at]:
                    tree[at][c] = len(tree)
                    tree.append({})
                    ends.append(-1)
                at = tree[at][c]
            ends[at] = value
        most = len(self.code) + 2
        size = 2 * len(tree) + 2 * most
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        after = list(range(size + 1))  # the next free slot from each slot on, with shortened paths
        after[0] = 1

        def free(at: int) -> int:
            first = at
            while after[at] != at:
                at = after[at]
            while after[first] != at:
                after[first], first = at, after[first]
            return at

        todo = deque([(0, 0)])
        while todo:
            node, slot = todo.popleft()
            value[slot] = ends[node]
            kids = sorted(tree[node])
            if not kids:
                continue
            p = free(kids[0] + 1)
            while True:
                b = p - kids[0]
                if b + kids[-1] >= len(check):
                    more = len(check) + kids[-1]
                    base += [0] * more
                    check += [-1] * more
                    value += [-1] * more
                    after += list(range(len(after), len(after) + more))
                if all(check[b + c] < 0 for c in kids):
                    break
                p = free(p + 1)
            base[slot] = b
            for c in kids:
                check[b + c] = slot
                after[b + c] = b + c + 1
                todo.append((tree[node][c], b + c))
        room = max(i for i, c in enumerate(check) if c >= 0) + len(self.code) + 2
        self.base, self.check, self.value = ((x + [f] * room)[: room + 1] for x, f in ((base, 0), (check, -1), (value, -1)))


def _marks(words: list[str], few: int = 4) -> tuple[frozenset[str], frozenset[str]]:
    """(marks, joining): no piece has a mark right after a character that is neither mark, marker nor joining.

    Marks start as all characters that are no letters or digits; one that more than ``few`` other characters
    precede is given up, until none is.  Of what is left the ASCII ones are returned.
    """
    pairs = {p[i - 1 : i + 1] for p in words for i in range(1, len(p))}
    marks = {ch for p in words for ch in p if not ch.isalnum() and not ch.isspace() and ch != MARK}
    while True:
        before = {c: {x for x, y in pairs if y == c} - marks - {MARK} for c in marks}
        wrong = {c for c, b in before.items() if len(b) > few}
        if not wrong:
            break
        marks -= wrong
    plain = {c for c in marks if c.isascii()}  # a short class keeps the splitting pattern fast
    return frozenset(plain), frozenset(x for x, y in pairs if y in plain) - plain - {MARK}


class Vocabulary:
    """What is broadcast: the trie, scores and ids of the pieces, and the bytes of every id."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.out: list[bytes] = [b""] * n
        self.byte_ids = [-1] * 256
        words, self.ids, self.scores = [], [], []
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.out[i] = bytes([int(p[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                words.append(p)
                self.ids.append(i)
                self.scores.append(sp.get_score(i))
                self.out[i] = p.replace(MARK, " ").encode()
        if min(self.byte_ids) < 0:
            raise ValueError("the vocabulary has no byte fallback")
        if any(MARK in p.lstrip(MARK) for p in words):
            raise ValueError("a piece holds the whitespace marker after another character")
        self.trie = DoubleArray(words)
        inside = {ch for p in words if len(p) > 1 for ch in p} | {MARK}
        self.joined = frozenset(inside)
        self.marks, self.joining = _marks(words)
        self.unknown = min(self.scores, default=0.0) - UNKNOWN_PENALTY
        self.key = hashlib.sha256(model).hexdigest()


class _Units(dict):
    """Segmentations by unit: recent ones in this dict, those of the generation before in ``old``."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder, self.old = encoder, {}

    def __missing__(self, unit: str) -> tuple[int, ...]:
        ids = self.old.get(unit)
        if ids is None:
            ids = tuple(self.encoder.viterbi(unit))
            if len(unit) > LONGEST_CACHED:
                return ids
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[unit] = ids
        return ids


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        import regex

        self.v = vocabulary
        self.units = _Units(self)
        alone = "".join(regex.escape(ch) for ch in "\n\t\r\x0b\x0c" if ch not in vocabulary.joined)
        apart = rf"[{alone}]|" if alone else ""
        self.plain = regex.compile(rf"{apart}{MARK}*[^{MARK}{alone}]+|{MARK}+").findall
        # a unit also ends before a mark: no piece joins one to what precedes it, but for a few characters
        held = regex.escape("".join(sorted(vocabulary.marks)))
        self.fine = regex.compile(rf"{apart}{MARK}*[{held}]*[^{MARK}{alone}{held}]+|{MARK}*[{held}]+|{MARK}+").findall if held else self.plain
        self.mark_bytes = [vocabulary.byte_ids[b] for b in MARK.encode()]

    def split(self, marked: str) -> list[str]:
        """Units of a text with markers; no piece spans two of them."""
        return self.plain(marked) if any(c in marked for c in self.v.joining) else self.fine(marked)

    def viterbi(self, unit: str) -> list[int]:
        """The best segmentation; of equal scores the one found first, from shorter pieces on."""
        v = self.v
        base, check, value, code, scores = v.trie.base, v.trie.check, v.trie.value, v.trie.code, v.scores
        n = len(unit)
        codes = [code.get(ch, 0) for ch in unit]
        worst = float("-inf")
        best, back = [0.0] + [worst] * n, [(-1, -1)] * (n + 1)
        for i in range(n):
            here, s, covered = best[i], 0, False
            for j in range(i, n):
                c = codes[j]
                t = base[s] + c
                if not c or check[t] != s or not t:
                    break
                s = t
                if (w := value[s]) >= 0:
                    covered |= j == i
                    if (score := here + scores[w]) > best[j + 1]:
                        best[j + 1], back[j + 1] = score, (i, w)
            if not covered and here + v.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = here + v.unknown, (i, -1)
        out, at = [], n
        while at:
            i, w = back[at]
            out.append([v.ids[w]] if w >= 0 else [v.byte_ids[b] for b in unit[i:at].encode()])
            at = i
        return [x for part in reversed(out) for x in part]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        known = self.units.__getitem__
        if MARK not in text:
            return list(chain.from_iterable(map(known, self.split(MARK + text.replace(" ", MARK)))))
        out: list[int] = []
        for k, part in enumerate(text.split(MARK)):
            if k:
                out += self.mark_bytes
            marked = part.replace(" ", MARK)
            out += chain.from_iterable(map(known, self.split(marked if k else MARK + marked)))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        raw = b"".join(map(self.v.out.__getitem__, ids))
        return raw.decode("utf-8", "replace").removeprefix(" ")

    def restores(self, ids: list[int], text: str | None) -> bool:
        """Whether decoding gives the text back, without building the decoded string."""
        return b"".join(map(self.v.out.__getitem__, ids)) == (b" " + text.encode() if text else b"")


def encoder(vocabulary: Vocabulary) -> Encoder:
    """The worker's encoder; it outlives the task."""
    if _STATE.get("key") != vocabulary.key:
        _STATE.update(key=vocabulary.key, encoder=Encoder(vocabulary))
    return _STATE["encoder"]


def load(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary(f.read())


def encode_texts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_pieces, ids, round_trip)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                texts = part.column("text").to_pylist()
                ids = [enc.encode(t) for t in texts]
                same = [enc.restores(i, t) for i, t in zip(ids, texts, strict=True)]
                ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(ends[-1]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(same, pa.bool_())],
                    names=["doc_id", "n_pieces", "ids", "round_trip"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_pieces long, ids array<int>, round_trip boolean")


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text); null ids decode to an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        for b in batches:
            texts = [enc.decode(i or []) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents``: its piece ids, and whether they decode to it."""
    import public_tokenizers

    return encode_texts(table(spark, sf_dir, "documents"), load(public_tokenizers.path("piece_bpe_32k.model")))
