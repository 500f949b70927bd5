"""Benchmark decontamination by latent semantic retrieval.

1. Every text is cut into passages of 32 words (ASCII punctuation set aside, A-Z lower-cased).  A word is
   one of 8192 hashed terms; document frequencies of terms over all passages give TF-IDF weights.
2. A randomised SVD of the passage-by-term matrix A: each task adds up its part of A'(A G) for a
   Gaussian G with a fixed seed, partial sums are added by term, and the leading left singular vectors
   of the small result are the latent space.
3. Search: windows about as long as the item over every text are placed in the latent space and compared
   with all items of the block by matrix products.  A cosine of ``least_cosine`` makes a window a candidate, however
   many there are; nothing else makes candidates.  With ``own_thresholds`` an item's cosine is the higher one that
   ``UNRELATED`` of all windows of all texts reach without holding the item, to a step of ``BINS`` downwards: fewer
   candidates, and reworded items among many windows of their own topic are lost.  The queries don't use it.
4. Check: the longest common subsequence of the item and the text around the window must cover
   ``least_lcs`` of the item; for items of ``LONG`` words or more also ``least_paraphrase`` of it is enough where
   two thirds of the item's answer words (the rarer half of its words, twelve at most) stand there.

Items are worked on in blocks of about ``BLOCK_ITEMS`` items, a pass over the texts each (two with
``own_thresholds``), so what is broadcast is bounded whatever the benchmark's size.

Defined results: a null text, an empty one and one without words match nothing; items without words match
nothing; equal items match alike; repeated rows give repeated matches; rows without a
doc_id are reported with a null doc_id; empty tables give no matches; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.session import table, unused
from llm.textkernel import PLAIN, word_hashes

TERM_BITS = 13
TERMS = 1 << TERM_BITS
PASSAGE = 32
RANK = 24
EXTRA = 8
ANSWERS = 12
LEAST_COSINE = 0.3
LEAST_LCS = 0.6
LEAST_PARAPHRASE = 0.5
LONG = 16
BLOCK = 8
#: the share of unrelated windows that may be candidates of an item, how many windows that must be for an item to get
#: a threshold of its own, and the steps from the least cosine to 1 that windows are counted by
UNRELATED = 0.06
LEAST_ABOVE = 50
BINS = 256
#: neighbouring windows whose terms are compared with an item's together at first, and the pairs of such a run and an
#: item that are compared at once, few enough for a core's cache
RUN = 4
RUN_CELLS = 1 << 16
#: counts of items' words in blocks of texts that are held at once, which bounds the items for a long text
COUNT_CELLS = 1 << 21
BLOCK_ITEMS = 4096
#: the longest set of hashed bits of a block's terms
MOST_BITS = 1024
_TERM_SHIFT = np.uint64(64 - TERM_BITS)


def passages(column: pa.Array) -> Iterator[np.ndarray]:
    """Matrices (passages, PASSAGE) of terms, -1 where the last passage of a text is short."""
    for _, _, hashes, counts in word_hashes(column, PLAIN):
        out = _rows_of((hashes >> _TERM_SHIFT).astype(np.int16), counts, PASSAGE)
        if len(out):
            yield out


def _rows_of(terms: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """(rows, width): the terms of each text from a row of its own on, -1 where its last row is short."""
    rows = -(-counts // width)
    out = np.full(int(rows.sum()) * width, -1, dtype=np.int16)
    shift = (np.cumsum(rows) - rows) * width - (np.cumsum(counts) - counts)
    out[np.arange(len(terms)) + np.repeat(shift, counts)] = terms
    return out.reshape(-1, width)


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(TERMS + 1, dtype=np.int64), 0
    for b in batches:
        for p in passages(b.column("text")):
            s = np.sort(p, axis=1)
            new = s >= 0
            new[:, 1:] &= s[:, 1:] != s[:, :-1]
            df[:TERMS] += np.bincount(s[new], minlength=TERMS)
            n += len(p)
    df[TERMS] = n
    seen = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(df[seen])], names=["term", "n"])


def term_weights(docs: DataFrame) -> np.ndarray:
    """The inverse document frequency of every term over all passages."""
    got = docs.select("text").mapInArrow(_count_terms, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # at most TERMS + 1 rows
    df = np.zeros(TERMS + 1)
    for r in got:
        df[r.term] = r.n
    return np.log((1 + df[TERMS]) / (1 + df[:TERMS])).astype(np.float32) + np.float32(0.01)


def _project(idf: np.ndarray, terms: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights of the tokens of each passage, the passages times the basis)."""
    w = np.where(terms >= 0, idf[terms], np.float32(0))
    w /= np.maximum(np.sqrt((w * w).sum(axis=1, keepdims=True)), 1e-6)
    y = np.empty((len(terms), basis.shape[1]), dtype=np.float32)
    for a in range(0, len(terms), 256):
        y[a : a + 256] = np.matmul(w[a : a + 256, None, :], basis[terms[a : a + 256]])[:, 0]
    return w, y


def _gram_part(idf: np.ndarray, seed: int):
    width = RANK + EXTRA

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = np.random.default_rng(seed).standard_normal((TERMS, width)).astype(np.float32)
        z = np.zeros((TERMS, width))
        for b in batches:
            for p in passages(b.column("text")):
                w, y = _project(idf, p, start)
                # passages by columns, a sum by term each; the row of no term is left out
                w, y = w.astype(np.float64), np.ascontiguousarray(y.T, dtype=np.float64)
                at, parts = np.where(p >= 0, p, TERMS).reshape(-1).astype(np.intp), np.empty(p.shape)
                for k in range(width):
                    np.multiply(w, y[k][:, None], out=parts)
                    z[:, k] += np.bincount(at, weights=parts.reshape(-1), minlength=TERMS + 1)[:TERMS]
        seen = np.flatnonzero(z.any(axis=1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(seen), *[pa.array(z[seen, k]) for k in range(width)]], names=["term", *[f"z{k}" for k in range(width)]])

    return run


def latent_basis(docs: DataFrame, idf: np.ndarray, seed: int = 7) -> np.ndarray:
    """(TERMS, RANK): leading right singular vectors of the TF-IDF matrix by a randomised SVD over all passages."""
    width = RANK + EXTRA
    schema = "term int, " + ", ".join(f"z{k} double" for k in range(width))
    summed = docs.select("text").mapInArrow(_gram_part(idf, seed), schema).groupBy("term").agg(*[F.sum(f"z{k}").alias(f"z{k}") for k in range(width)])
    z = np.zeros((TERMS, width))
    for r in summed.collect():  # at most TERMS rows
        z[r.term] = r[1:]
    left, _, _ = np.linalg.svd(z, full_matrices=False)
    return np.ascontiguousarray(left[:, :RANK], dtype=np.float32)


class Items:
    """A block of benchmark items: word hashes, answer words and places in the latent space."""

    def __init__(self, ids: list[int], texts: list[str], idf: np.ndarray, basis: np.ndarray) -> None:
        self.ids, self.words, self.answers = [], [], []
        at = 0
        for _, _, hashes, counts in word_hashes(pa.array(texts, pa.string()), PLAIN):
            ends = np.cumsum(counts)
            for k, c in enumerate(counts.tolist()):
                if c:
                    h = hashes[ends[k] - c : ends[k]]
                    own = np.unique(h)
                    rare = own[np.lexsort((own, -idf[(own >> _TERM_SHIFT).astype(np.int64)]))]
                    self.ids.append(ids[at + k])
                    self.words.append(h)
                    self.answers.append(rare[: min(ANSWERS, -(-len(own) // 2))])
            at += len(counts)
        spots = [_place((w >> _TERM_SHIFT).astype(np.int64), idf, basis) for w in self.words]
        self.spots = np.array(spots, dtype=np.float32).reshape(-1, basis.shape[1])
        #: each item's words as bit masks of their positions
        self.masks = [_masks(w) for w in self.words]
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.least = np.full(len(self.ids), LEAST_COSINE)
        #: whether an item holds a term; the column of no term, the last, is empty
        self.holds = np.zeros((len(self.ids), TERMS + 1), dtype=bool)
        for k, w in enumerate(self.words):
            self.holds[k, (w >> _TERM_SHIFT).astype(np.int64)] = True
        self.groups = _by_window(self.sizes)

    def signatures(self, ks: np.ndarray, bits: int) -> np.ndarray:
        """The terms of the items as sets of hashed bits, see _signatures."""
        held = self.holds[ks, :TERMS].reshape(len(ks), TERMS // bits, bits).any(axis=1)
        return np.packbits(held, axis=1, bitorder="little").view("<u8").astype(np.uint64)

    def count_windows(self, hashes: np.ndarray, counts: np.ndarray, weighted: np.ndarray, least_cosine: float, least_lcs: float) -> np.ndarray:
        """(items, BINS + 1): the windows over all texts by the step of their cosine from ``least_cosine`` on; first, those below it or that hold the item."""
        out = np.zeros((len(self.ids), BINS + 1), dtype=np.int64)
        terms = (hashes >> _TERM_SHIFT).astype(np.int16)
        sums, blocks = _block_sums(terms, counts, weighted), _rows_of(terms, counts, BLOCK)
        per_text = -(-counts // BLOCK)
        before = np.cumsum(per_text) - per_text
        scale = BINS / _range(least_cosine)
        for wide, group in self.groups:
            x, text, first = _windows(sums, counts, wide)
            start, end = before[text] + first, before[text] + np.minimum(first + wide, per_text[text])
            at_once = max(1, COUNT_CELLS // max(1, len(blocks)))
            for ks in np.split(group, range(at_once, len(group), at_once)):
                # running sums over the blocks of the words that each item has too
                own = np.ascontiguousarray(self.holds[ks].T).view(np.uint8)
                inside = np.zeros((len(blocks) + 1, len(ks)), dtype=np.int32)
                np.cumsum(sum(own[blocks[:, k]] for k in range(BLOCK)), axis=0, out=inside[1:])
                spots, enough = np.ascontiguousarray(self.spots[ks].T), np.ceil(least_lcs * self.sizes[ks]).astype(np.int32)
                row, cells = np.arange(len(ks)) * (BINS + 1), len(ks) * (BINS + 1)
                some = max(1, (1 << 18) // len(ks))
                for at in range(0, len(x), some):
                    step = x[at : at + some] @ spots
                    step -= np.float32(least_cosine)
                    step *= np.float32(scale)
                    step += np.float32(1)
                    cell = np.clip(step, 0, BINS, out=step).astype(np.intp)
                    cell += row
                    held = np.flatnonzero(inside[end[at : at + some]] - inside[start[at : at + some]] >= enough)
                    cell.reshape(-1)[held] = row[held % len(ks)]
                    out[ks] += np.bincount(cell.reshape(-1), minlength=cells).reshape(len(ks), BINS + 1)
        return out

    def settle(self, windows: np.ndarray, least_cosine: float) -> None:
        """Each item's least cosine by the counts of all windows: no more than ``UNRELATED`` of them lie in higher steps; ``least_cosine`` at least."""
        few = (UNRELATED * windows.sum(axis=1)).astype(np.int64)
        reach = np.cumsum(windows[:, :0:-1], axis=1)
        step = np.maximum((reach > few[:, None]).sum(axis=1) - 1, 0)
        self.least = least_cosine + np.where(few >= LEAST_ABOVE, step, 0) * (_range(least_cosine) / BINS)

    def calibrate(self, texts: list[str], weighted: np.ndarray, least_cosine: float, least_lcs: float) -> None:
        """Each item's least cosine by all windows of the texts."""
        windows = np.zeros((len(self.ids), BINS + 1), dtype=np.int64)
        for _, _, hashes, counts in word_hashes(pa.array(texts, pa.string()), PLAIN):
            windows += self.count_windows(hashes, counts, weighted, least_cosine, least_lcs)
        self.settle(windows, least_cosine)


def _range(least_cosine: float) -> float:
    """From the least cosine to 1, the range that is counted in steps."""
    return max(1 - least_cosine, 1e-6)


def _by_window(sizes: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(blocks of the window, items): windows of 1, 2, 3, 4, 6, 8, 12, ... blocks, each item in the nearest."""
    scale = [1, 2]
    while scale[-1] * BLOCK < max(sizes, default=0):
        scale += [scale[-1] * 3 // 2, scale[-1] * 2]
    near = np.abs(sizes[:, None] - np.array(scale) * BLOCK).argmin(axis=1) if len(sizes) else np.zeros(0, dtype=np.int64)
    return [(scale[g], np.flatnonzero(near == g)) for g in np.unique(near)]


def _block_sums(terms: np.ndarray, counts: np.ndarray, weighted: np.ndarray) -> np.ndarray:
    """Running sums over the blocks of all texts in the latent space; weighted ends with a row of zeros, for -1."""
    blocks = _rows_of(terms, counts, BLOCK)
    x = np.zeros((len(blocks), weighted.shape[1]), dtype=np.float32)
    for k in range(BLOCK):
        x += weighted[blocks[:, k]]
    return np.concatenate([np.zeros((1, x.shape[1])), np.cumsum(x, axis=0, dtype=np.float64)])


def _windows(sums: np.ndarray, counts: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit vectors, text, first block within the text) of windows of so many blocks over every text that has words."""
    blocks = -(-counts // BLOCK)
    step = max(1, wide // 4)
    n = np.where(blocks, -(-np.maximum(blocks - wide, 0) // step) + 1, 0)
    text = np.repeat(np.arange(len(counts)), n)
    first = np.minimum((np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * step, np.maximum(blocks - wide, 0)[text])
    base = (np.cumsum(blocks) - blocks)[text]
    x = (sums[base + np.minimum(first + wide, blocks[text])] - sums[base + first]).astype(np.float32)
    x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-9)[:, None]
    return x, text, first


def _signatures(blocks: np.ndarray, bits: int) -> np.ndarray:
    """(rows, bits / 64): each row's terms as a set of hashed bits."""
    out = np.zeros((len(blocks), bits // 64), dtype=np.uint64)
    place = blocks & np.int16(bits - 1)
    word, bit = (place >> 6).astype(np.intp), np.where(blocks >= 0, np.uint64(1) << (place & 63).astype(np.uint64), np.uint64(0))
    rows = np.arange(len(blocks))
    for k in range(blocks.shape[1]):
        out[rows, word[:, k]] |= bit[:, k]
    return out


def _bits(wide: int) -> int:
    """The length of the sets for windows of so many blocks: eight times the words about a window, bounded for memory."""
    return min(MOST_BITS, max(64, 1 << (16 * wide * BLOCK - 1).bit_length()))


def _any_of(sets: np.ndarray, n: int) -> np.ndarray:
    """The union of every row of sets and the n - 1 rows before it."""
    out, have = sets.copy(), 1
    while have < n:
        step = min(have, n - have)
        out[step:] |= out[:-step].copy()
        have += step
    return out


def _place(terms: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    x = (idf[terms, None] * basis[terms]).sum(axis=0)
    return x / max(1e-9, float(np.linalg.norm(x)))


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


def lcs_length(masks: dict[int, int], n: int, words: list[int]) -> int:
    """The longest common subsequence by bit-parallel rows, one addition for each word of the text."""
    full = (1 << n) - 1
    row = full
    for w in words:
        m = masks.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return n - bin(row).count("1")


def matches(items: Items, item: int, words: np.ndarray, least_lcs: float, least_paraphrase: float) -> float | None:
    """The share of an item that its longest common subsequence with the words covers, None where that is too little."""
    own = words[items.holds[item, (words >> _TERM_SHIFT).astype(np.int64)]]
    n = len(items.words[item])
    share = lcs_length(items.masks[item], n, own.tolist()) / n
    if share >= least_lcs:
        return share
    answers = items.answers[item]
    close = n >= LONG and share >= least_paraphrase and 3 * int(np.isin(answers, own).sum()) >= 2 * len(answers)
    return share if close else None


def _candidates(items: Items, weighted: np.ndarray, least_lcs: float, least_paraphrase: float, hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, cosine, first word, end word) of windows of all texts that are near an item in the latent space.

    The words about the window must hold as many of the item's terms as the common subsequence needs.
    """
    terms = (hashes >> _TERM_SHIFT).astype(np.int16)
    sums, blocks = _block_sums(terms, counts, weighted), _rows_of(terms, counts, BLOCK)
    begins = np.cumsum(counts) - counts
    before = np.cumsum(-(-counts // BLOCK)) + counts // -BLOCK
    flat = items.holds.reshape(-1)
    most = max((_bits(wide) for wide, _ in items.groups), default=64)
    signed = {most: _signatures(blocks, most)}
    while most > 64:  # a set of half the bits is the union of its halves
        signed[most // 2] = signed[most][:, : most // 128] | signed[most][:, most // 128 :]
        most //= 2
    for wide, ks in items.groups:
        x, text, first = _windows(sums, counts, wide)
        spots, least = items.spots[ks], items.least[ks].astype(np.float32)
        needed = np.ceil(np.where(items.sizes[ks] >= LONG, min(least_lcs, least_paraphrase), least_lcs) * items.sizes[ks] - 1e-9)
        repeats = items.sizes[ks] - items.holds[ks].sum(axis=1)
        reach = wide * BLOCK + 2 * (wide * BLOCK // 2)
        # the terms of all blocks about a window as hashed bits: they bound the terms in common from above
        bits = _bits(wide)
        aside = -(-wide // 2)
        span = wide + 2 * aside
        around = _any_of(np.concatenate([signed[bits], np.zeros((span, bits // 64), dtype=np.uint64)]), span)
        place = before[text] + first + wide + aside - 1
        own_bits = items.signatures(ks, bits)
        held_bits = np.bitwise_count(own_bits).sum(axis=1)
        least_bits = np.maximum(needed - repeats - (items.holds[ks].sum(axis=1) - held_bits), np.minimum(needed, 1)).astype(np.int32)
        # words about every place; no term beyond the ends
        about = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(reach, -1, np.int16), terms, np.full(2 * reach, -1, np.int16)]), reach)
        some = max(1, RUN_CELLS // len(ks)) * RUN
        both, ones = np.empty((len(ks), some // RUN), dtype=np.uint64), np.empty((len(ks), some // RUN), dtype=np.uint8)
        bound = np.empty((len(ks), some // RUN), dtype=np.uint8 if max(held_bits, default=0) < 256 else np.uint16)
        for at in range(0, len(x), some):
            n = min(some, len(x) - at)
            cosine = spots @ x[at : at + n].T
            sets = around[place[at : at + n]]
            # first the union of a run of windows, then each window of the runs that are left
            runs = np.ascontiguousarray(np.bitwise_or.reduceat(sets, np.arange(0, n, RUN), axis=0).T)
            r = runs.shape[1]
            bound[:, :r] = 0
            for word in range(bits // 64):
                np.bitwise_and(own_bits[:, word, None], runs[word], out=both[:, :r])
                np.bitwise_count(both[:, :r], out=ones[:, :r])
                bound[:, :r] += ones[:, :r]
            left = np.flatnonzero(bound[:, :r] >= least_bits[:, None])
            k, v = np.repeat(left // r, RUN), ((left % r)[:, None] * RUN + np.arange(RUN)).reshape(-1)
            k, v = k[v < n], v[v < n]
            near = cosine[k, v]
            enough = (near >= least[k]) & (counts[text[at + v]] >= needed[k])
            v, k, near = v[enough], k[enough], near[enough]
            common = np.zeros(len(v), dtype=np.int32)
            for word in range(bits // 64):
                common += np.bitwise_count(sets[v, word] & own_bits[k, word])
            enough = common >= least_bits[k]
            v, k, cosine = v[enough] + at, k[enough], near[enough]
            for c in range(0, len(v), max(1, (1 << 20) // reach)):
                vv, kk, cc = (z[c : c + max(1, (1 << 20) // reach)] for z in (v, k, cosine))
                t = text[vv]
                a = first[vv] * BLOCK - wide * BLOCK // 2
                near = about[begins[t] + a + reach]
                held = flat[(ks[kk] * (TERMS + 1)).astype(np.int32)[:, None] + near]
                some_j = np.flatnonzero(held.sum(axis=1) >= needed[kk])
                # a subsequence has no more words than terms in common and repeats in the item
                own = np.sort(np.where(held[some_j], near[some_j], np.int16(-1)), axis=1)
                common = ((own[:, 1:] != own[:, :-1]) & (own[:, 1:] >= 0)).sum(axis=1) + (own[:, 0] >= 0)
                for j in some_j[common >= needed[kk[some_j]] - repeats[kk[some_j]]].tolist():
                    yield int(t[j]), int(ks[kk[j]]), float(cc[j]), max(0, int(a[j])), min(int(counts[t[j]]), int(a[j]) + reach)


def _count_windows(shared, least_cosine: float, least_lcs: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weighted = shared.value
        windows = np.zeros((len(items.ids), BINS + 1), dtype=np.int64)
        for b in batches:
            for _, _, hashes, counts in word_hashes(b.column("text"), PLAIN):
                windows += items.count_windows(hashes, counts, weighted, least_cosine, least_lcs)
        item, step = np.nonzero(windows)
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(step.astype(np.int32)), pa.array(windows[item, step])], names=["item", "step", "n"])

    return run


def set_thresholds(items: Items, docs: DataFrame, weighted: np.ndarray, least_cosine: float, least_lcs: float) -> None:
    """Each item's least cosine by all windows of all texts of docs."""
    shared = docs.sparkSession.sparkContext.broadcast((items, weighted))
    found = docs.select("text").mapInArrow(_count_windows(shared, least_cosine, least_lcs), "item int, step int, n long")
    got = found.groupBy("item", "step").agg(F.sum("n").alias("n")).toArrow()  # at most BINS + 1 rows an item
    windows = np.zeros((len(items.ids), BINS + 1), dtype=np.int64)
    windows[got.column("item").to_numpy(), got.column("step").to_numpy()] = got.column("n").to_numpy()
    items.settle(windows, least_cosine)
    shared.destroy()


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least_cosine: float = LEAST_COSINE,
    least_lcs: float = LEAST_LCS,
    least_paraphrase: float = LEAST_PARAPHRASE,
    own_thresholds: bool = True,
) -> DataFrame:
    """docs(doc_id, text), benchmark(item_id, text) -> (doc_id, item_id, lcs_share, cosine, first_word, end_word).

    own_thresholds: leave out windows below the item's own cosine; without it every window of ``least_cosine`` is checked.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, lcs_share double, cosine double, first_word long, end_word long"
    wanted = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = wanted.count()
    spark = docs.sparkSession
    out = spark.createDataFrame([], schema)
    if not total:
        return out
    idf = term_weights(slim)
    basis = latent_basis(slim, idf)
    weighted = np.concatenate([idf[:, None] * basis, np.zeros((1, RANK), dtype=np.float32)])
    ordered = wanted.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(-(-total // BLOCK_ITEMS))))
    for block in range(-(-total // BLOCK_ITEMS)):
        rows = ordered.where(F.col("block") == block).orderBy("item_id", "text").collect()  # about BLOCK_ITEMS rows
        items = Items([r.item_id for r in rows], [r.text for r in rows], idf, basis)
        if not items.ids:
            continue
        if own_thresholds:
            set_thresholds(items, slim, weighted, least_cosine, least_lcs)
        else:
            items.least[:] = least_cosine
        shared = spark.sparkContext.broadcast((items, weighted))

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items, weighted = shared.value
            for b in batches:
                ids, found = b.column("doc_id").to_pylist(), []
                for i, _, hashes, counts in word_hashes(b.column("text"), PLAIN):
                    begins = np.cumsum(counts) - counts
                    best: dict[tuple[int, int], tuple] = {}
                    for k, item, cosine, first, end in _candidates(items, weighted, least_lcs, least_paraphrase, hashes, counts):
                        share = matches(items, item, hashes[begins[k] + first : begins[k] + end], least_lcs, least_paraphrase)
                        if share is not None and ((k, item) not in best or (share, cosine) > best[k, item][:2]):
                            best[k, item] = (share, cosine, first, end)
                    found += [(ids[i + k], items.ids[item], *m) for (k, item), m in best.items()]
                cols = list(zip(*found, strict=True)) if found else [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "lcs_share", "cosine", "first_word", "end_word"])

        out = out.unionByName(slim.mapInArrow(run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose text holds no benchmark item; rows without a doc_id are judged by a key of their text."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).bitwiseXOR(F.xxhash64(F.col("text").cast("string")))
    (name,) = unused(docs, "key")
    lost = find_leaks(docs.select(key.alias("doc_id"), "text"), benchmark, own_thresholds=False).select(F.col("doc_id").alias(name)).distinct()
    return docs.withColumn(name, key).join(lost, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) whose text holds the item."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), own_thresholds=False)
