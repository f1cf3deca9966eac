"""Evaluation texts leaking into training text (problem 8): n-gram seeds, bounds on the score, local alignment.

1. Items become word sequences. Each run of `run` words of an item (all its words, if fewer) is to be found
   wherever it stands in a document, and each edited copy by its score.
2. One pass over the corpus looks up the n-grams of all items. An exact run shows in those of `seed` words: they follow each
   other on one diagonal.
3. An edited copy shows in pairs of words. With M matched words and E edits an alignment scores 2 M - E, and M words in at
   most E + 1 runs make M - E - 1 matched pairs at least. So a score of `least` x 2 m, m the words of the item, needs pairs at
   (2 least - 1) m - 1 places of the item or more; an item for which that is nothing needs `least` x m of its words. Documents and
   items with fewer cannot reach the score and go no further: no copy is lost, however regular its edits.
4. Of those, two more bounds that no alignment exceeds leave few. For all that stay, a Smith-Waterman alignment of the item
   with the parts of the document that may reach the score gives the score and the longest run.

Neither the size of the corpus nor the number of copies plays a part.

Scale: the corpus is read once, by a narrow map, and is never shuffled. Items are a stated query set; they go
to the executors in blocks of at most `block_words` words, one pass over the corpus per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.words import parts, words
from corpusmill.session import written

RUN, SEED, LEAST = 13, 4, 0.6
#: Counts of documents x items that are held at once.
CELLS = 1 << 22


def item_words(items: DataFrame, id_col: str = "item_id", text: str = "text", run: int = RUN) -> DataFrame:
    """(item_id, words, unique): unique are the starts of those runs that stand in no other item.

    Items without words and null ids are left out; rows of one id and the same words count once.
    """
    d = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text).alias("text")).where("item_id is not null")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array([words(x) for x in b.column("text").to_pylist()], pa.list_(pa.string()))], names=["item_id", "words"])

    it = written(d.mapInArrow(split, "item_id long, words array<string>").where(F.size("words") > 0).distinct(), "items")
    size = F.least(F.size("words"), F.lit(run))
    lengths = [r[0] for r in it.select(size).distinct().collect()]  # at most `run`
    grams = lambda n: F.transform(F.sequence(F.lit(0), F.size("words") - n), lambda i: F.struct(i.alias("start"), F.array_join(F.slice("words", i + 1, n), " ").alias("gram")))
    all_ = None
    for n in lengths:
        g = it.where(F.size("words") >= n).select("item_id", F.explode(grams(n)).alias("g"), (size == n).alias("own"), "words").select("item_id", "own", "words", "g.*")
        shared = g.groupBy("gram").agg(F.count_distinct("item_id").alias("items"))
        g = g.where("own").join(shared, "gram").groupBy("item_id", "words").agg(F.collect_list(F.when(F.col("items") == 1, F.col("start"))).alias("unique"))
        all_ = g if all_ is None else all_.unionByName(g)
    return all_ if all_ is not None else it.select("item_id", "words", F.array().cast("array<int>").alias("unique"))


class Table:
    """Numbers of codes, from 1; 0 for one that is not in the table."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.unique(codes)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(codes), dtype=np.int64)
        i = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where((self.codes[i] == codes) & (codes > 0), i + 1, 0)


class Postings:
    """Of each number the items that have it and at how many places."""

    def __init__(self, per_item: list[np.ndarray], size: int):
        number = np.concatenate([np.empty(0, np.int64), *per_item])
        item = np.repeat(np.arange(len(per_item)), [len(x) for x in per_item])
        key, self.weight = np.unique(number * len(per_item) + item, return_counts=True)
        self.item = key % max(1, len(per_item))
        self.start = np.searchsorted(key // max(1, len(per_item)), np.arange(size + 2))

    def count(self, doc: np.ndarray, number: np.ndarray, docs: int, items: int) -> np.ndarray:
        """docs x items: the places of each item that the numbers of each document hold."""
        u = np.unique(doc * (len(self.start)) + number)
        doc, number = u // len(self.start), u % len(self.start)
        n = self.start[number + 1] - self.start[number]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start[number], n)
        return np.bincount(np.repeat(doc, n) * items + self.item[at], self.weight[at], docs * items).reshape(docs, items)


class Items:
    """A block of items as numbers: words, pairs of words, and every n-gram of `seed` words (fewer in a shorter item).

    An n-gram of three or four words is a pair and a word or a pair and a pair, so no code exceeds the square of their number.
    """

    def __init__(self, rows: list[tuple[int, list[str], list[int]]], run: int = RUN, seed: int = SEED, least: float = LEAST):
        self.vocab: dict[str, int] = {}
        self.ids = [r[0] for r in rows]
        self.unique = [frozenset(r[2]) for r in rows]
        self.seq = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in r[1]], dtype=np.int64) for r in rows]
        self.run = [min(run, len(s)) for s in self.seq]
        self.seed, self.least = seed, least
        self.base = len(self.vocab) + 1
        codes = [self._pair(s) for s in self.seq]
        self.pairs = Table(np.concatenate([np.empty(0, np.int64), *codes]))
        pairs = [self.pairs(c) for c in codes]
        # n-grams by their length: number -> places
        self.grams: dict[int, Table] = {}
        self.places: dict[int, list[list[tuple[int, int]]]] = {}
        own = [min(seed, len(s)) for s in self.seq]
        for n in sorted(set(own)):
            here = [(k, self._gram(s, p, n)) for k, (s, p) in enumerate(zip(self.seq, pairs, strict=True)) if own[k] == n]
            table = self.grams[n] = Table(np.concatenate([c for _, c in here]))
            places = self.places[n] = [[] for _ in range(len(table.codes) + 1)]
            for k, c in here:
                for i, g in enumerate(table(c).tolist()):
                    places[g].append((k, i))
        # what a copy needs: pairs of so many places, or words of so many
        sizes = np.array([len(s) for s in self.seq])
        need = np.ceil((2 * least - 1) * sizes - 1 - 1e-9)
        self.by_pairs = need > 0
        self.need = np.where(self.by_pairs, need, np.ceil(least * sizes - 1e-9))
        none = np.empty(0, np.int64)
        self.pair_items = Postings([p if b else none for p, b in zip(pairs, self.by_pairs, strict=True)], len(self.pairs.codes))
        self.word_items = Postings([none if b else s for s, b in zip(self.seq, self.by_pairs, strict=True)], self.base)

    def _pair(self, ids: np.ndarray) -> np.ndarray:
        """The code of each two words; 0 if either is none of an item's."""
        a, b = ids[:-1], ids[1:]
        return np.where((a > 0) & (b > 0), a * self.base + b, 0)

    def _gram(self, ids: np.ndarray, pairs: np.ndarray, n: int) -> np.ndarray:
        """The code of each n words; 0 if one of them is none of an item's."""
        if n == 1:
            return ids
        if n == 2:
            return pairs
        a, b = (pairs[:-1], ids[2:]) if n == 3 else (pairs[:-2], pairs[2:])
        return np.where((a > 0) & (b > 0), a * (max(self.base, len(self.pairs.codes) + 1)) + b, 0)


class Batch:
    """Documents as one array of word numbers, with a gap after each."""

    def __init__(self, docs: list[list[str]], items: Items):
        gap = 4
        get = items.vocab.get
        self.ids = np.zeros(sum(map(len, docs)) + gap * len(docs), dtype=np.int64)
        starts, at = [], 0
        for d in docs:
            starts.append(at)
            self.ids[at : at + len(d)] = np.fromiter((get(w, 0) for w in d), dtype=np.int64, count=len(d))
            at += len(d) + gap
        self.starts, self.sizes, self.items = np.array(starts, dtype=np.int64), list(map(len, docs)), items
        self.pairs = items.pairs(items._pair(self.ids)) if len(self.ids) > 1 else np.empty(0, np.int64)

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, pos, side="right") - 1

    def of(self, k: int) -> np.ndarray:
        return self.ids[self.starts[k] : self.starts[k] + self.sizes[k]]

    def seeds(self) -> dict[int, list[tuple[int, int, int]]]:
        """By document: (position, words, number) of all n-grams of items, by position."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        for n, table in self.items.grams.items():
            if len(self.ids) < n:
                continue
            g = table(self.items._gram(self.ids, self.pairs, n))
            pos = np.flatnonzero(g)
            doc = self.doc_of(pos)
            for d, p, x in zip(doc.tolist(), (pos - self.starts[doc]).tolist(), g[pos].tolist(), strict=True):
                out.setdefault(d, []).append((p, n, x))
        return out

    def candidates(self) -> dict[int, list[int]]:
        """By document: the items whose pairs or words it has as often as a copy needs."""
        items, out = self.items, {}
        k = len(items.seq)
        if not len(self.starts) or not k:
            return out
        found = []
        for numbers, postings, some in ((self.pairs, items.pair_items, items.by_pairs.any()), (self.ids, items.word_items, not items.by_pairs.all())):
            if some:
                pos = np.flatnonzero(numbers)
                found.append((self.doc_of(pos), numbers[pos], postings))
        step = max(1, CELLS // k)
        for lo in range(0, len(self.starts), step):
            n = min(step, len(self.starts) - lo)
            count = np.zeros((n, k))
            for doc, numbers, postings in found:
                a, b = np.searchsorted(doc, [lo, lo + n])
                count += postings.count(doc[a:b] - lo, numbers[a:b], n, k)
            for d, i in zip(*(x.tolist() for x in np.nonzero(count >= items.need)), strict=True):
                out.setdefault(lo + d, []).append(i)
        return out


def align(item: np.ndarray, doc: np.ndarray, match: int = 2, mismatch: int = -1, gap: int = -1) -> tuple[int, np.ndarray]:
    """Smith-Waterman: the best local score, and of each item position the longest run without an edit that ends there."""
    m, n = len(item), len(doc)
    j = np.arange(n + 1)
    prev, best = np.zeros(n + 1, dtype=np.int64), 0
    run_prev = np.zeros(n + 1, dtype=np.int64)
    longest = np.zeros(m, dtype=np.int64)
    for i in range(m):
        same = doc == item[i]
        run = np.zeros(n + 1, dtype=np.int64)
        run[1:] = np.where(same, run_prev[:-1] + 1, 0)
        longest[i] = run.max(initial=0)
        run_prev = run
        h = np.zeros(n + 1, dtype=np.int64)
        h[1:] = np.maximum(0, np.maximum(prev[:-1] + np.where(same, match, mismatch), prev[1:] + gap))
        h = np.maximum.accumulate(h - gap * j) + gap * j  # gaps in the item
        best = max(best, int(h.max()))
        prev = h
    return best, longest


def walk(matches: np.ndarray) -> np.ndarray:
    """At each place the best sum of neighbours that ends there, 2 for each true and -1 for each false, and at least 0. Of the words
    of a document that an item has, or of an item that a document has, its maximum bounds the score of `align`: a word that is
    not matched costs 1 at least."""
    c = np.cumsum(np.where(matches, 2, -1))
    return c - np.minimum(np.minimum.accumulate(c), 0)


def reaching(h: np.ndarray, need: float) -> list[list[int]]:
    """The stretches [from, to) of a walk between its zeros that reach `need`. An alignment across a zero is no better than its rest
    after it, so the best one lies within one of these."""
    out: list[list[int]] = []
    zeros = np.flatnonzero(h == 0)
    for e in np.flatnonzero(h >= need).tolist():
        if out and e < out[-1][1]:
            continue
        z = int(np.searchsorted(zeros, e))
        out.append([int(zeros[z - 1]) + 1 if z else 0, int(zeros[z]) if z < len(zeros) else len(h)])
    return out


def aligned(ids: np.ndarray, hits: list[tuple[int, int, int]], candidates: list[int], items: Items) -> Iterator[tuple[int, float, int, bool]]:
    """(item, score, longest run, exact) of the items that the document has exactly or with the least score. ids: its words; hits:
    (position, words, number) of its n-grams; candidates: the items that may reach the score.

    score is 1 for a whole copy. exact: a run stands in the document that stands in no other item. longest run: in the parts
    of the document that were aligned.
    """
    near: dict[int, dict[int, set[int]]] = {}  # by item and diagonal: starts of n-grams in the item
    for p, n, g in hits:
        for k, i in items.places[n][g]:
            near.setdefault(k, {}).setdefault(p - i, set()).add(i)
    may, exacts = set(candidates), {}
    for k, diagonals in near.items():
        grams = items.run[k] - min(items.seed, len(items.seq[k])) + 1
        at = [d for d, there in diagonals.items() if len(there) >= grams and any(i in items.unique[k] and all(i + j in there for j in range(grams)) for i in there)]
        if at:
            exacts[k] = at
    if not may and not exacts:
        return
    there, own = np.zeros(items.base, dtype=bool), np.zeros(items.base, dtype=bool)
    there[ids] = True
    there[0] = False
    for k in sorted(may | exacts.keys()):
        item, spans = items.seq[k], []
        m = len(item)
        need = 2 * m * items.least - 1e-6
        if k in may and walk(there[item]).max() >= need:
            own[item] = True
            spans = reaching(walk(own[ids]), need)
            own[item] = False
        spans += [[max(0, d - 2 * m), min(len(ids), d + 3 * m)] for d in exacts.get(k, ())]
        best, longest, done = 0, 0, 0
        for lo, hi in sorted(spans):
            if hi <= done:
                continue
            score, runs = align(item, ids[lo:hi])
            best, longest, done = max(best, score), max(longest, int(runs.max(initial=0))), hi
        if k in exacts or best >= need:
            yield items.ids[k], best / (2 * m), longest, k in exacts


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", run: int = RUN, seed: int = SEED, block_words: int = 200_000, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, score, longest_run, exact) of each document and item that are exact or have a score of `least`.

    Documents without text have no rows; an empty benchmark gives none. Null doc_ids are left out.
    """
    spark = df.sparkSession
    if not 1 <= seed <= min(run, 4):
        raise ValueError("a seed has 1 to 4 words, and no more than a run")
    d = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    schema = "doc_id long, item_id long, score double, longest_run int, exact boolean"
    out = None
    for rows in _blocks(item_words(benchmark, run=run), block_words):
        part = d.mapInArrow(_aligner(Items(rows, run, seed, least)), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def _blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[int, list[str], list[int]]]]:
    block, size = [], 0
    for r in items.orderBy("item_id").toLocalIterator():
        if block and size + len(r["words"]) > block_words:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["words"], r["unique"]))
        size += len(r["words"])
    if block:
        yield block


def _aligner(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ids = b.column("text").to_pylist(), b.column("doc_id").to_pylist()
            for s, e in parts(texts, 2000, 4_000_000):
                batch = Batch([words(x) for x in texts[s:e]], items)
                seeds, may = batch.seeds(), batch.candidates()
                out: list[tuple] = []
                for k in sorted(seeds.keys() | may.keys()):
                    out += [(ids[s + k], *x) for x in aligned(batch.of(k), seeds.get(k, []), may.get(k, []), items)]
                cols = list(zip(*out, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "score", "longest_run", "exact"])

    return run
