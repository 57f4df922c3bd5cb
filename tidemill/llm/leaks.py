"""Problem 9: evaluation texts leaking into training text.

Both sides are brought to one form and cut into words. Of every passage of an item (``PASSAGE`` consecutive words, or the
whole item if it has fewer) the rarest of its n-grams is its seed, by the number of documents that hold it, counted over
all documents; a document that holds the passage holds the seed, so no leak is missed, and boilerplate that stands in a
third of all documents seeds nothing. Documents and items that share a seed are aligned word by word (Smith and Waterman),
which scores edited copies, and the longest run of equal words decides whether a passage is held as it is.

``near`` reports edited copies without seeds: every document is held against every item, those pairs that share too few words
to reach the bound are left out, and the others are aligned many at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.lookalike import one_form
from tidemill.session import Scratch

#: Consecutive words that make a leak; words of a seed.
PASSAGE, GRAM = 12, 5
#: Item n-grams are broadcast, to drop the documents' other n-grams early, up to this many (8 bytes each).
BROADCAST_GRAMS = 1 << 20
#: Documents compared with all items at once; cells of a diagonal, and document words, of a block of pairs.
NEAR_DOCS, NEAR_CELLS, NEAR_WORDS = 512, 1 << 15, 1 << 19
#: Scores of the alignment.
MATCH, MISMATCH, GAP = 2, -1, -1

WORD = regex.compile(r"[\p{L}\p{Nd}]+")


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits of the canonical form, in lower case; none for null."""
    return WORD.findall(one_form(text).lower()) if text else []


def _numbers(texts: list[list[str]], cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """All words of some texts as 64-bit hashes in one array, and the number of the text of each."""
    flat = []
    for t in texts:
        for w in t:
            h = cache.get(w)
            if h is None:
                if len(cache) > 1 << 18:
                    cache.clear()
                h = cache[w] = xxhash.xxh64_intdigest(w)
            flat.append(h)
    return np.array(flat, np.uint64), np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def _grams(flat: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of all runs of n words that lie in one text."""
    m = len(flat) - n + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h = np.full(m, n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            h = (h ^ flat[i : m + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    at = np.flatnonzero(owner[:m] == owner[n - 1 :])
    return at, h[at].view(np.int64)


def align(item: list[str], doc: list[str]) -> tuple[int, int]:
    """(longest run of equal words, best local alignment score) of an item and a document."""
    ids: dict[str, int] = {}
    a = [ids.setdefault(w, len(ids)) for w in item]
    b = np.array([ids.get(w, -1) for w in doc], np.int64)
    if not a or not len(b):
        return 0, 0
    step = -GAP * np.arange(len(b) + 1)
    score, run, best, longest = np.zeros(len(b) + 1, np.int64), np.zeros(len(b) + 1, np.int64), 0, 0
    for w in a:
        same = b == w
        new = np.zeros_like(run)
        new[1:][same] = run[:-1][same] + 1
        run = new
        longest = max(longest, int(run.max()))
        row = np.maximum(score + GAP, 0)
        row[1:] = np.maximum(row[1:], score[:-1] + np.where(same, MATCH, MISMATCH))
        score = np.maximum.accumulate(row + step) - step  # gaps in the item
        best = max(best, int(score.max()))
    return longest, best


def _table(texts: list[np.ndarray], none: int, back: bool = False) -> np.ndarray:
    """Word numbers of texts as rows of one width; ``none`` fills up. ``back``: each from its end, the filling before it."""
    out = np.full((len(texts), max(map(len, texts), default=0)), none, np.int32)
    for row, x in zip(out, texts, strict=True):
        row[len(row) - len(x) if back else 0 : len(row) if back else len(x)] = x[::-1] if back else x
    return out


def align_many(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``align`` of many pairs of word numbers at once, by anti-diagonals. a: (word of the item, pair), filled up behind;
    b: (word of the document from its end, pair), filled up before, so that a diagonal is a slice of both. What fills up, and
    words that no item has, are negative and differ on both sides."""
    m, n, pairs = len(a), len(b), a.shape[1]
    kind = np.int16 if MATCH * m < 1 << 15 else np.int32
    before, last, new = (np.zeros((m + 1, pairs), kind) for _ in range(3))  # scores of three diagonals, by position in the item
    run0, run1, run2 = (np.zeros((m + 1, pairs), kind) for _ in range(3))
    most, longest = np.zeros((m + 1, pairs), kind), np.zeros((m + 1, pairs), kind)
    same, cell, gap = np.empty((m, pairs), bool), np.empty((m, pairs), kind), np.empty((m, pairs), kind)
    for d in range(2, m + n + 1):
        lo, hi = max(1, d - n), min(m, d - 1)
        own, prior, k = slice(lo, hi + 1), slice(lo - 1, hi), hi - lo + 1
        s, c, g = same[:k], cell[:k], gap[:k]
        np.equal(a[prior], b[n - d + lo : n - d + hi + 1], out=s)
        np.copyto(c, s)
        np.add(run0[prior], kind(1), out=run2[own])
        run2[own] *= c
        np.maximum(longest[own], run2[own], out=longest[own])
        c *= kind(MATCH - MISMATCH)
        c += before[prior]
        c += kind(MISMATCH)
        np.maximum(last[own], last[prior], out=g)
        g += kind(GAP)
        np.maximum(c, g, out=c)
        np.maximum(c, kind(0), out=new[own])
        np.maximum(most[own], new[own], out=most[own])
        before, last, new = last, new, before
        run0, run1, run2 = run1, run2, run0
    return longest.max(0), most.max(0)


def align_pairs(items: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(longest run of equal words, best local alignment score) of each item and the document beside it, as arrays of word
    numbers (negative in a document where no item has the word); those alike in length are aligned together."""
    size, length = (np.array([len(x) for x in side], np.int64) for side in (items, docs))
    longest, best = np.zeros(len(items), np.int32), np.zeros(len(items), np.int32)
    order = np.lexsort((length, size // 16))
    order = order[(size[order] > 0) & (length[order] > 0)]
    start = 0
    while start < len(order):
        x = order[start : start + NEAR_CELLS // int(size.max()) + 1]
        x = x[: max(1, NEAR_WORDS // int(length[x].max()))]
        a, b = _table([items[k] for k in x], -1), _table([docs[k] for k in x], -2, back=True)
        longest[x], best[x] = align_many(np.ascontiguousarray(a.T), np.ascontiguousarray(b.T))
        start += len(x)
    return longest, best


def _reach(held: np.ndarray) -> np.ndarray:
    """The most that any run of words of each row can score, if those held are all matched and the others are edits."""
    total = np.zeros((len(held), held.shape[1] + 1), np.int32)
    np.cumsum(np.where(held, np.int32(MATCH), np.int32(max(MISMATCH, GAP))), 1, out=total[:, 1:])
    return (total - np.minimum.accumulate(total, 1)).max(1)


def _of(df: DataFrame, key: str, known: np.ndarray | None, sizes: list[int], spark: SparkSession) -> DataFrame:
    """(key, gram) of all n-grams of the given sizes, only those in ``known`` if it is given; each once per text and batch."""
    shared = None if known is None else spark.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.slice(at, 512)
                ids = part.column(key).to_numpy(zero_copy_only=False)
                flat, owner = _numbers([words(t) for t in part.column("text").to_pylist()], cache)
                for n in sizes:
                    start, h = _grams(flat, owner, n)
                    if shared is not None and len(h):
                        k = shared.value
                        spot = np.minimum(np.searchsorted(k, h), len(k) - 1)
                        ok = k[spot] == h
                        start, h = start[ok], h[ok]
                    if len(h):
                        both = np.unique(np.stack([owner[start], h], 1), axis=0)
                        yield pa.RecordBatch.from_arrays([pa.array(ids[both[:, 0]]), pa.array(both[:, 1])], [key, "gram"])

    return df.select(key, "text").filter(F.col(key).isNotNull()).mapInArrow(run, f"{key} bigint, gram bigint")


def _passages(items: DataFrame) -> DataFrame:
    """(item_id, passage, gram, size): the n-grams of every passage of every item; n is GRAM, or less in a shorter item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        for b in batches:
            for i, t in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                own = words(t)
                if i is None or not own:
                    continue
                n, span = min(GRAM, len(own)), min(PASSAGE, len(own))
                flat, owner = _numbers([own], cache)
                _, h = _grams(flat, owner, n)
                at = np.arange(len(own) - span + 1)
                passage = np.repeat(at, span - n + 1)
                gram = h[(at[:, None] + np.arange(span - n + 1)).ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), i)), pa.array(passage.astype(np.int32)), pa.array(gram), pa.array(np.full(len(gram), n, np.int32))], ["item_id", "passage", "gram", "size"])

    return items.select("item_id", "text").mapInArrow(run, "item_id bigint, passage int, gram bigint, size int")


def leaks(spark: SparkSession, documents: DataFrame, items: DataFrame, rare: float = 0.0) -> DataFrame:
    """(doc_id, item_id, run, score, words): every document and item that share a seed, with the longest run of equal words,
    the alignment score, and the words of the item. With ``rare``, also those that share an n-gram which at most that share
    of the documents holds: passages that were edited, of which only pieces are left.

    Null, empty and wordless texts and null ids match nothing; repeated items match each for itself; empty tables give an
    empty result. Words are hashed only to find candidates, which are then compared word by word.
    """
    scratch = Scratch(spark, "leaks")
    passages = scratch.keep(_passages(items))
    grams = passages.select("gram").distinct()
    sizes = sorted(r[0] for r in passages.select("size").distinct().collect())  # at most GRAM values
    few = grams.count() <= BROADCAST_GRAMS
    known = np.sort(np.array([r[0] for r in grams.collect()], np.int64)) if few else None
    if known is not None and not len(known):
        return passages.selectExpr("item_id doc_id", "item_id", "passage run", "passage score", "size words").limit(0)
    held = _of(documents, "doc_id", known, sizes, spark)
    held = scratch.keep(held if few else held.join(grams, "gram", "left_semi"))
    common = held.groupBy("gram").agg(F.count("*").alias("df"))
    counted = passages.join(common, "gram", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    seeds = counted.groupBy("item_id", "passage").agg(F.min_by(F.struct("gram", "df"), F.struct("df", "gram")).alias("s"))
    seeds = seeds.select("item_id", "s.*").filter("df > 0").select("item_id", "gram")  # else no document holds the passage
    if rare:
        most = F.lit(max(1, int(rare * documents.count())))
        seeds = seeds.union(counted.filter((F.col("df") > 0) & (F.col("df") <= most)).select("item_id", "gram"))
    pairs = scratch.keep(held.join(seeds.select("item_id", "gram").distinct(), "gram").select("doc_id", "item_id").distinct())
    text = documents.select("doc_id", F.col("text").alias("doc"))
    ids = pairs.select("doc_id").distinct()
    text = text.join(F.broadcast(ids) if pairs.count() <= BROADCAST_GRAMS // 2 else ids, "doc_id", "left_semi")
    met = pairs.join(text, "doc_id").join(items.select("item_id", F.col("text").alias("item")), "item_id")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2048):
                b = whole.slice(at, 2048)
                number: dict[str, int] = {}
                cut = {t: np.array([number.setdefault(w, len(number)) for w in words(t)], np.int32) for t in set(b.column("item").to_pylist())}
                own = [cut[t] for t in b.column("item").to_pylist()]
                held = {t: np.array([number.get(w, -2) for w in words(t)], np.int32) for t in set(b.column("doc").to_pylist())}
                run, best = align_pairs(own, [held[t] for t in b.column("doc").to_pylist()])
                out = [b.column("doc_id"), b.column("item_id"), pa.array(run), pa.array(best), pa.array([len(x) for x in own], pa.int32())]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "item_id", "run", "score", "words"])

    return met.select("doc_id", "item_id", "doc", "item").mapInArrow(score, "doc_id bigint, item_id bigint, run int, score int, words int")


def near(spark: SparkSession, documents: DataFrame, items: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, item_id, run, score, words) of every document and item whose alignment score is at least ``least`` of a
    passage's, however common their words are.

    A score of s needs s / MATCH words that both texts hold, counted as often as both hold them, and a run of words in either
    text of which the other holds enough; pairs without are not aligned, and no other pair is left out. Items are broadcast. Null, empty and wordless texts and null ids match nothing.
    """
    rows = [(r.item_id, words(r.text)) for r in items.select("item_id", "text").filter("item_id is not null").toLocalIterator()]
    shared = spark.sparkContext.broadcast([r for r in rows if r[1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, vocabulary, places = shared.value, {}, {}
        item_words = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in own], np.int32) for _, own in known]

        def repeats(own: list[int]) -> list[tuple[int, int]]:
            """Words with how often they came before: texts share as many of these as words."""
            seen: dict[int, int] = {}
            out = []
            for w in own:
                seen[w] = seen.get(w, -1) + 1
                out.append((w, seen[w]))
            return out

        held = [[places.setdefault(x, len(places)) for x in repeats(own.tolist())] for own in item_words]
        holds = np.zeros((len(places), len(known)), np.float32)
        for i, h in enumerate(held):
            holds[h, i] = 1
        size = np.array([len(own) for own in item_words], np.int32)
        bound = least * MATCH * np.minimum(PASSAGE, size)
        narrow = np.int16 if len(vocabulary) < 1 << 15 else np.int32
        item_table = _table(item_words, -1).astype(narrow)
        has_word = np.zeros((len(known), len(vocabulary) + 2), bool)  # two columns for what no item has
        for i, own in enumerate(item_words):
            has_word[i, own] = True
        for batch in batches:
            for at in range(0, len(batch) if known else 0, NEAR_DOCS):
                part = batch.slice(at, NEAR_DOCS)
                docs = [np.array([vocabulary.get(w, -2) for w in words(t)], np.int32) for t in part.column("text").to_pylist()]
                length = np.array([len(own) for own in docs], np.int32)
                by = np.argsort(length, kind="stable")
                ids, docs, length = part.column("doc_id").to_numpy(zero_copy_only=False)[by], [docs[k] for k in by], length[by]
                has = np.zeros((len(docs), len(places)), np.float32)
                for k, own in enumerate(docs):
                    has[k, [places[x] for x in repeats(own[own >= 0].tolist()) if x in places]] = 1
                doc, item = np.nonzero(MATCH * (has @ holds) >= bound)
                left, start = [], 0
                while start < len(doc):
                    few = start + max(1, min(4096, NEAR_WORDS // max(1, int(length[doc[min(start + 4095, len(doc) - 1)]]))))
                    x, y = doc[start:few], item[start:few]
                    first = x[0]
                    table = _table(docs[first : x[-1] + 1], -2)[x - first]
                    ok = _reach(has_word[y[:, None], table]) >= bound[y]
                    in_doc = np.zeros((x[-1] + 1 - first, len(vocabulary) + 2), bool)
                    for k in range(first, x[-1] + 1):
                        in_doc[k - first, docs[k][docs[k] >= 0]] = True
                    x, y, start = x[ok], y[ok], few
                    ok = _reach(in_doc[(x - first)[:, None], item_table[y]]) >= bound[y]
                    left.append((x[ok], y[ok]))
                doc, item = (np.concatenate(c) for c in zip(*left, strict=True)) if left else (doc, item)
                order = np.lexsort((length[doc], size[item] // 16))  # alike in both lengths, so that little is filled up
                doc, item, start = doc[order], item[order], 0
                while start < len(doc):
                    end = start + NEAR_CELLS // int(size.max()) + 1
                    x, y = doc[start:end], item[start:end]
                    few = max(1, NEAR_WORDS // int(length[x].max()))
                    x, y = x[:few], y[:few]
                    one, spot = np.unique(x, return_inverse=True)
                    b = _table([docs[k] for k in one], -2, back=True).astype(narrow)[spot].T
                    longest, best = align_many(np.ascontiguousarray(item_table[y, : size[y].max()].T), np.ascontiguousarray(b))
                    ok = best >= bound[y]
                    start += len(x)
                    if ok.any():
                        x, y = x[ok], y[ok]
                        columns = [pa.array(ids[x]), pa.array([known[i][0] for i in y], pa.int64()), pa.array(longest[ok], pa.int32()), pa.array(best[ok], pa.int32()), pa.array(size[y])]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "run", "score", "words"])

    return documents.select("doc_id", "text").filter("doc_id is not null and text is not null").mapInArrow(run, "doc_id bigint, item_id bigint, run int, score int, words int")


def exact(found: DataFrame) -> DataFrame:
    """(doc_id, item_id) of which the document holds a whole passage."""
    return found.filter(F.col("run") >= F.least(F.lit(PASSAGE), "words")).select("doc_id", "item_id").distinct()


def edited(found: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, item_id, run, score): documents that hold at least ``least`` of a passage, in the alignment's measure."""
    return found.filter(F.col("score") >= least * MATCH * F.least(F.lit(PASSAGE), "words")).select("doc_id", "item_id", "run", "score")
