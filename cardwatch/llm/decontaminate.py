"""Benchmark decontamination: BM25 over an inverted index of test items.

Each document is cut into overlapping passages (windows of words); every
passage is a query against the items.  Impacts are BM25 weights divided by the
item's own total, so a score is the share of the item that the passage covers
and one threshold fits all items.  Retrieval is block-max WAND: postings lie
sorted by item in blocks that know their largest impact; a pivot is skipped
when the maxima of its terms, then those of their current blocks, cannot reach
the threshold.  The most frequent terms, as many as stay below ``COMMON`` of
every item, share one list: what they add to an item is bounded by what all of
them together have in it, and summed exactly only when the rest of the item's
terms makes the threshold possible.  All items at or above it are candidates,
none is cut.

A candidate is verified on the whole document: the item's question (all but
its last sentence) and its answer (the last sentence) must each have at least
``OVERLAP`` of their five-word shingles in it; parts shorter than five words
must occur as they stand.  With ``whole_items`` (as the registered query and
the pipeline have it) an item is also found when its whole text, undivided, has
at least ``OVERLAP`` of its five-word shingles in the document, so an edit in
a short last sentence does not hide it; and the terms of a document of several
passages are one more query, by ``WHOLE_THRESHOLD``, so that an item need not lie
in one passage.

The thresholds are lower than the share of its weight that an item at the
overlap keeps, unless nearly all its weight lies in the words it has lost: a
recall that is measured (see README), not proved.  ``exhaustive`` adds what
no score can miss, outside the registered query: of a text with n shingles,
``needed`` of which must occur, one of any ``n - needed + 1`` occurs, so that many
of the rarest of each item are looked up in the whole document.

Items that repeat id and text stand once with their number.  They are
processed in blocks of about ``MAX_BLOCK_ITEMS`` and ``MAX_BLOCK_BYTES``, so what
is broadcast is bounded however many there are; document frequencies cover all
items, so the scores do not depend on the blocks.

Defined cases: NULL and empty texts match nothing, as documents or as items;
items repeated in the benchmark are reported each; repeated documents are
reported each; an empty table on either side gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import quoted, python_workers, written

WORD = re.compile(r"[^\W_]+")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
SHINGLE, OVERLAP = 5, 0.8
THRESHOLD, WHOLE_THRESHOLD = 0.5, 0.7
K1, B = 1.2, 0.75
BLOCK = 32
COMMON = 0.4
MAX_BLOCK_ITEMS, MAX_BLOCK_BYTES = 20_000, 32 << 20


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_answer(text: str | None) -> tuple[list[str], list[str]]:
    """Words of the question (all but the last sentence) and of the answer
    (the last one; none if the item is a single sentence)."""
    sentences = [w for w in map(words_of, SENTENCE_END.split(text or "")) if w]
    if len(sentences) < 2:
        return (sentences[0] if sentences else []), []
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """Five-word shingles; a shorter part is one shingle of all its words."""
    width = min(SHINGLE, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()


def fewest(n: int, overlap: float) -> int:
    """The smallest number of n shingles whose share reaches ``overlap``."""
    return next((k for k in range(n + 1) if k / n >= overlap), n + 1)


@dataclass
class ItemIndex:
    """Postings of one block of items, by rare term: item numbers (ascending),
    impacts, block maxima.  Of the frequent terms: the impacts by item, and
    what all of them together have in each item, with block maxima.  Of the
    shingles of items and of their longer parts: those looked up for
    ``overlap``, with the items they are looked up for."""

    ids: list[int]
    parts: list[tuple[set, set]]
    wholes: list[set]
    span: int  # words of the longest item
    copies: list[int] = field(default_factory=list)  # rows of the benchmark that each item stands for
    postings: dict[str, tuple[list[int], list[float], list[float]]] = field(default_factory=dict)
    ceiling: dict[str, float] = field(default_factory=dict)
    frequent: list[dict[str, float]] = field(default_factory=list)
    share: list[float] = field(default_factory=list)
    share_maxima: list[float] = field(default_factory=list)
    share_ceiling: float = 0.0
    looked_up: dict[tuple[str, ...], set[int]] = field(default_factory=dict)
    widths: list[int] = field(default_factory=list)  # of the shingles looked up

    @classmethod
    def build(cls, items: list[tuple], frequency: dict[str, int], n_items: int,
              mean_length: float) -> ItemIndex:
        counted = [(i, text, Counter(words_of(text)), *n) for i, text, *n in items]
        counted = [c for c in counted if c[2]]
        wholes = [shingles(words_of(text)) for _, text, *_ in counted]
        index = cls([c[0] for c in counted], [tuple(map(shingles, question_answer(c[1]))) for c in counted], wholes,
                    max((sum(c[2].values()) for c in counted), default=0), [c[3] if len(c) > 3 else 1 for c in counted])
        lists = defaultdict(list)
        for number, (_, _, tf, *_) in enumerate(counted):
            length = K1 * (1 - B + B * sum(tf.values()) / mean_length)
            impact = {t: log(1 + (n_items - frequency[t] + 0.5) / (frequency[t] + 0.5)) * n * (K1 + 1) / (n + length)
                      for t, n in tf.items()}
            total = sum(impact.values())
            for t, x in impact.items():
                lists[t].append((number, x / total))
        index.frequent, index.share = [{} for _ in counted], [0.0] * len(counted)
        for t in sorted(lists, key=lambda t: (-len(lists[t]), t)):
            if any(index.share[i] + x >= COMMON for i, x in lists[t]):
                continue
            for i, x in lists.pop(t):
                index.frequent[i][t] = x
                index.share[i] += x
        index.share_maxima = [max(index.share[i:i + BLOCK]) for i in range(0, len(counted), BLOCK)]
        index.share_ceiling = max(index.share_maxima, default=0.0)
        for t, pairs in lists.items():
            numbers, impacts = [p[0] for p in pairs], [p[1] for p in pairs]
            maxima = [max(impacts[i:i + BLOCK]) for i in range(0, len(impacts), BLOCK)]
            index.postings[t], index.ceiling[t] = (numbers, impacts, maxima), max(maxima)
        return index

    def look_up(self, overlap: float) -> None:
        """Fills ``looked_up``.  A whole item under five words needs no look-up
        of its own: where it stands, its parts stand."""
        sought = [(i, max(parts, key=lambda p: (len(next(iter(p), ())), len(p)))) for i, parts in enumerate(self.parts)]
        sought += [(i, whole) for i, whole in enumerate(self.wholes) if len(next(iter(whole))) == SHINGLE]
        held = Counter(s for _, text in sought for s in text)
        for number, text in sought:
            rarest = sorted(text, key=lambda s: (held[s], s))
            for s in rarest[:len(text) - max(fewest(len(text), overlap), 1) + 1]:
                self.looked_up.setdefault(s, set()).add(number)
        self.widths = sorted({len(s) for s in self.looked_up})

    def score(self, number: int, passage: set[str]) -> float:
        """The score of one item for the distinct terms of a passage."""
        total = sum(x for t, x in self.frequent[number].items() if t in passage)
        for t in {w for s in self.wholes[number] for w in s} & self.postings.keys() & passage:
            numbers, impacts, _ = self.postings[t]
            total += impacts[bisect_left(numbers, number)]
        return total

    def search(self, passage: set[str], threshold: float) -> dict[int, float]:
        """All items scoring at least ``threshold`` for the distinct terms of
        a passage, by block-max WAND."""
        threshold -= 1e-9  # sums may round down
        terms = self.ceiling.keys() & passage
        if self.share_ceiling + sum(map(self.ceiling.__getitem__, terms)) < threshold:
            return {}
        cursors = [[self.postings[t][0][0], 0, self.ceiling[t], self.postings[t]] for t in sorted(terms)]
        found = {}
        while cursors:
            cursors.sort(key=itemgetter(0))
            reach, pivot = self.share_ceiling, None
            for k, c in enumerate(cursors):
                reach += c[2]
                if reach >= threshold:
                    pivot = k
                    break
            if pivot is None:
                return found
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            ahead = cursors[: pivot + 1]
            for c in ahead:
                self._seek(c, target)
            most = self.share_maxima[target // BLOCK]
            if most + sum(c[3][2][c[1] // BLOCK] for c in ahead if c[0] == target) >= threshold:
                score = sum(c[3][1][c[1]] for c in ahead if c[0] == target)
                if score + self.share[target] >= threshold:
                    score += sum(x for t, x in self.frequent[target].items() if t in passage)
                    if score >= threshold:
                        found[target] = score
            for c in ahead:
                self._seek(c, target + 1)
            cursors = [c for c in cursors if c[1] < len(c[3][0])]
        return found

    @staticmethod
    def _seek(cursor: list, item: int) -> None:
        numbers = cursor[3][0]
        at = cursor[1] = bisect_left(numbers, item, cursor[1])
        cursor[0] = numbers[at] if at < len(numbers) else 1 << 62


def passages(words: list[str], span: int) -> Iterator[list[str]]:
    """Windows of twice the longest item, starting every such item: any
    stretch as long as an item lies whole in one of them."""
    step = max(span, 1)
    for at in range(0, max(len(words) - step, 1), step):
        yield words[at:at + 2 * step]


def matches(text: str | None, index: ItemIndex, threshold: float = THRESHOLD, overlap: float = OVERLAP,
            whole_items: bool = False) -> list[tuple[int, float, float, float]]:
    """(item, score, question overlap, answer overlap) of the verified items."""
    words = words_of(text)
    queries = [(set(passage), threshold) for passage in passages(words, index.span)]
    if whole_items and len(queries) > 1:
        queries.append((set(words), max(threshold, WHOLE_THRESHOLD)))
    best: dict[int, float] = {}
    for terms, least in queries:
        for number, score in index.search(terms, least).items():
            best[number] = max(best.get(number, 0.0), score)
    near: set[int] = set()
    for width in index.widths:
        if not index.looked_up.keys().isdisjoint(zip(*[words[i:] for i in range(width)])):
            found = index.looked_up.keys() & set(zip(*[words[i:] for i in range(width)]))
            near.update(*map(index.looked_up.__getitem__, found))
    said: dict[int, set] = {}  # shingles of the whole document by width

    def share(part: set) -> float:
        width = len(next(iter(part)))
        if width not in said:
            said[width] = set(zip(*[words[i:] for i in range(width)]))
        return len(part & said[width]) / len(part)

    verified = {}
    for number in sorted(best.keys() | near):
        shares = [share(part) if part else 1.0 for part in index.parts[number]]
        if min(shares) >= overlap or whole_items and share(index.wholes[number]) >= overlap:
            verified[number] = shares
    lost = verified.keys() - best.keys()
    for passage in map(set, passages(words, index.span)) if lost else ():
        for number in lost:
            best[number] = max(best.get(number, 0.0), index.score(number, passage))
    return [(index.ids[number], best[number], *shares) for number, shares in verified.items() for _ in range(index.copies[number])]


def _item_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(t, 1, 0) for text in b["text"] for t in set(words_of(text))]
        rows += [(None, int(n > 0), n) for n in (len(words_of(text)) for text in b["text"])]
        yield pd.DataFrame(rows, columns=["term", "n", "words"])


def item_indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 block_items: int = MAX_BLOCK_ITEMS) -> Iterator[ItemIndex]:
    """The index of each block of items, one at a time."""
    items = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    stats = written(items.mapInPandas(_item_terms, "term string, n long, words long")
                    .groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")), "bench-terms")
    whole = stats.where(F.col("term").isNull()).first()
    if whole is None or not whole.n:
        return
    items = written(items.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("copies")), "bench-items")
    n_items, n_bytes = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(-(-n_items // block_items), -(-(n_bytes or 0) // MAX_BLOCK_BYTES), 1)
    for k in range(blocks):
        # a hash decides the block of an item; blocks are of one size on average
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        rows = sorted((tuple(r) for r in own.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        terms = own.mapInPandas(_item_terms, "term string, n long, words long").select("term").distinct()
        frequency = {r.term: r.n for r in stats.join(terms, "term", "left_semi").collect()}
        yield ItemIndex.build(rows, frequency, whole.n, whole.words / whole.n)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, overlap: float = OVERLAP,
                 block_items: int = MAX_BLOCK_ITEMS, whole_items: bool = False, exhaustive: bool = False) -> DataFrame:
    """One row per document and test item that it contains: ``doc_id``,
    ``item_id``, ``score``, ``question_overlap``, ``answer_overlap``."""
    spark = docs.sparkSession
    python_workers(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    out = None
    for index in item_indexes(benchmark, block_items=block_items):
        if exhaustive:
            index.look_up(overlap)
        part = rows.mapInPandas(_matcher(spark.sparkContext.broadcast(index), threshold, overlap, whole_items), schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def _matcher(index, threshold: float, overlap: float, whole_items: bool):
    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(d, *m) for d, text in zip(b["doc_id"], b["text"]) for m in matches(text, index.value, threshold, overlap, whole_items)]
            out = pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
            yield out.astype({"doc_id": "Int64", "item_id": "Int64"})
    return match


def _flagger(index, threshold: float, overlap: float, whole_items: bool):
    @F.pandas_udf("boolean")
    def flag(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(matches(t, index.value, threshold, overlap, whole_items)) for t in texts], dtype="bool")
    return flag


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = THRESHOLD,
                      overlap: float = OVERLAP, block_items: int = MAX_BLOCK_ITEMS,
                      whole_items: bool = False, exhaustive: bool = False) -> DataFrame:
    """The documents that contain no test item: a filter, nothing is shuffled."""
    python_workers(docs.sparkSession)
    clean = docs
    for index in item_indexes(benchmark, block_items=block_items):
        if exhaustive:
            index.look_up(overlap)
        flag = _flagger(docs.sparkSession.sparkContext.broadcast(index), threshold, overlap, whole_items)
        clean = clean.where(~flag(quoted(text_col)))
    return clean


def op7_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The registered query: all verified pairs of document and item."""
    return contaminated(docs, benchmark, whole_items=True)
