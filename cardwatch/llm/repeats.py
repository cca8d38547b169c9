"""Long repeats over documents by a logarithmic family of suffix arrays.

A byte goes when a 400-byte string that covers it also starts anywhere else.

*Cells*: every 400-byte window of a document belongs to the leftmost smallest
(by a hash) of the 128-byte strings inside it, its anchor.  Equal windows have
equal anchors at equal places, so only windows of one anchor need comparing.
Neighbouring windows of one anchor form a cell; its bytes are its context.
Cells with equal contexts are one class (combined in each task, counted over
the corpus): all windows of a class met twice repeat, and a class alone on its
anchor repeats nowhere else.  What is left are the classes that share an anchor
with another class, the rims of repeats.

*Index family* (:class:`IndexFamily`): those contexts come in batches and are
dealt to buckets by anchor.  A batch's bucket gets a suffix array (its windows
in order of their bytes), which is merge-scanned with the bucket's array of
every level: neighbours in the merged order that agree over the whole length
are a match, on both sides.  A level holds as many batches as its power of two;
when two levels are equal in size they merge into the next, so a batch is merged
a logarithmic number of times.  Levels are written tables.  A bucket holds
about ``BUCKET_WINDOWS`` windows, however many documents there are.

*Crowded anchors* (more than ``CROWD`` classes, such as the rims of a passage in
a third of all documents) would not fit one bucket.  Their windows are compared
by digests instead, in slices of eight neighbouring windows: a slice whose
common bytes occur once is dropped, one whose whole bytes occur twice repeats,
and only the windows of the others are counted one by one.  This is exact, a
few rows a class, and no task holds an anchor.

Digests of contexts and slices have 128 bits.

Defined cases: NULL text is empty; a text under 400 bytes keeps all its bytes;
rows that repeat an id and its text are two occurrences of everything in them;
long texts are read in pieces that overlap; a run of one byte or line repeats
within its own document; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from operator import ne

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import python_workers, text_of, written

LENGTH, GRAM = 400, 128
BATCHES = 4
BUCKET_WINDOWS = 1 << 16
CROWD = 512
SLICE = 8
_PIECE = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2 to the 64."""
    n = _PIECE + LENGTH
    def powers(x):
        return np.cumprod(np.r_[np.uint64(1), np.full(n, x, dtype=np.uint64)], dtype=np.uint64)
    return powers(_FACTOR), powers(pow(_FACTOR, -1, 1 << 64))


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed hash of every ``gram`` bytes of at most one piece."""
    up, down = _powers()
    sums = np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64)))
    h = (sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _places(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every gram of at most one piece, and every window's anchor place."""
    h, reach = _gram_hashes(data, gram), length - gram + 1
    # high bits of the hash, then the place: the least is the leftmost smallest
    key = (h & ~np.uint64((1 << 21) - 1)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while 2 * span <= reach:
        key, span = np.minimum(key[:-span], key[span:]), 2 * span
    if span < reach:
        key = np.minimum(key[:len(key) - (reach - span)], key[reach - span:])
    return h, (key & np.uint64((1 << 21) - 1)).astype(np.int64)


def cells(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, int]]:
    """(anchor hash, anchor place, first window, last window) of every cell."""
    whole = np.frombuffer(data, dtype=np.uint8)
    places, firsts, hashes = [], [], []
    for at in range(0, len(data) - length + 1, _PIECE):
        h, place = _places(whole[at:at + _PIECE + length - 1], length, gram)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        places.append(place[first] + at)
        firsts.append(first + at)
        hashes.append(h[place[first]])
    if not places:
        return
    place, first, h = map(np.concatenate, (places, firsts, hashes))
    own = np.r_[True, place[1:] != place[:-1]]  # a cell may go on into the next piece
    place, first, h = place[own], first[own], h[own].view(np.int64)
    last = np.r_[first[1:] - 1, len(data) - length]
    yield from zip(h.tolist(), place.tolist(), first.tolist(), last.tolist())


def cells_of_all(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """:func:`cells` of texts that are at most one piece together: number of the
    text, anchor hash, and place, first and last window in the joined texts."""
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    if len(owner) < length:
        return (np.empty(0, dtype=np.int64),) * 5
    h, place = _places(np.frombuffer(b"".join(texts), dtype=np.uint8), length, gram)
    # windows within one text; those of different texts have different places
    own, other = owner[:len(place)] == owner[length - 1:], place[1:] != place[:-1]
    first = np.flatnonzero(own & np.append(True, other | ~own[:-1]))
    last = np.flatnonzero(own & np.append(other | ~own[1:], True))
    return owner[first], h[place[first]].view(np.int64), place[first], first, last


#: Rows a task gathers before it hands them on (whole documents).
_HAND_ON = 20_000


def _handed_on(rows_of_documents: Iterator[list[tuple]], columns: list[str]) -> Iterator[pd.DataFrame]:
    rows: list[tuple] = []
    for own in rows_of_documents:
        rows += own
        if len(rows) >= _HAND_ON:
            yield pd.DataFrame(rows, columns=columns)
            rows = []
    yield pd.DataFrame(rows, columns=columns)


#: Bytes of texts that are cut together.
_TOGETHER = 1 << 16


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Row digests and texts in groups of ``_TOGETHER`` bytes, or of one long text."""
    docs, texts, size = [], [], 0
    for b in batches:
        for doc, text in zip(b["doc"], b["text"]):
            data = text.encode("utf-8", "surrogatepass")
            if docs and size + len(data) > _TOGETHER:
                yield docs, texts
                docs, texts, size = [], [], 0
            docs.append(doc)
            texts.append(data)
            size += len(data)
    if docs:
        yield docs, texts


def _cell_rows(length: int, gram: int):
    def of(docs: list[bytes], texts: list[bytes]) -> pd.DataFrame:
        if len(texts) == 1 and len(texts[0]) > _PIECE:
            own = np.array(list(cells(texts[0], length, gram)), dtype=np.int64).reshape(-1, 4)
            own = (np.zeros(len(own), dtype=np.int64), *own.T)
        else:
            own = cells_of_all(texts, length, gram)
        number, anchor, place, first, last = own
        joined, start = b"".join(texts), np.cumsum([0, *map(len, texts)])[number]
        ctx = [xxhash.xxh3_128_digest(joined[low:high]) for low, high in zip(first.tolist(), (last + length).tolist())]
        return pd.DataFrame({"doc": [docs[i] for i in number.tolist()], "anchor": anchor, "ctx": ctx,
                             "mark": (place - first).astype(np.int32), "first": first - start, "last": last - start})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for group in _groups(batches):
            held.append(of(*group))
            rows += len(held[-1])
            if rows >= _HAND_ON:
                yield pd.concat(held)
                held, rows = [], 0
        if held:
            yield pd.concat(held)
    return run


def _contexts(length: int):
    def of(doc: bytes, text: str, wanted) -> list[tuple]:
        data = text.encode("utf-8", "surrogatepass")
        return [(doc, c["anchor"], c["ctx"], c["mark"], c["crowded"], data[c["first"]:c["last"] + length]) for c in wanted]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        documents = (of(*row) for b in batches for row in zip(b["doc"], b["text"], b["wanted"]))
        return _handed_on(documents, ["doc", "anchor", "ctx", "mark", "crowded", "data"])
    return run


def _runs(offsets: list[int], length: int) -> list[tuple[int, int]]:
    """Byte ranges of the windows at sorted ``offsets``, joined where they touch."""
    out: list[tuple[int, int]] = []
    for o in offsets:
        if out and o <= out[-1][1]:
            out[-1] = (out[-1][0], o + length)
        else:
            out.append((o, o + length))
    return out


# -- the index family ---------------------------------------------------------

_RUN = "bucket int, ctx array<binary>, data array<binary>, suffixes binary"
_FOUND = f"{_RUN}, repeated binary, spans array<struct<low:int,high:int>>"
_OFFSETS = 1 << 16  # windows of a context (a cell has at most LENGTH - GRAM + 1)


def _in_order(joined: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings at ``places``, and which differ from the one before."""
    strings = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(joined, length)[places])
    order = pc.sort_indices(pa.FixedSizeBinaryArray.from_buffers(pa.binary(length), len(places), [None, pa.py_buffer(strings)]))
    order = order.to_numpy().astype(np.int64)
    strings = strings.view(f"V{length}").ravel()[order]
    return order, np.append(True, strings[1:] != strings[:-1])


def in_order(data: list[bytes], codes: np.ndarray, length: int, heads: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The order of the windows that ``codes`` (number of the context times
    ``_OFFSETS`` plus offset) name, by their bytes, and which of them in that
    order differ from the one before.  With ``heads``, only windows that agree
    with others in so many times 8 bytes are compared whole."""
    if not len(codes):
        return codes, np.empty(0, dtype=bool)
    places = np.cumsum([0, *map(len, data)])[codes // _OFFSETS] + codes % _OFFSETS
    joined, order, other = np.frombuffer(b"".join(data), dtype=np.uint8), np.arange(len(codes)), np.arange(len(codes)) == 0
    tied = order.copy()
    for at in range(0, min(8 * heads, length - 7), 8):
        own, group = order[tied], np.cumsum(other[tied])
        head = np.lib.stride_tricks.sliding_window_view(joined, 8)[places[own] + at].view(">u8").ravel().astype(np.uint64)
        by = np.lexsort((head, group))
        order[tied], head = own[by], head[by]
        other[tied[1:]] |= head[1:] != head[:-1]
        tied = np.flatnonzero(~(other & np.append(other[1:], True)))
    if len(tied):
        own = order[tied]
        by, differ = _in_order(joined, places[own], length)
        order[tied] = own[by]
        other[tied] |= differ
    return order, other


def suffix_array(data: list[bytes], length: int) -> np.ndarray:
    """The codes of the windows of all contexts, in order of their bytes."""
    codes = np.concatenate([np.empty(0, dtype=np.int64), *(np.arange(len(d) - length + 1, dtype=np.int64) + i * _OFFSETS
                                                           for i, d in enumerate(data) if len(d) >= length)])
    # few contexts of a batch share an anchor, so few windows agree in 16 bytes
    return codes[in_order(data, codes, length, heads=2)[0]]


def merge_scan(data: list[bytes], arrays: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ``arrays`` of codes in one order, and which of its windows equal
    another and one of the first array."""
    codes = np.concatenate(arrays)
    order, other = in_order(data, codes, length)
    group = np.cumsum(other) - 1
    new = np.bincount(group, order < len(arrays[0]))
    return codes[order], (new[group] > 0) & (np.bincount(group)[group] > 1)


def _scan_bucket(length: int, merged_levels: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        new = {c: d for cs, ds in zip(*[rows.loc[rows["level"] < 0, k] for k in ("ctx", "data")]) for c, d in zip(cs, ds)}
        ctx, data = list(new), list(new.values())
        arrays, kept = [suffix_array(data, length)], len(ctx)
        levels = rows[rows["level"] >= 0].sort_values("level")
        for level, held_ctx, held, order in zip(*[levels[k] for k in ("level", "ctx", "data", "suffixes")]):
            arrays.append(np.frombuffer(order, dtype=np.int64) + len(ctx) * _OFFSETS)
            ctx, data = ctx + list(held_ctx), data + list(held)
            if level < merged_levels:  # becomes one array with the batch
                kept = len(ctx)
        codes, met = merge_scan(data, arrays, length)
        out = []
        found = np.sort(codes[met])
        cuts = np.flatnonzero(np.diff(found // _OFFSETS)) + 1
        for own in np.split(found, cuts) if len(found) else ():
            out.append((bucket, None, None, None, ctx[own[0] // _OFFSETS], _runs((own % _OFFSETS).tolist(), length)))
        out.append((bucket, ctx[:kept], data[:kept], codes[codes < kept * _OFFSETS].tobytes(), None, None))
        return pd.DataFrame(out, columns=["bucket", "ctx", "data", "suffixes", "repeated", "spans"])
    return run


@dataclass
class IndexFamily:
    """Levels of suffix arrays: level k holds two to the k batches."""

    spark: SparkSession
    length: int = LENGTH
    levels: dict[int, DataFrame] = field(default_factory=dict)

    def add(self, batch: DataFrame) -> DataFrame:
        """Scan ``batch`` (``bucket``, ``ctx``, ``data``, a row per context)
        with itself and every level, then let it in.  Returns ``ctx`` and the
        ``spans`` found to repeat, in the batch and in the levels."""
        merged = 0
        while merged in self.levels:
            merged += 1
        rows = batch.select("bucket", F.lit(-1).alias("level"), F.array("ctx").alias("ctx"), F.array("data").alias("data"),
                            F.lit(None).cast("binary").alias("suffixes"))
        for k, level in self.levels.items():
            rows = rows.unionByName(level.select("bucket", F.lit(k).alias("level"), "ctx", "data", "suffixes"))
        found = written(rows.groupBy("bucket").applyInPandas(_scan_bucket(self.length, merged), _FOUND), "repeats-level", compression="zstd")
        for k in range(merged):
            del self.levels[k]
        self.levels[merged] = found.where(F.col("suffixes").isNotNull())
        return found.where(F.col("repeated").isNotNull()).select(F.col("repeated").alias("ctx"), "spans")


# -- crowded anchors ---------------------------------------------------------

def _slices(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for ctx, mark, data in zip(b["ctx"], b["mark"], b["data"]):
                last = len(data) - length
                for j in range(max(mark - last, 0) // SLICE, mark // SLICE + 1):
                    low, high = max(mark - SLICE * j - SLICE + 1, 0), min(mark - SLICE * j, last)
                    core = data[mark - SLICE * j:mark - SLICE * j - SLICE + 1 + length]
                    rows.append((ctx, low, high, xxhash.xxh3_128_digest(b"core%d:" % j + core), xxhash.xxh3_128_digest(
                        b"whole%d,%d:" % (mark - low, mark - high) + data[low:high + length])))
            yield pd.DataFrame(rows, columns=["ctx", "low", "high", "core", "whole"])
    return run


def _windows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(ctx, o, xxhash.xxh3_128_digest(data[o:o + length])) for ctx, low, high, data in
                                zip(b["ctx"], b["low"], b["high"], b["data"]) for o in range(low, high + 1)],
                               columns=["ctx", "offset", "digest"])
    return run


def _met_twice(digests: DataFrame) -> DataFrame:
    counted = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return written(counted.select("digest"), "repeats-twice")


def crowded_repeats(contexts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``ctx`` and ``spans`` of the windows that repeat among ``contexts``
    (``ctx``, ``mark``, ``data``), whatever the number on one anchor."""
    contexts = written(contexts.dropDuplicates(["ctx"]).select("ctx", "mark", "data"), "repeats-crowded")
    slices = written(contexts.mapInPandas(_slices(length), "ctx binary, low int, high int, core binary, whole binary"),
                     "repeats-slices")
    twice = _met_twice(slices.select(F.explode(F.array("core", "whole")).alias("digest")))
    shared = slices.join(twice.withColumnRenamed("digest", "core"), "core").drop("core")
    whole = twice.select(F.col("digest").alias("whole"), F.lit(True).alias("all"))
    marked = written(shared.join(whole, "whole", "left").select("ctx", "low", "high", "whole", "all"), "repeats-marked")
    # a slice met twice stands once for its windows, which others may hold in part
    one = marked.where("all").groupBy("whole").agg(F.min(F.struct("ctx", "low", "high")).alias("s")).select("s.*")
    unsettled = marked.where("all IS NULL").select("ctx", "low", "high").unionByName(one)
    windows = written(unsettled.join(contexts, "ctx").mapInPandas(_windows(length), "ctx binary, offset int, digest binary"),
                      "repeats-windows")
    single = windows.join(_met_twice(windows.select("digest")), "digest").select("ctx", F.col("offset").alias("low"),
                                                                              F.col("offset").alias("high"))
    ranges = marked.where("all").select("ctx", "low", "high").unionByName(single)
    return ranges.select("ctx", F.array(F.struct("low", (F.col("high") + length).alias("high"))).alias("spans"))


# -- the operator ----------------------------------------------------------------

def _doc_key(id_col: str, text_col: str) -> Column:
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("\\N")), F.lit(":"), text_of(text_col)).cast("binary")))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES,
                   bucket_windows: int = BUCKET_WINDOWS, crowd: int = CROWD) -> DataFrame:
    """``doc``, ``spans`` of the bytes that repeat, for ``docs`` (``doc``, a
    digest of the row, and ``text``)."""
    spark = docs.sparkSession
    found = written(docs.where(F.octet_length("text") >= length).mapInPandas(
        _cell_rows(length, gram), "doc binary, anchor long, ctx binary, mark int, first long, last long"), "repeats-cells")
    classes = written(found.groupBy("anchor", "ctx").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "first", "last", "mark")).alias("at")), "repeats-classes")
    anchors = written(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes")).where(F.col("classes") > 1), "repeats-anchors")
    rims = classes.join(anchors, "anchor").select(
        F.col("at.doc").alias("doc"), F.struct("anchor", "ctx", "at.mark", "at.first", "at.last",
                                               (F.col("classes") > crowd).alias("crowded")).alias("cell"))
    wanted = rims.groupBy("doc").agg(F.collect_list("cell").alias("wanted"))  # cells of one document
    contexts = written(docs.join(wanted, "doc").mapInPandas(
        _contexts(length), "doc binary, anchor long, ctx binary, mark int, crowded boolean, data binary"), "repeats-contexts")

    spans = classes.where("n > 1").select("ctx", F.array(F.struct(F.lit(0).alias("low"), (
        F.col("at.last") - F.col("at.first") + length).cast("int").alias("high"))).alias("spans"))
    calm = contexts.where(~F.col("crowded"))
    windows = calm.agg(F.sum(F.octet_length("data") - (length - 1))).first()[0] or 0
    if windows:
        buckets = -(-windows // bucket_windows)
        family = IndexFamily(spark, length)
        batched = calm.select(F.pmod(F.xxhash64("anchor"), F.lit(buckets)).cast("int").alias("bucket"), "ctx", "data",
                              F.pmod(F.xxhash64("doc"), F.lit(batches)).alias("batch"))
        for k in range(batches):
            spans = spans.unionByName(family.add(batched.where(F.col("batch") == k)))
    if not contexts.where("crowded").isEmpty():
        spans = spans.unionByName(crowded_repeats(contexts.where("crowded"), length))
    spans = written(spans, "repeats-spans")
    shifted = F.transform("spans", lambda s: F.struct((s["low"] + F.col("first")).alias("low"), (s["high"] + F.col("first")).alias("high")))
    return (found.select("doc", "ctx", "first").join(spans, "ctx").select("doc", shifted.alias("spans"))
            .groupBy("doc").agg(F.flatten(F.collect_list("spans")).alias("spans")))  # spans of one document


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for doc_id, text, spans in zip(b["doc_id"], b["text"], b["spans"]):
            data, runs = text.encode("utf-8", "surrogatepass"), []
            for low, high in sorted((s["low"], s["high"]) for s in (spans if spans is not None else ())):
                if runs and low <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], high)
                else:
                    runs.append([low, high])
            digest, at = hashlib.sha256(), 0
            for low, high in runs:
                digest.update(data[at:low])
                at = high
            digest.update(data[at:])
            rows.append((doc_id, len(data), sum(h - lo for lo, h in runs), len(runs), digest.hexdigest(),
                         [(lo, h) for lo, h in runs]))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans``, ``kept_sha256`` and ``removed``, the byte ranges that repeat.
    ``options`` as in :func:`repeated_spans`."""
    python_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), _doc_key(id_col, text_col).alias("doc"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    spans = written(repeated_spans(rows.select("doc", "text"), **options), "repeats-docs")
    return rows.join(spans, "doc", "left").select("doc_id", "text", "spans").mapInPandas(
        _kept, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
               "removed array<struct<low:long,high:long>>")


def op12_repeats(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return remove_repeats(docs).drop("removed")
