"""Cross-tokenizer alignment with an identity-map fast path.

Both tokenizers cut the same bytes (a space and the text).  Offsets at which
tokens of both end cut the tokens into groups; a link is a pair of one A and
one B token whose byte ranges overlap.  Inside a group no end is shared, so
its n A and m B tokens have n + m - 1 links, one per stretch between
neighbouring ends.

* *Identity map*: of every A id the B id with the same bytes, an array as long
  as A's vocabulary, computed once from the two files.  One token of each side
  with the same bytes is the usual group; such links are counted in vectors as
  long as the vocabulary, one per task, and only their sums move.  (A link of
  an irregular group between such a pair of ids belongs to the same count and
  is added to the same vector.)
* *Irregular links* alone enter the pair shuffle, combined per document and
  per task before they move.
* *Counts back to the documents*: the vector, the best count of every B id (as
  many numbers as B has ids) and the pairs that hold at least one in
  ``HEAVY`` of all irregular links (so there are at most ``HEAVY``) are sent to
  the tasks.  What remains is joined by pair; no pair of it can be hot.

Neither tokenizer merges across a space between two other characters (A cuts
words before it; no piece of B goes on after a word into a space, which is
checked).  So texts are cut there, and a worker encodes and aligns each
different stretch once, the new stretches of a batch in one row of tokens.
Where that does not hold, whole texts are encoded.

Defined cases: NULL and empty texts, and texts that a tokenizer does not give
back byte for byte (a literal U+2581), have zeros and an empty digest; strings
of special tokens are plain text; long texts are encoded whole, stretch by
stretch, and their links are one array of different pairs; repeated rows count
each; ties for a B id's highest count are all best; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import python_workers, written

#: Pairs with at least one in so many irregular links are sent to the tasks.
HEAVY = 1 << 16
#: Stretches that a worker remembers at a time, and the longest remembered.
KNOWN_STRETCHES, LONGEST_KNOWN = 300_000, 100
#: New stretches that A encodes in one text.
JOINED = 500
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_ROWS = ("row long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "same array<int>, same_n array<int>, pair array<long>, pair_n array<int>")


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class TokenizerPair:
    """The two files (read once on the driver) and what follows from them."""

    def __init__(self, a_path: str | Path, b_path: str | Path):
        self.a_file, self.b_file = Path(a_path).read_text("utf-8"), Path(b_path).read_bytes()
        a, b = self.libraries()
        alphabet = byte_alphabet()
        words = {i: w for w, i in a.get_vocab().items()}
        self.a_bytes = [bytes(alphabet[c] for c in words.get(i, "")) if all(c in alphabet for c in words.get(i, ""))
                        else b"" for i in range(max(words) + 1)]
        self.b_bytes = []
        for i in range(b.vocab_size()):
            piece = b.id_to_piece(i)
            if b.is_byte(i):
                self.b_bytes.append(bytes([int(_BYTE_PIECE.fullmatch(piece)[1], 16)]))
            else:
                self.b_bytes.append(b"" if b.is_control(i) or b.is_unknown(i) else piece.replace("▁", " ").encode())
        # of ids with the same bytes a piece proper comes before a byte's own piece
        order = sorted(range(len(self.b_bytes)), key=b.is_byte, reverse=True)
        by_bytes = {self.b_bytes[i]: i for i in order if self.b_bytes[i]}
        #: B id with the same bytes as each A id, -1 for none
        self.identity = np.array([by_bytes.get(x, -1) if x else -1 for x in self.a_bytes], dtype=np.int64)
        cuts = json.loads(self.a_file).get("pre_tokenizer") == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        inner = any("▁" in b.id_to_piece(i).lstrip("▁") for i in range(b.vocab_size()))
        self.cuts_at_spaces = cuts and not inner

    def libraries(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        a = Tokenizer.from_str(self.a_file)
        a.no_truncation()
        a.no_padding()
        a.encode_special_tokens = True
        return a, sentencepiece.SentencePieceProcessor(model_proto=self.b_file)


class Aligner:
    """Aligns texts; remembers the stretches between spaces it has seen."""

    def __init__(self, pair: TokenizerPair):
        self.pair = pair
        self.a, self.b = pair.libraries()
        self.a_len, self.b_len = (np.array([len(x) for x in of], dtype=np.int64) for of in (pair.a_bytes, pair.b_bytes))
        # how an id is written: A's inside and at the end of its part, B's also at the end of a stretch
        self.written = [f"{i}{end}" for i in range(len(pair.a_bytes)) for end in ",|"]
        self.b_first = len(self.written)
        self.written += [f"{i}{end}" for i in range(len(pair.b_bytes)) for end in ",;\n"]
        # two generations: what is used again outlives what is met once
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def align(self, texts: list[str]) -> list[tuple | None]:
        """Per text (n_a, n_b, n_groups, digest, same ids, counts, pairs, counts)."""
        cut = [_CUT.split(t) if self.pair.cuts_at_spaces else [t] for t in texts]
        wanted = set().union(*cut)
        if len(self.known) + len(wanted) > KNOWN_STRETCHES:
            self.known, self.older = {}, self.known
        unknown = wanted.difference(self.known)
        again = unknown & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        new = list(unknown - again)
        self.known.update(zip(new, self._encode(new)))
        out = [self._whole(t, parts) for t, parts in zip(texts, cut)]
        for w in new:
            if len(w) > LONGEST_KNOWN:
                del self.known[w]
        return out

    def _encode(self, stretches: list[str]) -> list[tuple | None]:
        """Per stretch (n_a, n_b, groups, links as bytes); None if its bytes differ."""
        said = [" " + s for s in stretches]
        whole = [s.encode("utf-8", "surrogatepass") for s in said]
        b_ids, b_bytes = self.b.encode(stretches, num_threads=1), self.pair.b_bytes
        kept = [i for i, ids in enumerate(b_ids) if b"".join([b_bytes[x] for x in ids]) == whole[i]]
        # stretches that begin and end with a word's character may follow one another in one text
        alone = [not self.pair.cuts_at_spaces or not s or s[0].isspace() or s[-1].isspace() for s in stretches]
        kept.sort(key=alone.__getitem__)
        a_ids = self._in_a_row([said[i] for i in kept], [whole[i] for i in kept], sum(not alone[i] for i in kept))
        if a_ids is None:
            each = [e.ids for e in self.a.encode_batch_fast([said[i] for i in kept], add_special_tokens=False)]
            right = [b"".join([self.pair.a_bytes[x] for x in ids]) == whole[i] for i, ids in zip(kept, each)]
            kept, each = [i for i, r in zip(kept, right) if r], [ids for ids, r in zip(each, right) if r]
            a_ids = np.fromiter(chain.from_iterable(each), dtype=np.int64)
        out: list[tuple | None] = [None] * len(stretches)
        if kept:
            for i, found in zip(kept, self._links(a_ids, [b_ids[i] for i in kept], [len(whole[i]) for i in kept])):
                out[i] = found
        return out

    def _in_a_row(self, said: list[str], whole: list[bytes], joined: int) -> np.ndarray | None:
        """A's ids of all stretches, the first ``joined`` of them encoded many
        at a time; None if bytes differ or a token reaches over a stretch's end."""
        texts = ["".join(said[k:min(k + JOINED, joined)]) for k in range(0, joined, JOINED)] + said[joined:]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)),
                          dtype=np.int64)
        if b"".join(map(self.pair.a_bytes.__getitem__, ids.tolist())) != b"".join(whole):
            return None
        ends, stops = np.cumsum(self.a_len[ids]), np.cumsum([len(w) for w in whole])
        return ids if not len(ids) or (ends[np.searchsorted(ends, stops)] == stops).all() else None

    def _links(self, a_ids: np.ndarray, b_lists: list[list[int]], lengths: list[int]) -> Iterator[tuple]:
        """Groups and links of stretches that lie in a row; both sides end
        tokens where a stretch ends, so no group reaches over that."""
        b_ids = np.fromiter(chain.from_iterable(b_lists), dtype=np.int64)
        a_ends, b_ends, stops = np.cumsum(self.a_len[a_ids]), np.cumsum(self.b_len[b_ids]), np.cumsum(lengths)
        ends = np.unique(np.concatenate([a_ends, b_ends]))
        i, j = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        links = (a_ids[i] << 32 | b_ids[j]).tobytes()
        shared = ends[(a_ends[i] == ends) & (b_ends[j] == ends)]
        a_group, b_group = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        a_last, b_last = a_ends == shared[a_group], b_ends == shared[b_group]
        b_stop = b_ends == stops[np.searchsorted(stops, b_ends)]
        tokens = np.concatenate([a_ids * 2 + a_last, self.b_first + b_ids * 3 + b_last + b_stop])
        order = np.argsort(np.concatenate([a_group * 2, b_group * 2 + 1]), kind="stable")
        groups = "".join(map(self.written.__getitem__, tokens[order].tolist())).split("\n")
        n_a = np.diff(np.searchsorted(a_ends, stops) + 1, prepend=0).tolist()
        upto = ((np.searchsorted(ends, stops) + 1) * 8).tolist()
        return zip(n_a, map(len, b_lists), groups, (links[x:y] for x, y in zip([0, *upto], upto)))

    def _whole(self, text: str, parts: list[str]) -> tuple | None:
        if not text:
            return None
        found = list(map(self.known.__getitem__, parts))
        if None in found:  # a stretch differs, so the text is compared whole
            found = self._encode([text]) if len(parts) > 1 else found
            if found[0] is None:
                return None
        n_a, n_b, groups, links = zip(*found)
        n_a, n_b, links = sum(n_a), sum(n_b), np.frombuffer(b"".join(links), dtype=np.int64)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        pairs, n = np.unique(links, return_counts=True)
        a = pairs >> 32
        same = self.pair.identity[a] == pairs & 0xFFFFFFFF
        return n_a, n_b, n_a + n_b - len(links), digest, a[same], n[same], pairs[~same], n[~same]


def _aligned(pair):
    none = np.array([], dtype=np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(pair.value)
            found = aligner.align([t or "" for t in batch["text"]])
            rows = [(0, 0, 0, 0, "", none, none, none, none) if f is None else
                    (f[0], f[1], f[2], f[0] + f[1] - f[2], f[3], *f[4:]) for f in found]
            out = pd.DataFrame(rows, columns=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "same", "same_n",
                                              "pair", "pair_n"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            out.insert(0, "row", batch["row"].to_numpy())
            yield out
    return run


def _vector_sums(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for ids, n in zip(batch["same"], batch["same_n"]):
                sums[ids] += n  # ids of one document differ
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"a": at, "n": sums[at]})
    return run


def _own_shares(known):
    """Per row what the sent counts settle, and the pairs left for the join."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vector, best, identity, heavy, heavy_n = known.value
        top = vector == best[identity]
        heavy_top = heavy_n == best[heavy & 0xFFFFFFFF]
        for batch in batches:
            out = []
            for row, same, same_n, pair, pair_n in zip(*[batch[c] for c in ("row", "same", "same_n", "pair", "pair_n")]):
                total, n_best = int(vector[same] @ same_n), int(top[same] @ same_n)
                if len(heavy) and len(pair):
                    at = np.minimum(np.searchsorted(heavy, pair), len(heavy) - 1)
                    sent = heavy[at] == pair
                    total += int(heavy_n[at[sent]] @ pair_n[sent])
                    n_best += int(heavy_top[at[sent]] @ pair_n[sent])
                    pair, pair_n = pair[~sent], pair_n[~sent]
                out.append((row, total, n_best, pair, pair_n))
            yield pd.DataFrame(out, columns=["row", "total", "best", "pair", "pair_n"])
    return run


def align_documents(docs: DataFrame, a_path: str | Path, b_path: str | Path, id_col: str = "doc_id",
                    text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    spark = docs.sparkSession
    python_workers(spark)
    pair = TokenizerPair(a_path, b_path)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    aligned = written(rows.mapInPandas(_aligned(spark.sparkContext.broadcast(pair)), _ROWS.format(id=id_type)), "align")

    vector = np.zeros(len(pair.identity), dtype=np.int64)
    sums = (aligned.select("same", "same_n").mapInPandas(_vector_sums(len(vector)), "a int, n long")
            .groupBy("a").agg(F.sum("n").alias("n")))
    for a, n in sums.collect():  # at most one row per A id
        vector[a] = n
    each = aligned.select(F.explode(F.arrays_zip("pair", "pair_n")).alias("x")).select("x.pair", "x.pair_n")
    pairs = written(each.groupBy("pair").agg(F.sum("pair_n").cast("long").alias("n")), "align-pairs")

    best = np.zeros(len(pair.b_bytes) + 1, dtype=np.int64)  # the last place is for ids without a twin
    np.maximum.at(best, pair.identity, vector)
    best[-1] = 0
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    for b, n in pairs.groupBy(b_id.alias("b")).agg(F.max("n")).collect():  # at most one row per B id
        best[b] = max(best[b], n)
    total = pairs.agg(F.sum("n")).first()[0] or 0
    least = max(-(-total // heavy), 1)
    sent = sorted(tuple(r) for r in pairs.where(F.col("n") >= least).collect())  # at most ``heavy`` rows
    known = spark.sparkContext.broadcast((vector, best, pair.identity, np.array([p for p, _ in sent], dtype=np.int64),
                                          np.array([n for _, n in sent], dtype=np.int64)))

    own = written(aligned.select("row", "same", "same_n", "pair", "pair_n").mapInPandas(
        _own_shares(known), "row long, total long, best long, pair array<long>, pair_n array<int>"), "align-own")
    tops = spark.createDataFrame([(int(b), int(n)) for b, n in enumerate(best[:-1]) if n], "b long, top long")
    light = (pairs.where(F.col("n") < least).join(F.broadcast(tops), b_id == F.col("b"))  # one row per B id
             .select("pair", "n", (F.col("n") == F.col("top")).alias("is_best")))
    rest = (own.select("row", F.explode(F.arrays_zip("pair", "pair_n")).alias("x")).select("row", "x.pair", "x.pair_n")
            .join(light, "pair").groupBy("row")
            .agg(F.sum(F.col("n") * F.col("pair_n")).alias("more"),
                 F.sum(F.when(F.col("is_best"), F.col("pair_n")).otherwise(0)).alias("more_best")))
    shares = own.select("row", "total", "best").join(rest, "row", "left")
    return (aligned.drop("same", "same_n", "pair", "pair_n").join(shares, "row")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links",
                    (F.col("best") + F.coalesce("more_best", F.lit(0))).cast("long").alias("n_best"),
                    (F.col("total") + F.coalesce("more", F.lit(0))).cast("long").alias("count_sum"), "groups_sha256"))


def op11_token_align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """The registered query, by the two public vocabularies of the contract."""
    import public_tokenizers
    return align_documents(docs, a_path or public_tokenizers.path("byte_bpe_50k.json"),
                           b_path or public_tokenizers.path("piece_bpe_32k.model"))
