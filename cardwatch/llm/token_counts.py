"""Token counts through a digest cache.

A count belongs to a pair of digests: one of the content, one of the
tokenizer's own file (its version).  Documents are joined to the stored
counts; only distinct misses are encoded, and appended to the cache.

* content is normalised as far as counts allow: NULL becomes the empty text,
  nothing else changes;
* the cache is a parquet table partitioned by tokenizer digest; an append is
  one committed job, and a rerun finds what was appended, so lost executors
  or a restart cost at most the texts of the failed job;
* of a byte-level tokenizer, the library encodes each different word of a
  worker's texts once (:class:`WordCounts`); other texts and files it encodes
  whole;
* misses are made distinct by (digest, whole text), which combines copies in
  each partition before the shuffle; a text shared by a third of all rows is
  encoded once;
* the tokenizer's file is read by the driver and broadcast (a few MB), so
  executors need no copy of it.

Defined cases: NULL text has 0 bytes and 0 tokens; strings of special tokens
inside texts are handled as the library's default does; repeated rows share a
count; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import new_folder, python_workers, text_of, utf8_bytes

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"
TOKEN_LIMIT = 512
#: Words whose counts a worker remembers at a time.
KNOWN_WORDS = 400_000


class Tokenizer:
    """A public tokenizer file, read once on the driver."""

    def __init__(self, path: str | Path):
        self.kind = Path(path).suffix
        if self.kind not in (".json", ".model"):
            raise ValueError(f"no library for {path}")
        self.content = Path(path).read_bytes()
        self.version = hashlib.sha256(self.content).hexdigest()
        file = json.loads(self.content) if self.kind == ".json" else {}
        self.added = tuple(a["content"] for a in file.get("added_tokens", []))
        # byte-level, cut by its own word pattern, and nothing done to the text before
        self.cuts_words = file.get("normalizer", "") is None and file.get("pre_tokenizer") == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

    def counter(self):
        """A function from texts to token counts."""
        if self.kind == ".json":
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer as Library
            t = Library.from_str(self.content.decode("utf-8"))
            t.no_truncation()
            t.no_padding()

            def whole(texts):
                return [len(e) for e in t.encode_batch_fast(texts, add_special_tokens=False)]

            def each(words):  # all at once: the library numbers the word of every token
                numbers = t.encode(words, is_pretokenized=True, add_special_tokens=False).word_ids
                return np.bincount(numbers, minlength=len(words)).tolist()

            return WordCounts(whole, each, self.added).count if self.cuts_words else whole
        import sentencepiece
        p = sentencepiece.SentencePieceProcessor(model_proto=self.content)
        return lambda texts: [len(ids) for ids in p.encode(texts, num_threads=1)]


# The byte-level word pattern, spelt out for characters below
# U+0250 other than controls, whose classes no Unicode version changes.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\\t\\n\\r "
_WORD = re.compile(rf" ?[{_LETTER}]+| ?[{_NUMBER}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
                   rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_OTHER = re.compile("[^\\t\\n\\r\x20-\x7e\xa1-\u024f]")


class WordCounts:
    """Token counts by the words that the tokenizer itself cuts a text into.

    The library merges bytes inside such words only, so a text's count is the
    sum over its words; each word is encoded by the library once and its count
    remembered (at most ``KNOWN_WORDS`` at a time).  Texts with a character
    outside the pattern's range, or with the string of an added token, go to
    the library whole."""

    def __init__(self, whole, each, added: tuple[str, ...]):
        self.whole, self.each, self.added = whole, each, added
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        plain = [not _OTHER.search(t) and not any(a in t for a in self.added) for t in texts]
        rest = iter(self.whole([t for t, p in zip(texts, plain) if not p]))
        cut = [_WORD.findall(t) if p else None for t, p in zip(texts, plain)]
        self._learn(set().union(*[words for words in cut if words]))
        return [next(rest) if words is None else sum(map(self.known.__getitem__, words)) for words in cut]

    def _learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > KNOWN_WORDS:
            self.known = {w: n for w in words if (n := self.known.get(w))}
        new = list(words.difference(self.known))
        if new:
            self.known.update(zip(new, self.each(new)))


def content_digest(text: str) -> Column:
    return F.unhex(F.sha2(text_of(text), 256))


class CountCache:
    """Stored counts, one folder per tokenizer digest."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        # an empty append makes the table exist
        spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)

    def counts(self, version: str) -> DataFrame:
        stored = self.spark.read.schema(CACHE_SCHEMA).parquet(self.path)
        return stored.where(F.col("tokenizer") == version).select("digest", "n_tokens")

    def append(self, counts: DataFrame, version: str) -> None:
        counts.select("digest", "n_tokens", F.lit(version).alias("tokenizer")).write.mode("append").parquet(self.path)


def _encoder(tokenizer):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = None
        for batch in batches:
            count = count or tokenizer.value.counter()
            yield pd.DataFrame({"digest": batch["digest"],
                                "n_tokens": pd.array(count(batch["content"].tolist()), dtype="int64")})
    return encode


def fill_cache(docs: DataFrame, cache: CountCache, tokenizer: Tokenizer, text_col: str = "text") -> None:
    """Encode the distinct contents that the cache does not hold yet."""
    spark = docs.sparkSession
    python_workers(spark)
    contents = docs.select(content_digest(text_col).alias("digest"), text_of(text_col).alias("content"))
    misses = contents.distinct().join(cache.counts(tokenizer.version), "digest", "left_anti")
    shared = spark.sparkContext.broadcast(tokenizer)
    cache.append(misses.mapInPandas(_encoder(shared), "digest binary, n_tokens long"), tokenizer.version)


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, cache_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, ``n_tokens``,
    ``over_limit`` (more than ``limit`` tokens)."""
    cache = CountCache(docs.sparkSession, cache_path)
    fill_cache(docs, cache, tokenizer, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), content_digest(text_col).alias("digest"),
                       utf8_bytes(text_col).alias("n_bytes"))
    return rows.join(cache.counts(tokenizer.version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op8_token_counts(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """The digest columns of the registered query.  Each call starts an empty
    cache, so that its work is that of the whole table."""
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(docs, Tokenizer(tokenizer_path), new_folder(docs.sparkSession, "token-cache"))
