import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from cardwatch.llm import token_counts as T
from llm_cases import clashing_docs, edge_docs, EDGE_ROWS, no_docs, rows_of  # noqa: F401

NAME = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Library.from_file(NAME)
COUNT = T.Tokenizer(NAME).counter()


def brute(rows):
    t = Library.from_file(NAME)
    out = []
    for d, text, *_ in rows:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        out.append((d, len((text or "").encode()), n, n > 512))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_edges_equal_the_library(edge_docs, clashing_docs):
    assert rows_of(T.op8_token_counts(edge_docs)) == brute(EDGE_ROWS)
    assert rows_of(T.op8_token_counts(clashing_docs)) == brute(EDGE_ROWS)


def test_special_strings_are_as_the_library_has_them(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>"), (3, " <|endoftext|> ")]
    assert rows_of(T.op8_token_counts(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


ALPHABET = "abcXYZ éÉß²½¼ªµ×÷·'’strevml0123456789 \t\n\r\x0b\x0c\x1c\x85\xa0\xad!?.,<|>#_-\u0250\u0301漢\U0001f600 "


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=30) | st.sampled_from(["<|endoftext|>", "'s ", " 're", "  ", " \n ", "n't"]),
                max_size=8))
def test_word_counts_equal_the_library(parts):
    texts = ["".join(parts), "".join(reversed(parts)), " ".join(parts)]
    assert COUNT(texts) == [len(LIBRARY.encode(t, add_special_tokens=False).ids) for t in texts]


def test_forgotten_words_are_counted_again(monkeypatch):
    monkeypatch.setattr(T, "KNOWN_WORDS", 7)
    texts = [" ".join(f"word{i * j % 50}" for i in range(20)) for j in range(30)]
    count = T.Tokenizer(NAME).counter()
    assert count(texts) == count(texts[:]) == [len(LIBRARY.encode(t).ids) for t in texts]


def test_empty_table(no_docs):
    assert T.op8_token_counts(no_docs).count() == 0


def test_only_distinct_misses_are_encoded(spark, scratch):
    rows = [(i, f"text {i % 5}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path, tokenizer = f"{scratch}/cache", T.Tokenizer(NAME)
    assert rows_of(T.count_tokens(docs, tokenizer, path)) == brute(rows)
    assert spark.read.parquet(path).count() == 5
    more = spark.createDataFrame(rows + [(99, "text 9"), (100, None)], "doc_id long, text string")
    assert rows_of(T.count_tokens(more, tokenizer, path)) == brute(rows + [(99, "text 9"), (100, None)])
    assert spark.read.parquet(path).count() == 7  # two more, nothing again
    # stored counts are what is returned
    cache = T.CountCache(spark, path)
    assert cache.counts(tokenizer.version).count() == 7 and cache.counts("other").count() == 0


def test_another_tokenizer_has_its_own_counts(spark, scratch):
    docs = spark.createDataFrame([(1, "Hello there, world")], "doc_id long, text string")
    a = T.count_tokens(docs, T.Tokenizer(NAME), f"{scratch}/cache").first().n_tokens
    b = T.count_tokens(docs, T.Tokenizer(public_tokenizers.path("piece_bpe_32k.model")), f"{scratch}/cache").first().n_tokens
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert (a, b) == (len(Library.from_file(NAME).encode("Hello there, world").ids), len(p.encode("Hello there, world")))
    assert spark.read.parquet(f"{scratch}/cache").select(F.countDistinct("tokenizer")).first()[0] == 2
