import hashlib
from bisect import bisect_right
from collections import Counter
from functools import lru_cache

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardwatch.llm import token_align as M
from llm_cases import clashing_docs, edge_docs, EDGE_ROWS, no_docs, rows_of, sf  # noqa: F401

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_ends(parts):
    ends, at = [], 0
    for p in parts:
        at += len(p)
        ends.append(at)
    return ends


def plain(text, libraries):
    """Groups and links of one text, by the byte ranges of whole encodings."""
    a, b = libraries
    if not text:
        return None
    marks = M.byte_alphabet()
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_parts = [bytes(marks[c] for c in a.id_to_token(i)) for i in a_ids]
    b_parts = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in b_ids]
    if b"".join(a_parts) != (" " + text).encode() or b"".join(b_parts) != (" " + text).encode():
        return None
    a_ends, b_ends = byte_ends(a_parts), byte_ends(b_parts)
    links, i, j = [], 0, 0
    while i < len(a_ids):  # every stretch between neighbouring ends is one overlap
        links.append((a_ids[i], b_ids[j]))
        end = min(a_ends[i], b_ends[j])
        i, j = i + (a_ends[i] == end), j + (b_ends[j] == end)
    groups = []
    shared = sorted(set(a_ends) & set(b_ends))
    for low, high in zip([0, *shared], shared):
        own = [[str(x) for x in ids[bisect_right(ends, low):bisect_right(ends, high)]] for ids, ends in
               ((a_ids, a_ends), (b_ids, b_ends))]
        groups.append("|".join(map(",".join, own)))
    return a_ids, b_ids, groups, links


def brute(rows, libraries):
    found = [plain(t, libraries) for _, t in rows]
    counts = Counter(x for f in found if f for x in f[3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    out = []
    for (d, _), f in zip(rows, found):
        if f is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            a_ids, b_ids, groups, links = f
            out.append((d, len(a_ids), len(b_ids), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                        sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
HOSTILE = ["a  b", " lead", "trail ", "a\n b", "a \nb", "x\t\t y", "lit▁eral", "a▁ b", "<|endoftext|> <s> </s> <unk>", "<0x41>",
           "don't we'll I'M", "12345 67,89 3.14", "日本語 テスト \U0001f600\U0001f600", "é́ ﬁ ½ \xa0x 　 y", "\x00a\x00 b\x1c c",
           "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "    ", " ", "\n\n\n", "naïve façade — “quoted” text…", "﻿bom ​zero"]


def test_hostile_texts_equal_brute_force(spark, libraries):
    rows = [(i, t) for i, t in enumerate(HOSTILE * 2)] + [(99, " ".join(HOSTILE))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows, libraries)
    assert rows_of(M.op11_token_align(docs), *COLUMNS) == want
    # nothing sent to the tasks but the vectors: all irregular pairs are joined
    assert rows_of(M.align_documents(docs, A, B, heavy=1), *COLUMNS) == want


def test_edges_equal_brute_force(edge_docs, clashing_docs, no_docs, libraries):
    want = brute([r[:2] for r in EDGE_ROWS], libraries)
    assert rows_of(M.op11_token_align(edge_docs), *COLUMNS) == want
    assert rows_of(M.op11_token_align(clashing_docs), *COLUMNS) == want
    assert M.op11_token_align(no_docs).count() == 0


def test_the_table_equals_brute_force(spark, sf, libraries):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(M.op11_token_align(docs), *COLUMNS) == brute(rows, libraries)


def test_identity_map():
    pair = M.TokenizerPair(A, B)
    assert pair.cuts_at_spaces
    twins = [(a, b) for a, b in enumerate(pair.identity) if b >= 0]
    assert len(twins) > 10_000 and all(pair.a_bytes[a] == pair.b_bytes[b] for a, b in twins)
    missing = {pair.a_bytes[a] for a, b in enumerate(pair.identity) if b < 0} & set(pair.b_bytes)
    assert missing <= {b""}


@lru_cache
def one_aligner():
    return M.Aligner(M.TokenizerPair(A, B))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab éx1.,'s \n\t▁<|>0日\U0001f600\xa0　", max_size=40))
def test_stretches_equal_whole_encodings(text):
    aligner = one_aligner()
    found = aligner.align([text])[0]
    want = plain(text, (aligner.a, aligner.b))
    assert (found is None) == (want is None)
    if want:
        assert found[:3] == (len(want[0]), len(want[1]), len(want[2]))
        assert found[3] == hashlib.sha256(";".join(want[2]).encode()).hexdigest()


def test_a_third_of_all_rows_alike(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "xylophonist ünïcödé").otherwise(
        F.concat(F.lit("w"), F.col("id").cast("string"))).alias("text"))
    out = M.op11_token_align(docs).where("doc_id % 3 = 0")
    assert out.select(*COLUMNS[1:]).distinct().count() == 1 and out.count() == 300
