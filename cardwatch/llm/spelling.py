"""Spelling variants by a trie over frequency vectors.

*Words*: maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased;
a run whose checksum with its document's id falls in one of ``SLIP`` classes
loses one character, by the contract's rule.  Words are counted in the JVM and
combined in each task before they move.

*Trie*: letters fall into ``GROUPS`` groups (code point modulo ``GROUPS``).  A
word's path is its number of letters of each group, one trie level a group.
One inserted letter is a surplus of one, a deleted one a deficit of one, a
replaced one both (or neither, inside one group).  A depth-first search
therefore starts with a budget of one surplus and one deficit and follows, at
each level, the word's own count, one more, or one less.  The words of the
leaves it reaches are verified letter by letter.  A pair is looked for from one
side only: the shorter word, else the one whose first different count is the
smaller, so the deficit is spent only after the surplus.

*Shards*: the trie is cut below its first levels, as few as leave at most
``SHARD_WORDS`` words in the largest subtree; each subtree is one shard.  A
word searches the subtrees its budget reaches, with what is left of the budget.
Rows lie sorted by shard, a shard's own words first: a task holds one subtree
at a time and streams the searches through it, however many there are.  In a
leaf, words (all of one length) lie by their first and by their last half, of
which one edit leaves one as it is, so no leaf is compared word by word.

*Forms*: of the near words with the largest count (ties: the smallest word)
the count must be at least twice the word's own; so forms have no cycles, and
pointers are doubled until they rest.

Defined cases: NULL and empty texts have no words; a NULL id counts as the empty
string; long texts and words are taken whole; repeated rows count each; ties as
above; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import python_workers, text_of, written

# Fixed values of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
SLIP, SHORTEST, LEAST = 97, 5, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

GROUPS = 12
SHARD_WORDS = 60_000


def slipped(doc_id: Column, run: Column) -> Column:
    """The run, less one character where its checksum says so."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % SLIP == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
                  ).otherwise(run)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
                least: int = LEAST) -> DataFrame:
    """``word``, ``n`` of every word long and frequent enough."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(text_of(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.select(slipped(F.col("id"), F.translate("run", UPPER, LOWER)).alias("word"))
    return (words.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least))


def path_of(word: str, groups: int = GROUPS) -> list[int]:
    """Letters of each group in the word."""
    path = [0] * groups
    for c in word:
        path[ord(c) % groups] += 1
    return path


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced character parts them."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[at + (len(a) >= len(b)):] == b[at + (len(b) >= len(a)):]


#: What a search has spent of its budget.
NOTHING, SURPLUS, BOTH = 0, 1, 2


class Trie:
    """The words of one subtree by their counts from ``depth`` on."""

    def __init__(self, depth: int, groups: int = GROUPS):
        self.depth, self.groups, self.root = depth, groups, {}
        self.group = _Group(groups)
        self.letters = [chr(g) for g in range(depth, groups)]

    def _rest(self, word: str) -> list[int]:
        return list(map(word.translate(self.group).count, self.letters))

    def add(self, word: str, n: int) -> None:
        node = self.root
        for count in self._rest(word):
            node = node.setdefault(count, {})
        half = len(word) // 2
        node.setdefault("<" + word[:half], []).append((word, n))
        node.setdefault(">" + word[half:], []).append((word, n))

    def near(self, word: str, spent: int = NOTHING) -> list[tuple[str, int]]:
        """Words one edit away that this side looks for, with what the search
        has ``spent`` on the way to this subtree."""
        path, found, stack = self._rest(word), [], [(self.root, 0, spent)]
        levels = len(path)
        while stack:
            node, level, spent = stack.pop()
            while node is not None:
                if level == levels:
                    found += self._leaf(node, word, spent)
                    break
                count = path[level]
                level += 1
                if spent == NOTHING:
                    if count + 1 in node:
                        stack.append((node[count + 1], level, SURPLUS))
                elif spent == SURPLUS and count and count - 1 in node:
                    stack.append((node[count - 1], level, BOTH))
                node = node.get(count)
        return found

    @staticmethod
    def _leaf(node: dict, word: str, spent: int) -> list[tuple[str, int]]:
        length = len(word) + (spent == SURPLUS)
        half = length // 2
        met = [*node.get("<" + word[:half], ()), *node.get(">" + word[len(word) - (length - half):], ())]
        if not met:
            return met
        # equal paths: the smaller word looks for the larger
        return [(w, n) for w, n in set(met) if one_edit(w, word) and (spent != NOTHING or w > word)]


class _Group(dict):
    """For ``str.translate``: the group of each letter, as a character."""

    def __init__(self, groups: int):
        self.groups = groups

    def __missing__(self, letter: int) -> str:
        self[letter] = chr(letter % self.groups)
        return self[letter]


def _paths(groups: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(path=[np.array(path_of(w, groups), dtype=np.int32) for w in b["word"]])
    return run


def _visits(depth: int):
    """For each word its own shard (role 0), and every shard it searches (role
    1) with what it has spent by then."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for word, n, path in zip(b["word"], b["n"], b["path"]):
                own = path[:depth].tolist()
                rows.append((_name(own), 0, word, n, NOTHING))
                rows.append((_name(own), 1, word, n, NOTHING))
                for i in range(depth):
                    up = own[:i] + [own[i] + 1] + own[i + 1:]
                    rows.append((_name(up), 1, word, n, SURPLUS))
                    rows += [(_name(up[:j] + [up[j] - 1] + up[j + 1:]), 1, word, n, BOTH) for j in range(i + 1, depth) if up[j]]
            yield pd.DataFrame(rows, columns=["shard", "role", "word", "n", "spent"])
    return run


def _name(path: list[int]) -> str:
    return ".".join(map(str, path))


def _search(depth: int, groups: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, trie = None, None
        for b in batches:
            found = []
            for at, role, word, n, spent in zip(*[b[c].tolist() for c in ("shard", "role", "word", "n", "spent")]):
                if at != shard:
                    shard, trie = at, Trie(depth, groups)
                if role == 0:
                    trie.add(word, n)
                elif trie.root:
                    for other, m in trie.near(word, spent):
                        found += [(word, other, m), (other, word, n)]
            yield pd.DataFrame(found, columns=["word", "other", "other_n"])
    return run


def near_words(words: DataFrame, groups: int = GROUPS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Every ordered pair (``word``, ``other``, ``other_n``) of ``words``
    (``word``, ``n``) that are one edit apart."""
    placed = written(words.mapInPandas(_paths(groups), "word string, n long, path array<int>"), "spelling-paths")
    at = placed.select("path", F.explode(F.sequence(F.lit(0), F.lit(groups))).alias("depth"))
    sizes = (at.groupBy("depth", F.expr("slice(path, 1, depth)").alias("top")).count()
             .groupBy("depth").agg(F.max("count").alias("most")).collect())  # one row a level
    depth = min((r.depth for r in sizes if r.most <= shard_words), default=groups)
    visits = placed.mapInPandas(_visits(depth), "shard string, role int, word string, n long, spent int")
    ordered = visits.repartition("shard").sortWithinPartitions("shard", "role")
    return ordered.mapInPandas(_search(depth, groups), "word string, other string, other_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``) of ``forms`` (``word``, ``form``, acyclic), the last
    form that each chain reaches, by pointer doubling."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(at.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_forms(words: DataFrame, groups: int = GROUPS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for ``words``
    (``word``, ``n``)."""
    python_workers(words.sparkSession, rows=10_000)
    words = written(words.select("word", "n"), "spelling-words")
    near = (near_words(words, groups, shard_words).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")))
    leads = -F.col("best.less") >= 2 * F.col("n")
    formed = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best.other")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n")), "spelling-forms")
    last = roots(formed.where(F.col("form").isNotNull()))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                    "form_n")


def op13_spelling(docs: DataFrame) -> DataFrame:
    """The registered query: words of all documents with their forms."""
    return spelling_forms(count_words(docs))
