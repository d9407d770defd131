"""Spelling variant grouping with k-d trees over letter-count vectors.

Two words are near if one inserted, deleted or replaced code point turns one into the other.  Then
their letter counts differ by at most two in L1 distance: a replacement takes one letter and adds
another at equal length, an insertion adds one letter.  So the words of each length are kept in k-d trees
over their letter counts, and a word searches the trees of its own length and of the next one for
counts within one letter added and (at equal length) one taken.  Boxes that are farther are pruned; what
is left is verified letter by letter, in order.

Letter counts are written in unary (count c of a letter: its first c bits are set).  A split "at least t of
letter x" is then one bit, and the letters that a word lacks of a box are the bits of ``low & ~word``: box distances
are exact counts of bits.

Dealt over tasks: for each length an upper tree, shaped by a bounded sample of words (it steers the size of
shards only, never the result), deals the words to leaves and sends each word as a query to every leaf that its box does not
rule out.  Leaves of many letters are cut into blocks by hash, and get their queries in each.  A block is one task: it builds its own
tree, searches it, and returns for each word the number of near words and the best of them, never the
pairs.  What grows with the number of words per task is bounded; words that all have the same letters
(which no k-d tree can part) meet block by block.

A word's form is its near word of largest n (ties: smallest in code-point order) where that n is at least
``ratio`` times its own; roots follow forms to the last, by doubling steps in Spark (n grows along a chain, so it
ends after a few).

Edge cases: null texts have no words; a null doc_id counts as an empty string in the hash of
``noisy_words``; repeated rows count each; very long words have blocks of their own size; an empty
table, or one without frequent words, gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: the letters of a run once A-Z are lower-cased: a fixed value
RUN = "[a-zÀ-ÿ]+"
#: a-z, then U+00C0 to U+00FF
LETTERS = 26 + 64
#: words that shape the upper trees, of at most so many letters
SAMPLE, SAMPLE_LETTERS = 65_536, 64
#: sampled words a leaf of an upper tree has at least
SAMPLE_LEAF = 16


# ---------------------------------------------------------------- words

def noisy_words(docs: DataFrame, every: int = 97, min_letters: int = 5) -> DataFrame:
    """One row (word) for each run of letters of ``docs`` (doc_id, text), A-Z lower-cased.

    Where ``every`` divides the CRC-32 of ``<doc_id>:<run>``, the run loses the letter at that CRC modulo its length.
    Words of fewer than ``min_letters`` are left out.
    """
    runs = F.regexp_extract_all(F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit(RUN), F.lit(0))
    run = (docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
           .filter(F.length("run") >= min_letters)
           .withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return (run.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word"))
            .filter(F.length("word") >= min_letters))


def frequent_words(words: DataFrame, min_count: int = 3) -> DataFrame:
    """word, n of the words that occur at least ``min_count`` times."""
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _codes(words: list[str], length: int) -> np.ndarray:
    """The words (all of one length) as rows of letter numbers."""
    c = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)
    return np.where(c >= 0xC0, c - (0xC0 - 26), c - 97).astype(np.uint8)


def _counts(codes: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(codes)), codes.shape[1])
    cells = rows * LETTERS + codes.ravel()
    return np.bincount(cells, minlength=len(codes) * LETTERS).reshape(len(codes), LETTERS)


# ---------------------------------------------------------------- k-d tree

class Unary:
    """Letter counts as bits: of each letter as many as its largest count (larger ones are cut to it,
    which only lowers distances)."""

    def __init__(self, most: np.ndarray):
        self.letter = np.repeat(np.arange(LETTERS), most)
        self.level = np.concatenate([np.arange(1, m + 1) for m in most if m] or [np.zeros(0, np.int64)])
        self.words = max(1, -(-self.letter.size // 64))

    def bits(self, counts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(counts), self.words * 64), bool)
        out[:, :self.letter.size] = counts[:, self.letter] >= self.level
        return np.packbits(out, axis=1, bitorder="little").view(np.uint64)

    def side(self, bit: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``high`` with fewer of the bit's letter than its level, ``low`` with at least as many."""
        same = self.letter == self.letter[bit]
        up, down = np.zeros(self.words * 64, bool), np.ones(self.words * 64, bool)
        up[:self.letter.size] = same & (self.level <= self.level[bit])
        down[:self.letter.size] = ~(same & (self.level >= self.level[bit]))
        pack = lambda x: np.packbits(x, bitorder="little").view(np.uint64)
        return high & pack(down), low | pack(up)


class KdTree:
    """Nodes (low, high, left, right) or (low, high, rows): boxes around letter counts in unary.

    ``tight``: boxes span a node's rows; else they are the half spaces of the splits, so that rows which
    the tree has not seen lie in them too.
    """

    def __init__(self, unary: Unary, bits: np.ndarray, leaf: int, tight: bool):
        self.unary, self.data, self.leaf, self.tight = unary, bits, leaf, tight
        self.nodes: list[tuple] = []
        self.splits: dict[int, int] = {}
        self.build(np.arange(len(bits)), np.zeros(unary.words, np.uint64), np.full(unary.words, ~np.uint64(0)))

    def build(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        mine = self.data[rows]
        if self.tight and rows.size:
            low, high = np.bitwise_and.reduce(mine, axis=0), np.bitwise_or.reduce(mine, axis=0)
        if rows.size > self.leaf:
            set_ = np.unpackbits(mine.view(np.uint8), axis=1, bitorder="little")
            ones = set_.sum(axis=0, dtype=np.int64)
            bit = int(np.argmin(np.abs(2 * ones - rows.size)))       # the most even split
            if 0 < ones[bit] < rows.size:
                has = set_[:, bit].astype(bool)
                high_left, low_right = self.unary.side(bit, low, high)
                self.splits[at] = bit
                self.nodes[at] = (low, high, self.build(rows[~has], low, high_left), self.build(rows[has], low_right, high))
                return at
        self.nodes[at] = (low, high, rows)
        return at

    def search(self, queries: np.ndarray, added: int, taken: int) -> Iterator[tuple[np.ndarray, int]]:
        """Leaf nodes whose box is within ``added`` more and ``taken`` fewer letters, with the queries that reach them."""
        stack = [(0, np.arange(len(queries)))]
        while stack:
            at, who = stack.pop()
            low, high = self.nodes[at][:2]
            q = queries[who]
            near = ((np.bitwise_count(low & ~q).sum(axis=1) <= added)
                    & (np.bitwise_count(q & ~high).sum(axis=1) <= taken))
            who = who[near]
            if who.size:
                if len(self.nodes[at]) == 4:
                    stack += [(self.nodes[at][2], who), (self.nodes[at][3], who)]
                else:
                    yield who, at

    def place(self, queries: np.ndarray) -> np.ndarray:
        """The leaf node that each row falls in."""
        out = np.zeros(len(queries), np.int32)
        stack = [(0, np.arange(len(queries)))]
        while stack:
            at, who = stack.pop()
            if at in self.splits:
                word, shift = divmod(self.splits[at], 64)
                has = (queries[who, word] >> np.uint64(shift)) & np.uint64(1) == 1
                stack += [(self.nodes[at][2], who[~has]), (self.nodes[at][3], who[has])]
            else:
                out[who] = at
        return out


def upper_trees(words: list[str], share: float, block_words: int) -> dict[int, KdTree]:
    """A tree for each length, of sampled words; ``share``: of all words that are in the sample."""
    by_length: dict[int, list[str]] = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    trees = {}
    for length, some in by_length.items():
        counts = _counts(_codes(some, length))
        unary = Unary(counts.max(axis=0))
        trees[length] = KdTree(unary, unary.bits(counts), max(SAMPLE_LEAF, int(block_words * share)), tight=False)
    return trees


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == length)
        step = max(1, (1 << 24) // (length + LETTERS))
        for a in range(0, rows.size, step):
            part = rows[a:a + step]
            yield length, part, [words[k] for k in part.tolist()]


def _route(batches: Iterator[pa.RecordBatch], trees: dict[int, KdTree]) -> Iterator[pa.RecordBatch]:
    """Each word's own length and leaf, and the leaves of its length and of the next that it has to search."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        own = np.zeros(len(words), np.int32)
        targets: list[list] = [[] for _ in words]
        for length, rows, some in _by_length(words):
            counts = _counts(_codes(some, length))
            for size, added, taken in ((length, 1, 1), (length + 1, 1, 0)):
                tree = trees.get(size)
                if tree is None:                      # a length that the sample lacks: one leaf
                    for k in rows.tolist():
                        targets[k].append({"length": size, "leaf": 0})
                    continue
                bits = tree.unary.bits(counts)
                if size == length:
                    own[rows] = tree.place(bits)
                for who, at in tree.search(bits, added, taken):
                    for k in rows[who].tolist():
                        targets[k].append({"length": size, "leaf": at})
        sizes = np.fromiter(map(len, words), np.int32, len(words))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(sizes), pa.array(own),
             pa.array(targets, pa.list_(pa.struct([("length", pa.int32()), ("leaf", pa.int32())])))],
            names=["word", "n", "length", "leaf", "targets"])


# ---------------------------------------------------------------- a block

def one_edit(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether rows of letters ``q`` and ``m`` (as long, or one longer) differ by exactly one edit."""
    if q.shape[1] == m.shape[1]:
        return (q != m).sum(axis=1) == 1
    size = q.shape[1]
    head, tail = q == m[:, :-1], q == m[:, 1:]
    front = np.where(head.all(axis=1), size, np.argmin(head, axis=1))
    back = np.where(tail.all(axis=1), size, np.argmin(tail[:, ::-1], axis=1))
    return front + back >= size


class Best:
    """Of each word the number of near words and the best one so far: largest n, then smallest rank."""

    def __init__(self, n: np.ndarray, rank: np.ndarray):
        self.n, self.rank = n, rank
        self.count, self.word = np.zeros(n.size, np.int64), np.full(n.size, -1, np.int64)

    def add(self, who: np.ndarray, near: np.ndarray) -> None:
        np.add.at(self.count, who, 1)
        had = np.unique(who[self.word[who] >= 0])
        who, near = np.concatenate([who, had]), np.concatenate([near, self.word[had]])
        order = np.lexsort((self.rank[near], -self.n[near], who))
        who, near = who[order], near[order]
        first = np.concatenate([[True], who[1:] != who[:-1]]) if who.size else np.zeros(0, bool)
        self.word[who[first]] = near[first]


def _block(bucket: int, cells: int):
    def compare(key: tuple, table: pa.Table) -> pa.Table:
        length = key[0].as_py()
        words = table.column("word").to_pylist()
        n = table.column("n").to_numpy()
        member = table.column("member").to_numpy(zero_copy_only=False)
        order = np.argsort(np.array(words, object), kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        best = Best(n, rank)
        mine = np.flatnonzero(member)
        if mine.size:
            codes = _codes([words[k] for k in mine.tolist()], length)
            counts = _counts(codes)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            for size, added, taken in ((length, 1, 1), (length - 1, 1, 0)):
                asks = np.flatnonzero(~member & (sizes == size))
                if not asks.size:
                    continue
                q_codes = _codes([words[k] for k in asks.tolist()], size)
                q_counts = _counts(q_codes)
                unary = Unary(np.maximum(counts.max(axis=0), q_counts.max(axis=0)))
                bits, q_bits = unary.bits(counts), unary.bits(q_counts)
                tree = KdTree(unary, bits, bucket, tight=True)
                for who, at in tree.search(q_bits, added, taken):
                    rows = tree.nodes[at][2]
                    step = max(1, cells // (rows.size * max(unary.words, 1)))
                    for a in range(0, who.size, step):
                        some = who[a:a + step]
                        more = np.bitwise_count(bits[rows][None] & ~q_bits[some][:, None]).sum(axis=2)
                        i, j = np.nonzero(more == added)      # equal in sum, so as many are taken as must be
                        i, j = some[i], rows[j]
                        for c in range(0, i.size, max(1, cells // length)):
                            x, y = i[c:c + max(1, cells // length)], j[c:c + max(1, cells // length)]
                            hit = one_edit(q_codes[x], codes[y])
                            x, y = asks[x[hit]], mine[y[hit]]
                            best.add(x, y)
                            if size < length:                 # the longer word does not ask for shorter ones
                                best.add(y, x)
        found = np.flatnonzero(best.count)
        near = best.word[found]
        return pa.table({"word": pa.array([words[k] for k in found.tolist()], pa.string()),
                         "n_near": pa.array(best.count[found]), "near_n": pa.array(n[near]),
                         "near": pa.array([words[k] for k in near.tolist()], pa.string())})
    return compare


# ---------------------------------------------------------------- the whole

def near_words(words: DataFrame, block_words: int = 5_000, bucket: int = 16, cells: int = 1 << 21) -> DataFrame:
    """word, n_near, near_n, near (the best near word) of the words that have one.

    ``words``: a stored table of distinct words of the letters of ``RUN`` with their n.
    """
    total = words.count()
    share = min(1.0, SAMPLE / max(1, total))
    sample = [r["word"] for r in words.filter((F.length("word") <= SAMPLE_LETTERS)
                                              & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1))
              .select("word").limit(2 * SAMPLE).collect()]
    trees = upper_trees(sample, share, block_words)
    placed = materialize(words.select("word", "n").mapInArrow(
        lambda it: _route(it, trees),
        "word string, n long, length int, leaf int, targets array<struct<length int, leaf int>>"), "spelling-placed")
    # a block has about block_words words of 16 letters
    blocks = placed.groupBy("length", "leaf").agg(
        F.ceil(F.count("*") * F.greatest(F.col("length") / 16, F.lit(1.0)) / block_words).cast("int").alias("blocks"))
    members = placed.join(blocks, ["length", "leaf"]).select(
        "length", "leaf", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int").alias("block"), "word", "n",
        F.lit(True).alias("member"))
    asked = placed.select("word", "n", F.explode("targets").alias("t")).select("t.length", "t.leaf", "word", "n")
    queries = asked.join(blocks, ["length", "leaf"]).select(
        "length", "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "word", "n",
        F.lit(False).alias("member"))
    found = members.unionByName(queries).groupBy("length", "leaf", "block").applyInArrow(
        _block(bucket, cells), "word string, n_near long, near_n long, near string")
    best = F.min_by(F.struct("near_n", "near"), F.struct(-F.col("near_n"), F.col("near")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", "best.near_n", "best.near"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of the words that have a form: forms followed to the last, steps doubling each round."""
    links = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        after = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = materialize(links.join(after, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if not links.filter("moved").limit(1).count():
            return links.select("word", "root")
        links = links.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 2, block_words: int = 5_000) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (distinct words of the letters of ``RUN``, with n)."""
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = near_words(words, block_words)
    has = F.col("near_n") >= ratio * F.col("n")
    named = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")), "spelling-forms")
    roots = _roots(named.filter(F.col("form").isNotNull()))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
