"""Spelling variant grouping: words one edit apart, found in FM-indexes.

Counting. Runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts are
lower-cased (A-Z only) and counted with built-in functions; the caller may
alter a run first (``alter``). The vocabulary holds the words of at least
``min_length`` code points and ``min_count`` occurrences.

Search. Of two words one edit apart, either the left or the right half of one
is untouched in the other. Both search schemes match that half exactly and then
extend across the other half allowing one error, down to the delimiter. An
index holds delimited words as one circular text; a pattern's matches are an
interval of suffix ranks, and a symbol put before the pattern maps both ends of
the interval by one lookup among the (symbol, place) pairs of the
Burrows-Wheeler transform. A scheme runs in one direction throughout: the right
half is matched leftwards on the words, the left half leftwards on the reversed
words. The two sets of intervals together are the bidirectional index. The
interval of a whole delimited word is its rank among the words. The scheme with
an untouched right half leaves out what also has the untouched left half, so no
pair is counted twice.

Partitioning. A word of length l is indexed once per direction, under the key
(l, its first (l - 1) // 2 code points); as a query it goes to the keys of
lengths l - 1, l and l + 1. Its untouched half is never shorter, so every near
word is under one of them. Keys are dealt by hash to shards of about
SHARD_WORDS words; a key with more words, or three times as many queries (a hot
beginning), is cut into parts of that size, and every part of its words meets
every part of its queries. A shard gives one row per query: how many near words,
and the best. Nothing is capped; queries are read in blocks of QUERY_BLOCK.

Forms. A word's form is its near word of largest count (ties: smallest in code
point order) if that is at least ``ratio`` times its own; roots follow the forms
to the last by pointer doubling (counts grow by the ratio at each step, so there
are no cycles).

Defined results: null and empty texts have no words; a null key counts as an
empty one; repeated rows count one by one; texts and words are read whole,
whatever their length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import whole_text, written

RUN = "[a-zÀ-ÿ]+"          # after lower-casing
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARD_WORDS = 1 << 14
QUERY_BLOCK = 1 << 13
ENUMERATE = 64     # intervals up to this size are read place by place


def drop_letter(key: str = "doc_id", every: int = 97):
    """Alteration that deletes one letter of about one run in ``every``,
    chosen by a checksum of the key and the run."""
    def alter(run: Column) -> Column:
        name = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), run)
        h, n = F.crc32(name.cast("binary")), F.char_length(run)
        at = (h % n).cast("int")
        return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, n))).otherwise(run)
    return alter


def count_words(df: DataFrame, text: str = "text", alter=None, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n) of the vocabulary."""
    lowered = F.translate(whole_text(text), UPPER, LOWER)
    runs = df.withColumn("sv_run", F.explode(F.regexp_extract_all(lowered, F.lit(f"({RUN})"), F.lit(0))))
    words = runs.select((alter(F.col("sv_run")) if alter else F.col("sv_run")).alias("word"))
    return words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= min_count)


def _flat(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words and where each word starts (and the end)."""
    starts = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64), starts


class WordIndex:
    """FM-index of sorted distinct words as the circular text $w1$w2..$wn."""

    def __init__(self, words: list[str]):
        codes, starts = _flat(words)
        self.n, lens = len(words), np.diff(starts)
        self.letters = np.unique(codes)                     # symbol k + 1; the delimiter is 0
        size = len(codes) + self.n
        text = np.zeros(size, np.int64)
        inner = np.ones(size, bool)
        inner[starts[:-1] + np.arange(self.n)] = False
        text[inner] = np.searchsorted(self.letters, codes) + 1
        order = self._sorted(text, int(lens.max(initial=0)))
        self.size, self.bwt = size, text[order - 1]
        # the (symbol, place) pairs of the transform: a lookup is C[c] + Occ(c, place)
        self.pairs = np.sort(self.bwt * size + np.arange(size))

    @staticmethod
    def _sorted(text: np.ndarray, longest: int) -> np.ndarray:
        """Order of the rotations, by prefix doubling."""
        size, step = len(text), 1
        rank = np.unique(text, return_inverse=True)[1]
        while True:
            key = rank * size + np.roll(rank, -step)
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(size, np.int64)
            rank[order] = new
            step *= 2
            if new[-1] == size - 1 or step > 2 * longest + 2:
                return order

    def extend(self, lo: np.ndarray, hi: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with symbol ``c`` put before them."""
        return np.searchsorted(self.pairs, c * self.size + lo), np.searchsorted(self.pairs, c * self.size + hi)

    def symbols(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, letter) for the letters that may stand before each pattern."""
        small = hi - lo <= ENUMERATE
        few, many = np.flatnonzero(small), np.flatnonzero(~small)
        n = (hi - lo)[few]
        at = np.repeat(lo[few] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        base = len(self.letters) + 1
        both = np.unique(np.repeat(few, n) * base + self.bwt[at])
        state, letter = both // base, both % base
        keep = letter > 0
        return np.concatenate([state[keep], np.repeat(many, base - 1)]), \
            np.concatenate([letter[keep], np.tile(np.arange(1, base), len(many))])

    def near(self, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs exactly one edit apart whose last ``exact``
        letters of the query are untouched."""
        codes, starts = _flat(queries)
        at = np.minimum(np.searchsorted(self.letters, codes), max(len(self.letters) - 1, 0))
        known = self.letters[at] == codes if len(self.letters) else np.zeros(len(codes), bool)
        symbol = np.append(np.where(known, at + 1, -1), -1)  # -1: in no word
        q = np.arange(len(queries))
        left = np.diff(starts)                # letters still to match
        free = left - exact                   # an error may come once so many are left
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), self.n)
        err = np.zeros(len(q), bool)
        found_q, found_w = [q[:0]], [q[:0]]
        while len(q):
            here = np.where(left > 0, symbol[starts[q] + np.maximum(left - 1, 0)], 0)
            ask = ~((left == 0) & ~err) & (here >= 0)   # the word itself is not near itself
            a, b = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
            a[ask], b[ask] = self.extend(lo[ask], hi[ask], here[ask])
            done = np.flatnonzero((left == 0) & (a < b))
            found_q.append(q[done])
            found_w.append(a[done])           # the delimited word's rank is its number
            go = np.flatnonzero((left > 0) & (a < b))
            nxt = [(q[go], left[go] - 1, a[go], b[go], err[go])]
            open_ = np.flatnonzero(~err & (left <= free[q]))
            if len(open_):
                yes = np.ones
                gone = open_[left[open_] > 0]           # a letter of the query is missing
                nxt.append((q[gone], left[gone] - 1, lo[gone], hi[gone], yes(len(gone), bool)))
                state, letter = self.symbols(lo[open_], hi[open_])
                state = open_[state]
                x, y = self.extend(lo[state], hi[state], letter)
                live = x < y
                state, letter, x, y = state[live], letter[live], x[live], y[live]
                nxt.append((q[state], left[state], x, y, yes(len(state), bool)))       # one more letter
                other = (left[state] > 0) & (letter != here[state])                    # another letter
                state, x, y = state[other], x[other], y[other]
                nxt.append((q[state], left[state] - 1, x, y, yes(len(state), bool)))
            q, left, lo, hi, err = (np.concatenate(z) for z in zip(*nxt))
            if len(q) and err.any():          # one state for each interval, however it was reached
                order = np.lexsort((hi, lo, left, q, err))
                same = np.ones(len(order), bool)
                same[1:] = np.any([np.diff(z[order]) != 0 for z in (q, left, lo, hi, err.view(np.int8))], axis=0)
                q, left, lo, hi, err = (z[order[same]] for z in (q, left, lo, hi, err))
        pairs = np.unique(np.stack([np.concatenate(found_q), np.concatenate(found_w)], 1), axis=0)
        return pairs[:, 0], pairs[:, 1]


def _search_shard(words: list[str], counts: np.ndarray, queries: list[str], reverse: bool) -> Iterator[tuple]:
    """(query, near words, count of the best, the best) per query with any.
    With ``reverse`` the left halves stay untouched, else the right halves."""
    order = sorted(range(len(words)), key=lambda i: words[i][::-1] if reverse else words[i])
    words, counts = [words[i] for i in order], counts[order]
    index = WordIndex([w[::-1] for w in words] if reverse else words)
    for s in range(0, len(queries), QUERY_BLOCK):
        block = queries[s:s + QUERY_BLOCK]
        half = np.array([len(w) // 2 if reverse else len(w) - len(w) // 2 for w in block], np.int64)
        q, w = index.near([x[::-1] for x in block] if reverse else block, half)
        if not reverse and len(q):            # these are the other scheme's
            own = np.fromiter((not words[j].startswith(block[i][:len(block[i]) // 2])
                               for i, j in zip(q.tolist(), w.tolist())), bool, len(q))
            q, w = q[own], w[own]
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))] = np.arange(len(words))
        by = np.lexsort((rank[w], q))
        q, w = q[by], w[by]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        for i, j, n in zip(q[first].tolist(), w[first].tolist(), np.diff(np.append(first, len(q))).tolist()):
            yield block[i], n, int(counts[j]), words[j]


def near_words(vocabulary: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of the words of (word, n) that have near
    words; ``vocabulary`` should be a written table (it is read twice)."""
    spark = vocabulary.sparkSession
    shards = max(1, -(-2 * vocabulary.count() // shard_words))
    key, size = ["sv_back", "sv_len", "sv_half"], F.char_length("word")
    half = F.expr("if(sv_back, left(word, {0}), right(word, {0}))".format("cast((sv_len - 1) div 2 as int)"))
    both = vocabulary.withColumn("sv_back", F.explode(F.array(F.lit(False), F.lit(True))))
    placed = both.withColumn("sv_len", size).withColumn("sv_half", half).withColumn("sv_ask", F.lit(False))
    asked = both.withColumn("sv_len", F.explode(F.sequence(size - 1, size + 1))).withColumn("sv_half", half) \
        .withColumn("sv_ask", F.lit(True))

    def cut(count: str, at_most: int) -> Column:
        return F.ceil(F.col(count) / at_most).cast("int")

    # only keys of more words or queries than a shard takes, so at most 8 V / shard_words rows
    hot = placed.unionByName(asked).groupBy(*key).agg(F.count_if(~F.col("sv_ask")).alias("w"), F.count_if("sv_ask").alias("q")) \
        .where((F.col("w") > shard_words) | (F.col("w") > 0) & (F.col("q") > 3 * shard_words)) \
        .select(*key, cut("w", shard_words).alias("sv_w"), cut("q", 3 * shard_words).alias("sv_q"))
    hot = F.broadcast(written(spark, hot, "spelling-hot"))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """One part of the own side by hash, every part of the other side."""
        n, m = (F.coalesce(F.col(c), F.lit(1)) for c in (own, other))
        return rows.join(hot, key, "left").withColumn("p", F.pmod(F.xxhash64("word"), n).cast("int")) \
            .withColumn("o", F.explode(F.sequence(F.lit(0), m - 1)))

    cols = ["sv_back", "sv_ask", "word", "n", "sv_len", "sv_half", "p", "o"]
    rows = dealt(placed, "sv_w", "sv_q").select(cols).unionByName(
        dealt(asked, "sv_q", "sv_w").select(*cols[:-2], F.col("o").alias("p"), F.col("p").alias("o"))) \
        .select("sv_back", "sv_ask", "word", "n", F.pmod(F.xxhash64("sv_len", "sv_half", "p", "o"), F.lit(shards)).alias("sv_shard"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ask = pdf["sv_ask"].to_numpy()
        words, out = pdf[~ask], []
        if len(words) and ask.any():
            out = list(_search_shard(words["word"].tolist(), words["n"].to_numpy(),
                                     pdf.loc[ask, "word"].drop_duplicates().tolist(), bool(pdf["sv_back"].iloc[0])))
        return pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])

    found = rows.groupBy("sv_back", "sv_shard").applyInPandas(
        run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")) \
        .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def roots_of(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows, forms followed to the last."""
    spark = links.sparkSession
    roots = written(spark, links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = roots.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                      F.col("next").isNotNull().alias("moved"))
        step = written(spark, step, "spelling-roots")
        if not step.where("moved").limit(1).count():
            return roots
        roots = step.select("word", "root")


def group_variants(df: DataFrame, text: str = "text", alter=None, min_length: int = 5, min_count: int = 3,
                   ratio: int = 2, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    spark = df.sparkSession
    vocabulary = written(spark, count_words(df, text, alter, min_length, min_count), "spelling-words")
    near = near_words(vocabulary, shard_words)
    better = F.col("best_n") >= ratio * F.col("n")
    known = vocabulary.join(near, "word", "left").select(
        "word", F.when(better, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("best_n")).alias("form_n"))
    known = written(spark, known, "spelling-forms")
    roots = roots_of(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
