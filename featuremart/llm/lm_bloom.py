"""Language-model scoring with a log-frequency Bloom filter.

Counts of n-grams (two to ``order`` words) are quantised to levels
``1 + floor(log2 count)``; an n-gram of level q puts the keys (n-gram, 1) ..
(n-gram, q) into one Bloom filter. A count is read back by probing level after
level until a key is missing or the level of the shorter n-grams inside it is
reached (it cannot be more frequent than they are). A level is never missed; a
false positive can add one. The filter has BITS_PER_NGRAM bits per n-gram token
of the training rows, whatever the corpus, so its false positives do not depend
on the size.

Filling. The filter is cut by n-gram hash into slices. Tasks merge the training
n-grams of several chunks of documents and send them to their slices, where they
are counted and put into the slice's bits; the counts end there.

Scoring. The slices are broadcast to the workers in groups of at most
``group_bytes``, one after the other, so no worker, nor the driver, ever holds
more. Every chunk's distinct n-grams are kept in hash order, cut by group; while
a group is out, they probe it. A chunk's levels then come back in the order it
asked, and its texts are scored from them.

Smoothing: P(w | h) = (low(hw) + MU * P(w | shorter h)) / (high(h) + MU), ending
in the additive unigram probability (c + 0.5) / (N + 0.5 * (V + 1)). ``low`` is the
lower end of the n-gram's level, ``high`` the upper end of the context's, both
bounded by the counts of the words inside, so that without false positives the
probabilities of a context's successors add up to at most one.

Unigram counts are exact. Every chunk of documents asks for the counts of its
distinct words in sorted hash slices and gets them back in the same order, so
no vocabulary is broadcast and a frequent word is one entry per chunk.

Training rows are marked by the caller. Words are told apart by 64-bit hashes.

Defined results: null and empty texts consist of the end token; texts are read
whole; repeated rows count and score one by one; without training rows every
count is 0 and probabilities are the additive ones with N = V = 0; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.chunks import (bit_width, chunked, each_row, mix, record_batch, rows_of, slices_of, word_counts,
                                    word_hashes)
from featuremart.llm.common import freeing_shuffles, written
from featuremart.session import scratch_dir

ORDER = 3
PROBES = 4
BITS_PER_NGRAM = 8
GROUP_BYTES = 64 << 20     # of the filter, broadcast at a time
MERGE_KEYS = 1 << 21       # training n-grams merged in a task before they are sent
LEVELS = 40
MU = 4.0
END = np.uint64(0x5BD1E995A3C59AC3)
SLICE_KEYS = 1 << 19
SPARE_BITS = 10            # an n-gram's hash is this much longer than the number of n-grams


def _pack(x: np.ndarray) -> bytes:
    """Integers as byte planes, compressed (high planes are nearly empty)."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes(), 1)


def _unpack(raw: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64))


def tokens_of(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts in a row (each ends in END) and their counts."""
    h, words = word_hashes(texts, lower=True)
    lens = words + 1
    out = np.empty(len(h) + len(texts), np.uint64)
    ends = np.cumsum(lens) - 1
    word = np.ones(len(out), bool)
    word[ends] = False
    out[ends], out[word] = END, h
    return out, lens


def ngram_hashes(h: np.ndarray, place: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (``bits`` long) of the n-grams that end at the returned token
    indices; ``place`` is each token's place in its text."""
    end = np.flatnonzero(place >= n - 1)
    x = np.full(len(end), n, np.uint64)
    for k in range(n - 1, -1, -1):
        x = mix(x * np.uint64(0x9E3779B97F4A7C15) + h[end - k], n)
    return end, x >> np.uint64(64 - bits)


def _places(lens: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lens)
    return np.arange(int(lens.sum())) - np.repeat(ends - lens, lens)


class CountFilter:
    """Some slices of the filter, from slice ``first`` on; a key's slice is
    given by its hash's top bits, ``bits`` is the size of one slice."""

    def __init__(self, raw: np.ndarray, slice_bits: int, bits: int, key_bits: int, first: int = 0):
        self.raw, self.slice_bits, self.bits, self.key_bits, self.first = raw, slice_bits, bits, key_bits, first

    @staticmethod
    def _start(keys: np.ndarray, level: int):
        x = mix(keys, level)
        return x, (x >> np.uint64(32)) | np.uint64(1)

    @staticmethod
    def _place(x: np.ndarray, bits: int) -> np.ndarray:
        return (((x & np.uint64(0xFFFFFFFF)) * np.uint64(bits)) >> np.uint64(32)).astype(np.int64)

    @classmethod
    def fill(cls, keys: np.ndarray, level: np.ndarray, bits: int) -> bytes:
        """One slice with the keys at their levels."""
        on = np.zeros(bits, bool)
        for q in range(1, int(level.max(initial=0)) + 1):
            x, step = cls._start(keys[level >= q], q)
            for _ in range(PROBES):
                on[cls._place(x, bits)] = True
                x = x + step
        return np.packbits(on, bitorder="little").tobytes()

    def levels(self, keys: np.ndarray, last: np.ndarray | None = None) -> np.ndarray:
        """The highest level found, going up until a key is missing or ``last``
        is reached."""
        level = np.zeros(len(keys), np.int64)
        last = np.full(len(keys), LEVELS - 1) if last is None else last
        base = np.zeros(len(keys), np.int64)
        if self.slice_bits:
            base = ((keys >> np.uint64(self.key_bits - self.slice_bits)).astype(np.int64) - self.first) * (self.bits // 8)
        alive = np.flatnonzero(last)
        for q in range(1, LEVELS):
            x, step = self._start(keys[alive], q)
            for _ in range(PROBES):
                at = self._place(x, self.bits)
                hit = np.flatnonzero((self.raw[base[alive] + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1)
                alive, step = alive[hit], step[hit]
                x = x[hit] + step
            level[alive] = q
            alive = alive[last[alive] > q]
            if not len(alive):
                break
        return level


def last_levels(most: np.ndarray) -> np.ndarray:
    return np.where(most >= 1, 1 + np.log2(np.maximum(most, 1)).astype(np.int64), 0)


def level_bounds(level: np.ndarray, most: np.ndarray, min_count: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper end of the counts of each level, at most ``most`` (a
    bound on the true count). Levels above that of ``most`` count as that level;
    without a level the count is below ``min_count``."""
    level = np.minimum(level, last_levels(most))
    low = np.where(level > 0, np.exp2(level - 1.0), 0.0)
    return low, np.minimum(np.where(level > 0, np.exp2(level) - 1, min_count - 1.0), most)


def _word_requests(chunks: DataFrame, slice_bits: int) -> DataFrame:
    """Distinct words of each chunk and their counts in its training rows."""
    names, kinds = ["slice", "chunk", "keys", "counts"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        for b in batches:
            for chunk, block in each_row(b):
                rows = rows_of(block)
                h, lens = tokens_of(rows.column(1).to_pylist())
                train = np.repeat(rows.column(2).to_numpy(), lens)
                keys, back = np.unique(h, return_inverse=True)
                n = np.bincount(back, weights=train, minlength=len(keys)).astype(np.uint32)
                yield record_batch([(s, chunk, _pack_sorted(keys[a:z]), _pack(n[a:z]))
                                    for s, a, z in slices_of(keys, 64 - slice_bits)], names, kinds)

    return chunks.select("chunk", "block").mapInArrow(run, "slice long, chunk long, keys binary, counts binary")


def _word_answers(requests: DataFrame) -> DataFrame:
    """Corpus counts back to the chunks; n_types and n_tokens of the slice are
    on its first row."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [_unpack_sorted(k) for k in pdf["keys"]]
        flat, back = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.concatenate([_unpack(c, np.uint32) for c in pdf["counts"]])
        total = np.bincount(back, weights=n, minlength=len(flat)).astype(np.uint64)
        answers = np.split(total[back], np.cumsum([len(k) for k in keys])[:-1])
        first = np.arange(len(pdf)) == 0
        return pd.DataFrame({"chunk": pdf["chunk"], "slice": pdf["slice"], "counts": [_pack(a) for a in answers],
                             "n_types": first * int((total > 0).sum()), "n_tokens": first * int(total.sum())})

    return requests.groupBy("slice").applyInPandas(
        run, "chunk long, slice long, counts binary, n_types long, n_tokens long")


def _all_ngrams(h: np.ndarray, place: np.ndarray, order: int, key_bits: int) -> tuple[list, list]:
    """Token indices and hashes of the n-grams of 2 .. ``order`` words."""
    both = [ngram_hashes(h, place, n, key_bits) for n in range(2, order + 1)]
    none = np.zeros(0, np.uint64)
    return [e for e, _ in both], [k for _, k in both] or [none]


def _training_counts(chunks: DataFrame, order: int, slice_bits: int, key_bits: int) -> DataFrame:
    """Distinct n-grams of the training rows and their counts, cut by slice;
    the chunks of a task are merged up to MERGE_KEYS n-grams."""
    names, kinds = ["slice", "keys", "counts"], [pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            n = np.bincount(back, weights=np.concatenate([c for _, c in held])).astype(np.uint32)
            held.clear()
            return record_batch([(s, _pack_sorted(keys[a:z]), _pack(n[a:z]))
                                 for s, a, z in slices_of(keys, key_bits - slice_bits)], names, kinds)

        for b in batches:
            for (block,) in each_row(b):
                rows = rows_of(block)
                rows = rows.filter(rows.column(2))
                h, lens = tokens_of(rows.column(1).to_pylist())
                keys = _all_ngrams(h, _places(lens), order, key_bits)[1]
                held.append(np.unique(np.concatenate(keys), return_counts=True))
                if sum(len(k) for k, _ in held) >= MERGE_KEYS:
                    yield flush()
        if held:
            yield flush()

    return chunks.select("block").mapInArrow(run, "slice long, keys binary, counts binary")


def _filled(counts: DataFrame, per_slice: int, min_count: int) -> DataFrame:
    """(slice, bits): the counts of a slice merged, quantised and put into its
    part of the filter."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        flat, back = np.unique(np.concatenate([_unpack_sorted(k) for k in pdf["keys"]]), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate([_unpack(c, np.uint32) for c in pdf["counts"]]))
        level = np.where(n >= min_count, 1 + np.log2(np.maximum(n, 1)).astype(np.int64), 0)
        return pd.DataFrame({"slice": pdf["slice"][:1], "bits": [CountFilter.fill(flat, level, per_slice)]})

    return counts.groupBy("slice").applyInPandas(run, "slice long, bits binary")


def _requests(chunks: DataFrame, order: int, slice_bits: int, key_bits: int, per_group: int) -> DataFrame:
    """Distinct n-grams of each chunk in hash order, cut by group of slices."""
    names, kinds = ["grp", "chunk", "keys"], [pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        for b in batches:
            for chunk, block in each_row(b):
                h, lens = tokens_of(rows_of(block).column(1).to_pylist())
                # with counts numpy sorts; without, it hashes, which takes far longer here
                keys, _ = np.unique(np.concatenate(_all_ngrams(h, _places(lens), order, key_bits)[1]), return_counts=True)
                grp = (keys >> np.uint64(key_bits - slice_bits)).astype(np.int64) // per_group
                cuts = np.flatnonzero(np.diff(grp, prepend=-1))
                yield record_batch([(int(grp[a]), chunk, _pack_sorted(keys[a:z]))
                                    for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)])], names, kinds)

    return chunks.select("chunk", "block").mapInArrow(run, "grp long, chunk long, keys binary")


def probe(requests: DataFrame, bits, slice_bits: int, per_slice: int, key_bits: int, first: int) -> DataFrame:
    """(chunk, grp, levels) found in the broadcast group ``bits``, whose first
    slice is ``first``."""
    names, kinds = ["chunk", "grp", "levels"], [pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        held = CountFilter(np.frombuffer(bits.value, np.uint8), slice_bits, per_slice, key_bits, first)
        for b in batches:
            yield record_batch([(chunk, grp, _pack(held.levels(_unpack_sorted(keys)).astype(np.uint8)))
                                for chunk, grp, keys in each_row(b)], names, kinds)

    return requests.select("chunk", "grp", "keys").mapInArrow(run, "chunk long, grp long, levels binary")


def ngram_levels(chunks: DataFrame, order: int, tokens: int, train_tokens: int, group_bytes: int,
                 min_count: int = 1) -> tuple[DataFrame, int]:
    """(chunk, grp, levels) for the distinct n-grams of each chunk, and the
    length of their hashes."""
    spark = chunks.sparkSession
    ngrams = train_tokens * (order - 1)
    slice_bits = max(5, bit_width(-(-tokens * (order - 1) // SLICE_KEYS)))
    key_bits = min(64, max(24, bit_width(ngrams) + SPARE_BITS, slice_bits))
    per_slice = 8 * max(1, BITS_PER_NGRAM * ngrams >> slice_bits >> 3)
    per_group = min(1 << slice_bits, max(1, 8 * group_bytes // per_slice))
    base = scratch_dir(spark, f"lm-{uuid.uuid4().hex}")
    with freeing_shuffles(spark):
        slices = written(spark, _filled(_training_counts(chunks, order, slice_bits, key_bits), per_slice, min_count), "lm-filter")
        _requests(chunks, order, slice_bits, key_bits, per_group).write.option("compression", "none") \
            .partitionBy("grp").parquet(f"{base}/requests")
        requests = spark.read.schema("chunk long, keys binary, grp long").parquet(f"{base}/requests")
        for grp in range(-(-(1 << slice_bits) // per_group)):
            first = grp * per_group
            raw = np.zeros(min(per_group, (1 << slice_bits) - first) * per_slice // 8, np.uint8)
            for r in slices.where(F.col("slice").between(first, first + per_group - 1)).toLocalIterator():
                at = (r.slice - first) * per_slice // 8   # the group together is at most group_bytes
                raw[at:at + per_slice // 8] = np.frombuffer(r.bits, np.uint8)
            bits = spark.sparkContext.broadcast(raw.tobytes())
            probe(requests.where(F.col("grp") == grp), bits, slice_bits, per_slice, key_bits, first) \
                .write.mode("append").option("compression", "none").parquet(f"{base}/levels")
            bits.destroy()
    return spark.read.schema("chunk long, grp long, levels binary").parquet(f"{base}/levels"), key_bits


def interpolated(c: np.ndarray, base: np.ndarray, place: np.ndarray, order: int, ends: list, levels: list,
                 min_count: int = 1) -> np.ndarray:
    """Probability of each token from the words' counts and the levels of the
    n-grams that end at ``ends``, order by order."""
    p, suffix, context = base, c, np.concatenate([[0.0], c[:-1]])
    for k, end, level in zip(range(2, order + 1), ends, levels):
        low, high = np.zeros(len(c)), np.zeros(len(c))
        low[end], high[end] = level_bounds(level, np.minimum(suffix[end], context[end]), min_count)
        p = np.where(place >= k - 1, (low + MU * p) / (context + MU), p)
        suffix, context = high, np.concatenate([[0.0], high[:-1]])
    return p


def score(df: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", order: int = ORDER,
          group_bytes: int = GROUP_BYTES, min_count: int = 1) -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens,
    base_score (additive unigrams) and score, both log10."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key), F.col(text).alias("lm_text"), (~held_out).alias("lm_train"))

    def size(texts):
        return int(word_counts(texts).sum()) + len(texts)

    chunks = chunked(rows, "lm-chunks", "lm_text", size)
    tokens = chunks.agg(F.sum("size")).first()[0] or 0
    slice_bits = max(5, bit_width(-(-tokens // SLICE_KEYS)))
    with freeing_shuffles(spark):
        answers = written(spark, _word_answers(_word_requests(chunks, slice_bits)), "lm-words")
    v, n = (int(x or 0) for x in answers.agg(F.sum("n_types"), F.sum("n_tokens")).first())
    levels, key_bits = ngram_levels(chunks, order, tokens, n, group_bytes, min_count)
    told = answers.select("chunk", F.lit(False).alias("ngrams"), "slice", F.col("counts").alias("raw")) \
        .unionByName(levels.select("chunk", F.lit(True).alias("ngrams"), F.col("grp").alias("slice"), F.col("levels").alias("raw"))) \
        .groupBy("chunk").agg(F.collect_list(F.struct("ngrams", "slice", "raw")).alias("told"))
    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        def answer(told, ngrams, kind):
            parts = sorted((x for x in told if x["ngrams"] == ngrams), key=lambda x: x["slice"])
            return np.concatenate([np.zeros(0, kind), *(_unpack(x["raw"], kind) for x in parts)])

        for b in batches:
            for block, told in each_row(b):
                part = rows_of(block)
                h, lens = tokens_of(part.column(1).to_pylist())
                _, back = np.unique(h, return_inverse=True)
                c = answer(told, False, np.uint64)[back].astype(float)
                base = (c + 0.5) / (n + 0.5 * (v + 1))
                place = _places(lens)
                ends, keys = _all_ngrams(h, place, order, key_bits)
                _, back = np.unique(np.concatenate(keys), return_inverse=True)
                found = np.split(answer(told, True, np.uint8)[back], np.cumsum([len(e) for e in ends])[:-1])
                p = interpolated(c, base, place, order, ends, found, min_count)
                at = np.cumsum(lens) - lens
                sums = [np.add.reduceat(x, at) for x in (np.log10(base), np.log10(p), (c > 0).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).combine_chunks(), pa.array(~part.column(2).to_numpy()), pa.array(lens),
                     pa.array(sums[2], pa.int64()), pa.array(np.full(len(lens), n), pa.int64()),
                     pa.array(sums[0]), pa.array(sums[1])], names=names)

    return chunks.select("chunk", "block").join(told, "chunk").select("block", "told").mapInArrow(
        run, f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")
