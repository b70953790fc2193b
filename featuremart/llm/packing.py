"""Packing of token sequences by minimum bin slack.

Every document is tokenised whole and cut into pieces of ``capacity`` tokens;
the full pieces are sequences of their own. What remains of each document is
packed by its *length*: the corpus is reduced to a histogram of remaining
lengths (fewer than ``capacity`` rows), and the plan is made on the histogram.

Each step of the plan takes the largest remaining length and picks the multiset
of other remaining lengths that fills the window closest to capacity: subset
sums are bits of an integer, one shift per (binary part of the) count of a
length, and the counts used are read back through the kept bit sets. The
pattern is applied as often as the counts allow, so the plan's size depends on
the capacity, not on the number of documents.

Pieces get ranks inside their length, in parallel: each length is cut into
hash buckets of about 1/BUCKETS of all pieces, rows are numbered inside
(length, bucket) and shifted by the counts before (at most capacity + BUCKETS
rows). Rank and length then say sequence and offset through the plan.

Defined results: null and empty texts are one piece, the end id; a text of any
length is read whole; repeated rows are packed one by one; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import written

CAPACITY = 2048
END_ID = 1
BUCKETS = 4096
CACHE = 1_300_000      # distinct words remembered by a worker process, over its tasks
MARK = "\x01"          # stands between words that are encoded together
TOGETHER = 500
CLOSING = b".,;:!?$#%*&|<>()\"=-"
_encoders: dict = {}   # one per worker process and tokenizer file


def _ends_in_letter(stem: bytes) -> bool:
    """Whether the last code point is a letter (or ASCII digit) when the
    tokenizer has normalised and lower-cased it."""
    if stem[-1] < 128:
        return stem[-1:].isalnum()
    return unicodedata.category(unicodedata.normalize("NFC", stem.decode()).lower()[-1])[0] == "L"


class WordIds:
    """Token ids of whole texts, word by word.

    The tokenizer drops white space and never joins across it, so a text's
    ids are those of its words in order. Words not seen lately are encoded
    many at a time, apart by a mark of one token.
    """

    def __init__(self, blob: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_buffer(blob)  # as it is: strings of special tokens in a text become these tokens
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        self.mark = self._ids(MARK)

    @classmethod
    def shared(cls, blob: bytes) -> WordIds:
        """The worker process's encoder; its words stay known to later tasks."""
        key = zlib.crc32(blob), len(blob)
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = cls(blob)
        return _encoders[key]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, words: list[bytes]) -> None:
        """Words that differ in case or in closing punctuation share their
        letters: the tokenizer lower-cases and cuts between a letter or digit
        and punctuation, so a word's ids are those of the two parts. What counts
        is the letter after its normal form: some end in a combining mark, which
        goes with the punctuation. A word that holds a special token's string is
        encoded whole."""
        todo, whole, stems, tails = set(), [], [], []
        for w in words:
            stem = w.rstrip(CLOSING).lower()
            if stem == w or not stem or not _ends_in_letter(stem) or any(t in w for t in self.special):
                todo.add(w)
            else:
                whole.append(w)
                stems.append(stem)
                tails.append(w[len(stem):])
        self._encode(list(todo.union(stems, tails).difference(self.known)))
        known = self.known
        for w, stem, tail in zip(whole, stems, tails):
            known[w] = known[stem] + known[tail]

    def _encode(self, words: list[bytes]) -> None:
        mark = MARK.encode()
        plain = []
        for w in words:
            if mark in w or len(self.mark) != 1 or not w:
                self.known[w] = self._ids(w.decode()).tobytes()
            else:
                plain.append(w)
        sep = b" " + mark + b" "
        for at in range(0, len(plain), TOGETHER):
            part = plain[at:at + TOGETHER]
            ids = self._ids(sep.join(part).decode())
            cuts = np.flatnonzero(ids == self.mark[0])
            lo, hi = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(ids)]])
            raw = ids.tobytes()
            for w, a, b in zip(part, lo.tolist(), hi.tolist()):
                self.known[w] = raw[4 * a:4 * b]

    def __call__(self, texts: list) -> list[np.ndarray]:
        docs = [t.encode().split() if t else [] for t in texts]
        if len(self.known) > CACHE:
            self.known = {}
        words = list(chain.from_iterable(docs))
        ids = list(map(self.known.get, words))
        new, at = [], -1
        for _ in range(ids.count(None)):
            new.append(at := ids.index(None, at + 1))
        self._learn(list({words[i] for i in new}))
        for i in new:
            ids[i] = self.known[words[i]]
        out, at = [], 0
        for d in docs:
            out.append(np.frombuffer(b"".join(ids[at:at + len(d)]), np.uint32))
            at += len(d)
        return out


def pieces(df: DataFrame, blob: bytes, key: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, doc_tokens and, if asked, ids)."""
    kind = df.schema[key].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(blob)  # the tokenizer's file, under 2 MB
    names = [key, "piece", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches):
        from pyspark import TaskContext

        encode, n = WordIds.shared(shared.value), TaskContext.get().partitionId() << 32
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for i, x in enumerate(encode(part.column(1).to_pylist())):
                    x = np.append(x, np.uint32(end_id))
                    for s in range(0, len(x), capacity):
                        cut = x[s:s + capacity]
                        row.append(i), start.append(s), length.append(len(cut)), total.append(len(x))
                        crc.append(zlib.crc32(cut.astype("<u4").tobytes()))
                        if with_ids:
                            ids.append(cut.astype(np.int32))
                at = np.arange(n, n + len(row))
                n += len(row)
                cols = [part.column(0).take(pa.array(row, pa.int64())), pa.array(at, pa.int64()),
                        *(pa.array(c, pa.int64()) for c in (start, length, crc, total))]
                yield pa.RecordBatch.from_arrays(
                    cols + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names=names)

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, piece long, start long, length long, "
                                                "ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids)


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and counts whose sum is the largest not above ``room``."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part, now = min(counts[length], room // length), 1, reach
        while left:  # binary parts 1, 2, 4, ... and the rest give every count
            part = min(part, left)
            now |= (now << (part * length)) & mask
            left -= part
            part *= 2
        if now != reach:
            steps.append((length, reach))
            reach = now
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            used[length] = n
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, dict[int, int]]]:
    """(first sequence, repeats, lengths and counts) of every pattern."""
    left = {k: n for k, n in counts.items() if n}
    out, first = [], 0
    while left:
        top = max(left)
        left[top] -= 1
        used = best_fill({k: n for k, n in left.items() if n}, capacity - top)
        left[top] += 1
        used[top] = used.get(top, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        out.append((first, times, used))
        first += times
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def plan_table(patterns) -> dict[str, np.ndarray]:
    """The plan as arrays: ranks [rank, ...) of ``length`` go, ``use`` to a
    sequence, to sequences from ``first`` on, at ``offset`` there."""
    taken: dict[int, int] = {}
    rows = []
    for first, times, used in patterns:
        offset = 0
        for length in sorted(used, reverse=True):
            rows.append((length, taken.get(length, 0), used[length], first, offset))
            taken[length] = taken.get(length, 0) + times * used[length]
            offset += length * used[length]
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "use", "first", "offset"), cols))


def pack(df: DataFrame, blob: bytes, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ids)."""
    spark = df.sparkSession
    cut = written(spark, pieces(df, blob, key, text, capacity, end_id, with_ids), "pack-pieces")
    lengths = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in lengths.collect()}  # at most ``capacity`` rows
    table = plan_table(plan(counts, capacity))
    each = max(1, -(-sum(counts.values()) // BUCKETS))
    parts = spark.createDataFrame([(k, -(-n // each)) for k, n in counts.items()], "length long, parts long")
    rows = cut.join(F.broadcast(parts), "length") \
        .withColumn("bucket", F.pmod(F.xxhash64("piece"), F.col("parts"))).drop("parts")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")) \
        .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = rows.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("piece"))) \
        .join(F.broadcast(offsets), ["length", "bucket"]) \
        .withColumn("rank", F.col("rank").cast("long") + F.col("before") - 1)
    cols = [key, "start", "length", "ids_crc32", "doc_tokens", "rank"] + ["ids"] * with_ids
    starts = table["length"] << 48 | table["rank"]

    def run(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(starts, length << 48 | rank, "right") - 1
            inside, use = rank - table["rank"][at], table["use"][at]
            seq = table["first"][at] + inside // np.maximum(use, 1)
            off = table["offset"][at] + inside % np.maximum(use, 1) * length
            data = [b.column(c) for c in cols if c != "rank"]
            yield pa.RecordBatch.from_arrays([*data, pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                                             names=[c for c in cols if c != "rank"] + ["sequence_id", "offset"])

    kind = df.schema[key].dataType.simpleString()
    return numbered.select(*cols).mapInArrow(
        run, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        + "ids array<int>, " * with_ids + "sequence_id long, offset long")
