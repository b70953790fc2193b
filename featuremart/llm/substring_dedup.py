"""Substring de-duplication with a count-min prefilter.

A window is ``window`` consecutive words. Words covered by a window whose word
sequence also starts anywhere else are removed.

First pass: every chunk of documents makes a partial count-min sketch of its
windows (``DEPTH`` hash rows of saturating counters, cells 0, 1 or 2+). A
partial sketch is sparse, so it travels as the sorted numbers of its non-empty
cells, cut into slices of the cell range; one task per (row, slice) merges the
partial sketches and answers each chunk which of its cells reach two. Counters
only overestimate, so a window that truly repeats is estimated repeated in
every row. The width follows the number of windows (four cells each), and no
task holds more than one slice (at most 2**MAX_SLICE_BITS bytes): the sketch is
never broadcast and never whole anywhere.

Second pass: only windows estimated repeated are grouped exactly, by two
independent 64-bit hashes of their word sequence (128 bits), again as distinct
sorted keys per chunk. The answers return to the chunks, which take the
covered words out.

Defined results: null and empty texts have no words and stay as they are;
repeated rows are repeats of each other, so texts of ``window`` words or more
lose every word in all copies; texts shorter than a window lose nothing; a
text that loses no word is unchanged, any other becomes its kept words joined
by one space; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from featuremart.llm.chunks import (bit_width, chunked, each_row, mix, pack_bits, record_batch, rows_of, slices_of,
                                    unpack_bits, window_hashes, word_counts, word_hashes)
from featuremart.llm.common import fresh

WINDOW = 35
DEPTH = 2
CELLS_PER_WINDOW = 4
MIN_SLICE_BITS, MAX_SLICE_BITS = 20, 26
SLICE_TARGET_BITS = 9        # about 2**9 slices, until slices reach their largest size
EXACT_KEYS = 1 << 21         # windows per slice of the exact pass


class Windows:
    """The windows of one chunk: word hashes and where windows may start."""

    def __init__(self, texts: list, size: int):
        h, self.lens = word_hashes(texts)
        first = window_hashes(h, size)
        ends = np.repeat(np.cumsum(self.lens), self.lens)[:len(first)]
        self.start = np.flatnonzero(np.arange(len(first)) + size <= ends)
        self.first = first[self.start]
        self.hashes, self.size = h, size

    def cells(self, row: int, bits: int) -> np.ndarray:
        return mix(self.first, row + 1) >> np.uint64(64 - bits)

    def second(self, pick: np.ndarray) -> np.ndarray:
        """The other half of the 128-bit key, of the picked windows."""
        return window_hashes(mix(self.hashes, 77), self.size)[self.start[pick]]


def _pack_cells(cells: np.ndarray) -> bytes:
    """Sorted distinct cell numbers as gaps, low bytes first, compressed."""
    gaps = np.diff(cells, prepend=0).astype(np.uint32)
    return zstandard.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack_cells(raw: bytes) -> np.ndarray:
    gaps = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(gaps).view(np.uint32).ravel(), dtype=np.int64)


def count_windows(size: int):
    return lambda texts: int(np.maximum(word_counts(texts) - size + 1, 0).sum())


def partial_sketches(chunks: DataFrame, at: int, size: int, bits: int, slice_bits: int) -> DataFrame:
    names = ["row", "slice", "chunk", "cells", "twice"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        for b in batches:
            for chunk, block in each_row(b):
                win = Windows(rows_of(block).column(at).to_pylist(), size)
                out = []
                for row in range(DEPTH):
                    cells, n = np.unique(win.cells(row, bits), return_counts=True)
                    for s, lo, hi in slices_of(cells, slice_bits):
                        local = (cells[lo:hi] & np.uint64((1 << slice_bits) - 1)).astype(np.int64)
                        out.append((row, s, chunk, _pack_cells(local), pack_bits(n[lo:hi] > 1)))
                yield record_batch(out, names, kinds)

    return chunks.select("chunk", "block").mapInArrow(
        run, "row int, slice long, chunk long, cells binary, twice binary")


def merge_sketches(parts: DataFrame, slice_bits: int) -> DataFrame:
    """(chunk, answers): for each row and slice, bits saying which of the
    chunk's cells reach two in the merged sketch."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(1 << slice_bits, np.uint8)
        for raw, twice in zip(pdf["cells"], pdf["twice"]):
            cells = _unpack_cells(raw)
            # cells are distinct inside one partial sketch
            counts[cells] = np.minimum(counts[cells] + 1 + unpack_bits(twice, len(cells)), 2)
        bits = [pack_bits(counts[_unpack_cells(raw)] > 1) for raw in pdf["cells"]]
        return pd.DataFrame({"chunk": pdf["chunk"], "row": pdf["row"], "slice": pdf["slice"], "bits": bits})

    merged = parts.groupBy("row", "slice").applyInPandas(run, "chunk long, row int, slice long, bits binary")
    return merged.groupBy("chunk").agg(F.collect_list(F.struct("row", "slice", "bits")).alias("repeated_cells"))


def _estimated(win: Windows, answers, bits: int, slice_bits: int) -> np.ndarray:
    """Windows (indices into win.start) estimated repeated in every row."""
    ok = np.ones(len(win.start), bool)
    by = {(a["row"], a["slice"]): a["bits"] for a in answers or ()}
    for row in range(DEPTH):
        cells, back = np.unique(win.cells(row, bits), return_inverse=True)
        flags = np.zeros(len(cells), bool)
        for s, lo, hi in slices_of(cells, slice_bits):
            if (row, s) in by:
                flags[lo:hi] = unpack_bits(by[row, s], hi - lo)
        ok &= flags[back]
    return np.flatnonzero(ok)


def _exact_keys(win: Windows, pick: np.ndarray):
    """Distinct (first, second) keys of the picked windows in sorted order,
    whether each occurs twice here, and each window's place among them."""
    a, b = win.first[pick], win.second(pick)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    place = np.empty(len(a), np.int64)
    place[order] = np.cumsum(new) - 1
    return a[new], b[new], np.bincount(place, minlength=int(new.sum())) > 1, place


def exact_requests(joined: DataFrame, at: int, size: int, bits: int, slice_bits: int, shift: int) -> DataFrame:
    names = ["slice", "chunk", "first", "second", "twice"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches):
        for b in batches:
            for chunk, block, answers in each_row(b):
                win = Windows(rows_of(block).column(at).to_pylist(), size)
                a, c, twice, _ = _exact_keys(win, _estimated(win, answers, bits, slice_bits))
                yield record_batch([(s, chunk, a[lo:hi].tobytes(), c[lo:hi].tobytes(), pack_bits(twice[lo:hi]))
                              for s, lo, hi in slices_of(a, shift)], names, kinds)

    return joined.select("chunk", "block", "repeated_cells").mapInArrow(
        run, "slice long, chunk long, first binary, second binary, twice binary")


def exact_answers(requests: DataFrame) -> DataFrame:
    """(chunk, answers): for each slice, bits saying which of the chunk's
    window keys occur twice or more in the corpus."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        firsts = [np.frombuffer(x, np.uint64) for x in pdf["first"]]
        lens = [len(x) for x in firsts]
        a = np.concatenate(firsts)
        b = np.frombuffer(b"".join(pdf["second"]), np.uint64)
        n = 1 + np.concatenate([unpack_bits(t, k) for t, k in zip(pdf["twice"], lens)]).astype(np.int64)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        group = np.cumsum(new) - 1
        again = np.empty(len(a), bool)
        again[order] = np.add.reduceat(n[order], np.flatnonzero(new))[group] > 1
        bits = [pack_bits(x) for x in np.split(again, np.cumsum(lens)[:-1])]
        return pd.DataFrame({"chunk": pdf["chunk"], "slice": pdf["slice"], "bits": bits})

    return requests.groupBy("slice").applyInPandas(run, "chunk long, slice long, bits binary") \
        .groupBy("chunk").agg(F.collect_list(F.struct("slice", "bits")).alias("repeated_windows"))


def remove_repeats(df: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """All columns of ``df`` and kept_words (the words left, joined by one
    space), n_words, n_removed (underscores are added to a taken name)."""
    chunks = chunked(df, "substring-chunks", text, count_windows(window))
    total = chunks.agg(F.sum("size")).first()[0] or 0
    bits = max(MIN_SLICE_BITS, bit_width(CELLS_PER_WINDOW * total))
    slice_bits = min(max(bits - SLICE_TARGET_BITS, MIN_SLICE_BITS), MAX_SLICE_BITS)
    shift = 64 - max(6, bit_width(-(-total // EXACT_KEYS)))
    at = df.columns.index(text)
    cells = merge_sketches(partial_sketches(chunks, at, window, bits, slice_bits), slice_bits)
    joined = chunks.select("chunk", "block").join(cells, "chunk", "left")
    windows = exact_answers(exact_requests(joined, at, window, bits, slice_bits, shift))
    both = joined.join(windows, "chunk", "left")
    kept, n_words, n_removed = (fresh(df, c) for c in ("kept_words", "n_words", "n_removed"))

    def run(batches):
        for b in batches:
            for block, cell_answers, answers in each_row(b):
                rows = rows_of(block)
                source = rows.column(at).to_pylist()
                win = Windows(source, window)
                pick = _estimated(win, cell_answers, bits, slice_bits)
                a, _, _, place = _exact_keys(win, pick)
                again = np.zeros(len(a), bool)
                by = {x["slice"]: x["bits"] for x in answers or ()}
                for s, lo, hi in slices_of(a, shift):
                    again[lo:hi] = unpack_bits(by[s], hi - lo)
                hit = win.start[pick[again[place]]]
                cover = np.zeros(len(win.hashes) + 1, np.int64)
                cover[hit] += 1
                cover[hit + window] -= 1
                gone = np.cumsum(cover)[:-1] > 0
                texts, removed, at_word = [], [], 0
                for text_, n in zip(source, win.lens.tolist()):
                    words = text_.encode().split() if text_ else []
                    mask = gone[at_word:at_word + n]
                    at_word += n
                    removed.append(int(mask.sum()))
                    left = [w for w, g in zip(words, mask.tolist()) if not g] if removed[-1] else words
                    texts.append(b" ".join(left).decode())
                out = rows.append_column(kept, pa.array(texts, pa.string())) \
                    .append_column(n_words, pa.array(win.lens)).append_column(n_removed, pa.array(removed, pa.int64()))
                yield from out.combine_chunks().to_batches()

    schema = StructType([*df.schema.fields, StructField(kept, StringType()),
                         StructField(n_words, LongType()), StructField(n_removed, LongType())])
    return both.select("block", "repeated_cells", "repeated_windows").mapInArrow(run, schema)


def dedup_texts(df: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The rows and columns of ``df``, repeated windows taken out of the text."""
    out = remove_repeats(df, window, text)
    kept, _, n_removed = out.columns[-3:]
    return out.withColumn(text, F.when(F.col(n_removed) > 0, F.col(kept)).otherwise(F.col(text))) \
        .select(*df.columns)
