"""Documents gathered into chunks of a few megabytes, and hashing of their words.

Operators that ask the whole corpus about every word or window of a document
would shuffle one row per word. Instead documents are gathered, in reading
order, into chunk rows (a chunk id and the rows as a compressed Arrow block),
written once to the shared folder so that ids stay valid when tasks are
retried. A chunk sends its *distinct* keys in sorted arrays, one row per hash
slice, and gets its answers back in the same order. A key that fills a third of
the corpus is thereby one entry per chunk, whatever its frequency.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from featuremart.llm.common import ASCII_LOWER, written

CHUNK_BYTES = 4 << 20
SEGMENT = 1 << 20
_M = 0xBF58476D1CE4E5B9
_INV = pow(_M, -1, 1 << 64)


def chunked(df: DataFrame, tag: str, text: str = "text",
            measure: Callable[[list], int] | None = None) -> DataFrame:
    """Written table (chunk long, size long, block binary); ``size`` is the
    sum of ``measure`` over the chunk's texts. A chunk ends when its texts
    reach CHUNK_BYTES; a longer text is a chunk of its own."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        base, n = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []
        weight = 0

        def flush():
            nonlocal held, weight, n
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                for b in held:
                    w.write_batch(b)
            size = sum(measure(b.column(at).to_pylist()) for b in held) if measure else 0
            n, held, weight = n + 1, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([base + n], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "size", "block"])

        for b in batches:
            lens = pc.fill_null(pc.binary_length(b.column(at)), 0).to_numpy(zero_copy_only=False)
            start = 0
            for i, x in enumerate(lens.tolist()):
                weight += x + 16
                if weight >= CHUNK_BYTES:
                    held.append(b.slice(start, i + 1 - start))
                    start = i + 1
                    yield flush()
            if start < b.num_rows:
                held.append(b.slice(start))
        if held:
            yield flush()

    rows = df.mapInArrow(run, "chunk long, size long, block binary")
    return written(df.sparkSession, rows, tag)


def each_row(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch one by one (a batch may hold many blocks)."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def rows_of(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int):
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_M, _INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p)
    return _POWERS[0][:n], _POWERS[1][:n]


# A random 64-bit number per byte value (from a fixed seed).
_LETTERS = np.random.default_rng(20_240_601).integers(0, 2**64, 256, dtype=np.uint64)
_LOWER_LETTERS = _LETTERS[np.frombuffer(ASCII_LOWER, np.uint8)]
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


def _joined(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, a line break after each, and where each ends."""
    raws = [t.encode() if t else b"" for t in texts]
    return np.frombuffer(b"\n".join([*raws, b""]), np.uint8), \
        np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)


def _segments(buf: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of about SEGMENT bytes that end in white space."""
    at = 0
    while at < len(buf):
        end = min(at + SEGMENT, len(buf)) - 1
        while not (space := _SPACE[buf[end:end + SEGMENT]]).any():  # a word as long as a segment
            end += SEGMENT
        end += int(space.argmax()) + 1
        yield at, buf[at:end]
        at = end


def _word_edges(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turn = np.diff((~_SPACE[part]).view(np.int8), prepend=np.int8(0))
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def word_counts(texts: list) -> np.ndarray:
    """Words of each text."""
    buf, ends = _joined(texts)
    starts = np.concatenate([np.zeros(0, np.int64), *(at + _word_edges(part)[0] for at, part in _segments(buf))])
    return np.diff(np.searchsorted(starts, ends), prepend=0)


def word_hashes(texts: list, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and the words of
    each text. With ``lower``, A-Z count as a-z.

    No word becomes a Python object: a word's hash is a polynomial over its
    bytes' random numbers, read off prefix sums modulo 2**64.
    """
    buf, ends = _joined(texts)
    table = _LOWER_LETTERS if lower else _LETTERS
    hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, part in _segments(buf):
        first, last = _word_edges(part)
        up, down = _powers(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(table[part] * up, out=sums[1:])
        hashes.append(mix((sums[last] - sums[first]) * down[first]))
        starts.append(at + first)
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(starts), ends), prepend=0)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes: a polynomial over
    integers mod 2**64, by differences of prefix sums."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(h) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[:len(h)])])
    return mix((sums[size:] - sums[:n]) * down[:n])


def pack_bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def unpack_bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def bit_width(n: int) -> int:
    """Bits that number n things."""
    return max(0, int(n - 1).bit_length())


def slices_of(keys: np.ndarray, shift: int):
    """(slice, from, to) of the non-empty slices of sorted keys."""
    part = (keys >> np.uint64(shift)).astype(np.int64)
    edges = np.flatnonzero(np.diff(part)) + 1
    lo, hi = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
    return zip(part[lo].tolist(), lo.tolist(), hi.tolist()) if len(keys) else ()


def record_batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
