"""Byte-level BPE over many pieces at once, in padded numpy matrices.

A text is cut into pieces by the pre-token pattern; each *distinct* piece is
encoded once per batch. Pieces are bucketed by length (powers of two) and laid
into a padded matrix of token ids, one piece per row. In every round each row
merges its leftmost pair of minimum rank; pair ranks come from an
open-addressing hash table held in numpy arrays, and only the two pairs beside
a merge are looked up again. Every live row loses exactly one column per round,
so the matrix is compacted by one column; rows without a mergeable pair leave.

A merged token's id is its rank. Pieces over ``LONG`` bytes (a run of one
letter over a whole page) would make the rounds quadratic; they follow the same
rule with a heap of (rank, position) over a linked list.

Decoding concatenates the token bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG = 4096
CELLS = 1 << 20            # matrix cells held at once
CACHE = 200_000            # distinct pieces remembered by a task
BATCH_CHARS = 1 << 21      # characters whose pieces are encoded together
NONE = np.int32(2**31 - 1)


def read_ranks(blob: bytes) -> dict[bytes, int]:
    """Rank file: one ``base64(token) rank`` line per token."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines()) if a}


class PairTable:
    """(left id, right id) -> merged id, as a hash table in numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(4 * len(left)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.vals = np.full(1 << bits, NONE, np.int32)
        keys = (left.astype(np.int64) << 32) | right
        slot, todo = self._home(keys), np.arange(len(keys))
        self.reach = 0
        while len(todo):
            self.reach += 1
            free = todo[self.keys[slot[todo]] == -1]
            _, first = np.unique(slot[free], return_index=True)  # one key may claim a slot
            won = free[first]
            self.keys[slot[won]], self.vals[slot[won]] = keys[won], merged[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids (NONE without a merge); negative ids are padding."""
        shape = left.shape
        keys = ((left.astype(np.int64) << 32) | right).ravel()
        out = np.full(keys.shape, NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._home(keys[todo])
        for _ in range(self.reach):
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self.vals[slot[hit]]
            on = ~hit & (there != -1)
            if not on.any():
                break
            todo, slot = todo[on], (slot[on] + 1) & self.mask
        return out.reshape(shape)


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for tok, r in ranks.items():
            self.tokens[r] = tok
        self.names = [str(i) for i in range(size)]
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.pairs = PairTable(*np.array(pairs, np.int32).reshape(-1, 3).T)
        self.by_pair = {(a, b): r for a, b, r in pairs}

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece, in the given order."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if len(p) > LONG:
                out[i] = self._merge_long(p)
            elif p:
                buckets.setdefault((len(p) - 1).bit_length(), []).append(i)
        for power, members in buckets.items():
            width = 1 << power
            step = max(1, CELLS // width)
            for at in range(0, len(members), step):
                block = members[at:at + step]
                self._merge_block([pieces[i] for i in block], block, out, width)
        return out

    def _merge_block(self, pieces, where, out, width: int) -> None:
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < lens[:, None]] = flat
        rank = self.pairs.get(ids[:, :-1], ids[:, 1:])
        where = np.asarray(where)
        while True:
            if rank.shape[1]:
                at = rank.argmin(1)
                best = rank[np.arange(len(at)), at]
                live = best != NONE
            else:
                live = np.zeros(len(ids), bool)
            if not live.all():
                done = ~live
                size = (ids[done] >= 0).sum(1)
                for i, row, n in zip(where[done].tolist(), ids[done], size.tolist()):
                    out[i] = row[:n].copy()
                if not live.any():
                    return
                ids, rank, where, at, best = ids[live], rank[live], where[live], at[live], best[live]
            n, w = ids.shape
            rows = np.arange(n)
            stay = np.ones((n, w), bool)
            stay[rows, at + 1] = False
            ids = ids[stay].reshape(n, w - 1)
            ids[rows, at] = best
            stay = np.ones((n, w - 1), bool)
            stay[rows, at] = False
            rank = rank[stay].reshape(n, w - 2)
            if w > 2:
                has = at > 0
                r, c = rows[has], at[has]
                rank[r, c - 1] = self.pairs.get(ids[r, c - 1], ids[r, c])
                has = at < w - 2
                r, c = rows[has], at[has]
                rank[r, c] = self.pairs.get(ids[r, c], ids[r, c + 1])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n, get = len(ids), self.by_pair.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k) for k in range(n - 1) if (r := get((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            if ids[k] is None or after[k] >= n or get((ids[k], ids[after[k]])) != r:
                continue  # one of the two has merged since
            gone = after[k]
            ids[k], ids[gone], after[k] = r, None, after[gone]
            if after[k] < n:
                before[after[k]] = k
                if (x := get((r, ids[after[k]]))) is not None:
                    heapq.heappush(heap, (x, k))
            if before[k] >= 0 and (x := get((ids[before[k]], r))) is not None:
                heapq.heappush(heap, (x, before[k]))
        return np.array([i for i in ids if i is not None], np.int32)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class TextEncoder:
    """Whole texts to ids, remembering the pieces seen last."""

    def __init__(self, bpe: ByteBPE, pattern: str):
        import regex

        self.bpe, self.find, self.known = bpe, regex.compile(pattern).findall, {}

    def __call__(self, texts: list[str]) -> Iterator[list[int]]:
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= BATCH_CHARS):
                chars += len(texts[end])
                end += 1
            cut = [self.find(t) for t in texts[at:end]]
            distinct = set().union(*cut)
            if len(self.known) > CACHE:
                self.known = {}
            new = list(distinct - self.known.keys())
            for piece, ids in zip(new, self.bpe.encode_pieces([p.encode() for p in new])):
                self.known[piece] = ids.tobytes()
            for pieces in cut:
                raw = b"".join(map(self.known.__getitem__, pieces))
                yield np.frombuffer(raw, np.int32).tolist()
            at = end


def encode_documents(df: DataFrame, rank_blob: bytes, pattern: str, key: str = "doc_id",
                     text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document: the key, ``ids`` (array<int>; left out with
    ``with_ids=False``), n_tokens, ids_sha256 (hex digest of the decimal ids
    joined by commas) and decoded_sha256 (of the bytes the ids decode to).

    The rank file (under 1 MB) is broadcast. Null and empty texts have no ids;
    rows with the same key or text are encoded one by one; nothing is grouped,
    so there is no shuffle. Other columns are ignored, whatever their names.
    """
    shared = df.sparkSession.sparkContext.broadcast(rank_blob)

    def run(batches):
        bpe = ByteBPE(read_ranks(shared.value))
        encode, sha = TextEncoder(bpe, pattern), hashlib.sha256
        for b in batches:
            ids_out, n, a, d = [], [], [], []
            for ids in encode([t or "" for t in b.column(1).to_pylist()]):
                n.append(len(ids))
                a.append(sha(",".join(map(bpe.names.__getitem__, ids)).encode()).hexdigest())
                d.append(sha(bpe.decode(ids)).hexdigest())
                if with_ids:
                    ids_out.append(np.array(ids, np.int32))
            cols = [b.column(0)] + ([pa.array(ids_out, pa.list_(pa.int32()))] if with_ids else [])
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                names=[key, *(["ids"] if with_ids else []), "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ("ids array<int>, " if with_ids else "") + \
        "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)
