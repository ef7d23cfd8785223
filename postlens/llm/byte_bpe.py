"""Byte-level BPE encoding and decoding by a rank queue with a hierarchical bitmap.

A bucket for each merge rank holds the list positions whose pair has that rank. A
bitmap over the ranks in words of 256 bits, with a bitmap of its non-zero words
above it, yields the lowest rank in use by find-first-set at both levels, so the next
merge is found as fast in a piece of ten million bytes as in one of ten. Entries of
pairs that are gone stay in their buckets and are skipped.
"""

from __future__ import annotations

import base64
import hashlib
import re
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.names import quoted
from postlens.llm.common import caches, map_texts

CACHE_BYTES = 256 << 20  # of a worker: nearly all for words, an eighth for other pieces
ENTRY_BYTES = 220  # of a cached word or piece, beside its characters and ids
SPACES = re.compile(r"\s\s")
_encoders: dict[str, ByteBpe] = {}
caches[__name__] = _encoders


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class _Cache(dict):
    """Ids by key, made when first asked for.

    When half of its bytes are in use they become the old half, and the former old half goes; a key that
    is found there moves over. So what is asked for often stays, and memory is bounded.
    """

    def __init__(self, make, limit: int):
        self.make, self.limit, self.used, self.old = make, limit // 2, 0, {}

    def __missing__(self, key):
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        self.used += ENTRY_BYTES + len(key) + 8 * len(ids)
        if self.used >= self.limit:
            self.old, self.used = dict(self), 0
            self.clear()
        self[key] = ids
        return ids


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_bytes: int = CACHE_BYTES):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.bitmap = [0] * ((max(ranks.values()) >> 8) + 1)  # empty between merges
        self.pieces = _Cache(lambda piece: self.merge(piece.encode()), cache_bytes // 8)
        self.words = _Cache(self._spaced, cache_bytes - cache_bytes // 8)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece, by merges in order of rank."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        rank_of, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # of the part that begins at a position; the next begins there
        before = list(range(-1, n))
        pair: list[int | None] = [rank_of(piece[i : i + 2]) for i in range(n - 1)]
        pair.append(None)
        bitmap, used = self.bitmap, 0
        buckets: dict[int | None, list[int]] = {}  # each a heap, leftmost position first
        for i, rank in enumerate(pair):
            if rank in buckets:
                buckets[rank].append(i)
            elif rank is not None:
                buckets[rank] = [i]
                used |= 1 << (rank >> 8)
                bitmap[rank >> 8] |= 1 << (rank & 255)
        while used:
            word = (used & -used).bit_length() - 1
            bits = bitmap[word]
            rank = word << 8 | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                bitmap[word] = bits = bits & (bits - 1)
                if not bits:
                    used &= used - 1
            if pair[i] != rank:
                continue  # stale: the pair was merged or has grown
            j = end[i]
            k = end[i] = end[j]
            pair[j] = pair[i] = None
            before[k] = i
            if k < n:
                pair[i] = rank_of(piece[i : end[k]])
            h = before[i]
            if h >= 0:
                pair[h] = rank_of(piece[h:k])
            for at in (i, h):
                rank = pair[at] if at >= 0 else None
                if rank in buckets:
                    heappush(buckets[rank], at)
                elif rank is not None:
                    buckets[rank] = [at]
                    used |= 1 << (rank >> 8)
                    bitmap[rank >> 8] |= 1 << (rank & 255)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(ids)

    def _spaced(self, word: str) -> tuple[int, ...]:
        """The ids of a word after a space. A word that it begins with is found, or kept, as a word of its own."""
        found = self.pattern.findall(" " + word)
        if len(found) == 1:
            return self.merge(found[0].encode())
        stem = found[0][1:]
        first = self.words[stem] if stem else self.pieces[found[0]]
        return first + tuple(chain.from_iterable(map(self.pieces.__getitem__, found[1:])))

    def encode_any(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.pattern.findall(text))))

    def encode(self, text: str) -> list[int]:
        """The ids of a text.

        No piece crosses a lone space between other characters, so a text without
        adjacent white space is encoded word by word, through the cache.
        """
        if not text or SPACES.search(text):
            return self.encode_any(text)
        first, *words = text.split(" ")
        ids = self.encode_any(first)
        ids.extend(chain.from_iterable(map(self.words.__getitem__, words)))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _encoder(ranks: dict[bytes, int], pattern: str, name: str, cache_bytes: int = CACHE_BYTES) -> ByteBpe:
    """One encoder, with its cache, for all tasks of a worker."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = ByteBpe(ranks, pattern, cache_bytes)
    return _encoders[name]


def encode_texts(
    rows: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", cache_bytes: int = CACHE_BYTES
) -> DataFrame:
    """Replace the text by its token ids (array of int); a NULL text has none.

    The rank file is read on the driver and broadcast; it has the size of a
    vocabulary, whatever the size of the data.
    """
    work = _over_texts(rows, ranks_path, pattern, cache_bytes)

    def make():
        bpe = work()
        return lambda texts: [pa.array([bpe.encode(t or "") for t in texts], pa.list_(pa.int32()))]

    return map_texts(rows, text, make, f"`{ids}` array<int>")


def byte_bpe_round_trip(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    cache_bytes: int = CACHE_BYTES,
) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, and with ``with_ids``
    the ``ids``.

    The digests are of the decimal ids joined by spaces and of the bytes that the
    ids decode to. ``cache_bytes`` bounds what each worker keeps of words it has encoded; less of it takes
    more time. NULL and empty texts have no token. Repeated rows come back as
    often as they occur; an empty table gives an empty result; other columns are
    ignored.
    """
    work = _over_texts(docs, ranks_path, pattern, cache_bytes)

    def make():
        bpe = work()
        decimal = {i: str(i) for i in bpe.tokens}

        def digests(texts):
            counts, written, decoded, kept = [], [], [], []
            for t in texts:
                ids = bpe.encode(t or "")
                if with_ids:
                    kept.append(np.array(ids, np.int32))
                counts.append(len(ids))
                line = " ".join(map(decimal.__getitem__, ids))
                written.append(hashlib.sha256(line.encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            columns = [pa.array(counts, pa.int64()), pa.array(written), pa.array(decoded)]
            return [*columns, pa.array(kept, pa.list_(pa.int32()))] if with_ids else columns

        return digests

    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return map_texts(docs.select(F.col(quoted(id)), F.col(quoted(text))), text, make, added)


def _over_texts(rows: DataFrame, ranks_path: str, pattern: str, cache_bytes: int):
    ranks = read_ranks(ranks_path)
    name = hashlib.sha256(repr((sorted(ranks.items()), pattern, cache_bytes)).encode()).hexdigest()
    shared = rows.sparkSession.sparkContext.broadcast(ranks)
    return lambda: _encoder(shared.value, pattern, name, cache_bytes)
