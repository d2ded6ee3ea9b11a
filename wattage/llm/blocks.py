"""Token-id files in patched frame-of-reference blocks.

A file holds the ids of consecutive documents. Ids are cut into blocks of 128. A
block stores its minimum, a bit width and the differences from the minimum packed
at that width; the width holds the 90th percentile of the differences, and the few
larger ones are kept whole in an exception list (position, difference). An index
gives the byte where each block starts, so any block can be read on its own.

Layout (little endian): magic, counts (documents, ids, blocks, exceptions), document
table (id, null flag, length), block index (start byte, minimum, width, number of
exceptions), packed blocks, exception positions, exception differences.
"""

from __future__ import annotations

import numpy as np

MAGIC = b"PFORIDS1"
BLOCK = 128
PERCENTILE = 90
# Blocks packed or unpacked at once; bounds the memory beside the ids and the file.
BLOCKS_AT_ONCE = 4096


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """(128, n) values under 2**width -> (n, 2 * width) words."""
    out = np.zeros((2 * width, rows.shape[1]), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        out[word] |= rows[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= rows[i] >> np.uint64(64 - shift)
    return out.T


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """(n, 2 * width) words -> (n, 128) values."""
    source = np.ascontiguousarray(words.T)
    out = np.empty((BLOCK, words.shape[0]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        value = source[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (source[word + 1] << np.uint64(64 - shift))
        out[i] = value & mask
    return out.T


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits needed for each value (0 for 0)."""
    return np.where(values > 0, np.floor(np.log2(np.maximum(values, 1).astype(np.float64))) + 1, 0).astype(np.int64)


def _encode_blocks(grid: np.ndarray):
    """(minimum, width, exceptions, packed words, exception positions, exception differences) of rows of 128 ids."""
    low = grid.min(axis=1)
    delta = grid - low[:, None]
    kth = -(-BLOCK * PERCENTILE // 100) - 1
    width = _bits(np.partition(delta, kth, axis=1)[:, kth])
    over = delta > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    position = np.nonzero(over)[1].astype("u1")
    kept = delta[over].astype("<u4")
    delta[over] = 0
    ends = np.cumsum(width * 2)
    words = np.empty(int(ends[-1]), "<u8")
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        where = (ends[rows] - 2 * w)[:, None] + np.arange(2 * w)
        words[where] = _pack(delta[rows].T.astype(np.uint64, order="C"), int(w))
    return low, width, over.sum(axis=1), words, position, kept


def encode_file(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file from documents (id or None), their numbers of ids and all ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    index = np.zeros(blocks, [("start", "<u8"), ("low", "<u4"), ("width", "u1"), ("exceptions", "u1")])
    body, positions, kept = [], [], []
    for lo in range(0, blocks, BLOCKS_AT_ONCE):
        some = ids[lo * BLOCK : (lo + BLOCKS_AT_ONCE) * BLOCK].astype(np.uint32)
        if len(some) % BLOCK:  # the last block is filled with its last id
            some = np.pad(some, (0, -len(some) % BLOCK), mode="edge")
        rows = index[lo : lo + BLOCKS_AT_ONCE]
        rows["low"], rows["width"], rows["exceptions"], words, position, difference = _encode_blocks(some.reshape(-1, BLOCK))
        body.append(words.tobytes())
        positions.append(position.tobytes())
        kept.append(difference.tobytes())
    size = index["width"].astype(np.int64) * 16
    index["start"] = np.cumsum(size) - size
    docs = np.zeros(len(doc_ids), [("id", "<i8"), ("null", "u1"), ("length", "<u8")])
    docs["id"] = [0 if d is None else d for d in doc_ids]
    docs["null"] = [d is None for d in doc_ids]
    docs["length"] = lengths
    head = np.array([len(doc_ids), n, blocks, sum(map(len, positions))], "<u8")
    return b"".join((MAGIC, head.tobytes(), docs.tobytes(), index.tobytes(), *body, *positions, *kept))


def _head(data: bytes):
    if data[:8] != MAGIC:
        raise ValueError("not a token-id file")
    n_docs, n, blocks, exceptions = np.frombuffer(data, "<u8", 4, 8).tolist()
    doc_type = np.dtype([("id", "<i8"), ("null", "u1"), ("length", "<u8")])
    index_type = np.dtype([("start", "<u8"), ("low", "<u4"), ("width", "u1"), ("exceptions", "u1")])
    docs = np.frombuffer(data, doc_type, n_docs, 40)
    at = 40 + docs.nbytes
    index = np.frombuffer(data, index_type, blocks, at)
    return n, exceptions, docs, index, at + index.nbytes


def decode_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, null flags, lengths, all ids) of a file."""
    n, exceptions, docs, index, at = _head(data)
    width = index["width"].astype(np.int64)
    size = int((width * 16).sum())
    body = np.frombuffer(data, "<u8", size // 8, at).copy()  # aligned
    position = np.frombuffer(data, "u1", exceptions, at + size)
    kept = np.frombuffer(data, "<u4", exceptions, at + size + exceptions)
    out = np.zeros((len(index), BLOCK), np.uint32)
    for lo in range(0, len(index), BLOCKS_AT_ONCE):
        some = width[lo : lo + BLOCKS_AT_ONCE]
        for w in np.unique(some[some > 0]):
            rows = lo + np.flatnonzero(some == w)
            where = (index["start"][rows].astype(np.int64) // 8)[:, None] + np.arange(2 * w)
            out[rows] = _unpack(body[where], int(w))
    out[np.repeat(np.arange(len(index)), index["exceptions"]), position] = kept
    out += index["low"][:, None]
    return docs["id"], docs["null"].astype(bool), docs["length"].astype(np.int64), out.reshape(-1)[:n]


def read_block(data: bytes, block: int) -> np.ndarray:
    """The ids of one block, reached through the block index."""
    n, exceptions, _, index, at = _head(data)
    row = index[block]
    w = int(row["width"])
    size = int((index["width"].astype(np.int64) * 16).sum())
    out = np.zeros((1, BLOCK), np.uint32)
    if w:
        words = np.frombuffer(data, "<u8", 2 * w, at + int(row["start"])).reshape(1, 2 * w)
        out = _unpack(words, w).astype(np.uint32)
    first = int(index["exceptions"][:block].astype(np.int64).sum())
    k = int(row["exceptions"])
    position = np.frombuffer(data, "u1", k, at + size + first)
    out[0, position] = np.frombuffer(data, "<u4", k, at + size + exceptions + 4 * first)
    return (out[0] + row["low"])[: min(BLOCK, n - block * BLOCK)]
