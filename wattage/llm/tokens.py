"""Whole-text token encoding with a public tokenizer file.

A byte-level BPE never merges across a word boundary, and a boundary always lies
before a run of white space that follows a visible character. So a text can be
cut there, every distinct chunk encoded once by the ``tokenizers`` library, and
the ids of the chunks concatenated: the ids are those of the whole text. Texts
with white space outside ASCII (whose runs could straddle a cut), and texts that
quote an added token such as an end marker (which is one id there), are encoded
whole. Chunks are counted out with Arrow's dictionary encoding, so Python touches
each distinct chunk of a batch once, not each word.

A null text is an empty text. The cache of chunk ids is bounded; it holds no
result, only work already done.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Entries kept per worker process, in two generations: about 200 MB for words of ordinary length.
CACHE_ENTRIES = 1_000_000
# Characters encoded at once; bounds the memory of a batch however long its texts are.
SLICE_CHARS = 4_000_000

# White space outside ASCII, and the four separators Python and Arrow class differently.
_WIDE_SPACE = "[\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_MIXED_RUN = "[\\x20][\\x20\\t-\\r]|[\\t-\\r][\\x20]"
_CHUNKS = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+").findall


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer file on this machine (a parameter of every operator)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_decoder() -> dict[str, int]:
    """The byte behind each printable stand-in of a byte-level vocabulary: printable Latin-1 stands
    for itself, the other byte values take the code points from 256 on in ascending order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodes batches of texts to (ids per text, all ids)."""

    def __init__(self, path: str | None = None) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizer())
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.joins = not any(" " in t for t in self.added)  # else chunks put together could form one
        stand_in = _byte_decoder()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.token_bytes[i] = len(token) if all(c in stand_in for c in token) else len(token.encode())
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, chunks: list[str]) -> None:
        """Put the ids of unseen chunks into the cache, encoding those that one space starts as one text."""
        young, white = self.young, " \t\n\x0b\x0c\r"
        joined, odd = [], []
        for c in chunks:
            (joined if self.joins and len(c) > 1 and c[0] == " " and c[1] not in white and c[-1] not in white else odd).append(c)
        for c, e in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False) if odd else ()):
            young[c] = np.array(e.ids, np.uint32).tobytes()
        for lo in range(0, len(joined), 4096):
            some = joined[lo : lo + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            sizes = pc.binary_length(pa.array(some, pa.string())).to_numpy()
            ends = np.searchsorted(np.cumsum(self.token_bytes[ids]), np.cumsum(sizes, dtype=np.int64)) + 1
            raw, at = ids.tobytes(), 0
            for c, end in zip(some, (ends * 4).tolist()):
                young[c] = raw[at:end]
                at = end

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of distinct chunks, encoding the unseen ones."""
        found = list(map(self.young.get, words))
        missing = [i for i, f in enumerate(found) if f is None]
        if not missing:
            return found
        get_old, new = self.old.get, []
        for i in missing:
            f = found[i] = get_old(words[i])
            if f is None:
                new.append(words[i])
        if len(self.young) + len(missing) > CACHE_ENTRIES // 2:
            self.old, self.young = self.young, {}
        # What is still in use moves from the old generation to the young one, so that it stays known.
        young = self.young
        young.update((words[i], found[i]) for i in missing if found[i] is not None)
        if new:
            self._learn(new)
            found = [young[w] if f is None else f for w, f in zip(words, found)]
        return found

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        return self.encode(texts, ids=False)[0]

    def _chunked(self, chunks: pa.Array, offsets: np.ndarray, ids: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids per text and (with ``ids``) all ids, from the chunks of every text (chunk slices by ``offsets``)."""
        coded = chunks.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        found = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        n = size[code]
        end = np.cumsum(n)
        counts = np.diff(np.concatenate([[0], end])[offsets])
        if not ids:
            return counts, np.zeros(0, np.uint32)
        begin = np.cumsum(size) - size
        values = np.frombuffer(b"".join(found), np.uint32)
        total = int(end[-1]) if len(end) else 0
        index = np.int32 if max(total, len(values)) < 2**31 else np.int64
        take = np.arange(total, dtype=index)
        take += np.repeat((begin[code] - (end - n)).astype(index), n)
        return counts, values[take]

    def encode(self, texts: pa.Array, ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, the ids of all texts one after another; none without ``ids``)."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        counts, parts, lo = [], [], 0
        upto = np.cumsum(sizes)
        while lo < len(texts):
            base = upto[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(upto, base + SLICE_CHARS, "right")))
            n, v = self._encode_slice(texts.slice(lo, hi - lo), ids)
            counts.append(n)
            parts.append(v)
            lo = hi
            pa.default_memory_pool().release_unused()  # else freed chunk arrays stay with the worker
        if not counts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        return np.concatenate(counts), np.concatenate(parts)

    def _encode_slice(self, texts: pa.Array, ids: bool) -> tuple[np.ndarray, np.ndarray]:
        wide = pc.match_substring_regex(texts, _WIDE_SPACE).to_numpy(zero_copy_only=False)
        for token in self.added:
            wide = wide | pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        mixed = pc.match_substring_regex(texts, _MIXED_RUN).to_numpy(zero_copy_only=False)
        kinds = np.where(wide, 2, np.where(mixed, 1, 0))
        if not kinds.any():
            return self._plain(texts, ids)
        strings = texts.to_pylist()
        counts = np.zeros(len(strings), np.int64)
        pieces: list = [None] * len(strings)
        for kind in (0, 1, 2):
            rows = np.flatnonzero(kinds == kind)
            if not len(rows):
                continue
            some = [strings[i] for i in rows]
            if kind == 2:
                parts = [self._whole(s) for s in some]
                n = np.array([len(p) for p in parts])
            else:
                n, v = self._plain(pa.array(some, pa.large_string()), ids) if kind == 0 else self._runs(some, ids)
                parts = np.split(v, np.cumsum(n)[:-1]) if ids else []
            counts[rows] = n
            for i, p in zip(rows, parts):
                pieces[i] = p
        return counts, np.concatenate(pieces) if ids else np.zeros(0, np.uint32)

    def _plain(self, texts: pa.Array, ids: bool) -> tuple[np.ndarray, np.ndarray]:
        """Texts whose spaces all stand alone: cut at each space, which goes with what follows."""
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        blank = pa.scalar("", pa.large_string())
        spaced = pc.binary_join_element_wise(blank, flat, pa.scalar(" ", pa.large_string()))
        first = np.zeros(len(flat), bool)
        first[offsets[:-1]] = True
        chunks = pc.if_else(pa.array(first), flat, spaced)
        return self._chunked(chunks, offsets, ids)

    def _runs(self, strings: list[str], ids: bool) -> tuple[np.ndarray, np.ndarray]:
        lists = [_CHUNKS(s) for s in strings]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        return self._chunked(pa.array([c for x in lists for c in x], pa.large_string()), offsets, ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The encoder of this worker process (made once, reused by later tasks)."""
    key = path or ""
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path)
    return _ENCODERS[key]
