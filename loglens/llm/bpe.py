"""Byte-level BPE encoding and decoding with length-bucketed numpy matrices.

A text is split by the rank file's pattern; each match is encoded separately.
The distinct matches of a batch are sorted into buckets by length and laid out
as padded matrices of token ids, one match per row.  In every round each row
merges its leftmost pair of minimum rank: the pair's rank is found by a hashed
lookup, the row's tail moves one cell to the left, only the two pairs beside the
merge are looked up anew, and finished rows leave the matrix.  A match of more
than ``LONG`` bytes takes the same merges from a heap, as its rounds would be
quadratic in its length.

Nulls encode as empty texts, and empty texts to no ids.  Ids outside the
vocabulary and null ids cannot be decoded and raise ``ValueError``.  Repeated
rows and other columns are left as they are, also very long texts, whose matches are
encoded in slices.  Of pairs of equal rank the leftmost is merged first.  An empty table
gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.tables import table
from loglens.llm.text import U, chunks, lists, mix

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = 256            # bytes of a match
BUCKETS = (4, 8, 12, 16, 24, 32, 64, 128, LONG)
CELLS = 1 << 18       # of a matrix
BATCH_BYTES = 2 << 20  # text bytes encoded at a time
KNOWN = 300_000       # pieces whose ids a task remembers; then it forgets those used once
NONE = np.int32(2**31 - 1)

MARKS = frozenset(",.;:!?")
FIRST = "\t"            # marks a piece that no space precedes; a piece never begins with a tab otherwise
#: White space other than a blank or line end (fixed values: the characters that Unicode or the pattern count as such).
OTHER_SPACE = "[\\x09\\x0b-\\x0d\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
ODD = f"{OTHER_SPACE}|  | \n| $"
BEFORE_WORD = re.compile(r"(?= [^ \n])")


def _cut(text: str) -> list[str]:
    """The pieces of a text without other white space, at every blank before a word."""
    first, *rest = BEFORE_WORD.split(text)
    return [FIRST + first, *(x[1:] for x in rest)]


def pieces(texts: pa.Array, whole: str | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Parts of texts that the pattern splits independently: (all parts, each text's first part, its number of parts).

    A space before a character that is not white space always begins a match:
    no match runs on over it, and white space before it is a match of its own.
    A part stands for a space and itself; one that begins with FIRST, for what
    follows that.  A text with other white space, or in which the regex ``whole``
    is found, is not cut.
    """
    marked = pc.binary_join_element_wise(pa.scalar(FIRST, pa.large_string()), texts, pa.scalar("", pa.large_string()))
    odd = pc.match_substring_regex(texts, ODD)
    if whole is not None:
        odd = pc.or_(odd, pc.match_substring_regex(texts, whole))
    strange = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    usual = np.flatnonzero(~odd.to_numpy(zero_copy_only=False))
    lists_ = pc.split_pattern(marked.take(pa.array(usual)), " ")
    n = np.zeros(len(texts), np.int64)
    n[usual] = np.diff(lists_.offsets.to_numpy())
    flat = lists_.flatten()
    if len(strange):
        some = texts.take(pa.array(strange))
        uncut = pc.match_substring_regex(some, OTHER_SPACE)
        if whole is not None:
            uncut = pc.or_(uncut, pc.match_substring_regex(some, whole))
        parts = [[FIRST + t] if u else _cut(t) for t, u in zip(some.to_pylist(), uncut.to_pylist())]
        n[strange] = [len(x) for x in parts]
        flat = pa.concat_arrays([flat, pa.array(chain.from_iterable(parts), flat.type)])
    first = np.empty(len(texts), np.int64)
    order = np.concatenate([usual, strange])
    first[order] = np.cumsum(n[order]) - n[order]
    return flat, first, n


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    """Token bytes and their ranks, which are the ids, of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def pair_table(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """Plain arrays for :class:`Merger`: an open-addressing table of all pairs of tokens that form a token."""
    left, right, rank = [], [], []
    for token, r in ranks.items():
        for cut in range(1, len(token)):
            a = ranks.get(token[:cut])
            b = ranks.get(token[cut:]) if a is not None else None
            if b is not None:
                left.append(a), right.append(b), rank.append(r)
    key = np.array(left, U) << U(32) | np.array(right, U)
    bits = max(4, int(len(key) * 4).bit_length())
    keys, values = np.full(1 << bits, U(2**64 - 1)), np.full(1 << bits, NONE, np.int32)
    at, left_over, probes = mix(key) & U((1 << bits) - 1), np.arange(len(key)), 0
    while len(left_over):  # every probe places one pair per free cell
        slot = (at[left_over] + U(probes)) & U((1 << bits) - 1)
        free = keys[slot] == U(2**64 - 1)
        _, first = np.unique(slot, return_index=True)
        take = first[free[first]]
        keys[slot[take]] = key[left_over[take]]
        values[slot[take]] = np.array(rank, np.int32)[left_over[take]]
        left_over = np.delete(left_over, take)
        probes += 1
    single = np.full(256, -1, np.int32)
    for token, r in ranks.items():
        if len(token) == 1:
            single[token[0]] = r
    if (single < 0).any():
        raise ValueError("the rank file lacks single bytes")
    return {"keys": keys, "values": values, "probes": np.array([probes]), "single": single}


class Merger:
    """Encodes matches by the arrays of :func:`pair_table`."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.keys, self.values, self.single = arrays["keys"], arrays["values"], arrays["single"]
        self.probes, self.mask = int(arrays["probes"][0]), U(len(arrays["keys"]) - 1)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NONE where it is no token or either id is missing (negative)."""
        key = a.astype(np.int64).view(U) << U(32) | (b.astype(np.int64).view(U) & U(2**32 - 1))
        at = mix(key) & self.mask
        out = np.where(self.keys[at] == key, self.values[at], NONE)
        todo = np.flatnonzero((self.keys[at] != key) & (self.values[at] != NONE))
        for p in range(1, self.probes):
            if not len(todo):
                break
            slot = (at[todo] + U(p)) & self.mask
            hit = self.keys[slot] == key[todo]
            out[todo[hit]] = self.values[slot[hit]]
            todo = todo[~hit & (self.values[slot] != NONE)]
        return np.where((a < 0) | (b < 0), NONE, out)

    def encode(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the ids of all matches, one after the other, and how many each has."""
        length = np.array([len(m) for m in matches])
        order, flat, sizes = [], [], []
        low = -1
        for top in BUCKETS:
            own = np.flatnonzero((length > low) & (length <= top))
            low = top
            step = max(1, CELLS // top)
            for i in range(0, len(own), step):
                part = own[i:i + step]
                ids = self._bucket([matches[k] for k in part.tolist()], length[part], top)
                order.append(part)
                flat.append(ids[ids >= 0])
                sizes.append((ids >= 0).sum(axis=1))
        for k in np.flatnonzero(length > LONG).tolist():
            ids = self._long(matches[k])
            order.append(np.array([k]))
            flat.append(ids)
            sizes.append(np.array([len(ids)]))
        if not order:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        back, size, ids = np.argsort(np.concatenate(order)), np.concatenate(sizes), np.concatenate(flat)
        return gather(ids, np.cumsum(size) - size, size, back), size[back]

    def _bucket(self, matches: list[bytes], size: np.ndarray, width: int) -> np.ndarray:
        cells = np.frombuffer(b"".join(m.ljust(width, b"\0") for m in matches), np.uint8).reshape(-1, width)
        cols = np.arange(width)
        ids = np.where(cols < size[:, None], self.single[cells], np.int32(-1))
        rank = np.full(ids.shape, NONE, np.int32)
        rank[:, :-1] = self.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        final, row, size = np.full(ids.shape, -1, np.int32), np.arange(len(ids)), size.copy()
        while len(row):
            at = rank.argmin(axis=1)
            here = np.arange(len(row))
            best = rank[here, at]
            done = best == NONE
            if done.any():
                final[row[done], :ids.shape[1]] = ids[done]
                go = ~done
                row, size, ids, rank, at, best = row[go], size[go] - 1, ids[go], rank[go], at[go], best[go]
                if not len(row):
                    break
                wide = int(size.max()) + 1
                ids, rank, here = ids[:, :wide], rank[:, :wide], np.arange(len(row))
            else:
                size = size - 1
            # the merged cell's tail moves one to the left
            tail = np.arange(ids.shape[1])[None, :] > at[:, None]
            ids = np.where(tail, np.pad(ids[:, 1:], ((0, 0), (0, 1)), constant_values=-1), ids)
            rank = np.where(tail, np.pad(rank[:, 1:], ((0, 0), (0, 1)), constant_values=NONE), rank)
            ids[here, at] = best
            after = np.minimum(at + 1, ids.shape[1] - 1)
            rank[here, at] = self.ranks(best, np.where(at + 1 < ids.shape[1], ids[here, after], np.int32(-1)))
            inner = at > 0
            before = at[inner] - 1
            rank[here[inner], before] = self.ranks(ids[here[inner], before], best[inner])
        return final

    def _long(self, match: bytes) -> np.ndarray:
        ids = self.single[np.frombuffer(match, np.uint8)]
        rank = self.ranks(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(match)
        heap = [(int(r), i) for i, r in enumerate(rank.tolist()) if r != NONE]
        heapq.heapify(heap)
        now = rank.tolist() + [int(NONE)]
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))

        def renew(i):
            j = nxt[i]
            now[i] = int(self.ranks(np.array([ids[i]], np.int32), np.array([ids[j]], np.int32))[0]) if j < n else int(NONE)
            if now[i] != NONE:
                heapq.heappush(heap, (now[i], i))

        while heap:
            r, i = heapq.heappop(heap)
            if now[i] != r or ids[i] < 0:
                continue
            j = nxt[i]
            ids[i], ids[j], now[j] = r, -1, int(NONE)
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            renew(i)
            if prev[i] >= 0:
                renew(prev[i])
        return np.array([x for x in ids if x >= 0], np.int32)


def gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs ``flat[first[i]:first[i] + size[i]]`` for i in ``at``, one after the other."""
    n = size[at]
    end = np.cumsum(n)
    total = int(end[-1]) if len(end) else 0
    return flat[np.arange(total) + np.repeat(first[at] - (end - n), n)]


def names_of(parts: pa.Array) -> list[str]:
    """The texts that parts of :func:`pieces` stand for."""
    return [p[1:] if p.startswith(FIRST) else " " + p for p in parts.to_numpy(zero_copy_only=False)]


class Memory:
    """Ids of texts, where ``learn`` encodes each distinct piece once: texts -> (ids, offsets).

    It lives as long as its task and remembers KNOWN pieces at most, besides those of one call.
    """

    def __init__(self, learn, whole: str | None = None):
        self.learn, self.whole = learn, whole
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat, self.first, self.size = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.uses = np.empty(0, np.int64)

    def _forget(self) -> None:
        """Keep the pieces that were used again, unless those are too many as well."""
        again = np.flatnonzero(self.uses > 1)
        ids = gather(self.flat, self.first, self.size, again)
        if len(again) > KNOWN // 2 or len(ids) > 4 * KNOWN:
            return self._clear()
        names = list(self.slot)
        self.slot = {names[i]: k for k, i in enumerate(again.tolist())}
        self.size = self.size[again]
        self.flat, self.first, self.uses = ids, np.cumsum(self.size) - self.size, np.zeros(len(again), np.int64)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts) of an Arrow column or a list; nulls are empty."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        flat, first, n = pieces(column.cast(pa.large_string()).fill_null(""), self.whole)
        if len(self.slot) > KNOWN or len(self.flat) > 8 * KNOWN:
            self._forget()
        coded = flat.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False)
        at = np.fromiter(map(self.slot.get, names, repeat(-1)), np.int64, len(names))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new = coded.dictionary.take(pa.array(unknown))
            ids, size = self.learn(new)
            at[unknown] = np.arange(len(self.slot), len(self.slot) + len(new))
            self.slot.update(zip(names[unknown], at[unknown].tolist()))
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, ids])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        which = coded.indices.to_numpy()
        self.uses[at] += np.bincount(which, minlength=len(names))
        # in the order of the texts
        where = gather(at[which], first, n, np.arange(len(n)))
        ids = gather(self.flat, self.first, self.size, where)
        ends = np.concatenate([[0], np.cumsum(self.size[where])])
        return ids, ends[np.concatenate([[0], np.cumsum(n)])]


def by_merging(merger: Merger, pattern: str):
    """A ``learn`` for :class:`Memory`: split by the pattern, encode the distinct matches."""
    split = regex.compile(pattern).findall

    def learn(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        new = names_of(parts)
        if pattern == public_tokenizers.PATTERN:
            # Letters after a space are one match as they are, and letters and a mark two.
            parts = [(p,) if p[1:].isalpha() and p[0] == " " else (p[:-1], p[-1]) if p[-1:] in MARKS and p[1:-1].isalpha() and p[0] == " " else split(p) for p in new]
        else:
            parts = [split(p) for p in new]
        flat = list(chain.from_iterable(parts))
        slot = {m: k for k, m in enumerate(dict.fromkeys(flat))}
        ids, size = merger.encode([m.encode() for m in slot])
        at = np.fromiter(map(slot.__getitem__, flat), np.int64, len(flat))
        ends = np.concatenate([[0], np.cumsum(size[at])])
        cut = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return gather(ids, np.cumsum(size) - size, size, at), np.diff(ends[cut])

    return learn


def encode(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """All rows and columns with the text's ids as ``out_col array<int>`` (which replaces a column of that name)."""
    tables = docs.sparkSession.sparkContext.broadcast(pair_table(load_ranks(path)))
    keep = [c for c in docs.columns if c != out_col]
    types = dict(docs.dtypes)

    def run(batches):
        encoder = Memory(by_merging(Merger(tables.value), pattern))
        for batch in chunks(batches, text_col, BATCH_BYTES):
            ids, off = encoder.encode(batch.column(text_col))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists(ids, off, pa.int32())], [*keep, out_col])

    return docs.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"`{out_col}` array<int>"]))


def _tokens(ranks: dict[bytes, int]) -> list[bytes | None]:
    out: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, r in ranks.items():
        out[r] = token
    return out


def _joined(tokens: list, ids: list) -> bytes:
    try:
        if ids and min(ids) < 0:
            raise IndexError
        return b"".join(map(tokens.__getitem__, ids))
    except (IndexError, TypeError) as exc:
        raise ValueError("an id is not in the vocabulary") from exc


def decode(docs: DataFrame, path: str = RANKS, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All rows and columns with the bytes of the ids as ``out_col binary``; a null list has no bytes."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(_tokens(load_ranks(path)))
    keep = [c for c in docs.columns if c != out_col]
    types = dict(docs.dtypes)

    def run(batches):
        tokens = vocabulary.value
        for batch in batches:
            out = pa.array((_joined(tokens, x.as_py() or []) for x in batch.column(ids_col)), pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), out], [*keep, out_col])

    return docs.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), f"`{out_col}` binary"]))


def digests(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids): the digests of what is decoded again."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(_tokens(load_ranks(path)))

    def run(batches):
        tokens = vocabulary.value
        numbers = [b"%d" % k for k in range(len(tokens))]
        for batch in batches:
            n, a, b = [], [], []
            for x in batch.column("ids"):
                ids = x.values.to_pylist() if x.is_valid else []
                n.append(len(ids))
                a.append(hashlib.sha256(b" ".join(map(numbers.__getitem__, ids))).hexdigest())
                b.append(hashlib.sha256(_joined(tokens, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def q_op8(spark, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "ids"))
