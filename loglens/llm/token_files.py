"""Token ids in bit-plane files.

A file holds the ids of many documents, one after the other, cut into blocks of
``block`` ids.  A block's ids are transposed into planes (plane k holds bit k,
or byte k, of every id; only the planes that the block needs are kept) and each
plane is compressed with zstandard.  Layout, integers little-endian:

    magic ``PLANES1\\n``
    the planes of all blocks, one after the other
    the chunk index, compressed with zstandard: per block its number of ids and
      planes, then per plane its offset and length; then per document its id,
      whether it has one, and its number of ids
    footer: offset and length of the index, bits per plane, number of blocks
      and of documents (five uint64), and the magic again

A dataset is a folder of such files plus a manifest (a Spark table: file number,
path, number of documents and ids).  Documents are dealt to files by ranges of
their id, so the files in order hold them in ascending order (nulls first, equal
ids by a hash of their text).  A task names its file by its attempt, and the
manifest, which Spark commits, lists the files of the attempts that counted: a
lost or repeated task does no harm.

Null and empty texts have only the end id.  Repeated rows are written repeatedly.
An empty table gives a dataset without documents.  A very long text is encoded and written
as one document; columns other than the two named have no influence, whatever their names.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from operator import attrgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglens.llm.bpe import BATCH_BYTES, FIRST, Memory, gather, names_of
from loglens.llm.tables import Staged, table
from loglens.llm.text import chunks
from loglens.session import staging_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MAGIC = b"PLANES1\n"
BLOCK = 1 << 16
END_ID = 0


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The planes of a block of ids, of 1 or 8 bits each, up to the highest that is not all zero."""
    top = int(ids.max(initial=0)).bit_length()
    octets = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :-(-top // 8)]
    if bits == 8:
        return [octets[:, k].tobytes() for k in range(octets.shape[1])]
    flags = np.unpackbits(octets, axis=1, bitorder="little")[:, :top]
    return [x.tobytes() for x in np.packbits(np.ascontiguousarray(flags.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    """The inverse of :func:`to_planes` for ``n`` ids."""
    if bits == 8:
        octets = np.zeros((n, 4), np.uint8)
        for k, plane in enumerate(planes):
            octets[:, k] = np.frombuffer(plane, np.uint8)
        return octets.view("<u4").ravel()
    octets = np.zeros((n, 4), np.uint8)
    flags = np.zeros((-(-len(planes) // 8) * 8, n), np.uint8)
    for k, plane in enumerate(planes):
        flags[k] = np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little")
    octets[:, :len(flags) // 8] = np.packbits(np.ascontiguousarray(flags.T), axis=1, bitorder="little")
    return octets.view("<u4").ravel()


class Writer:
    """Writes one file to a binary stream, block by block."""

    def __init__(self, out, bits: int = 1, block: int = BLOCK, level: int = 1):
        self.out, self.bits, self.block = out, bits, block
        self.zip = zstandard.ZstdCompressor(level=level)
        self.waiting, self.n_waiting = [], 0
        self.blocks, self.documents = [], []
        self.at = out.write(MAGIC)

    def add(self, ids: np.ndarray, doc_ids: list, sizes: np.ndarray) -> None:
        """Append documents: their ids, laid end to end, their names and numbers of ids."""
        self.documents.append((np.array([0 if x is None else x for x in doc_ids], "<i8"), np.array([x is not None for x in doc_ids], np.uint8),
                               np.asarray(sizes, "<i8")))
        self.waiting.append(np.asarray(ids, "<u4"))
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // self.block * self.block
            for i in range(0, whole, self.block):
                self._flush(flat[i:i + self.block])
            self.waiting, self.n_waiting = [flat[whole:]], len(flat) - whole

    def _flush(self, ids: np.ndarray) -> None:
        entry = [len(ids)]
        planes = to_planes(ids, self.bits)
        entry.append(len(planes))
        for plane in planes:
            small = self.zip.compress(plane)
            entry += [self.at, len(small)]
            self.at += self.out.write(small)
        self.blocks.append(entry)

    def close(self) -> tuple[int, int]:
        """Write what waits, the index and the footer; (documents, ids)."""
        last = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        if len(last):
            self._flush(last)
        docs = [np.concatenate(x) for x in zip(*self.documents)] if self.documents else [np.empty(0, "<i8"), np.empty(0, np.uint8), np.empty(0, "<i8")]
        index = self.zip.compress(np.array([v for e in self.blocks for v in e], "<u8").tobytes() + b"".join(x.tobytes() for x in docs))
        self.out.write(index)
        self.out.write(np.array([self.at, len(index), self.bits, len(self.blocks), len(docs[0])], "<u8").tobytes() + MAGIC)
        return len(docs[0]), int(docs[2].sum())


class Reader:
    """Random access to one file, a seekable binary stream."""

    def __init__(self, source):
        self.source, self.unzip = source, zstandard.ZstdDecompressor()
        size = source.seek(0, os.SEEK_END)
        tail = self._bytes(size - 48, 48)
        if tail[40:] != MAGIC:
            raise ValueError("not a bit-plane file")
        at, length, self.bits, blocks, docs = np.frombuffer(tail[:40], "<u8").tolist()
        index = self.unzip.decompress(self._bytes(at, length))
        pos, self.blocks = 0, []
        for _ in range(blocks):
            n, planes = np.frombuffer(index, "<u8", 2, pos).tolist()
            self.blocks.append((n, np.frombuffer(index, "<u8", 2 * planes, pos + 16).reshape(-1, 2).tolist()))
            pos += 16 + 16 * planes
        self.doc_ids = np.frombuffer(index, "<i8", docs, pos)
        self.named = np.frombuffer(index, np.uint8, docs, pos + 8 * docs)
        self.sizes = np.frombuffer(index, "<i8", docs, pos + 9 * docs)

    def _bytes(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def block(self, k: int) -> np.ndarray:
        n, where = self.blocks[k]
        return from_planes([self.unzip.decompress(self._bytes(*x)) for x in where], n, self.bits)

    def documents(self):
        """(doc_id, ids) of each document in order, with one block and one document in memory."""
        left, k = np.empty(0, "<u4"), 0
        for doc_id, named, size in zip(self.doc_ids.tolist(), self.named.tolist(), self.sizes.tolist()):
            parts, have = [left], len(left)
            while have < size:
                parts.append(self.block(k))
                have += len(parts[-1])
                k += 1
            flat = np.concatenate(parts) if len(parts) > 1 else left
            left = flat[size:]
            yield (doc_id if named else None), flat[:size]


#: Letters whose class no Unicode version changes, perhaps ASCII marks, and the same again on a next line: each is one pre-token for sure.
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ɏ]+", r"[!-/:-@\[-`{-~]*"
PLAIN = f"^(?P<word>{FIRST}?{_LETTERS})(?P<marks>{_MARKS})(?:(?P<line>\n)(?P<next>{_LETTERS})(?P<end>{_MARKS}))?$"
IN_PLAIN = f" ?(?:{_LETTERS})?{_MARKS}(?:\n(?:{_LETTERS})?{_MARKS})?"
AT_ONCE = 1000  # other pieces per call: what the library returns takes memory


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


@functools.lru_cache(1)
def _by_library(json: str, cut: bool):
    """(learn, whole) for :class:`Memory`: the tokenizers library encodes every piece.

    Pieces that are surely a few pre-tokens go straight to the library's model, each
    distinct pre-token of a call once; the others through its whole encoding.  A Python worker
    loads the vocabulary once.
    """
    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(json)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    whole = "|".join(map(re.escape, added)) if added else None
    # A plain piece can hold an added token only if that has the form of a part of one.
    inside = whole if any(re.fullmatch(IN_PLAIN, x) for x in added) else None
    tokenize, letters, id_of = tokenizer.model.tokenize, _byte_letters(), attrgetter("id")

    def learn(new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.extract_regex(new, PLAIN) if cut else pa.nulls(len(new), pa.struct([]))
        if inside:
            plain = pc.if_else(pc.match_substring_regex(pa.array(names_of(new), new.type), inside), None, plain)
        hard = np.flatnonzero(plain.is_null().to_numpy(zero_copy_only=False))
        easy = np.flatnonzero(plain.is_valid().to_numpy(zero_copy_only=False))
        # A table of distinct parts, and for each piece its up to five parts in it; part 0 is empty.
        flat, ends = [], [0]
        parts = np.zeros((len(new), 5), np.int64)
        if len(easy):
            word, *others = plain.filter(plain.is_valid()).flatten()
            first = pc.starts_with(word, FIRST)
            word = pc.if_else(first, pc.utf8_slice_codeunits(word, 1), pc.binary_join_element_wise(pa.scalar(" ", word.type), word, pa.scalar("", word.type)))
            coded = pa.concat_arrays([word, *others]).dictionary_encode()
            parts[easy] = coded.indices.to_numpy().reshape(5, -1).T + 1
            # No part but a line end has one, so they are the separators of the parts' texts.
            line = coded.dictionary.index("\n").as_py()
            texts = "\n".join(x if x != "\n" else "" for x in coded.dictionary.to_numpy(zero_copy_only=False))
            texts = texts.encode().decode("latin-1").translate(letters).split(letters[0x0A])
            if line >= 0:
                texts[line] = letters[0x0A]
            for text in texts:
                if text:
                    flat += map(id_of, tokenize(text))
                ends.append(len(flat))
        parts[hard, 0] = np.arange(len(ends), len(ends) + len(hard))
        strange = names_of(new.take(pa.array(hard)))
        for i in range(0, len(strange), AT_ONCE):
            for e in tokenizer.encode_batch_fast(strange[i:i + AT_ONCE], add_special_tokens=False):
                flat += e.ids
                ends.append(len(flat))
        start, size = np.array([0, *ends[:-1]], np.int64), np.diff(ends, prepend=0)
        return gather(np.array(flat, np.int32), start, size, parts.ravel()), size[parts].sum(axis=1)

    return learn, whole


def _cuttable(json: str) -> bool:
    """Whether pieces of a text encode as within it: byte-level pre-tokens by the common pattern, and nothing before them."""
    import json as js
    d = js.loads(json)
    pre = d.get("pre_tokenizer") or {}
    return d.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)


def write_ids(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, bits: int = 1, block: int = BLOCK,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of all documents below ``folder`` (a URI that all executors share); the manifest's rows."""
    with open(tokenizer) as file:
        json = file.read()
    vocabulary = docs.sparkSession.sparkContext.broadcast(json)
    cut = _cuttable(json)
    target = re.sub(r"^(file:)?/+", "file:///", folder)  # a plain path is a file URI

    def run(batches):
        store, path = fs.FileSystem.from_uri(target)
        store.create_dir(path, recursive=True)
        task = TaskContext.get()
        name = f"ids-{task.partitionId():05d}-{task.taskAttemptId()}.planes"
        learn, whole = _by_library(vocabulary.value, cut)
        memory = Memory(learn, whole if cut else "")
        with store.open_output_stream(f"{path}/{name}") as out:
            writer = Writer(out, bits, block)
            for batch in chunks(batches, "text", BATCH_BYTES):
                ids, off = memory.encode(batch.column("text"))
                size = np.diff(off) + 1
                end = np.cumsum(size)
                flat = np.full(int(end[-1]), end_id, "<u4")
                body = np.ones(len(flat), bool)
                body[end - 1] = False
                flat[body] = ids
                writer.add(flat, batch.column("doc_id").to_pylist(), size)
            n_docs, n_ids = writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([f"{target}/{name}"]), pa.array([n_docs]), pa.array([n_ids])], ["file", "path", "n_docs", "n_ids"])

    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    written = own.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "file int, path string, n_docs bigint, n_ids bigint")
    return Staged(written, "ids-manifest").df


def read_ids(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of all documents of a dataset; start counts the ids of all documents before."""
    return _read(manifest, "ids array<bigint>", lambda rows: pa.array([x.astype(np.int64) for x in rows], pa.list_(pa.int64())))


def _read(manifest: DataFrame, column: str, made) -> DataFrame:
    # One row per file: the only ordered window there is.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = Staged(manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "ids-files").df
    name = column.split()[0]

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                store, inner = fs.FileSystem.from_uri(path)
                with store.open_input_file(inner) as source:
                    ids, starts, sizes, rows, held = [], [], [], [], 0
                    for doc_id, own in Reader(source).documents():
                        ids.append(doc_id), starts.append(start), sizes.append(len(own)), rows.append(own)
                        start, held = start + len(own), held + len(own)
                        if held > 1 << 20:
                            yield _batch(ids, starts, sizes, rows, made, name)
                            ids, starts, sizes, rows, held = [], [], [], [], 0
                    if ids:
                        yield _batch(ids, starts, sizes, rows, made, name)

    n = max(1, manifest.count())
    return files.select("path", "start").repartition(n).mapInArrow(run, f"doc_id bigint, start bigint, n_tokens bigint, {column}")


def _batch(ids, starts, sizes, rows, made, name):
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), made(rows)],
                                      ["doc_id", "start", "n_tokens", name])


def q_op7(spark, sf_dir: str) -> DataFrame:
    manifest = write_ids(table(spark, sf_dir, "documents", "doc_id", "text"), staging_dir(spark, "token-ids"))
    crc = lambda rows: pa.array([zlib.crc32(np.ascontiguousarray(x, "<u4").tobytes()) for x in rows], pa.int64())
    return _read(manifest, "ids_crc32 bigint", crc)
