"""Token ids in seekable files: independent zstandard frames, a document index and a trailing seek table.

File layout (all integers little-endian), one file per range of documents:

* data frames: each an independent zstandard frame with its content checksum, holding the ids (unsigned 32-bit) of
  whole documents one after another; a frame is closed once it holds ``frame_bytes`` of ids (a longer document gets a
  frame of its own);
* a skippable frame (magic ``0x184D2A50``) with the document index: per document its id (signed 64-bit), a flags byte
  (1: the id is null), its frame, its first id within the frame and its number of ids (unsigned 32-bit each);
* the seek table as a skippable frame (magic ``0x184D2A5E``): per data frame its compressed size, decompressed size and
  the low 32 bits of the XXH64 of its content, then the number of frames, a descriptor byte (bit 7: checksums
  present) and the magic ``0x8F92EAB1``.

A reader takes the footer, then the seek table, then the index that starts where the frames end, and decompresses only
the frames of the documents it wants. Writers put each file under a temporary name and rename it when complete, so a
retried task leaves one whole file.

Spark's part: documents are range-partitioned by id (ties by text, then by their place in the input, so a hot id is
split over several tasks), sorted within each task, encoded and written by the task that holds them; the files are
read back by one task per file.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the format (those of zstandard's skippable frames and seekable format).
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_FOOTER = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
FRAME_BYTES = 1 << 18
LEVEL = 3
#: ids of repeated texts a task remembers
MEMO_IDS = 4_000_000
#: characters of the texts that are encoded together
SLICE_CHARS = 2_000_000
#: pieces of texts a worker remembers at least before it forgets those it did not see again, and the longest of them in characters
MEMO_PIECES = 400_000
LONGEST_PIECE = 64
#: pieces that go through the tokenizer as one text
JOINED = 100
# Characters that no definition of white space includes; cuts before single blanks and line breaks between two of them.
_INK = "!-~\u00a1-\u167f\u2010-\u2027\u2030-\u205e\u2070-\u2fff\u3001-\ud7ff\U00010000-\U0010ffff"
_CUT = re.compile(f"(?<=[{_INK}])(?=[ \n][{_INK}])")
_PLAIN = re.compile(f"[ \n]?[{_INK}]+")
_INDEX_ROW = struct.Struct("<qBIII")
_SEEK_ROW = struct.Struct("<III")

_tokenizers: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a vocabulary file, loaded once per worker; without threads of its own, as a task has one core."""
    if path not in _tokenizers:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


#: by vocabulary: ids of pieces, and those of the generation before, from which pieces that are seen again come back
_pieces: dict[str, tuple[dict[str, bytes], dict[str, bytes]]] = {}
_cuttable: dict[str, bool] = {}
_openings: dict[str, np.ndarray] = {}


def cuttable(path: str) -> bool:
    """Whether a text's ids are those of its pieces (``_CUT``), one after another.

    So it is for byte-level BPE with that pre-tokenizer's own pattern: no part of it goes on from ink into a blank or line
    break or looks past the ink after one, so a part always begins there, and merges stay within a part. Nothing before
    (a normalizer, added tokens with blanks) or after it may see more than a part.
    """
    if path not in _cuttable:
        spec = json.loads(tokenizer(path).to_str())
        split, after = spec.get("pre_tokenizer") or {}, spec.get("post_processor")
        _cuttable[path] = (
            not any(spec.get(k) for k in ("normalizer", "truncation", "padding"))
            and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
            and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout")
            and (after is None or after.get("type") == "ByteLevel")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]))
    return _cuttable[path]


def _ids(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    return [np.asarray(e.ids, "<u4").tobytes() for e in tokenizer(path).encode_batch(texts, add_special_tokens=False)]


def _opening(path: str) -> np.ndarray:
    """Whether a token, by id, begins with a blank or a line break; byte-level vocabularies write them as below."""
    if path not in _openings:
        tokens = tokenizer(path).get_vocab(with_added_tokens=True)
        _openings[path] = np.zeros(max(tokens.values()) + 1, bool)
        _openings[path][[i for token, i in tokens.items() if token[:1] in ("\u0120", "\u010a")]] = True
    return _openings[path]


def _ids_of_pieces(pieces: list[str], path: str) -> list[bytes]:
    """As ``_ids``, for pieces of ink behind one blank or line break: many go as one text, cut where a token begins with these."""
    if len(pieces) < JOINED:
        return _ids(pieces, path)
    groups = [pieces[i:i + JOINED] for i in range(0, len(pieces), JOINED)]
    out = []
    for group, raw in zip(groups, _ids(["".join(g) for g in groups], path)):
        starts = np.flatnonzero(_opening(path)[np.frombuffer(raw, "<u4")])
        if len(starts) != len(group) or starts[0]:  # an odd vocabulary
            out += _ids(group, path)
            continue
        bounds = [*(4 * starts).tolist(), len(raw)]
        out += [raw[i:j] for i, j in zip(bounds, bounds[1:])]
    return out


def _encoded(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text; the tokenizer sees a piece once per worker, if it can and as long as the piece is remembered."""
    if not cuttable(path):
        return _ids(texts, path)
    known, before = _pieces.setdefault(path, ({}, {}))
    if len(known) > MEMO_PIECES:  # only a memo: what is forgotten is encoded again
        known, before = _pieces[path] = {}, known
    # a cut before every blank and line break is right if all pieces are plain; what is known without NUL is plain
    marked = ["\0\0" if "\0" in t else t.replace(" ", "\0 ").replace("\n", "\0\n") for t in texts]
    cut = pc.split_pattern(pa.array(marked, pa.large_string()), "\0")
    pieces = cut.values.dictionary_encode()
    which, ends = pieces.indices.to_numpy(), cut.offsets.to_numpy()
    different = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
    ids = list(map(known.get, different))
    gaps = [i for i, v in enumerate(ids) if v is None]
    missing = {different[i] for i in gaps if _PLAIN.fullmatch(different[i])}
    # texts with other pieces are cut again with care; their pieces that are not plain have NUL before them
    odd = np.zeros(len(different), bool)
    odd[[i for i in gaps if different[i] not in missing]] = True
    again = np.unique(np.searchsorted(ends, np.flatnonzero(odd[which]), "right") - 1).tolist()
    careful = {i: [p if _PLAIN.fullmatch(p) else "\0" + p for p in _CUT.split(texts[i])] for i in again}
    missing.update(p for some in careful.values() for p in some if p not in known)
    fresh = {p: before[p] for p in missing if p in before}
    missing.difference_update(fresh)
    others = [p for p in missing if p[0] not in " \n"]
    joinable = list(missing.difference(others))
    fresh.update(zip(joinable, _ids_of_pieces(joinable, path)))
    fresh.update(zip(others, _ids([p.removeprefix("\0") for p in others], path)))
    for i in gaps:
        ids[i] = fresh.get(different[i], b"")  # none for the odd ones, whose texts come below
    table = np.frombuffer(b"".join(ids), "<u4")
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    begin, n = (np.cumsum(size) - size)[which], size[which]
    at = np.concatenate([[0], np.cumsum(n)])
    whole = table[np.repeat(begin - at[:-1], n) + np.arange(at[-1])]
    bounds = at[ends].tolist()
    out = [whole[i:j].tobytes() for i, j in zip(bounds, bounds[1:])]
    for i, some in careful.items():
        out[i] = b"".join([fresh[p] if p in fresh else known[p] for p in some])
    known.update(fresh)
    for piece in [p for p in fresh if len(p) > LONGEST_PIECE]:
        del known[piece]
    return out


class Memo(dict):
    """Ids by the 128-bit hash of their text, with the number of ids held."""

    held = 0


def encode(texts: list[str | None], path: str, end_id: int, memo: Memo | None = None) -> list[np.ndarray]:
    """Ids of each text (null: none) without special tokens, ``end_id`` appended.

    ``memo`` (128-bit hash of a text -> its ids) lets copies of a text be encoded once; it is bounded by the caller.
    """
    memo = Memo() if memo is None else memo
    keys = [xxhash.xxh3_128_digest((t or "").encode()) for t in texts]
    fresh = {k: t or "" for k, t in zip(keys, texts) if k not in memo}
    if fresh:
        end = np.uint32(end_id).astype("<u4").tobytes()
        for k, ids in zip(fresh, _encoded(list(fresh.values()), path)):
            memo[k] = np.frombuffer(ids + end, "<u4")
            memo.held += len(memo[k])
    return [memo[k] for k in keys]


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Places of texts in a row, up to ``SLICE_CHARS`` and one text more."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text or "") + 1
        if held > SLICE_CHARS or i + 1 == len(texts):
            yield start, i + 1
            start, held = i + 1, 0


class TokenWriter:
    """Writes documents to a binary stream as they come; keeps only the index and the seek table in memory."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.seek, self.index, self.pending, self.size, self.frames = [], [], [], 0, 0

    def _close(self):
        raw = b"".join(self.pending)
        packed = self.compressor.compress(raw)
        self.out.write(packed)
        self.seek.append(_SEEK_ROW.pack(len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.pending, self.size = [], 0
        self.frames += 1

    def add(self, doc_id: int | None, ids: np.ndarray):
        if self.pending and self.size + 4 * len(ids) > self.frame_bytes:
            self._close()
        self.index.append(_INDEX_ROW.pack(0 if doc_id is None else doc_id, doc_id is None, self.frames, self.size // 4, len(ids)))
        self.pending.append(ids.astype("<u4").tobytes())
        self.size += 4 * len(ids)

    def finish(self):
        if self.pending:
            self._close()
        listed = b"".join(self.index)
        table = b"".join(self.seek) + struct.pack("<IBI", self.frames, CHECKSUM_FLAG, SEEK_FOOTER)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(listed)) + listed)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)


def pack(doc_ids: list[int | None], ids: list[np.ndarray], frame_bytes: int = FRAME_BYTES) -> bytes:
    """One file in memory: frames of whole documents, the document index and the seek table."""
    out = io.BytesIO()
    writer = TokenWriter(out, frame_bytes)
    for doc_id, these in zip(doc_ids, ids):
        writer.add(doc_id, these)
    writer.finish()
    return out.getvalue()


def layout(data: bytes) -> tuple[list[tuple[int, int, int, int]], list[tuple[int | None, int, int, int]]]:
    """(offset, compressed size, size, checksum) of each frame and (doc_id, frame, first, count) of each document."""
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEK_FOOTER or not flags & CHECKSUM_FLAG:
        raise ValueError("not a token file: no seek table")
    table_at = len(data) - 9 - count * _SEEK_ROW.size
    frames, offset = [], 0
    for i in range(count):
        packed, size, check = _SEEK_ROW.unpack_from(data, table_at + i * _SEEK_ROW.size)
        frames.append((offset, packed, size, check))
        offset += packed
    magic, length = struct.unpack_from("<II", data, offset)
    if magic != SKIPPABLE_INDEX:
        raise ValueError("not a token file: no document index")
    docs = []
    for at in range(offset + 8, offset + 8 + length, _INDEX_ROW.size):
        doc_id, null, frame, first, n = _INDEX_ROW.unpack_from(data, at)
        docs.append((None if null else doc_id, frame, first, n))
    return frames, docs


def frame_ids(data: bytes, frame: tuple[int, int, int, int]) -> np.ndarray:
    """The ids of one frame, both checksums verified."""
    offset, packed, size, check = frame
    raw = zstandard.ZstdDecompressor().decompress(data[offset:offset + packed], max_output_size=size)
    if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
        raise ValueError("token file frame does not match its seek table")
    return np.frombuffer(raw, "<u4")


def read_documents(data: bytes, wanted: set[int] | None = None) -> list[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of the wanted documents (all if None), decompressing only their frames."""
    frames, docs = layout(data)
    cache: dict[int, np.ndarray] = {}
    out = []
    for doc_id, frame, first, n in docs:
        if wanted is not None and doc_id not in wanted:
            continue
        if frame not in cache:
            cache.clear()
            cache[frame] = frame_ids(data, frames[frame])
        out.append((doc_id, cache[frame][first:first + n]))
    return out


def _filesystem(folder: str):
    """File system and path of a folder given as a path or a URI (``file:/x`` as Hadoop writes it included)."""
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:"):]
    return pafs.FileSystem.from_uri(folder)


def _writer(folder: str, path: str, end_id: int, frame_bytes: int):
    def run(frames):
        part = TaskContext.get().partitionId()
        fs, base = _filesystem(folder)
        name = f"{base}/part-{part:05d}.tok"
        temporary = f"{name}.{uuid.uuid4().hex}.tmp"
        docs = n_ids = 0
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(temporary) as out:
            writer = TokenWriter(out, frame_bytes)
            memo = Memo()
            for frame in frames:
                texts, keys = frame["text"].tolist(), frame["doc_id"].tolist()
                for start, end in _slices(texts):
                    if memo.held > MEMO_IDS:  # only a memo: what is forgotten is encoded again
                        memo.clear()
                        memo.held = 0
                    for key, ids in zip(keys[start:end], encode(texts[start:end], path, end_id, memo)):
                        writer.add(None if pd.isna(key) else int(key), ids)
                        docs, n_ids = docs + 1, n_ids + len(ids)
            writer.finish()
        fs.move(temporary, name)
        yield pd.DataFrame({"part": [part], "n_docs": [docs], "n_ids": [n_ids]})

    return run


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = 0, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encode ``doc_id`` and ``text`` of ``docs`` into token files under ``folder``, in ascending ``doc_id`` order.

    Order: doc_id ascending with null ids last; equal ids by the 64-bit xxhash of their text (null first), then by
    their place in the input.
    Every row is a document (repeated rows are written repeatedly; a null text has only ``end_id``). An empty table
    writes one file per task that received rows, possibly none. Other columns are not read. Returns one row per file:
    its task number (files sort by it), documents and ids.
    """
    # the range bounds are drawn from a sample of these keys on the driver: a hash stands for the text there
    order = [F.asc_nulls_last("doc_id"), F.asc_nulls_first("__text"), F.col("__at")]
    placed = docs.select("doc_id", "text").withColumn("__text", F.when(F.col("text").isNotNull(), F.xxhash64("text"))).withColumn(
        "__at", F.monotonically_increasing_id())
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    return ranged.mapInPandas(_writer(folder, path, end_id, frame_bytes), "part int, n_docs long, n_ids long")


def _reader(folder: str):
    def run(frames):
        fs, base = _filesystem(folder)
        for frame in frames:
            for name, part in zip(frame["name"], frame["part"]):
                with fs.open_input_file(f"{base}/{name}") as f:
                    data = f.read()
                frames_, docs = layout(data)
                rows, at = [], 0
                cache: dict[int, np.ndarray] = {}
                for doc_id, number, first, n in docs:
                    if number not in cache:
                        cache = {number: frame_ids(data, frames_[number])}
                    ids = cache[number][first:first + n]
                    rows.append((doc_id, int(part), at, n, zlib.crc32(ids.astype("<u4").tobytes())))
                    at += n
                yield pd.DataFrame(rows, columns=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"]).astype(
                    {"doc_id": "Int64", "part": "int32", "local_start": "int64", "n_tokens": "int64", "ids_crc32": "int64"})

    return run


def _counter(folder: str):
    """Ids per file, by its document index; no frame is decompressed."""
    def run(frames):
        fs, base = _filesystem(folder)
        for frame in frames:
            counts = []
            for name in frame["name"]:
                with fs.open_input_file(f"{base}/{name}") as f:
                    counts.append(sum(n for *_, n in layout(f.read())[1]))
            yield pd.DataFrame({"part": frame["part"], "n": counts}).astype({"part": "int32", "n": "int64"})

    return run


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files under ``folder``: doc_id, start (ids of all documents before it, over the files in
    order), n_tokens and the unsigned crc32 of its ids as little-endian 32-bit integers; one task per file."""
    fs, base = _filesystem(folder)
    fs.create_dir(base, recursive=True)
    listed = sorted(i.base_name for i in fs.get_file_info(pafs.FileSelector(base)) if i.base_name.endswith(".tok"))
    names = spark.createDataFrame([(n, int(n[5:10])) for n in listed], "name string, part int")
    dealt = names.repartition(max(1, len(listed)), "name")
    read = dealt.mapInPandas(
        _reader(folder), "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    # a running total over one row per file, so one task holds them all
    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = dealt.mapInPandas(_counter(folder), "part int, n long")
    before = sizes.select("part", (F.sum("n").over(running) - F.col("n")).alias("base"))
    return read.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "part")
