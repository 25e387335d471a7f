"""Token ids in seekable zstandard files: independent frames, a trailing seek table, a checksum per frame.

Documents are dealt out by ranges of doc_id, sorted inside a range, encoded and
written as one file per task. A file is a run of zstandard frames of little-endian
unsigned 32-bit ids, then a skippable frame with the document index (doc_id,
n_tokens, compressed), then a skippable frame with the seek table: per frame its
compressed size, its size and the low 32 bits of the XXH64 of its content, as in
the published seekable format. A reader takes the last bytes, then the index,
then only the frames of the documents it was asked for, and checks them.

Each attempt of a task writes a file of its own name; the manifest, itself a
table written by Spark, names the files of the attempts that were committed. So
a lost executor or a repeated task leaves at most an unnamed file.

Null and empty texts have no ids but the end id. Repeated rows are written each.
Null ids come first and are read back as null. Extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wireglass.llm.common import small_batches
from wireglass.session import landed, shared_dir

END_ID = 1
#: Bytes of ids in a frame; a longer document is cut over several frames.
FRAME_BYTES = 1 << 18
#: Distinct words whose ids a task remembers; beyond it the memory starts anew.
REMEMBERED = 1_000_000
#: A mark that stands between words encoded together; words that hold it are encoded alone.
BETWEEN = "^"
# fixed values of the seekable format
INDEX_MAGIC, SEEK_MAGIC, SEEK_END, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
MANIFEST = "name string, first long, tie long, documents long, ids long"
#: Bytes of text behind one file; a task that sees much text meets few new words.
TEXT_BYTES = 256 << 20
#: Bytes of ids in one batch of a reading task.
READ_BYTES = 1 << 22
NULL_ID = -(1 << 63)


def open_path(folder: str):
    """(file system, path) of a folder; any store pyarrow can write."""
    if re.match(r"\w+:/", folder):
        return pyarrow.fs.FileSystem.from_uri(folder)
    return pyarrow.fs.LocalFileSystem(), folder


class Encoder:
    """Ids of whole texts, remembering the ids of words.

    The tokenizer's splitting never joins characters across white space, and its
    normalisation does not either, so a text's ids are those of its words in a
    row. Texts that may hold a special token, or a separator that only Python
    counts as white space, are encoded whole.
    """

    separators = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        split = [None if any(s in t for s in self.special) or self.separators.search(t) else t.split() for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        fresh = [w for w in set().union(*[words for words in split if words]) if w not in known]
        parts = [self._parts(w) for w in fresh]
        self._learn([p for p in set().union(*parts) if p not in known])
        for word, part in zip(fresh, parts):
            known[word] = known[part[0]] if len(part) == 1 else known[part[0]] + known[part[1]]
        out = []
        for text, words in zip(texts, split):
            if words is None:
                out.append(array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes())
            else:
                out.append(b"".join([known[w] for w in words]))
        return out

    @staticmethod
    def _parts(word: str) -> tuple[str, ...]:
        """Plain letters in lower case, and the mark behind them; any other word as it is.

        Splitting and lower-casing are what the tokenizer does with such a word itself.
        """
        if word[-1] in ".,;:!?" and word.isascii() and word[:-1].isalpha():
            return word[:-1].lower(), word[-1]
        return (word.lower() if word.isascii() and word.isalpha() else word,)

    def _learn(self, words: list[str]) -> None:
        """Ids of new words: plain letters straight from the model, all others in one text, told apart by a mark."""
        known, tokenize = self.known, self.tokenizer.model.tokenize
        other = []
        for word in words:
            if word.isascii() and word.isalpha():
                known[word] = array("I", [t.id for t in tokenize(word)]).tobytes()
            else:
                other.append(word)
        mark = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        together = [w for w in other if BETWEEN not in w] if len(mark) == 1 else []
        alone = [w for w in other if BETWEEN in w] if len(mark) == 1 else other
        for at in range(0, len(together), 500):
            part = together[at : at + 500]
            joined = self.tokenizer.encode(f" {BETWEEN} ".join(part), add_special_tokens=False)
            ids = array("I", [*joined.ids, *mark])
            start = 0
            for word in part:
                end = ids.index(mark[0], start)
                known[word] = ids[start:end].tobytes()
                start = end + 1
        for word in alone:
            known[word] = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()


class Writer:
    """Appends documents to one file."""

    def __init__(self, out):
        self.out, self.buffer, self.frames = out, bytearray(), []
        self.ids, self.counts = [], []
        self.pack = zstandard.ZstdCompressor(level=3)

    def add(self, doc_id: int, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.buffer += ids
        while len(self.buffer) >= FRAME_BYTES:
            self._frame(bytes(self.buffer[:FRAME_BYTES]))
            del self.buffer[:FRAME_BYTES]

    def _frame(self, content: bytes) -> None:
        packed = self.pack.compress(content)
        self.frames.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.out.write(packed)

    def close(self) -> None:
        if self.buffer:
            self._frame(bytes(self.buffer))
        index = self.pack.compress(np.array(self.ids, "<i8").tobytes() + np.array(self.counts, "<i8").tobytes())
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        # number of index bytes stands before the seek table's own fields, inside the same skippable frame
        body = table + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEK_END)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(body)) + body)
        self.out.close()


class Reader:
    """Reads one file; only the frames of the documents asked for are decompressed."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_END or flags != CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        table = self._at(size - 9 - 12 * count, 12 * count)
        self.frames = np.frombuffer(table, "<u4").reshape(-1, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.ends = np.cumsum(self.frames[:, 1]) // 4
        at = int(self.places[-1])
        magic, length = struct.unpack("<II", self._at(at, 8))
        if magic != INDEX_MAGIC:
            raise ValueError("no document index behind the frames")
        index = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._at(at + 8, length)), "<i8")
        self.ids, self.counts = index[: len(index) // 2], index[len(index) // 2 :]
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.held: tuple[int, bytes] = (-1, b"")

    def _at(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def frame(self, number: int) -> bytes:
        if self.held[0] != number:
            packed = self._at(int(self.places[number]), int(self.frames[number, 0]))
            content = zstandard.ZstdDecompressor().decompress(packed)
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.frames[number, 2]:
                raise ValueError(f"frame {number} does not match its checksum")
            self.held = (number, content)
        return self.held[1]

    def document(self, number: int) -> bytes:
        """Ids of the number-th document of the file, as bytes."""
        start, end = int(self.starts[number]), int(self.starts[number + 1])
        parts = []
        k = int(np.searchsorted(self.ends, start, "right"))
        while start < end:
            first = int(self.ends[k]) - int(self.frames[k, 1]) // 4
            stop = min(end, int(self.ends[k]))
            parts.append(self.frame(k)[4 * (start - first) : 4 * (stop - first)])
            start, k = stop, k + 1
        return b"".join(parts)


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write doc_id and text in ascending doc_id order; returns the manifest, one row per file.

    `tokenizer` is a file the executors can open; by default the installed public one.
    """
    small_batches(docs.sparkSession)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        encoder, writer, total = Encoder(path), None, 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            if writer is None:
                files, root = open_path(folder)
                files.create_dir(root, recursive=True)
                name, tie = f"ids-{uuid.uuid4().hex}.zst", int(batch["tie"].iloc[0])
                writer = Writer(files.open_output_stream(f"{root}/{name}", compression=None))
            texts = ["" if t is None else t for t in batch["text"]]
            for doc_id, coded in zip(batch["doc_id"].tolist(), encoder.encode(texts)):
                writer.add(doc_id, coded + end)
                total += len(coded) // 4 + 1
        if writer is not None:
            writer.close()
            yield pd.DataFrame(
                {
                    "name": [name],
                    "first": [writer.ids[0]],
                    "tie": [tie],
                    "documents": [len(writer.ids)],
                    "ids": [total],
                }
            )

    # the hash lets rows that share an id be dealt to several tasks; a null id is the smallest number
    doc_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("doc_id")
    dealt = docs.select(doc_id, F.xxhash64("text").alias("tie"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(-(-total // TEXT_BYTES), docs.sparkSession.sparkContext.defaultParallelism)
    dealt = dealt.repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return landed(dealt.mapInPandas(task, MANIFEST), "manifest")


def read(manifest: DataFrame, folder: str, checksum_only: bool = False) -> DataFrame:
    """Documents of a manifest from their files: doc_id, start (ids of all documents before it), n_tokens, ids.

    With `checksum_only` the ids are replaced by ids_crc32, their crc32.
    """
    # one row per file; only the order of the files is global
    before = Window.orderBy("first", "tie", "name").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    last = ("ids_crc32", "long") if checksum_only else ("ids", "binary")

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = open_path(folder)
        for batch in batches:
            for name, start in zip(batch["name"], batch["start"]):
                with files.open_input_file(f"{root}/{name}") as source:
                    reader = Reader(source)
                    rows, held = [], 0
                    for k, doc_id in enumerate(reader.ids.tolist()):
                        ids = reader.document(k)
                        value = zlib.crc32(ids) if checksum_only else ids
                        known = None if doc_id == NULL_ID else doc_id
                        rows.append((known, int(start) + int(reader.starts[k]), len(ids) // 4, value))
                        held += 64 if checksum_only else len(ids)
                        if held >= READ_BYTES:
                            yield _frame(rows, last[0])
                            rows, held = [], 0
                    if rows:
                        yield _frame(rows, last[0])

    spread = placed.repartition(max(manifest.count(), 1))
    return spread.mapInPandas(task, f"doc_id long, start long, n_tokens long, {last[0]} {last[1]}")


def _frame(rows: list[tuple], name: str) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", name])
    return frame.astype({"doc_id": "Int64"})


def roundtrip(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the documents to a new shared folder and read what was written: doc_id, start, n_tokens, ids_crc32."""
    folder = shared_dir(docs.sparkSession, "tokens")
    return read(write(docs, folder, tokenizer, end_id), folder, checksum_only=True)
