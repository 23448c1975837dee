"""Token ids in files of independent zstandard frames.

A file holds one frame a document (its ids as little-endian unsigned 32-bit numbers), a skippable frame with the
document ids, and the public seekable format's trailing seek table: for each frame its compressed and decompressed
size and the low 32 bits of the XXH64 of its content. A reader takes the end of the file, then only the frames it wants.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from legispark.llm import text as T
from legispark.llm.storage import fresh, opened, written

#: Fixed values of the seekable format and of skippable frames.
SKIPPABLE_SEEK, SKIPPABLE_OWN, SEEKABLE = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
CHECKSUMS = 0x80
END_ID = 2
#: Tasks that read files, at most.
READERS = 4096
#: Distinct words that are encoded at once, and that a worker remembers with their ids.
JOINED, REMEMBERED = 1024, 400_000


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """A worker's encoder of a tokenizer's file; tasks after the first find it ready."""
    return WordEncoder(path)


class WordEncoder:
    """Encodes each distinct white-space-separated word once, and remembers a bounded number of them.

    That holds for tokenizers of one form (FORM), which drop white space and never join across it: a text's ids are its
    words' ids in order. Texts of any other tokenizer are encoded whole. Plain words (printable ASCII and Latin-1
    letters) are encoded many at a time with spaces between them: the last token of each piece that the tokenizer cuts a
    word into ends in its mark for word ends, and a pattern tells the number of pieces. Each word's tokens must make up
    its bytes; if one's don't, all are encoded alone, as other words are.
    """

    # The form of tokenizer for which words may be encoded apart.
    FORM = {
        "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    }
    PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
    PLAIN = "^[!-~À-ÖØ-öø-ÿ]+$"
    TAIL, MARK = ".,;:!?", "</w>"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        form = json.loads(self.tokenizer.to_str())
        self.apart = form["model"].get("end_of_word_suffix") == self.MARK and all(form[k] == v for k, v in self.FORM.items()) and form["post_processor"] is None
        n = self.tokenizer.get_vocab_size()
        self.ends, self.bytes = np.zeros(n, bool), np.zeros(n, np.int64)
        for token, k in self.tokenizer.get_vocab().items():  # a token has a character for each byte
            self.ends[k], self.bytes[k] = token.endswith(self.MARK), len(token.removesuffix(self.MARK))
        self.special = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.words, self.ids, self.begin = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(f) for f in found], np.int64)

    def _packed(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        known = words.to_pylist()
        packs = [" ".join(known[i : i + JOINED]) for i in range(0, len(known), JOINED)]
        ids, _ = self._alone(packs)
        pieces = pc.count_substring_regex(pc.utf8_lower(words), self.PIECE).to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != pieces.sum():
            return self._alone(known)
        n = np.diff(ends[np.cumsum(pieces) - 1], prepend=-1)
        own = np.add.reduceat(self.bytes[ids], np.cumsum(n) - n) if len(n) else n
        if (own != pc.binary_length(pc.utf8_lower(words)).to_numpy(zero_copy_only=False)).any():
            return self._alone(known)
        return ids, n

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Plain words; what ends them after a letter or digit is a piece of its own, so it is encoded once."""
        heads = pc.utf8_rtrim(words, self.TAIL)
        heads = pc.if_else(pc.match_substring_regex(heads, "[A-Za-z0-9À-ÖØ-öø-ÿ]$"), heads, words)
        tails = pc.if_else(pc.equal(heads, words), "", pc.replace_substring_regex(words, r"^.*[A-Za-z0-9À-ÖØ-öø-ÿ]", ""))
        code, known = T.coded(heads)
        ids, n = self._packed(known)
        end_code, ends = T.coded(tails)
        more, m = self._alone(ends.to_pylist())
        every, size = np.concatenate([ids, more]), np.concatenate([n, m])
        begin = np.cumsum(size) - size
        order = np.column_stack([code, end_code + len(n)]).ravel()  # each head, then its tail
        return every[T.spread(begin[order], size[order])], size[order].reshape(-1, 2).sum(axis=1)

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offset of each word's first and of the end."""
        plain = pc.and_(pc.match_substring_regex(words, self.PLAIN), pc.invert(pc.match_substring_regex(words, self.special))).to_numpy(zero_copy_only=False)
        where = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        a, n_a = self._plain(words.filter(pa.array(plain))) if plain.any() else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        b, n_b = self._alone(words.filter(pa.array(~plain)).to_pylist())
        ids, n = np.concatenate([a, b]), np.concatenate([n_a, n_b])
        back = np.empty(len(where), np.int64)
        back[where] = np.arange(len(where))
        starts = np.cumsum(n) - n
        return ids[T.spread(starts[back], n[back])], np.concatenate([[0], np.cumsum(n[back], dtype=np.int64)])

    def known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As distinct(), as the ids and each word's first and number; remembers new words while there is room."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        fresh = words.filter(pa.array(at < 0))
        ids, begin = self.distinct(fresh) if len(new) else (np.zeros(0, np.uint32), np.zeros(1, np.int64))
        every = np.concatenate([self.ids, ids])
        starts, n = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        old = np.flatnonzero(at >= 0)
        starts[old], n[old] = self.begin[at[old]], np.diff(self.begin)[at[old]]
        starts[new], n[new] = len(self.ids) + begin[:-1], np.diff(begin)
        room = min(len(new), REMEMBERED - len(self.words))
        if room > 0:
            self.words = pa.concat_arrays([self.words, fresh.slice(0, room)])
            self.begin = np.concatenate([self.begin, len(self.ids) + begin[1 : room + 1]])
            self.ids = every[: self.begin[-1]]
        return every, starts, n

    def _whole(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, n = self._alone(text.to_pylist())
        ends = np.cumsum(n + 1)
        return np.insert(ids, np.cumsum(n), END_ID).astype(np.uint32), np.concatenate([[0], ends])

    def __call__(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, an end id after each, and the offset of each text's first and of the end."""
        if not self.apart:
            return self._whole(text)
        if not self.special or not pc.any(pc.match_substring_regex(text, f"(?i){self.special}")).as_py():  # the tokenizer lowers all but these
            text = pc.ascii_lower(text)
        flat, at = T.split(text)
        code, words = T.coded(flat)
        ids, first, size = self.known(words)
        n = size[code] if len(code) else np.zeros(0, np.int64)
        sizes = T.sums(n, at) + 1
        ends = np.cumsum(sizes)
        out = np.full(int(ends[-1]) if len(ends) else 0, END_ID, np.uint32)
        body = np.ones(len(out), bool)
        body[ends - 1] = False
        if len(code):
            out[body] = ids[T.spread(first[code], n)]
        return out, np.concatenate([[0], ends])


class FrameWriter:
    """Writes one file; add() takes a document's id and ids, close() writes what a reader needs."""

    def __init__(self, stream):
        self.stream, self.table, self.docs = stream, bytearray(), []
        self.pack = zstandard.ZstdCompressor(level=3, write_content_size=True, write_checksum=False)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        content = ids.astype("<u4", copy=False).tobytes()
        frame = self.pack.compress(content)
        self.table += struct.pack("<III", len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF)
        self.docs.append(doc_id)
        self.stream.write(frame)

    def close(self) -> None:
        null = np.array([d is None for d in self.docs], np.uint8)
        known = np.array([d or 0 for d in self.docs], "<i8")
        own = self.pack.compress(known.tobytes() + null.tobytes())
        self.stream.write(struct.pack("<II", SKIPPABLE_OWN, len(own)) + own)
        foot = struct.pack("<IBI", len(self.docs), CHECKSUMS, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE_SEEK, len(self.table) + len(foot)) + self.table + foot)
        self.stream.close()


class FrameReader:
    """Reads a file's tables from its end, then single frames."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        count, _, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("not a seekable file")
        start = size - 9 - 12 * count - 8
        table = np.frombuffer(self._at(start + 8, 12 * count), "<u4").reshape(count, 3)
        self.sizes, self.sums = table[:, 1], table[:, 2]
        self.begin = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
        self.unpack = zstandard.ZstdDecompressor()
        own = self.unpack.decompress(self._at(self.begin[-1] + 8, start - self.begin[-1] - 8))
        null = np.frombuffer(own, np.uint8, count, 8 * count)
        self.docs = [None if n else int(d) for d, n in zip(np.frombuffer(own, "<i8", count), null, strict=True)]

    def _at(self, position: int, n: int) -> bytes:
        self.stream.seek(int(position))
        return self.stream.read(int(n))

    def ids(self, k: int) -> np.ndarray:
        """The ids of the document in frame k; raises if its checksum is wrong."""
        content = self.unpack.decompress(self._at(self.begin[k], self.begin[k + 1] - self.begin[k]), max_output_size=int(self.sizes[k]))
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k}: wrong checksum")
        return np.frombuffer(content, "<u4")


def write_tokens(docs: DataFrame, directory: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes files in ascending id order; returns a row per file: shard, path, first_id, n_docs, n_tokens.

    Null texts count as empty and give the end id alone. Null ids come first; rows that repeat an id are ordered by
    text. A task writes under a name of its own and renames, so a rerun of a lost task replaces the same file. An empty
    table gives no file. Other columns are ignored.
    """
    rows = docs.select(T.col(id_col).cast("long").alias("doc_id"), T.col(text_col).alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        shard, writer, first, n = task.partitionId(), None, None, 0
        fs, base = opened(directory)
        final = f"{base}/shard-{shard:06d}.zst"
        part = f"{final}.{task.taskAttemptId()}"
        encode = encoder(tokenizer)
        for batch in T.slices(batches, "text"):
            if writer is None:
                fs.create_dir(base, recursive=True)
                writer, first = FrameWriter(fs.open_output_stream(part, compression=None)), batch.column("doc_id")[0].as_py()
            ids, at = encode(T.strings(batch.column("text")))
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                writer.add(doc, ids[at[k] : at[k + 1]])
            n += len(ids)
        if writer is not None:
            writer.close()
            fs.move(part, final)
            row = {"shard": [shard], "path": [f"shard-{shard:06d}.zst"], "first_id": pa.array([first], pa.int64()), "n_docs": [len(writer.docs)], "n_tokens": [n]}
            yield pa.RecordBatch.from_pydict(row)

    return rows.mapInArrow(write, "shard long, path string, first_id long, n_docs long, n_tokens long")


def read_tokens(files: DataFrame, directory: str) -> DataFrame:
    """Each document of the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32, from the files alone."""
    order = Window.orderBy(F.col("first_id").asc_nulls_first(), "shard").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("before", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))  # a row per file

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(directory)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                with fs.open_input_file(f"{base}/{path}") as stream:
                    reader = FrameReader(stream)
                    n, crc = [], []
                    for k in range(len(reader.docs)):
                        ids = reader.ids(k)
                        n.append(len(ids))
                        crc.append(zlib.crc32(ids.tobytes()))
                begin = start + np.cumsum([0, *n])[:-1]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(reader.docs, pa.int64()), "start": begin, "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    spread = files.repartition(max(1, min(files.count(), READERS)))  # a number of its own, or the small list would be one task
    return spread.select("path", "before").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens(spark: SparkSession, docs: DataFrame, tokenizer: str, directory: str | None = None) -> DataFrame:
    """Writes the documents' ids to files in the shared folder and reads them back."""
    directory = directory or fresh(spark, "tokens")
    return read_tokens(written(write_tokens(docs, directory, tokenizer), "files"), directory)

