"""Bounded-space online packing of token ids into fixed windows."""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salvor.llm.common import arrow, batches, few_rows, kept, staged, table

LENGTH = 2048
END_ID = 1
OPEN_WINDOWS = 64
LEAST_PIECE = 64
MERGED_TOGETHER = 4096
KEPT_WORDS = 200_000  # words of a generation; a worker keeps two
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?").fullmatch
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def byte_signs() -> dict[str, int]:
    """The printable sign of each byte in byte-level vocabularies: bytes that print stand for
    themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordIds(dict):
    """Word between white space -> its ids as little-endian bytes.

    No token crosses white space, so a text's ids are those of its words. A word of Latin letters
    goes through the same merges as ranks of bytes, with one more byte for the word's end;
    any other word is encoded by the tokenizer itself. Words of the last generation stay within reach, so frequent ones are
    encoded once while rare ones go."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.most, self.before = kept_words, {}
        self.tokenizer = Tokenizer.from_file(path)
        signs, ranks = byte_signs(), {}
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        for token, i in vocabulary.items():
            body = token.removesuffix("</w>")
            if all(c in signs for c in body):
                ranks.setdefault(bytes(signs[c] for c in body) + b"\x01" * (body != token), i)
        self.fast = tiktoken.Encoding("words", pat_str=r"[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={})
        self.sign = {s: np.array(self.tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes() for s in ".,"}

    def __missing__(self, word: str) -> bytes:
        if word in self.before:
            ids = self.before[word]
        elif LETTERS(word):
            tail = self.sign.get(word[-1], b"")
            found = self.fast.encode_ordinary((word[:-1] if tail else word).lower() + "\x01")
            ids = np.array(found, "<u4").tobytes() + tail
        else:
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= 40:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        # str.split also splits at four control signs that are no white space to the tokenizer.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.split()))


class Windows:
    """At most ``open_windows`` open windows; closed ones are handed out."""

    def __init__(self, length: int, open_windows: int, least_piece: int, first_id: int):
        self.length, self.most, self.least, self.next = length, open_windows, least_piece, first_id
        self.rooms: list[tuple[int, int]] = []  # (room, window), ascending
        self.held: dict[int, list[tuple]] = {}

    def _opened(self) -> int:
        self.next += 1
        self.held[self.next] = []
        return self.next

    def put(self, doc_id, total: int, ids: bytes) -> Iterator[list[tuple]]:
        """Place a document; yields the pieces of each window that closes. Full lengths are windows
        of their own, the rest goes where the least room is left. If it fits nowhere, the
        fullest window takes as much of it as it has room for (if that is ``least_piece`` or more) and closes."""
        start = 0
        while total - start >= self.length:
            self.next += 1
            yield [(doc_id, start, self.length, total, self.next, 0, ids[4 * start : 4 * (start + self.length)])]
            start += self.length
        while start < total:
            size = total - start
            at = bisect_left(self.rooms, (size, -1))
            if at < len(self.rooms):
                room, window = self.rooms.pop(at)
            elif len(self.rooms) < self.most:
                room, window = self.length, self._opened()
            else:
                room, window = self.rooms.pop(0)
                if room < self.least:
                    yield self.held.pop(window)
                    continue
                size = room
            self.held[window].append((doc_id, start, size, total, window, self.length - room, ids[4 * start : 4 * (start + size)]))
            start += size
            if room == size:
                yield self.held.pop(window)
            else:
                insort(self.rooms, (room - size, window))


def _pieces(schema: pa.Schema, rows: list[tuple], keep: bool) -> pa.RecordBatch:
    columns = list(zip(*rows))
    doc_id, start, size, total, window, offset, ids = columns or ((),) * 7
    return arrow(schema, [doc_id, start, size, [zlib.crc32(x) for x in ids], total, window, offset, ids if keep else [None] * len(ids)])


def merged(pieces: pd.DataFrame, length: int, first_id: int, keep: bool) -> pd.DataFrame:
    """Leftover windows one after another, cut at every ``length``; the last, shorter run is cut into
    powers of two, which need no padding."""
    pieces = pieces.sort_values(["sequence_id", "offset"], kind="stable")
    left = int(pieces["length"].sum())
    sizes = [length] * (left // length) + [1 << b for b in range(left.bit_length(), -1, -1) if (left % length) >> b & 1]
    out, window, offset = [], 0, 0
    for doc_id, start, size, total, ids in pieces[["doc_id", "start", "length", "doc_tokens", "ids"]].itertuples(index=False):
        done = 0
        while done < size:
            taken = min(size - done, sizes[window] - offset)
            part = ids[4 * done : 4 * (done + taken)]
            out.append((doc_id, start + done, taken, zlib.crc32(part), total, first_id + window, offset, part if keep else None))
            done, offset = done + taken, offset + taken
            if offset == sizes[window]:
                window, offset = window + 1, 0
    return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])


def pack(docs: DataFrame, path: str, *, length: int = LENGTH, open_windows: int = OPEN_WINDOWS, least_piece: int = LEAST_PIECE, keep_ids: bool = False, kept_words: int = KEPT_WORDS) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with
    ``keep_ids``, the ids as little-endian 32-bit numbers. A worker keeps the ids of up to twice ``kept_words`` words.

    Tokenising and packing are one pass over the partitions of ``docs`` without a shuffle. Only the
    windows still open at a partition's end move: groups of about MERGED_TOGETHER of them are merged.

    Null and empty texts are the end id alone. Repeated rows are packed each; an empty table gives
    no rows. Only doc_id and text are read.
    """
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())])
    with_open = schema.append(pa.field("open", pa.bool_()))
    end = np.array([END_ID], "<u4").tobytes()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept(("words", path, kept_words), lambda: WordIds(path, kept_words))
        windows = Windows(length, open_windows, least_piece, TaskContext.get().partitionId() << 33)

        def batch_of(rows, still_open: bool) -> pa.RecordBatch:
            made = _pieces(schema, rows, keep_ids or still_open)
            return pa.RecordBatch.from_arrays([*made.columns, pa.array([still_open] * len(rows), pa.bool_())], schema=with_open)

        for batch, texts in batches(source):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                ids = words.text(text) + end
                for closed in windows.put(doc_id, len(ids) // 4, ids):
                    rows += closed
            yield batch_of(rows, False)
        rest = [piece for held in windows.held.values() for piece in held]
        if rest:
            yield batch_of(rest, True)

    ready = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    with few_rows(docs.sparkSession):
        first = staged(ready.mapInArrow(run, f"{PIECE}, open boolean"), "packed")
    left = first.filter("open").drop("open")
    groups = -(-left.select("sequence_id").distinct().count() // MERGED_TOGETHER) or 1

    def merge(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        return merged(pieces, length, (1 << 62) + (key[0] << 33), keep_ids)

    group = F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("part")
    last = left.groupBy(group).applyInPandas(merge, PIECE)
    pieces = first.filter("not open").drop("open").unionByName(last)
    return pieces if keep_ids else pieces.drop("ids")


def query(spark, folder: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
