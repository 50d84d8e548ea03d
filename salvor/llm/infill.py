"""Fill-in-middle: segments of a text exchanged in place by block rotation, and put back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salvor.llm.common import arrow, by_batches, table

SEED = 42
# Fixed values of the contract: sentinels, and percentages of texts changed and of those in suffix-first form.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
CHANGED_PERCENT = 50
SUFFIX_FIRST_PERCENT = 80
MADE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def unit_ends(body: bytearray) -> np.ndarray:
    """Byte positions where the units of a text end: a unit is a word with the white space before it, or
    the white space at the end. White space is ASCII, so bytes are scanned."""
    if not body:
        return np.zeros(0, np.int64)
    space = SPACE[np.frombuffer(body, np.uint8)]
    return np.append(np.flatnonzero(~space[:-1] & space[1:]) + 1, len(body))


def code_points(part: bytes) -> int:
    """Characters of valid UTF-8: bytes that continue none."""
    return int(np.count_nonzero(np.frombuffer(part, np.int8) >= -64))


def flip(view: np.ndarray, start: int, stop: int) -> None:
    """Reverse view[start:stop] in place; only half of it is held beside."""
    half = (stop - start) // 2
    if half:
        left = view[start : start + half].copy()
        view[start : start + half] = view[stop - half : stop][::-1]
        view[stop - half : stop] = left[::-1]


def rotate(body: bytearray, start: int, middle: int, stop: int) -> None:
    """Exchange the neighbours body[start:middle] and body[middle:stop] by three reversals."""
    view = np.frombuffer(body, np.uint8)
    flip(view, start, middle)
    flip(view, middle, stop)
    flip(view, start, stop)


def infilled(body: bytearray, first: int, second: int, form: str) -> None:
    """Change a text into its form, in place, with its prefix before ``first`` and its suffix from ``second`` on."""
    # From the back, so that earlier cuts keep their places.
    body[second:second] = SUFFIX
    body[first:first] = MIDDLE
    body[0:0] = PREFIX
    moved = second + len(PREFIX) + len(MIDDLE)
    rotate(body, first + len(PREFIX) if form == "psm" else 0, moved, len(body))


def restored(body: bytearray, form: str) -> None:
    """The inverse rotation, then the sentinels go. A text has no sentinel of its own, so each is found once."""
    if form == "plain":
        return
    if form == "psm":
        first, stop = body.index(SUFFIX), body.index(MIDDLE)
        start = first
    else:
        start, stop = 0, body.index(PREFIX)
        first = body.index(MIDDLE) - stop
    # The moved block went before the others; rotating by the rest of the length takes it back.
    suffix = stop - start
    rotate(body, start, stop, len(body))
    at = len(body) - suffix
    del body[at : at + len(SUFFIX)]
    del body[first : first + len(MIDDLE)]
    del body[: len(PREFIX)]


def draws(seed: int, doc_id) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def changed(text: bytes, doc_id, seed: int, percent: int, suffix_first: int) -> tuple:
    """n, form, prefix and middle characters (None if plain), output of one text."""
    body = bytearray(text)
    ends = unit_ends(body)
    n = len(ends)
    a, b, change, order = draws(seed, doc_id)
    if not body or any(s in body for s in (PREFIX, SUFFIX, MIDDLE)) or change % 100 >= percent:
        return n, "plain", None, None, text
    cuts = np.append(0, ends)
    first, second = (int(cuts[k]) for k in sorted((a % (n + 1), b % (n + 1))))
    form = "spm" if order % 100 < suffix_first else "psm"
    prefix, middle = code_points(body[:first]), code_points(body[first:second])
    infilled(body, first, second, form)
    return n, form, prefix, middle, bytes(body)


def _texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """One text at a time as UTF-8, null as empty: a batch is never held twice."""
    for value in column:
        buffer = value.as_buffer()
        yield b"" if buffer is None else buffer.to_pybytes()


def fill_in_middle(docs: DataFrame, *, seed: int = SEED, percent: int = CHANGED_PERCENT, suffix_first: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain) and output of every text, without a shuffle.

    Cuts lie between units and, like the form, follow the seed and the id alone, so reruns agree. ``percent`` of the ids
    change, ``suffix_first`` per cent of these into ``<S>``suffix``<P>``prefix``<M>``middle, the others into
    ``<P>``prefix``<S>``suffix``<M>``middle.

    Null text is empty; an empty text, and one that holds a sentinel, stays plain. A missing id
    draws as the empty one. Rows that repeat come out each; an empty table gives none. Only doc_id and text are read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids = batch.column("doc_id").to_pylist()
            made = [changed(t, i, seed, percent, suffix_first) for i, t in zip(ids, _texts(batch.column("text")))]
            yield arrow(schema, [ids, *(zip(*made) if made else ((),) * 5)])

    return by_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), run, MADE)


def restore(made: DataFrame) -> DataFrame:
    """``made`` with ``restored``: the text that its ``output`` and ``form`` alone give back. Null output is empty."""
    schema = StructType([*made.schema.fields, StructField("restored", StringType())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = []
            for text, form in zip(_texts(batch.column("output")), batch.column("form").to_pylist()):
                body = bytearray(text)
                restored(body, form)
                texts.append(bytes(body))
            yield batch.append_column("restored", pa.array(texts, pa.string()))

    return by_batches(made, run, schema)


def query(spark, folder: str) -> DataFrame:
    made = fill_in_middle(table(spark, folder, "documents"))
    return restore(made).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")
    )


SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units,
         sha256(concat('42:', coalesce(doc_id::varchar, ''))) as h
  from documents
), u as (
  select doc_id, text, units, len(units)::bigint as n,
         ('0x' || substr(h, 1, 8))::bigint % (len(units) + 1) as a,
         ('0x' || substr(h, 9, 8))::bigint % (len(units) + 1) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                or ('0x' || substr(h, 17, 8))::bigint % 100 >= 50 then 'plain'
              when ('0x' || substr(h, 25, 8))::bigint % 100 < 80 then 'spm' else 'psm' end as form
  from d
), p as (
  select doc_id, text, n, form,
         coalesce(array_to_string(units[:least(a, b)], ''), '') as prefix,
         coalesce(array_to_string(units[least(a, b) + 1:greatest(a, b)], ''), '') as middle,
         coalesce(array_to_string(units[greatest(a, b) + 1:], ''), '') as suffix
  from u
)
select doc_id, n, form,
       case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text
                        when 'psm' then concat('<P>', prefix, '<S>', suffix, '<M>', middle)
                        else concat('<S>', suffix, '<P>', prefix, '<M>', middle) end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""
