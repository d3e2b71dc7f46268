"""Removal of lines that other documents hold too, with two Bloom filters.

First pass: every task hashes the keys of its lines into two filters, a bit of the first
for a place met once, of the second for a place met again.  Filters of two tasks merge as
once = a | b and twice = a.twice | b.twice | (a.once & b.once), so a key in two documents
has all its places in ``twice``, wherever these documents are read; the rest of ``twice``
is chance.  A task sends only the places it has set, by segment, and a segment is merged
in one task.

Second pass: a line whose places are not all in ``twice`` is unique.  Documents with no
other line are done where they are read.  Of the others the suspected keys (SHA-256) are
counted exactly: the smallest and largest document of a key, by partial aggregation, say
whether it repeats and which document keeps it.  Documents with suspects are stored once
and meet the decisions by their number; a hot key is looked up by a broadcast of bounded size.

Filters have ``BITS_PER_LINE`` bits a line up to ``MOST_BITS``.  More lines than that make
chance suspects more frequent, up to every line being confirmed by the shuffle: the result
stays exact, and neither driver nor task ever holds more than two filters of that size.

Defined cases: a null or empty text is one empty line, and stays as it is.  Rows that
share an id are one document: all of them keep the lines that the id keeps.  Rows without
an id count as one document that comes after all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.llm.common import begin, lookup, pick, plain, position, text_slices, tidy, without
from tallyspan.session import store_and_reload

LEAST_KEY = 10
PLACES = 4
BITS_PER_LINE = 12
SEGMENT_BITS = 1 << 16
MOST_BITS = 1 << 28
BLANK = " \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1  # the id of rows without one


def key_of(line: str) -> bytes | None:
    """The key of a line, None where it is too short to count."""
    line = line.strip(BLANK)
    return line.encode("utf-8", "surrogatepass").lower() if len(line) >= LEAST_KEY else None


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """[key, place] of 64-bit hashes in a filter of ``bits``: double hashing."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    base = hashes * np.uint64(0x9E3779B97F4A7C15)
    at = base[:, None] + step[:, None] * np.arange(PLACES, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return ((at >> np.uint64(20)) % np.uint64(bits)).astype(np.int64)


def hashes_of(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def merge(once: np.ndarray, twice: np.ndarray, other_once: np.ndarray, other_twice: np.ndarray) -> None:
    """Merges packed filters into the first two."""
    twice |= other_twice | (once & other_once)
    once |= other_once


def _packed(at: np.ndarray) -> bytes:
    """Positions in a segment, as positions or as a bitmap, whichever is smaller."""
    if len(at) * 2 < SEGMENT_BITS // 8:
        return at.astype(np.uint16).tobytes()
    bits = np.zeros(SEGMENT_BITS, np.uint8)
    bits[at] = 1
    return np.packbits(bits).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    if len(raw) == SEGMENT_BITS // 8:
        return np.frombuffer(raw, np.uint8)
    bits = np.zeros(SEGMENT_BITS, np.uint8)
    bits[np.frombuffer(raw, np.uint16)] = 1
    return np.packbits(bits)


def _filters(texts: DataFrame, bits: int) -> DataFrame:
    """(segment, once, twice) of every task, where it has set a bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("linededup")
        once = np.zeros(bits // 8, np.uint8)
        twice = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            tidy()
            for start, length in text_slices(batch.column(0)):
                keys: list[bytes] = []
                for text in batch.column(0).slice(start, length).to_pylist():
                    # A key that a document repeats counts once.
                    keys += {k for k in map(key_of, (text or "").split("\n")) if k is not None}
                at, n = np.unique(places(hashes_of(keys), bits), return_counts=True)
                byte, bit = at >> 3, (128 >> (at & 7)).astype(np.uint8)
                again = (n > 1) | ((once[byte] & bit) > 0)
                np.bitwise_or.at(twice, byte[again], bit[again])
                np.bitwise_or.at(once, byte, bit)
        segments, packed = [], ([], [])
        for segment in range(bits // SEGMENT_BITS):
            part = slice(segment * SEGMENT_BITS // 8, (segment + 1) * SEGMENT_BITS // 8)
            if once[part].any():
                segments.append(segment)
                for out, bitmap in zip(packed, (once, twice)):
                    out.append(_packed(np.flatnonzero(np.unpackbits(bitmap[part]))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(segments, pa.int32()), *[pa.array(x, pa.binary()) for x in packed]],
            names=["segment", "once", "twice"],
        )

    return texts.mapInArrow(run, "segment int, once binary, twice binary")


def repeated_filter(texts: DataFrame, bits: int) -> np.ndarray:
    """The packed ``twice`` filter of one column of texts, at most ``MOST_BITS`` bits."""

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("linededup")
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            tidy()
            for segment, once, twice in zip(batch["segment"], batch["once"], batch["twice"]):
                if segment not in held:
                    held[segment] = [np.zeros(SEGMENT_BITS // 8, np.uint8) for _ in range(2)]
                merge(*held[segment], _unpacked(once), _unpacked(twice))
        some = [(s, t.tobytes()) for s, (_, t) in held.items() if t.any()]
        yield pd.DataFrame(some, columns=["segment", "twice"])

    parts = _filters(texts, bits).repartition("segment").mapInPandas(merged, "segment int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.collect():
        out[row.segment * SEGMENT_BITS // 8 : (row.segment + 1) * SEGMENT_BITS // 8] = np.frombuffer(row.twice, np.uint8)
    return out


def _suspects(rows: DataFrame, twice, bits: int) -> DataFrame:
    """``_n_lines`` and ``_suspects``, the digests of the suspected lines in the order of the lines
    (null: none; an empty digest: a line that stays)."""
    added = [T.StructField("_n_lines", T.LongType()), T.StructField("_suspects", T.ArrayType(T.BinaryType()))]
    schema = T.StructType([*rows.schema.fields, *added])
    at_text = rows.columns.index("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("linededup")
        bitmap = np.frombuffer(twice.value, np.uint8)
        for batch in batches:
            tidy()
            for start, length in text_slices(batch.column(at_text)):
                part = batch.slice(start, length)
                lines = [(t or "").split("\n") for t in part.column(at_text).to_pylist()]
                owner = [i for i, x in enumerate(lines) for _ in x]
                keys = [key_of(line) for x in lines for line in x]
                some = [i for i, k in enumerate(keys) if k is not None]
                at = places(hashes_of([keys[i] for i in some]), bits)
                hit = ((bitmap[at >> 3] & (128 >> (at & 7))) > 0).all(axis=1)
                found: list[list[bytes] | None] = [None] * len(lines)
                first = np.cumsum([0] + [len(x) for x in lines])
                for i in np.array(some, np.int64)[hit]:
                    row = owner[i]
                    if found[row] is None:
                        found[row] = [b""] * len(lines[row])
                    found[row][i - first[row]] = hashlib.sha256(keys[i]).digest()
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([len(x) for x in lines], pa.int64()),
                        pa.array(found, pa.list_(pa.binary())),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns with the text that is left, ``n_lines`` (before) and ``n_dropped``."""
    spark = df.sparkSession
    kept = without(df, ["n_lines", "n_dropped"])
    names = [*kept.columns, "n_lines", "n_dropped"]
    at_text, at_key = position(kept, text), position(kept, key)
    rows = plain(kept).withColumnRenamed(f"c{at_text}", "_text")
    breaks = F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit("")))
    count = rows.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1)).first()[0] or 0
    bits = min(MOST_BITS, max(SEGMENT_BITS, -(-count * BITS_PER_LINE // SEGMENT_BITS) * SEGMENT_BITS))
    twice = spark.sparkContext.broadcast(repeated_filter(rows.select("_text"), bits).tobytes())

    marked = _suspects(rows, twice, bits).withColumn("_row", F.monotonically_increasing_id())
    stored = store_and_reload(marked, "lines")
    document = F.coalesce(F.col(f"c{at_key}").cast("bigint"), F.lit(LAST)).alias("_document")
    seen = stored.where("_suspects IS NOT NULL").select("_row", document, F.posexplode("_suspects").alias("_at", "_digest"))
    seen = seen.where(F.octet_length("_digest") > 0)
    repeats = store_and_reload(
        seen.groupBy("_digest")
        .agg(F.min("_document").alias("_first"), F.max("_document").alias("_last"), F.count("*").alias("_n"))
        .where("_first < _last")
        .drop("_last"),
        "repeats",
    )
    looked = lookup(seen, repeats, "_digest", "_n").where("_document > _first")
    gone = looked.groupBy("_row").agg(F.collect_list("_at").alias("_gone"))

    clean = stored.where("_suspects IS NULL").drop("_suspects", "_row")
    affected = stored.where("_suspects IS NOT NULL").drop("_suspects").join(gone, "_row", "left").drop("_row")
    out = clean.withColumn("_n_dropped", F.lit(0).cast("bigint")).unionByName(_without(affected))
    order = ["_text" if i == at_text else f"c{i}" for i in range(len(kept.columns))]
    return out.select(*order, "_n_lines", "_n_dropped").toDF(*names)


def _without(affected: DataFrame) -> DataFrame:
    """The texts without the lines whose numbers are in ``_gone``, which becomes ``_n_dropped``."""
    kept = [f for f in affected.schema.fields if f.name != "_gone"]
    schema = T.StructType([*kept, T.StructField("_n_dropped", T.LongType())])
    at_text, at_gone = affected.columns.index("_text"), affected.columns.index("_gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("linededup")
        for batch in batches:
            tidy()
            for start, length in text_slices(batch.column(at_text)):
                part = batch.slice(start, length)
                texts, dropped = part.column(at_text).to_pylist(), []
                for i, gone in enumerate(part.column(at_gone).to_pylist()):
                    if gone:
                        out = set(gone)
                        texts[i] = "\n".join([x for at, x in enumerate(texts[i].split("\n")) if at not in out])
                    dropped.append(len(gone or ()))
                columns = list(part.columns)
                columns[at_text] = pa.array(texts, pa.string())
                del columns[at_gone]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(dropped, pa.int64())], names=schema.names)

    return affected.mapInArrow(run, schema)


def op8(documents: DataFrame) -> DataFrame:
    """The rows of the contract."""
    found = dedup_lines(pick(documents, doc_id="doc_id", text="text"))
    text = F.coalesce("text", F.lit("")).cast("binary")
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


ORACLE = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce("text", ''), chr(10)) AS lines FROM documents
), cut AS (
  SELECT r, doc_id, generate_subscripts(lines, 1) AS place, unnest(lines) AS line FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM cut
), repeated AS (
  SELECT line_key, min(doc_id) AS first_id FROM keyed
  WHERE length(line_key) >= 10 GROUP BY line_key HAVING count(DISTINCT doc_id) > 1
), judged AS (
  SELECT k.*, coalesce(k.doc_id > first_id, false) AS gone FROM keyed k LEFT JOIN repeated USING (line_key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""
