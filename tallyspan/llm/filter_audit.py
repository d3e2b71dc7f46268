"""Which filter removes what, in every order: an audit of interacting filters.

Each document gets a mask of the filters that it fails.  Four of them are functions of its text.
The fifth one, E, asks whether a smaller id has the same text, which radix tries answer.

1. Every task inserts its texts, some megabytes at a time, into a compressed trie.  A
   row above the smallest id of its terminal is a repeat.  Of the others one per
   terminal, with its text, is a candidate, so a text goes on about once a task, however many rows
   hold it.
2. The candidates are range-partitioned by adaptive prefixes: a prefix of 16 code points, where
   that is heavy of 128, where that is heavy too of 1024, then by the text's hash.  So texts that begin
   alike are together unless there are too many of them, and equal texts are together always.
   Each partition inserts its whole texts into a trie with the smallest id at the terminals,
   and a walk over these tells which candidates repeat a smaller id.
3. A text with more than ``HOT_COPIES`` candidates is dealt over salts; what is left of each salt
   goes through a second trie.

Rows become counts per (id, part, mask), labels join these, and counts per (part, mask, labels) are all
that the orders need: a filter's step is decided by the bits of a mask.

Defined cases: null texts are empty; a row without an id neither repeats another one nor makes one a
repeat; rows with the same id and text do not repeat one another; a null ``lang`` is the part
"" (that of an empty one as well); an id with several labels is good or toxic if one of them
says so; labels without a document, or without an id, have no part; an empty table gives no rows;
other columns, whatever their names, have no part in the result.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import begin, pick, text_slices, tidy
from tallyspan.llm.radix import RadixTrie
from tallyspan.session import store_and_reload

FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")
PREFIXES = (16, 128, 1024)  # code points
HEAVY_SHARE = 2048  # at most so many prefixes of a length are heavy
RANGE_BYTES = 48 << 20
HOT_COPIES = 1000
SLICE = 8 << 20
KNOWN_TEXTS = 100_000


def text_mask(text: Column) -> Column:
    """Bits of the filters that a text fails by itself: A few words, B few different words,
    C capitals, D symbols."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    capitals = F.length(text) - F.length(F.translate(text, string.ascii_uppercase, ""))
    counted = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("different")))[0]
    fails = [
        counted["all"] < 200,
        100 * counted["different"] < 50 * counted["all"],
        100 * capitals > 3 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(f, 1 << bit).otherwise(0) for bit, f in enumerate(fails)), F.lit(0))


def _reduced(rows: DataFrame) -> DataFrame:
    """Per row (row, doc_id, part, mask): ``again`` (a smaller id of the task has the text),
    ``candidate`` (the row that stands for it, if it may be the smallest), and the text of
    rows that stand for others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("filter_audit")
        known: dict[bytes, int] = {}  # smallest id of the task's texts so far, by digest
        for batch in batches:
            tidy()
            for start, length in text_slices(batch.column(4), SLICE):
                part = batch.slice(start, length)
                ids, texts = part.column(1).to_pylist(), part.column(4).to_pylist()
                trie, number = RadixTrie(), part.column(0).to_pylist()
                for i, (key, text) in enumerate(zip(ids, texts)):
                    if key is not None:
                        trie.insert(text, key, i)
                again, candidate, sent = [False] * length, [None] * length, [None] * length
                for end in trie.terminals():
                    first = next(i for i in end.rows if ids[i] == end.least)
                    digest = hashlib.blake2b(texts[first], digest_size=16).digest()
                    before = known.get(digest)
                    if before is None or end.least < before:
                        if len(known) >= KNOWN_TEXTS:
                            known.clear()
                        known[digest] = end.least
                    if before is None or end.least <= before:
                        sent[first] = texts[first]
                    for i in end.rows:
                        again[i] = ids[i] > end.least or (before is not None and ids[i] > before)
                        if not again[i]:
                            candidate[i] = number[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(i) for i in range(4)],
                        pa.array(again, pa.bool_()),
                        pa.array(candidate, pa.int64()),
                        pa.array(sent, pa.binary()),
                    ],
                    names=["row", "doc_id", "part", "mask", "again", "candidate", "text"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {kind}, part string, mask int, again boolean, candidate bigint, text binary"
    return rows.select("row", "doc_id", "part", "mask", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _tries(rows: DataFrame) -> DataFrame:
    """Per row (row, doc_id, text, hot; equal texts of a salt are together): ``stands``, the
    row that stands for its text, and ``least``, the smallest id of the text.  Where ``hot``,
    the row that stands for others keeps its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("filter_audit")
        trie, number, ids, hot = RadixTrie(), [], [], {}
        for batch in batches:
            tidy()
            for row, key, text, is_hot in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                end = trie.insert(text, key, len(number))
                if is_hot and len(end.rows) == 1:
                    hot[len(number)] = text
                number.append(row)
                ids.append(key)
        stands, least, sent = [0] * len(number), [None] * len(number), [None] * len(number)
        for end in trie.terminals():
            for i in end.rows:
                stands[i], least[i] = number[end.rows[0]], end.least
            sent[end.rows[0]] = hot.get(end.rows[0])
        for start in range(0, len(number), 2000):
            at = slice(start, start + 2000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number[at], pa.int64()),
                    pa.array(ids[at], pa.int64()),
                    pa.array(stands[at], pa.int64()),
                    pa.array(least[at], pa.int64()),
                    pa.array(sent[at], pa.binary()),
                ],
                names=["row", "doc_id", "stands", "least", "text"],
            )

    schema = "row bigint, doc_id bigint, stands bigint, least bigint, text binary"
    return rows.select("row", "doc_id", "text", "hot").mapInArrow(run, schema)


def _prefixed(rows: DataFrame, total: int) -> DataFrame:
    """Adds ``prefix``, longer where many bytes begin alike."""
    named = rows.withColumn("string", F.col("text").cast("string"))
    named = named.withColumn("prefix", F.substring("string", 1, PREFIXES[0]))
    for longer in (*PREFIXES[1:], None):
        sums = named.groupBy("prefix").agg(F.sum("size").alias("_bytes"))
        # Fewer than HEAVY_SHARE prefixes have such a share, and each has at most 1024 code points.
        many = sums.where((F.col("_bytes") > RANGE_BYTES) & (F.col("_bytes") * HEAVY_SHARE > total))
        found = [r.prefix for r in many.select("prefix").collect()]
        if not found:
            break
        table = rows.sparkSession.createDataFrame([(p, True) for p in found], "prefix string, _many boolean")
        named = named.join(F.broadcast(table), "prefix", "left")
        prefix = F.substring("string", 1, longer) if longer else F.concat("prefix", F.hex("hash"))
        named = named.withColumn("prefix", F.when(F.col("_many"), prefix).otherwise(F.col("prefix"))).drop("_many")
    return named.drop("string")


def repeats(candidates: DataFrame) -> DataFrame:
    """(row, again): whether a smaller id has a candidate's text.  ``candidates``: row,
    doc_id, text, stored; equal texts come about once a task."""
    spark = candidates.sparkSession
    sized = candidates.withColumn("hash", F.xxhash64("text")).withColumn("size", F.octet_length("text") + 32)
    total = sized.agg(F.sum("size")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    copies = sized.groupBy("hash").agg(F.count("*").alias("_copies")).where(F.col("_copies") > HOT_COPIES)
    salts = store_and_reload(copies.select("hash", F.ceil(F.col("_copies") / HOT_COPIES).alias("_salts")), "salts")
    salted = not salts.isEmpty()
    dealt = _prefixed(sized, total)
    if salted:
        dealt = dealt.join(salts, "hash", "left")
        salt = F.coalesce(F.pmod(F.xxhash64("row"), F.col("_salts")), F.lit(0))
        dealt = dealt.withColumn("salt", salt).withColumn("hot", F.col("_salts").isNotNull())
    else:
        dealt = dealt.withColumn("salt", F.lit(0)).withColumn("hot", F.lit(False))
    first = _tries(dealt.repartitionByRange(parts, "prefix", "hash", "salt"))
    if not salted:
        return first.select("row", (F.col("doc_id") > F.col("least")).alias("again"))
    first = store_and_reload(first, "tries")
    left = first.where("text IS NOT NULL").select("row", F.col("least").alias("doc_id"), "text", F.lit(False).alias("hot"))
    more = left.withColumn("hash", F.xxhash64("text"))
    second = _tries(more.repartitionByRange(parts, F.substring(F.col("text").cast("string"), 1, PREFIXES[0]), "hash"))
    second = second.select(F.col("row").alias("stands"), F.col("least").alias("of_all"))
    joined = first.drop("text").join(second, "stands", "left")
    return joined.select("row", (F.col("doc_id") > F.coalesce("of_all", "least")).alias("again"))


def masks(df: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, mask, n): how many rows of an id and part fail which filters."""
    rows = pick(df, doc_id=key, text=text, part=part).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("part", F.lit("")).alias("part"),
    )
    judged = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "part", text_mask(F.col("text")).cast("int").alias("mask"), "text"
    )
    stored = store_and_reload(_reduced(judged), "reduced")
    found = repeats(stored.where("text IS NOT NULL").select("row", "doc_id", "text"))
    found = found.select(F.col("row").alias("candidate"), F.col("again").alias("_later"))
    narrow = stored.select("doc_id", "part", "mask", "again", "candidate")
    sure = narrow.where("candidate IS NULL").drop("candidate")
    open_rows = narrow.where("candidate IS NOT NULL").drop("again").join(found, "candidate")
    both = sure.unionByName(open_rows.select("doc_id", "part", "mask", F.col("_later").alias("again")))
    mask = (F.col("mask") + F.when(F.col("again"), REPEAT).otherwise(0)).alias("mask")
    return both.select("doc_id", "part", mask).groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))


def label_counts(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n); ``labels``: doc_id, quality, toxic."""
    of = pick(labels, doc_id="doc_id", quality="quality", toxic="toxic").where("doc_id IS NOT NULL")
    flags = of.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    joined = counted.join(flags, "doc_id", "left")
    named = joined.select("part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")
    return named.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def orders_report(counts: DataFrame) -> DataFrame:
    """A row per part, order and step; ``counts``: part, mask, good, toxic, n (stored).  Each part
    has at most 128 rows of counts, which meet 600 steps."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def bit(step: int | str) -> Column:
        return F.expr(f"shiftleft(1, ascii(substr(filter_order, {step}, 1)) - ascii('{FILTERS[0]}'))")

    earlier = sum((F.when(F.col("step") > j, bit(j)).otherwise(0) for j in range(1, len(FILTERS))), F.lit(0))
    steps = steps.withColumn("_bit", bit("step")).withColumn("_before", earlier)
    fails = F.col("mask").bitwiseAND(F.col("_bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("_before")) != 0

    def total(condition: Column, value: Column | None = None) -> Column:
        return F.sum(F.when(condition, F.col("n") if value is None else value).otherwise(0)).cast("bigint")

    # Over all orders a document is removed by each of the filters that it fails equally often.
    share = F.floor(F.lit(120) / F.greatest(F.bit_count("mask"), F.lit(1))) * F.col("n")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails).alias("kept"),
        total(~gone & fails).alias("removed"),
        total(gone & fails).alias("redundant"),
        total(F.col("mask") == F.col("_bit")).alias("unique_fails"),
        total(~gone & fails & F.col("good")).alias("good_lost"),
        total(~gone & fails & F.col("toxic")).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What every filter removes in every order, per language."""
    return orders_report(store_and_reload(label_counts(masks(docs), labels), "counts"))


def op12(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(docs, labels)


ORACLE = """
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce("text", '') AS body FROM documents
), cut AS (
  SELECT *, list_filter(string_split_regex(body, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
         min(doc_id) OVER (PARTITION BY body) AS first_id
  FROM docs
), flags AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         [len(words) < 200,
          100 * len(list_distinct(words)) < 50 * len(words),
          100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 3 * length(body),
          regexp_matches(body, '[#$%&*|]'),
          coalesce(doc_id > first_id, false)] AS failing
  FROM cut LEFT JOIN flags USING (doc_id)
), counts AS (
  SELECT part, good, toxic, failing, count(*) AS n,
         len(list_filter(failing, lambda f: f)) AS failed FROM judged GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 3, 4, 5]) AS at
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.at, b.at, c.at, d.at, e.at] AS places
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.at, b.at, c.at, d.at, e.at])) = 5
), steps AS (
  SELECT filter_order, step, places[step] AS place, places[1:step - 1] AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), met AS (
  SELECT part, filter_order, step, n, good, toxic, failed, failing[place] AS fails,
         len(list_filter(before, lambda p: failing[p])) > 0 AS gone
  FROM counts, steps
)
SELECT part, filter_order, step,
       CAST(sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN fails AND failed = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN NOT gone AND fails AND good = 1 THEN n ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN NOT gone AND fails AND toxic = 1 THEN n ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN fails THEN n * 120 // failed ELSE 0 END) AS BIGINT) AS shapley
FROM met GROUP BY part, filter_order, step
"""
