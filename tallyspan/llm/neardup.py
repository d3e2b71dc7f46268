"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A text's elements are its distinct runs of five words.  It has two signatures: one with weights
1 + ln(count), one with unit weights, whose probability Jaccard is the Jaccard similarity of
the sets, which is what a link is defined by.  Every
element is a Poisson process of its weight's rate, a function of the element alone: its
arrivals have exponential gaps and each falls into one of ``COMPONENTS`` components.  A component
keeps the element of the earliest arrival.  Two texts agree in a component with a
probability equal to their probability Jaccard similarity.  The elements of a batch of
texts arrive together, round by round; one whose next arrival is later than the latest
component of its text can change nothing more and stops.

Banding: bands of some components of each signature (one list for a text whose runs
repeat equally often, as both are the same), as many and as long as the threshold asks for (``Plan``): a pair whose
sets are just as similar shares no
band with a probability below 1e-5, whatever its counts.  Verification: the exact Jaccard similarity of the two sets of
runs, at least ``threshold``.  A class is a connected component of verified links.

A bucket (texts that share a band) is not expanded into all its pairs.  First every text is
verified against the centre of each of its buckets, the text that shares most bands with
others, as the source of many copies does; the links give components.  A bucket that lies in one
component has nothing more to add.  In the others only pairs from different components are left, and
most of these are ruled out by what each text has to itself: its runs that no other text of
such buckets holds.  With a share of more than 1 - t of them (t the threshold) a text has no link, and
of two texts with more than (1 - t) / (1 + t) each, neither has one with the other.  So the copies of a
template that each of them has changed too much, in places of its own, are not compared with one another,
however many they are.  The texts outside a bucket's main component with a smaller share meet the bucket
inside the join, and those with a larger share meet its texts with a smaller one.  The join lets a pair through
only in the smallest band that it shares, and only if its sketches (``SKETCH_BITS`` bits of each component
of the unit-weight signature) agree in so many components as a similar pair does but with a probability below 1e-5.
So no link between texts of a shared band is lost but for that chance.  Last, the runs that a text does not have
to itself are counted in ``PARTS`` parts by their hashes.  Two texts have at most the smaller count of each part in
common, so a pair for which that is too little has no link for certain: the copies of a template
that have each changed it a little too much in places of their own do not reach the verification.

Equal texts are one text from the start.  No text is shuffled: the sets of runs are read
from the texts that take part in a candidate pair, found by a Bloom filter of bounded size
(chance hits are dropped by the join on the digest).

Defined cases: null texts, empty texts and texts of blanks have no runs, so only equal
ones (null counts as empty) are one class.  A class's id is its smallest document id,
null only if none of its rows has one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import WORDS as known_words
from tallyspan.llm.common import begin, lookup, pick, plain, position, shingles, text_slices, tidy, weighted
from tallyspan.llm.components import components
from tallyspan.session import store_and_reload

WORDS = 5
THRESHOLD = 0.8
COMPONENTS = 480  # the sketches take all of them
BANDED = 240  # the bands the first of them
MISSED = 1e-5
SKETCH_BITS = 4
SKETCH_WORDS = 8  # per bit, of 60 components each
DEVIATIONS = 4.5
PARTS = 1024
MOST_IN_PART = 4
ROUNDING = 1e-9
FILTER_BITS_PER_TEXT = 16
MOST_FILTER_BITS = 1 << 28
FILTER_PLACES = 4
UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)
LOW = np.uint64(0xFFFFFFFF)
BAND_MULTIPLIERS = np.random.default_rng(9).integers(1, 1 << 63, BANDED, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Plan:
    """What a threshold asks for: the longest bands that miss a pair just as similar with a chance
    of ``MISSED`` at most, the components in which such a pair's sketches agree less
    ``DEVIATIONS`` standard deviations, and the shares of own runs that rule out links."""

    threshold: float
    bands: int
    rows: int
    least_agreement: int

    @classmethod
    def of(cls, threshold: float) -> Plan:
        def enough(rows: int) -> bool:
            return (1 - threshold**rows) ** (BANDED // rows) <= MISSED

        fitting = [rows for rows in range(1, BANDED + 1) if 0 < threshold < 1 and enough(rows)]
        if not fitting:
            raise ValueError(f"the signatures have too few components for a threshold of {threshold}")
        agree = threshold + (1 - threshold) / 2**SKETCH_BITS
        spread = DEVIATIONS * math.sqrt(COMPONENTS * agree * (1 - agree))
        return cls(threshold, BANDED // max(fitting), max(fitting), int(COMPONENTS * agree - spread))

    @property
    def most_own(self) -> float:
        """No text with a larger share of own runs has a link."""
        return 1 - self.threshold + ROUNDING

    @property
    def light(self) -> float:
        """Of two texts with a larger share each, neither has a link with the other."""
        return (1 - self.threshold) / (1 + self.threshold) + ROUNDING


def _arrivals(elements: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Exponential gap (rate 1) and component of the arrival with this number."""
    x = elements + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    gap = -np.log(((x >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) / np.float32(1 << 24))
    return gap, (((x & LOW) * np.uint64(COMPONENTS)) >> np.uint64(32)).astype(np.int64)


def signatures(elements: np.ndarray, owners: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """[text, component]: lower half of the first element to arrive; ``UNSET`` for a text
    without elements.  Rows of (owner, element) are distinct."""
    best = np.full(texts * COMPONENTS, UNSET)
    view = best.reshape(texts, COMPONENTS)
    name = elements & LOW
    rate = weights.astype(np.float32)
    at = np.zeros(len(elements), np.float32)
    owner, number = owners, 0
    while len(elements):
        gap, component = _arrivals(elements, number)
        at = at + gap / rate
        packed = (at.view(np.uint32).astype(np.uint64) << np.uint64(32)) | name
        np.minimum.at(best, owner * COMPONENTS + component, packed)
        number += 1
        # Early termination, by the latest component of each text that is still active.
        active = np.unique(owner)
        limit = np.zeros(texts, np.uint64)
        limit[active] = view[active].max(axis=1)
        go = packed <= limit[owner]
        elements, owner, name, rate, at = elements[go], owner[go], name[go], rate[go], at[go]
    return np.where(view == UNSET, UNSET, view & LOW)


def bands(signature: np.ndarray, plan: Plan) -> np.ndarray:
    """[text, band]: a 64-bit hash of the band's number and components."""
    parts = signature[:, : plan.bands * plan.rows].reshape(len(signature), plan.bands, plan.rows)
    key = (parts * BAND_MULTIPLIERS[: plan.rows]).sum(axis=2, dtype=np.uint64) + np.arange(plan.bands, dtype=np.uint64)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (key ^ (key >> np.uint64(32))).view(np.int64)


def sketches(signature: np.ndarray) -> np.ndarray:
    """[text, word]: bit planes of the components, ``SKETCH_WORDS`` words for each bit."""
    mixed = (signature ^ (signature >> np.uint64(13))) * np.uint64(0x9E3779B97F4A7C15)
    parts = (mixed >> np.uint64(64 - SKETCH_BITS)).reshape(len(signature), SKETCH_WORDS, -1)
    places = np.arange(parts.shape[2], dtype=np.uint64)
    planes = [(((parts >> np.uint64(b)) & np.uint64(1)) << places).sum(axis=2, dtype=np.uint64) for b in range(SKETCH_BITS)]
    return np.concatenate(planes, axis=1).view(np.int64)


def _agreement(a, b):
    """In how many components two sketches agree."""
    differ = F.lit(0)
    for word in range(SKETCH_WORDS):
        planes = [F.get(a, p * SKETCH_WORDS + word).bitwiseXOR(F.get(b, p * SKETCH_WORDS + word)) for p in range(SKETCH_BITS)]
        differ = differ + F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), planes))
    return F.lit(COMPONENTS) - differ


def _digest(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()


def _signed(rows: DataFrame, plan: Plan) -> DataFrame:
    """(id, digest, bands, sketch) of rows (id, text); no bands without a run of words.  The
    bands are those of both signatures, equal ones once; the sketch is of unit weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("neardup", known_words.clear)
        for batch in batches:
            tidy()
            for start, length in text_slices(batch.column(1), 2 << 20):
                part = batch.slice(start, length)
                texts = [t or "" for t in part.column(1).to_pylist()]
                value, owner, count = weighted(*shingles(texts, WORDS))
                signature = signatures(value, owner, np.ones(len(count)), length)
                keys, planes = np.tile(bands(signature, plan), 2), sketches(signature)
                taken = np.zeros(keys.shape, bool)
                taken[np.unique(owner), : plan.bands] = True
                # Weights change the signature only of a text whose runs repeat unequally.
                uneven = np.unique(owner[count != count[np.searchsorted(owner, owner)]])
                of = np.isin(owner, uneven)
                at = np.searchsorted(uneven, owner[of])
                keys[uneven, plan.bands :] = bands(signatures(value[of], at, 1 + np.log(count[of]), len(uneven)), plan)
                taken[uneven, plan.bands :] = keys[uneven, plan.bands :] != keys[uneven, : plan.bands]
                offsets = np.concatenate([[0], np.cumsum(taken.sum(axis=1))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(keys[taken], pa.int64()))
                words = np.arange(length + 1, dtype=np.int32) * planes.shape[1]
                sketch = pa.ListArray.from_arrays(words, pa.array(planes.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(_digest, texts), pa.binary()), lists, sketch],
                    names=["id", "digest", "bands", "sketch"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, digest binary, bands array<bigint>, sketch array<bigint>")


def _filter_places(digests: np.ndarray, bits: int) -> np.ndarray:
    """[digest, place]: the first four eights of the digest, each modulo ``bits``."""
    return (digests.reshape(-1, 32).view("<u8")[:, :FILTER_PLACES] % np.uint64(bits)).astype(np.int64)


def _run_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, runs): the sorted distinct runs of the texts whose digests are in ``wanted``
    (node, digest; stored)."""
    spark = rows.sparkSession
    bits = min(MOST_FILTER_BITS, max(1 << 16, wanted.count() * FILTER_BITS_PER_TEXT))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("neardup", known_words.clear)
        found = [np.zeros(0, np.int64)]
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8)
            found.append(np.unique(_filter_places(raw, bits)))
        at = np.unique(np.concatenate(found))
        segment = at >> 16
        cuts = np.flatnonzero(np.diff(segment, prepend=-1))
        groups = np.split((at & 0xFFFF).astype(np.uint16), cuts[1:]) if len(cuts) else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(segment[cuts], pa.int64()), pa.array([g.tobytes() for g in groups], pa.binary())],
            names=["segment", "places"],
        )

    bitmap = np.zeros(-(-bits // 8), np.uint8)
    for row in wanted.select("digest").mapInArrow(build, "segment bigint, places binary").collect():
        at = (row.segment << 16) + np.frombuffer(row.places, np.uint16).astype(np.int64)
        np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))
    sent = spark.sparkContext.broadcast(bitmap.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("neardup", known_words.clear)
        filled = np.frombuffer(sent.value, np.uint8)
        done: set[bytes] = set()  # copies inside a task are read once
        for batch in batches:
            tidy()
            for start, length in text_slices(batch.column(1), 2 << 20):
                texts = [t or "" for t in batch.column(1).slice(start, length).to_pylist()]
                digests = list(map(_digest, texts))
                at = _filter_places(np.frombuffer(b"".join(digests), np.uint8), bits)
                hit = ((filled[at >> 3] >> (at & 7)) & 1).all(axis=1)
                chosen: dict[bytes, str] = {}
                for i in np.flatnonzero(hit):
                    if digests[i] not in done:
                        chosen[digests[i]] = texts[i]
                done.update(chosen)
                value, owner, _ = weighted(*shingles(list(chosen.values()), WORDS))
                offsets = np.searchsorted(owner, np.arange(len(chosen) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(chosen), pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(value.view(np.int64), pa.int64())),
                    ],
                    names=["digest", "runs"],
                )

    found = rows.mapInArrow(run, "digest binary, runs array<bigint>")
    return found.join(wanted, "digest").groupBy("node").agg(F.first("runs").alias("runs"))


def _verified(pairs: DataFrame, rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of texts whose sets of runs are similar enough."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = store_and_reload(texts.select("node", "digest").join(nodes, "node", "left_semi"), "wanted")
    sets = store_and_reload(_run_sets(rows, wanted), "runs")
    sized = sets.select("node", "runs", F.size("runs").alias("n"))
    left = sized.select(F.col("node").alias("a"), F.col("runs").alias("of_a"), F.col("n").alias("n_a"))
    right = sized.select(F.col("node").alias("b"), F.col("runs").alias("of_b"), F.col("n").alias("n_b"))
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    # Sizes alone exclude most of what is not similar: common <= smaller, union >= larger.
    sizes = pairs.join(sized.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
    sizes = sizes.join(sized.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b").where(small >= threshold * large)
    both = sizes.select("a", "b").join(left, "a").join(right, "b")
    return both.where(common >= threshold * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")


def _shared(texts: DataFrame) -> DataFrame:
    """(band, node, n): a row per text and band that it shares with n - 1 others."""
    every = texts.select("node", F.explode("bands").alias("band"))
    sizes = store_and_reload(every.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    return store_and_reload(lookup(every, sizes.withColumn("_weight", F.col("n")), "band", "_weight"), "shared")


def _centres(shared: DataFrame) -> DataFrame:
    """(band, centre, n): of each bucket the text whose bands have most texts in all."""
    known = shared.groupBy("node").agg(F.sum("n").alias("known"))
    best = F.max(F.struct("known", (-F.col("node")).alias("last")))
    ranked = shared.join(known, "node").groupBy("band").agg(best.alias("best"), F.count("*").alias("n"))
    return store_and_reload(ranked.select("band", (-F.col("best.last")).alias("centre"), "n"), "centres")


def _labelled(rows: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """All rows (id, digest), and the different texts (digest, copies, node, least_id,
    label) with the label of their class; ``rows``: id, text."""
    plan = Plan.of(threshold)
    stored = store_and_reload(_signed(rows, plan).withColumn("node", F.monotonically_increasing_id()), "signatures")
    first = stored.groupBy("digest").agg(
        F.min("node").alias("node"), F.min("id").alias("least_id"), F.count("*").alias("copies")
    )
    distinct = store_and_reload(first, "texts")
    texts = store_and_reload(stored.drop("id").join(distinct.select("node"), "node", "left_semi"), "nodes")

    shared = _shared(texts)
    pairs = lookup(shared.select("band", "node"), _centres(shared), "band", "n").where("node <> centre")
    pairs = pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    near = F.col("agreement") >= plan.least_agreement
    sketch = texts.select("node", "sketch")
    judged = pairs.join(sketch.toDF("a", "of_a"), "a").join(sketch.toDF("b", "of_b"), "b")
    judged = judged.select("a", "b", _agreement(F.col("of_a"), F.col("of_b")).alias("agreement"))
    tested = store_and_reload(judged.where(near).select("a", "b"), "pairs")
    links = store_and_reload(_verified(tested, rows, texts, threshold), "links")

    rest = _across(shared, rows, texts, components(links), plan).join(tested, ["a", "b"], "left_anti")
    more = _verified(store_and_reload(rest, "pairs"), rows, texts, threshold)
    label = store_and_reload(components(links.unionByName(more)), "labels")

    named = distinct.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return stored.select("id", "digest"), store_and_reload(named, "labelled")


def similar_classes(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: key, class_id (the smallest key of the class), class_texts
    (how many different texts the class has)."""
    rows, labelled = _labelled(pick(df, id=key, text=text), threshold)
    # Classes of different texts first, then of all rows.
    found = labelled.groupBy("label").agg(F.min("least_id").alias("class_id"), F.count("*").alias("class_texts"))
    classes = store_and_reload(found.withColumn("_n", F.col("class_texts")), "classes")
    of_text = lookup(labelled.select("digest", "copies", "label"), classes, "label", "_n").drop("label")
    per_text = store_and_reload(of_text, "classes")
    return lookup(rows, per_text, "digest", "copies").select(F.col("id").alias(key), "class_id", "class_texts")


def first_of_classes(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that stay when one of each class does: the one with the smallest
    key (a row without a key only if no row of the class has one); of rows that
    repeat both key and text, one."""
    _, labelled = _labelled(pick(df, id=key, text=text), threshold)
    order = F.struct(F.col("least_id").isNull().alias("unknown"), "least_id", "node", "digest")
    first = labelled.groupBy("label").agg(F.min(order).alias("first"))
    same = [F.coalesce(F.col("first.least_id").cast("string"), F.lit("")), F.col("first.unknown"), F.col("first.digest")]
    kept = store_and_reload(first.select(*[c.alias(n) for c, n in zip(same, ("k0", "k1", "k2"))]), "kept")
    at_key, at_text = f"c{position(df, key)}", F.coalesce(f"c{position(df, text)}", F.lit(""))
    own = [
        F.coalesce(F.col(at_key).cast("string"), F.lit("")),
        F.col(at_key).isNull(),
        F.unhex(F.sha2(at_text.cast("binary"), 256)),
    ]
    rows = plain(df).withColumns({n: c for c, n in zip(own, ("k0", "k1", "k2"))})
    found = rows.join(kept, ["k0", "k1", "k2"], "left_semi").dropDuplicates(["k0", "k1", "k2"])
    return found.drop("k0", "k1", "k2").toDF(*df.columns)


def _own_shares(nodes: DataFrame, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, own, runs, parts, rest): the share of a text's runs that none of the other ``nodes``
    has, the number of its runs, and of the others how many are in each of ``PARTS`` parts, up to
    ``MOST_IN_PART`` (as many planes of bits, plane p for parts with more than p), and how many beyond."""
    wanted = store_and_reload(texts.select("node", "digest").join(nodes, "node", "left_semi"), "wanted")
    sets = store_and_reload(_run_sets(rows, wanted), "runs")
    runs = sets.select("node", F.explode("runs").alias("run")).groupBy("run")
    alone = runs.agg(F.min("node").alias("node"), F.count("*").alias("_n")).where("_n = 1")
    counted = alone.groupBy("node").agg(F.collect_list("run").alias("_alone"))
    others = F.array_except("runs", F.coalesce("_alone", F.array().cast("array<bigint>")))
    known = sets.join(counted, "node", "left").select("node", F.size("runs").alias("runs"), others.alias("others"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.num_rows, batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            at = lists.flatten().to_numpy().view(np.uint64) % np.uint64(PARTS)
            at = at.astype(np.int64) + np.repeat(np.arange(texts) * PARTS, sizes)
            parts = np.bincount(at, minlength=texts * PARTS).reshape(texts, 1, PARTS)
            more = parts > np.arange(MOST_IN_PART)[:, None]
            planes = np.packbits(more, axis=2).reshape(texts, -1).view(np.int64)
            offsets = pa.array(np.arange(texts + 1, dtype=np.int32) * planes.shape[1])
            size = batch.column(1).to_numpy()
            columns = [
                batch.column(0),
                pa.array((size - sizes) / size, pa.float64()),
                batch.column(1),
                pa.ListArray.from_arrays(offsets, pa.array(planes.ravel())),
                pa.array(sizes - more.sum(axis=(1, 2)), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "own", "runs", "parts", "rest"])

    return known.mapInArrow(run, "node bigint, own double, runs int, parts array<bigint>, rest bigint")


def _most_common():
    """How many runs two texts have in common at most, of which each has others."""
    both = F.zip_with("parts_a", "parts", lambda a, b: F.bit_count(a.bitwiseAND(b)))
    return F.aggregate(both, F.least("rest_a", "rest"), lambda total, count: total + count)


def _across(shared: DataFrame, rows: DataFrame, texts: DataFrame, label: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) that share a band, lie in different components and may be similar."""
    named = shared.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = store_and_reload(named.drop("n"), "named")
    mixed = named.groupBy("band").agg(F.count("*").alias("n"), F.min("label").alias("_l"), F.max("label").alias("_h"))
    mixed = store_and_reload(mixed.where("_l <> _h").select("band", "n"), "mixed")
    members = store_and_reload(lookup(named, mixed, "band", "n"), "members")
    shares = store_and_reload(_own_shares(members.select("node").distinct(), rows, texts), "own")
    linked = shares.where(F.col("own") <= plan.most_own).withColumn("light", F.col("own") <= plan.light)
    members = members.join(linked.select("node", "light"), "node")
    sizes = members.groupBy("band", "label").agg(F.count("*").alias("count"), F.count_if("light").alias("_light"))
    main = sizes.groupBy("band").agg(
        F.max_by("label", F.struct("count", "label")).alias("main"),
        F.count("*").alias("labels"),
        F.sum("count").alias("n"),
        F.sum("_light").alias("_light"),
    )
    # A bucket with links left has several components, and a text with few runs of its own.
    left = store_and_reload(main.where("labels > 1 AND _light > 0").select("band", "main", "n"), "left")
    inside = lookup(members, left, "band", "n").join(texts.select("node", "bands", "sketch"), "node")
    inside = inside.join(linked.select("node", "runs", "parts", "rest"), "node")
    inside = store_and_reload(inside, "inside")
    first_shared = F.array_min(F.array_intersect("bands", "bands_a")) == F.col("band")
    near = _agreement(F.col("sketch_a"), F.col("sketch")) >= plan.least_agreement
    enough = (1 + plan.threshold) * _most_common() >= plan.threshold * (F.col("runs_a") + F.col("runs")) - ROUNDING
    odd = inside.where("label <> main").drop("main")
    odd = odd.toDF(*[c if c == "band" else f"{c}_a" for c in odd.columns])
    once = (F.col("label") == F.col("main")) | ~F.col("light") | (F.col("node_a") < F.col("node"))
    met = [
        odd.where("light_a").join(inside, "band").where(once),
        odd.where("NOT light_a").join(inside.where("light AND label = main"), "band"),
    ]
    pairs = [m.where((F.col("label_a") != F.col("label")) & near & first_shared & enough) for m in met]
    return pairs[0].unionByName(pairs[1]).select(F.least("node_a", "node").alias("a"), F.greatest("node_a", "node").alias("b"))


def op9(documents: DataFrame) -> DataFrame:
    return similar_classes(documents)
