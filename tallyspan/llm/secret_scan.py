"""Secrets in texts: fixed patterns, and strings whose characters look random.

Candidates for the second part are runs of one character class (hexadecimal digits; the letters,
digits and signs of base 64) of at least ``WINDOW`` characters.  A window of ``WINDOW`` characters slides over a
candidate; counts per character and the sum of n log2 n over them are brought up to date
for the character that enters and the one that leaves, and give the Shannon entropy
log2(W) - sum / W.  A candidate whose largest entropy reaches its class's bound is a span,
unless it touches a span found before it.

The allow-list has two parts.  Placeholder words cut a candidate, and only what is between them is
judged, so a word like "sample" beside a random string hides nothing of it.  Patterns of harmless
strings suppress a piece that they match as a whole.

All of it is built from SQL functions, row by row: no Python on the executors and no shuffle.  Inside a
higher-order function only bound variables are used (``let``), so nothing is computed once
per element that could be computed once per row.  The work is linear in the text.

Defined cases: a null text is an empty text and has no span.  Positions count code points, the
end is exclusive.  U+0001 and U+0002 may occur in a text; they match no pattern.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import pick, plain, position, without

# The base patterns.  Runs of a least length need no check of that length.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8

WINDOW = 20
# Class: candidates, alphabet, least entropy of a window in bits.
CLASSES = {
    "entropy_hex": ("[0-9A-Fa-f]{20,}", "0123456789abcdefABCDEF", 3.0),
    "entropy_base64": ("[A-Za-z0-9+/_=-]{20,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.85),
}
# The allow-list, of whole pieces, and of words that cut a candidate into pieces.
ALLOW = (
    "^[A-Za-z_=/-]+$",  # words, paths and rules without a digit
    "^[0-9=/_+-]+$",  # numbers and dates
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
)
PLACEHOLDERS = ("example", "sample", "dummy", "placeholder", "changeme", "lorem", "abcdefgh", "01234567")
MARK, FILLER = "\x01", "\x02"
BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _ends(lengths: Column, start: Column) -> Column:
    """Running sums of a short array of lengths, from ``start``."""
    first = F.struct(start.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("ends"))

    def add(acc: Column, n: Column) -> Column:
        return F.struct((acc["at"] + n).alias("at"), F.concat(acc["ends"], F.array(acc["at"] + n)).alias("ends"))

    return F.aggregate(lengths, first, add)["ends"]


def running_ends(lengths: Column) -> Column:
    """Running sums of an array of lengths.  An array that grows by one is copied every
    time, so sums run inside blocks, from the running sums of the blocks."""

    def whole(n: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(n) - 1) / BLOCK).cast("int"))
        cut = F.transform(blocks, lambda b: F.slice(n, b * BLOCK + 1, BLOCK))
        return let(cut, by_block)

    def by_block(cut: Column) -> Column:
        sums = F.transform(cut, lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x))
        starts = let(sums, lambda s: F.concat(F.array(F.lit(0).cast("bigint")), _ends(s, F.lit(0))))
        return let(starts, lambda s: F.flatten(F.transform(cut, lambda c, i: _ends(c, F.get(s, i)))))

    return let(lengths, whole)


def _parts(text: Column, pattern: str) -> Column:
    """What is between matches (even places) and the matches (odd places)."""
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, body) of the leftmost matches that do not overlap."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,body:string>>")

    def numbered(parts: Column) -> Column:
        return let(running_ends(F.transform(parts, F.length)), lambda ends: placed(parts, ends))

    def placed(parts: Column, ends: Column) -> Column:
        def one(j: Column) -> Column:
            start, end = F.get(ends, 2 * j), F.get(ends, 2 * j + 1)
            return F.struct(start.alias("start"), end.alias("end"), F.get(parts, 2 * j + 1).alias("body"))

        return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(parts), 1) - 1), one)

    return F.when(text.rlike(pattern), let(_parts(text, pattern), numbered)).otherwise(none)


def _value_is_long(body: Column) -> Column:
    return F.length(F.regexp_extract(body, ASSIGN, 2)) >= LEAST_VALUE


def masked(text: Column, pattern: str, valid: Callable[[Column], Column] | None = None) -> Column:
    """The text with its (valid) matches overwritten, so that no other span touches them."""

    def overwrite(parts: Column) -> Column:
        def one(p: Column, i: Column) -> Column:
            hit = (i % 2 == 1) & (valid(p) if valid else F.lit(True))
            return F.when(hit, F.repeat(F.lit(FILLER), F.length(p))).otherwise(p)

        return F.array_join(F.transform(parts, one), "")

    return F.when(text.rlike(pattern), let(_parts(text, pattern), overwrite)).otherwise(text)


def largest_entropy(body: Column, alphabet: str) -> Column:
    """Largest Shannon entropy of a window of the string, whose characters are all in the
    alphabet; 0 for a string shorter than the window."""
    size, width = len(alphabet), WINDOW
    weight = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(width + 2)])

    def slide(x: Column) -> Column:
        codes, weigh = x["codes"], x["weigh"]
        start = F.struct(
            F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("peak")
        )

        def step(acc: Column, i: Column) -> Column:
            enters = F.get(codes, i)
            leaves = F.when(i >= width, F.get(codes, i - width)).otherwise(F.lit(-1))
            more, less = F.get(acc["counts"], enters), F.get(acc["counts"], leaves)
            gain = F.get(weigh, more + 1) - F.get(weigh, more)
            loss = F.when(leaves >= 0, F.get(weigh, less) - F.get(weigh, less - 1)).otherwise(F.lit(0.0))
            total = F.when(enters == leaves, acc["sum"]).otherwise(acc["sum"] + gain - loss)
            counts = F.transform(
                acc["counts"], lambda n, j: n + (j == enters).cast("int") - (j == leaves).cast("int")
            )
            moved = F.struct(counts.alias("counts"), total.alias("sum"), acc["peak"].alias("peak"))
            # Bound once: the peak needs the new sum.
            return let(
                moved,
                lambda m: F.struct(
                    m["counts"].alias("counts"),
                    m["sum"].alias("sum"),
                    F.when(i >= width - 1, F.greatest(m["peak"], F.lit(math.log2(width)) - m["sum"] / width))
                    .otherwise(m["peak"])
                    .alias("peak"),
                ),
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step)["peak"]

    codes = F.transform(F.split(body, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    bound = F.struct(codes.alias("codes"), weight.alias("weigh"))
    return F.when(F.length(body) >= width, let(bound, slide)).otherwise(F.lit(0.0))


def _labelled(found: Column, number: int, kind: str) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(number).alias("number"), m["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def random_strings(text: Column, kind: str, allow: Sequence[str], placeholders: Sequence[str]) -> Column:
    """Matches of the class's candidates that have a random enough piece which is not allowed."""
    pattern, alphabet, least = CLASSES[kind]
    allowed = "|".join(f"(?:{entry})" for entry in allow)
    cut = "(?i)" + "|".join(placeholders)

    def random(piece: Column) -> Column:
        enough = largest_entropy(piece, alphabet) >= least
        return ~piece.rlike(allowed) & enough if allow else enough

    def judged(match: Column) -> Column:
        return F.exists(F.split(match["body"], cut, -1), random) if placeholders else random(match["body"])

    return F.filter(matches(text, pattern), judged)


def find_secrets(
    df: DataFrame,
    text: str = "text",
    name: str = "secrets",
    allow: Sequence[str] = ALLOW,
    placeholders: Sequence[str] = PLACEHOLDERS,
) -> DataFrame:
    """All columns and the array of spans (start, number, end, kind), by start and then by
    the kind's number: assign, access, hex, entropy_hex, entropy_base64.  ``allow`` are patterns of
    pieces, ``placeholders`` words in any case between which pieces lie."""
    kept = without(df, [name])
    rows = plain(kept).withColumn(
        "t", F.translate(F.coalesce(F.col(f"c{position(kept, text)}"), F.lit("")), MARK, FILLER)
    )
    rows = rows.withColumns(
        {
            "assign": F.filter(matches(F.col("t"), ASSIGN), lambda m: _value_is_long(m["body"])),
            "access": matches(F.col("t"), ACCESS),
            "hex": matches(F.col("t"), HEX),
            # Written over in turn: what is left holds no base span.
            "rest": masked(masked(masked(F.col("t"), ASSIGN, _value_is_long), ACCESS), HEX),
        }
    )
    rows = rows.withColumn("entropy_hex", random_strings(F.col("rest"), "entropy_hex", allow, placeholders))
    hex_class = CLASSES["entropy_hex"][0]
    left = F.when(F.size("entropy_hex") > 0, masked(F.col("rest"), hex_class)).otherwise(F.col("rest"))
    rows = rows.withColumn("entropy_base64", random_strings(left, "entropy_base64", allow, placeholders))
    kinds = ["assign", "access", "hex", *CLASSES]
    spans = F.array_sort(F.concat(*[_labelled(F.col(k), i, k) for i, k in enumerate(kinds)]))
    return rows.withColumn("spans", spans).select(*[f"c{i}" for i in range(len(kept.columns))], "spans").toDF(
        *kept.columns, name
    )


def _joined(spans: Column) -> Column:
    line = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(line, ",")


def op6(documents: DataFrame) -> DataFrame:
    """The rows of the contract."""
    found = find_secrets(pick(documents, doc_id="doc_id", text="text"))
    base = F.filter("secrets", lambda s: s["number"] < 3)

    def count(number: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["number"] == number)).cast("bigint")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
    )
