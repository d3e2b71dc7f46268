"""Profiles of the business properties of the two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.columns import is_first_quarter, is_weekday, share
from tallyspan.session import store_and_reload

SETTLED = 1e-9
MOST_DOUBLINGS = 40


def creation_seasonality(initial: DataFrame) -> DataFrame:
    """Creations per year, in the first quarter and on Monday to Friday."""
    day = F.col("creation_date")
    return (
        initial.groupBy(F.year(day).cast("long").alias("year"))
        .agg(
            F.count("*").alias("n_created"),
            F.count_if(is_first_quarter(day)).alias("n_first_quarter"),
            F.count_if(is_weekday(day)).alias("n_weekday"),
        )
        .withColumn("first_quarter_share", share(F.col("n_first_quarter"), F.col("n_created")))
    )


def customer_concentration(initial: DataFrame, k: int = 10) -> DataFrame:
    """The k customers with most licences (ties to the lower id) and their share."""
    total = initial.agg(F.count("*").alias("n")).scalar()
    top = (
        initial.groupBy("customer_id")
        .agg(F.count("*").alias("n_licenses"))
        .orderBy(F.col("n_licenses").desc(), F.col("customer_id"))
        .limit(k)
    )
    place = Window.orderBy(F.col("n_licenses").desc(), F.col("customer_id"))
    return top.select(
        F.row_number().over(place).cast("long").alias("customer_rank"),
        "customer_id",
        "n_licenses",
        share(F.col("n_licenses"), total).alias("license_share"),
    )


def changes_per_license(changes: DataFrame) -> DataFrame:
    return changes.groupBy("license_id").agg(F.count("*").alias("n_changes"))


def change_count_histogram(changes: DataFrame) -> DataFrame:
    """How many licences have how many changes."""
    return changes_per_license(changes).groupBy("n_changes").agg(F.count("*").alias("n_licenses"))


def price_moves(states: DataFrame) -> DataFrame:
    """Rises, falls and unchanged prices between consecutive states of a licence."""
    before = F.lag("price").over(Window.partitionBy("license_id").orderBy("date"))
    step = F.signum(F.col("price") - F.col("previous_price"))
    return (
        states.withColumn("previous_price", before)
        .where(F.col("price").isNotNull() & F.col("previous_price").isNotNull())
        .groupBy(F.when(step > 0, "rise").when(step < 0, "fall").otherwise("same").alias("move"))
        .agg(F.count("*").alias("n_moves"))
    )


def type_transitions(states: DataFrame) -> DataFrame:
    """Transition matrix estimated from consecutive states of a licence; the shares
    of one ``from_type`` sum to 1."""
    before = F.lag("type").over(Window.partitionBy("license_id").orderBy("date"))
    counts = (
        states.withColumn("from_type", before)
        .where(F.col("from_type").isNotNull() & F.col("type").isNotNull())
        .groupBy("from_type", F.col("type").alias("to_type"))
        .agg(F.count("*").alias("n_transitions"))
    )
    of_row = F.sum("n_transitions").over(Window.partitionBy("from_type"))
    return counts.withColumn("transition_share", share(F.col("n_transitions"), of_row))


def transition_row_sums(transitions: DataFrame) -> DataFrame:
    """Per ``from_type``: the sum of its shares, and whether it is 1 up to the rounding of
    six digits in each of them."""
    sums = transitions.groupBy("from_type").agg(
        F.round(F.sum("transition_share"), 6).alias("share_sum"), F.count("*").alias("n_shares")
    )
    holds = F.abs(F.col("share_sum") - 1) <= F.col("n_shares") * 0.000001
    return sums.withColumn("sums_to_one", holds)


def steady_state(transitions: DataFrame, counts: str = "n_transitions", tolerance: float = SETTLED) -> DataFrame:
    """(from_type, to_type, share): the long-run share of each type, by where a licence starts.

    The transition matrix is multiplied with itself again and again, as a join and a sum
    over its entries, until no entry moves by more than ``tolerance``.  A
    step is taken or left out with equal chance, which has the same limit and no cycles.  A type
    without a way out stays what it is.  Entries that are zero are not there, and the shares
    of one ``from_type`` sum to 1.
    """
    of_row = F.sum(counts).over(Window.partitionBy("from_type"))
    moves = transitions.select("from_type", "to_type", (F.col(counts) / of_row / 2).alias("share"))
    types = transitions.select("from_type").union(transitions.select("to_type")).distinct()
    leaving = transitions.select("from_type", F.lit(0.5).alias("stay")).distinct()
    stays = types.join(leaving, "from_type", "left").select(
        "from_type", F.col("from_type").alias("to_type"), F.coalesce("stay", F.lit(1.0)).alias("share")
    )

    def summed(entries: DataFrame) -> DataFrame:
        return entries.groupBy("from_type", "to_type").agg(F.sum("share").alias("share"))

    matrix = store_and_reload(summed(moves.unionByName(stays)), "matrix")
    for _ in range(MOST_DOUBLINGS):
        right = matrix.select(F.col("from_type").alias("through"), F.col("to_type").alias("_to"), F.col("share").alias("_share"))
        products = matrix.withColumnRenamed("to_type", "through").join(right, "through")
        squared = summed(products.select("from_type", F.col("_to").alias("to_type"), (F.col("share") * F.col("_share")).alias("share")))
        # Rounding errors must not add up over the doublings.
        total = F.sum("share").over(Window.partitionBy("from_type"))
        squared = store_and_reload(squared.withColumn("share", F.col("share") / total), "matrix")
        old = matrix.withColumnRenamed("share", "_old")
        moved = squared.join(old, ["from_type", "to_type"], "left")
        largest = moved.agg(F.max(F.abs(F.col("share") - F.coalesce("_old", F.lit(0.0))))).first()[0] or 0.0
        matrix = squared
        if largest <= tolerance:
            return matrix
    raise ArithmeticError(f"the shares have not settled after {MOST_DOUBLINGS} doublings")
