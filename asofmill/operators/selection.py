"""Exact order statistics by radix: histograms of key bits narrow down to the wanted value, and no group's values meet in one place."""

from __future__ import annotations

import uuid
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import shared_folder
from .writes import aside

#: Bits that a pass narrows down, of 64.
DIGIT = 16


def ordered_bits(value: Column) -> Column:
    """A long that orders as the double does (NaN last, -0.0 as 0.0): sign, exponent and fraction, as the format itself lays them out."""
    a = F.abs(value)
    # exponent by logarithm, put right where that rounds
    guess = F.greatest(F.floor(F.log2(a)), F.lit(-1022))
    above = a >= F.pow(F.lit(2.0), F.least(guess + 1, F.lit(1023)).cast("double"))
    e = F.when(above & (guess < 1023), guess + 1).when(a < F.pow(F.lit(2.0), guess.cast("double")), guess - 1).otherwise(guess)
    fraction = ((a / F.pow(F.lit(2.0), e.cast("double")) - 1) * F.lit(float(1 << 52))).cast("long")
    normal = (e + 1023).cast("long") * F.lit(1 << 52) + fraction
    tiny = ((a * F.lit(2.0**537)) * F.lit(2.0**537)).cast("long")
    size = F.when(F.isnan(value), F.lit((1 << 63) - 1)).when(a == float("inf"), F.lit(2047 << 52)).when(a < F.lit(2.0**-1022), tiny).otherwise(normal)
    return F.when(value < 0, -size).otherwise(size)


def medians(rows: DataFrame, by: str, value: str) -> DataFrame:
    """``by``, n and median (the mean of the two middle values, if n is even) of each group's values that are not null.

    Each of four passes counts the rows of every group by the next 16 bits of their key, for the bits that the middle ranks have led to so far: at most
    65,536 counts a group, added up before they move. Groups may be of any size, and hold any number of equal values. The rows are written aside
    once, and what each pass has led to: two rows a group.
    """
    spark, folder = rows.sparkSession, shared_folder(rows.sparkSession)
    given = rows.filter(F.col(value).isNotNull()).select(F.col(by).alias("g"), F.col(value).cast("double").alias("x"))
    with aside(given.withColumn("key", ordered_bits(F.col("x")).bitwiseXOR(F.lit(-(1 << 63)))), folder) as keyed, ExitStack() as steps:
        counts = keyed.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        # ranks (from 0) of the two middle values among the rows that share the prefix so far
        middles = F.explode(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)))
        led = counts.select("g", "n", middles.alias("rank"), F.lit(0).cast("long").alias("prefix"), F.lit(None).cast("double").alias("x"))
        for shift in range(64 - DIGIT, -1, -DIGIT):
            led = steps.enter_context(aside(led, folder))
            rest = F.shiftrightunsigned("key", shift + DIGIT) if shift + DIGIT < 64 else F.lit(0).cast("long")
            digit = F.shiftrightunsigned("key", shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
            held, to = keyed.select(F.col("g").alias("hg"), rest.alias("hp"), digit.alias("digit"), F.col("x").alias("hx")), led.select("g", "prefix").distinct()
            near = held.join(to, held["hg"].eqNullSafe(to["g"]) & (held["hp"] == to["prefix"]), "left_semi")
            found = near.groupBy("hg", "hp", "digit").agg(F.count(F.lit(1)).alias("c"), F.min("hx").alias("hx"))
            before = Window.partitionBy("hg", "hp").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
            found = found.withColumn("below", F.coalesce(F.sum("c").over(before), F.lit(0)))
            inside = led["g"].eqNullSafe(found["hg"]) & (led["prefix"] == found["hp"]) & (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("c"))
            led = led.join(found, inside).select("g", "n", (F.col("rank") - F.col("below")).alias("rank"), F.shiftleft("hp", DIGIT).bitwiseOR(F.col("digit")).alias("prefix"), F.col("hx").alias("x"))
        path = f"{folder}/medians-{uuid.uuid4().hex[:12]}"  # two rows a group, which outlast what they were made of
        led.write.parquet(path)
    led = spark.read.schema(led.schema).parquet(path)
    return led.groupBy(F.col("g").alias(by), "n").agg((F.sum(F.col("x") * 0.5)).alias("median"))
