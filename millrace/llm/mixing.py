"""Mixing sources to target weights by Poisson replication, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import packed, plain, shuffle_partitions, written

# A Poisson number of a larger mean is the sum of numbers of at most this mean; each is inverted from one table.
LARGEST_MEAN = 8.0
# Entries of that table: for a mean of 8 the rest beyond them is below the smallest step of the uniform numbers.
TABLE = 64
# Hexadecimal digits of MD5 that make a uniform number; 13 digits are 52 bits.
DIGITS = 13


def uniform(key: Column) -> Column:
    """A number in (0, 1) from the MD5 of ``key``."""
    digits = F.substring(F.md5(key), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**DIGITS))


def source_rates(
    docs: DataFrame, source_column: str = "source", weights: dict[str, float] | None = None, temperature: float = 0.5,
    epochs: float = 1.0,
) -> DataFrame:
    """(source, n_rows, rate): the mean number of copies of a row of each source.

    With ``weights`` a source's share of the output is its weight over the sum of the weights of the sources that are
    there; sources without a weight get none. Without, its share goes as its number of rows to the power
    ``temperature``: 1 keeps the shares, 0 makes all sources equal. The output has ``epochs`` times the input's rows on
    average. A NULL source is a source of its own, of the weight of the key ``None``.
    """
    counts = written(docs.groupBy(plain(source_column).alias("source")).agg(F.count(F.lit(1)).alias("n_rows")), "mix-counts")
    if weights is None:
        weighted = counts.withColumn("weight", F.pow(F.col("n_rows").cast("double"), F.lit(float(temperature))))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(w)) for k, w in weights.items()], "name string, weight double")
        weighted = counts.join(given, F.col("source").eqNullSafe(F.col("name")), "left").select(
            "source", "n_rows", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    total = weighted.agg(F.sum("weight").alias("weight"), F.sum("n_rows").alias("n_rows")).first()
    wanted = float(epochs) * (total["n_rows"] or 0)
    return weighted.select(
        "source", "n_rows", (F.col("weight") / F.lit(total["weight"] or 1.0) * F.lit(wanted) / F.col("n_rows")).alias("rate")
    )


def _table(mean: Column) -> Column:
    """Cumulated Poisson probabilities of ``mean`` for 0, 1, 2 and so on."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("below"), F.array(first).alias("cdf"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k.cast("double")
        return F.struct(p.alias("p"), (state["below"] + p).alias("below"), F.concat(state["cdf"], F.array(state["below"] + p)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TABLE)), start, step, lambda state: state["cdf"])


def mix(
    docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", weights: dict[str, float] | None = None,
    temperature: float = 0.5, epochs: float = 1.0, seed: int = 42, copy_column: str | None = "copy", detail: bool = False,
) -> DataFrame:
    """Rows of ``docs`` as often as a Poisson number of their source's rate says, in random order.

    A row's number is the inverse of the Poisson distribution at a uniform number hashed from ``seed`` and all its columns,
    so a repeated task draws it again. Copies are numbered from 0 in ``copy_column`` (None leaves it out). A hash of row, copy
    and seed deals the copies to partitions and orders them there: a global shuffle, even whatever the sources are.
    ``detail`` adds ``n_copies``, ``rate`` and ``shuffle_key``.

    The rates are one row per source, counted first and written; Spark broadcasts them if their size allows and joins by
    sorting, with splitting of hot sources, if not. Rows with NULL or repeated ids draw by their other columns; only a row repeated
    whole gets the same number of copies each time. An empty table gives an empty result. Columns of ``docs``
    that have a name of a new column are replaced.
    """
    spark = docs.sparkSession
    rates = source_rates(docs, source_column, weights, temperature, epochs).filter("rate > 0")
    parts = F.ceil(F.col("rate") / F.lit(LARGEST_MEAN)).cast("int")
    rates = rates.select(F.col("source").alias("_mix_source"), F.col("rate").alias("_mix_rate"), parts.alias("_mix_parts"))
    rates = written(rates.withColumn("_mix_cdf", _table(F.col("_mix_rate") / F.col("_mix_parts"))), "mix-rates")

    first = [id_column, *[c for c in docs.columns if c != id_column]]
    content = F.concat_ws("\x1f", *[F.coalesce(plain(c).cast("string"), F.lit("\x01")) for c in first])
    rows = docs.select(packed(docs).alias("_mix_row"), F.md5(content).alias("_mix_name"), plain(source_column).alias("_mix_of"))
    name = F.col("_mix_name")

    def draw(part: Column) -> Column:
        u = uniform(F.concat_ws(":", F.lit(str(seed)), name, part.cast("string")))
        return F.size(F.filter("_mix_cdf", lambda below: below < u))

    number = F.aggregate(F.sequence(F.lit(1), F.col("_mix_parts")), F.lit(0), lambda sum_, part: sum_ + draw(part))
    counted = rows.join(rates, F.col("_mix_of").eqNullSafe(F.col("_mix_source"))).withColumn("_mix_n", number)
    copies = counted.filter("_mix_n > 0").withColumn("_mix_copy", F.explode(F.sequence(F.lit(0), F.col("_mix_n") - 1)))
    place = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), name, F.col("_mix_copy").cast("string")))
    shuffled = copies.withColumn("_mix_place", place).repartition(shuffle_partitions(spark), "_mix_place")
    ordered = shuffled.sortWithinPartitions("_mix_place")

    new = {copy_column: "_mix_copy"} if copy_column else {}
    if detail:
        new |= {"n_copies": "_mix_n", "rate": "_mix_rate", "shuffle_key": "_mix_place"}
    kept = [F.col("_mix_row").getField(c).alias(c) for c in docs.columns if c not in new]
    return ordered.select(*kept, *[F.col(k).alias(v) for v, k in new.items()])
