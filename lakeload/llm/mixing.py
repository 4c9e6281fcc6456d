"""Mixing sources to target weights by entropy balancing.

Every source gets a word target. Within a source, document rates are chosen as
close as possible to one (in relative entropy, rates bounded by the most copies
a document may have) such that the expected words meet the target. The dual of
that problem is convex with one multiplier per source, and its solution is an
exponential tilt: rate = least(most, exp(multiplier * size / mean size)).

Newton steps on the multipliers are DataFrame aggregations over (source, size,
number of documents), a loss-free summary; steps that leave the bracket known
to hold the root are replaced by its middle. All sources step at once; no more
than their number of rows is ever looked at by the driver: it only reads
whether all have settled.

Rates become whole copies by systematic rounding: along a line on which
documents of a source lie by size class and size, each document gets as many
copies as integers fall into its stretch of cumulated rates. Neighbours on the
line have like sizes, so the words taken stay close to the words expected. The
line is cut into segments, whose number follows the rows, summed separately and
chained by their totals, so no window holds a whole source.

What whole copies still miss of a target is closed by moving single copies: from
the counts of movable copies per size, the largest sizes that fit the gap are
taken first, and the last step may go beyond if that leaves less. How many of a
size move is dealt to the segments by their counts. All of this is found on rows
of id, source and size; texts that are carried along are shuffled once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeload.llm.common import column, settled

_WORD = r"[^\x20\x09-\x0D]+"
_SEGMENTS = 64  # of one size class of one source, at least
_SEGMENT_ROWS = 1_000_000  # rows of a segment on average, should one class hold all rows


def word_count(text: Column) -> Column:
    """Words that ASCII white space parts; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(``source``, ``source_size``, ``target``) from rows of (``source``, ``size``).

    Sources in code point order, null last, weigh ``weights`` in rotation and
    share ``share`` times all words. No target is above ``most`` times its
    source's size; what is over goes to the others by weight, until none is
    above. With the sources ordered by size over weight, that is where the
    common level fits: one prefix of them is at its limit.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    rank = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), rank.cast("int") + 1)
    by_source = by_source.withColumn("weight", weight.cast("double"))
    by_source = by_source.withColumn("cap", most * F.col("source_size"))
    total = Window.partitionBy()
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    by_source = by_source.withColumn("all", share * F.sum("source_size").over(total))
    # the level if all sources before this one are full and this one and the others are not
    left = F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing))
    by_source = by_source.withColumn("level", left / weights_left)
    by_source = by_source.withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(total)["level"]
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", F.coalesce(level, F.lit(0.0)) * F.col("weight")))
    return by_source.select("source", "source_size", target.cast("double").alias("target"))


def _rate(multiplier: Column, scaled: Column, most: float) -> Column:
    # the exponent is bounded before it is raised: beyond, the rate is at a limit anyway
    return F.least(F.lit(most), F.exp(F.greatest(F.least(multiplier * scaled, F.lit(50.0)), F.lit(-700.0))))


def solve_multipliers(counted: DataFrame, targets: DataFrame, most: float = 2.0, tolerance: float = 1e-9, max_steps: int = 60) -> DataFrame:
    """(``source``, ``mean``, ``multiplier``) that make the expected words of each source its target.

    ``counted`` has the number of documents ``n`` of each ``source`` and ``size``.
    The multiplier is null where the target is all a source can give: all its
    rates are ``most`` then.
    """
    counted = counted.where("size > 0")
    mean = counted.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    states = targets.join(mean, targets["source"].eqNullSafe(mean["source"])).select(targets["source"], "source_size", "target", "mean")
    free = F.col("target") < most * F.col("source_size") * (1 - 1e-12)
    states = states.withColumn("multiplier", F.when(free, F.least(F.log(F.greatest(F.col("target"), F.lit(1e-300)) / F.col("source_size")), F.lit(0.7))))
    states = states.withColumn("low", F.lit(-700.0)).withColumn("high", F.lit(50.0) * F.col("mean")).withColumn("off", F.lit(1.0))
    states, counted = settled(states), settled(counted)
    for _ in range(max_steps):
        s = states.select(F.col("source").alias("s"), F.col("mean").alias("m"), F.col("multiplier").alias("x")).where("x IS NOT NULL")
        joined = counted.join(s, counted["source"].eqNullSafe(s["s"])).withColumn("scaled", F.col("size") / F.col("m"))
        rate = _rate(F.col("x"), F.col("scaled"), most)
        words = rate * F.col("size") * F.col("n")
        sums = joined.groupBy("s").agg(
            F.sum(words).alias("words"), F.sum(F.when(rate < most, words * F.col("scaled")).otherwise(0.0)).alias("slope")
        )
        after = states.join(sums, states["source"].eqNullSafe(sums["s"]), "left")
        miss = F.col("words") - F.col("target")
        after = after.withColumn("low", F.when(miss < 0, F.col("multiplier")).otherwise(F.col("low")))
        after = after.withColumn("high", F.when(miss >= 0, F.col("multiplier")).otherwise(F.col("high")))
        newton = F.col("multiplier") - miss / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        off = F.abs(miss) / F.greatest(F.col("target"), F.lit(1.0))
        after = after.withColumn("off", F.coalesce(off, F.lit(0.0)))
        after = after.withColumn("multiplier", F.when(F.col("off") <= tolerance, F.col("multiplier")).otherwise(F.when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)))
        states = settled(after.select(*states.columns))
        if (states.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    return states.select("source", "mean", "multiplier")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, carry: bool = False) -> DataFrame:
    """Per row of ``docs``: id, ``size``, ``source_size``, ``target``, ``rate``, ``copies`` and ``taken`` (words).

    With ``carry``, the columns of ``docs`` come along in a struct ``_row``. A
    null text has size zero; wordless documents get one copy and take no words.
    Rows that repeat an id are rounded like different documents. Null is a
    source of its own, the last. Documents of one source, size and id that tie
    on the line are interchangeable.
    """
    keyed = docs.select(column(id_col).cast("long").alias("id"), column(source_col).cast("string").alias("source"), word_count(column(text_col)).alias("size"))
    slim = settled(keyed)  # the texts are read once for their sizes
    counted = settled(slim.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    spread = counted.select("source", (F.col("size") * F.col("n")).alias("size"))
    targets = settled(source_targets(spread, weights, share, float(most)))
    solved = solve_multipliers(counted, targets, float(most))
    facts = targets.join(solved.withColumnRenamed("source", "s"), F.expr("source <=> s"), "left").drop("s")
    facts = settled(facts.select(_key("source"), "source_size", "target", "mean", "multiplier"))
    parts = max(_SEGMENTS, (counted.agg(F.sum("n")).first()[0] or 0) // _SEGMENT_ROWS)

    def rated(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("key", _key("source")).drop("source").join(facts, "key")
        rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
            F.coalesce(_rate(F.col("multiplier"), F.col("size") / F.col("mean"), float(most)), F.lit(float(most)))
        )
        line = F.when(F.col("size") > 0, F.floor(F.log2(F.greatest(F.col("size"), F.lit(1))) * 4)).otherwise(-1).cast("int")
        segment = F.pmod(F.xxhash64("id", "size"), F.lit(parts)).cast("int")
        return rows.withColumn("rate", rate).withColumn("line", line).withColumn("segment", segment)

    # totals of the segments put each behind the ones before it on its source's line
    cells = rated(slim).groupBy(*_CELL).agg(F.sum("rate").alias("cell_rate"))
    chain = Window.partitionBy("key").orderBy("line", "segment").rowsBetween(Window.unboundedPreceding, -1)
    cells = settled(cells.select(*_CELL, F.coalesce(F.sum("cell_rate").over(chain), F.lit(0.0)).alias("before")))
    first = settled(_rounded(rated(slim), cells, most).select("key", "size", "line", "segment", "copies"))
    moved = _quotas(first, _moves(first, facts.select("key", "target"), most), most)
    cells = settled(cells.join(moved, list(_CELL), "left"))

    if carry:
        slim = docs.select(
            column(id_col).cast("long").alias("id"), column(source_col).cast("string").alias("source"), word_count(column(text_col)).alias("size"),
            F.struct(*[column(c) for c in docs.columns]).alias("_row"),
        )
    placed = _rounded(rated(slim), cells, most)
    quota = F.coalesce(F.element_at("quotas", F.col("size")), F.lit(0))
    placed = placed.withColumn("free", _movable(quota, most))
    earlier = Window.partitionBy(*_CELL, "size").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    step = F.least(F.col("free"), F.greatest(F.abs(quota) - F.coalesce(F.sum("free").over(earlier), F.lit(0)), F.lit(0)))
    placed = placed.withColumn("copies", (F.col("copies") + step * F.signum(quota)).cast("int"))
    columns = [F.col("id").alias(id_col), "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")]
    return placed.select(*columns, *(["_row"] if carry else []))


_CELL = ("key", "line", "segment")


def _key(source: str) -> Column:
    """A source as text that is never null, so that plain joins and shuffles by it agree."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key")


def _rounded(rated: DataFrame, cells: DataFrame, most: int) -> DataFrame:
    """Rows with their whole ``copies``: the integers in their stretch of the line. One shuffle by cell."""
    own = Window.partitionBy(*_CELL).orderBy("size", "id").rowsBetween(Window.unboundedPreceding, 0)
    placed = rated.join(cells, list(_CELL)).withColumn("end", F.col("before") + F.sum("rate").over(own))
    # a rate of a whole number always gives that many copies
    whole = F.col("rate") == F.floor("rate")
    copies = F.when(whole, F.col("rate")).otherwise(F.floor(F.col("end") + 0.5) - F.floor(F.col("end") - F.col("rate") + 0.5))
    return placed.withColumn("copies", F.least(F.lit(most), F.greatest(F.lit(0), copies.cast("int"))).cast("int"))


def _movable(change: Column, most: int) -> Column:
    """The copies that a document can gain, or lose if ``change`` is negative."""
    return F.when((F.col("size") > 0) & (change > 0), F.lit(most) - F.col("copies")).when((F.col("size") > 0) & (change < 0), F.col("copies")).otherwise(0)


def _moves(placed: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """(``key``, ``size``, ``n``): how many copies of documents of a size are added (or taken, if negative) to meet the target.

    Afterwards a source misses its target by at most half of the smallest size
    that could still be moved that way. Works on the distinct sizes of a source, of those
    no larger than its gap and the next one.
    """
    words = placed.groupBy("key").agg(F.sum(F.col("copies") * F.col("size")).alias("words"))
    gaps = targets.join(words, "key").select("key", (F.col("target") - F.col("words")).alias("gap")).where("abs(gap) > 0.5")
    free = placed.join(gaps, "key").withColumn("free", _movable(F.col("gap"), most)).where("free > 0")
    free = free.groupBy("key", "gap", "size").agg(F.sum("free").cast("long").alias("n"))
    beyond = F.min(F.when(F.col("size") > F.abs("gap"), F.col("size"))).over(Window.partitionBy("key"))
    free = free.withColumn("beyond", beyond).where("size <= abs(gap) OR size = beyond")
    by_source = free.groupBy("key", "gap").agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("sizes"))
    kind = "struct<left:double,moves:array<struct<size:bigint,n:bigint>>>"

    def step(acc: Column, x: Column) -> Column:
        n = F.least(x["n"], F.floor(acc["left"] / x["size"]).cast("long"))
        taken = F.when(n > 0, F.array(F.struct(x["size"].alias("size"), n.alias("n")))).otherwise(F.array().cast("array<struct<size:bigint,n:bigint>>"))
        return F.struct((acc["left"] - n * x["size"]).alias("left"), F.concat(acc["moves"], taken).alias("moves")).cast(kind)

    start = F.struct(F.abs("gap").alias("left"), F.array().alias("moves")).cast(kind)
    found = by_source.withColumn("done", F.aggregate("sizes", start, step))
    # the smallest size of which some are left, if one more of it comes nearer
    left = F.filter("sizes", lambda x: ~F.exists("done.moves", lambda m: (m["size"] == x["size"]) & (m["n"] == x["n"])))
    found = found.withColumn("next", F.try_element_at(F.transform(left, lambda x: x["size"]), F.lit(-1)))
    one = F.when(F.col("done.left") > F.col("next") / 2, F.array(F.struct(F.col("next").alias("size"), F.lit(1).cast("long").alias("n"))))
    moves = F.concat("done.moves", F.coalesce(one, F.array().cast("array<struct<size:bigint,n:bigint>>")))
    found = found.select("key", F.signum("gap").alias("sign"), F.explode(moves).alias("m"))
    return found.groupBy("key", F.col("m.size").alias("size")).agg((F.sum("m.n") * F.first("sign")).cast("long").alias("n"))


def _quotas(placed: DataFrame, moves: DataFrame, most: int) -> DataFrame:
    """(cell, ``quotas``): by size, how many copies move in the cell; earlier segments fill up first."""
    counts = placed.join(moves, ["key", "size"]).withColumn("free", _movable(F.col("n"), most)).where("free > 0")
    counts = counts.groupBy(*_CELL, "size", "n").agg(F.sum("free").alias("free"))
    before = F.coalesce(F.sum("free").over(Window.partitionBy("key", "size").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = F.least(F.col("free"), F.greatest(F.abs("n") - before, F.lit(0))) * F.signum("n")
    counts = counts.withColumn("quota", quota.cast("long")).where("quota <> 0")
    return counts.groupBy(*_CELL).agg(F.map_from_entries(F.collect_list(F.struct("size", "quota"))).alias("quotas"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows taken no time are gone."""
    taken = mix(docs, carry=True, **options).where("copies > 0")
    taken = taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
    return taken.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
