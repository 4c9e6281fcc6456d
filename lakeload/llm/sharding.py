"""Sharding by fixed virtual slots.

A record's hash picks one of some thousands of slots; the number of slots never
changes, so neither does a record's slot. Which shard holds a slot is written in
a small map with a version: the first version deals the slots, largest first, to
the shard with the fewest bytes so far; rebalancing edits the map, moving only
the slots that an overfull, a new or a leaving shard forces, and is stored as
the next version. Rows are only ever looked up through a version of the map.

The map has one row a slot, so everything that is ordered or dealt one after
another here is bounded by the number of slots, never by the rows. Rows are
aggregated to bytes per slot before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakeload.llm.common import column, settled

SLOTS = 4096


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id``, ``size``, ``text_crc32``, ``key``, ``row``) of every row, settled: the texts are read once.

    The size is the text's UTF-8 bytes plus one; a null text counts as empty.
    ``key`` hashes id and text, ``row`` numbers the rows.
    """
    text = F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary")
    id_ = column(id_col).cast("long")
    return settled(
        docs.select(
            id_.alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(id_, text).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(key, F.lit(slots)).cast("int")


def with_slots(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``rows`` of ``sized`` with their ``virtual_slot``.

    One id and text repeated until it alone would fill more than a slot's share
    is spread over as many slots as it needs by row number. There are fewer of
    these keys than slots, and only slots beyond twice their share are searched.
    """
    plain = rows.withColumn("virtual_slot", slot_of(F.col("key"), slots))
    by_slot = plain.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    share = F.greatest(F.sum("bytes").over(Window.partitionBy()) / slots, F.lit(1.0))
    full = settled(by_slot.select("virtual_slot", "bytes", share.alias("share")).where("bytes > 2 * share").drop("bytes"))
    heavy = plain.join(full, "virtual_slot").groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("share").alias("share"))
    parts = F.least(F.col("n"), F.ceil(F.col("bytes") / F.col("share"))).cast("long")
    heavy = settled(heavy.where("n > 1 AND bytes > share").select("key", parts.alias("parts")))
    spread = slot_of(F.xxhash64("key", F.pmod(F.xxhash64("row"), F.col("parts"))), slots)
    return plain.join(heavy, "key", "left").withColumn("virtual_slot", F.coalesce(spread, "virtual_slot")).drop("parts")


def slot_totals(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(``slot``, ``bytes``, ``rows``) of every slot, empty ones too."""
    found = rows.groupBy(F.col("virtual_slot").alias("slot")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    return every.join(found, "slot", "left").select("slot", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))


def _dealt(loose: DataFrame, loads: DataFrame) -> DataFrame:
    """(``slot``, ``shard``): loose slots (``slot``, ``bytes``), largest first, each to the shard of least load so far.

    ``loads`` has a row (``bytes``, ``slots``, ``shard``) for each shard to deal to. Ties go to the shard with fewer slots, then the lower one.
    """
    state = F.struct(F.col("bytes").cast("long").alias("bytes"), F.col("slots").cast("long").alias("slots"), F.col("shard").cast("int").alias("shard"))
    start = loads.agg(F.sort_array(F.collect_list(state)).alias("loads"))
    line = loose.agg(F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("minus"), F.col("slot").alias("slot")))).alias("line"))
    kind = "struct<loads:array<struct<bytes:bigint,slots:bigint,shard:int>>,dealt:array<struct<slot:int,shard:int>>>"

    def step(acc: Column, x: Column) -> Column:
        least = F.array_min(acc["loads"])
        grown = F.struct((least["bytes"] - x["minus"]).alias("bytes"), (least["slots"] + 1).alias("slots"), least["shard"].alias("shard"))
        loads = F.transform(acc["loads"], lambda s: F.when(s["shard"] == least["shard"], grown).otherwise(s))
        dealt = F.concat(acc["dealt"], F.array(F.struct(x["slot"].alias("slot"), least["shard"].alias("shard"))))
        return F.struct(loads.alias("loads"), dealt.alias("dealt")).cast(kind)

    empty = F.struct(F.col("loads").alias("loads"), F.array().alias("dealt")).cast(kind)
    done = line.crossJoin(start).select(F.aggregate("line", empty, step, lambda acc: acc["dealt"]).alias("dealt"))  # one row each
    return done.select(F.inline("dealt"))


def first_map(totals: DataFrame, shards: int) -> DataFrame:
    """(``slot``, ``shard``, ``bytes``) for slots that no map holds yet."""
    loads = totals.sparkSession.range(shards).select(F.lit(0).alias("bytes"), F.lit(0).alias("slots"), F.col("id").alias("shard"))
    return _dealt(totals, loads).join(totals, "slot").select("slot", "shard", "bytes")


def rebalanced(slot_map: DataFrame, totals: DataFrame, shards: int, only_new: bool = False) -> DataFrame:
    """The map edited for the bytes that ``totals`` counts now and for ``shards`` shards.

    A shard keeps its largest slots up to an even share of all bytes; what is
    beyond, and all slots of shards that leave, goes to the shards of least
    load. With ``only_new`` it goes only to shards the map did not have, so no
    other shard gains a row; without new shards the map stays as it is then.
    """
    spark = slot_map.sparkSession
    held = settled(slot_map.select("slot", "shard").join(totals, "slot").select("slot", "shard", "bytes"))
    target = F.sum("bytes").over(Window.partitionBy()) / shards
    so_far = F.sum("bytes").over(Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot").rowsBetween(Window.unboundedPreceding, 0))
    marked = held.withColumn("keeps", (so_far <= F.ceil(target)) & (F.col("shard") < shards))
    before = held.agg(F.max("shard")).first()[0]
    before = 0 if before is None else before + 1
    if only_new and before >= shards:
        marked = marked.withColumn("keeps", F.col("shard") < shards)
    marked = settled(marked)
    kept = marked.where("keeps")
    loads = kept.groupBy("shard").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("slots"))
    every = spark.range(before if only_new and before < shards else 0, shards).select(F.col("id").cast("int").alias("shard"))
    loads = every.join(loads, "shard", "left").select(F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("slots", F.lit(0)).alias("slots"), "shard")
    loose = marked.where("NOT keeps")
    moved = _dealt(loose, loads).join(loose.select("slot", "bytes"), "slot").select("slot", "shard", "bytes")
    return kept.select("slot", "shard", "bytes").unionByName(moved)


def store_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Keep a map as ``version`` under ``path``. A version is never overwritten."""
    slot_map.coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def stored_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(``slot``, ``shard``, ``bytes``, ``version``) of one version, by default the last."""
    maps = spark.read.parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version).select("slot", "shard", "bytes", "version")


def placed(rows: DataFrame, slot_map: DataFrame, totals: DataFrame) -> DataFrame:
    """``rows`` with their ``shard``, their place ``slot`` in it, gapless from 0, and the map's ``version``.

    A place is the number of rows in the shard's earlier virtual slots plus the
    row's place in its own, so no window holds a shard.
    """
    earlier = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(totals.select("slot", "rows"), "slot")
    starts = starts.select(F.col("slot").alias("virtual_slot"), "shard", "version", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    own = Window.partitionBy("virtual_slot").orderBy("id", "key", "size", "row")
    numbered = rows.withColumn("place", F.row_number().over(own))
    return numbered.join(F.broadcast(starts), "virtual_slot").withColumn("slot", (F.col("start") + F.col("place") - 1).cast("long"))


def shard_documents(docs: DataFrame, path: str, shards: int = 8, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` in shards of near equal bytes: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``, ``virtual_slot``, ``map_version``.

    The first version of the map is stored under ``path``. The law is ``bytes``:
    with large slots dealt first, the small ones even the shards out. As bytes
    decide, ``grown_shard`` is null. A null text counts as empty, a null id as one id;
    rows repeated without end still spread. An empty table has no rows and a map.
    """
    rows = settled(with_slots(sized(docs, id_col, text_col), slots))
    totals = settled(slot_totals(rows, slots))
    store_map(first_map(totals, shards), path, 1)
    found = placed(rows, stored_map(docs.sparkSession, path), totals)
    return found.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", F.col("version").alias("map_version"),
    )
