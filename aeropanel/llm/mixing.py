"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of a source are laid on a ring, documents in a seeded order, and cut into blocks of equally many words. Blocks
are apportioned to sources by highest quotients (target over 1, 3, 5, ...), then the blocks of a source to its shards
by the words of the shards. In a shard, blocks are taken one after another from a seeded one on, and all of them once
more often when the quota exceeds their number. A document takes what its words have in the taken blocks; as these are
neighbours and documents lie in random order, the choice is random while nearly every taken document is whole.

A block holds `block_words` words, or a fortieth of the smallest target where that is less, down to single words: so even a
source of a few words has its seats and comes near its target. No row is made per block, so small blocks cost nothing.

A source is cut into shards of about `shard_words` by the hash of the document id, so no source, however large, is
ordered by one task. Quotas need no list of all quotients: below the level at which every group certainly has its
seats, only a few quotients per group are compared.

Defined cases: a missing text has no words; a missing source is a source of its own, after all others; a document
without words takes none; without any words nothing is taken. Repeated rows are separate documents; missing ids share a
shard. Other columns pass through `mixed`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeropanel.session import scratch_path, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 64
LEAST_BLOCKS = 40
SHARD_WORDS = 2_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST_REPEATS) -> DataFrame:
    """`sources` (source, source_size) -> also weight and target.

    Targets are in proportion to the weights but stop at `most` times the source's size. With sources in the order in
    which they reach that stop, one pass finds how many of them stop: the rest then shares what is left by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighted = sources.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn))
    limit = F.lit(float(most)) * F.col("source_size")
    by_stop = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    upto = by_stop.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    # the level if this source and all that stop before it have stopped, and if it is the first that has not
    rest = F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight")
    level = (total - F.sum(limit).over(upto) + limit) / rest
    free = weighted.withColumns({"_limit": limit, "_level": level, "_free": limit / F.col("weight") >= level})
    # the level of the first free source holds for all free ones
    found = F.min(F.when(F.col("_free"), F.struct(F.col("_limit") / F.col("weight"), F.col("_level").alias("level")))).over(everything)
    target = F.when(F.col("_free"), F.least(F.col("_limit"), F.col("weight") * found["level"])).otherwise(F.col("_limit"))
    return free.select("source", "source_size", "weight", target.alias("target"))


def apportion(groups: DataFrame, size: str, seats: Column, within: Sequence[str], key: Sequence[str],
              name: str = "quota") -> DataFrame:
    """Adds the seats of each group by Sainte-Laguë; `seats` go to the groups of one `within`, ties to lower `key`.

    A group of exact share s holds at least floor(s) - 1 of its seats before any quotient is compared; the rest goes by
    highest quotients among the next ones of every group, as many as there are groups, and three more.
    """
    whole = Window.partitionBy(*within)
    total = F.sum(size).over(whole)
    exact = F.when(total > 0, F.col(size) * F.col("_seats") / total).otherwise(F.lit(0.0))
    sure = groups.withColumn("_seats", seats).withColumn("_exact", exact)
    sure = sure.withColumn("_sure", F.greatest(F.lit(0).cast("long"), F.floor("_exact") - 1))
    sure = sure.withColumn("_left", F.col("_seats") - F.sum("_sure").over(whole))
    more = F.explode(F.sequence(F.col("_sure"), F.col("_sure") + 4)).alias("_seat")
    quotients = sure.filter(F.col(size) > 0).select(*within, *key, "_left", more, F.col(size).alias("_size")) \
        .withColumn("_quotient", F.col("_size") / (2 * F.col("_seat") + 1))
    order = Window.partitionBy(*within).orderBy(F.desc("_quotient"), *(F.col(k).asc_nulls_last() for k in key), "_seat")
    won = quotients.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= F.col("_left")) \
        .groupBy(*within, *key).agg(F.count("*").alias("_won"))
    keys = list(dict.fromkeys([*within, *key]))
    won = won.withColumnsRenamed({c: f"_won_{c}" for c in keys})
    joined = sure.join(won, [F.col(c).eqNullSafe(F.col(f"_won_{c}")) for c in keys], "left").drop(*(f"_won_{c}" for c in keys))
    quota = F.col("_sure") + F.coalesce("_won", F.lit(0))
    return joined.withColumn(name, quota.cast("long")).drop("_seats", "_exact", "_sure", "_left", "_won")


def _offsets(sized: DataFrame, seed: int, shard_words: int) -> DataFrame:
    """Documents with source_size, shard and the place of their first word in the shard."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    known = sized.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    shards = F.ceil(F.greatest(F.col("source_size"), F.lit(1)) / shard_words)
    known = known.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(seed)), shards).cast("long"))
    line = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "size", "_tie", "_row")
    first = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    return known.withColumn("first", first)


def taken_parts(documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
                seed: int = 7) -> DataFrame:
    """`documents` (doc_id, source, size, _tie, _row) -> these, source_size, target, `once`, `parts` and `taken`.

    The mix takes the whole document `once` times, and the stretches of its words in `parts` (first word, from 0, and
    number of words) once more.
    """
    path = scratch_path(documents.sparkSession, "mixing")
    # words are counted once
    placed = written(_offsets(written(documents, f"{path}/sized"), seed, shard_words), f"{path}/placed")

    aimed = targets(placed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    everything = Window.partitionBy()
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything)
    per_block = F.coalesce(F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(smallest / LEAST_BLOCKS))), F.lit(1))
    aimed = aimed.withColumn("block", per_block)
    all_seats = F.round(F.sum("target").over(everything) / F.col("block")).cast("long")
    of_source = apportion(aimed, "target", all_seats, [], ["source"])
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    shards = shards.join(of_source.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    of_shard = apportion(shards, "shard_size", F.col("quota"), ["source"], ["shard"], "shard_quota")
    blocks = F.greatest(F.lit(1), F.round(F.col("shard_size") / F.col("block"))).cast("long")
    quota = F.least(F.col("shard_quota"), blocks * most)
    begin = F.pmod(F.xxhash64("source", "shard", F.lit(seed + 2)), blocks)
    bound = lambda block: F.floor(block * F.col("shard_size") / F.col("blocks"))
    of_shard = of_shard.withColumns({"blocks": blocks, "once": F.floor(quota / blocks).cast("int"), "extra": quota % blocks, "begin": begin})
    end = F.col("begin") + F.col("extra")
    facts = written(of_shard.select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "target", "once", bound(F.col("begin")).alias("_from"),
        bound(F.least(end, F.col("blocks"))).alias("_to"), bound(F.greatest(end - F.col("blocks"), F.lit(0))).alias("_around")),
        f"{path}/shards")

    rows = placed.join(facts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))

    def inside(low: Column, high: Column) -> Column:
        start = F.greatest(low, "first")
        words = F.least(high, F.col("first") + F.col("size")) - start
        return F.struct((start - F.col("first")).alias("first"), words.alias("words"))

    both = F.array(inside(F.lit(0).cast("long"), F.col("_around")), inside(F.col("_from"), F.col("_to")))
    parts = F.filter(both, lambda p: p["words"] > 0)
    extra = F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + p["words"])
    return rows.select("_row", "doc_id", "source", "size", "source_size", "target", "once", parts.alias("parts"),
                       (F.col("once") * F.col("size") + extra).alias("taken"))


def _sized(documents: DataFrame, columns: Sequence[str]) -> DataFrame:
    return documents.select(*columns, word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_tie"),
                            F.monotonically_increasing_id().alias("_row"))


def mix(documents: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return taken_parts(_sized(documents, ["doc_id", "source"]), **options).select("doc_id", "size", "source_size", "target", "taken")


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them, with their columns: a row per time, `n_chars` of the text if there is one.

    A document that is taken in part holds these words, parted by single blanks.
    """
    path = scratch_path(documents.sparkSession, "mixing")
    # rows get a number that stays
    numbered = written(documents.select(F.struct("*").alias("row"), word_count(F.col("text")).alias("size"),
                                        F.monotonically_increasing_id().alias("_row")), path)
    sized = numbered.select("row.doc_id", "row.source", "size", F.xxhash64("row.text").alias("_tie"), "_row")
    taken = taken_parts(sized, **options).filter(F.col("taken") > 0).select(F.col("_row").alias("_taken_row"), "once", "parts")
    rows = numbered.join(taken, F.col("_row") == F.col("_taken_row"))
    text, nothing = F.col("row.text"), F.array().cast("array<string>")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    cut = F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(words, p["first"].cast("int") + 1, p["words"].cast("int")))), " ")
    once_more = F.when(F.col("parts")[0]["words"] == F.col("size"), text).otherwise(cut)
    taken_texts = F.concat(F.when(F.col("once") > 0, F.transform(F.sequence(F.lit(1), F.col("once")), lambda _: text)).otherwise(nothing),
                           F.when(F.size("parts") > 0, F.array(once_more)).otherwise(nothing))
    each = rows.select("row", F.explode(taken_texts).alias("text"))
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in documents.columns:
        row = row.withField("n_chars", F.length("text").cast(dict(documents.dtypes)["n_chars"]))
    return each.select(row.alias("row")).select("row.*")
