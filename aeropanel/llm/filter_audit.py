"""What each filter of a chain removes, in every order of the chain, by higher-order SQL folds.

Five filters look at a whole document; which of them it fails is a mask of five bits. Only counts by part and mask (a cell)
leave the documents: how many there are, how many of them are good and how many toxic. Each cell is then folded across the
constant array of all 120 orders with `transform` and `aggregate`, which gives 600 structs (an order and a step each)
weighted by the counts of the cell; the cells of a part are merged by sums element by element. A part has at most 32
cells, so neither the fold nor the merge grows with the documents.

The fifth filter fails copies of a text that a smaller id holds too. Rows are counted by text digest, id, part and labels
before the least id of a digest is looked for, so a text that a third of all rows hold is a few counts by then.

Defined cases: a missing text is an empty one, a missing part is the empty string. Rows that share text and smallest id are
all the first of their text; a missing id comes before nothing and after nothing, so such rows never fail as copies. A
document is good or toxic if any of its label rows says so; labels without an id belong to no document. A part without
documents is not returned, so an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "[#$%&*|]"
LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(LETTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column) -> Column:
    """Bits 0 to 3 of the filters A to D that a text fails."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def failing(found: Column) -> Column:
        n = F.size(found)
        few = (n < 200).cast("int")
        repeated = (100 * F.size(F.array_distinct(found)) < 50 * n).cast("int")
        return few + 2 * repeated

    # words are taken once for both filters
    by_words = F.transform(F.array(words), failing)[0]
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return by_words + 4 * (100 * capitals > 3 * F.length(text)).cast("int") + 8 * text.rlike(MARKS).cast("int")


def cells(documents: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, mask, n, good, toxic: the counts of the documents that fail the same filters."""
    says = lambda c: F.max(F.coalesce((F.col(c) == 1), F.lit(False)).cast("long"))
    told = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_labelled")) \
        .agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"),
        text_mask(text).alias("mask"))
    rows = rows.join(told, F.col("doc_id") == F.col("_labelled"), "left").drop("_labelled") \
        .withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("good", "toxic")})
    kind = ["digest", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    by_kind = by_id.groupBy(*kind).agg(first.alias("first"), F.sum("n").alias("n"),
                                       F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"))
    # a digest has as many rows here as it has parts and labels
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    passing = F.col("unnamed") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(F.lit(0))
    counted = by_kind.withColumn("passing", passing).select(
        *kind[1:], F.explode(F.array(F.struct(F.col("mask"), F.col("passing").alias("n")),
                                     F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))).alias("cell"))
    return counted.groupBy("part", F.col("cell.mask").alias("mask")).agg(
        F.sum("cell.n").alias("n"), F.sum(F.col("cell.n") * F.col("good")).alias("good"),
        F.sum(F.col("cell.n") * F.col("toxic")).alias("toxic")).filter(F.col("n") > 0)


def folded_cell(mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """The 600 structs of a cell: every order, every step, in the order of ORDERS."""
    nothing = F.lit(0).cast("long")
    bits = F.create_map(*(x for i, a in enumerate(LETTERS) for x in (F.lit(a), F.lit(1 << i))))

    def along(order: Column) -> Column:
        def step(state: Column, k: Column) -> Column:
            letter = F.substr(order, k, F.lit(1))
            bit = F.element_at(bits, letter)
            fails, alive = mask.bitwiseAND(bit) > 0, state["alive"]
            removed = fails & alive
            row = F.struct(
                order.alias("filter_order"), k.alias("step"),
                F.when(alive & ~fails, n).otherwise(nothing).alias("kept"),
                F.when(removed, n).otherwise(nothing).alias("removed"),
                F.when(fails & ~alive, n).otherwise(nothing).alias("redundant"),
                F.when(mask == bit, n).otherwise(nothing).alias("unique_fails"),
                F.when(removed, good).otherwise(nothing).alias("good_lost"),
                F.when(removed, toxic).otherwise(nothing).alias("toxic_lost"))
            return F.struct((alive & ~fails).alias("alive"), F.concat(state["rows"], F.array(row)).alias("rows"))

        kinds = "array<struct<filter_order:string,step:int,kept:bigint,removed:bigint,redundant:bigint,unique_fails:bigint," \
                "good_lost:bigint,toxic_lost:bigint>>"
        start = F.struct(F.lit(True).alias("alive"), F.array().cast(kinds).alias("rows"))
        steps = F.array(*(F.lit(k) for k in range(1, len(LETTERS) + 1)))
        return F.aggregate(steps, start, step, lambda state: state["rows"])

    return F.flatten(F.transform(F.lit(ORDERS), along))


def merged(folds: Column) -> Column:
    """Folds of a part's cells added up element by element."""
    def add(a: Column, b: Column) -> Column:
        return F.struct(a["filter_order"].alias("filter_order"), a["step"].alias("step"), *((a[c] + b[c]).alias(c) for c in COUNTS))

    return F.aggregate(F.slice(folds, 2, 31), folds[0], lambda total, fold: F.zip_with(total, fold, add))


def audit(documents: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    fold = folded_cell(F.col("mask"), F.col("n"), F.col("good"), F.col("toxic"))
    by_part = cells(documents, labels, part).select("part", fold.alias("fold")) \
        .groupBy("part").agg(F.collect_list("fold").alias("folds")).select("part", merged(F.col("folds")).alias("steps"))
    letter = lambda s: F.substr(s["filter_order"], s["step"], F.lit(1))
    removed_by = lambda a: F.aggregate(
        F.filter("steps", lambda s: letter(s) == a), F.lit(0).cast("long"), lambda total, s: total + s["removed"])
    shapley = F.create_map(*(x for a in LETTERS for x in (F.lit(a), removed_by(F.lit(a)))))
    rows = by_part.withColumn("by_filter", shapley).select("part", "by_filter", F.explode("steps").alias("s"))
    return rows.select("part", "s.filter_order", "s.step", *(F.col(f"s.{c}") for c in COUNTS),
                       F.element_at("by_filter", letter(F.col("s"))).alias("shapley"))
