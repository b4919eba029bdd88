"""Mixing sources to target weights by capped water-filling.

Sizes are words. The sources share the words of the whole corpus by weight; a
source whose share exceeds ``MAX_EPOCHS`` times its own size is clamped there
and its excess goes to the others by weight until none is above. That level is
found on one row per source: with sources sorted by cap / weight, the first k
are clamped for the smallest k at which the remaining share per weight fits the
next source.

A document gets the whole repetitions of its source's ratio, plus a fractional
one: documents are put in a seeded order (md5 of seed and doc_id), the source's
remaining words are dealt along it, and the document at which they run out is
taken in part. So the words taken from a source equal its target rounded, reruns
agree, and no document is taken more than ``MAX_EPOCHS`` times its size.

The running sums work in two levels: ``SLOTS`` slots of the md5 per source are
summed first (in the map tasks), their offsets are prefix sums over at most
SLOTS rows per source, and rows are ordered only inside a slot, so a source with
a third of all rows is no single task.

Cases: null text has size 0; null source is a source, last in code-point order;
rows with a null doc_id take the order of an empty id; repeated rows count each,
ties in the order fall to (doc_id, size) and equal rows are interchangeable; an empty
table gives an empty result; a very long text is counted whole, one row in a task;
further columns pass through ``repeat`` untouched. The level is found in one window
over the sources, one row each: their number must fit a task, as that of named
sources does; a source per host does not belong there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from curbwise.llm.common import saved, words

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
SLOTS = 256
#: Java pattern of the place between a word and the space after it.
WORD_END = r"(?<=[^ \t-\r])(?=[ \t-\r])"


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def order_key(doc_id: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> with weight and target; one row per source.

    The windows run over one row per source, not over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    s = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), nth))
    s = s.withColumn("cap", F.lit(epochs) * F.col("source_size"))
    fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    s = s.withColumns({"total": F.sum("source_size").over(every), "rest_weight": F.sum("weight").over(onward)})
    s = s.withColumn("rest", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    # the level of the first source that is not clamped; exact comparison in wide integers
    wide = lambda a, b: F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)")
    s = s.withColumn("free", wide("rest", "weight") <= wide("cap", "rest_weight"))
    s = s.withColumn("level", F.first(F.when(F.col("free"), F.struct("rest", "rest_weight")), ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    s = s.withColumn("clamped", F.coalesce(wide("cap", "level.rest_weight") < wide("level.rest", "weight"), F.lit(True)))
    share = F.col("level.rest").cast("double") * F.col("weight") / F.col("level.rest_weight")
    return s.select("source", "source_size", "weight", F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken per row of ``docs`` (and the columns ``keep``).

    Without ``keep`` the sizes are written once to the shared folder, so that
    the text is read once.
    """
    k = F.col(f"`{doc_id}`")
    kept = [F.col(f"`{c}`") for c in keep]
    sized = docs.select(k.alias("doc_id"), F.col(f"`{source}`").alias("source"), size_of(F.col(f"`{text}`")).alias("size"),
                        order_key(k, seed).alias("o"), *([F.struct(*kept).alias("row")] if keep else []))
    if not keep:
        sized = saved(sized, "mix-sizes")
    sized = sized.withColumn("slot", F.conv(F.substring("o", 1, 2), 16, 10).cast("int"))
    # words per slot, then running sums over at most SLOTS rows a source
    slots = sized.groupBy("source", "slot").agg(F.sum("size").alias("in_slot"))
    along = Window.partitionBy("source").orderBy("slot")
    slots = slots.withColumns({
        "before": F.coalesce(F.sum("in_slot").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "source_size": F.sum("in_slot").over(Window.partitionBy("source"))})
    level = targets(slots.groupBy("source").agg(F.sum("in_slot").alias("source_size")), weights, epochs)
    level = level.select(F.col("source").alias("s"), "target")
    slots = slots.join(level, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    slots = slots.select(F.col("source").alias("s"), F.col("slot").alias("b"), "before", "source_size", "target")
    got = sized.join(slots, F.col("source").eqNullSafe(F.col("s")) & (F.col("slot") == F.col("b"))).drop("s", "b")
    inside = Window.partitionBy("source", "slot").orderBy("o", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    got = got.withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    goal = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    got = got.withColumn("whole", whole).withColumn("part", goal - F.col("whole") * F.col("source_size"))
    more = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("ahead")))
    got = got.withColumn("taken", (F.col("whole") * F.col("size") + more).cast("long"))
    return got.select("doc_id", "source", "size", "source_size", "target", "taken", *(["row"] if keep else []))


def repeat(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` in the mix: a row for each whole repetition, and one cut after the words of a fractional one.

    A cut text is the beginning of its document, lines and spaces as they were, up to the end of its last word.

    A document without words has nothing to take and is left out of the mix.
    """
    names = docs.columns
    got = mix(docs, text, source, doc_id, keep=tuple(names), **options)
    n = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = F.pmod(F.col("taken"), F.col("size")).cast("int")
    pieces = F.concat(F.array_repeat(F.lit(0), n), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    got = got.filter("taken > 0").select("row", F.explode(pieces).alias("first_words"))
    t = F.col("row")[text]
    cut = F.array_join(F.slice(F.split(t, WORD_END), F.lit(1), F.col("first_words")), "")
    cell = lambda c: F.when(F.col("first_words") > 0, cut).otherwise(t) if c == text else F.col("row")[c]
    return got.select([cell(c).alias(c) for c in names])
