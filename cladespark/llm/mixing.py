"""Mixing sources to target weights, in column expressions only.

The words of a source are one long sequence, cut into blocks of ``block`` words (the last one may be shorter);
documents stand in it in an order given by hashes. The mix is a list of slots, ``shard`` of them in each output shard. For
each shard a multinomial count of slots is drawn for every source; counting on from shard to shard, a source's slots are
its draws 0, 1, 2, ..., and draw k takes block p(k mod n) of its n blocks, where p is a pseudorandom permutation of that source
and of the turn k div n. So no block comes again before all others of its source came, and slots and blocks meet in an equi-join by (source, block).

Targets: sources in order of code points, null last, have the weights in turn and share ``share`` times all words; a source stops at
``most`` times its words, and the excess is shared again by weight until none is above. A source has as many
draws as bring it nearest to its target, ``most`` times its blocks at most. The multinomial draws miss these quotas by
chance: draws of a source beyond its quota go to the sources that lack some, in order. So the words that are taken
of a source differ from its target by less than two blocks, and no word is taken more than ``most`` times.

Permutations are swap-or-not shuffles (Hoang, Morris, Rogaway 2012): in each round x is exchanged with key - x mod n, or
not, by a bit of a hash of the larger of both. That is a permutation for any n, in plain arithmetic.

At scale: text is read once, to count words; everything else is numbers. Running sums go by stretches, whose sums are
summed first, so no task sees all documents of a source or all shards. Draws are counted before they are shuffled and
become rows only when the counts are spread out. Tables of sources are broadcast only if they are short.

Defined results: null and empty texts have no words and are never taken; null is a source of its own, and so is the empty
text; repeated rows are documents of their own; null keys are keys; an empty table, or one without words, gives no spans. The same
rows in any order give the same mix. Further columns are left out, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import numbered_in_order
from ..storage import Scratch, scratch
from .joins import attached

WHITE = " \t\n\x0b\x0c\r"
#: Rows of a stretch in a running sum, and words (and documents) of a group in which a source's documents are put in order.
STRETCH, GROUP = 4096, 1 << 18
#: Slots that a task makes of their counts.
SLOTS = 200_000
#: Rounds of a permutation: two neighbours stay neighbours with a chance of 2^-16. From about 20 on the JVM doesn't compile the generated code.
ROUNDS = 16


class Recipe(NamedTuple):
    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    block: int = 32
    shard: int = 1024
    seed: int = 1


def n_words(text: Column) -> Column:
    """How many runs without white space a text has: each becomes one letter first."""
    return F.coalesce(F.char_length(F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), WHITE, "")), F.lit(0)).cast("long")


def before(df: DataFrame, by: list[str], place: str, amount: str, name: str) -> DataFrame:
    """Adds the sum of ``amount`` over all rows of the same ``by`` with a smaller ``place`` (whole numbers, each once)."""
    by = by or ["_all"]
    cut = df.withColumns({"_stretch": F.floor(F.col(place) / STRETCH)} | ({"_all": F.lit(0)} if by == ["_all"] else {}))
    earlier = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*by, "_stretch").agg(F.sum(amount).alias("_sum")).select(*by, "_stretch", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"))
    within = Window.partitionBy(*by, "_stretch").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    own = cut.withColumn("_own", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return own.join(sums, [*by, "_stretch"]).withColumn(name, F.col("_own") + F.col("_earlier")).drop("_stretch", "_own", "_earlier", "_sum", "_all")


def shuffled(df: DataFrame, place: str, n: str, keys: list[Column], name: str) -> DataFrame:
    """Adds the place of a place in a pseudorandom permutation of 0 to n - 1 that the keys name.

    Each round is a step of the plan, so that generated code runs it.
    """
    out = df.withColumns({"_key": F.xxhash64(*keys), "_x": F.col(place).cast("long")})
    for r in range(ROUNDS):
        out = out.withColumn("_other", F.pmod(F.pmod(F.xxhash64("_key", F.lit(r)), F.col(n)) - F.col("_x"), F.col(n)))
        out = out.withColumn("_x", F.when(F.xxhash64("_key", F.lit(r), F.greatest("_x", "_other")) < 0, F.col("_other")).otherwise(F.col("_x")))
    return out.withColumn(name, F.col("_x")).drop("_key", "_x", "_other")


def sources_of(docs: DataFrame, recipe: Recipe, tables: Scratch) -> DataFrame:
    """source, number (from 0), words, documents, target, blocks, quota of each source, from documents with size."""
    sums = tables.keep(docs.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("documents")), "sums")
    named = sums.filter("source is not null")
    known = named.count()
    numbered = numbered_in_order(named, ["source"]).withColumn("number", F.col("k") - 1).drop("k").unionByName(sums.filter("source is null").withColumn("number", F.lit(known).cast("long")))
    weights = F.array(*(F.lit(w) for w in recipe.weights))
    weighed = tables.keep(numbered.withColumn("weight", F.get(weights, F.pmod("number", F.lit(len(recipe.weights))))), "sources")
    goal = recipe.share * (weighed.agg(F.sum("words")).first()[0] or 0)
    full, level, last = F.lit(False), 0.0, -1.0
    while level != last:  # each turn fills further sources, so it ends
        stopped, weight = weighed.agg(F.coalesce(F.sum(F.when(full, F.col("words"))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        last, level = level, (goal - recipe.most * stopped) / weight if weight else 0.0
        if weight:
            full = F.col("words") * recipe.most < F.col("weight") * level
        else:
            break
    target = F.when(full, F.col("words") * float(recipe.most)).otherwise(F.col("weight") * F.lit(float(level))).cast("double")
    blocks = F.ceil(F.col("words") / recipe.block)
    quota = F.when(F.col("words") > 0, F.least(F.round(F.col("target") * F.col("blocks") / F.col("words")).cast("long"), F.col("blocks") * recipe.most)).otherwise(F.lit(0).cast("long"))
    return tables.keep(weighed.withColumn("target", target).withColumn("blocks", blocks).withColumn("quota", quota).drop("weight"), "targets")


def placed(docs: DataFrame, sources: DataFrame, tables: Scratch) -> DataFrame:
    """number, key, mark, size, start (place of the first word in its source; null without words) of each document."""
    groups = F.ceil((F.col("words") + F.col("documents")) / GROUP)
    all_docs = attached(docs, sources.select(F.col("source").alias("_of"), "number", groups.alias("groups")), "source", "_of")
    filled = all_docs.filter("size > 0").withColumn("group", F.pmod(F.xxhash64("key", "mark", "size"), F.col("groups")))
    sums = before(filled.groupBy("number", "group").agg(F.sum("size").alias("words")), ["number"], "group", "words", "earlier").select("number", "group", "earlier")
    within = Window.partitionBy("number", "group").orderBy("key", "mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    own = filled.withColumn("own", F.coalesce(F.sum("size").over(within), F.lit(0))).join(sums, ["number", "group"])
    columns = ["number", "key", "mark", "size"]
    return tables.keep(own.select(*columns, (F.col("own") + F.col("earlier")).alias("start")).unionByName(all_docs.filter("size = 0").select(*columns, F.lit(None).cast("long").alias("start"))), "placed")


def drawn(sources: DataFrame, recipe: Recipe, tables: Scratch) -> DataFrame:
    """shard, slot (both from 0), number, draw, block of each slot of the mix."""
    spark = sources.sparkSession
    ranges = tables.keep(before(sources.select("number", "quota"), [], "number", "quota", "low"), "ranges")
    count, slots = ranges.agg(F.count(F.lit(1)), F.coalesce(F.sum("quota"), F.lit(0))).first()
    # a whole number below all slots falls into the range of a source; ranges are found by the cells they lie in
    cell = max(1, slots // max(1, 4 * count))
    cells = ranges.filter("quota > 0").select("number", "low", (F.col("low") + F.col("quota")).alias("high"))
    cells = cells.withColumn("cell", F.explode(F.sequence(F.expr(f"low div {cell}"), F.expr(f"(high - 1) div {cell}"))))
    fall = spark.range(slots).select((F.expr(f"id div {recipe.shard}")).alias("shard"), F.pmod(F.xxhash64(F.lit(recipe.seed), "id"), F.lit(max(1, slots))).alias("fell"))
    fall = attached(fall.withColumn("at", F.expr(f"fell div {cell}")), cells, "at", "cell").filter("fell >= low and fell < high")
    counts = tables.keep(fall.groupBy("shard", "number").agg(F.count(F.lit(1)).alias("n")), "counts")
    by_shard = Window.partitionBy("shard").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    spread = before(counts, ["number"], "shard", "n", "first").withColumn("place", F.coalesce(F.sum("n").over(by_shard), F.lit(0)))
    # draws beyond a quota are as many as lack elsewhere: both are numbered in the order of sources and meet by number
    made = sources.select("number", "blocks", "quota").join(counts.groupBy("number").agg(F.sum("n").alias("made")), "number", "left").fillna(0, ["made"])
    odd = made.select("number", "blocks", "quota", "made", F.greatest(F.col("made") - F.col("quota"), F.lit(0)).alias("over"), F.greatest(F.col("quota") - F.col("made"), F.lit(0)).alias("under"))
    odd = tables.keep(before(before(odd, [], "number", "over", "over_before"), [], "number", "under", "under_before"), "odd")
    told = attached(spread, odd.select(F.col("number").alias("_of"), "blocks", "quota", "over_before"), "number", "_of")
    told = tables.keep(told.withColumn("good", F.least(F.col("n"), F.greatest(F.col("quota") - F.col("first"), F.lit(0)))), "told")
    rows = lambda df, low, high: df.filter(F.col(low) < F.col(high)).withColumn("i", F.explode(F.sequence(low, F.col(high) - 1)))
    zero = lambda df: df.withColumn("zero", F.lit(0).cast("long"))
    tasks = max(1, -(-slots // SLOTS))
    kept = rows(zero(told).repartition(tasks, "shard"), "zero", "good").select("shard", (F.col("place") + F.col("i")).alias("place"), "number", "blocks", (F.col("first") + F.col("i")).alias("draw"))
    spare = rows(told, "good", "n").select("shard", (F.col("place") + F.col("i")).alias("place"), (F.col("over_before") + F.col("first") + F.col("i") - F.col("quota")).alias("spare"))
    lacking = rows(zero(odd), "zero", "under").select((F.col("under_before") + F.col("i")).alias("spare"), "number", "blocks", (F.col("made") + F.col("i")).alias("draw"))
    drew = kept.unionByName(spare.join(lacking, "spare").select("shard", "place", "number", "blocks", "draw"))
    drew = drew.withColumns({"in_shard": F.least(F.lit(recipe.shard), F.lit(slots) - F.col("shard") * recipe.shard), "index": F.col("draw") % F.col("blocks")})
    seated = shuffled(drew, "place", "in_shard", [F.lit(recipe.seed), F.col("shard")], "slot")
    seated = tables.keep(seated.select("shard", "slot", "number", "draw", "index", "blocks"), "seated")  # generated code of both permutations would be too long to be compiled
    chosen = shuffled(seated, "index", "blocks", [F.lit(recipe.seed), F.col("number"), F.expr("draw div blocks")], "block")
    return tables.keep(chosen.select("shard", "slot", "number", "draw", "block"), "slots")  # a table, as joins above so many steps are slow to plan


def spans_of(documents: DataFrame, slots: DataFrame, recipe: Recipe) -> DataFrame:
    """shard, slot, number, block, at, key, mark, start, begin, length: what each slot takes of which document.

    at: words of the slot before; begin: words of the document before; start: the place of the document in its source, which tells
    documents with the same key apart.
    """
    size = recipe.block
    pieces = documents.filter("start is not null").withColumn("block", F.explode(F.sequence(F.expr(f"start div {size}"), F.expr(f"(start + size - 1) div {size}"))))
    begin, end = F.greatest(F.col("block") * size - F.col("start"), F.lit(0)), F.least((F.col("block") + 1) * size - F.col("start"), F.col("size"))
    pieces = pieces.select("number", "block", F.greatest(F.col("start") - F.col("block") * size, F.lit(0)).alias("at"), "key", "mark", "start", begin.alias("begin"), (end - begin).alias("length"))
    return slots.join(pieces, ["number", "block"]).select("shard", "slot", "number", "block", "at", "key", "mark", "start", "begin", "length")


class Mix(NamedTuple):
    sources: DataFrame
    documents: DataFrame
    spans: DataFrame


def mix(docs: DataFrame, tables: Scratch, recipe: Recipe = Recipe(), key: str = "doc_id", text: str = "text", source: str = "source") -> Mix:
    """The sources with their targets, the documents in their places, and the spans of the mix."""
    sized = docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), F.xxhash64(text).alias("mark"))
    counted = tables.keep(sized, "sizes")
    sources = sources_of(counted, recipe, tables)
    documents = placed(counted, sources, tables)
    return Mix(sources, documents, spans_of(documents, drawn(sources, recipe, tables), recipe))


def texts(spans: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """shard, slot, text (the words of the slot, a space between them) of a mix of ``docs``."""
    own = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_mark"), F.col(text).alias("_text")).dropDuplicates(["_key", "_mark"])
    cut = spans.join(own, F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark")))
    words = F.slice(F.regexp_extract_all("_text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), (F.col("begin") + 1).cast("int"), F.col("length").cast("int"))
    parts = cut.select("shard", "slot", F.struct("at", F.array_join(words, " ").alias("said")).alias("part"))
    return parts.groupBy("shard", "slot").agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["said"]), " ").alias("text"))


def taken(docs: DataFrame, recipe: Recipe = Recipe(), key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """key, size, source_size, target (its source's), taken (words of it in the mix), one row for each row."""
    with scratch(docs.sparkSession) as tables:
        made = mix(docs, tables, recipe, key, text, source)
        sums = made.spans.groupBy("number", "start").agg(F.sum("length").alias("taken"))
        told = attached(made.documents, made.sources.select(F.col("number").alias("_of"), F.col("words").alias("source_size"), "target"), "number", "_of")
        return told.join(sums, ["number", "start"], "left").select(F.col("key").alias(key), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")).checkpoint()
