"""Mixing sources to target weights (operator 4): whole copies and Pareto order sampling, in DataFrame functions only.

Every source has a weight; the sources share the words of all documents by weight, none above `MOST` times its own
words. A document's share is its source's target over the source's words: the integer part is that many certain copies.
The rest of the target, R words, is sampled: inclusion probabilities are proportional to size, min(1, c * size), with c
such that the expected words are R; probability one is another certain copy. The others are ranked by

    q = (u / (1 - u)) / (p / (1 - p)),   u from a hash of doc_id and seed,

Pareto order sampling, and taken in that order up to the document that would bring the words more than half its size
over R: a sample of fixed size in words.

The order is cut without sorting a source in one task. q / (q + typical q) falls into buckets of about `BUCKET`
documents; sums of buckets give each bucket's place, buckets before the cut are taken whole, and only the one bucket
that holds the cut is sorted.

Defined cases: null text and text without words has size 0 and takes 0; null sources are one source, ordered last;
repeated rows share u and are taken by their place in the order; a null doc_id hashes as the text ``null``; an empty
table gives an empty result; other columns are not read. The same rows give the same mix on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.tables import stored

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix-1"
BUCKET = 1000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, n_docs, source_size, target): water filling over the sources, of which there are few rows.

    Sorted by how soon they fill up, a source is full if the level, with all fuller ones full, lies above it."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int")).cast("long")
    s = s.withColumn("weight", weight).withColumn("full", most * F.col("source_size"))
    s = s.withColumn("full_at", F.col("full") / F.col("weight"))
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0))
    share = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", left / share)
    level = F.min_by(F.when(F.col("level") <= F.col("full_at"), F.col("level")),
                     F.when(F.col("level") <= F.col("full_at"), F.col("full_at"))).over(everything)
    target = F.when(F.col("level") <= F.col("full_at"), level * F.col("weight")).otherwise(F.col("full").cast("double"))
    return s.select("source", "n_docs", "source_size", target.alias("target"))


def inclusion(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, n_docs, source_size, target, copies, rest, scale): the certain copies of every document of a source, the
    words left to sample, and c of the inclusion probability min(1, c * size).

    The largest sizes reach one first. Documents are summed by size beforehand, so a source has a row a distinct size."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets.withColumn("copies", copies.cast("long"))
    plan = stored(plan.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")), "mix-plan")
    by_size = sizes.where("size > 0").groupBy("source", "size").count()
    words = (F.col("size") * F.col("count")).cast("decimal(38,0)")
    squares = (F.col("size").cast("decimal(19,0)") * F.col("size").cast("decimal(18,0)")).cast("decimal(38,0)") * F.col("count").cast("decimal(18,0)")
    by_size = by_size.withColumn("words", words).withColumn("squares", squares.cast("decimal(38,0)"))
    larger = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(0, Window.unboundedFollowing)
    by_size = by_size.select(
        "source", "size", F.coalesce(F.sum("words").over(larger), F.lit(0)).cast("double").alias("sure"),
        F.sum("squares").over(rest).cast("double").alias("squares"))
    joined = by_size.withColumnRenamed("source", "s").join(plan, F.equal_null(F.col("s"), F.col("source")))
    c = (F.col("rest") - F.col("sure")) / F.col("squares")
    valid = (c >= 0) & (c * F.col("size") <= 1)
    scales = joined.groupBy("s").agg(F.max_by(F.when(valid, c), F.when(valid, F.col("size"))).alias("scale"))
    return plan.join(scales, F.equal_null(F.col("s"), F.col("source")), "left").drop("s")


def _drawn(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """``rows`` (doc_id, source, size and others) with their source's plan, the words of certain copies, the words in the
    pool, and their place in Pareto order: bucket and q."""
    p = plan.select(F.col("source").alias("s"), "n_docs", "source_size", "target", "copies", "rest", "scale")
    drawn = rows.join(p, F.equal_null(F.col("s"), F.col("source"))).drop("s")
    chance = F.least(F.lit(1.0), F.coalesce(F.col("scale"), F.lit(0.0)) * F.col("size"))
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("|" + seed))
    u = (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    drawn = drawn.withColumn("p", chance).withColumn("u", u)
    sure = F.col("p") >= 1
    drawn = drawn.withColumn("sure", sure).withColumn("certain", (F.col("copies") + sure.cast("long")) * F.col("size"))
    drawn = drawn.withColumn("left", F.when(sure | (F.col("p") <= 0) | (F.col("size") <= 0), F.lit(0)).otherwise(F.col("size")))
    drawn = drawn.withColumn("q", F.when(F.col("left") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))))
    mean = F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.col("rest") / F.col("source_size")))
    typical = (1 - mean) / mean
    buckets = F.floor(F.col("n_docs") / BUCKET) + 1
    drawn = drawn.withColumn("bucket", F.when(F.col("left") > 0, F.floor(buckets * F.col("q") / (F.col("q") + typical))))
    return drawn.select(*rows.columns, "source_size", "target", "rest", "certain", "left", "q", "bucket", "sure")


def _mixed(docs: DataFrame, weights: tuple[int, ...], most: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """The mix, with source and place in the order of every document, and the plan of the sources."""
    sizes = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count().alias("size")), "mix-sizes")
    plan = stored(inclusion(sizes, source_targets(sizes, weights, most)), "mix-scales")
    drawn = _drawn(sizes, plan, seed)
    totals = drawn.groupBy("source", "bucket").agg(
        F.sum("left").alias("words"), F.sum(F.when(F.col("sure"), F.col("size")).otherwise(F.lit(0))).alias("sure_words"))
    upto = Window.partitionBy("source").orderBy(F.col("bucket").asc_nulls_last())
    totals = totals.withColumn("after", F.sum("words").over(upto)).withColumn("before", F.col("after") - F.col("words"))
    totals = totals.withColumn("sure_words", F.sum("sure_words").over(Window.partitionBy("source")))
    totals = stored(totals.where("bucket is not null").select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before", "after", "sure_words"), "mix-buckets")
    placed = drawn.where("left > 0").join(totals, F.equal_null("s", "source") & (F.col("b") == F.col("bucket")))
    wanted = F.col("rest") - F.col("sure_words")
    whole = F.col("after") <= wanted
    cut = (F.col("before") <= wanted) & ~whole
    result = ("doc_id", "size", "source_size", "target", "source", "bucket", "q")

    def taking(rows: DataFrame, chosen: Column) -> DataFrame:
        return rows.select(*result, (F.col("certain") + F.when(chosen, F.col("size")).otherwise(F.lit(0))).alias("taken"), chosen.alias("chosen"))

    order = Window.partitionBy("source", "bucket").orderBy("q", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = placed.where(cut).withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    out = taking(drawn.where("left <= 0"), F.lit(False)).union(taking(placed.where(~cut), whole)).union(
        taking(edge, F.col("start") + F.col("size") / 2 <= wanted))
    return out, plan


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document; ``taken`` is a multiple of its size."""
    return _mixed(docs, weights, most, seed)[0].select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The documents, each as often as the mix takes it. Documents without words are taken no time.

    A source's sample is all documents up to one place of its order, so a row a source is enough to tell, and the texts
    stay where they are. Rows that repeat doc_id and size share a place and are taken alike."""
    rows, plan = _mixed(docs, weights, most, seed)
    last = rows.where("chosen").groupBy("source").agg(F.max(F.struct("bucket", "q", "doc_id", "size")).alias("last"))
    plan = stored(plan.join(last.withColumnRenamed("source", "s"), F.equal_null(F.col("s"), F.col("source")), "left").drop("s"), "mix-last")
    columns = [F.col(c) for c in docs.columns if c not in ("doc_id", "source")]
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count().alias("size"), F.struct(*columns).alias("others"))
    ends = plan.select(F.col("source").alias("s"), "last")
    drawn = _drawn(sized, plan, seed).join(ends, F.equal_null(F.col("s"), F.col("source")))
    chosen = F.coalesce(F.struct("bucket", "q", "doc_id", "size") <= F.col("last"), F.lit(False)) & (F.col("left") > 0)
    copies = F.when(F.col("size") > 0, (F.col("certain") / F.col("size")).cast("int") + chosen.cast("int")).otherwise(F.lit(0))
    taken = drawn.withColumn("copies", copies).where("copies > 0").select(
        "doc_id", "source", "others", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    kinds = dict(docs.dtypes)
    own = {"doc_id": F.col("doc_id").cast(kinds["doc_id"]), "source": F.col("source")}
    return taken.select(*[(own[c] if c in own else F.col("others")[c]).alias(c) for c in docs.columns])
