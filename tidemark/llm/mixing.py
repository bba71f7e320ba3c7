"""Mixing sources to target weights by weighted fair queueing.

The documents of a source queue in shuffled order, again for each repetition. A document's
virtual finish time is the number of its source's words up to its end, over the source's
target; the mix takes documents by finish time until the total budget is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.prefix import running_sums
from tidemark.session import cut

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def uid_of(docs: DataFrame) -> Column:
    """A SHA-256 of the whole row: of each column, whether it is null, its length and its value."""

    def value(field: T.StructField) -> Column:
        of = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            of = F.to_json(F.struct(of.alias("v")), {"ignoreNullFields": "false"})
        elif isinstance(field.dataType, T.TimestampType):
            of = F.unix_micros(of)  # the local time repeats an hour in autumn
        return of.cast("string")

    values = [value(f) for f in docs.schema]
    parts = [p for v in values for p in (F.coalesce(F.octet_length(v).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(v, F.lit("")))]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def source_targets(
    sizes: DataFrame, cycle: tuple[float, ...], budget: float, repeats: int
) -> tuple[DataFrame, int]:
    """Targets of the sources in (source, source_size), and the total budget in words.

    Sources in code point order, null last, weigh ``cycle`` again and again and share
    ``budget`` times all words. A target stops at ``repeats`` times its source; the excess
    is shared by weight among the rest until none is above. Each round of that is one
    aggregate over the sources; the driver sees two sums.
    """
    ordered = running_sums(
        sizes.withColumn("_one", F.lit(1).cast("long")),
        [F.col("source").isNull().asc(), F.col("source").asc()],
        {"_one": "_place", "source_size": "_upto"},
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), ((F.col("_place") - 1) % len(cycle) + 1).cast("int"))
    table = cut(
        ordered.select(
            "source",
            "source_size",
            F.col("_place").alias("place"),
            (F.col("_upto") - F.col("source_size")).alias("offset"),
            weight.alias("weight"),
            (F.col("source_size") * float(repeats)).alias("cap"),
        )
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("weight") * level > F.col("cap")
        row = table.agg(F.sum(F.when(full, F.col("cap"))).alias("caps"), F.sum(F.when(~full, F.col("weight"))).alias("weights")).first()
        if not row.weights:
            break
        higher = (budget * total - (row.caps or 0.0)) / row.weights
        if higher <= level:
            break
        level = higher
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level))
    return table.withColumn("target", target).drop("cap"), int(budget * total)


def plan_mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", cycle: tuple[float, ...] = (5, 2, 1), budget: float = 1.5, repeats: int = 2, seed: int = 17
) -> DataFrame:
    """One row per document: key, ``uid``, size, source, source_size, target, copies, taken.

    ``copies`` is how often the mix takes the document, at most ``repeats``; ``taken`` is
    that times its size. Documents are taken whole, so a source ends within one document
    of its target. Documents without a word are never taken. A null key or source is a
    value like others; repeated rows queue each by itself. ``uid`` hashes all
    columns and serves to find the documents again. Texts are read once; after that only
    narrow rows move, dealt out by range, so a source of any size is split.
    """
    base = cut(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            uid_of(docs).alias("uid"),
            word_count(F.col(text)).alias("size"),
            F.xxhash64(F.lit(seed), F.col(key)).alias("shuffled"),
        ).withColumn("row", F.monotonically_increasing_id())
    )
    sizes = cut(base.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources, total = source_targets(sizes, cycle, budget, repeats)
    ties = [F.col(c).asc() for c in ("shuffled", "uid", "row")]
    queued = running_sums(base, [F.col("source").isNull().asc(), F.col("source").asc(), *ties], {"size": "upto"})
    named = sources.withColumnRenamed("source", "of")
    turns = (
        queued.join(named, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn(
            "finish",
            F.when(
                (F.col("size") > 0) & (F.col("target") > 0),
                (F.col("turn") * F.col("source_size") + F.col("upto") - F.col("offset")) / F.col("target"),
            ),
        )
        .drop("of", "offset", "weight", "upto")
    )
    used = running_sums(turns, [F.col("finish").asc_nulls_last(), F.col("place").asc(), *ties, F.col("turn").asc()], {"size": "used"})
    takes = F.col("finish").isNotNull() & (F.col("used") <= F.lit(total))
    one = lambda c: F.first(c).alias(c)
    return (
        used.groupBy("row")
        .agg(one("key"), one("uid"), one("source"), one("size"), one("source_size"), one("target"), F.sum(takes.cast("int")).alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .withColumnRenamed("key", key)
        .drop("row")
    )


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The documents of the mix with their own columns, whatever their names, each as often
    as it is taken; rows are one document only if they agree in all columns.
    """
    plan = cut(plan_mix(docs, key, source, text, **how))
    copies = plan.groupBy("uid").agg(F.sum("copies").alias("copies")).filter("copies > 0")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    kept = docs.select(uid_of(docs).alias("uid"), whole).join(copies, "uid").dropDuplicates(["uid"])
    return kept.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
