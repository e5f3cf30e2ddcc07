"""Line dedup by a suffix array over line ids.

Every text is a sequence of its lines that have a word; a line's id is its 64-bit hash. Prefix doubling ranks the
suffixes of all sequences by their first 1, 2, 4, ... lines: each round pairs the rank of a suffix with that of the
suffix as many lines further on, sorts the distinct pairs by range, and takes running counts as new ranks. Suffixes
that share a rank form an interval [rank, rank + n) of the suffix array whose common prefix has at least that many
lines; suffixes with a rank of their own drop out. A run of m lines is named by the ranks of its first and of its last
2^k lines (2^k <= m < 2^(k+1)), that is by its common-prefix interval of depth m. A run of at least ``min_words`` words
that stands earlier too (in order of doc_id, text, line) is a later copy, and its lines are deleted.

It is enough to look at runs that no shorter run of ``min_words`` words begins or ends: every line of a maximal repeated
run lies in such a run inside it. They have at most ``min_words`` lines, which bounds the rounds.

Null, empty and blank texts have no lines and stay as they are, as do blank lines. A null id sorts first. Rows equal in
id and text are one document and get the same result. Further columns are kept, whatever their names. An empty table
gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import BLANKS, SPACE_RUN, fresh, save

DOC = ["doc_id", "h"]
#: stands for a null id in keys, as joins drop nulls
NULL_ID = -(2 ** 63)


def _id(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID))


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, h, idx, pos, line id, words before, and the shortest long enough runs that begin and end at each line."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line"))),
                     lambda x: F.btrim(x["line"], F.lit(BLANKS)) != "")
    facts = F.transform(lines, lambda x: F.struct(x["pos"].alias("pos"), F.xxhash64(x["line"]).alias("line"),
                                                  F.size(F.split(F.btrim(x["line"], F.lit(BLANKS)), SPACE_RUN)).cast("long").alias("nw")))
    # equal rows are one document; grouped as the windows are partitioned, so the rows move once
    single = (docs.filter("text is not null").select(_id(docs).alias("doc_id"), F.xxhash64("text").alias("h"), facts.alias("lines"))
              .groupBy(*DOC).agg(F.first("lines").alias("lines")))
    rows = single.select(*DOC, F.posexplode_outer("lines").alias("idx", "x")).filter("x is not null").select(*DOC, "idx", "x.*")
    ordered = Window.partitionBy(*DOC).orderBy("idx")
    rows = rows.withColumn("end", F.sum("nw").over(ordered.rangeBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("begin", F.col("end") - F.col("nw"))
    doc = Window.partitionBy(*DOC)
    after = F.min("idx").over(doc.orderBy("begin").rangeBetween(min_words, Window.unboundedFollowing))
    before = F.max("idx").over(doc.orderBy("end").rangeBetween(Window.unboundedPreceding, -min_words))
    rows = (rows.withColumn("after", after).withColumn("before", before)
            .withColumn("words", F.max("end").over(doc)).withColumn("lines", F.max("idx").over(doc) + 1))
    to = F.coalesce(F.col("after"), F.when(F.col("words") - F.col("begin") >= min_words, F.col("lines")))
    since = F.coalesce(F.col("before") + 1, F.when(F.col("end") >= min_words, F.lit(0)))
    return save(rows.select(*DOC, "idx", "pos", "line", to.alias("to"), since.alias("since")), "dedup-lines")


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur at two or more places, with their rank: how many suffixes sort before."""
    place = F.struct(*DOC, "idx")
    found = (rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(place).alias("a"), F.max(place).alias("b"))
             .filter("a <> b").select(*keys, "n"))
    found = save(found.repartitionByRange(*keys).withColumn("slice", F.spark_partition_id()), "dedup-keys")
    sums = found.groupBy("slice").agg(F.sum("n").alias("n"))  # a row for each partition
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    own = Window.partitionBy("slice").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (found.withColumn("own", F.coalesce(F.sum("n").over(own), F.lit(0))).join(F.broadcast(starts), "slice")
             .select(*keys, (F.col("start") + F.col("own")).alias("rank")))
    return rows.join(ranks, keys).drop(*keys)


def repeated_runs(lines: DataFrame) -> DataFrame:
    """doc_id, h, idx, m: runs of m lines from line idx on that stand earlier too."""
    starts = lines.filter("to is not null").select(*DOC, "idx", (F.col("to") - F.col("idx")).alias("m"))
    ends = lines.filter("since is not null").select(*DOC, F.col("since").alias("idx"), (F.col("idx") + 1 - F.col("since")).alias("m"))
    runs = starts.unionByName(ends).distinct()
    level, out = 0, []
    ranks = save(_ranked(lines.select(*DOC, "idx", "line"), ["line"]), "dedup-ranks")
    most = runs.agg(F.max("m")).first()[0] or 0
    while 2 ** level <= most:
        size = 2 ** level
        own = runs.filter((F.col("m") >= size) & (F.col("m") < 2 * size))
        named = own.join(ranks, [*DOC, "idx"]).withColumnRenamed("rank", "first").withColumn("idx2", F.col("idx") + F.col("m") - size)
        named = named.join(ranks.select(*DOC, F.col("idx").alias("idx2"), F.col("rank").alias("last")), [*DOC, "idx2"])
        place, name = F.struct(*DOC, "idx"), ["m", "first", "last"]
        origin = named.groupBy(*name).agg(F.min(place).alias("origin"), F.max(place).alias("newest")).filter("origin <> newest")
        copies = named.join(origin, name).filter(F.col("origin") < place).select(*DOC, "idx", "m")
        out.append(save(copies, "dedup-copies"))
        if 2 * size > most:
            break
        ahead = Window.partitionBy(*DOC).orderBy("idx").rangeBetween(size, size)
        pairs = (ranks.withColumn("next", F.max("rank").over(ahead)).filter("next is not null")
                 .select(*DOC, "idx", F.col("rank").alias("r1"), F.col("next").alias("r2")))
        ranks = save(_ranked(pairs, ["r1", "r2"]), "dedup-ranks")
        level += 1
    empty = runs.filter("false")
    return reduce(DataFrame.unionByName, out, empty)


def dedup_lines(docs: DataFrame, min_words: int = 30) -> DataFrame:
    """All columns of ``docs`` with the cleaned text, and ``_removed``: how many lines went (a column of that name is replaced)."""
    doc, h, places = (fresh(docs.columns, x) for x in ("_doc", "_h", "_gone"))
    lines = line_table(docs.select("doc_id", "text"), min_words)
    gone = (repeated_runs(lines).select(*DOC, F.explode(F.sequence("idx", F.col("idx") + F.col("m") - 1)).alias("idx")).distinct()
            .join(lines.select(*DOC, "idx", "pos"), [*DOC, "idx"])
            .groupBy(*DOC).agg(F.array_sort(F.collect_set("pos")).alias(places)))  # at most the lines of one text
    gone = gone.select(F.col("doc_id").alias(doc), F.col("h").alias(h), places)
    joined = docs.join(gone, (_id(docs) == F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(h)), "left")
    kept = F.array_join(F.filter(F.split(docs["text"], "\n"), lambda _, i: ~F.array_contains(places, i)), "\n")
    return joined.select(*[F.when(F.col(places).isNull(), docs["text"]).otherwise(kept).alias("text") if c == "text" else docs[c]
                           for c in docs.columns if c != "_removed"], F.coalesce(F.size(places), F.lit(0)).alias("_removed"))
