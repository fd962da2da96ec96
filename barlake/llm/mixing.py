"""Sources mixed to target weights, with DataFrame functions only.

The words of each source are added up. Sources share SHARE times all words by their weights, and none
gets more than MOST times its own: what such a source leaves is shared again by weight among the
others, round by round, until none is above. All of that is exact in whole numbers. The repetition rate
of a source is its target over its size; each of its documents comes floor(rate) times, and once more
with a chance equal to the rest of the rate. The chance is a hash of the document, so reruns agree.

Weights go round by the sources' order by code point, a null source last. Size is the number of words
(ASCII white space between them); null text has none. Null and repeated ids do no harm: a row's chance
hangs on its id, source and text, and rows alike in these are numbered, so each has a chance of its own.
Sources without words have a target of 0 and none of their documents is taken. An empty table gives no
rows. Columns other than doc_id, text and source are carried along under whatever names.

The source with most rows is never gathered: sizes are added up in tasks first, targets come to the
rows by a checked broadcast or by salts. The table of sources may be long; it is ranked in ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.scratch import stored
from barlake.operators.lookup import attach

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Of all words, as a fraction.
SHARE = (3, 2)
MOST = 2
SEED = "mix"
#: Sources that one task ranks.
RANGE = 100_000
#: Hexadecimal digits of a hash that make a chance.
DIGITS = 13


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _present(value: Column) -> Column:
    """A text that tells null from every value."""
    return F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("n"))


def sized(docs: DataFrame) -> DataFrame:
    """(doc, size, of_source, of_doc): the row as it is, its words, and keys of its source and of itself."""
    doc = F.concat_ws("|", _present(F.col("doc_id")), _present(F.col("source")), _present(F.md5(F.col("text").cast("string"))))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        word_count(F.col("text")).alias("size"),
        _present(F.col("source")).alias("of_source"),
        F.md5(doc).alias("of_doc"),
    )


def ranked(sources: DataFrame, by: str) -> DataFrame:
    """The rows with their ``rank`` from 0 on by a unique column; no task sorts more than a range of them."""
    ranges = 1 + sources.count() // RANGE
    laid = stored(sources.repartitionByRange(ranges, by).withColumn("range", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    before = laid.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(by)) - 1
    return laid.withColumn("inside", inside).join(before, "range").withColumn("rank", F.col("inside") + F.col("before")).drop("range", "inside", "before")


def targets(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST
) -> DataFrame:
    """(of_source, source_size, target) of ``sized`` rows: at most ``most`` times each source's size.

    The level, words per unit of weight, rises round by round as full sources leave their rest to the
    others. One row comes to the driver in each round; full sources never become unfull.
    """
    sizes = rows.groupBy("of_source").agg(F.sum("size").alias("source_size"))
    # "n", the null source, would come before "v...".
    placed = sizes.withColumn("place", F.when(F.col("of_source") == "n", F.lit("w")).otherwise(F.col("of_source")))
    turn = (F.col("rank") % len(weights) + 1).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("turn"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    found = stored(
        ranked(placed, "place").withColumn("turn", turn).withColumns({"weight": weight, "full": F.col("source_size") * most}),
        "sources",
    )
    total = found.agg(F.sum("source_size")).first()[0] or 0
    is_full, n_full = F.lit(False), -1
    rest, weighing = 0, 1
    while True:
        # The level is rest / (share[1] * weighing).
        row = found.agg(
            F.sum(F.when(is_full, wide("full"))).alias("taken"),
            F.sum(F.when(~is_full, F.col("weight"))).alias("weighing"),
            F.count_if(is_full).alias("n"),
        ).first()
        if row["n"] == n_full or not row["weighing"]:
            break
        n_full, weighing = row["n"], row["weighing"]
        rest = share[0] * total - share[1] * int(row["taken"] or 0)
        one, other = (F.lit(str(x)).cast("decimal(38,0)") for x in (share[1] * weighing, rest))
        # Products of such sums may need more than 64 bits.
        is_full = wide("full") * one <= other * wide("weight")
    level = F.array(*[F.lit(float(w * rest) / float(share[1] * weighing)) for w in weights])
    target = F.when(is_full, F.col("full").cast("double")).otherwise(F.element_at(level, F.col("turn")))
    return found.select("of_source", "source_size", target.alias("target"))


def numbered_twins(rows: DataFrame) -> DataFrame:
    """The rows with ``twin``: 1 for the first of rows with one ``of_doc``, 2 for the next, and so on.

    Twins are interchangeable. They are numbered inside tasks, and tasks by how many came before, so
    a crowd of them is never in one place.
    """
    repeated = rows.groupBy("of_doc").count().where("count > 1").select("of_doc")
    if repeated.isEmpty():
        return rows.withColumn("twin", F.lit(1).cast("long"))
    whole = stored(rows.withColumn("place", F.monotonically_increasing_id()), "with-twins")
    task = F.shiftright("place", 33)
    twins = attach(whole.select("place", "of_doc", task.alias("task")), repeated, ["of_doc"], "left_semi")
    inside = F.row_number().over(Window.partitionBy("of_doc", "task").orderBy("place"))
    earlier = Window.partitionBy("of_doc").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = twins.groupBy("of_doc", "task").count()
    before = before.select("of_doc", "task", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    twin = twins.withColumn("inside", inside).join(before, ["of_doc", "task"])
    twin = twin.select("place", (F.col("inside") + F.col("before")).alias("twin"))
    return whole.join(twin, "place", "left").withColumn("twin", F.coalesce("twin", F.lit(1).cast("long"))).drop("place")


def plan_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """(doc, size, source_size, target, copies): every row as a struct, and how often the mix takes it."""
    rows = sized(docs)
    met = attach(numbered_twins(rows), targets(rows, weights, share, most), ["of_source"], "inner")
    rate = F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))
    drawn = F.md5(F.concat_ws(":", F.lit(seed), F.col("of_doc"), F.col("twin").cast("string")))
    chance = F.conv(F.substring(drawn, 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    planned = met.withColumn("rate", F.coalesce(rate, F.lit(0.0)))
    return planned.select("doc", "size", "source_size", "target", copies.cast("int").alias("copies"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, each as often as it is taken; ``settings`` as for ``plan_mix``."""
    planned = plan_mix(docs, **settings).where("copies > 0")
    return planned.select("doc", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*")


def taken_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each document: the words that the mix takes of it."""
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return plan_mix(docs).select(F.col("doc.doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", taken)


def oracle() -> str:
    """The same for DuckDB: sources are filled in the order of full words per weight."""
    return rf"""
WITH sized AS (
  SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
    row_number() OVER (PARTITION BY doc_id, source, text) AS twin
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(2 * sum(size) AS BIGINT) AS fill,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), filling AS (
  SELECT *, 3 * sum(source_size) OVER () - 2 * coalesce(sum(fill) OVER before, 0) AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weighing
  FROM sources
  WINDOW before AS (ORDER BY fill * (10 // weight), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT max(weighing) AS weighing, arg_max(rest, weighing) AS rest
  FROM filling WHERE 2 * fill * weighing > rest * weight
), targets AS (
  SELECT source, source_size,
    CASE WHEN l.weighing IS NULL OR 2 * fill * l.weighing <= l.rest * weight THEN CAST(fill AS DOUBLE)
         ELSE CAST(weight * l.rest AS DOUBLE) / CAST(2 * l.weighing AS DOUBLE) END AS target
  FROM sources, level l
), rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    CAST('0x' || substr(md5(concat_ws(':', 'mix', md5(concat_ws('|', coalesce('v' || d.doc_id, 'n'), coalesce('v' || d.source, 'n'),
      coalesce('v' || md5(d.text), 'n'))), d.twin)), 1, 13) AS BIGINT) / CAST(4503599627370496 AS DOUBLE) AS chance
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  size * (CAST(floor(rate) AS BIGINT) + CAST(chance < rate - floor(rate) AS BIGINT)) AS taken
FROM rated
"""
