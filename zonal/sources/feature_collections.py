"""Features of GeoJSON collections, read by many tasks however few files or lines they come in.

A collection is one JSON document. Here it is read as text cut at every `}`, which Spark does in
byte ranges, and each piece is summed up without knowing what came before: how many quotes it holds,
and by how much it deepens the nesting if it starts outside a string, and if inside. Those summaries
add up, first over the pieces of a byte range, then over the ranges of a file (one row each), and
give every piece the state it starts in. A feature ends where a `}` leaves just the document and one
array open; pieces between two such ends are one feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Root-level text up to a key that opens an array: whole strings, and anything that is neither a
# quote nor an object.
_SKIP = r'(?s)^\s*\{?(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*?'
_OPENS = _SKIP + r'"((?:[^"\\]++|\\.)*+)"\s*:\s*\[\s*(\{.*)$'
_ODD = _SKIP + r'"features"\s*:\s*\[\s*[^\s\]{]'
_HOLDS = _SKIP + r'"features"\s*:\s*\['
_NEXT = r"(?s)^\s*,?\s*(\{.*)$"
_CLOSES = r"(?s)^\s*\](.*)$"

RANGE = ("file", "range")


def _pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text pieces with file, range (where its byte range starts) and place, and their summaries."""
    read = spark.read.option("lineSep", "}").text(paths)
    pieces = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("text"),
    )
    parts = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"', -1)

    def count(text: Column, char: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))

    pieces = pieces.withColumn("parts", parts).withColumn("quotes", F.size("parts") - 1)
    every_other = (lambda _, i: i % 2 == 0, lambda _, i: i % 2 == 1)
    for start in (0, 1):  # outside and inside a string
        pieces = pieces.withColumn("plain", F.array_join(F.filter("parts", every_other[start]), ""))
        closing = F.when((F.col("quotes") + start) % 2 == 0, 1).otherwise(0)
        pieces = pieces.withColumn(f"curly{start}", count(F.col("plain"), "{") - closing)
        pieces = pieces.withColumn(f"square{start}", count(F.col("plain"), "[") - count(F.col("plain"), "]"))
    return pieces.drop("parts", "plain")


def _before(column: str, along: Window) -> Column:
    return F.coalesce(F.sum(column).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _chosen(state: Column, name: str) -> Column:
    return F.when(state % 2 == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))


def _states(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces with the state they start in (quoted, curly, square), and per file the state at its end."""
    inside = Window.partitionBy(*RANGE).orderBy("place")
    pieces = pieces.withColumn("quotes_before", _before("quotes", inside))
    totals = [F.sum("quotes").alias("quotes")]
    for start in (0, 1):
        state = F.col("quotes_before") + start
        totals += [F.sum(_chosen(state, n)).alias(f"{n}{start}") for n in ("curly", "square")]
    ranges = pieces.groupBy(*RANGE).agg(*totals)
    over = Window.partitionBy("file").orderBy("range")
    ranges = ranges.withColumn("quotes_then", _before("quotes", over))
    for n in ("curly", "square"):
        ranges = ranges.withColumn(n, _chosen(F.col("quotes_then"), n))
    starts = ranges.select(*RANGE, "quotes_then", *[_before(n, over).alias(f"{n}_then") for n in ("curly", "square")])
    ends = ranges.groupBy("file").agg(*[F.sum(n).alias(n) for n in ("quotes", "curly", "square")])
    placed = pieces.join(starts, list(RANGE)).withColumn("quoted", (F.col("quotes_before") + F.col("quotes_then")) % 2)
    for n in ("curly", "square"):
        placed = placed.withColumn(f"{n}_step", _chosen(F.col("quoted"), n))
        placed = placed.withColumn(n, F.col(f"{n}_then") + _before(f"{n}_step", inside))
    return placed, ends


def feature_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row `text` per element of the `features` array of each document. A document that does not
    end, holds no `features` array, or has anything but objects in it, fails the query."""
    placed, ends = _states(_pieces(spark, paths))
    at_root = (F.col("curly") <= 1) & (F.col("square") == 0) & (F.col("quoted") == 0)
    between = (F.col("curly") == 1) & (F.col("square") == 1) & (F.col("quoted") == 0)
    outside = (F.col("quoted") + F.col("quotes")) % 2 == 0
    ended = outside & (F.col("curly") + F.col("curly_step") == 1) & (F.col("square") + F.col("square_step") == 1)
    follows, closes = F.regexp_extract("text", _NEXT, 1), F.col("text").rlike(_CLOSES)
    # text of the document itself: all of a piece that starts there, or what follows the end of an array
    root = F.when(at_root, F.col("text")).when(between & closes, F.regexp_extract("text", _CLOSES, 1))
    opened = F.regexp_extract(root, _OPENS, 2)
    strange = F.raise_error(F.lit("unreadable text between the features of a GeoJSON document"))
    body = (
        F.when(root.rlike(_ODD), strange)
        .when(root.isNotNull(), F.when(opened != "", opened))
        .when(between, F.when(follows != "", follows).otherwise(strange))
        .when((F.col("square") > 0) | (F.col("quoted") == 1), F.col("text"))
    )
    # in no array, or in one whose first element is no object: the empty name
    key = F.when(root.isNotNull(), F.when(opened != "", F.regexp_extract(root, _OPENS, 1)).otherwise(""))
    marked = placed.select(
        *RANGE,
        "place",
        body.alias("body"),
        ended.cast("int").alias("ended"),
        key.alias("key"),
        F.coalesce(root.rlike(_HOLDS), F.lit(False)).alias("holds"),
    )
    # which array an element is in, and its number: again within a range, then over ranges
    inside, over = Window.partitionBy(*RANGE).orderBy("place"), Window.partitionBy("file").orderBy("range")
    named = marked.withColumn("key", F.last("key", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    named = named.withColumn("number", _before("ended", inside))
    ranges = named.groupBy(*RANGE).agg(F.sum("ended").alias("ended"), F.max_by("key", "place").alias("last"), F.max("holds").alias("holds"))
    carried = F.last("last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.select(*RANGE, _before("ended", over).alias("number_then"), carried.alias("key_then"))
    whole = named.join(starts, list(RANGE)).select(
        *RANGE, "place", "body", (F.col("number") + F.col("number_then")).alias("number"), F.coalesce("key", "key_then").alias("key")
    )
    parts = F.sort_array(F.collect_list(F.struct("range", "place", F.concat("body", F.lit("}")).alias("body"))))
    features = whole.where((F.col("key") == "features") & F.col("body").isNotNull()).groupBy("file", "number").agg(parts.alias("parts"))
    texts = features.select(F.array_join(F.transform("parts", lambda p: p["body"]), "").alias("text"))

    held = ranges.groupBy("file").agg(F.max("holds").alias("holds"))
    # text after the last brace of a file counts as if one more followed
    complete = (F.col("quotes") % 2 == 0) & F.col("curly").isin(0, -1) & (F.col("square") == 0)
    problem = F.when(~complete, F.lit("a GeoJSON document does not end: ")).when(~F.col("holds"), F.lit("no features in a GeoJSON document: "))
    checked = ends.join(held, "file").select(F.concat(problem, "file").alias("problem")).where(F.col("problem").isNotNull())
    return texts.unionByName(checked.select(F.raise_error(F.col("problem")).cast("string").alias("text")))
