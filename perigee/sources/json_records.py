"""JSON records of any layout, read in byte ranges: JSON Lines, arrays on one line, arrays spread over many.

The text reader splits files at opening braces, so a range of bytes needs no line breaks to be read alone. Nearly every
piece between two braces is the rest of a whole record and is parsed where it is read, without a shuffle. The others -
of nested objects, of strings that hold braces, of broken records - are few in flat data; they alone are put in order
and joined again. What lies between two whole records is taken by itself, so a broken record spoils no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
#: What may stand between records: blanks, the mark of a text's start, an array's ends and commas.
BLANKS = " \t\r\n"
BETWEEN = BLANKS + "\ufeff,[]"
_FILE, _RANGE, _PIECE, _TEXT = "_file", "_range", "_piece", "_text"


def with_corrupt(schema: T.StructType) -> T.StructType:
    fields = [f for f in schema.fields if f.name != CORRUPT]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between opening braces, numbered without gaps within a range of bytes of a file."""
    text = spark.read.option("lineSep", "{").text(path)
    return text.select(
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_RANGE),
        F.monotonically_increasing_id().alias(_PIECE),
        F.col("value").alias(_TEXT),
    )


def _parsed(text: Column, schema: T.StructType) -> Column:
    """The record, with ``CORRUPT`` set to its text if it could not be fully parsed."""
    return F.from_json(text, with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.name != CORRUPT]


def _without_escapes(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\.", "")


def _without_strings(text: Column) -> Column:
    return F.regexp_replace(text, r'"[^"]*(?:"|$)', "")


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with ``columns``, each worked out once for a row however often it is used. They come from a generator, since
    the optimizer puts a plain column's expression in every place that names the column."""
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def _candidates(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``_body``: the object that a piece may be, NULL if it is none by its looks."""
    tail = F.substring_index(_TEXT, "}", -1)
    cut = F.when(F.rtrim(F.col("_tail"), F.lit(BETWEEN)) == "", F.substring(F.col(_TEXT), F.lit(1), F.length(_TEXT) - F.length("_tail")))
    closed = F.when(F.instr("_cut", "}") == F.length("_cut"), True).otherwise(_count(_without_strings(_without_escapes(F.col("_cut"))), "}") == 1)
    likely = F.ltrim(F.col("_cut"), F.lit(BLANKS)).startswith('"') & closed
    rows = _once(_once(pieces, _tail=tail), _cut=cut)
    return _once(rows, _body=F.when(likely, F.concat(F.lit("{"), "_cut"))).drop("_tail", "_cut")


def _known(schema: T.StructType) -> Column:
    """Whether ``_body`` is an object with declared keys."""
    return F.coalesce(F.arrays_overlap(F.json_object_keys("_body"), F.array(*map(F.lit, _names(schema)))), F.lit(False))


def _sound(schema: T.StructType) -> Column:
    """Whether ``_record`` was fully parsed and has a value."""
    record = F.col("_record")
    return record[CORRUPT].isNull() & F.greatest(F.lit(False), *(record[n].isNotNull() for n in _names(schema)))


def _split(pieces: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Records of the pieces that are whole ones, objects with declared keys, and the other pieces.

    Inside a string of another record no piece is one: its first quote would end that string, and what follows would
    not go on as JSON. Pieces with declared keys are not parsed to find the others.
    """
    candidates = _candidates(pieces)
    records = _once(candidates.where(F.col("_body").isNotNull()), _record=_parsed(F.col("_body"), schema))
    whole = records.where(_sound(schema) | _known(schema)).select("_record.*")
    rest = _once(candidates, _keyed=_known(schema)).where(~F.col("_keyed"))
    rest = _once(rest, _record=_parsed(F.col("_body"), schema)).where(F.col("_body").isNull() | ~_sound(schema))
    return whole, rest.select(_FILE, _RANGE, _PIECE, _TEXT)


def _islands(pieces: DataFrame, rest: DataFrame) -> DataFrame:
    """``rest`` with ``_head``, whether a piece stands before the first brace of its file, and ``_island``, the same number
    for pieces that follow each other without a whole record between."""
    ranges = pieces.groupBy(_FILE, _RANGE).agg(F.min(_PIECE).alias("_first"), F.max(_PIECE).alias("_last"))
    by_range = Window.partitionBy(_FILE).orderBy(_RANGE)
    ranges = ranges.withColumn("_before", F.lag("_last").over(by_range)).drop("_last")
    in_file = Window.partitionBy(_FILE).orderBy(_RANGE, _PIECE)
    first = F.col(_PIECE) == F.col("_first")
    expected = F.when(first, F.col("_before")).otherwise(F.col(_PIECE) - 1)
    previous = F.lag(_PIECE).over(in_file)
    marked = rest.join(ranges, [_FILE, _RANGE]).select(
        *rest.columns,
        (first & F.col("_before").isNull()).alias("_head"),
        (previous.isNull() | ~previous.eqNullSafe(expected)).cast("long").alias("_starts"),
    )
    return marked.withColumn("_island", F.sum("_starts").over(in_file)).drop("_starts")


def _joined(islands: DataFrame) -> DataFrame:
    """``_text`` of each object of an island, with what stands between it and the next one.

    Quotes tell, in order, which pieces begin inside a string; braces outside of strings give the depth. An object ends
    in the piece after which the depth is as low as at any place before.
    """
    by = Window.partitionBy(_FILE, "_island").orderBy(_RANGE, _PIECE)
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    plain = _without_escapes(F.col(_TEXT))
    rows = islands.select(
        "*",
        (_count(plain, '"') % 2).alias("_odd"),
        _count(_without_strings(plain), "}").alias("_closed"),
        _count(_without_strings(F.regexp_replace(plain, r'^[^"]*(?:"|$)', "")), "}").alias("_closed_inside"),
    )
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2 == 1)
    opened = F.when(F.col("_inside") | F.col("_head"), 0).otherwise(1)
    net = opened - F.when(F.col("_inside"), F.col("_closed_inside")).otherwise(F.col("_closed"))
    rows = rows.withColumn("_net", net).withColumn("_depth", F.sum("_net").over(upto))
    lowest = F.least(F.coalesce(F.min("_depth").over(before), F.lit(0)), F.lit(0))
    rows = rows.withColumn("_end", (F.col("_depth") <= lowest).cast("long"))
    rows = rows.withColumn("_object", F.coalesce(F.sum("_end").over(before), F.lit(0)))
    parts = F.array_sort(F.collect_list(F.struct(_RANGE, _PIECE, _TEXT)))  # the pieces of one object
    text = F.array_join(F.transform(parts, lambda p: p[_TEXT]), "{")
    objects = rows.groupBy(_FILE, "_island", "_object").agg(text.alias(_TEXT), F.bool_or("_head").alias("_head"))
    return objects.select(F.when(F.col("_head"), F.col(_TEXT)).otherwise(F.concat(F.lit("{"), _TEXT)).alias(_TEXT))


def _of_rest(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of joined texts, and rows without values for what is no object."""
    body = F.trim(F.col(_TEXT), F.lit(BETWEEN))
    end = F.length(body) - F.coalesce(F.nullif(F.instr(F.reverse(body), "}"), F.lit(0)), F.lit(1)) + 1
    opened = body.startswith("{")
    object_ = F.when(opened, F.substring(body, F.lit(1), end))
    junk = F.trim(F.when(opened, F.substring(body, end + 1, F.length(body))).otherwise(body), F.lit(BETWEEN))
    found = texts.select(F.explode(F.array(object_, junk)).alias(_TEXT)).filter(F.length(_TEXT) > 0)
    parsed = found.withColumn("_record", F.when(F.col(_TEXT).startswith("{"), _parsed(F.col(_TEXT), schema)))
    corrupt = F.when(F.col("_record").isNull(), F.col(_TEXT)).otherwise(F.col("_record")[CORRUPT])
    return parsed.select(*(F.col("_record")[n].alias(n) for n in _names(schema)), corrupt.alias(CORRUPT))


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every record of the JSON files at ``path`` with the columns of ``schema``, and its raw text in ``CORRUPT`` if it
    could not be fully parsed, else NULL.

    Files may be laid out in any way and differ in it. A cell that does not parse is NULL; what is no object, or a broken
    one, gives one row of NULLs with its own text. Nested objects and braces in strings are read right, except for arrays
    of objects that have declared keys of their own: those count as records. Text is UTF-8. The text is read up to three
    times, the records parsed once. Pieces that are no whole record are put in order file by file.
    """
    pieces = _pieces(spark, path)
    whole, rest = _split(pieces, schema)
    return whole.unionByName(_of_rest(_joined(_islands(pieces, rest)), schema))
