"""JSON document sources.

A source document is one JSON array (competitions, a season's matches, or a
match's events). All are read over a path or glob with an explicit schema:
one distributed scan over every file, no per-document fetch loop and no
schema-inference pass. A document is split into its elements first and each
element is parsed by itself, so a malformed field costs its own element only.
The match of an event comes from the document's file name (``<match_id>.json``)
through the ``_metadata`` column.

What does not parse is not dropped: an element, or the whole text of a document
that is no JSON array, stays as a row with its raw text in ``_corrupt_record``;
``split_corrupt`` separates those rows into a quarantine frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import COMPETITION_SCHEMA, EVENT_DOCUMENT_SCHEMA, MATCH_SCHEMA
from touchline.sources.arrays import scan_array_documents

CORRUPT = "_corrupt_record"
REASON = "_corrupt_reason"
#: Why a text was not read; fields that hold another type are named one by one.
NO_ELEMENT = "no element of an array"
NO_OBJECT = "no object"
BROKEN = "broken json"
UNFIT = "does not fit the schema"
NO_MATCH = "no match id"
# Name of the raw text in quarantine output. Not ``_corrupt_record``: a JSON
# reader would take a field of that name for its own corrupt-record column.
RAW_TEXT = "raw_text"


def parse_documents(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per element of the documents ``value`` (JSON arrays, or single
    objects), with the raw text of what does not parse in ``_corrupt_record``.
    Blank documents and empty arrays give no rows."""
    keep = [c for c in texts.columns if c != "value"]
    text = F.trim(F.regexp_replace("value", "^\ufeff|^\\s+|\\s+$", ""))
    elements = F.when(text.startswith("{"), F.array(text)).otherwise(
        F.from_json(text, "array<string>")
    )
    # pieces carry all that is needed of the document, so that no row carries its whole text
    piece = lambda of, unreadable: F.struct(of.alias("text"), F.lit(unreadable).alias("unreadable"))
    pieces = F.when(elements.isNull(), F.array(piece(F.col("value"), True))).otherwise(
        F.transform(elements, lambda e: piece(e, False))
    )
    rows = texts.filter(text != "").select(*keep, F.explode(pieces).alias("piece"))
    rows = rows.select(*keep, F.col("piece.text").alias("element"), F.col("piece.unreadable").alias("unreadable"))
    return parse_elements(rows, schema)


def parse_elements(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse the texts ``element``; ``unreadable`` ones and those that don't fit
    the schema keep their text in ``_corrupt_record`` and say why in ``_corrupt_reason``."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    keep = [c for c in rows.columns if c not in ("element", "unreadable")]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # exploded, not just added: a filter on the parsed fields would otherwise be pushed below and parse every element again
    parsed = rows.select("*", F.explode(F.array(F.from_json("element", with_corrupt, options))).alias("row"))
    # an element that is no object (a number, null) has no fields to read
    no_object = ~F.coalesce(F.ltrim("element").startswith("{"), F.lit(False))
    corrupt = (
        F.when(F.col("unreadable"), F.col("element"))
        .when(no_object, F.coalesce("element", F.lit("null")))
        .otherwise(F.col(f"row.{CORRUPT}"))
    )
    reason = (
        F.when(F.col("unreadable"), NO_ELEMENT).when(no_object, NO_OBJECT)
        .when(F.col(f"row.{CORRUPT}").isNotNull(), misfit(F.col("element"), schema))
    )
    return parsed.select(
        *[F.col("row").getField(f.name).alias(f.name) for f in schema.fields],
        corrupt.alias(CORRUPT),
        reason.alias(REASON),
        *keep,
    )


def _fields(schema: T.StructType, prefix: str = "$") -> list[tuple[str, T.DataType]]:
    """Every field that is no part of an array, outer ones first, as a JSON path and its type."""
    out: list[tuple[str, T.DataType]] = []
    for f in schema.fields:
        path = f"{prefix}.{f.name}"
        out.append((path, f.dataType))
        if isinstance(f.dataType, T.StructType):
            out += _fields(f.dataType, path)
    return out


#: How JSON values that a type can hold are called by ``schema_of_variant``, as a pattern.
_NUMBER = r"(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"


def _holds(kind: T.DataType) -> str:
    """The pattern of the values that the parser takes for a type; text takes any."""
    if isinstance(kind, T.StructType):
        return r"OBJECT<.*>"
    if isinstance(kind, T.ArrayType):
        return rf"ARRAY<({_holds(kind.elementType)}|VOID)>"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _NUMBER
    if isinstance(kind, (T.LongType, T.IntegerType)):
        # whole numbers of more digits than a long has are decimals
        return r"BIGINT"
    if isinstance(kind, T.BooleanType):
        return r"BOOLEAN"
    return r".*"


def misfit(element: Column, schema: T.StructType) -> Column:
    """Why a JSON object doesn't fit ``schema``: broken JSON, or the first field
    that holds another type, with the type expected and the kind of value found."""

    def check(value: Column, path: str, kind: T.DataType) -> Column:
        found = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
        name, expected = path.removeprefix("$."), "struct" if isinstance(kind, T.StructType) else kind.simpleString().split("<struct")[0]
        # objects and arrays by their kind alone: their contents vary
        kind_found = F.lower(F.regexp_extract(found, r"^\w+", 0))
        return F.when(~found.rlike(rf"^({_holds(kind)}|VOID)$"), F.concat(F.lit(f"field {name}: {expected} expected, "), kind_found, F.lit(" found")))

    def reason(value: Column) -> Column:
        checks = [check(value, path, kind) for path, kind in _fields(schema) if _holds(kind) != r".*"]
        return F.when(value.isNull(), BROKEN).otherwise(F.coalesce(*checks, F.lit(UNFIT)))

    # a lambda's argument is parsed once, however many fields are checked
    return F.transform(F.array(F.try_parse_json(element)), reason)[0]


def read_json_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    keep_corrupt: bool = True,
    multi_line: bool = True,
    split: bool = False,
) -> DataFrame:
    """JSON documents with a fixed schema.

    ``multi_line`` (the source format) reads each file as one JSON array, a row
    per element; such a file is one task, which suits per-match documents of a
    few MB. With ``split`` Spark splits large documents, too, at the price of
    reading them twice; a broken document then keeps its whole elements.
    ``multi_line=False`` reads JSON lines, which Spark splits inside large files.

    With ``keep_corrupt`` the frame has a ``_corrupt_record`` column holding
    the raw text of an element (or document) that did not parse, null for good
    rows, ``_corrupt_reason`` that says why, and the ``source_file`` it came from;
    without it such rows are left out.
    """
    if multi_line and split:
        df = parse_elements(scan_array_documents(spark, path), schema)
    elif multi_line:
        texts = (
            spark.read.text(path, wholetext=True)
            .select("value", F.col("_metadata.file_path").alias("source_file"))
        )
        df = parse_documents(texts, schema)
    else:
        df = (
            spark.read.schema(T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path)
            .withColumns({REASON: F.when(F.col(CORRUPT).isNotNull(), misfit(F.col(CORRUPT), schema)), "source_file": F.col("_metadata.file_path")})
        )
    return df if keep_corrupt else df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, REASON)


def read_competitions(spark: SparkSession, path: str, split: bool = False) -> DataFrame:
    """The competitions document."""
    return read_json_documents(spark, path, COMPETITION_SCHEMA, split=split)


def read_matches(spark: SparkSession, path: str | list[str], split: bool = False) -> DataFrame:
    """S3: match documents, one per competition and season
    (``matches/<competition_id>/<season_id>.json``). When a document lacks the
    competition or season ids, they are taken from its path."""
    df = read_json_documents(spark, path, MATCH_SCHEMA, split=split)
    ids = F.regexp_extract(F.col("source_file"), r"(\d+)/(\d+)\.json$", 1)
    season = F.regexp_extract(F.col("source_file"), r"(\d+)/(\d+)\.json$", 2)
    from_path_comp = F.when(ids != "", ids.cast("bigint"))
    from_path_season = F.when(season != "", season.cast("bigint"))
    return df.withColumn(
        "competition",
        F.struct(
            F.coalesce(F.col("competition.competition_id"), from_path_comp).alias("competition_id"),
            F.col("competition.competition_name").alias("competition_name"),
        ),
    ).withColumn(
        "season",
        F.struct(
            F.coalesce(F.col("season.season_id"), from_path_season).alias("season_id"),
            F.col("season.season_name").alias("season_name"),
        ),
    )


def match_id_from_path(path_col: str = "source_file"):
    """The match id in a path ``.../<match_id>.json`` or, as Spark's own writers
    name them, ``.../match_id=<match_id>/...`` (null if none)."""
    raw = F.regexp_extract(F.col(path_col), r"(?:match_id=(\d+)/[^/]*|(\d+)\.json)$", 0)
    return F.regexp_extract(raw, r"\d+", 0).try_cast("bigint")


def read_events(spark: SparkSession, path: str | list[str], split: bool = False) -> DataFrame:
    """Match event documents (``events/<match_id>.json``), any number of
    them in one scan, each row tagged with the ``match_id`` of its file."""
    df = read_json_documents(spark, path, EVENT_DOCUMENT_SCHEMA, split=split)
    return df.withColumn("match_id", match_id_from_path())


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine rows) of a frame read with ``keep_corrupt``.

    The quarantine keeps the source file, the first data field, the raw text
    (as ``raw_text``) and why it was not read (as ``reason``). Writing both parts
    parses the documents twice, which costs less at scale than a copy of the
    parsed input on disk.
    """
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, REASON)
    first = next(c for c in df.columns if c not in (CORRUPT, REASON, "source_file"))
    reason = F.col(REASON) if REASON in df.columns else F.lit(None).cast("string")
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(
        "source_file", first, F.col(CORRUPT).alias(RAW_TEXT), reason.alias("reason")
    )
    return good, bad


def _paths(dt: T.DataType, prefix: str = "") -> set[str]:
    """Every nested field path of a type (array elements are looked into)."""
    while isinstance(dt, T.ArrayType):
        dt = dt.elementType
    out: set[str] = set()
    if isinstance(dt, T.StructType):
        for f in dt.fields:
            path = f"{prefix}{f.name}"
            out.add(path)
            out |= _paths(f.dataType, path + ".")
    return out


def unknown_fields(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sampling_ratio: float = 1.0,
    multi_line: bool = True,
) -> list[str]:
    """Field paths present in the documents but not in ``schema``.

    The explicit schema keeps every statistic stable when documents drift,
    but it ignores fields it does not know; this report (one inference job
    over all documents, unless a sample is asked for) shows what a provider has added, e.g. ``pass.technique``.
    """
    inferred = (
        spark.read.option("multiLine", multi_line)
        .option("samplingRatio", sampling_ratio)
        .json(path)
        .schema
    )
    known = _paths(schema)
    return sorted(p for p in _paths(inferred) if p not in known and p != CORRUPT)
