"""Readers that account for every damaged line, document, record and field.

Each gives the good rows and, apart from them, the rejects: file, place, kind, field, text.

kind      what is damaged                                    place
line      a line that is no JSON or CSV record               its number in the file, from 1
document  a file that is no JSON document of records         0
surplus   a line or document with more behind a JSON value   as line or document
record    an element of a list or map that is no record      its line, or its number in the
                                                             document, from 1
field     text that is no value of the field's type          as record; CSV: line

A line or document that is rejected gives no rows, its whole text is in the reject; a
damaged field is null in its row. Rows and rejects are both read from the files, in one pass
each; rejects are only looked for when that frame is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from chargelake import schemas
from chargelake.functions.scalar import parse_time
from chargelake.sources.numbering import SCAN, numbered, with_scan_place

REJECT = "file string, place bigint, kind string, field string, text string"
_TIMES = ("connectionTime", "disconnectTime", "doneChargingTime")
_CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Checked:
    rows: DataFrame
    rejects: DataFrame


class DamagedInput(ValueError):
    """Input that a strict reader does not take."""


_FIELDS = dict(field.split() for field in schemas.RAW_SESSION_DDL.split(", "))
_NUMBERS = {c: t for c, t in _FIELDS.items() if t != "STRING"}
#: a record with all its fields as text
_RECORD = T.StructType([T.StructField(c, T.StringType()) for c in _FIELDS])
_FOUND = "struct<kind:string,field:string,text:string,nth:bigint>"


def _found(kind: str, text: Column, field: str | None = None,
           nth: Column | int = 0) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(field).cast("string").alias("field"),
                    text.alias("text"), F.lit(nth).cast("bigint").alias("nth")).cast(_FOUND)


def _present(found: Column) -> Column:
    return F.filter(found, lambda x: x.isNotNull())


def _field_damage(of, numbers: dict[str, str], times: Sequence[str],
                  nth: Column | int = 0) -> Column:
    """Structs of the fields whose text can't be read; `of` gives the text of a field."""
    values = [(c, of(c).try_cast(t)) for c, t in numbers.items()]
    values += [(c, parse_time(of(c))) for c in times]
    checks = [F.when(of(c).isNotNull() & (F.trim(of(c)) != "") & value.isNull(),
                     _found("field", of(c), c, nth)) for c, value in values]
    return _present(F.array(*checks)) if checks else F.array().cast(f"array<{_FOUND}>")


def _wrapped(text: Column, kind: str) -> Column:
    """The JSON values of a text and a null, or null if they aren't of that kind.

    The text is read as the inside of a list, before a null: a reader of a single value
    would not look at what comes behind it. Fewer than two are left where the text itself
    ends the list.
    """
    return F.from_json(F.concat(F.lit("["), text, F.lit(",null]")), f"array<{kind}>")


def _only(values: Column) -> Column:
    return F.when(F.size(values) == 2, F.get(values, F.lit(0)))


def _as_record(text: Column) -> Column:
    read = F.from_json(text, T.StructType([*_RECORD, T.StructField(_CORRUPT, T.StringType())]),
                       {"columnNameOfCorruptRecord": _CORRUPT})
    fields = F.struct(*[read[c].alias(c) for c in _RECORD.names])
    return F.when(text.isNotNull() & read[_CORRUPT].isNull(), fields)


def _sessions(texts: DataFrame, lines: bool) -> DataFrame:
    """`texts` with `records` (null where an element is none), `elements`, the JSON text of
    each, and `damage`: why there are no records at all."""
    text = F.col("value")
    listed = _only(_wrapped(text, "array<string>"))
    if lines:
        # one parse for the usual line, which is an object
        elements = F.when(text.startswith("["), listed).otherwise(F.array(text))
        single = _wrapped(text, _RECORD.simpleString())
        records = F.when(text.startswith("["), F.transform(listed, _as_record)).when(
            text.startswith("{") & (F.size(single) == 2), F.slice(single, 1, 1))
    else:
        data = _only(_wrapped(text, "struct<data:array<string>>"))["data"]
        entries = F.map_values(_only(_wrapped(text, "map<string,string>")))
        elements = F.when(text.startswith("["), listed).otherwise(F.coalesce(data, entries))
        records = F.transform("elements", _as_record)
    begins_well = F.from_json(text, "array<string>").isNotNull() | F.from_json(
        text, "map<string,string>").isNotNull()
    several = begins_well & ~F.coalesce(F.size(_wrapped(text, "string")) == 2, F.lit(False))
    kind = F.when(several, "surplus").otherwise("line" if lines else "document")
    return (texts.withColumn("elements", elements).withColumn("records", records)
            .withColumn("damage", F.when(F.col("records").isNull(), kind)))


def _json_scan(spark: SparkSession, path: str, lines: bool) -> tuple[DataFrame, DataFrame]:
    scan = spark.read.text(path, wholetext=not lines)
    tidy = F.regexp_replace("value", r"^[\s\uFEFF]+|\s+$", "")
    texts = with_scan_place(scan).withColumn("value", tidy).filter(F.length("value") > 0)
    return scan, _sessions(texts, lines)


def _typed(records: Column, parsed: DataFrame) -> DataFrame:
    r = lambda c: F.col(f"r.{c}")
    return parsed.select(F.explode(records).alias("r")).select(*[
        (r(c).try_cast(_NUMBERS[c]) if c in _NUMBERS else r(c)).alias(c) for c in _RECORD.names])


def sessions_or_error(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    """The records of JSON files; a damaged line, document or record fails the query."""
    _, parsed = _json_scan(spark, path, lines)
    bad = F.raise_error(F.concat(
        F.lit("not a line of session records: " if lines else "not a document of session records: "),
        F.substring("value", 1, 80)))
    whole = F.col("damage").isNull() & F.forall("records", lambda r: r.isNotNull())
    return _typed(F.when(whole, F.col("records")).otherwise(bad), parsed)


def _check_json(spark: SparkSession, path: str, lines: bool) -> Checked:
    scan, parsed = _json_scan(spark, path, lines)
    number = lambda i: F.lit(0) if lines else i + 1
    no_record = _present(F.transform("records", lambda r, i: F.when(r.isNull(), _found(
        "record", F.coalesce(F.get("elements", i), F.lit("null")), nth=number(i)))))
    fields = F.flatten(F.transform("records", lambda r, i: F.when(r.isNotNull(), _field_damage(
        lambda c: r[c], _NUMBERS, _TIMES, number(i))).otherwise(
        F.array().cast(f"array<{_FOUND}>"))))
    whole = F.array(_found("", F.col("value")).withField("kind", F.col("damage")))
    damage = F.when(F.col("damage").isNotNull(), whole).otherwise(F.concat(no_record, fields))
    found = parsed.select(*SCAN, F.explode(damage).alias("d"))
    if lines:
        rejects = _placed(found, scan)
    else:
        rejects = found.select(F.col(SCAN[0]).alias("file"), F.col("d.nth").alias("place"),
                               "d.kind", "d.field", "d.text")
    return Checked(_typed(_present(F.col("records")), parsed), rejects)


def _placed(found: DataFrame, scan: DataFrame) -> DataFrame:
    """Rejects with the number of their row in its file, from 1."""
    return numbered(found, scan, "row", per_file=True, file="file").select(
        "file", (F.col("row") + 1).alias("place"), "d.kind", "d.field", "d.text")


def check_json_lines(spark: SparkSession, path: str) -> Checked:
    """Session records, one object (or a list of objects) to a line. Blank lines don't count."""
    return _check_json(spark, path, lines=True)


def check_json_documents(spark: SparkSession, path: str) -> Checked:
    """Session records, one document to a file: a list of records, {"data": [records]} or an
    object whose values are records. Empty files have no records."""
    return _check_json(spark, path, lines=False)


def _csv_lines(scan: DataFrame, names: list[str]) -> DataFrame:
    """The fields of every line but headers, the line in `_line`, and whether it is `_bad`."""
    ddl = ", ".join(f"`{c}` STRING" for c in [*names, _CORRUPT])
    record = F.from_csv(F.regexp_replace("value", "^\uFEFF", ""), ddl, {
        "quote": '"', "escape": '"', "columnNameOfCorruptRecord": _CORRUPT})
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    fields = F.array(*[F.col(f"r.`{c}`") for c in names])
    header = F.array(*[F.lit(c) for c in names])
    other = F.size(F.array_intersect(fields, header)) > len(names) / 2
    return (
        with_scan_place(scan).filter(F.trim("value") != "").withColumn("r", record)
        .filter(~fields.eqNullSafe(header))
        .withColumn("value", F.when(other, F.raise_error(F.concat(
            F.lit("a file with another header: "), "value"))).otherwise(F.col("value")))
        .select(F.col("value").alias("_line"), *SCAN,
                (F.col(f"r.{_CORRUPT}").isNotNull() | (quotes % 2 == 1)).alias("_bad"),
                *[F.col(f"r.`{c}`").alias(c) for c in names])
    )


def check_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None,
              timestamps: Sequence[str] = (), multiline: bool = False,
              times: Sequence[str] = (), columns: Sequence[str] | None = None) -> Checked:
    """CSV with the same header in all files. `types` and `timestamps` are cast, others text;
    `times` stay text that must be a time. `columns` is the header where not every file has it.

    A line is damaged if it has more or fewer fields than the header, or a quote that is not
    closed. With `multiline`, quoted text may hold line breaks; a file is then read by one
    task, and a place is the number of the record. A file whose header names most columns,
    but in another way, fails the query.
    """
    names = list(columns or spark.read.csv(
        path, header=True, quote='"', escape='"', multiLine=multiline).columns)
    if multiline:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _CORRUPT]])
        scan = spark.read.schema(schema).csv(
            path, header=True, multiLine=True, enforceSchema=False, quote='"', escape='"',
            columnNameOfCorruptRecord=_CORRUPT)
        # Spark refuses a scan of the damaged text alone
        placed = with_scan_place(scan).withColumns({
            "_bad": F.col(_CORRUPT).isNotNull(),
            "_line": F.coalesce(_CORRUPT, F.col(f"`{names[0]}`"))})
    else:
        scan = spark.read.text(path)
        placed = _csv_lines(scan, names)
    wanted = {c: t for c, t in (types or {}).items() if c in names}
    wanted |= {c: "timestamp_ntz" for c in timestamps if c in names}
    field = lambda c: F.col(f"`{c}`")
    rows = placed.filter(~F.col("_bad")).select(*[
        (field(c).try_cast(wanted[c]) if c in wanted else field(c)).alias(c) for c in names])
    damage = F.when(F.col("_bad"), F.array(_found("line", F.col("_line")))).otherwise(
        _field_damage(field, wanted, [c for c in times if c in names]))
    return Checked(rows, _placed(placed.select(*SCAN, F.explode(damage).alias("d")), scan))


def check_sessions_csv(spark: SparkSession, path: str, multiline: bool = False,
                       columns: Sequence[str] | None = None) -> Checked:
    """Session records from CSV; their times are text that must be a time."""
    return check_csv(spark, path, _NUMBERS, (), multiline, _TIMES, columns)


def write_dead_letters(rejects: DataFrame, folder: str, source: str) -> DataFrame:
    """Store the rejects of one source, in place of earlier ones of it; all that are stored."""
    spark = rejects.sparkSession
    rejects.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/source={source}")
    return spark.read.schema(T._parse_datatype_string(f"{REJECT}, source string")).parquet(folder)


def raise_on(rejects: DataFrame, kinds: Sequence[str] = ("line", "document", "surplus", "record")
             ) -> None:
    """Fail with the first few rejects of these kinds, if there are any."""
    some = rejects.filter(F.col("kind").isin(list(kinds))).limit(3).collect()
    if some:
        raise DamagedInput("; ".join(
            f"{r['file']}:{r['place']}: damaged {r['kind']}: {(r['text'] or '')[:80]}" for r in some))
