"""Merkle fingerprints of documents, with built-in functions only.

A text is cut into paragraphs at line breaks and sentence ends, and after WIDTHS characters
without one (fewer in short texts). Paragraphs are grouped to sections behind each whose
hash ends in 0 or 8 (about every eighth), so an edit moves no border but its own. A
section's node is the hash of its paragraphs' hashes and the root that of the nodes.

The fingerprint writes the tree: the root, and per section its node and its leaves, 24 bits
of each paragraph's hash with the paragraph's length. Comparing two goes down the tree: equal
roots are equal texts; of the sections, those with equal nodes are equal; only leaves of the
others are looked at. Lengths say how much is alike and where an edit lies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from chargelake.functions.scalar import ratio
from chargelake.llm.common import doc_id, keyed, stored

#: longest paragraph by the length of the text: (texts shorter than, characters)
WIDTHS = ((32, 1), (512, 8), (None, 96))
#: digits of a leaf: the hash's, and two of the length, which is 99 at most
_LEAF = "[0-9a-f]{6}[0-9]{2}"


def paragraph_pattern(width: int) -> str:
    return r"[^.!?\n]{1,%d}+[.!?\n]{0,3}+|[.!?\n]{1,99}+" % width


def paragraphs(text: Column) -> Column:
    """Consecutive pieces that make up the whole text; none for an empty one."""
    cut = lambda width: F.regexp_extract_all(text, F.lit(paragraph_pattern(width)), F.lit(0))
    *short, (_, widest) = WIDTHS
    pieces = cut(widest)
    for below, width in reversed(short):
        pieces = F.when(F.length(text) < below, cut(width)).otherwise(pieces)
    return pieces


def _closes(hashed: Column) -> Column:
    return F.substring(hashed, 32, 1).isin("0", "8")


def fingerprint(text: Column) -> Column:
    """root:node=leaves;node=leaves;... in hexadecimal digits, nodes as n and seven of them."""
    # 32 digits of hash and two of length, and a ; behind the last of a section
    leaves = F.transform(paragraphs(text), lambda p: F.concat(
        F.md5(p), F.lpad(F.length(p).cast("string"), 2, "0")))
    entries = F.array_join(F.transform(
        leaves, lambda x: F.concat(x, F.when(_closes(x), ";").otherwise(""))), "")
    branches = F.filter(F.split(entries, ";"), lambda x: x != "")
    short = lambda x: F.regexp_replace(x, "([0-9a-f]{6})[0-9a-f]{26}([0-9]{2})", "$1$2")
    written = F.transform(branches, lambda x: F.concat(
        F.lit("n"), F.substring(F.md5(x), 1, 7), F.lit("="), short(x)))
    root = F.substring(F.sha2(F.array_join(F.transform(branches, lambda x: F.md5(x)), ""), 256), 1, 32)
    return F.concat(root, F.lit(":"), F.array_join(written, ";"))


def _sections(print_: Column) -> Column:
    return F.filter(F.split(F.substring_index(print_, ":", -1), ";"), lambda x: x != "")


def _leaves(sections_: Column) -> Column:
    """The leaves of sections, in order: n and the node's seven digits are not one."""
    return F.regexp_extract_all(F.array_join(sections_, ";"), F.lit(_LEAF), F.lit(0))


def _length(leaves: Column) -> Column:
    """Characters that leaves stand for."""
    return F.aggregate(leaves, F.lit(0).cast("bigint"), lambda total, leaf: total + F.substring(
        leaf, 7, 2).cast("bigint"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _with_sections(one: Column, other: Column,
                   use: Callable[[Column, Column], Column]) -> Column:
    return _let(_sections(one), lambda a: _let(_sections(other), lambda b: use(a, b)))


def likeness(one: Column, other: Column) -> Column:
    """0 to 1: twice the characters that two fingerprints share, over those of both.

    Equal roots share all. Else sections of equal nodes do, and of the other sections the
    leaves that both have. A section or leaf that a text repeats counts once.
    """
    def share(same: Column, leaves_a: Column, leaves_b: Column) -> Column:
        shared = 2 * (same + _length(F.array_intersect(leaves_a, leaves_b)))
        both = 2 * same + _length(leaves_a) + _length(leaves_b)
        return F.coalesce(ratio(shared, both), F.lit(0.0))

    def descend(a: Column, b: Column) -> Column:
        apart = lambda x, y: F.array_distinct(_leaves(F.array_except(x, y)))
        same = _length(_leaves(F.array_intersect(a, b)))
        return _let(apart(a, b), lambda one: _let(apart(b, a), lambda two: share(same, one, two)))

    return F.when(F.substring(one, 1, 32) == F.substring(other, 1, 32), F.lit(1.0)).otherwise(
        _with_sections(one, other, descend))


def _same_ahead(a: Column, b: Column) -> Column:
    """How many elements two arrays have alike from the front."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return _let(differ, lambda at: F.when(at > 0, at - 1).otherwise(F.size(a)).cast("int"))


def _like_ahead(a: Column, b: Column) -> Column:
    """Characters that two lists of sections have alike from the front: whole sections, and
    leaves of the first section that differs."""
    def counted(n: Column) -> Column:
        inside = lambda x: _leaves(F.slice(x, n + 1, F.lit(1)))
        return _length(_leaves(F.slice(a, F.lit(1), n))) + _let(inside(a), lambda one: _length(
            F.slice(one, F.lit(1), _same_ahead(one, inside(b)))))

    return _let(_same_ahead(a, b), counted)


def edit_places(one: Column, other: Column) -> Column:
    """start and end (0-based characters of the first text) around all that differs, from the
    fingerprints alone; null where they are equal."""
    def backwards(sections_: Column) -> Column:
        # the leaves of each section the other way round as well
        return F.transform(F.reverse(sections_), lambda x: F.array_join(
            F.reverse(F.regexp_extract_all(x, F.lit(_LEAF), F.lit(0))), ""))

    def places(a: Column, b: Column) -> Column:
        behind = _let(backwards(a), lambda x: _let(backwards(b), lambda y: _like_ahead(x, y)))
        end = _length(_leaves(a)) - behind
        return _let(_like_ahead(a, b), lambda start: F.struct(
            start.alias("start"), F.greatest(start, end).alias("end")))

    return F.when(F.substring(one, 1, 32) != F.substring(other, 1, 32),
                  _with_sections(one, other, places))


def _sent_to(rows: DataFrame) -> DataFrame:
    """id and key of each document with those and n of the document before it, in a ring."""
    order = ["id", "key"]
    placed = stored(
        rows.select("id", "key", "n").distinct().repartitionByRange(*order)
        .sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "order")
    whole = F.struct("id", "key", "n")
    # one row per partition: the last document before it
    by_part = Window.orderBy("part")
    last = placed.groupBy("part").agg(F.max(whole).alias("last"))
    last = last.select("part", F.coalesce(
        F.lag("last").over(by_part), F.max("last").over(Window.partitionBy())).alias("edge"))
    inside = F.lag(whole).over(Window.partitionBy("part").orderBy(*order))
    return (placed.withColumn("inside", inside).join(last, "part")
            .select("id", "key", F.coalesce("inside", "edge").alias("to")))


def fingerprinted(docs: DataFrame, share: int = 4) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are.

    The edited text has its last n_chars // share code points replaced by the first as many
    (or all) of the next document by ascending doc_id; the first follows the last. Columns:
    doc_id, n_chars, edited (the text), fingerprint, edited_fingerprint, near_edited,
    near_next. Null texts count as empty. A null doc_id comes after all others; equal ids
    are ordered by a hash of their texts, and repeated rows are one document there, each
    returned. One document alone is its own next. No rows for no rows.
    """
    rows = keyed(docs, "text").select(
        "id", "key", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "fingerprint", fingerprint(F.col("text")))
    to = _sent_to(rows.withColumn("n", F.length("text")))
    head = F.substring(F.col("text"), F.lit(1), F.floor(F.col("to.n") / share).cast("int"))
    # each document sends its head to the one before it: less than the texts themselves
    sent = (rows.join(to.hint("shuffle_hash"), ["id", "key"])
            .select(F.col("to.id").alias("id"), F.col("to.key").alias("key"),
                    head.alias("head"), F.col("fingerprint").alias("next_print"))
            .dropDuplicates(["id", "key"]))
    n = F.length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / share).cast("int")),
                      F.col("head"))
    return (
        rows.join(sent.hint("shuffle_hash"), ["id", "key"])
        .select(doc_id(), n.cast("bigint").alias("n_chars"), edited.alias("edited"),
                "fingerprint", "next_print")
        .withColumn("edited_fingerprint", fingerprint(F.col("edited")))
        .withColumn("near_edited", likeness(F.col("fingerprint"), F.col("edited_fingerprint")))
        .withColumn("near_next", likeness(F.col("fingerprint"), F.col("next_print")))
        .withColumn("place", edit_places(F.col("fingerprint"), F.col("edited_fingerprint")))
        .withColumns({"edit_start": F.col("place.start"), "edit_end": F.col("place.end")})
        .drop("next_print", "place")
    )
