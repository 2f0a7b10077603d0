"""Extraction jobs over lines, texts, HTML and sheet grids.

Each job is a plan over a table of lines, documents or cells. Label tables are
expanded per row from an array of expressions, so no rule table is joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from auditloom import fixed
from auditloom.functions.keys import match
from auditloom.functions.names import canonical_district
from auditloom.functions.numbers import amount_or_null, clean_amount, col, decimal_text, int_text, let, money_sum, strip
from auditloom.operators.rank import global_rank, running_id
from auditloom.session import durable, stored

# --- records assembled from lines ----------------------------------------------------


def assemble_records(lines: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str],
                     line: str = "line", start: str | Column = fixed.RECORD_START) -> DataFrame:
    """Records of ordered lines: a start line and all lines up to the next one.

    Lines before the first start belong to no record and are dropped before the
    shuffle. ``lines`` is the record's array of lines, ``text`` joins them with
    spaces.
    """
    starts = F.col(line).rlike(start) if isinstance(start, str) else start
    numbered = running_id(lines, keys, chunk, order, starts).filter(F.col("record_id") > 0)
    packed = numbered.groupBy(*keys, "record_id").agg(
        F.array_sort(F.collect_list(F.struct(*order, F.col(line).alias("_line")))).alias("_rows"))
    return packed.select(*keys, "record_id", F.col("_rows._line").alias("lines")).withColumn(
        "text", F.array_join("lines", " "))


#: Lines of a piece of a record (no fewer than those ahead), and lines after it that a match may run
#: into: the longest pattern has five tokens, and no token holds a space.
PIECE_LINES = 64
LINES_AHEAD = 4


def _changes(column: pa.Array) -> np.ndarray:
    """True at each row (but the first) that differs from the row before it; nulls are equal."""
    here, before = column.slice(1), column.slice(0, len(column) - 1)
    differ = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(pc.is_null(here), pc.is_null(before)))
    return differ.to_numpy(zero_copy_only=False)


def _cut_pieces(batches: Iterable[pa.RecordBatch], by: Sequence[str], piece: int, ahead: int) -> Iterator[pa.RecordBatch]:
    """Ordered lines (``by``, ``_start``, ``_line``) to pieces, as :func:`record_pieces` stores them. The rows of a chunk
    follow each other, so only the last two pieces of a batch wait for the next one."""
    held, fresh, known, since = None, True, 0, 0

    def cut(rows: pa.Table, final: bool) -> tuple[pa.RecordBatch, int, bool, int, int]:
        n, columns = rows.num_rows, {c: rows[c].combine_chunks() for c in rows.column_names}
        start = columns["_start"].to_numpy(zero_copy_only=False)
        new = np.zeros(n, bool)
        new[0] = fresh
        for c in by:
            new[1:] |= _changes(columns[c])
        at, count = np.arange(n), np.cumsum(start)
        # Starts of the chunk up to a row, and lines since its last start; what came before the first row is carried.
        here = count - np.maximum.accumulate(np.where(new, count - start, -known))
        anchor = np.where(new | start, at, -since - 1)
        anchor[0] = 0 if new[0] or start[0] else -since
        row = at - np.maximum.accumulate(anchor)
        first = np.flatnonzero(new | (row % piece == 0))
        end, chunk = np.append(first[1:], n), np.cumsum(new)[first]
        follows = np.append(chunk[1:] == chunk[:-1], False)
        same = follows & np.append(here[first[1:]] == here[first[:-1]], False)
        last = ~follows | (same & ~np.append(follows[1:], False))
        k = len(first) if final else max(len(first) - 2, 0)
        sizes = np.where(same, np.minimum(ahead, np.append(end[1:] - first[1:], 0)), 0)[:k]
        offsets = np.append(0, np.cumsum(sizes))
        taken = np.repeat(end[:k] - offsets[:-1], sizes) + np.arange(offsets[-1])
        lines, stop = columns["_line"], end[k - 1] if k else 0
        out = pa.RecordBatch.from_arrays(
            [*[columns[c].take(pa.array(first[:k])) for c in by], pa.array(here[first[:k]], pa.int64()), pa.array((row // piece)[first[:k]], pa.int32()),
             pa.ListArray.from_arrays(pa.array(np.append(first[:k], stop), pa.int32()), lines),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines.take(pa.array(taken))), pa.array(last[:k])],
            names=[*by, "_here", "_sub", "lines", "_next", "_last"])
        if stop == n:
            return out, stop, True, 0, 0
        return out, stop, bool(new[stop]), int(here[stop] - start[stop]) if not new[stop] else 0, int(row[stop])

    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            out, stop, fresh, known, since = cut(rows, False)
            held = rows.slice(stop)
            if out.num_rows:
                yield out
    if held is not None:
        yield cut(held, True)[0]


def record_pieces(lines: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str],
                  line: str = "line", start: str | Column = fixed.RECORD_START, placed: bool = False) -> DataFrame:
    """Records of ordered lines, in pieces of up to ``PIECE_LINES`` lines: no record is ever gathered.

    A record is one piece as a rule (``whole``); a longer one, or one that crosses a chunk, is several, in the
    order of ``at``. ``lines`` are the piece's own, ``ahead`` the next few of the same record, ``first`` marks the
    piece with the start line. Lines before the first start are dropped. The lines of a chunk are brought together
    and sorted, unless they are ``placed``: in order in one task, as the block of a file is read.
    """
    starts = F.col(line).rlike(start) if isinstance(start, str) else start
    by = [*keys, "_chunk"]
    flagged = lines.withColumn("_chunk", chunk)
    if not placed:
        flagged = flagged.repartition(*by).sortWithinPartitions(*by, *order)
    flagged = flagged.select(*by, F.coalesce(starts, F.lit(False)).alias("_start"), F.col(line).alias("_line"))
    kinds = StructType([*[flagged.schema[c] for c in by], *StructType.fromDDL("_here bigint, _sub int, lines array<string>, _next array<string>, _last boolean")])
    piece, ahead = PIECE_LINES, LINES_AHEAD
    pieces = flagged.mapInArrow(lambda batches: _cut_pieces(batches, by, piece, ahead), kinds)
    went_on = (F.col("_here") == 0) & (F.col("_sub") == 0)
    pieces = stored(pieces.withColumn("_head", F.when(went_on, F.slice("lines", 1, LINES_AHEAD))), "pieces")

    # One row per chunk: its starts, and the lines with which it goes on with the record before it.
    none = F.array().cast("array<string>")
    chunks = pieces.groupBy(*by).agg(F.max("_here").alias("_n"), F.max("_head").alias("_head"))
    across = Window.partitionBy(*keys).orderBy("_chunk")
    come, open_ = none, F.lit(True)
    for k in range(1, LINES_AHEAD + 1):
        come = F.concat(come, F.when(open_, F.coalesce(F.lead("_head", k).over(across), none)).otherwise(none))
        open_ = open_ & F.coalesce(F.lead("_n", k).over(across) == 0, F.lit(False))
    # Written, so that the join knows how small they are and pieces need not be shuffled by chunk.
    chunks = stored(chunks.select(*by, F.coalesce(F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                                  F.slice(come, 1, LINES_AHEAD).alias("_come")), "chunks")
    joined = pieces.join(chunks, by).withColumn("record_id", (F.col("_before") + F.col("_here")).cast("bigint")).filter(F.col("record_id") > 0)
    out = joined.select(*keys, "record_id", F.struct("_chunk", "_sub").alias("at"), "lines",
                        F.slice(F.concat("_next", F.when(F.col("_last"), F.col("_come")).otherwise(none)), 1, LINES_AHEAD).alias("ahead"),
                        ((F.col("_here") > 0) & (F.col("_sub") == 0)).alias("first"))
    return out.withColumn("whole", F.col("first") & (F.size("ahead") == 0))


def record_spans(lines: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str], starts: Column,
                 line: str) -> DataFrame:
    """Per record: first and last position, number of lines, characters, first line.

    Only mergeable aggregates, so a record of any length is never gathered.
    """
    numbered = running_id(lines, keys, chunk, order, starts).filter(F.col("record_id") > 0)
    place = F.struct(*order)
    return numbered.groupBy(*keys, "record_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length(line)).cast("bigint").alias("chars"),
        F.min(F.col(order[-1])).cast("bigint").alias("first_pos"),
        F.max(F.col(order[-1])).cast("bigint").alias("last_pos"),
        F.min_by(line, place).alias("first_line"))


def _owner_lines(lines: Column) -> Column:
    """Up to four lines after the first, without tax, class and value lines."""
    def keep(x: Column) -> Column:
        return (x != "") & reduce(Column.__and__, [~x.rlike(p) for p in fixed.OWNER_LINE_SKIP])

    return F.filter(F.transform(F.slice(lines, 2, 4), strip), keep)


#: What a piece of a record tells of it: text as found, typed only once the pieces are merged.
_FOUND = ("account_number", "property_class", "zone", "acreage", "first_half_tax", "second_half_tax", "deferred_value")


def _own(text: Column, pattern: str, group: int = 1, found: Column | None = None) -> Column:
    """First match that starts in the piece itself; it may end in the lines ahead. ``found`` is the match
    where it has been made already."""
    inside = (F.size("ahead") == 0) | (F.regexp_instr(text, F.lit(pattern)) <= F.col("_length"))
    found = F.regexp_extract(text, pattern, group) if found is None else found
    return F.when((found != "") & inside, found)


def _first_match(text: Column, name: str, pattern: str, group: int) -> Column:
    found, word = F.regexp_extract(text, pattern, group), fixed.RECORD_WORDS.get(name)
    return F.when(text.contains(word), found) if word else found


def _pieces(records: DataFrame) -> DataFrame:
    """Assembled records count as whole pieces."""
    if "ahead" not in records.columns:
        none = F.array().cast("array<string>")
        records = records.withColumns({"ahead": none, "first": F.lit(True), "whole": F.lit(True), "at": F.struct(F.lit(0).alias("_chunk"), F.lit(0).alias("_sub"))})
    own = F.array_join("lines", " ")
    return (records.withColumn("_text", F.concat_ws(" ", "lines", "ahead")).withColumn("_length", F.length(own)))


def _or_else(value: Column, place: int, later: Column) -> Column:
    def pick(found: Column) -> Column:
        return F.when(found.isNotNull(), F.struct(F.lit(place).alias("place"), found.alias("text"))).otherwise(later)

    return let(value, pick)


def _description(text: Column) -> Column:
    """The first pattern that matches, as (its place, text); later ones run only if the earlier fail."""
    out = F.lit(None).cast("struct<place: int, text: string>")
    for place, pattern in reversed(list(enumerate(fixed.DESCRIPTION_PATTERNS))):
        out = _or_else(_own(text, pattern, found=None if place else F.col("_m_description")), place, out)
    return out


def _district(text: Column) -> Column:
    """The first district of the fixed order, as (its place, name)."""
    names = F.array(*[F.lit(n) for n in fixed.DISTRICTS.values()])
    return let(canonical_district(text), lambda d: F.when(d.isNotNull(), F.struct(F.array_position(names, d).alias("place"), d.alias("name"))))


def _read_once(found: DataFrame) -> DataFrame:
    """The same rows behind an ``explode``: a later filter on the fields stays above it. Pushed below, it would run the
    patterns again at each of its references, in the condition of the join before them."""
    return found.select(F.explode(F.array(F.struct(*found.columns))).alias("_r")).select("_r.*")


def _record_fields(records: DataFrame, keep: Sequence[str], parcel_pattern: str, amounts: Mapping[str, tuple], blocks: Mapping[str, Column]) -> DataFrame:
    """One row per record with the first match of every field, in text order.

    A field of a record in several pieces is that of its first piece that has it; only those pieces
    are shuffled. ``amounts`` (pattern, names) and ``blocks`` are further columns, merged alike. Every pattern
    runs once a piece: matches are columns of their own before anything refers to them twice.
    """
    text = F.col("_text")
    patterns = {n: (fixed.RECORD_PATTERNS[n], 1) for n in _FOUND} | {n: (p, 0) for n, (p, _) in amounts.items()}
    rows = _pieces(records).withColumns({
        **{f"_m_{n}": _first_match(text, n, p, g) for n, (p, g) in patterns.items()},
        "_m_description": F.regexp_extract(text, fixed.DESCRIPTION_PATTERNS[0], 1),
        "_m_parcel": F.when(F.col("first"), F.regexp_extract(F.get("lines", F.lit(0)), parcel_pattern, 1))})
    opening = F.slice(F.concat("lines", "ahead"), 1, 5)
    own = {n: _own(text, p, g, F.col(f"_m_{n}")) for n, (p, g) in patterns.items()}
    found = {
        "parcel_code": F.regexp_replace(F.nullif("_m_parcel", F.lit("")), r"\s+", ""),
        "_owner": F.when(F.col("first"), _owner_lines(opening)),
        "_description": _description(text), "_district": _district(text),
        **{n: _amounts(c, amounts[n][1]) if n in amounts else c for n, c in own.items()}, **blocks}
    found = rows.select(*keep, "record_id", "at", "whole", *[c.alias(n) for n, c in found.items()])
    names = [c for c in found.columns if c not in (*keep, "record_id", "at", "whole")]
    if "ahead" in records.columns:
        first = {n: F.min_by(n, F.when(F.col(n).isNotNull(), F.struct(*([f"{n}.place"] if n in ("_description", "_district") else []), "at"))) for n in names}
        merged = found.filter(~F.col("whole")).groupBy(*keep, "record_id").agg(*[c.alias(n) for n, c in first.items()])
        found = _read_once(found.filter("whole").select(*keep, "record_id", *names)).unionByName(merged)
    else:
        found = _read_once(found)
    zero = F.lit(0).cast("decimal(18,2)")
    return found.select(
        *keep, "record_id", "parcel_code", "_owner", strip(F.col("_description.text")).alias("description"),
        F.col("acreage").try_cast("double").alias("acreage"), F.col("property_class").try_cast("int").alias("property_class"),
        "zone", "account_number", F.col("_district.name").alias("district"), F.lit(None).cast("string").alias("deed_book"),
        F.coalesce(decimal_text("first_half_tax"), zero).alias("first_half_tax"),
        F.coalesce(decimal_text("second_half_tax"), zero).alias("second_half_tax"),
        F.coalesce(int_text("deferred_value"), F.lit(0)).cast("bigint").alias("deferred_value"), *amounts, *blocks)


def _amounts(block: Column, names: Sequence[str]) -> Column:
    """Struct of the amounts of a matched block: longs, the last one (tax) decimal.

    The block is cut at white space; no amount holds any.
    """
    def read(parts: Column) -> Column:
        values = []
        for i, name in enumerate(names):
            found = F.get(parts, F.lit(i))
            values.append((decimal_text(found) if name == "tax" else int_text(found)).alias(name))
        return F.when(parts.isNotNull(), F.struct(*values))

    return let(F.split(block, r"\s+"), read)


def _with_values(records: DataFrame, land: Column, improvement: Column, total: Column, tax: Column) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    owner = [F.get("_owner", F.lit(i)).alias(name)
             for i, name in enumerate(("owner_name", "owner_address", "owner_city_state_zip"))]
    values = records.select(
        "*", *owner, F.coalesce(land, zero).alias("land_value"), F.coalesce(improvement, zero).alias("improvement_value"),
        F.coalesce(total, zero).alias("total_value"),
        F.coalesce(tax, F.lit(0).cast("decimal(18,2)")).alias("tax_amount"))
    meaningful = F.col("parcel_code").isNotNull() & ((F.col("total_value") > 0) | (F.col("land_value") > 0))
    return values.filter(meaningful).drop("_owner")


def property_records(records: DataFrame, keep: Sequence[str], caps: Mapping = fixed.VALUE_CAPS) -> DataFrame:
    """Property fields of records: of :func:`record_pieces`, or of :func:`assemble_records`.

    Values come from the four amounts before the account mark, if under the
    caps; else from three amounts (land, total, tax). Records without a parcel
    code or without value are dropped. ``deed_book`` is a column that no text fills.
    A description that is known by its last word only starts in the piece that holds this word.
    """
    base = _record_fields(records, keep, fixed.RECORD_PATTERNS["parcel_code"], {
        "four": (fixed.VALUE_BLOCK, ("land", "improvement", "total", "tax")),
        "three": (fixed.VALUE_BLOCK_LAND_ONLY, ("land", "total", "tax"))}, {})
    four_ok = ((F.col("four.total") < caps["total"]) & (F.col("four.tax") < caps["tax"])
               & (F.col("four.total") != 0))
    three_ok = F.col("three.total") < caps["total"]

    def pick(name: str) -> Column:
        return F.when(four_ok, F.col(f"four.{name}")).when(three_ok, F.col(f"three.{name}"))

    # A block whose total is zero still gives its improvement; the land-only form has none of its own.
    capped = (F.col("four.total") < caps["total"]) & (F.col("four.tax") < caps["tax"])
    improvement = F.when(F.coalesce(capped, F.lit(False)), F.col("four.improvement"))
    return _with_values(base, pick("land"), improvement, pick("total"), pick("tax")).drop("four", "three")


def _all_blocks(text: Column) -> Column:
    """Every four-amount block of the text as typed structs; found once and cut at white space, which no amount holds."""
    def read(block: Column) -> Column:
        return let(F.split(block, r"\s+"), lambda n: F.struct(
            int_text(n[0]).alias("land"), int_text(n[1]).alias("improvement"), int_text(n[2]).alias("total"), decimal_text(n[3]).alias("tax")))

    return F.transform(F.regexp_extract_all(text, F.lit(fixed.VALUE_BLOCK_ANY), F.lit(0)), read)


def property_records_strict(records: DataFrame, keep: Sequence[str],
                            caps: Mapping = fixed.VALUE_CAPS_STRICT) -> DataFrame:
    """As :func:`property_records`, with the first block that is consistent.

    A block counts when its parts add up, its tax rate is plausible and it is
    under the caps. The land-only form needs land and total to be equal. Blocks are told
    apart from the start of a piece.
    """
    low, high = fixed.TAX_RATE_RANGE

    def valid(b: Column) -> Column:
        rate = b["tax"].cast("double") / F.nullif(b["total"].cast("double"), F.lit(0.0))
        return ((F.abs(b["land"] + b["improvement"] - b["total"]) < fixed.SUM_TOLERANCE) & (b["total"] > 0)
                & (rate > low) & (rate < high) & (b["total"] < caps["total"]) & (b["tax"] < caps["tax"]))

    base = _record_fields(records, keep, fixed.RECORD_PATTERNS["parcel_code_strict"], {
        "three": (fixed.VALUE_BLOCK_LAND_ONLY_STRICT, ("land", "total", "tax"))},
        {"four": F.get(F.filter(_all_blocks(F.col("_text")), valid), F.lit(0))})
    found = F.col("four").isNotNull()
    same = F.col("three.land") == F.col("three.total")

    def pick(name: str) -> Column:
        return F.when(found, F.col(f"four.{name}")).when(same, F.col(f"three.{name}"))

    return _with_values(base, pick("land"), F.when(found, F.col("four.improvement")), pick("total"),
                        pick("tax")).drop("four", "three")


# --- labelled numbers --------------------------------------------------------------------

def line_measures(lines: DataFrame, kind: str, keep: Sequence[str], line: str = "line") -> DataFrame:
    """Lines of the form "label number number ..." as a label and named measures."""
    pattern, names = fixed.LINE_PATTERNS[kind], fixed.LINE_MEASURES[kind]
    text = strip(F.col(line))
    measures = [F.translate(F.regexp_extract(text, pattern, i), ",", "").try_cast("double").alias(n)
                for i, n in enumerate(names, 2)]
    rows = lines.filter(text.rlike(pattern)).select(
        *keep, strip(F.regexp_extract(text, pattern, 1)).alias("label"), *measures)
    if kind == "expenditure":
        total = reduce(Column.__add__, [F.col(n) for n in names])
        rows = rows.withColumn("total", total).filter(F.col("total") > 0)
    return rows


def all_line_measures(lines: DataFrame, keep: Sequence[str], line: str = "line",
                      kinds: Sequence[str] = tuple(fixed.LINE_PATTERNS)) -> DataFrame:
    """Lines of any of the ``kinds`` in one pass: ``kind``, ``label`` and the ``measures`` as an array in the
    order of ``fixed.LINE_MEASURES`` (with the total last for expenditures). A line that has the form of
    several kinds gives one row for each of them."""
    text = strip(F.col(line))

    def hit(kind: str) -> Column:
        pattern, count = fixed.LINE_PATTERNS[kind], len(fixed.LINE_MEASURES[kind])
        values = F.array(*[F.translate(F.regexp_extract(text, pattern, i), ",", "").try_cast("double") for i in range(2, count + 2)])
        if kind == "expenditure":
            values = let(values, lambda v: F.concat(v, F.array(reduce(Column.__add__, [F.get(v, F.lit(i)) for i in range(count)]))))
        found = F.struct(F.lit(kind).alias("kind"), strip(F.regexp_extract(text, pattern, 1)).alias("label"), values.alias("measures"))
        return F.when(text.rlike(pattern), found)

    rows = lines.select(*keep, F.explode(F.array_compact(F.array(*[hit(k) for k in kinds]))).alias("h")).select(*keep, "h.*")
    return rows.filter((F.col("kind") != "expenditure") | (F.element_at("measures", -1) > 0))


def _last_numbers(found: Column, count: int) -> Column:
    """The trailing ``count`` numbers of a matched piece of text."""
    numbers = F.regexp_extract_all(found, F.lit(r"([\d,]*\d[\d,]*(?:\.\d*)?)"), F.lit(1))
    return F.transform(F.slice(numbers, -count, count), lambda x: F.translate(x, ",", "").try_cast("double"))


def section_measures(docs: DataFrame, text: str, keep: Sequence[str], section: str = "expenditures",
                     categories: Mapping[str, str] = fixed.SECTION_CATEGORIES,
                     names: Sequence[str] = fixed.SECTION_MEASURES) -> DataFrame:
    """One row per category found in the named section of a document."""
    body = docs.select(*keep, F.regexp_extract(text, fixed.SECTIONS[section], 0).alias("_section"))
    hits = F.array(*[F.struct(F.lit(key).alias("category"),
                              F.regexp_extract("_section", "(?i)" + pattern, 0).alias("found"))
                     for key, pattern in categories.items()])
    # No section leaves an empty text, in which no category is found.
    rows = body.select(*keep, F.explode(F.filter(hits, lambda h: h["found"] != "")).alias("h"))
    numbered = rows.select(*keep, F.col("h.category").alias("category"),
                           _last_numbers(F.col("h.found"), len(names)).alias("_n"))
    return numbered.select(*keep, "category", *[F.get("_n", F.lit(i)).alias(n) for i, n in enumerate(names)])


def _first_hits(text: Column | str, patterns: Mapping[str, str], count: int) -> Column:
    """Per category whose pattern is in the text: the first match's trailing ``count`` words as numbers. A
    number that is none is null."""
    found = F.array(*[F.struct(F.lit(key).alias("category"), F.regexp_extract(text, "(?i)" + pattern, 0).alias("found"))
                      for key, pattern in patterns.items()])
    words = lambda h: F.slice(F.split(h["found"], r"\s+"), -count, count)
    return F.transform(F.filter(found, lambda h: h["found"] != ""), lambda h: F.struct(
        h["category"].alias("category"), F.transform(words(h), lambda w: w.try_cast("double")).alias("numbers")))


def personnel_summary(pages: DataFrame, document: Sequence[str], page: str, text: str,
                      markers: Sequence[str] = fixed.PAGE_MARKERS["personnel"],
                      departments: Mapping[str, str] = fixed.STAFF_CATEGORIES, totals: Mapping[str, str] = fixed.STAFF_TOTALS,
                      names: Sequence[str] = fixed.STAFF_MEASURES) -> DataFrame:
    """Staff of each document's personnel table: a row per department and per total that it holds, with the
    ``page``, the ``kind`` ("department" or "total"), the ``category`` and six typed measures.

    The table is on the first page that holds every marker, and is what stands there between its heading
    and the reasons for the change. Pages are narrowed to those that hold the markers first, so only their
    sections are shuffled, and of each document one section goes on. A document without such a page, or
    whose page lacks the heading, has no row.
    """
    hit = reduce(Column.__and__, [F.col(text).contains(m) for m in markers])
    sections = pages.filter(hit).select(*document, F.col(page).alias("page"),
                                        F.regexp_extract(text, fixed.SECTIONS["personnel"], 0).alias("_section"))
    first = sections.groupBy(*document).agg(F.min_by("_section", "page").alias("_section"), F.min("page").alias("page"))

    def hits(kind: str, patterns: Mapping[str, str]) -> Column:
        return F.transform(_first_hits("_section", patterns, len(names)), lambda h: F.struct(
            F.lit(kind).alias("kind"), h["category"].alias("category"), h["numbers"].alias("numbers")))

    rows = first.select(*document, "page", F.explode(F.concat(hits("department", departments), hits("total", totals))).alias("h"))
    return rows.select(*document, "page", "h.kind", "h.category", *[F.get("h.numbers", F.lit(i)).alias(n) for i, n in enumerate(names)])


def _per_label(docs: DataFrame, keep: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    hits = F.array(*[F.struct(F.lit(k).alias("label"), v.alias("value")) for k, v in values.items()])
    return docs.select(*keep, F.explode(F.filter(hits, lambda h: h["value"].isNotNull())).alias("h")).select(
        *keep, "h.*")


def max_per_label(docs: DataFrame, text: str, keep: Sequence[str],
                  patterns: Mapping[str, str] = fixed.FUND_PATTERNS) -> DataFrame:
    """Greatest non-zero amount among all matches of each label."""
    def best(pattern: str) -> Column:
        found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
        amounts = F.transform(found, lambda x: amount_or_null(x, fixed.NULL_AMOUNT_MARKS_V1))
        return F.array_max(F.filter(amounts, lambda x: x.isNotNull() & (x != 0)))

    return _per_label(docs, keep, {k: best(p) for k, p in patterns.items()})


def first_per_label(docs: DataFrame, text: str, keep: Sequence[str],
                    patterns: Mapping[str, str] = fixed.FUNCTION_PATTERNS) -> DataFrame:
    """Amount of the first match of each label."""
    values = {k: amount_or_null(match(text, p), fixed.NULL_AMOUNT_MARKS_V1) for k, p in patterns.items()}
    return _per_label(docs, keep, values)


def name_counts(docs: DataFrame, text: str, keep: Sequence[str], section: str | None = "staffing",
                pattern: str = fixed.NAME_COUNT_PATTERN, min_letters: int = 4) -> DataFrame:
    """Name and count pairs of a staffing section; the last pair of a name wins."""
    body = match(text, fixed.SECTIONS[section], 0) if section else F.col(text)
    docs = docs.select(*keep, body.alias("_body"))
    names = F.regexp_extract_all(F.col("_body"), F.lit(pattern), F.lit(1))
    counts = F.regexp_extract_all(F.col("_body"), F.lit(pattern), F.lit(2))
    pairs = docs.select(*keep, F.posexplode(F.arrays_zip(names.alias("n"), counts.alias("c"))).alias("pos", "pair"))
    rows = pairs.select(*keep, "pos", strip(F.col("pair.n")).alias("name"),
                        amount_or_null(F.col("pair.c"), fixed.NULL_AMOUNT_MARKS_V1).alias("count"))
    good = (F.length("name") >= min_letters) & (F.col("count") != 0)
    return rows.filter(good).groupBy(*keep, "name").agg(F.max_by("count", "pos").alias("count"))


# --- HTML ---------------------------------------------------------------------------------

def html_fields(pages: DataFrame, html: str, keep: Sequence[str],
                fields: Mapping[str, tuple[str, str]] = fixed.PAGE_FIELDS) -> DataFrame:
    """Field dictionary of an HTML column; ``group.name`` keys become a struct per group."""
    def value(pattern: str, kind: str) -> Column:
        found = match(html, pattern)
        if kind == "string":
            return found
        bare = F.regexp_replace(F.translate(found, ",", ""), r"\.+$", "")
        return bare.try_cast(kind)

    flat = [value(p, t).alias(k) for k, (p, t) in fields.items() if "." not in k]
    groups: dict[str, list[Column]] = {}
    for key, (pattern, kind) in fields.items():
        if "." in key:
            group, name = key.split(".", 1)
            groups.setdefault(group, []).append(value(pattern, kind).alias(name))
    return pages.select(*keep, *flat, *[F.struct(*cs).alias(g) for g, cs in groups.items()])


# --- sheet grids ---------------------------------------------------------------------------

def _has_groups(text: Column, groups: Sequence[Sequence[str]]) -> Column:
    return reduce(Column.__and__, [reduce(Column.__or__, [text.contains(w) for w in g]) for g in groups])


def field_of_header(header: Column | str, rules: Sequence[tuple]) -> Column:
    """First field rule whose word groups all occur in the lower-cased header."""
    def first_rule(text: Column) -> Column:
        chain = None
        for name, groups in rules:
            test = _has_groups(text, groups)
            chain = F.when(test, F.lit(name)) if chain is None else chain.when(test, F.lit(name))
        return chain

    return let(F.lower(col(header)), first_rule)


def pack_rows(cells: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """One row per sheet row with its cells in column order; a row is as long as the sheet is wide."""
    return cells.groupBy(*sheet, "row_idx").agg(
        F.array_sort(F.collect_list(F.struct("col_idx", "value"))).alias("cells"))


def header_rows(rows: DataFrame, sheet: Sequence[str], header_tests: Sequence) -> DataFrame:
    """First row of each sheet whose joined cell texts pass the tests, with its cells."""
    filled = F.transform(F.filter("cells", lambda c: c["value"].isNotNull()), lambda c: F.lower(c["value"]))

    def passes(text: Column) -> Column:
        return reduce(Column.__or__, [_has_groups(text, groups) for groups in header_tests])

    hits = rows.filter(let(F.array_join(filled, " "), passes))
    first = hits.groupBy(*sheet).agg(F.min(F.struct("row_idx", "cells")).alias("h"))
    return first.select(*sheet, F.col("h.row_idx").alias("header_row"), F.col("h.cells").alias("header"))


def sheet_layout(head: DataFrame, sheet: Sequence[str], rules: Sequence[tuple],
                 key_words: Sequence[str]) -> DataFrame:
    """Per sheet the column of the key and of each field; the last column of a field wins."""
    named = head.withColumn("_h", F.transform("header", lambda c: F.struct(
        c["col_idx"].alias("col"), field_of_header(c["value"], rules).alias("field"),
        reduce(Column.__or__, [F.lower(c["value"]).contains(w) for w in key_words]).alias("is_key"))))
    keys = F.filter("_h", lambda c: c["is_key"])
    key_col = F.coalesce(F.array_min(F.transform(keys, lambda c: c["col"])),
                         F.array_min(F.transform("_h", lambda c: c["col"])))

    def place(name: str) -> Column:
        return F.array_max(F.transform(F.filter("_h", lambda c: c["field"] == name), lambda c: c["col"]))

    return named.select(*sheet, "header_row", key_col.alias("key_col"),
                        *[place(name).alias(f"col_{name}") for name, _ in rules])


def promote_header(cells: DataFrame, sheet: Sequence[str], kind: str,
                   targets: Mapping[str, str] | None = None,
                   key_words: Sequence[str] = fixed.KEY_HEADERS, headers: Mapping = fixed.GRID_HEADERS,
                   fields: Mapping = fixed.GRID_FIELDS) -> DataFrame:
    """Header promotion: cells below the header row become named fields, one row per sheet row.

    The key column is the first one whose header holds a key word, else the
    first column. With ``targets`` only rows with a target code remain, or, in a
    sheet without any, rows that name a target. Cells are shuffled once, into
    rows; the layout is one row per sheet.
    """
    if kind not in fields:
        raise ValueError(f"no fields are known for {kind!r}; a comparative report goes through comparative_rows")
    rules = fields[kind]
    names = [name for name, _ in rules]
    rows = pack_rows(cells, sheet)
    # A sheet without any known header has no row to give.
    any_field = F.coalesce(*[F.col(f"col_{n}") for n in names]).isNotNull()
    layout = sheet_layout(header_rows(rows, sheet, headers[kind]), sheet, rules, key_words).filter(any_field)
    body = rows.join(layout, list(sheet)).filter(F.col("row_idx") > F.col("header_row")).withColumn(
        "_values", F.map_from_entries("cells"))
    picked = F.array(*[F.element_at("_values", F.col(f"col_{n}")) for n in names])
    numbers = body.withColumn("_n", F.transform(picked, clean_amount))
    wide = numbers.select(*sheet, "row_idx", strip(F.element_at("_values", F.col("key_col"))).alias("key"),
                          *[F.when(F.col(f"col_{n}").isNotNull(), F.get("_n", F.lit(i))).alias(n)
                            for i, n in enumerate(names)])
    found = wide.filter(F.col("key").isNotNull())
    if targets is None:
        return found
    by_code = F.col("key").isin(list(targets))
    by_name = reduce(Column.__or__, [F.lower("key").contains(n.lower()) for n in targets.values()])
    candidates = found.filter(by_code | by_name)
    coded = candidates.filter(by_code).select(*sheet).distinct().withColumn("_coded", F.lit(True))
    return (candidates.join(coded, list(sheet), "left")
            .filter(by_code | F.col("_coded").isNull()).drop("_coded"))


def comparative_rows(cells: DataFrame, file: str = "file", sheet: str = "sheet", divisions: Mapping[str, str] = fixed.DIVISIONS,
                     sheets: Sequence[str] = fixed.COMPARATIVE_SHEETS, key_words: Sequence[str] = fixed.COMPARATIVE_KEYS,
                     header_tests: Sequence = fixed.GRID_HEADERS["comparative"]) -> DataFrame:
    """Rows of the listed divisions in a comparative report: one row per cell, with the ``header`` above it.

    Of each file only sheets named by one of ``sheets`` are read, or all where none is. The place column is
    the first one whose header holds a key word; a sheet without any gives nothing. A row counts if its
    place holds the first word of a division's name; ``division_code`` is that of the longest name that the
    place holds whole, else of the first one by code whose first word it holds.
    """
    named = reduce(Column.__or__, [F.lower(sheet).contains(w) for w in sheets])
    routed = cells.select(file, sheet).distinct().withColumn("_named", named)
    some = routed.filter("_named").select(file).distinct().withColumn("_any", F.lit(True))
    routed = routed.join(some, file, "left").filter(F.col("_named") | F.col("_any").isNull()).select(file, sheet)
    rows = pack_rows(cells.join(routed, [file, sheet], "left_semi"), [file, sheet])
    head = header_rows(rows, [file, sheet], header_tests)
    keys = F.filter("header", lambda c: reduce(Column.__or__, [F.lower(c["value"]).contains(w) for w in key_words]))
    layout = head.withColumn("key_col", F.array_min(F.transform(keys, lambda c: c["col_idx"]))).filter("key_col IS NOT NULL")
    layout = layout.select(file, sheet, "header_row", "key_col", F.map_from_entries("header").alias("_header"))
    body = rows.join(layout, [file, sheet]).filter(F.col("row_idx") > F.col("header_row")).withColumn("_values", F.map_from_entries("cells"))
    place = strip(F.element_at("_values", F.col("key_col")))
    names = sorted(divisions.items(), key=lambda d: (-len(d[1]), d[0]))
    known = None
    for code, name in names:
        hit = F.lower(place).contains(name.lower())
        known = F.when(hit, F.lit(code)) if known is None else known.when(hit, F.lit(code))
    for code, name in sorted(divisions.items()):
        known = known.when(F.lower(place).contains(name.lower().split()[0]), F.lit(code))
    found = body.withColumn("place", place).withColumn("division_code", known).filter("division_code IS NOT NULL")
    cell = F.explode(F.filter("cells", lambda c: c["value"].isNotNull() & (c["col_idx"] != F.col("key_col"))))
    long = found.select(file, sheet, "row_idx", "place", "division_code", "_header", cell.alias("c"))
    return long.select(file, sheet, "row_idx", "place", "division_code", F.col("c.col_idx").alias("col_idx"),
                       F.element_at("_header", F.col("c.col_idx")).alias("header"), F.col("c.value").alias("value"))


def score_tables(rows: DataFrame, table: Sequence[str], row_idx: str, text: str,
                 keywords: Sequence[str] = fixed.TABLE_KEYWORDS, first_rows: int = 5,
                 at_least: int = 2) -> DataFrame:
    """Distinct keywords in the header (row 0) and the first five rows; tables with 2+ hits, with
    their ``rank``, best first (ties by the table's key).

    Only six short rows per table reach the aggregation.
    """
    few = rows.filter(F.col(row_idx) <= first_rows)
    packed = few.groupBy(*table).agg(F.array_sort(F.collect_list(F.struct(
        F.col(row_idx).alias("i"), F.lower(text).alias("t")))).alias("_rows"))
    head = F.array_join(F.filter("_rows", lambda r: r["i"] == 0)["t"], "")
    body = F.array_join(F.filter("_rows", lambda r: r["i"] > 0)["t"], "")
    whole = F.concat(head, F.lit(" "), body)
    hits = reduce(Column.__add__, [F.col("_text").contains(k).cast("int") for k in keywords])
    scored = packed.withColumn("_text", whole).withColumn("keyword_matches", hits.cast("bigint"))
    kept = scored.filter(F.col("keyword_matches") >= at_least).select(*table, "keyword_matches")
    # The few kept rows are written once; the rank counts and samples those.
    return global_rank(durable(kept), [F.col("keyword_matches").desc(), *map(F.col, table)])


def row_categories(rows: DataFrame, table: Sequence[str], row_idx: str, text: str, amounts: str | Sequence[str],
                   patterns: Mapping[str, str] = fixed.ROW_CATEGORIES,
                   other_over: float = fixed.ROW_OTHER_OVER) -> DataFrame:
    """Per table: sums per category, by the largest positive amount of each row.

    The first matching pattern decides; a row that only says "total" sets the
    total (the last one wins); other rows above the bound count as other. With
    no total row the total is the sum. ``amounts`` is an array column or a list of
    columns.
    """
    if isinstance(amounts, str):
        largest = F.array_max(F.filter(amounts, lambda a: a > 0))
    else:
        largest = F.greatest(*[F.when(F.col(a) > 0, F.col(a)) for a in amounts])
    lowered = F.lower(text)
    (first, pattern), *rest = patterns.items()
    chain = F.when(lowered.rlike(pattern), F.lit(first))
    for name, pattern in rest:
        chain = chain.when(lowered.rlike(pattern), F.lit(name))
    label = (chain.when(lowered.contains("total"), F.lit("total"))
             .when(F.col("_amount") > other_over, F.lit("other")))
    labelled = (rows.withColumn("_amount", largest)
                .filter(F.col("_amount").isNotNull()).withColumn("_label", label))
    money = F.col("_amount")

    def total_of(name: str) -> Column:
        part = money_sum(F.when(F.col("_label") == name, money)).cast("double")
        return F.coalesce(part, F.lit(0.0)).alias(name)

    is_total = F.col("_label") == "total"
    names = [*patterns, "other"]
    out = labelled.groupBy(*table).agg(
        *[total_of(n) for n in names],
        F.max(F.when(is_total, F.struct(F.col(row_idx).alias("i"), money.alias("m"))))["m"]
        .cast("double").alias("_stated"),
        F.coalesce(money_sum(F.when(~is_total, money)).cast("double"), F.lit(0.0)).alias("_summed"))
    stated = F.nullif(F.col("_stated"), F.lit(0.0))
    return out.withColumn("total", F.coalesce(stated, F.col("_summed"))).drop("_stated", "_summed")


def locate_page(pages: DataFrame, document: Sequence[str], page: str, text: str,
                markers: Sequence[str]) -> DataFrame:
    """First page of each document that holds every marker phrase."""
    hit = reduce(Column.__and__, [F.col(text).contains(m) for m in markers])
    return pages.filter(hit).groupBy(*document).agg(F.min(page).alias("page"))
