"""JSON sources: wrapped record sets, nested records, GeoJSON features.

A file that wraps its records in one array is read by many tasks. Each task summarises a byte
range for both cases, starting outside or inside a string: whether a string is open at its
end, and how the bracket depth changed. Summaries of a file chain up to the state at the start of
every range; with it a task cuts the elements that begin in its range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from auditloom import fixed
from auditloom.session import durable
from auditloom.sources import ranges

_QUOTE, _ESCAPE = ord('"'), ord("\\")
_STEP = np.zeros(256, np.int8)
_STEP[[ord("["), ord("{")]] = 1
_STEP[[ord("]"), ord("}")]] = -1


def _scan(data: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Places of the quotes that open or close strings and of all brackets, the step of each bracket, and whether
    the byte after ``data`` is escaped."""
    raw = np.frombuffer(data, np.uint8)
    quotes, slashes, marks = (np.flatnonzero(x) for x in (raw == _QUOTE, raw == _ESCAPE, _STEP[raw]))
    # A run of n backslashes escapes what follows if n is odd.
    after = np.zeros(1 if escaped else 0, np.int64)
    escaped = escaped and not len(raw)
    if len(slashes):
        breaks = np.flatnonzero(np.diff(slashes) != 1)
        first, last = slashes[np.concatenate(([0], breaks + 1))], slashes[np.concatenate((breaks, [-1]))]
        length = last - first + 1
        if len(after) and first[0] == 0:
            length[0] += 1
            after = after[:0]
        after = np.concatenate((after, last[length % 2 == 1] + 1))
        escaped = bool(last[-1] == len(raw) - 1 and length[-1] % 2 == 1)
    if len(after):
        quotes = quotes[~np.isin(quotes, after, assume_unique=True)]
    return quotes, marks, _STEP[raw[marks]], escaped


class Scanner:
    """Depth and string state over the bytes of a file, block by block, from a known start."""

    def __init__(self, depth: int = 0, inside: bool = False, escaped: bool = False):
        self.depth, self.inside, self.escaped = depth, inside, escaped

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the brackets outside of strings, the depth before and the depth after each of them."""
        quotes, marks, step, self.escaped = _scan(data, self.escaped)
        open_ = (np.searchsorted(quotes, marks) + self.inside) % 2 == 0
        marks, step = marks[open_], step[open_]
        depth = self.depth + np.cumsum(step, dtype=np.int64)
        self.inside ^= len(quotes) % 2 == 1
        if len(depth):
            self.depth = int(depth[-1])
        return marks, depth - step, depth


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range and start state: the change of depth and the state at the end.

    The state has a third part, whether the first byte is escaped; a range begins with it if an odd run of
    backslashes ends before it, which the task looks up. Brackets that are outside of strings for one start state
    are inside for the other, so one scan serves both.
    """
    for batch in batches:
        for r in batch.to_pylist():
            inside, escaped, change = False, _escaped(r["path"], r["at"]), [0, 0]
            for data in ranges.blocks(r["path"], r["at"], r["size"]):
                quotes, marks, step, escaped = _scan(data, escaped)
                odd = (np.searchsorted(quotes, marks) + inside) % 2 == 1
                change[0] += int(step[~odd].sum(dtype=np.int64))
                change[1] += int(step[odd].sum(dtype=np.int64))
                inside ^= len(quotes) % 2 == 1
            yield pa.RecordBatch.from_pylist([{**{k: r[k] for k in ("path", "part", "at", "size")}, "flips": inside,
                                               "out": change[0], "in": change[1]}], schema=_SUMMARY)


_SUMMARY = pa.schema([("path", pa.string()), ("part", pa.int64()), ("at", pa.int64()), ("size", pa.int64()), ("flips", pa.bool_()), ("out", pa.int64()), ("in", pa.int64())])


def _escaped(path: str, at: int) -> bool:
    """Whether an odd run of backslashes ends right before ``at``."""
    back, run = 64, 0
    while at > 0:
        start = max(0, at - back)
        tail = b"".join(ranges.blocks(path, start, at - start))
        run = len(tail) - len(tail.rstrip(b"\\"))
        if run < len(tail) or start == 0:
            break
        back *= 8
    return run % 2 == 1


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements that begin in each range, as (path, offset, text): objects at depth ``level`` between the
    offsets ``from`` and ``to``. Other members at that depth are passed over."""
    for batch in batches:
        for r in batch.to_pylist():
            yield from _cut(r)


def _cut(r: dict) -> Iterator[pa.RecordBatch]:
    scanner, at, end, level = Scanner(r["depth"], r["inside"], _escaped(r["path"], r["at"])), r["at"], r["at"] + r["size"], r["level"]
    open_at, held = None, b""
    for data in ranges.onward(r["path"], at, r["size"]):
        marks, prior, depth = scanner(data)
        # An element begins where an object opens at ``level`` and ends where the depth is ``level`` again.
        raw = np.frombuffer(data, np.uint8)[marks]
        begins = (prior == level) & (depth == level + 1) & (raw == ord("{"))
        edges = np.flatnonzero(begins | (prior == level + 1) & (depth == level))
        done, start, offsets, texts = False, 0, [], []
        for i, begin in zip(marks[edges].tolist(), begins[edges].tolist()):
            if begin:
                if at + i >= end:
                    done = True
                    break
                open_at, held, start = at + i, b"", i
            elif open_at is not None:
                if (r["from"] is None or open_at >= r["from"]) and (r["to"] is None or open_at <= r["to"]):
                    offsets.append(open_at)
                    texts.append((held + data[start: i + 1]).decode())
                open_at, held = None, b""
        if open_at is not None:
            held += data[start:]
        at += len(data)
        if texts:
            yield pa.RecordBatch.from_pydict({"path": [r["path"]] * len(texts), "offset": offsets, "text": texts}, schema=_ELEMENT)
        if done or at >= end and open_at is None:
            return


_ELEMENT = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("text", pa.string())])


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where an array opens as the value of a top-level key, or as the top itself, and where each ends, for what
    of it lies in a range."""
    for batch in batches:
        for r in batch.to_pylist():
            scanner, at, tail = Scanner(r["depth"], r["inside"], _escaped(r["path"], r["at"])), r["at"], b""
            rows = []
            if at:
                tail = b"".join(ranges.blocks(r["path"], max(0, at - 4096), min(at, 4096)))
            for data in ranges.blocks(r["path"], at, r["size"]):
                marks, prior, depth = scanner(data)
                raw = np.frombuffer(data, np.uint8)[marks]
                moves = np.flatnonzero((raw == ord("[")) & (prior <= 1) | (raw == ord("]")) & (depth <= 1))
                for k in moves.tolist():
                    key, i, opens = None, int(marks[k]), bool(raw[k] == ord("["))
                    if opens and prior[k] == 1:
                        key = _key((tail + data[max(0, i - 4096): i])[-4096:].rstrip())
                    rows.append({"path": r["path"], "offset": at + i, "level": int(min(prior[k], depth[k])), "opens": opens, "key": key})
                tail, at = (tail + data[-4096:])[-4096:], at + len(data)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_ARRAY)


_ARRAY = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("level", pa.int64()), ("opens", pa.bool_()), ("key", pa.string())])


def _key(text: bytes) -> str | None:
    """The key at the end of ``text``, which lies before an array: ``... "key" :``."""
    if not text.endswith(b":"):
        return None
    text = text[:-1].rstrip()
    start = text[:-1].rfind(b'"')
    return text[start + 1: -1].decode(errors="replace") if start >= 0 and text.endswith(b'"') else None


def elements(spark: SparkSession, path: str, record_path: str | None = None, size: int | None = None) -> DataFrame:
    """Record texts of wrapped JSON: ``path``, ``offset`` (byte in the file) and ``text`` of each object in the array.

    The array is that of the top-level key ``record_path``, else of the first of the known wrapper keys that holds
    an array, else the top-level list, in each file by itself. A file without any is one record. Ranges of
    ``size`` bytes are read by their own tasks, each from its start to the end of its last element. Array
    members that are no objects are passed over; an empty file gives no rows.
    """
    parts = ranges.split(ranges.listing(spark, path).filter("bytes > 0"), size)
    seen = durable(ranges.dealt(parts.select("path", "part", "at", "size"), "path", "part").mapInArrow(
        _summaries, "path string, part bigint, at bigint, size bigint, flips boolean, out bigint, `in` bigint"))
    # One row per range: states chain over the rows of a file.
    before = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    state = seen.withColumn("inside", F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0)) % 2 == 1)
    state = state.withColumn("change", F.when(F.col("inside"), F.col("in")).otherwise(F.col("out")))
    state = durable(state.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0))).select("path", "part", "at", "size", "inside", "depth"))
    dealt = ranges.dealt(state, "path", "part")

    # As many rows as there are arrays under top-level keys.
    marks = dealt.mapInArrow(_arrays, "path string, offset bigint, level bigint, opens boolean, key string")
    ends = Window.partitionBy("path", "level").orderBy("offset")
    spans = (marks.withColumn("to", F.lead("offset").over(ends)).filter("opens")
             .withColumn("place", F.when(F.col("level") == 0, F.lit(len(fixed.RECORD_KEYS)))
                         .otherwise(F.array_position(F.array(*[F.lit(k) for k in ([record_path] if record_path else fixed.RECORD_KEYS)]), F.col("key")) - 1))
             .filter("place >= 0" if record_path is None else "place = 0"))
    chosen = spans.groupBy("path").agg(F.min_by(F.struct("offset", "to", "level"), F.struct("place", "offset")).alias("s")).select(
        "path", F.col("s.offset").alias("from"), F.col("s.to").alias("to"), F.col("s.level").alias("level"))
    chosen = durable(chosen)
    # Each range carries the bounds of its file's array, so no record text is joined or shuffled.
    wanted = state.join(chosen.withColumn("known", F.lit(True)), "path", "left" if record_path is None else "inner")
    wanted = wanted.filter("known IS NULL OR at <= to AND at + size > from").withColumn("level", F.coalesce(F.col("level") + 1, F.lit(0)))
    return ranges.dealt(wanted.select("path", "part", "at", "size", "inside", "depth", "level", "from", "to"), "path", "part").mapInArrow(
        _elements, "path string, offset bigint, text string")


def read_records(spark: SparkSession, path: str, record_path: str | None = None,
                 schema: T.StructType | None = None) -> DataFrame:
    """Rows of a JSON file that wraps its records in an object.

    Without ``record_path`` the first known wrapper key that holds an array is
    used; a top-level list gives its elements; any other object is one row.
    """
    reader = spark.read.option("multiLine", True)
    raw = (reader.schema(schema) if schema else reader).json(path)
    if record_path is None:
        arrays = {f.name for f in raw.schema.fields if isinstance(f.dataType, T.ArrayType)}
        record_path = next((k for k in fixed.RECORD_KEYS if k in arrays), None)
        if record_path is None:
            return raw
    rows = raw.select(F.explode(record_path).alias("record"))
    if isinstance(rows.schema["record"].dataType, T.StructType):
        return rows.select("record.*")
    return rows


def _leaves(field: T.StructField, path: Column, name: str, sep: str) -> list[Column]:
    if isinstance(field.dataType, T.StructType):
        out: list[Column] = []
        for sub in field.dataType.fields:
            out += _leaves(sub, path.getField(sub.name), f"{name}{sep}{sub.name}", sep)
        return out
    if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StructType):
        return [F.to_json(path).alias(name)]
    return [path.alias(name)]


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct fields become top-level columns; arrays of structs become JSON text.

    One projection, so column pruning reaches the scan through it.
    """
    columns: list[Column] = []
    for field in df.schema.fields:
        columns += _leaves(field, F.col(f"`{field.name}`"), field.name, sep)
    return df.select(*columns)


def split_records(spark: SparkSession, path: str, record_path: str | None = None, size: int | None = None) -> DataFrame:
    """As :func:`read_records`, for files of any size: ``elements`` split by byte ranges, their schema merged over all
    of them by ``schema_of_variant_agg``. Fields that only some records have are null in the others."""
    found = durable(elements(spark, path, record_path, size))
    kind = _ddl(found.agg(F.schema_of_variant_agg(F.try_parse_json("text")).alias("s")).first()["s"])
    if not isinstance(kind, T.StructType) or not kind.fields:
        return found.select(F.lit(None).cast("string").alias("value")).filter("false")
    return found.select(F.from_json("text", kind).alias("r")).select("r.*")


def split_features(spark: SparkSession, path: str, size: int | None = None) -> DataFrame:
    """As :func:`read_features`, for files of any size; the columns are those of all features' properties."""
    found = durable(elements(spark, path, "features", size))
    shaped = found.select(F.try_parse_json("text").alias("v")).select(
        F.try_variant_get("v", "$.geometry.type", "string").alias("geometry_type"), F.to_json(F.variant_get("v", "$.geometry", "variant")).alias("geometry_json"),
        F.try_variant_get("v", "$.properties", "variant").alias("p"))
    kind = _ddl(shaped.agg(F.schema_of_variant_agg("p").alias("s")).first()["s"])
    fields = kind.fields if isinstance(kind, T.StructType) else []
    columns = []
    for f in fields:
        value = F.variant_get("p", f"$['{f.name}']", "variant")
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.VariantType, T.MapType))
        columns.append((F.to_json(value) if nested else F.try_variant_get("p", f"$['{f.name}']", f.dataType.simpleString())).alias(f.name))
    return shaped.select("geometry_type", "geometry_json", *columns)


def _ddl(schema: str | None) -> T.DataType:
    """The type that ``schema_of_variant_agg`` names; whole numbers and reals as bigint and double, what is never
    filled as string."""
    kind = T.DataType.fromDDL((schema or "VOID").replace("OBJECT<", "STRUCT<")) if schema and schema != "VOID" else T.NullType()

    def plain(t: T.DataType) -> T.DataType:
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in t.fields])
        if isinstance(t, T.ArrayType):
            return T.ArrayType(plain(t.elementType))
        if isinstance(t, T.DecimalType):
            return T.DoubleType() if t.scale else T.LongType()
        return T.StringType() if isinstance(t, (T.NullType, T.VariantType)) else t

    return plain(kind)


def read_features(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """GeoJSON features: geometry as type and JSON text, properties as columns."""
    features = read_records(spark, path, "features", schema)
    columns = [F.col("geometry.type").alias("geometry_type"), F.to_json("geometry").alias("geometry_json")]
    properties = features.schema["properties"].dataType
    for field in properties.fields:
        value = F.col("properties").getField(field.name)
        nested = isinstance(field.dataType, T.StructType)
        columns.append((F.to_json(value) if nested else value).alias(field.name))
    return features.select(*columns)
