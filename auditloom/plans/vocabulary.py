"""SQL names that Spark spells differently, as temporary SQL functions.

Spark SQL has nearly the whole advertised vocabulary under the same names. The
functions here cover the scalar rest; they are SQL expressions, inlined by the
analyser. Aggregates have Spark names: ``listagg(x, sep) WITHIN GROUP (ORDER BY
...)`` for ``string_agg``, ``collect_list`` for ``list``; ``= ANY (subquery)`` is
``IN``; a base-10 ``log`` is ``log10``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import SparkSession

# Date letters and their patterns.
DATE_LETTERS = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%j": "DDD",
                "%b": "MMM", "%B": "MMMM", "%a": "EEE", "%A": "EEEE"}

_PATTERN = reduce(lambda text, kv: f"replace({text}, '{kv[0]}', '{kv[1]}')", DATE_LETTERS.items(), "letters")

FUNCTIONS = {
    "strftime(moment TIMESTAMP, letters STRING) RETURNS STRING": f"date_format(moment, {_PATTERN})",
    "json_extract(document STRING, path STRING) RETURNS STRING": "get_json_object(document, path)",
    "json_extract_string(document STRING, path STRING) RETURNS STRING": "get_json_object(document, path)",
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the temporary functions; returns their names."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.split("(")[0] for signature in FUNCTIONS]
