"""Source column types to Spark types."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The legacy substring rules, first match wins, in this order.
LEGACY_RULES = (
    (("numeric", "decimal"), "decimal"),
    (("bigint",), "bigint"),
    (("float",), "float"),
    (("double",), "double"),
    (("boolean",), "boolean"),
    (("datetime", "timestamp"), "timestamp_ntz"),
    (("time",), "time"),
    (("date",), "date"),
    (("varchar", "text", "char", "binary", "blob"), "string"),
    (("tinyint",), "tinyint"),
    (("smallint",), "smallint"),
    (("mediumint", "int"), "int"),
)

# Leading type word to type name.
WORD_RULES = {
    "decimal": "decimal",
    "numeric": "decimal",
    "bigint": "bigint",
    "float": "float",
    "double": "double",
    "real": "double",
    "boolean": "boolean",
    "bool": "boolean",
    "datetime": "timestamp_ntz",
    "timestamp": "timestamp_ntz",
    "time": "time",
    "date": "date",
    "binary": "binary",
    "varbinary": "binary",
    "tinyblob": "binary",
    "blob": "binary",
    "mediumblob": "binary",
    "longblob": "binary",
    "tinyint": "tinyint",
    "smallint": "smallint",
    "mediumint": "int",
    "int": "int",
    "integer": "int",
}

# An unsigned column needs the next wider type to hold its upper half.
UNSIGNED = {
    "tinyint": "smallint",
    "smallint": "int",
    "int": "bigint",
    "bigint": "decimal(20,0)",
}

# TIME is carried as milliseconds of the day.
SPARK_TYPES = {
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "time": T.IntegerType(),
    "date": T.DateType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
}

DECIMAL_ARGS = r"\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)"


def mysql_type_text(text: str, legacy: bool = False) -> str:
    """Type name for one source type text, e.g. ``varchar(32)`` -> ``string``."""
    lowered = text.strip().lower()
    if legacy:
        name = next((out for words, out in LEGACY_RULES if any(w in lowered for w in words)),
                    "string")
    else:
        word = re.match(r"[a-z]*", lowered).group(0)
        name = WORD_RULES.get(word, "string")
        if name == "int" and word == "mediumint" and "unsigned" in lowered:
            return "int"
        if "unsigned" in lowered:
            name = UNSIGNED.get(name, name)
    if name != "decimal":
        return name
    args = re.search(DECIMAL_ARGS, lowered)
    if args is None:
        return "decimal(10,0)"
    return f"decimal({int(args.group(1))},{int(args.group(2) or 0)})"


def mysql_type(text: str, legacy: bool = False) -> T.DataType:
    """Spark type for one source type text."""
    name = mysql_type_text(text, legacy)
    if name.startswith("decimal"):
        precision, scale = re.search(DECIMAL_ARGS, name).groups()
        if int(precision) > 38:
            return T.StringType()
        return T.DecimalType(int(precision), int(scale))
    return SPARK_TYPES[name]


def mysql_type_column(text: Column, legacy: bool = False) -> Column:
    """The same rules as a column, for frames of column metadata."""
    lowered = F.lower(F.trim(text))
    precision = F.coalesce(
        F.nullif(F.regexp_extract(lowered, DECIMAL_ARGS, 1), F.lit("")), F.lit("10"))
    scale = F.coalesce(
        F.nullif(F.regexp_extract(lowered, DECIMAL_ARGS, 2), F.lit("")), F.lit("0"))
    decimal = F.when(precision.cast("int") > 38, F.lit("string")).otherwise(
        F.concat(F.lit("decimal("), precision, F.lit(","), scale, F.lit(")")))

    if legacy:
        chain = None
        for words, out in LEGACY_RULES:
            hit = F.lit(False)
            for word in words:
                hit = hit | F.contains(lowered, F.lit(word))
            value = decimal if out == "decimal" else F.lit(out)
            chain = F.when(hit, value) if chain is None else chain.when(hit, value)
        return chain.otherwise(F.lit("string"))

    word = F.regexp_extract(lowered, "^[a-z]*", 0)
    unsigned = F.contains(lowered, F.lit("unsigned"))
    chain = F.when(word.isin("decimal", "numeric"), decimal).when(
        (word == "mediumint") & unsigned, F.lit("int"))
    for name, wider in UNSIGNED.items():
        words = [w for w, out in WORD_RULES.items() if out == name]
        chain = chain.when(word.isin(*words) & unsigned, F.lit(wider))
    for name in dict.fromkeys(WORD_RULES.values()):
        if name != "decimal":
            words = [w for w, out in WORD_RULES.items() if out == name]
            chain = chain.when(word.isin(*words), F.lit(name))
    return chain.otherwise(F.lit("string"))
