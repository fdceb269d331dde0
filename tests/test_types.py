import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import values
from tidewell.functions.types import mysql_type, mysql_type_column, mysql_type_text

CASES = [
    ("decimal(20,4)", "decimal(20,4)", "decimal(20,4)"),
    ("DECIMAL( 12 , 2 )", "decimal(12,2)", "decimal(12,2)"),
    ("numeric(9)", "decimal(9,0)", "decimal(9,0)"),
    ("decimal", "decimal(10,0)", "decimal(10,0)"),
    ("bigint(20)", "bigint", "bigint"),
    ("bigint(20) unsigned", "decimal(20,0)", "bigint"),
    ("int(11) unsigned", "bigint", "int"),
    ("mediumint(8) unsigned", "int", "int"),
    ("smallint(5) unsigned", "int", "smallint"),
    ("float", "float", "float"),
    ("double", "double", "double"),
    ("boolean", "boolean", "boolean"),
    ("datetime(6)", "timestamp_ntz", "timestamp_ntz"),
    ("timestamp", "timestamp_ntz", "timestamp_ntz"),
    ("time(3)", "time", "time"),
    ("date", "date", "date"),
    ("varchar(32)", "string", "string"),
    ("longtext", "string", "string"),
    ("varbinary(16)", "binary", "string"),
    ("mediumblob", "binary", "string"),
    ("tinyint(1)", "tinyint", "tinyint"),
    ("smallint(6)", "smallint", "smallint"),
    ("int(11)", "int", "int"),
    ("point", "string", "int"),
    ("enum('update','x')", "string", "date"),
    ("json", "string", "string"),
]


@pytest.mark.parametrize("text,new,old", CASES)
def test_type_text(text, new, old):
    assert mysql_type_text(text) == new
    assert mysql_type_text(text, legacy=True) == old


def test_type_column_agrees_with_driver_rules(spark):
    texts = [c[0] for c in CASES]
    assert values(spark, mysql_type_column, texts, "string") == [c[1] for c in CASES]
    legacy = values(spark, lambda c: mysql_type_column(c, legacy=True), texts, "string")
    assert legacy == [c[2] for c in CASES]


def test_spark_types():
    assert mysql_type("decimal(20,4)") == T.DecimalType(20, 4)
    assert mysql_type("decimal(65,4)") == T.StringType()
    assert mysql_type("varbinary(3)") == T.BinaryType()
    assert mysql_type("time") == T.IntegerType()
    assert mysql_type("bigint unsigned") == T.DecimalType(20, 0)
