"""Text functions against the Python standard library, on arbitrary Unicode."""

import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamiz.functions import text
from tamiz.functions.rows import key_values, new_batch, raw_cell, row_json

letters = st.characters(blacklist_categories=("Cs", "Cn", "Co"), blacklist_characters="\x00")
batches = st.lists(st.text(letters, max_size=30), min_size=200, max_size=400)


def plain(value):
    return "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))


def run(spark, values, function):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    found = rows.select("i", function(F.col("t")).alias("r")).collect()
    return [r.r for r in sorted(found, key=lambda r: r.i)]


@settings(max_examples=5, deadline=None)
@given(values=batches)
def test_accents(spark, values):
    assert run(spark, values, text.strip_accents) == [plain(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(values=batches)
def test_spaces(spark, values):
    collapsed = run(spark, values, lambda c: text.collapse_space(text.strip_space(c)))
    assert collapsed == [re.sub(r"\s+", " ", v.strip()) for v in values]
    assert run(spark, values, text.tighten_hyphens) == [re.sub(r"\s*-\s*", "-", v) for v in values]


def test_every_character_with_a_decomposition(spark):
    chars = [chr(c) for c in range(0x80, 0x30000) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) != "Cn"]
    chars = [c for c in chars if plain(c) != c]
    values = ["x".join(chars[i : i + 50]) for i in range(0, len(chars), 50)]
    assert run(spark, values, text.strip_accents) == [plain(v) for v in values]


def test_title_case(spark):
    values = ["CERRO-AMATE", "los remedios", "o'neill x2y", "ñandú éCOLE", "", "a  b"]
    assert run(spark, values, text.title_case) == [v.title() for v in values]


def test_rows_as_text(spark):
    row = spark.createDataFrame([(7, None, "x")], "a int, b string, c string").select(
        key_values({"a": F.col("a"), "b": F.col("b")}).alias("kv"),
        raw_cell("ID", F.col("a"), "b", F.col("b")).alias("cell"),
        raw_cell("ID", F.col("a"), "c", F.col("c"), quoted=False).alias("bare"),
        row_json("a", "b", "c").alias("json"),
    ).first()
    assert tuple(row) == ("a=7; b=", "ID=7 b='None'", "ID=7 c=x", '{"a":7,"b":null,"c":"x"}')


def test_batch_ids():
    first, second = new_batch(), new_batch()
    assert re.fullmatch(r"[0-9a-f]{12}", first[0]) and first[0] != second[0]
    assert first[1][:10].count("-") == 2 and first[1].endswith("+00:00")
