import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textassay.functions import text as T


def test_html_strip(column_of):
    cases = {
        None: "",
        "": "",
        "<p>a</p>\n<b>b</b>": "a b",
        "a < b": "a < b",
        "<a <b>x": "x",
        "a \x1cb": "a b",
        "  <br/> ": "",
        "a<p\nclass='x'>b": "a b",
        "<script>x</script>": "x",
        "<b>é</b> 1 < 2 <i": "é 1 < 2 <i",
        ">>a<b>": ">>a",
        "x" + "<" * 300_000: "x" + "<" * 300_000,
    }
    assert column_of(T.html_strip("text"), *cases) == list(cases.values())


def test_html_ratio(column_of):
    cases = {None: 0.0, "": 0.0, "<b>xyz": 0.5, "<b\n>": 1.0, "abc": 0.0, "<b>" + "x" * 7: 0.3, "<b>" + "<" * 300_000: 3 / 300_003}
    assert column_of(T.html_ratio("text"), *cases) == list(cases.values())


def test_blank(column_of):
    assert column_of(T.is_blank("text"), None, "", " \t　\x1f", " a ", "​") == [True, True, True, False, False]


def test_shingle_normalize(column_of):
    cases = {
        None: None,
        "Hola,  HOLA!": "hola hola",
        "!!!": "",
        "NiÑo ² x_y": "niño ² xy",
        "\U0001d49c-\U0001f642z": "\U0001d49cz",
        "日本 語。": "日本 語",
    }
    assert column_of(T.shingle_normalize("text"), *cases) == list(cases.values())


def test_shingles(column_of):
    found = column_of(T.shingles("text"), None, "abc", "!!!", "Hola, HOLA", "aaaaaaa", "a\U0001d49cbcde")
    assert [sorted(s) for s in found] == [
        [],
        ["abc"],
        [""],
        sorted({"hola ", "ola h", "la ho", "a hol", " hola"}),
        ["aaaaa"],
        sorted(["a\U0001d49cbcd", "\U0001d49cbcde"]),
    ]


def test_tokens(column_of):
    cases = {
        None: [],
        "": [],
        "...": [],
        "odio,asco": ["odioasco"],
        "Père Ñandú": ["pre", "ñandú"],
        " a b\tc ": ["a", "b", "c"],
        "x , y": ["x", "y"],
    }
    assert column_of(T.tox_tokens("text"), *cases) == list(cases.values())


def test_snippet(column_of):
    assert column_of(T.snippet("text"), "a" * 100, "b" * 101, None) == ["a" * 100, "b" * 100 + "...", None]


def test_labels(spark):
    df = spark.createDataFrame([(12.345,), (None,), (0.0,)], "v double")
    rows = df.select(T.percent_label("v").alias("p"), T.number_label("v").alias("n")).collect()
    assert [(r.p, r.n) for r in rows] == [("12.34%", "12.3450"), ("N/A", "N/A"), ("0.00%", "0.0000")]


# Characters on which Python, Java and the tables agree about case, plus every kind of whitespace.
ALPHABET = "aZñÉß09_.,<>/ \t\n\x0b\x1c\x85   　²½日\U0001d49c\U0001f642-@"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=20, max_size=40))
def test_expressions_agree_with_python(column_of, values):
    def strip(x):
        return re.sub(r"\s+", " ", re.sub(r"<[^>]*>", " ", x)).strip()

    def normalize(x):
        return " ".join("".join(c for c in x.lower() if c.isalnum() or c.isspace()).split())

    def tokens(x):
        return re.sub(r"[^a-záéíóúüñ0-9\s]", "", x.lower()).split()

    both = F.struct(
        T.html_strip("text").alias("strip"), T.shingle_normalize("text").alias("norm"), T.tox_tokens("text").alias("tokens"),
        T.is_blank("text").alias("blank"),
    )
    for value, row in zip(values, column_of(both, *values)):
        assert (row.strip, row.norm, row.tokens, row.blank) == (strip(value), normalize(value), tokens(value), value.strip() == "")


@pytest.mark.parametrize("size", [0, 1, 200_000])
def test_long_texts_are_linear(column_of, size):
    (found,) = column_of(F.size(T.shingles("text")), "ab" * size)
    assert found == (1 if size < 3 else 2)
