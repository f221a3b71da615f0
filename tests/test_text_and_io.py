"""Literal-input tests for behaviour the driver tables do not exercise:
HTML tables, CJK cleaning, POS reduction, suffix stemming, CSV quoting and
missing-value tokens, JSON list / struct-of-arrays readers."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sparkprep.functions import text as T
from sparkprep.operators import html as H
from sparkprep.operators import text as TX
from sparkprep.sources import files as IO


def test_table_rows_skip_header_and_pick_cells(spark):
    html = ("<table><tr><th>Name</th><th>Age</th></tr>"
            "<tr><td>Ann</td><td>31</td><td>x</td></tr><tr class='r'><td>Bo</td><td>7</td></tr></table>")
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = H.table_rows(df, cells=[1, 2]).orderBy("row").collect()
    assert [(r["cell_1"], r["cell_2"]) for r in rows] == [("Ann", "31"), ("Bo", "7")]


def test_clean_text_keeps_cjk_and_its_punctuation(spark):
    df = spark.createDataFrame([("<p>这部电影 非常好！Great   movie...</p>",)], "t string")
    out = df.select(T.clean_text(F.col("t")).alias("c")).first()["c"]
    assert out == "这部电影 非常好！"


def test_reduce_pos(spark):
    df = spark.createDataFrame([(t,) for t in ["JJ", "NN", "VBD", "RB", "IN", "DT"]], "t string")
    got = [r[0] for r in df.select(TX.reduce_pos(F.col("t"))).collect()]
    assert got == ["a", "n", "v", "r", "n", "n"]


def test_regexp_stemmer_rule(spark):
    df = spark.createDataFrame([(w,) for w in ["running", "cats", "make", "readable", "is", "gas"]], "w string")
    got = [r[0] for r in df.select(TX.regexp_stem(F.col("w"))).collect()]
    assert got == ["runn", "cat", "mak", "read", "is", "gas"]


def test_read_csv_quotes_and_missing_tokens(spark):
    folder = tempfile.mkdtemp(prefix="sparkprep-csv-")
    with open(os.path.join(folder, "t.csv"), "w") as f:
        f.write('id,name,age\n1,"Kelly, Mr. James",34.5\n2,"Wilkes, Mrs. ""Ellen""",NA\n3,NaN,\n')
    df = IO.read_csv(spark, folder, "id long, name string, age double").orderBy("id").collect()
    assert df[0]["name"] == "Kelly, Mr. James" and df[0]["age"] == 34.5
    assert df[1]["name"] == 'Wilkes, Mrs. "Ellen"' and df[1]["age"] is None
    assert df[2]["name"] is None and df[2]["age"] is None


def test_json_list_and_struct_of_arrays(spark):
    folder = tempfile.mkdtemp(prefix="sparkprep-json-")
    with open(os.path.join(folder, "names.json"), "w") as f:
        f.write('["Anna", "Bob"]\n["Cy"]\n')
    names = sorted(r["name"] for r in IO.read_json_list(spark, os.path.join(folder, "names.json")).collect())
    assert names == ["Anna.", "Bob.", "Cy."]
    with open(os.path.join(folder, "soa.json"), "w") as f:
        f.write('{"X": ["a b", "c"], "Y": [1, 3]}\n')
    rows = IO.read_json_soa(spark, os.path.join(folder, "soa.json")).collect()
    assert [(r["X"], r["Y"]) for r in rows] == [("a b", 1), ("c", 3)]


def test_sentences_and_word_tokens(spark):
    df = spark.createDataFrame([("Hello there! How are you? Fine. don't",)], "t string")
    s = df.select(T.sentences(F.col("t"))).first()[0]
    assert s == ["Hello there!", "How are you?", "Fine.", "don't"]
    w = df.select(T.word_tokens(F.col("t"))).first()[0]
    assert w[:3] == ["Hello", "there", "!"] and w[-3:] == ["don", "'", "t"]
    c = df.select(T.clean_tokens(F.col("t"))).first()[0]
    assert c[-1] == "dont"


def test_indented_json_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    (tmp_path / "a" / "names.json").write_text('[\n  "Ann",\n  "Bo b"\n]\n')
    (tmp_path / "b" / "soa.json").write_text('{\n "X": ["p",\n  "q"],\n "Y": [1, 2]\n}\n')
    names = IO.read_json_list(spark, str(tmp_path / "a"), lines=False)
    assert sorted(r["name"] for r in names.collect()) == ["Ann.", "Bo b."]
    assert sorted(map(tuple, IO.read_json_soa(spark, str(tmp_path / "b"), lines=False).collect())) == [("p", 1), ("q", 2)]
    with pytest.raises(Exception):
        IO.read_json_list(spark, str(tmp_path / "a")).collect()  # an indented file read line by line


def test_csv_cells_with_line_breaks(spark, tmp_path):
    rows = [(1, 'a "quoted"\nline, two'), (2, "plain"), (3, None)]
    path = IO.write_csv(spark.createDataFrame(rows, "k long, t string"), str(tmp_path / "csv"))
    assert sorted(map(tuple, IO.read_csv(spark, path, "k long, t string").collect()), key=str) == rows
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.csv").write_text("k,t\n1,a\n2\n")
    with pytest.raises(Exception):
        IO.read_csv(spark, str(tmp_path / "bad"), "k long, t string").collect()


def test_html_elements_in_any_layout(spark):
    from sparkprep.operators import html as H
    page = ("<HTML><Title lang=en>\n A  <b>title</b>\n</TITLE><a class=x\n href='one'>first</a>"
            "<A HREF=two data-href=\"no\">se<i>co</i>nd\n one</A><a name=z>none</a>"
            "<table><tr><td>1</td></tr></table><TABLE border=1><tr><th>h</th></tr>\n<tr class=r>\n<td>a\n</td>"
            "<td id=k><b>b</b> c</td></tr></TABLE>")
    df = spark.createDataFrame([(1, page), (2, ""), (3, None)], "page_id long, html string")
    assert {r["page_id"]: r["title"] for r in H.title(df).collect()} == {1: "A title", 2: None, 3: None}
    links = [(r["href"], r["text"]) for r in H.links(df).orderBy("idx").collect()]
    assert links == [("one", "first"), ("two", "second one"), (None, "none")]
    second = H.nth_link(df, 2).where("page_id = 1").first()
    assert (second["href"], second["attrs"]) == ("two", 'HREF=two data-href="no"')
    rows = H.table_rows(df, cells=(1, 2), table=2).collect()
    assert [(r["row"], r["cell_1"], r["cell_2"]) for r in rows] == [(1, "a", "b c")]
