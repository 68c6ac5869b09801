import os
import subprocess
import sys

from helpers import rows
from pyspark import cloudpickle

from tradeflow.sources import html
from tradeflow.sources.html import cell_columns, html_table

PAGE = """
<html><head><style>table {x: y}</style><script>var t = "<table>";</script></head><body>
<table></table>
<table style="display: none"><tr><td>hidden</td></tr></table>
<table><tr><th>Symbol</th></tr><tr><td>decoy</td></tr></table>
<table class="wikitable">
  <thead><tr><th>Symbol</th><th>GICS <b>Sector</b></th><th>Symbol</th></tr></thead>
  <tbody>
    <tr><td><a href="#">A&amp;B</a></td><td>  Health
        Care </td><td>x</td></tr>
    <tr><td>SHORT</td></tr>
    <tr><td>EMPTY</td><td></td><td>y</td></tr>
    <tr><td rowspan=2>SPAN</td><td>one</td><td>p</td></tr>
    <tr><td>two</td><td>q</td></tr>
    <tr><td colspan="2">WIDE</td><td>r</td></tr>
    <tr><td>LONG</td><td>s</td><td>t</td><td>beyond</td></tr>
    <tr><td>NEST<table><tr><td>inner</td></tr></table></td><td>u</td><td>v</td></tr>
  </tbody>
</table>
</body></html>
"""

EXPECTED = [
    {"Symbol": "A&B", "GICS Sector": "Health Care", "Symbol.1": "x"},
    {"Symbol": "SHORT"},
    {"Symbol": "EMPTY", "Symbol.1": "y"},
    {"Symbol": "SPAN", "GICS Sector": "one", "Symbol.1": "p"},
    {"Symbol": "SPAN", "GICS Sector": "two", "Symbol.1": "q"},
    {"Symbol": "WIDE", "GICS Sector": "WIDE", "Symbol.1": "r"},
    {"Symbol": "LONG", "GICS Sector": "s", "Symbol.1": "t", "3": "beyond"},
    {"Symbol": "NESTinner", "GICS Sector": "u", "Symbol.1": "v"},
]


def read(spark, page, **how):
    pages = spark.createDataFrame([("id", page)], "url string, html string")
    out = html_table(pages, "html", "url", **how)
    return [r.cells for r in sorted(out.collect(), key=lambda r: r.row_no)]


def test_table_by_position(spark):
    assert read(spark, PAGE, index=1) == EXPECTED
    assert read(spark, PAGE, index=0) == [{"Symbol": "decoy"}]
    assert read(spark, PAGE, index=2) == [{"0": "inner"}]
    assert read(spark, PAGE, index=3) == []


def test_table_by_header(spark):
    assert read(spark, PAGE, index=None, columns=("GICS Sector",)) == EXPECTED
    assert read(spark, PAGE, index=None, columns=("Nothing",)) == []


def test_header_without_thead(spark):
    page = "<table><tr><th>a<th>b<tr><th>1<td>2<tr><td>3<td>4</table>"
    assert read(spark, page) == [{"a": "1", "b": "2"}, {"a": "3", "b": "4"}]


def test_no_header_and_no_table(spark):
    assert read(spark, "<table><tr><td>1</td><td>2</td></tr></table>") == [{"0": "1", "1": "2"}]
    assert read(spark, "<p>text") == []
    assert read(spark, None) == []


def test_many_pages_and_long_tables(spark):
    pages = spark.range(0, 40, 1, 4).selectExpr(
        "id",
        "concat('<table><tr><th>n</th></tr>', array_join(transform(sequence(1, 600), "
        "i -> concat('<tr><td>', id, '-', i, '</td></tr>')), ''), '</table>') html",
    )
    out = html_table(pages, "html", "id")
    assert out.count() == 40 * 600
    assert out.select("id", "row_no").distinct().count() == 40 * 600
    assert rows(cell_columns(out.filter("id = 7 and row_no = 599"), "n", "none")) == [
        ("7-600", None)
    ]


def test_page_reader_needs_no_package_on_the_executors(tmp_path):
    pickled = cloudpickle.dumps((html._rows, PAGE))
    script = (
        "import pickle, sys; f, page = pickle.load(open(sys.argv[1], 'rb')); "
        "assert 'tradeflow' not in sys.modules; print(len(list(f(page, 1, ()))))"
    )
    (tmp_path / "job").write_bytes(pickled)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", script, str(tmp_path / "job")],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120,
    )
    assert out.stdout.strip() == str(len(EXPECTED)), out.stderr


def test_a_span_beyond_all_rows(spark):
    page = "<table><tr><th>A</th><th>B</th></tr><tr><td rowspan=70000>x</td><td>0</td></tr>"
    page += "".join(f"<tr><td>{i}</td></tr>" for i in range(1, 66000)) + "</table>"
    out = html_table(spark.createDataFrame([(1, page)], "id int, html string"), "html", "id")
    assert out.filter("cells['A'] = 'x'").count() == 66000


def test_a_very_wide_span(spark):
    page = f"<table><tr><th>A</th><th>B</th></tr><tr><td colspan={10**30}>x</td></tr></table>"
    out = html_table(spark.createDataFrame([(1, page)], "id int, html string"), "html", "id")
    assert out.first()["cells"] == {"A": "x", "B": "x"}


def test_spans_of_any_width_keep_the_columns_in_place(spark):
    for width in (10_000, 10_001, 20_000):
        page = f"<table><tr><th>A</th></tr><tr><td colspan={width}>x</td><td>y</td></tr></table>"
        (cells,) = read(spark, page)
        assert len(cells) == width + 1 and cells["A"] == "x" and cells[str(width - 1)] == "x"
        assert cells[str(width)] == "y"
    page = f"<table><tr><td colspan={10**9} rowspan=2>x</td><td>y</td></tr><tr><td>z</td></tr></table>"
    assert read(spark, page) == [{"0": "x", str(10**9): "y"}, {"0": "x", str(10**9): "z"}]


def test_spans_that_cross(spark):
    page = (
        "<table><tr><th>a</th><th>b</th><th>c</th><th>d</th></tr>"
        "<tr><td>1</td><td rowspan=3>2</td><td rowspan=2>3</td><td>4</td></tr>"
        "<tr><td>5</td><td>6</td></tr><tr><td colspan=3>7</td><td>8</td></tr><tr><td>9</td></tr></table>"
    )
    assert read(spark, page) == [
        {"a": "1", "b": "2", "c": "3", "d": "4"}, {"a": "5", "b": "2", "c": "3", "d": "6"},
        {"a": "7", "b": "7", "c": "7", "d": "8"}, {"a": "9"},
    ]
