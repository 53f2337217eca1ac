"""Nested markup: templates in templates, pipes in links, tables in cells, lists in items, and what isn't closed."""

import random

import pytest
from pyspark.sql import functions as F

from filmweave.functions import fixed, folds

BOX = """Lead text.
{{Infobox film <!-- a | comment }} -->
| name = Ghost {{small|(a|b)}}
| director = {{Plainlist|
* [[Ann Lee|Ann]]{{efn|see {{cite|title=x|url=y}}}}
* Bo (director)
*  [[Cy]]
}}
| writer = {{ubl|[[Di Roe|Di]]|2=Ed|{{nowrap|Fay}} Gray}}
| music=[[Hal (composer)|Hal]]<br />Ida; Jo
| starring = [[Open link | next
| released = {{Film date|1984|6|8}}
| name = Last
| empty =
| =nothing
| positional
}}
After {{Other|director = no}} end."""


def test_fields_of_a_nested_box(value):
    fields = value(folds.infobox_fields, BOX)
    assert fields == {
        "director": "{{Plainlist|\n* [[Ann Lee|Ann]]{{efn|see {{cite|title=x|url=y}}}}\n* Bo (director)\n*  [[Cy]]\n}}",
        "writer": "{{ubl|[[Di Roe|Di]]|2=Ed|{{nowrap|Fay}} Gray}}",
        "music": "[[Hal (composer)|Hal]]<br />Ida; Jo",
        "starring": "[[Open link | next",
        "released": "{{Film date|1984|6|8}}",
        "name": "Last",
        "empty": "",
    }


@pytest.mark.parametrize(
    ("field", "names"),
    [("director", ["Ann Lee", "Bo", "Cy"]), ("writer", ["Di Roe", "Ed", "Gray"]), ("music", ["Hal", "Ida", "Jo"]), ("empty", ["not found"]), ("none", ["not found"])],
)
def test_names_of_a_field(value, field, names):
    assert value(lambda c: folds.infobox_names(c, field), BOX) == names


def test_boxes_that_are_none_or_do_not_end(value):
    assert value(folds.infobox_fields, "{{Infobox book|a=b}}") is None
    assert value(folds.infobox_fields, None) is None
    assert value(folds.infobox_fields, "") is None
    assert value(folds.infobox_fields, "{{Infobox film|a=b|c={{d|e=f") == {"a": "b", "c": "{{d|e=f"}
    assert value(folds.infobox_fields, "{{Infobox film|") == {}
    assert value(folds.infobox_fields, "}} {{Infobox film|a=b}}}} {{Infobox film|a=c}}") == {"a": "b"}


def test_text_outside_templates(value):
    assert value(folds.outside_templates, "a{{b{{c}}d}}e}}f{{g") == "ae}}f"
    assert value(folds.outside_templates, "") == "" and value(folds.outside_templates, None) is None


def parts_of(text):
    """Parts of the template at the start of a text, character by character."""
    out, depth, links, since, i = [], 0, 0, None, 0
    while i < len(text):
        two = text[i : i + 2]
        if two == "{{":
            depth += 1
            if depth == 1:
                since = i + 2
        elif two == "}}":
            depth -= 1
            if depth == 0:
                return [*out, text[since:i]]
        elif two == "[[":
            links += 1
        elif two == "]]":
            links = max(0, links - 1)
        else:
            two = text[i]
            if two == "\n":
                links = 0
            elif two == "|" and depth == 1 and links == 0:
                out.append(text[since:i])
                since = i + 1
        i += len(two)
    return [*out, text[since:]]


def test_parts_against_a_plain_reading(spark):
    rng = random.Random(1)
    texts = ["{{" + "".join(rng.choices(["{{", "}}", "[[", "]]", "|", "\n", "{", "}", "[", "é", "bc"], k=rng.randint(0, 30))) for _ in range(800)]
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r["p"] for r in rows.select(folds.template_parts(F.col("x")).alias("p")).collect()]
    assert got == [parts_of(t) for t in texts]


PAGE = """<table class="infobox"><tr><th>Title</th><td>T</td></tr>
<tr><th><b>Written by</b></th><td><table><tr><td>inner</td></tr></table><ul><li>Ann <b>Lee</b><li>Bo<ul><li>as B</li></ul></li><li> </li><li>Cy</ul></td></tr>
<tr><th>Directed by</th><td><table><tr><td>Di</td><td>Ed</td></tr></table></td><td>Fay <!-- </tr> --> Gray</td></tr>
<TR><TH>Music by</TH><TD>Hal<tr><th>Release date</th><td><ol><li>1984 <span>(US)</span></li><li>x</ol></td></table><li>after</li>"""


def test_rows_of_nested_tables(value):
    found = value(folds.detail_fields, PAGE)
    assert found["writers"] == ["Ann Lee", "Boas B", "Cy"]
    assert found["directors"] == ["DiEd", "Fay Gray"]
    assert found["composers"] == ["Hal"] and found["release"] == "1984 (US)"


def test_rows_that_are_missing_or_empty(value):
    assert tuple(value(folds.detail_fields, "<p>no table</p>")) == (None, None, None, None)
    assert tuple(value(folds.detail_fields, None)) == (None, None, None, None)
    found = value(folds.detail_fields, "<th>Written by</th>")
    assert found["writers"] == []
    assert value(folds.detail_fields, "<th>Created by</th><td>C</td><tr><th>Directed by</th><td>D</td>")["directors"] == ["C"]


def test_a_long_box_takes_linear_time(value):
    """Half a million marks; a fold that copied its text at each of them would not end."""
    text = "{{Infobox film|a=" + "{{b|[[c]]}}" * 100000 + "|d=e}}"
    fields = value(lambda c: F.map_values(folds.infobox_fields(c)), text)
    assert len(fields[0]) == 1100000 and fields[1] == "e"


def test_one_pattern_reads_what_the_fold_reads(spark):
    """Templates, open and closed, nested up to and beyond the pattern's depth, and links that hold templates."""
    rng = random.Random(5)
    marks = ["{{", "}}", "[[", "]]", "|", "\n", "{", "}", "[", "]", "é", "bc"]
    weights = [3, 4, 2, 3, 3, 1, 1, 1, 1, 1, 3, 3]
    texts = ["{{" * rng.randint(0, 2) + "".join(rng.choices(marks, weights, k=rng.randint(0, 25))) for _ in range(6000)]
    texts += ["{{a|" * n + "x|y" + "}}" * m + "|z" for n in range(7) for m in range(8)]
    x = F.col("x")
    rows = spark.createDataFrame([(t,) for t in texts], "x string").repartition(8)
    found = rows.select(
        "x", folds.template_parts(x).alias("parts"), folds._folded_parts(x).alias("folded"),
        folds.outside_templates(x).alias("outside"), folds._folded_outside(x).alias("folded_outside"),
        F.regexp_substr(x, F.lit(fixed.PLAIN_TEMPLATE)).isNotNull().alias("plain"),
    ).collect()
    assert [r["x"] for r in found if r["parts"] != r["folded"] or r["outside"] != r["folded_outside"]] == []
    assert 500 < sum(r["plain"] for r in found) < len(found) - 500


def test_common_boxes_take_no_fold(value):
    """Inner templates, piped links, links that end with their line and boxes that don't end are read by the pattern."""
    for text in (BOX[BOX.index("{{") :], "{{Infobox film|a=[[b|c]]|d={{e|{{f|{{g}}}}}}|h={{i|[[j", "{{a|b=[[c | d\n|e={f}}} rest"):
        box = value(lambda c: F.regexp_substr(folds.without_comments(c), F.lit(fixed.PLAIN_TEMPLATE)), text)
        assert box is not None


def test_the_rest_of_a_page_is_cut_off_at_little_cost(spark):
    physical = spark.range(1).select(folds.infobox_fields(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "(?s:.*)" in physical and r"\|[\s\S]*" not in physical
