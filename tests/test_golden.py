"""Golden rows of the extractors."""

import pytest
from pyspark.sql import functions as F

from filmweave.functions import details, fixed, infobox, pages, text

GOLDEN = [
    (infobox.clean_title, "Alpha (film)", "Alpha"),
    (infobox.clean_title, "Beta", "Beta"),
    (infobox.clean_title, " A (b) C (d\ne)\xa0", "A  C"),
    (infobox.infobox_directors, "director       = [[Ann Lee|Lee]]<br>[[Bo Ray]]\n", ["Ann Lee"]),
    (infobox.infobox_directors, "director = [[Ann Lee]]<br>[[Bo Ray]]\n", ["Ann Lee", "Bo Ray"]),
    (infobox.infobox_directors, "director =\n| producer = [[P Q]]\n", [""]),
    (infobox.infobox_directors, "no such line", ["not found"]),
    (infobox.infobox_directors, None, ["not found"]),
    (infobox.infobox_directors, "director = {{plainlist|\n* [[A]]", ["{{plainlist"]),
    (infobox.infobox_directors, "director = A (b); C\r\n| director = D\n", ["A", "C"]),
    (infobox.infobox_music, "| music = {{plainlist|\n* [[Cy Dow]]\n* [[Di Fox]]\n}}", ["Cy Dow, Di Fox"]),
    (infobox.infobox_music, "| music = {{plainlist|\n* A; B\n}}", ["A; B", "A; B"]),
    (infobox.infobox_music, "| music = [[Ed Gee]]", ["Ed Gee"]),
    (infobox.infobox_music, "| music = [[A|a]] and [[B]]", ["A|a]] and [[B"]),
    (infobox.infobox_music, "| music = [[]]", [""]),
    (infobox.infobox_music, "| music = Ed Gee", ["not found"]),
    (infobox.infobox_release_year, "released = {{Film date|2007|4|6}}", "2007"),
    (infobox.infobox_release_year, "released = 4 May 1999", "1999"),
    (infobox.infobox_release_year, "released = 14 May 1999", "not found"),
    (infobox.infobox_release_year, "released = {{Film date|2007}}", "2007"),
    (infobox.infobox_release_year, "released = |2007", "2007"),
    (infobox.infobox_release_year, "released = {{Film date|df=yes|2011|1|2}}", "not found"),
    (infobox.is_film, "Infobox film mention only", False),
    (infobox.is_film, "{{Infobox film\n| director = x", True),
    (infobox.is_film, "{{infobox film|", False),
    (pages.is_title_url, "https://www.imdb.com/title/tt1/", True),
    (pages.is_title_url, "https://www.imdb.com/title/tt1/reviews", False),
    (pages.is_title_url, "https://www.imdb.com/name/nm1/", False),
    (pages.page_title, "<title>Alpha  (2001) - IMDb</title>", "Alpha"),
    (pages.page_title, "<title>(2001) - IMDb</title>", ""),
    (pages.page_title, "<title>Alpha - IMDb</title>", None),
    (pages.page_director, "x Directed by A B, C D. With E F y", "A B, C D"),
    (pages.page_director, "(TV Series 2001) Directed by X. With Y Created by G H. With Z", "G H"),
    (pages.page_director, "neither", "more"),
    (pages.placeholder_director, "a {directorsOrCreatorsString} b", "more"),
    (pages.page_cast, 'x "cast":{"edges":[' + "".join(
        f'{{"nameText":{{"text":"{n}","__typename":"NameText"}}' for n in "ABC") + '\n{"nameText":{"text":"D","__typename":"NameText"}',
     ["A", "B"]),
    (pages.page_cast, "none", []),
    (text.clean_text, "Conan O&#x27;Brien  &quot;X&quot; ", "Conan O'Brien \"X\""),
    (text.split_directors, "A B, C D", ["A B", "C D"]),
    (text.parse_list_text, "['Ann Lee', 'Bo Ray']", ["Ann Lee", "Bo Ray"]),
    (text.parse_list_text, "", [""]),
    (text.parse_list_text, '["Conan O\'Brien"]', ['"Conan O\'Brien"']),
    (text.parse_list_text, None, []),
    (text.strip_blank_lines, "a \n\n \t\n b\x0b\r\nc ", "a\n b\nc"),
    (pages.relative_links, 'href="/title/tt1/" href="/name/nm1/" href="/title/tt1/"',
     ["https://www.imdb.com/title/tt1/", "https://www.imdb.com/name/nm1/"]),
    (pages.absolute_links, '<a class="x" href="https://imdb.com/a?b"> <a href=\'http://www.imdb.com/\'> <a href="https://x.org/">',
     ["https://imdb.com/a?b", "http://www.imdb.com/"]),
    (pages.dump_links, "x https://en.w.org/wiki/A_B, y https://en", ["https://en.w.org/wiki/A_B", "https://en"]),
    (pages.url_scheme_default, "//a.org/b", "https://a.org/b"),
    (pages.url_scheme_default, "http://a.org/b", "http://a.org/b"),
    (pages.page_text, "<p>a &amp;lt; <!-- <b> --><script>x<y</script>b</p> 1 < 2", "a &lt; b 1 < 2"),
    (lambda c: details.wiki_links(c, F.lit("https://e.org/wiki/B"), F.lit("A")), '<A href="/wiki/A_(x)">t</a><a href="/wiki/C">t</a>',
     ["https://e.org/wiki/B", "https://e.org/wiki/A_%28x%29"]),
    (details.detail_release, "<tr><th><div>Release date</div></th><td><li>4 May <b>1999</b></li><li>x</li></td></tr>", "4 May 1999"),
    (details.detail_release, "<tr><th>Release date</th><td>4 May</td></tr><tr><td><li>x</li></td></tr>", None),
    (details.detail_release, "<tr><th>Released</th><td><li>x</li></td></tr>", None),
    (details.detail_writers, "<tr><th>Story by</th><td><li>A</li><li>B</li><li>A</li></td></tr>", ["A", "B"]),
    (details.detail_writers, "<tr><th>Written by</th><td>A</td><td>B &amp; C</td></tr>", ["A", "B & C"]),
    (details.detail_writers, "none", []),
    (details.detail_composer, '<th>Music by</th><td><a href="m">Mo</a></td><th class="x">Produced by', "Mo"),
    (details.detail_composer, '<th>Music by</th><td><a href="m">Mo</a></td><th>Starring', None),
    (details.detail_directors, '<th>Created by</th><td class="x"><a href="c">Cy</a></td>', ["Cy"]),
    (details.detail_directors, "Created by <ul><li><a>A</a><a>B</a></ul>", ["A", "B"]),
    (details.detail_directors, '<th>Directed by</th><td class="x"><a href="d">Di</a></td>', ["Di"]),
    (details.detail_directors, "Directed by <ul><li><a>A</a></ul>", ["A"]),
    (details.detail_directors, "none", None),
]


def test_golden(spark):
    """All rows in one job: each expression over its own literal."""
    columns = [run(F.lit(given).cast("string")).alias(f"c{i}") for i, (run, given, _) in enumerate(GOLDEN)]
    row = spark.range(1).select(*columns).first()
    wrong = [(i, given, row[i], expected) for i, (_, given, expected) in enumerate(GOLDEN) if row[i] != expected]
    assert not wrong


def test_cast_whole(value):
    line = '"cast":{"edges":[{"nameText":{"text":"A","__typename":"NameText"}'
    assert value(lambda c: pages.page_cast(c, drop_last=False), line) == ["A"]
    assert value(pages.page_cast, line) == []


def test_restricted_words_each_count(spark):
    urls = [(fixed.TITLE_PREFIX + "tt1/" + word,) for word in fixed.RESTRICTED_WORDS]
    df = spark.createDataFrame(urls, "url string")
    assert len(urls) == 31
    assert df.filter(pages.is_title_url(F.col("url"))).count() == 0


@pytest.mark.parametrize("words", [20000])
def test_long_dotted_token(value, words):
    from filmweave.operators.search import tokens

    dotted = ".".join(["ab"] * words)
    assert value(tokens, dotted + " x the End") == [dotted, "end"]
