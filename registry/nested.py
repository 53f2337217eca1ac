"""Nested markup: fields of boxes with templates in templates, and rows of pages with tables in tables.

The SQL finds depths by running sums over the pieces of a text, one row to a piece.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from filmweave.functions import fixed, folds
from filmweave.functions.text import split_directors
from filmweave.operators.linking import enrich, link_catalogue
from filmweave.plans.linkage import detail_records, extract_infobox

from . import inputs
from .checks import Checks
from .sqltext import group, joined, lit, strip, sub, text_of

CHECKS = Checks()

# Boxes with nested, numbered, broken and unclosed values, before real text; remainders choose a layout.
NESTED_BOXES = """
SELECT d.k * 100000 + d.s AS id, concat(p.p_name, ' ', CAST(d.k AS STRING), ' (film)') AS title, replace(concat(
    'About {{other|x=y}}NL{{Infobox film <!-- old {{ | -->NL| name = ', p.p_name, ' {{small|(a|', p.p_brand, ')}}NL',
    CASE (d.k + d.s) % 6
      WHEN 0 THEN concat('| director = {{Plainlist|NL* [[Zoë ', s.s_name, '|Zoë]]{{efn|see {{cite|title=x|url=y}}}}NL* ', p.p_brand,
                         ' Unit (lead)NL}}NL')
      WHEN 1 THEN concat('| director = {{ubl|[[', s.s_name, ']]|2=', p.p_brand, '|{{nowrap|Fay}} Gray}}NL')
      WHEN 2 THEN concat('|director=[[', s.s_name, ' (person)|S]]<br />', p.p_brand, '; JoNL')
      WHEN 3 THEN concat('| director = {{unbulleted_list|NL| [[', s.s_name, ']]|{{nowrap|{{lang|fr|x}}}}}}NL')
      WHEN 4 THEN concat('| director = ', s.s_name, 'NL| director = [[', p.p_brand, ' | unit]] lastNL') ELSE '| director =NL' END,
    CASE (3 * d.k + d.s) % 4 WHEN 0 THEN '| starring = [[Open link | nextNL'
      WHEN 1 THEN concat('| starring = {a} [b] {{{c}}} | lost | =nothingNL') ELSE '' END,
    CASE (d.k + 2 * d.s) % 3 WHEN 0 THEN concat('| released = {{Film date|', CAST(1950 + d.k % 70 AS STRING), '|4|{{abbr|6}}}}NL')
      ELSE '' END,
    CASE (d.k + d.s) % 5 WHEN 0 THEN '| music = {{hlist|A|[[B|b]]' ELSE '}}NLAfter {{Other|director = no}} end.' END), 'NL', chr(10)) AS txt
FROM (SELECT DISTINCT l_partkey AS k, l_suppkey AS s FROM lineitem) d
JOIN part p ON p.p_partkey = d.k JOIN supplier s ON s.s_suppkey = d.s
"""

# Pages whose info tables hold tables and lists in cells, unclosed items and rows, and comments.
NESTED_DETAILS = """
SELECT g.page_id AS id, concat('<p>x</p><table class="i"><tr><th>Title</th><td>T</td></tr><tr><th><b>Written by</b></th>',
    CASE g.page_id % 4
      WHEN 0 THEN concat('<td><table><tr><td>in</td></tr></table><ul><li>Ann <b>', CAST(g.page_id AS STRING),
                         '</b><li>Bo<ul><li>as B</li></ul></li><li> </li><li>Bo<ul><li>as B</li></ul></li></ul></td></tr>')
      WHEN 1 THEN '<td>Cy <!-- </tr> --> Roe</td><td><table><tr><th>h</th><td>Di</td></tr></table></td></tr>'
      WHEN 2 THEN '<td>Ed<tr><th>Directed by</th><td><ol><li>Fay<li>Gil</ol></td></tr>' ELSE '</tr>' END,
    CASE g.page_id % 3 WHEN 0 THEN concat('<TR><TH>Directed by</TH><TD><TABLE><TR><TD>Hal</TD><TD>', CAST(g.page_id AS STRING),
                                          '</TD></TR></TABLE></TD></TR>')
      WHEN 1 THEN '<tr><th>Created by</th><td>Ida &amp; Jo</td></tr>' ELSE '' END,
    '<tr><th>Release date</th><td><ul><li>', CAST(1950 + g.page_id % 70 AS STRING), ' <span>(US)</span></li><li>x</ul></td>',
    '</table>', g.html) AS html
FROM pages g
"""


def _one_of(kinds) -> str:
    return ", ".join("chr(10)" if k == "\n" else lit(k) for k in kinds)


def _pieces(source: str, piece: str, mark: str, up=(), down=()) -> str:
    """Rows ``id, i, p, m, before, after, total, depth, was`` of the pieces of ``source`` (id, txt): place, mark, depth after and before."""
    delta = f"CASE WHEN m IN ({_one_of(up)}) THEN 1 WHEN m IN ({_one_of(down)}) THEN -1 ELSE 0 END"
    whole = "PARTITION BY id ORDER BY i"
    return f"""SELECT *, coalesce(lag(depth) OVER ({whole}), 0) AS was FROM (
  SELECT *, after - length(mk) AS before, s - least(0, min(s) OVER ({whole})) AS depth FROM (
    SELECT *, sum(length(p)) OVER ({whole}) AS after, sum({delta}) OVER ({whole}) AS s FROM (
      SELECT id, i, p, total, regexp_extract(p, {lit(mark)}) AS mk, lower(regexp_extract(p, {lit(mark)}, 1)) AS m FROM (
        SELECT id, length(txt) AS total, unnest(l) AS p, generate_subscripts(l, 1) AS i FROM (
          SELECT id, txt, regexp_extract_all(txt, {lit(piece)}) AS l FROM ({source}) src)))))"""


def _segments(source: str, events: str) -> str:
    """Rows ``id, i, txt``: from each event that opens a segment to the next event. ``events``: id, i, before, after, opens."""
    return f"""SELECT e.id, e.i, substring(src.txt, CAST(e.after AS BIGINT) + 1, CAST(coalesce(e.next, length(src.txt)) - e.after AS BIGINT)) AS txt
FROM (SELECT *, lead(before) OVER (PARTITION BY id ORDER BY i) AS next FROM ({events}) v) e JOIN ({source}) src ON src.id = e.id WHERE e.opens"""


def _parts(source: str) -> str:
    """Parts of the templates that the texts of ``source`` start with."""
    pieces = _pieces(source, fixed.TEMPLATE_PIECE, fixed.TEMPLATE_MARK, ("{{",), ("}}",))
    link = "CASE m WHEN '[[' THEN 1 WHEN ']]' THEN -1 ELSE 0 END"
    events = f"""SELECT id, i, before, after, m <> '}}}}' AS opens FROM (
  SELECT *, ls - least(0, min(ls) OVER (PARTITION BY id, line ORDER BY i)) AS links FROM (
    SELECT *, sum({link}) OVER (PARTITION BY id, line ORDER BY i) AS ls FROM (
      SELECT *, sum(CASE WHEN m = chr(10) THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY i) - CASE WHEN m = chr(10) THEN 1 ELSE 0 END AS line,
             coalesce(sum(CASE WHEN m = '}}}}' AND was = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended
      FROM ({pieces}) q)))
WHERE ended = 0 AND ((m = '{{{{' AND was = 0) OR (m = '}}}}' AND was = 1) OR (m = '|' AND was = 1 AND links = 0))"""
    return _segments(source, events)


def _outside(source: str) -> str:
    """``id, txt``: the texts of ``source`` without their templates."""
    pieces = _pieces(source, fixed.TEMPLATE_PIECE, fixed.TEMPLATE_MARK, ("{{",), ("}}",))
    kept = "CASE WHEN was > 0 THEN '' WHEN m = '{{' THEN left(p, length(p) - 2) ELSE p END"
    return f"SELECT id, string_agg({kept}, '' ORDER BY i) AS txt FROM ({pieces}) q GROUP BY id"


_BOX = f"SELECT id, regexp_extract({sub('txt', fixed.COMMENT)}, {lit(fixed.FILM_BOX + '[\\s\\S]*')}) AS txt FROM ({NESTED_BOXES}) n"
# The first part of each template is its name.
_FIELDS = f"""SELECT id, key, value FROM (
  SELECT id, i, {strip("string_split(txt, '=')[1]")} AS key, {strip("substring(txt, position('=' IN txt) + 1)")} AS value
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY i) AS nth FROM ({_parts("SELECT * FROM box")}) p) q
  WHERE nth > 1 AND contains(txt, '=')) e
WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY id, key ORDER BY i DESC) = 1"""


def _boxes(spark, sf_dir):
    return inputs.load(spark, sf_dir, NESTED_BOXES)


CHECKS.add(
    "infobox_fields",
    lambda spark, sf_dir: _boxes(spark, sf_dir).select("id", F.explode(folds.infobox_fields(F.col("txt")))),
    f"WITH box AS MATERIALIZED ({_BOX}) {_FIELDS}",
)

_LISTS = ", ".join(lit(n) for n in fixed.LIST_TEMPLATES)


def _names(field: str) -> str:
    """CTEs up to ``{field}_names`` (id, names): the names in a field of ``box``, joined."""
    listed = _parts(f"SELECT * FROM {field}_field WHERE starts_with(txt, '{{{{')")
    bare = sub(sub(sub("o.txt", fixed.LINK_TARGET, chr(92) + "1"), fixed.BRACKETED), r"\[\[|\]\]")
    return f"""{field}_field AS MATERIALIZED (SELECT id, value AS txt FROM field WHERE key = '{field}'),
  {field}_listed AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY i) AS nth FROM ({listed}) p),
  {field}_body AS (SELECT id, string_agg({sub("txt", fixed.NUMBERED_ARGUMENT)}, chr(10) || '*' ORDER BY i) AS txt FROM {field}_listed WHERE nth > 1
    AND id IN (SELECT id FROM {field}_listed WHERE nth = 1 AND lower(replace({strip("txt")}, '_', ' ')) IN ({_LISTS})) GROUP BY id),
  {field}_whole AS (SELECT f.id, coalesce(b.txt, f.txt) AS txt FROM {field}_field f LEFT JOIN {field}_body b ON b.id = f.id),
  {field}_item AS MATERIALIZED (SELECT id AS box_id, j, id * 100 + j AS id, txt FROM (SELECT id, unnest(l) AS txt, generate_subscripts(l, 1) AS j
    FROM (SELECT id, regexp_split_to_array(txt, {lit(fixed.ITEM_BREAK)}) AS l FROM {field}_whole) s) t),
  {field}_names AS (SELECT id, string_agg(name, '|' ORDER BY j) AS names FROM (SELECT i.box_id AS id, i.j, {strip(bare)} AS name
    FROM {field}_item i JOIN ({_outside(f"SELECT id, txt FROM {field}_item")}) o ON o.id = i.id) n WHERE name <> '' GROUP BY id)"""


_BOXES = f"box AS MATERIALIZED ({_BOX}), field AS MATERIALIZED ({_FIELDS})"
CHECKS.add(
    "infobox_names",
    lambda spark, sf_dir: _boxes(spark, sf_dir).select(
        "id", F.array_join(folds.infobox_names(F.col("txt"), "director"), "|").alias("names")
    ),
    f"""WITH {_BOXES}, {_names("director")} SELECT b.id, coalesce(n.names, 'not found') AS names FROM box b
LEFT JOIN director_names n ON n.id = b.id""",
)

_NESTED_WIKI = f"""WITH boxes AS MATERIALIZED ({NESTED_BOXES}), {_BOXES}, {_names("director")}, {_names("music")}
SELECT {strip(sub("b.title", fixed.BRACKETED))} AS title_wiki, string_split(coalesce(d.names, 'not found'), '|') AS director_wiki,
  string_split(coalesce(m.names, 'not found'), '|') AS music, coalesce({group("r.value", fixed.YEAR)}, 'not found') AS release
FROM boxes b LEFT JOIN director_names d ON d.id = b.id LEFT JOIN music_names m ON m.id = b.id
LEFT JOIN (SELECT id, value FROM field WHERE key = 'released') r ON r.id = b.id"""


def _nested_wiki(spark, sf_dir):
    return extract_infobox(_boxes(spark, sf_dir), "txt", nested=True)


def _flat(df):
    lists = ("director_list", "director_wiki", "music")
    return df.select(*[F.array_join(c, "|").alias(c) if c in lists else F.col(c) for c in df.columns])


CHECKS.add(
    "extract_infobox_nested",
    lambda spark, sf_dir: _flat(_nested_wiki(spark, sf_dir)),
    f"SELECT title_wiki, {joined('director_wiki')} AS director_wiki, {joined('music')} AS music, release FROM ({_NESTED_WIKI}) w",
)

# A catalogue whose directors stand in boxes of several layouts, or are unknown.
_FILMS = """SELECT concat(p_name, ' ', CAST(p_partkey AS STRING)) AS title, CASE WHEN p_partkey % 5 = 0 THEN 'more'
  ELSE concat(p_brand, ' Unit, ', 'Zoë ', s_name, ', ', s_name) END AS director
FROM part JOIN supplier ON s_suppkey = (p_partkey * 7) % 10 + 1"""


def _link_nested(spark, sf_dir):
    films = inputs.load(spark, sf_dir, _FILMS)
    films = films.select("title", split_directors(F.col("director")).alias("director_list"))
    return _flat(link_catalogue(films, _nested_wiki(spark, sf_dir)))


CHECKS.add(
    "link_catalogue_nested",
    _link_nested,
    f"""WITH w AS MATERIALIZED ({_NESTED_WIKI}), c AS (SELECT title, string_split(director, ', ') AS director_list FROM ({_FILMS}) f)
SELECT title, {joined("director_list")} AS director_list, title_wiki, {joined("director_wiki")} AS director_wiki, {joined("music")} AS music, release
FROM c LEFT JOIN w ON c.title = w.title_wiki AND (list_has_any(c.director_list, w.director_wiki) OR list_contains(c.director_list, 'more'))""",
)


def _row_texts(name: str, headers: tuple[str, ...]) -> str:
    """CTEs up to ``{name}`` (id, texts): texts of a row's items, or of its cells."""
    head = rf"(?i:<th\b[^>]*>)(?:<[^>]*>)*(?:{'|'.join(headers)})(?:</[^>]*>)*(?i:</th>)"
    rest = f"SELECT id, regexp_extract({sub('html', fixed.COMMENT)}, {lit(head + '[\\s\\S]*')}) AS txt FROM page"
    rows = _pieces(f"SELECT * FROM {name}_rest", fixed.ROW_PIECE, fixed.ROW_MARK, ("table",), ("/table",))
    items = _pieces(f"SELECT * FROM {name}_row", fixed.ITEM_PIECE, fixed.ITEM_MARK, ("ul", "ol"), ("/ul", "/ol"))
    item_events = f"SELECT id, i, before, after, m = 'li' AS opens FROM ({items}) q WHERE was <= 1 AND m IN ('li', '/li', '/ul', '/ol')"
    cells = _pieces(f"SELECT * FROM {name}_row", fixed.CELL_PIECE, fixed.CELL_MARK, ("table",), ("/table",))
    cell_events = f"SELECT id, i, before, after, m = 'td' AS opens FROM ({cells}) q WHERE was = 0 AND m IN ('td', '/td', 'th', '/th')"
    shown = strip(sub(text_of("txt"), f"[{fixed.WS}]+", " "))
    return f"""{name}_rest AS MATERIALIZED (SELECT * FROM ({rest}) r WHERE txt <> ''),
  {name}_end AS (SELECT id, min(before) AS at FROM ({rows}) q WHERE was = 0 AND m IN ('/tr', 'tr', '/table') GROUP BY id),
  {name}_row AS MATERIALIZED (SELECT r.id, left(r.txt, CAST(coalesce(e.at, length(r.txt)) AS BIGINT)) AS txt FROM {name}_rest r LEFT JOIN {name}_end e ON e.id = r.id),
  {name}_items AS MATERIALIZED ({_segments(f"SELECT * FROM {name}_row", item_events)}),
  {name}_cells AS ({_segments(f"SELECT * FROM {name}_row", cell_events)}),
  {name}_texts AS (SELECT id, i, {shown} AS txt FROM (SELECT * FROM {name}_items
    UNION ALL SELECT * FROM {name}_cells WHERE id NOT IN (SELECT id FROM {name}_items)) u),
  {name} AS (SELECT r.id, coalesce(t.texts, '') AS texts FROM {name}_row r LEFT JOIN (SELECT id, string_agg(txt, '|' ORDER BY i) AS texts FROM
    (SELECT id, txt, min(i) AS i FROM {name}_texts WHERE txt <> '' GROUP BY id, txt) g GROUP BY id) t ON t.id = r.id)"""


def _detail_rows(spark, sf_dir):
    found = inputs.load(spark, sf_dir, NESTED_DETAILS).select("id", folds.detail_fields(F.col("html")).alias("f"))
    return found.select(
        "id", "f.release", F.array_join("f.writers", "|").alias("writers"), F.array_join("f.directors", "|").alias("directors")
    )


CHECKS.add(
    "detail_rows",
    _detail_rows,
    f"""WITH page AS MATERIALIZED ({NESTED_DETAILS}), {_row_texts("released", fixed.RELEASE_HEADERS)},
  {_row_texts("writers", fixed.WRITER_HEADERS)}, {_row_texts("creators", fixed.CREATOR_HEADERS)}, {_row_texts("directors", fixed.DIRECTOR_HEADERS)}
SELECT p.id, nullif(string_split(r.texts, '|')[1], '') AS release, w.texts AS writers, coalesce(c.texts, d.texts) AS directors
FROM page p LEFT JOIN released r ON r.id = p.id LEFT JOIN writers w ON w.id = p.id LEFT JOIN creators c ON c.id = p.id
LEFT JOIN directors d ON d.id = p.id""",
)


# Catalogue rows of the pages, half of them with unknown directors, to be enriched from nested rows.
_TO_ENRICH = "SELECT page_id AS k, url AS title, CASE page_id % 2 WHEN 0 THEN 'more' ELSE 'Own, Other' END AS director FROM pages"


def _enrich_nested(spark, sf_dir):
    films = inputs.load(spark, sf_dir, _TO_ENRICH).select("k", "title", split_directors(F.col("director")).alias("director_list"))
    records = detail_records(inputs.load(spark, sf_dir, NESTED_DETAILS).withColumnRenamed("id", "k"), "k", nested=True)
    rows = enrich(films, records, "k")
    return rows.select(
        "k", "title", F.array_join("director_list", "|").alias("director_list"), "release", F.array_join("writer", "|").alias("writer")
    )


CHECKS.add(
    "enrich_nested",
    _enrich_nested,
    f"""WITH f AS ({_TO_ENRICH}), d AS MATERIALIZED ({CHECKS.oracles["detail_rows"]})
SELECT f.k, f.title, CASE WHEN f.director = 'more' AND d.directors IS NOT NULL THEN d.directors ELSE replace(f.director, ', ', '|') END AS director_list,
  d.release, coalesce(d.writers, '') AS writer FROM f LEFT JOIN d ON d.id = f.k""",
)
