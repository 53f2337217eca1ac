"""Sentinels, word lists, sites and regular expressions the results depend on.

The regular expressions, but for the token and whole templates, keep to the subset that Java and RE2 read alike, and never use ``.``, ``\\s``
or ``\\w``: those mean different character sets in different engines.
"""

# Sentinels for missing data. NULL is the third spelling: no join partner.
UNKNOWN = "more"  # director unknown; matches any director when linking
ABSENT = "not found"  # field not present on the page

# The Unicode whitespace characters, as a regex class body and as a set of characters to trim. Single
# characters and one category make a cheap class; ranges would each be tested in turn.
WS = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\p{Z}"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "               　"
)
LINE_BREAK = r"\r\n|[\n\x0b\f\r\x1c\x1d\x1e\x85\x{2028}\x{2029}]"

# Site of the stored pages.
SITE = "https://www.imdb.com"
SITE_HOST = "imdb.com"
TITLE_PREFIX = "https://www.imdb.com/title/"
TITLE_SUFFIX = " - IMDb"
SKIPPED_PREFIXES = ("https://apps.apple.com",)
RESTRICTED_WORDS = (
    "language=", "releaseinfo", "ratings", "fullcredits", "mediaviewer", "characters", "companycredits",
    "news", "mediaindex", "officialsites", "locations", "taglines", "plotsummary", "synopsis", "technical",
    "keywords", "parentalguide", "trivia", "goofs", "crazycredits", "quotes", "alternateversions",
    "movieconnections", "soundtracks", "soundtrack", "videogallery", "awards", "faq", "reviews",
    "externalsites", "episodes",
)
SERIES_MARK = "(TV Series "
PLACEHOLDER_DIRECTOR = "{directorsOrCreatorsString}"
ALWAYS_KEYWORD = "Star Trek"  # searched for every film, beside its directors

# Infobox markup.
FILM_MARK = "Infobox film"
FILM_BOX = rf"\{{\{{[{WS}]*Infobox[{WS}]*film[{WS}]*\|"
BRACKETED = r"\([^)]*\)"
BOX_DIRECTOR = rf"director[{WS}]+=[{WS}]+\[?\[?([^\n]*)"
BOX_MUSIC_LIST = rf"\|[{WS}]*music[{WS}]*=[{WS}]*\{{\{{plainlist\|([\s\S]*?)\}}\}}"
BOX_MUSIC_LINK = rf"music[{WS}]*=[{WS}]*\[\[([^\n]*)\]\]"
BOX_YEAR_DATED = rf"released[{WS}]*=[{WS}]*\{{\{{[a-zA-Z|{WS}]*\|(\p{{Nd}}{{4}})\|"
BOX_YEAR_PLAIN = rf"released[{WS}]*=[{WS}]*\p{{Nd}} [a-zA-Z]* (\p{{Nd}}{{4}})"
BOX_YEAR_SHORT = rf"released[{WS}]*=[{WS}]*(?:\{{\{{[a-zA-Z|{WS}]*)?\|(\p{{Nd}}{{4}})"
# Strict forms: the value on its own line or as a plain list; any date template; days of two digits.
BOX_DIRECTOR_STRICT = rf"\|[{WS}]*director[ \t]*=[ \t]*(\{{\{{(?i:plainlist)\|[\s\S]*?\}}\}}|[^\n]*)"
BOX_ITEM_BREAK = r"(?i)\{\{plainlist\||\}\}|<br */?>|\n[ \t]*\*|;"
BOX_SHOWN = r"\|[^\]\n]*"
BOX_YEAR_STRICT = rf"released[{WS}]*=[{WS}]*\{{\{{[^\n}}]*?\|(\p{{Nd}}{{4}})[|}}]"
BOX_YEAR_DAY = rf"released[{WS}]*=[{WS}]*\p{{Nd}}{{1,2}} [a-zA-Z]+ (\p{{Nd}}{{4}})"

# What follows to the end of the text. A class of all characters says the same at some hundred times the cost.
REST = r"(?s:.*)"

# The same list as BOX_MUSIC_LIST, its body up to the first closing marks read that way too.
BOX_MUSIC_BODY = rf"\|[{WS}]*music[{WS}]*=[{WS}]*\{{\{{plainlist\|((?s:.*?))\}}\}}"

# Templates read by depth: a piece of text with the mark that ends it, and that mark.
COMMENT = r"<!--[\s\S]*?-->"
TEMPLATE_PIECE = r"[^{}\[\]|\n]*(?:\{\{|\}\}|\[\[|\]\]|[{}\[\]|\n]|\z)"
TEMPLATE_MARK = r"(\{\{|\}\}|\[\[|\]\]|[{}\[\]|\n])\z"
# Whole templates in one pattern, up to three deep, with links that hold no template; possessive, so Java's alone and without
# recursion. An inner template that isn't closed ends with the text. What is nested otherwise is read mark by mark.
_LONE = r"\{(?!\{)|\}(?!\})"
_LINK = rf"\[\[(?:[^\[\]{{}}\n]++|\[(?!\[)|\](?!\])|{_LONE})*+(?:\]\]|(?=\n)|\z)"


def _nested(plain: str) -> tuple[str, str]:
    """What ``plain`` and closed templates make up within a template, and one template: closed, or open to the end of the text."""
    inner = f"(?:{plain})*+"
    for _ in range(2):
        inner = rf"(?:{plain}|\{{\{{{inner}\}}\}})*+"
    return inner, rf"\{{\{{{inner}\}}\}}|(?:\{{\{{{inner})++\z"


_LINKED = rf"[^{{}}\[]++|{_LONE}|\[(?!\[)|{_LINK}"
_ARGUMENT = rf"(?:[^{{}}\[|]++|{_LONE}|\[(?!\[)|{_LINK}|{_nested(_LINKED)[1]})*+"
PLAIN_TEMPLATE = rf"^\{{\{{{_ARGUMENT}(?:\|{_ARGUMENT})*+(?:\}}\}}|\z)"
TEMPLATE_ARGUMENT = rf"(?:^\{{\{{|(?!^)\G\|)({_ARGUMENT})"
INNER_TEMPLATE = _nested(rf"[^{{}}]++|{_LONE}")[1]
PLAIN_OUTSIDE = rf"^(?:[^{{}}]++|{_LONE}|\}}\}}|{INNER_TEMPLATE})*+\z"
LIST_TEMPLATES = ("plainlist", "plain list", "flatlist", "flat list", "hlist", "ubl", "unbulleted list")
NUMBERED_ARGUMENT = rf"^[{WS}]*\p{{Nd}}+[{WS}]*="
ITEM_BREAK = r"(?i)<br */?>|\n[ \t]*\*|;"
YEAR = r"(?:^|[^\p{Nd}])(\p{Nd}{4})(?:[^\p{Nd}]|\z)"
LINK_TARGET = r"\[\[([^\[\]|]*)\|?[^\[\]]*\]\]"

# Title pages.
DIRECTED = rf"Directed by ([^\n]*?)\.[{WS}]With"
CREATED = rf"Created by ([^\n]*?)\.[{WS}]With"
CAST_TAIL = r'"cast":\{"edges":([^\n]*)'
CAST_NAME = r'"nameText":\{"text":"([^"]+)","__typename":"NameText"'
ABSOLUTE_LINK = rf"<a[{WS}]+[^>]*?href=[\"'](https?://(?:www\.)?HOST/[^\"']*)[\"'][^>]*>"
TITLE_PATH = r"/title/[^\"']*"
NAME_PATH = r"/name/[^\"']*"

# Page text.
INVISIBLE = (
    r"(?i)<script\b[\s\S]*?</script[^>]*>|<style\b[\s\S]*?</style[^>]*>|<!--[\s\S]*?-->|</?[a-z!?][^>]*>"
)
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#x27;", "'"),
            ("&nbsp;", "\xa0"), ("&amp;", "&"))
DUMP_LINK = rf"https://en[^{WS}:,]*"
HEADING = r"(?i)<h1\b[^>]*>([\s\S]*?)</h1>"

# Detail pages of the encyclopedia.
RELEASE_HEADERS = ("Release dates", "Release", "Release date")
WRITER_HEADERS = ("Written by", "Story by")
COMPOSER_HEADERS = ("Music by",)
CREATOR_HEADERS = ("Created by",)
DIRECTOR_HEADERS = ("Directed by",)
# Rows, lists and cells read by depth: a piece of page with the tag that ends it, and that tag.
ROW_PIECE = r"[\s\S]*?(?i:</?(?:table|tr)\b[^<>]*>|\z)"
ROW_MARK = r"<(/?(?i:table|tr))\b[^<>]*>\z"
ITEM_PIECE = r"[\s\S]*?(?i:</?(?:ul|ol|li)\b[^<>]*>|\z)"
ITEM_MARK = r"<(/?(?i:ul|ol|li))\b[^<>]*>\z"
CELL_PIECE = r"[\s\S]*?(?i:</?(?:table|td|th)\b[^<>]*>|\z)"
CELL_MARK = r"<(/?(?i:table|td|th))\b[^<>]*>\z"
LIST_ITEM = r"(?i)<li\b[^>]*>([\s\S]*?)</li>"
TABLE_CELL = r"(?i)<td\b[^>]*>([\s\S]*?)</td>"
LINKED_CELL = (
    rf"</th><td [^\n]*<a[{WS}]*href[^\n]*>"
    rf"(?:[{WS}]*\n[{WS}]*([^\n]*)[{WS}]*</a></td>|[{WS}]*([^>\n]*)[{WS}]*</a></td>)"
)
ONE_CREATOR = rf"<th[^\n]*>[{WS}]*Created by[{WS}]*{LINKED_CELL}"
ONE_DIRECTOR = rf"Directed by[{WS}]*{LINKED_CELL}"
# What the linear forms of the composer and of single names must give, each as one pattern with one group.
PLAIN_COMPOSER = r"Music by[^\n]*<a[^\n]*>([^\n]*)</a>[^\n]*<th[^\n]*>P"
_PLAIN_CELL = rf"[{WS}]*</th><td [^\n]*<a[{WS}]*href[^\n]*>[{WS}]*([^\n]*)[{WS}]*</a></td>"
PLAIN_CREATOR = rf"<th[^\n]*>[{WS}]*Created by{_PLAIN_CELL}"
PLAIN_DIRECTOR = rf"Directed by{_PLAIN_CELL}"
CREATOR_LIST = r"Created by[\s\S]*?<ul>([\s\S]*?)</ul>"
DIRECTOR_LIST = r"Directed by[\s\S]*?<ul>([\s\S]*?)</ul>"
ANCHOR_TEXT = rf"<a[{WS}]*[^>]*>([^\n]*?)</a>"
WIKI_HREF = rf'(?i)<a[{WS}]+[^>]*href="/wiki/([^"]*)"[^>]*>[^\n]*?</a>'

# Search analysis: words joined by single dots are one token; short English stop list; two characters at least.
# The possessive form is Java's; without it a long run of dotted words recurses once per word.
TOKEN = r"[\p{L}\p{N}_]++(?:\.[\p{L}\p{N}_]++)*+"
MIN_TOKEN = 2
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "can", "for", "from", "have", "if", "in", "is", "it",
    "may", "not", "of", "on", "or", "tbd", "that", "the", "this", "to", "us", "we", "when", "will", "with",
    "yet", "you", "your",
)
SEARCH_FIELDS = ("title", "title_wiki", "director_list", "director_wiki", "music", "release")
DEFAULT_HITS = 10
