"""HTML expressions: regular expressions that Java and RE2 read alike, no backtracking groups."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.fixed_values import ARTICLE_BONUS, BLOCK_CHARS, CODE_LIKE, FALLBACK_NODE_CHARS, LINK_WEIGHT
from pageloom.functions import tags as T
from pageloom.functions.text import decode_entities, falsy_to_null, let, strip

_NO_TEXT_TAGS = ["nav", "footer", "aside", "form", "noscript", "iframe", "svg"]
_NO_TEXT = "(?is)<(?:" + "|".join(rf"{t}\b[^>]*>.*?</{t}\s*>" for t in _NO_TEXT_TAGS) + ")"
_SIDE_TAGS = ["div", "section", "article", "ul", "ol", "li", "p", "span"]
_SIDE_CLASS = (
    r"""\b[^>]*\s(?:class|id)\s*=\s*["'](?:[^"']*\s)?(?:ad|comments?)(?:\s[^"']*)?["'][^>]*>"""
)
_LINE_ENDS = r"(?i)<(?:/(?:p|h[1-6]|li|div)|p|br)\b[^>]*>"
_TAG = "<[^>]*>"
_ATTRIBUTE = r"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
#: A tag of the class of a content container, in double, single or no quotes; class names keep their case.
_CONTENT = "(?:post-body|main-content)"
_CONTENT_TAG = (
    r"(?s)<([a-zA-Z][a-zA-Z0-9-]*)\s(?:[^>]*\s)?(?i:class)\s*=\s*"
    + rf"""(?:"(?:[^">]*\s)?{_CONTENT}(?:\s[^">]*)?"|'(?:[^'>]*\s)?{_CONTENT}(?:\s[^'>]*)?'|{_CONTENT}(?=[\s>]))"""
)
_SPACE_REFERENCE, _REFERENCE = "&(?:nbsp|#160|#[xX][aA]0);", "&#?[A-Za-z0-9]{1,31};"
#: Begin and end of an outermost article among the blocks: characters that no page may hold.
_BEGIN, _END = "\ufdd0", "\ufdd1"

ANCHOR = r"(?is)<a\s[^>]*>"


def visible_markup(html: Column) -> Column:
    """The page without comments, scripts and styles; no attribute value holds an angle bracket."""
    return T.plain_markup(html)


def raw_attribute(tag: Column, name: str) -> Column:
    """Attribute as written, quotes included; empty when absent."""
    return F.regexp_extract(tag, _ATTRIBUTE.replace("{name}", name), 1)


def unquote(raw: Column) -> Column:
    return F.regexp_replace(raw, "^[\"']|[\"']$", "")


def attribute(tag: Column, name: str) -> Column:
    """Attribute value, character references not decoded."""
    return unquote(raw_attribute(tag, name))


def _without_side(html: Column, tag: Column) -> Column:
    """The markup without advertisement and comment elements of a kind, nested ones included.

    Markup in which such an element is never closed stays as it is.
    """

    def pattern(before: str, after: str) -> Column:
        return F.concat(F.lit(before), tag, F.lit(after))

    # Cut before each opening and after each closing tag of the kind
    pieces = F.split(html, F.concat(pattern(r"(?i)(?=<", r"\b)|"), pattern("(?<=</", r"\s{0,9}>)")))
    side_tag, opening, closing = pattern("(?is)^<", _SIDE_CLASS), pattern("(?i)^<", r"\b"), pattern("(?i)</", r"\s*>$")

    def step(state: Column, piece: Column) -> Column:
        hidden = (state["depth"] > 0) | F.rlike(piece, side_tag)
        moved = F.rlike(piece, opening).cast("int") - F.rlike(piece, closing).cast("int")
        depth = F.when(hidden, state["depth"] + moved).otherwise(0)
        kept = F.when(hidden, state["kept"]).otherwise(F.concat(state["kept"], piece))
        return F.struct(F.greatest(depth, F.lit(0)).alias("depth"), kept.alias("kept"))

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("kept"))
    cut = F.aggregate(pieces, start, step, lambda s: F.when(s["depth"] == 0, s["kept"]))
    return F.when(F.rlike(html, pattern("(?is)<", _SIDE_CLASS)), F.coalesce(cut, html)).otherwise(html)


def without_side_blocks(html: Column) -> Column:
    """The markup without advertisements and comments.

    Elements that hold no other one of their kind go first, by one expression; what is left then, if
    anything, is nested and needs counting.
    """
    any_tag = rf"(?is)<(?:{'|'.join(_SIDE_TAGS)}){_SIDE_CLASS}"
    flat = "|".join(
        rf"{t}{_SIDE_CLASS}[^<]*+(?:<(?!/?{t}\b)[^<]*+)*+</{t}\s*>" for t in _SIDE_TAGS
    )

    def all_tags(markup: Column) -> Column:
        return F.aggregate(F.array(*map(F.lit, _SIDE_TAGS)), markup, _without_side)

    return let(
        F.regexp_replace(html, f"(?is)<(?:{flat})", ""),
        lambda h: F.when(h.rlike(any_tag), all_tags(h)).otherwise(h),
    )


def _marked(scope: Column) -> Column:
    """A scope with its outermost articles between marks."""
    piece = lambda p: F.concat(
        F.when((p["before"] == 1) & T.is_inside(p), _BEGIN).otherwise(""),
        p["text"],
        F.when((p["after"] == 1) & T.is_inside(p), _END).otherwise(""),
    )
    every = F.array_join(F.transform(T.nested(scope, "article"), piece), "")
    open_ended = lambda m: F.contains(m, F.lit(_BEGIN)) & ~F.contains(F.substring_index(m, _BEGIN, -1), F.lit(_END))
    several = let(every, lambda m: F.when(open_ended(m), F.concat(m, F.lit(_END))).otherwise(m))
    return F.when(T.has_element(scope, "article"), several).otherwise(scope)


def _scope(markup: Column) -> Column:
    """Where the main text is looked for: ``main``, unless an article is outside of it; else the body, else all."""
    after = F.get(F.split(markup, r"(?i)<body\b[^>]*>", 2), F.lit(1))
    body = F.coalesce(falsy_to_null(F.split(after, r"(?i)</body\s*>", 2)[0]), markup)

    def of_main(pieces: Column) -> Column:
        outside = F.exists(pieces, lambda p: ~T.is_inside(p) & T.has_element(p["text"], "article"))
        return F.when(outside, body).otherwise(F.coalesce(falsy_to_null(T.inside(pieces)), body))

    return F.when(T.has_element(markup, "main"), let(T.nested(markup, "main"), of_main)).otherwise(body)


def _plain_chars(markup: Column) -> Column:
    """Characters of text; a character reference counts as one, and as none if it is a space."""
    text = F.regexp_replace(markup, f"{_TAG}|[{_BEGIN}{_END}]", "")
    return F.length(strip(F.regexp_replace(F.regexp_replace(text, _SPACE_REFERENCE, " "), _REFERENCE, "?")))


def _block(part: Column, markup: Column) -> Column:
    """A block with its score: characters of text, less those of links several times, less a fixed cost.

    In an article nothing is taken off, and a bonus lets runs go on from one article to the next.
    """
    links = F.array_join(F.regexp_extract_all(markup, F.lit(r"(?is)<a\b[^>]*>(.*?)(?:</a\s*>|\z)"), F.lit(1)), "")
    return let(
        _plain_chars(markup),
        lambda chars: F.struct(
            markup.alias("markup"),
            F.startswith(part, F.lit(_BEGIN)).alias("article"),
            chars.alias("chars"),
            F.when(F.startswith(part, F.lit(_BEGIN)), chars + ARTICLE_BONUS)
            .otherwise(chars - LINK_WEIGHT * _plain_chars(links) - BLOCK_CHARS)
            .alias("score"),
        ),
    )


def _best_run(blocks: Column) -> Column:
    """First and last index of the blocks with the greatest sum, each smoothed by its neighbours.

    Of equal sums the one that ends first, of these the one that starts last. Blocks at both ends whose own score is not
    positive are left out later.
    """

    def smoothed(block: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(blocks, i - 1)["score"]).otherwise(0)
        return before + 2 * block["score"] + F.coalesce(F.get(blocks, i + 1)["score"], F.lit(0))

    def step(s: Column, value: Column) -> Column:
        goes_on = s["sum"] > 0
        return let(
            F.struct(
                (F.when(goes_on, s["sum"]).otherwise(0) + value).alias("sum"),
                F.when(goes_on, s["first"]).otherwise(s["at"]).alias("first"),
            ),
            lambda run: F.struct(
                (s["at"] + 1).alias("at"),
                run["sum"].alias("sum"),
                run["first"].alias("first"),
                F.when(run["sum"] > s["best"], run["sum"]).otherwise(s["best"]).alias("best"),
                F.when(run["sum"] > s["best"], run["first"]).otherwise(s["from"]).alias("from"),
                F.when(run["sum"] > s["best"], s["at"]).otherwise(s["to"]).alias("to"),
            ),
        )

    zero = {"at": 0, "sum": 0, "first": 0, "best": 0, "from": 0, "to": -1}
    start = F.struct(*[F.lit(v).alias(k) for k, v in zero.items()])
    return F.aggregate(F.transform(blocks, smoothed), start, step, lambda s: F.struct(s["from"].alias("from"), s["to"].alias("to")))


def _chosen(blocks: Column, run: Column) -> Column:
    """Blocks of articles, and the best run from its first to its last good block; all if there are neither.

    Beside articles only good blocks of the run are kept: short lines around them are captions and menus.
    """
    indexed = F.transform(blocks, lambda b, i: F.struct(i.alias("i"), b["score"].alias("score")))
    good = F.filter(indexed, lambda x: x["i"].between(run["from"], run["to"]) & (x["score"] > 0))
    span = lambda found: F.struct(F.element_at(found, 1)["i"].alias("from"), F.element_at(found, -1)["i"].alias("to"))

    def kept(any_article: Column) -> Column:
        return let(
            span(good),
            lambda s: F.filter(blocks, lambda b, i: b["article"] | (i.between(s["from"], s["to"]) & (~any_article | (b["score"] > 0)))),
        )

    return let(
        F.exists(blocks, lambda b: b["article"]),
        lambda any_article: F.when((F.size(good) > 0) | any_article, kept(any_article)).otherwise(blocks),
    )


def _of_blocks(marked: Column) -> Column:
    """The best blocks of a scope whose outermost articles are marked."""
    parts = F.split(marked, f"(?={_BEGIN})|(?<={_END})")
    blocks = F.flatten(F.transform(parts, lambda part: F.transform(F.split(part, _LINE_ENDS), lambda m: _block(part, m))))
    chosen = let(F.filter(blocks, lambda b: b["chars"] > 0), lambda full: let(_best_run(full), lambda run: _chosen(full, run)))
    return F.array_join(F.transform(chosen, lambda b: b["markup"]), "\n")


def text_region(markup: Column) -> Column:
    """Of the visible markup, that of the main text: no navigation, advertisements, comments or other side blocks.

    If a page's scope holds articles and no other text, they are the region. Else it is what the scores of its blocks
    choose, articles in any case.
    """

    def of_parts(marked: Column, parts: Column) -> Column:
        """``parts`` begin with an article each, but for the first."""
        rest = F.slice(parts, 2, F.size(parts))
        outside = F.array_join(F.transform(parts, lambda p: F.substring_index(p, _END, -1)), "\n")
        articles = F.array_join(F.transform(rest, lambda p: F.substring_index(p, _END, 1)), "\n")
        chosen = F.when((F.size(parts) > 1) & (_plain_chars(outside) == 0), articles).otherwise(_of_blocks(marked))
        return F.replace(F.replace(chosen, F.lit(_BEGIN), F.lit("")), F.lit(_END), F.lit(""))

    def of_scope(scope: Column) -> Column:
        general = let(_marked(scope), lambda m: let(F.split(m, _BEGIN), lambda parts: of_parts(m, parts)))
        return let(
            T.single(scope, "article"),
            lambda one: F.when(_plain_chars(F.concat(one["before"], F.lit("\n"), one["after"])) == 0, one["element"]).otherwise(general),
        )

    clean = without_side_blocks(F.regexp_replace(markup, _NO_TEXT, ""))
    return let(clean, lambda c: let(_scope(c), of_scope))


def region_text(region: Column) -> Column:
    """Text of a region, one line per block.

    The last two patterns leave single spaces and line ends alone and match only what changes.
    """
    text = F.regexp_replace(F.regexp_replace(region, _LINE_ENDS, "\n"), _TAG, "")
    spaces = "[ \t\r\x0b\x0c\u00a0]{2,}|[\t\r\x0b\x0c\u00a0]"
    folded = F.regexp_replace(decode_entities(text), spaces, " ")
    return strip(F.regexp_replace(folded, "[ \n]{2,}", "\n"))


def main_text(html: Column) -> Column:
    """Main text of a page; empty when the page has none."""
    return markup_text(visible_markup(html))


def markup_text(markup: Column) -> Column:
    """The same from the visible markup."""
    return F.coalesce(region_text(text_region(markup)), F.lit(""))


def fallback_text(html: Column) -> Column:
    """Long text nodes of the content containers, code-like ones left out.

    Containers come in the order of their tags, each with all text in it: a nested one's text is also its own.
    """

    def named(markup: Column) -> Column:
        return F.contains(markup, F.lit("post-body")) | F.contains(markup, F.lit("main-content"))

    def names(markup: Column) -> Column:
        others = F.transform(F.regexp_extract_all(markup, F.lit(_CONTENT_TAG), F.lit(1)), F.lower)
        article = F.when(T.has_element(markup, "article"), F.array(F.lit("article"))).otherwise(F.array().cast("array<string>"))
        return F.when(named(markup), F.array_union(article, others)).otherwise(article)

    def opens_container(piece: Column) -> Column:
        return (piece["opens"] == "article") | ((piece["opens"] != "") & piece["text"].rlike("^" + _CONTENT_TAG))

    def containers(pieces: Column) -> Column:
        whole = F.transform(pieces, lambda p, i: F.when(opens_container(p), T.element_at(pieces, p, i)))
        return F.filter(whole, lambda w: w.isNotNull())

    def of_markup(markup: Column) -> Column:
        every = let(
            names(markup),
            lambda found: F.when(F.size(found) > 0, let(T.nested(markup, F.array_join(found, "|")), containers)),
        )
        return let(
            T.single(markup, "article"),
            lambda one: F.when(one.isNotNull() & ~named(markup), F.array(one["element"])).otherwise(every),
        )

    def long_nodes(elements: Column) -> Column:
        nodes = F.flatten(F.transform(elements, lambda w: F.split(w, _TAG)))
        long = F.filter(F.transform(nodes, lambda n: strip(decode_entities(n))), lambda n: F.length(n) >= FALLBACK_NODE_CHARS)
        return F.array_join(F.filter(long, lambda n: ~n.rlike(CODE_LIKE)), "\n\n")

    # What is left out still parts the text nodes around it
    return F.coalesce(long_nodes(let(T.plain_markup(html, "<!>"), of_markup)), F.lit(""))


def meta_tags(markup: Column) -> Column:
    """All ``<meta>`` tags of a page in one short text."""
    return F.array_join(
        F.regexp_extract_all(markup, F.lit(r"(?i)<meta\s[^>]*>"), F.lit(0)), ""
    )


def meta_content(metas: Column, key: str, name: str) -> Column:
    """Content of the first ``<meta>`` whose attribute ``key`` equals ``name``."""
    tag = F.regexp_extract(
        metas, rf"""(?is)<meta\s(?:[^>]*\s)?{key}\s*=\s*["']?{name}(?:["'\s/][^>]*)?>""", 0
    )
    return falsy_to_null(attribute(tag, "content"))


def page_title(markup: Column, metas: Column) -> Column:
    """Declared title, else the first direct text of ``<title>`` or ``<h1>``."""
    heading = F.regexp_extract(markup, r"(?i)<(?:title|h1)\b[^>]*>([^<]+)", 1)
    return decode_entities(
        F.coalesce(meta_content(metas, "property", "og:title"), falsy_to_null(heading))
    )


def _first_image(markup: Column, container: str) -> Column:
    within = T.inside(T.nested(markup, container))
    tag = F.regexp_extract(within, r"(?is)<img\s(?:[^>]*\s)?src\s*=[^>]*>", 0)
    return F.when(T.has_element(markup, container), falsy_to_null(attribute(tag, "src")))


def main_image(markup: Column, metas: Column) -> Column:
    """Declared image, else the first one in a figure or an article."""
    shown = F.when(
        markup.rlike(r"(?i)<img\s"),
        F.coalesce(_first_image(markup, "figure"), _first_image(markup, "article")),
    )
    return decode_entities(
        F.coalesce(
            meta_content(metas, "property", "og:image"),
            meta_content(metas, "name", "twitter:image"),
            shown,
        ),
        attribute=True,
    )


def page_date(markup: Column, metas: Column) -> Column:
    time_tag = F.regexp_extract(markup, r"(?i)<time\s[^>]*>", 0)
    return F.coalesce(
        meta_content(metas, "property", "article:published_time"),
        meta_content(metas, "name", "date"),
        falsy_to_null(attribute(time_tag, "datetime")),
    )


def page_author(metas: Column) -> Column:
    return F.coalesce(
        meta_content(metas, "name", "author"), meta_content(metas, "property", "article:author")
    )


def has_author_and_date(markup: Column, metas: Column) -> Column:
    return page_author(metas).isNotNull() & page_date(markup, metas).isNotNull()
