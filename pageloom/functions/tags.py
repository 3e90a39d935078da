"""Tags of a page as events: what is nested in what.

``plain_markup`` makes every later ``<[^>]*>`` safe, as no attribute value holds ``<`` or ``>`` any more. ``nested`` then
cuts the markup at the tags of some elements, and one fold gives each piece the elements that it stands in.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.text import let

_BLOCKS = "|".join(rf"{t}\b[^>]*>.*?</{t}\s*>" for t in ("script", "style"))
#: Comments, scripts and styles.
SILENT = rf"(?is)<(?:!--.*?-->|{_BLOCKS})"
#: A tag whose quoted values may hold anything but their quote; quotes count only after an equals sign.
QUOTED_TAG = r"""</?[a-zA-Z](?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
#: A quoted value that holds, or seems to hold, an angle bracket.
_SUSPECT = r"""=\s*(?:"[^"<>]*[<>]|'[^'<>]*[<>])"""
#: Mark after which the name of an open element stands in a path, and before the next.
_MARK = "/"


def _without_brackets(token: Column) -> Column:
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    escaped = F.replace(F.replace(inner, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.concat(F.lit("<"), escaped, F.lit(">"))


def plain_markup(html: Column, silent: str = "") -> Column:
    """The page without comments, scripts and styles (``silent`` in their place), brackets in attribute values as
    character references.
    """

    def careful(markup: Column) -> Column:
        tokens = F.regexp_extract_all(markup, F.lit(rf"(?s){QUOTED_TAG}|[^<]++|<"), F.lit(0))
        is_tag = lambda t: F.startswith(t, F.lit("<")) & (F.length(t) > 1)
        return F.array_join(F.transform(tokens, lambda t: F.when(is_tag(t), _without_brackets(t)).otherwise(t)), "")

    return let(
        F.regexp_replace(html, SILENT, silent),
        lambda markup: F.when(markup.rlike(_SUSPECT), careful(markup)).otherwise(markup),
    )


def has_element(markup: Column, names: str) -> Column:
    """Whether an element of these names (joined by ``|``) is opened."""
    return markup.rlike(rf"(?i)<(?:{names})[\s/>]")


def nested(markup: Column, names: str | Column) -> Column:
    """The markup in pieces, cut before each opening and after each closing tag of the elements named (joined by ``|``).

    Each piece comes with the element that it ``opens``, how deep the page is ``before`` it, ``within`` it and ``after``
    it: lengths of the path of open elements, 1 outside of all. A closing tag closes the nearest element of its name, and
    all that are open in it; without one it is ignored. What is never closed ends with the page.
    """
    is_literal = isinstance(names, str)

    def pattern(before: str, after: str):
        return before + names + after if is_literal else F.concat(F.lit(before), names, F.lit(after))

    def name_in(piece: Column, before: str, after: str) -> Column:
        found = pattern(before, after)
        return F.lower(F.regexp_extract(piece, found, 1) if is_literal else F.call_function("regexp_extract", piece, found, F.lit(1)))

    # Looking back is tried at every place and for every length: only after a bracket is there anything to find
    opening, closing = pattern("(?i)(?=<(?:", r")[\s/>])|(?<=>)"), pattern("(?<=</(?:", r")\s{0,9}>)")
    cut = opening + closing if is_literal else F.concat(opening, closing)
    tagged = F.transform(
        F.split(markup, cut),
        lambda p: F.struct(
            p.alias("text"),
            name_in(p, "(?i)^<(", r")[\s/>]").alias("opens"),
            name_in(p, "(?i)</(", r")\s*>\z").alias("closes"),
        ),
    )

    def closed(path: Column, name: Column) -> Column:
        whole = F.concat(F.lit(_MARK), name, F.lit(_MARK))
        back = F.instr(F.reverse(path), F.reverse(whole))
        kept = F.substring(path, F.lit(1), F.length(path) - back - F.length(whole) + 2)
        return F.when((name != "") & (back > 0), kept).otherwise(path)

    def step(state: Column, piece: Column) -> Column:
        path = F.when(piece["opens"] != "", F.concat(state["path"], piece["opens"], F.lit(_MARK))).otherwise(state["path"])
        return let(
            path,
            lambda inner: let(
                closed(inner, piece["closes"]),
                lambda outer: F.struct(
                    outer.alias("path"),
                    F.concat(state["depths"], F.array(F.struct(F.length(state["path"]).alias("before"), F.length(inner).alias("within"), F.length(outer).alias("after")))).alias("depths"),
                ),
            ),
        )

    start = F.struct(F.lit(_MARK).alias("path"), F.array().cast("array<struct<before:int,within:int,after:int>>").alias("depths"))
    depths = lambda pieces: F.aggregate(pieces, start, step, lambda s: s["depths"])
    return let(
        tagged,
        lambda pieces: F.zip_with(
            pieces,
            depths(pieces),
            lambda p, d: F.struct(p["text"].alias("text"), p["opens"].alias("opens"), d["before"].alias("before"), d["within"].alias("within"), d["after"].alias("after")),
        ),
    )


def single(markup: Column, name: str) -> Column:
    """What stands before, in and after the element of a name, if it is opened once only; else null.

    That is the usual case, and needs no fold. An element that is never closed ends with the page; ``element`` is
    without its closing tag.
    """

    def cut(parts: Column) -> Column:
        return let(
            F.split(parts[1], rf"(?i)</{name}\s*>", 2),
            lambda ended: F.struct(
                parts[0].alias("before"),
                F.concat(F.lit(f"<{name}"), ended[0]).alias("element"),
                F.coalesce(F.get(ended, F.lit(1)), F.lit("")).alias("after"),
            ),
        )

    return let(F.split(markup, rf"(?i)<{name}(?=[\s/>])", 3), lambda parts: F.when(F.size(parts) == 2, cut(parts)))


def is_inside(piece: Column) -> Column:
    return piece["within"] > 1


def inside(pieces: Column) -> Column:
    """The markup that stands in any of the elements."""
    return F.array_join(F.transform(F.filter(pieces, is_inside), lambda p: p["text"]), " ")


def element_at(pieces: Column, piece: Column, index: Column) -> Column:
    """The whole element that a piece opens, what is nested in it included."""
    rest = F.slice(pieces, index + 1, F.size(pieces))
    end = F.array_position(F.transform(rest, lambda p: p["after"] <= piece["before"]), True)
    return F.array_join(F.transform(F.slice(rest, 1, F.when(end > 0, end.cast("int")).otherwise(F.size(rest))), lambda p: p["text"]), "")
