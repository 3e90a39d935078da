"""Text expressions."""

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The characters that numbers 128 to 159 stand for in pages (Windows-1252).
WINDOWS_1252 = {
    n: bytes([n]).decode("cp1252", "replace") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)
}
#: Names looked up first; all others follow.
COMMON_NAMES = ["amp", "lt", "gt", "quot", "apos", "nbsp", "copy", "middot", "laquo", "raquo", "ndash", "mdash", "hellip"]
#: All named references of the HTML standard in one text: mark, name, mark, characters.
_NAMES = "".join(f"\x01{name}\x02{chars}" for name, chars in html5.items() if name.endswith(";")) + "\x01"


def strip(col: Column) -> Column:
    """Strip all leading and trailing whitespace, Unicode spaces included."""
    return F.trim(col, F.lit(WHITESPACE))


def any_of(tests: list[Column]) -> Column:
    """OR of many tests as a balanced tree, so that long lists stay shallow."""
    if not tests:
        return F.lit(False)
    if len(tests) == 1:
        return tests[0]
    middle = len(tests) // 2
    return any_of(tests[:middle]) | any_of(tests[middle:])


def contains_any(col: Column, words: list[str]) -> Column:
    return any_of([F.contains(col, F.lit(w)) for w in words])


def starts_with_any(col: Column, prefixes: list[str]) -> Column:
    return any_of([F.startswith(col, F.lit(p)) for p in prefixes])


def count_of(col: Column, part: str) -> Column:
    """Number of non-overlapping occurrences of ``part``."""
    gone = F.length(col) - F.length(F.replace(col, F.lit(part), F.lit("")))
    return (gone / len(part)).cast("int")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind a costly value once for an expression that names it several times."""
    return F.transform(F.array(value), use)[0]


def _named(name: Column) -> Column:
    """Characters of a named reference; null for a name that the standard does not have."""
    key = F.concat(F.lit("\x01"), name, F.lit(";\x02"))
    after = F.call_function("substring_index", F.lit(_NAMES), key, F.lit(-1))
    rare = F.when(F.contains(F.lit(_NAMES), key), F.substring_index(after, "\x01", 1))
    common = F.create_map(*[F.lit(x) for n in COMMON_NAMES for x in (n, html5[f"{n};"])])
    return F.coalesce(F.try_element_at(common, name), rare)


def _numbered(ref: Column) -> Column:
    """Character of ``#123`` or ``#x7b``; null for a number that names none."""
    hexadecimal = ref.rlike("^#[xX]")
    digits = F.regexp_replace(F.regexp_replace(ref, "^#[xX]?", ""), "^0+", "")
    code = F.when(
        F.length(digits) <= 7,
        F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int"),
    )
    old = F.create_map(*[F.lit(x) for pair in WINDOWS_1252.items() for x in pair])
    usable = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.when(usable, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    return F.when(code.between(128, 159), F.coalesce(F.try_element_at(old, code), char)).otherwise(char)


#: Names that the standard also reads without a semicolon, longest first.
_OPEN_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
#: A reference at the beginning of a text, without its semicolon; in attribute values open names must not run on.
_NUMBER = "#[0-9]+|#[xX][0-9A-Fa-f]+"
_IN_TEXT = f"^({_NUMBER}|[A-Za-z][A-Za-z0-9]*(?=;)|{_OPEN_NAMES})"
_IN_ATTRIBUTE = f"^({_NUMBER}|[A-Za-z][A-Za-z0-9]*(?=;)|(?:{_OPEN_NAMES})(?![=A-Za-z0-9]))"


def _decode_piece(piece: Column, pattern: str) -> Column:
    """Text after an ampersand, with the reference it starts with."""

    def replaced(ref: Column) -> Column:
        char = F.when(F.startswith(ref, F.lit("#")), _numbered(ref)).otherwise(_named(ref))
        ended = F.substring(piece, F.length(ref) + 1, F.lit(1)) == ";"
        rest = F.substring(piece, F.length(ref) + F.when(ended, 2).otherwise(1), F.length(piece))
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))

    return let(F.regexp_extract(piece, pattern, 1), replaced)


def decode_entities(col: Column, attribute: bool = False) -> Column:
    """Replace character references by their characters, each reference once.

    The text is cut at its ampersands, so it is read once whatever the number of known names. Numbers, and names that the
    standard lets, may lack their semicolon; in an ``attribute`` such a name must end there.
    """
    pattern = _IN_ATTRIBUTE if attribute else _IN_TEXT

    def decoded(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, 2, F.size(pieces)), lambda piece: _decode_piece(piece, pattern))
        return F.concat(pieces[0], F.array_join(tail, ""))

    return let(
        col,
        lambda text: F.when(
            F.contains(text, F.lit("&")), let(F.split(text, "&"), decoded)
        ).otherwise(text),
    )


def falsy_to_null(col: Column) -> Column:
    """Null for the empty string, so that ``coalesce`` skips it like null."""
    return let(col, lambda value: F.nullif(value, F.lit("")))
