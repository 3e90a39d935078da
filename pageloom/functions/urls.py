"""URL expressions."""

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.fixed_values import DATE_PATH
from pageloom.functions.text import let

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_ROOT = r"^((?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*)"
_BEFORE_QUERY = r"^([^?#]*)"


def netloc(url: Column) -> Column:
    """The authority part, port included; empty when there is none."""
    return F.regexp_extract(url, _NETLOC, 1)


def frontier_host(url: Column) -> Column:
    """Host for the on-site test: lower case, every ``www.`` removed."""
    return F.replace(F.lower(netloc(url)), F.lit("www."), F.lit(""))


def rule_host(url: Column) -> Column:
    """Host for the cleanup rules: every ``www.`` removed, case kept."""
    return F.replace(netloc(url), F.lit("www."), F.lit(""))


def registry_domain(domain: Column) -> Column:
    """Host for the registry look-up: one leading ``www.`` removed."""
    return F.regexp_replace(domain, r"^www\.", "")


def clean_ref(ref: Column) -> Column:
    """The reference without line breaks and leading control characters."""
    no_breaks = F.translate(ref, "\t\r\n", "")
    return F.regexp_replace(no_breaks, r"^[\x00-\x20]+", "")


def _walk_segments(path: Column) -> Column:
    """Resolve the ``.`` and ``..`` segments of a path that begins with a slash."""
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, seg: F.when(seg == ".", done)
        .when(seg == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(seg))),
    )
    closing = F.when(path.rlike(r"/\.{1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    joined = F.concat(F.array_join(kept, "/"), closing)
    return F.when(F.startswith(joined, F.lit("/")), joined).otherwise(F.concat(F.lit("/"), joined))


def _normal_path(path: Column) -> Column:
    """Path after a merge; only paths with dot segments need the walk."""
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), _walk_segments(path)).otherwise(path)


def join_paths(base: Column, ref: Column) -> Column:
    """Resolve a reference against a base; neither has query or fragment."""
    scheme = F.lower(F.regexp_extract(base, _SCHEME, 1))
    ref_scheme = F.lower(F.regexp_extract(ref, _SCHEME, 1))
    foreign = (ref_scheme != "") & (ref_scheme != scheme)
    rest = F.when(ref_scheme != "", F.regexp_replace(ref, _SCHEME, "")).otherwise(ref)
    root = F.regexp_extract(base, _ROOT, 1)
    base_path = F.regexp_replace(base, _ROOT, "")
    folder = F.regexp_extract(base_path, "(?s)^(.*/)", 1)
    # Only a merge of two paths folds repeated slashes; a path from the root keeps them.
    merged = F.regexp_replace(F.concat(F.lit("/"), folder, rest), "/{2,}", "/")
    return (
        F.when(foreign, ref)
        .when(F.startswith(rest, F.lit("//")), F.concat(scheme, F.lit(":"), rest))
        .when(rest == "", base)
        .when(F.startswith(rest, F.lit("/")), F.concat(root, _normal_path(rest)))
        .otherwise(F.concat(root, _normal_path(merged)))
    )


def before_query(url: Column) -> Column:
    """The URL up to the first ``#`` or ``?``."""
    return F.regexp_extract(url, _BEFORE_QUERY, 1)


def _join_any(base: Column, ref: Column) -> Column:
    head = before_query(ref)
    joined = join_paths(before_query(base), head)
    tail = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(ref, _BEFORE_QUERY, ""), r"^\?(#|$)", "$1"), "#$", ""
    )
    base_query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)?", 1)
    kept_query = F.when((head == "") & ~F.startswith(tail, F.lit("?")), base_query).otherwise("")
    return F.when(ref == "", base).otherwise(F.concat(joined, kept_query, tail))


def url_join(base: Column, ref: Column) -> Column:
    """Absolute form of a reference found on the page ``base``."""
    return let(clean_ref(ref), lambda clean: _join_any(base, clean))


def strip_slashes(url: Column) -> Column:
    return F.rtrim(url, F.lit("/"))


def canonical_url(url: Column) -> Column:
    """Cut fragment and query, strip every trailing slash."""
    return strip_slashes(before_query(url))


def has_date_path(url: Column) -> Column:
    return url.rlike(DATE_PATH)


@cache
def _plain_letters() -> tuple[str, str]:
    """By Unicode's decompositions: letters with marks, and the small letters without; then marks, which go."""
    letters, plain, marks = [], [], []
    for char in map(chr, range(0x80, sys.maxunicode + 1)):
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn").lower()
        if len(base) == 1 and base not in (char, char.lower()):
            letters.append(char)
            plain.append("\u03c3" if base == "\u03c2" else base)
    return "".join(["\u03c2", *letters, *marks]), "".join(["\u03c3", *plain])


def folded(url: Column) -> Column:
    """The URL in small letters without accents, for keys that stand for all its spellings; a final sigma is a sigma."""
    letters, plain = _plain_letters()
    small = F.lower(F.when(url.rlike(r"[^\x00-\x7F]"), F.translate(url, letters, plain)).otherwise(url))
    return F.when(F.contains(small, F.lit("\u03c2")), F.translate(small, "\u03c2", "\u03c3")).otherwise(small)


def key_of(url: Column, fold: bool) -> Column:
    """What two URLs have in common if they are one: all of it, or with ``fold`` its folded form."""
    return folded(url) if fold else url
