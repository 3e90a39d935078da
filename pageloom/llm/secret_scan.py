"""Op 10: secret scans with corpus-wide ownership frequency.

Candidates are found by pattern in every text. Their hashes are then counted over the corpus by distinct repositories
and owners: a value that many owners have is an example that was copied around; a value of one owner that looks
random is likely live; one of more owners, but fewer than an example has, is shared. Owners alone decide, as one owner
may use a secret in any number of repositories. Candidates of the base patterns are always reported. Opaque strings
(long, mixed letters and digits, without a telling name) are reported if they look random and are no example.

Offsets count code points; ends are exclusive. Null texts count as empty. A null repository or owner counts as one
unknown one. Repeated rows give repeated results, and count once for ownership. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.shared import steps, stored, text_of

#: Kinds in the order in which they are listed, and their patterns.
KINDS = ["assign", "access", "hex", "opaque"]
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}(?![A-Za-z0-9+/_-])")
PLACEHOLDER = re.compile(r"(?i)example|sample|changeme|placeholder|dummy|x{4}|0{6}|1234|abcd")
#: Owners from which on a value is a copied example, and bits per character from which on it looks random.
EXAMPLE_OWNERS = 3
LIVE_BITS = 3.0

_SPAN = "struct<start: int, kind: int, stop: int, secret: binary, random: boolean>"


def looks_random(value: str) -> bool:
    """Whether a value has digits, the entropy of a random string, and no placeholder in it."""
    counts = Counter(value).values()
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts)
    return bits >= LIVE_BITS and any(c.isdigit() for c in value) and not PLACEHOLDER.search(value)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``start, kind, end, value`` of all base candidates: leftmost, non-overlapping within a kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in LONG_HEX.finditer(text)]  # runs are whole: a shorter match is part of none
    return sorted(found)


def opaque_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Opaque strings that do not overlap a base span."""
    if max(map(len, text.split()), default=0) < 32:
        return []
    found = []
    for m in OPAQUE.finditer(text):
        value = m[0]
        mixed = any(c.islower() for c in value) and any(c.isupper() for c in value) and any(c.isdigit() for c in value)
        if mixed and not any(s < m.end() and m.start() < e for s, _, e, _ in base):
            found.append((m.start(), 3, m.end(), value))
    return found


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner_col: str | None = None) -> DataFrame:
    """``row, doc_id, repo, owner, found`` as a stored table, one row per input row; ``found`` are the candidates.

    Without an owner column, the owner is the part of the repository's name before the first slash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), ("secret", pa.binary()), ("random", pa.bool_())]))
        for batch in steps(batches, "text"):
            found = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                spans = base + opaque_spans(text, base)
                found.append([{"start": s, "kind": k, "stop": e, "secret": hashlib.blake2b(v.encode(), digest_size=16).digest(), "random": looks_random(v)} for s, k, e, v in spans])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, kind)], names=[*names, "found"])

    names = ["row", "doc_id", "repo", "owner"]
    repo = F.col(repo_col).cast("string")
    owner = F.substring_index(repo, "/", 1) if owner_col is None else F.col(owner_col).cast("string")
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), repo.alias("repo"), owner.alias("owner"), text_of(text_col).alias("text"))
    return stored(rows.mapInArrow(run, f"row long, doc_id long, repo string, owner string, found array<{_SPAN}>"), "secrets")


def ownership(scanned: DataFrame) -> DataFrame:
    """``secret, n_owners, n_repos`` over the corpus."""
    each = scanned.select("owner", "repo", F.explode("found.secret").alias("secret"))
    repos = each.groupBy("secret", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = repos.groupBy("secret", "owner").agg(F.sum("one").alias("repos"))
    return owners.groupBy("secret").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def classify(scanned: DataFrame) -> DataFrame:
    """Adds to the scanned rows ``added`` (opaque spans that are reported), ``n_example``, ``n_live`` and ``n_shared``."""
    owned = stored(ownership(scanned), "secret-owners")
    spans = scanned.where(F.size("found") > 0).select("row", F.explode("found").alias("span"))
    judged = spans.withColumn("secret", F.col("span.secret")).join(owned, "secret").select("row", "span", (F.col("n_owners") >= EXAMPLE_OWNERS).alias("example"), (F.expr("span.random") & (F.col("n_owners") == 1)).alias("live"), (F.expr("span.random") & F.col("n_owners").between(2, EXAMPLE_OWNERS - 1)).alias("shared"))
    opaque = F.col("span.kind") == KINDS.index("opaque")
    by_row = judged.groupBy("row").agg(
        F.collect_list(F.when(opaque & (F.col("live") | F.col("shared")), F.col("span"))).alias("added"),
        F.sum((F.col("example") & ~opaque).cast("long")).alias("n_example"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum(F.col("shared").cast("long")).alias("n_shared"),
    )
    none = F.array().cast(f"array<{_SPAN}>")
    return scanned.join(by_row, "row", "left").select(
        "row", "doc_id", "repo", "owner", "found", F.coalesce("added", none).alias("added"), F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"), F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared")
    )


def base_of(found: str = "found") -> Column:
    """The base spans of the scanned rows."""
    return F.filter(found, lambda s: s.kind < KINDS.index("opaque"))


def count_of(kind: str, found: str = "found") -> Column:
    """Number of spans of a kind."""
    number = KINDS.index(kind)
    return F.size(F.filter(found, lambda s: s.kind == number)).cast("long")


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, by start and then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    texts = F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.stop.alias("stop")))), lambda s: F.concat_ws(":", names[s.kind], s.start, s.stop))
    return F.array_join(texts, ",")
