"""Op 1: language identification by Bayesian evidence fusion.

Four kinds of evidence are combined by Bayes' rule for each text:

- the text itself: likelihoods of its letter trigrams, learned from texts with a known language;
- the declared language of the markup, and the suffix of the address: how often each value goes with each language;
- the host: a prior from the other texts of the host, smoothed towards that of its domain, and this towards all texts.

The last three are learned without labels, by grouped sums of the languages that the texts alone suggest. The own
text is left out of its host's sum. Evidence that is missing (null or empty) says nothing. Trigrams overlap and
repeat, so a text counts as at most TEXT_TRIGRAMS independent ones.

Null and empty texts are judged by the other evidence alone. Ties go to the language that comes first. Repeated rows
count, and are judged, each on its own. Without training texts all languages are equally likely. An empty table gives
an empty result. The model has one number for each trigram bucket and language, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.html import main_text
from pageloom.functions.urls import frontier_host
from pageloom.llm.shared import steps, stored, text_of

#: The languages where no text teaches any.
LANGUAGES = ("de", "en", "es", "fr")
BUCKETS = 1 << 15
TEXT_TRIGRAMS = 200
#: Texts that a parent's prior counts for in its children, and the count added to each declared value and suffix.
PRIOR_TEXTS, ADDED = 5.0, 0.5


def trigram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams of the lower-cased texts, and the row of each."""
    coded = [b" " + " ".join(t.lower().split()).encode() + b" " if t else b"" for t in texts]
    flat = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint32)
    sizes = np.array([len(c) for c in coded], np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    if len(flat) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = ((flat[:-2] << 16 | flat[1:-1] << 8 | flat[2:]) * np.uint32(2654435761)) >> np.uint32(17)
    inside = row[:-2] == row[2:]
    return code[inside].astype(np.int64), row[:-2][inside]


def languages_of(df: DataFrame, lang_col: str = "lang") -> tuple[str, ...]:
    """The languages that the rows have, in order; LANGUAGES if there are none. One row for each comes to the driver."""
    names = df.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang")).distinct()
    return tuple(sorted(r["lang"] for r in names.collect())) or LANGUAGES


def trigram_counts(df: DataFrame, text_col: str, lang_col: str, languages: tuple[str, ...]) -> np.ndarray:
    """Trigram counts by language (rows) and bucket, over all rows whose language is one of those given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), BUCKETS), np.int64)
        number = {name: i for i, name in enumerate(languages)}
        for batch in steps(batches, "text"):
            bucket, row = trigram_buckets(batch.column("text").to_pylist())
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            sums += np.bincount(lang[row] * BUCKETS + bucket, minlength=sums.size).reshape(sums.shape)
        lang, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(lang * BUCKETS + bucket), pa.array(sums[lang, bucket])], names=["cell", "n"])

    rows = df.where(F.col(lang_col).isin(*languages)).select(text_of(text_col).alias("text"), F.col(lang_col).alias("lang"))
    found = rows.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(len(languages) * BUCKETS)
    sums[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return sums.reshape(len(languages), BUCKETS)


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    smoothed = counts + 0.5
    return np.log(smoothed / smoothed.sum(axis=1, keepdims=True)).astype(np.float32)


def with_text_evidence(df: DataFrame, likelihoods: np.ndarray, text_col: str = "text") -> DataFrame:
    """Replaces the text by ``text_logs``: the log likelihood of each language, up to a constant."""
    sent = df.sparkSession.sparkContext.broadcast(likelihoods)
    schema = df.drop(text_col).schema.add("text_logs", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = sent.value
        for batch in steps(batches, text_col):
            bucket, row = trigram_buckets([t or "" for t in batch.column(text_col).to_pylist()])
            sums = np.stack([np.bincount(row, lang[bucket], minlength=batch.num_rows) for lang in logs], axis=1)
            seen = np.bincount(row, minlength=batch.num_rows)[:, None]
            sums = (sums - sums.max(axis=1, keepdims=True)) * np.minimum(1, TEXT_TRIGRAMS / np.maximum(seen, 1))
            values = pa.array(sums.ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(logs))
            columns = [batch.column(n) for n in batch.schema.names if n != text_col]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, values)], names=schema.names)

    return df.mapInArrow(run, schema)


def suffix_of(host: Column) -> Column:
    return F.nullif(F.substring_index(F.regexp_replace(host, r":\d+$", ""), ".", -1), F.lit(""))


def domain_of(host: Column) -> Column:
    return F.nullif(F.substring_index(F.regexp_replace(host, r":\d+$", ""), ".", -2), F.lit(""))


def declared_of(html: Column) -> Column:
    """The language that the markup declares, without region; null if none."""
    found = F.regexp_extract(html, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-z]{2,3})\b""", 1)
    return F.nullif(F.lower(found), F.lit(""))


def evidence_of_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Adds ``text, declared, suffix, host, domain``; drops the markup."""
    host = F.nullif(F.lower(frontier_host(F.col(url_col))), F.lit(""))
    html = F.coalesce(F.col(html_col), F.lit(""))
    found = pages.withColumns({"host": host, "declared": declared_of(html), "text": main_text(html)})
    return found.withColumns({"suffix": suffix_of(F.col("host")), "domain": domain_of(F.col("host"))}).drop(html_col)


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    shares = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(shares, lambda x: x / F.aggregate(shares, F.lit(0.0), lambda a, b: a + b))


def _sums(n: int, prefix: str = "q") -> list[Column]:
    return [F.sum(F.col("q")[i]).alias(f"{prefix}{i}") for i in range(n)]


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def fuse(df: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """Adds ``lang, confidence, text_lang`` to rows with ``text_logs, declared, suffix, host, domain``.

    Other columns are passed on, whatever their names, except those named like an output, which are replaced.
    """
    n, evidence, outputs = len(languages), ["text_logs", "declared", "suffix", "host", "domain"], ["lang", "confidence", "text_lang"]
    kept = [c for c in df.columns if c.lower() not in ("text_logs", *outputs)]
    carried = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("carried")
    q = stored(df.select(carried, *evidence, _softmax(F.col("text_logs")).alias("q")), "language-evidence")
    zeros = F.array_repeat(F.lit(0.0), n)
    everything = F.array(*[F.coalesce(F.sum(F.col("q")[i]), F.lit(0.0)) for i in range(n)])
    total = list(q.agg(everything).first()[0])
    shares = [(x + 1) / (sum(total) + n) for x in total]

    def likelihood(column: str) -> DataFrame:
        """log P(value of the column | language), by value."""
        sums = q.where(F.col(column).isNotNull()).groupBy(column).agg(*_sums(n))
        whole = sums.agg(F.count("*"), *[F.sum(f"q{i}") for i in range(n)]).first()
        logs = [F.log((F.col(f"q{i}") + ADDED) / ((whole[i + 1] or 0.0) + ADDED * max(1, whole[0]))) for i in range(n)]
        return sums.select(column, F.array(*logs).alias(f"{column}_logs"))

    domains = q.where("domain IS NOT NULL").groupBy("domain").agg(F.count("*").alias("m"), F.array(*[F.sum(F.col("q")[i]) for i in range(n)]).alias("s"))
    smooth = [(F.col("s")[i] + PRIOR_TEXTS * shares[i]) / (F.col("m") + PRIOR_TEXTS) for i in range(n)]
    domains = domains.select("domain", F.array(*smooth).alias("domain_prior"))
    hosts = q.where("host IS NOT NULL").groupBy("host").agg(F.max("domain").alias("domain"), F.count("*").alias("host_texts"), F.array(*[F.sum(F.col("q")[i]) for i in range(n)]).alias("host_sums"))
    overall = F.array(*map(F.lit, shares))
    hosts = hosts.join(domains, "domain", "left").select("host", "host_texts", "host_sums", F.coalesce("domain_prior", overall).alias("domain_prior"))
    rows = q.join(likelihood("declared"), "declared", "left").join(likelihood("suffix"), "suffix", "left").join(stored(hosts, "language-hosts"), "host", "left")
    # The arithmetic below costs more than its bytes tell: split by rows
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    others = [(F.greatest(F.col("host_sums")[i] - F.col("q")[i], F.lit(0.0)) + PRIOR_TEXTS * F.col("domain_prior")[i]) / (F.col("host_texts") - 1 + PRIOR_TEXTS) for i in range(n)]
    prior = F.when(F.col("host_texts").isNull(), F.array(*[F.lit(float(np.log(x))) for x in shares])).otherwise(F.array(*map(F.log, others)))
    logs = _added(_added(F.col("text_logs"), prior), _added(F.coalesce("declared_logs", zeros), F.coalesce("suffix_logs", zeros)))
    names = F.array(*map(F.lit, languages))
    first = lambda values: names[(F.array_position(values, F.array_max(values)) - 1).cast("int")]
    judged = rows.withColumn("posterior", _softmax(logs))
    return judged.select(*[F.col("carried")[c].alias(c) for c in kept], first(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("confidence"), first(F.col("q")).alias("text_lang"))
